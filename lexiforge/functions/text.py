"""Column functions with Python's text semantics: Unicode white space, code points, half-even rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's str.isspace() in Java's regular expressions.
SPACE = r"[\s\x1c-\x1f]"


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.regexp_replace(c(x), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def let(x: Column, f) -> Column:
    """f(x) with x evaluated once, however often f uses it: the optimiser copies columns into expressions, but no lambda's variable."""
    return F.element_at(F.transform(F.array(x), f), 1)


def collapsed(x: Column | str) -> Column:
    """Runs of white space as one blank."""
    return F.regexp_replace(c(x), rf"(?U){SPACE}+", " ")


def normalized(x: Column | str) -> Column:
    """Lower case, stripped, white space collapsed; null stays null."""
    return collapsed(strip(F.lower(c(x))))


def question_key(x: Column | str) -> Column:
    """The key of duplicate questions: stripped and lower case."""
    return F.lower(strip(F.coalesce(c(x), F.lit(""))))


def short_md5(x: Column | str, n: int = 12) -> Column:
    return F.substring(F.md5(c(x)), 1, n)


def cache_key(content: Column | str, prompt: Column | str, model: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of content|first 100 characters of the prompt|model; nulls count as empty."""
    empty = lambda x: F.coalesce(c(x), F.lit(""))
    return F.substring(F.sha2(F.concat_ws("|", empty(content), F.substring(empty(prompt), 1, 100), empty(model)), 256), 1, 16)


def word_count(x: Column | str) -> Column:
    """Pieces between white space; null has none."""
    return F.size(F.filter(F.split(F.coalesce(c(x), F.lit("")), rf"(?U){SPACE}+"), lambda t: t != ""))


def distinct_chars(x: Column | str) -> Column:
    return F.size(F.array_distinct(F.filter(F.split(F.coalesce(c(x), F.lit("")), ""), lambda t: t != "")))


def first_filled(*names: Column | str) -> Column:
    """The first that is neither null nor empty, else ''."""
    filled = [F.when(F.length(c(n)) > 0, c(n)) for n in names]
    return F.coalesce(*filled, F.lit(""))


def matches(x: Column | str, pattern: str, flags: str = "iuU") -> Column:
    """Whether a pattern occurs; null has none. The pattern is a literal, so that Java compiles it once."""
    lead = f"(?{flags})" if flags else ""
    return F.coalesce(c(x).rlike(lead + pattern), F.lit(False))


def count_groups(pattern: str) -> int:
    import re

    return re.compile(pattern.replace("(?U:", "(?:")).groups


def rounded(x: Column, digits: int) -> Column:
    return F.bround(x, digits)


def percent_text(n: Column, total: Column) -> Column:
    """'n (p%)' with one decimal."""
    return F.concat(n.cast("string"), F.lit(" ("), F.format_string("%.1f", F.bround(n / total * 100, 1)), F.lit("%)"))


def duration_text(seconds: Column | str) -> Column:
    """'12s', '3m 4s' or '2h 5m'."""
    s = F.floor(c(seconds)).cast("long")
    return (
        F.when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s")))
        .otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit("h "), F.floor(s % 3600 / 60).cast("string"), F.lit("m")))
    )


def timestamp_text(ts: Column | str) -> Column:
    return F.date_format(c(ts), "yyyy-MM-dd HH:mm:ss")
