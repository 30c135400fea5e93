"""Document metadata from headers: number, kind, date, issuer, title; and document numbers for answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import SPACE, c, collapsed, let, strip


def header(content: Column | str) -> Column:
    return F.substring(F.coalesce(c(content), F.lit("")), 1, X.HEADER_CHARS)


def _found(text: Column, pattern: str, f) -> Column:
    """f(groups) of the first match ignoring case, null without a match. The text is searched once; the groups are those of the short match."""
    p = f"(?iuU){pattern}"
    return let(F.regexp_extract(text, p, 0), lambda m: F.when(m != "", f(lambda group: F.regexp_extract(m, p, group))))


def header_number(content: Column | str, truncated_decrees: bool = True) -> Column:
    """struct(number, kind) of the first number form that the header has, null without one.

    truncated_decrees: decree numbers that were cut before their ending count and get it appended.
    """
    return let(collapsed(header(content)), lambda t: _number(t, truncated_decrees))


def _number(text: Column, truncated_decrees: bool = True) -> Column:
    forms = []
    for pattern, kind in X.HEADER_NUMBERS:
        if pattern.endswith("NĐ)") and not truncated_decrees:
            continue

        def made(group, kind=kind) -> Column:
            number = F.regexp_replace(group(1), rf"(?U){SPACE}+", "")
            if truncated_decrees and kind == "Nghị định số":
                number = F.when(number.contains("NĐ") & ~number.contains("-CP"), F.replace(number, F.lit("NĐ"), F.lit("NĐ-CP"))).otherwise(number)
            return F.struct(number.alias("number"), F.lit(kind).alias("kind"))

        forms.append(_found(text, pattern, made))
    return F.coalesce(*forms)


def issued_date(content: Column | str) -> Column:
    """DD/MM/YYYY of the first valid date form."""
    return let(collapsed(header(content)), _date)


def _date(text: Column) -> Column:
    def made(group) -> Column:
        d, m, y = (group(k) for k in (1, 2, 3))
        valid = F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(F.concat_ws("-", y, m, d))
        pad = lambda x: F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)
        return F.when((F.length(d) <= 2) & (F.length(m) <= 2) & valid.isNotNull(), F.concat(pad(d), F.lit("/"), pad(m), F.lit("/"), y))

    return F.coalesce(*[_found(text, pattern, made) for pattern in X.DATES])


def issuer(content: Column | str) -> Column:
    return let(collapsed(header(content)), _issuer)


def _issuer(text: Column) -> Column:
    def made(name: str, named: bool):
        return lambda group: F.concat(F.lit(name), strip(group(1))) if named else F.lit(name)

    return F.coalesce(*[_found(text, pattern, made(name, named)) for pattern, name, named in X.ISSUERS])


def title(content: Column | str) -> Column:
    """The line after the first line with a kind of document that is followed by one of more than 10 characters."""
    lines = F.split(header(content), "\n")
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(lines) - 1, F.lit(1))), lambda i: F.struct(F.upper(F.element_at(lines, i)).alias("head"), strip(F.coalesce(F.try_element_at(lines, i + 1), F.lit(""))).alias("next")))
    named = lambda p: F.array_contains(F.transform(F.array(*[F.lit(w) for w in X.TITLE_WORDS]), lambda w: F.contains(p["head"], w)), True)
    hits = F.filter(pairs, lambda p: (F.length(p["next"]) > 10) & named(p))
    return F.when((F.size(lines) > 1) & (F.size(hits) > 0), F.substring(F.element_at(hits, 1)["next"], 1, 200))


def extract_metadata(docs: DataFrame, content: str = "content") -> DataFrame:
    """docs with a metadata struct: doc_number, doc_number_short, doc_type, issued_date, issued_by, title."""

    def fields(number: Column, text: Column) -> Column:
        return F.struct(
            F.when(number.isNotNull(), F.concat_ws(" ", number["kind"], number["number"])).alias("doc_number"),
            number["number"].alias("doc_number_short"),
            number["kind"].alias("doc_type"),
            _date(text).alias("issued_date"),
            _issuer(text).alias("issued_by"),
        )

    found = let(collapsed(header(content)), lambda text: let(_number(text), lambda number: fields(number, text)))
    names = ("doc_number", "doc_number_short", "doc_type", "issued_date", "issued_by")
    meta = docs.select("*", F.inline(F.array(found)).alias(*[f"_{n}" for n in names]))  # a generator: its columns are made once
    return meta.withColumn("metadata", F.struct(*[F.col(f"_{n}").alias(n) for n in names], title(content).alias("title"))).drop(*[f"_{n}" for n in names])


def number_text(content: Column | str) -> Column:
    """'kind number' of a header, or the text for unknown numbers."""
    return let(header_number(content), lambda n: F.when(n.isNotNull(), F.concat_ws(" ", n["kind"], n["number"])).otherwise(X.UNKNOWN_NUMBER))


def split_number_text(text: Column | str) -> Column:
    """struct(number, kind) from 'kind number'."""
    p = rf"(?U)^(.+?){SPACE}+(\d+/.+)$"
    t = c(text)
    return F.when(t.rlike(p), F.struct(strip(F.regexp_extract(t, p, 2)).alias("number"), strip(F.regexp_extract(t, p, 1)).alias("kind")))


def number_from_file(name: Column | str) -> Column:
    """struct(number, kind) from file names such as 11_2025_TT-BNV_663712.txt."""
    n = F.coalesce(c(name), F.lit(""))

    def form(pattern: str, kind: str, *made) -> Column:
        parts = [F.regexp_extract(n, pattern, m) if isinstance(m, int) else F.lit(m) for m in made]
        return F.when(n.rlike(pattern), F.struct(F.concat(*parts).alias("number"), F.lit(kind).alias("kind")))

    return F.coalesce(*[form(pattern, kind, *made) for pattern, kind, made in X.FILE_NUMBERS])
