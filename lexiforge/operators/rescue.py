"""Repair of answers whose citations lack a document number.

The first of fixed.RESCUE_RULES that matches an answer wins. An answer is tested against the alternation of each GROUP of
rules, and against the single rules of its first group only, so that the plan does not grow with the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import count_groups, let, matches
from .metadata import header_number, number_from_file

GROUP = 8

def has_number(answer: Column | str) -> Column:
    a = F.coalesce(F.col(answer) if isinstance(answer, str) else answer, F.lit(""))
    return ~F.lower(a).contains(X.NO_NUMBER) & matches(a, X.RESCUED_NUMBER, "")


def is_invalid(answer: Column | str) -> Column:
    return matches(answer, X.INVALID_CITATION, "U")


def resolve_numbers(qa: DataFrame, docs: DataFrame, source: str = "source_doc") -> DataFrame:
    """qa with doc_info: struct(number, kind, issued_date, issued_by) from metadata, else the content, else the file name.

    docs: file_name, content, metadata (of extract_metadata) and perhaps seq; of several rows with a name the last counts.
    """
    order = F.col("seq") if "seq" in docs.columns else F.lit(0)
    # The content is only looked at where the metadata has no number.
    number = F.when(F.length("metadata.doc_number") > 0, F.lit(None)).otherwise(header_number("content", truncated_decrees=False))
    # Only the fields that are wanted, made once by a generator: not the title, and not again in the aggregate.
    fields = F.struct(*[F.col(f"metadata.{n}").alias(n) for n in ("doc_number", "doc_number_short", "doc_type", "issued_date", "issued_by")], number.alias("n"))
    each = docs.select(F.col("file_name").alias("_f"), order.alias("_o"), F.explode(F.array(fields)).alias("_v"))
    known = each.groupBy("_f").agg(F.max_by("_v", "_o").alias("_d"))
    m, n = F.col("_d"), F.col("_d.n")
    none = F.lit(None).cast("string")
    info = lambda number, kind, date=none, by=none: F.struct(number.alias("number"), kind.alias("kind"), date.alias("issued_date"), by.alias("issued_by"))
    file = number_from_file(source)
    found = F.coalesce(
        F.when(F.length(m["doc_number"]) > 0, info(m["doc_number_short"], m["doc_type"], m["issued_date"], m["issued_by"])),
        F.when(n.isNotNull(), info(n["number"], n["kind"])),
        F.when(file.isNotNull(), info(file["number"], file["kind"])),
    )
    return qa.join(known, F.col(source) == F.col("_f"), "left").withColumn("doc_info", found).drop("_f", "_d")


def _any(rules: list) -> str:
    """One pattern for several rules; most places of a text fail at the first letter."""
    return f"(?U)(?=[{X.RESCUE_LETTERS}])(?:" + "|".join(p for p, *_ in rules) + ")"


def applies(answer: Column | str) -> Column:
    """Whether any rule matches. A predicate on the plain column: filters on it may be pushed below the rewriting."""
    return (F.col(answer) if isinstance(answer, str) else answer).rlike(_any(X.RESCUE_RULES))


def rewritten(df: DataFrame, answer: str = "answer", info: str = "doc_info", to: str = "_new") -> DataFrame:
    """df with `to`: the answer after the first rule that matches it (which always changes it), else null.

    Only the rule that matched is applied, at its first place.
    """
    plain = F.concat_ws(" ", F.col(f"{info}.kind"), F.col(f"{info}.number"))
    full = F.concat(plain, F.coalesce(F.concat(F.lit(" ngày "), F.col(f"{info}.issued_date")), F.lit("")), F.coalesce(F.concat(F.lit(" của "), F.col(f"{info}.issued_by")), F.lit("")))
    every = X.RESCUE_RULES
    patterns = [f"(?U){p}" for p, *_ in every]
    group = F.lit(None).cast("int")
    for at in reversed(range(0, len(every), GROUP)):
        group = F.when(F.col(answer).rlike(_any(every[at : at + GROUP])), at).otherwise(group)
    own = lambda g: F.transform(F.slice(F.array(*map(F.lit, patterns)), g + 1, F.lit(GROUP)), lambda p: F.rlike(F.col(answer), p))
    which = let(F.when(F.col(f"{info}.number").isNotNull(), group), lambda g: F.when(g.isNotNull(), g + F.array_position(own(g), F.lit(True)).cast("int")))
    quoted = lambda t: F.regexp_replace(t, r"([\\\$])", r"\\$1")  # noqa: E731  the replacement gives \ and $ a meaning
    parts = [(f"(?Us)\\A(.*?)(?-s:{p})", "$1" + "$2" * (count_groups(p) > 0) + lead, tail + "$3" * (count_groups(p) > 1), is_full) for p, lead, tail, is_full in every]
    pick = lambda n: F.element_at(F.array(*[F.lit(x[n]) for x in parts]), F.col("_rule"))
    df = df.select("*", F.explode(F.array(which)).alias("_rule"))  # a generator: the rule is found once
    made = F.concat(pick(1), quoted(F.when(pick(3), full).otherwise(plain)), pick(2))
    return df.withColumn(to, F.when(F.col("_rule").isNotNull(), F.regexp_replace(F.col(answer), pick(0), made))).drop("_rule")


def rescue(qa: DataFrame, docs: DataFrame, answer: str = "answer") -> tuple[DataFrame, DataFrame]:
    """(rescued, still bad): rows whose number resolves, whose answer has none and is not made up, and which a rule changes."""
    keep = qa.columns
    known = resolve_numbers(qa, docs)
    ok = F.coalesce(F.col("doc_info.number").isNotNull() & ~has_number(answer) & ~is_invalid(answer) & applies(answer), F.lit(False))
    good = rewritten(known.filter(ok), answer).withColumns({answer: F.col("_new"), "rescued": F.lit(True), "doc_added": F.col("doc_info.number"), "eval_score": F.lit(10.0), "eval_reason": F.concat(F.lit(X.REASON_RESCUED), F.col("doc_info.number"))})
    extra = [c for c in ("rescued", "doc_added", "eval_score", "eval_reason") if c not in keep]
    return good.select(*keep, *extra), known.filter(~ok).select(*keep)


def fix_placeholders(qa: DataFrame, docs: DataFrame, answer: str = "answer") -> DataFrame:
    """Rows whose answer says that there is no number get one where a rule applies, and fixed_by_postprocess."""
    marked = F.lower(F.coalesce(F.col(answer), F.lit(""))).contains(X.NO_NUMBER)
    out = rewritten(resolve_numbers(qa, docs), answer)
    fixed = marked & F.col("doc_info").isNotNull() & F.col("_new").isNotNull()
    return out.withColumn("fixed_by_postprocess", F.coalesce(fixed, F.lit(False))).withColumn(answer, F.when(F.col("fixed_by_postprocess"), F.col("_new")).otherwise(F.col(answer))).drop("_new", "doc_info")


def rescue_stats(rescued: DataFrame, still_bad: DataFrame) -> DataFrame:
    r = rescued.agg(F.count("*").alias("rescued"))
    b = still_bad.agg(F.count("*").alias("still_bad"))
    n = F.col("rescued") + F.col("still_bad")
    return r.crossJoin(b).select(n.alias("processed"), "rescued", "still_bad", (F.col("rescued") / F.greatest(F.lit(1), n)).alias("rescue_rate"))
