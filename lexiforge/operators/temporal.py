"""Citations and whether the cited documents are in force on a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import c, first_filled
from ..sources.storage import written


#: Most laws of a registry: it enters plans as one broadcast row of some 20 MB at most.
REGISTRY = 100_000


def bounded(registry: DataFrame, most: int = REGISTRY) -> DataFrame:
    """The registry, after a count. People keep it by hand; more rows than that are no registry and must not be broadcast."""
    if (n := registry.limit(most + 1).count()) > most:
        raise ValueError(f"{n} laws or more: a registry may have {most}")
    return registry


def citations(text: Column | str) -> Column:
    """Distinct cited ids, by kind and then in the order of the text."""
    t = F.coalesce(c(text), F.lit(""))
    return F.array_distinct(F.concat(*[F.regexp_extract_all(t, F.lit(f"(?U){p}"), F.lit(1)) for p, _ in X.CITATIONS]))


def citation_kind(id_: Column) -> Column:
    out = None
    for p, kind in X.CITATIONS:
        hit = id_.rlike(rf"(?U)\A{p}\z")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def law_status(registry: DataFrame, on: str) -> DataFrame:
    """id, name, type, ord, status: active if in force on the date; expired also for what is not in force yet."""
    d = F.to_date(F.lit(on))
    active = (F.col("effective_date") <= d) & (F.col("expiry_date").isNull() | (F.col("expiry_date") > d))
    return bounded(registry).select("id", "name", "type", "ord", F.when(active, "active").otherwise("expired").alias("status"))


def applicable(registry: DataFrame, on: str) -> DataFrame:
    return registry.join(law_status(registry, on).filter("status = 'active'").select("id"), "id", "left_semi")


def _text(df: DataFrame, between: str) -> Column:
    q = first_filled(*[n for n in ("question", "instruction") if n in df.columns])
    a = first_filled(*[n for n in ("answer", "output") if n in df.columns])
    return F.concat(q, F.lit(between), a)


def _status_map(registry: DataFrame, on: str) -> DataFrame:
    """One row with the registry as a map id -> status. A registry is a list of laws that people keep by hand."""
    return law_status(registry, on).groupBy().agg(F.map_from_entries(F.collect_list(F.struct("id", "status"))).alias("_laws"))


def validated(df: DataFrame, registry: DataFrame, on: str, strict: bool = True) -> DataFrame:
    """df with _validation: is_valid, total_citations, active, expired, unknown.

    strict: no expired citation; else some active or no expired one. The registry is one broadcast row, so that pairs
    are neither exploded nor shuffled.
    """
    df = df.withColumn("_cited", citations(_text(df, "\n"))).crossJoin(F.broadcast(_status_map(registry, on)))
    of = lambda s: F.filter("_cited", lambda x: F.coalesce(F.try_element_at(F.col("_laws"), x), F.lit("unknown")) == s)
    df = df.withColumns({"_active": of("active"), "_expired": of("expired"), "_unknown": of("unknown")})
    valid = F.size("_expired") == 0
    if not strict:
        valid = valid | (F.size("_active") > 0)
    detail = F.struct(valid.alias("is_valid"), F.size("_cited").alias("total_citations"), F.col("_active").alias("active"), F.col("_expired").alias("expired"), F.col("_unknown").alias("unknown"))
    return df.withColumn("_validation", detail).drop("_cited", "_laws", "_active", "_expired", "_unknown")


#: Days of a bucket of dates, in which an interval and the dates that it holds meet.
BUCKET_DAYS = 365
#: Citations of one law on one day that a task of a join meets without more ado.
HOT = 100_000


def in_force(asked: DataFrame, registry: DataFrame) -> DataFrame:
    """id, day, n and status of distinct (id, day): active if a version of the law is in force on that day, else expired or unknown.

    An interval join: versions are laid out over the buckets of days that were asked for, and meet them by (id, bucket). Neither
    side is bounded or broadcast as such; a law has as many rows here as different days were asked for.
    """
    span = asked.agg(F.min("day").alias("first"), F.max("day").alias("last"))
    bucket = lambda day: F.floor(F.unix_date(day) / BUCKET_DAYS)
    laid = registry.filter("effective_date is not null").join(F.broadcast(span)).filter((F.col("effective_date") <= F.col("last")) & (F.col("expiry_date").isNull() | (F.col("expiry_date") > F.col("first"))))
    first, last = F.greatest("effective_date", "first"), F.least(F.coalesce("expiry_date", "last"), F.col("last"))
    laid = laid.select("id", "effective_date", "expiry_date", F.explode(F.sequence(bucket(first), bucket(last))).alias("bucket"))
    held = asked.withColumn("bucket", bucket(F.col("day"))).join(laid, ["id", "bucket"]).filter((F.col("effective_date") <= F.col("day")) & (F.col("expiry_date").isNull() | (F.col("expiry_date") > F.col("day"))))
    held = held.select("id", "day").distinct().withColumn("held", F.lit(True))
    known = registry.select("id").distinct().withColumn("known", F.lit(True))
    out = asked.join(held, ["id", "day"], "left").join(known, "id", "left")
    return out.select("id", "day", "n", F.when(F.col("held"), "active").when(F.col("known"), "expired").otherwise("unknown").alias("status"))


def validated_on(df: DataFrame, registry: DataFrame, on: str, key: str, strict: bool = True) -> DataFrame:
    """key and _validation (as of validated) of each row on its own date; key: a column without repeats.

    Texts do not move: each row's citations are laid out, counted by (law, day), looked up once for each such pair and gathered
    again by key. A pair that many rows have is dealt to several tasks. Without a date, citations are unknown.
    """
    cited = df.select(F.col(key).alias("k"), F.to_date(on).alias("day"), citations(_text(df, "\n")).alias("c"))
    cited = written(cited, "cited")
    each = cited.select("k", "day", F.posexplode("c").alias("at", "id"))
    asked = each.filter("day is not null").groupBy("id", "day").agg(F.count("*").alias("n"))
    status = written(in_force(asked, registry), "in-force")
    salts = F.ceil(F.col("n") / HOT).cast("int")
    copies = status.select("id", "day", "status", salts.alias("salts"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    # At most one pair for each HOT citations is hot.
    hot = F.broadcast(status.filter(F.col("n") > HOT).select("id", "day", salts.alias("own")))
    dealt = each.join(hot, ["id", "day"], "left").withColumn("salt", F.pmod(F.xxhash64("k"), F.coalesce("own", F.lit(1))).cast("int")).drop("own")
    found = dealt.join(copies.drop("salts"), ["id", "day", "salt"], "left")
    lists = found.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("at", "id", F.coalesce("status", F.lit("unknown")).alias("status")))).alias("s"))
    whole = cited.select("k").join(lists, "k", "left").withColumn("s", F.coalesce("s", F.array().cast("array<struct<at: int, id: string, status: string>>")))
    of = lambda status: F.transform(F.filter("s", lambda x: x["status"] == status), lambda x: x["id"])
    whole = whole.select("k", F.size("s").alias("total"), *[of(n).alias(n) for n in ("active", "expired", "unknown")])
    valid = F.size("expired") == 0
    if not strict:
        valid = valid | (F.size("active") > 0)
    return whole.select(F.col("k").alias(key), F.struct(valid.alias("is_valid"), F.col("total").alias("total_citations"), "active", "expired", "unknown").alias("_validation"))


def law_status_on(registry: DataFrame, days: DataFrame, on: str) -> DataFrame:
    """day, id, name, type, ord, status of all laws on each different date of a table; days without a date are left out."""
    every = days.select(F.to_date(on).alias("day")).filter("day is not null").distinct()
    active = (F.col("effective_date") <= F.col("day")) & (F.col("expiry_date").isNull() | (F.col("expiry_date") > F.col("day")))
    return every.crossJoin(F.broadcast(bounded(registry))).select("day", "id", "name", "type", "ord", F.when(active, "active").otherwise("expired").alias("status"))


def validity_stats(checked: DataFrame) -> DataFrame:
    v = F.col("_validation.is_valid")
    out = checked.agg(F.count("*").alias("total"), F.count_if(v).alias("valid"), F.count_if(~v).alias("invalid"))
    return out.withColumn("valid_rate", F.col("valid") / F.greatest(F.lit(1), F.col("total")) * 100)


def law_usage(checked: DataFrame) -> DataFrame:
    """law_id, kind, n: active laws of valid pairs and expired laws of invalid ones."""
    v = F.col("_validation")
    used = F.when(v["is_valid"], v["active"]).otherwise(v["expired"])
    kind = F.when(v["is_valid"], "active").otherwise("expired")
    return checked.select(F.explode(used).alias("law_id"), kind.alias("kind")).groupBy("law_id", "kind").agg(F.count("*").alias("n"))


def without_private(df: DataFrame) -> DataFrame:
    return df.drop(*[n for n in df.columns if n.startswith("_")])


def filter_by_validity(df: DataFrame, registry: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid with _invalid_citations): every citation in force or unknown."""
    df = df.withColumn("_cited", citations(_text(df, " "))).crossJoin(F.broadcast(_status_map(registry, on)))
    df = df.withColumn("_invalid_citations", F.array_sort(F.filter("_cited", lambda x: F.try_element_at(F.col("_laws"), x) == "expired"))).drop("_cited", "_laws")
    return df.filter(F.size("_invalid_citations") == 0).drop("_invalid_citations"), df.filter(F.size("_invalid_citations") > 0)


def _names(laws: DataFrame, kind: str, limit: int | None) -> Column:
    rows = F.array_sort(F.collect_list(F.when(F.col("type") == kind, F.struct("ord", "id", "name"))))
    return rows if limit is None else F.slice(rows, 1, limit)


def add_context(df: DataFrame, registry: DataFrame, on: str, first: int | None = 3, applicable_from_answer: bool = True) -> DataFrame:
    """Questions under a header with the date and the laws in force; reference_date and applicable_laws.

    first: at most so many laws in the header (None: all). applicable_laws are the active citations of the answer, or
    with applicable_from_answer=False the header's laws.
    """
    day = F.date_format(F.to_date(F.lit(on)), "dd/MM/yyyy")
    active = law_status(registry, on).filter("status = 'active'")
    one = active.groupBy().agg(F.transform(_names(active, "Luật", first), lambda x: x["id"]).alias("_main"), F.collect_list("id").alias("_all"))
    q = first_filled(*[n for n in ("question", "instruction") if n in df.columns])
    a = first_filled(*[n for n in ("answer", "output") if n in df.columns])
    head = F.concat(F.lit("### Ngày tham chiếu: "), day, F.lit("\n### Văn bản áp dụng: "), F.array_join("_main", ", "), F.lit("\n\n### Câu hỏi:\n"))
    laws = F.filter(citations(a), lambda x: F.array_contains(F.col("_all"), x)) if applicable_from_answer else F.col("_main")
    out = df.crossJoin(F.broadcast(one))
    return out.withColumns({"applicable_laws": laws, "reference_date": F.date_format(F.to_date(F.lit(on)), "yyyy-MM-dd"), "question": F.concat(head, q)}).drop("_main", "_all")


def temporal_prompt(df: DataFrame, registry: DataFrame, on: str, question: str = "question") -> DataFrame:
    """df with prompt: laws (all) and decrees (three) in force, the question, and where the answer goes."""
    active = law_status(registry, on).filter("status = 'active'")
    one = active.groupBy().agg(F.concat(_names(active, "Luật", None), _names(active, "Nghị định", 3)).alias("_l"))
    lines = F.array_join(F.transform("_l", lambda x: F.concat(F.lit("- "), x["id"], F.lit(": "), x["name"])), "\n")
    day = F.date_format(F.to_date(F.lit(on)), "dd/MM/yyyy")
    text = F.concat(F.lit("### Ngày tham chiếu: "), day, F.lit("\n### Văn bản pháp luật đang có hiệu lực:\n"), lines, F.lit("\n\n### Câu hỏi:\n"), F.col(question), F.lit("\n\n### Lưu ý: Trả lời theo văn bản pháp luật đang có hiệu lực tại ngày tham chiếu.\n\n### Trả lời:\n"))
    return df.crossJoin(F.broadcast(one)).withColumn("prompt", text).drop("_l")
