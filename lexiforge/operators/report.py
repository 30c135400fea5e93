"""Reports on question-answer pairs. Each is one aggregate with map-side partial sums; several share a scan where they can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import c, matches, percent_text, rounded, strip
from ..sources.storage import written


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")


def evaluation_stats(labelled: DataFrame) -> DataFrame:
    """total, good, bad, good_rate in percent."""
    out = labelled.agg(F.count("*").alias("total"), F.count_if(F.col("label") == "good").alias("good"), F.count_if(F.col("label") == "bad").alias("bad"))
    return out.withColumn("good_rate", F.col("good") / F.greatest(F.lit(1), F.col("total")) * 100)


def most_common(df: DataFrame, value: Column | str, limit: int, order: str = "seq", to: str = "value") -> DataFrame:
    """value, n: the most frequent values; ties in order of first appearance."""
    out = df.groupBy(c(value).alias(to)).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    return out.orderBy(F.col("n").desc(), "_first").limit(limit).drop("_first")


def by_source(df: DataFrame, limit: int = 20, order: str = "seq") -> DataFrame:
    return most_common(df, F.coalesce(F.col("source_doc"), F.lit("Unknown")), limit, order, "source_doc")


def top_reasons(df: DataFrame, limit: int = 10, order: str = "seq") -> DataFrame:
    return most_common(df, F.coalesce(F.col("eval_reason"), F.lit("N/A")), limit, order, "eval_reason")


def score_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy(F.coalesce(F.col("eval_score"), F.lit(0.0)).cast("int").alias("score")).agg(F.count("*").alias("n"))


def length_stats(df: DataFrame) -> DataFrame:
    """field, min, max, avg of question and answer lengths in code points."""
    return _length_stats(df, F.length(_text(df, "question")), F.length(_text(df, "answer")))


def _length_stats(df: DataFrame, question: Column, answer: Column) -> DataFrame:
    lengths = F.explode(F.create_map(F.lit("question"), question, F.lit("answer"), answer))
    return df.select(lengths.alias("field", "_n")).groupBy("field").agg(F.min("_n").alias("min_length"), F.max("_n").alias("max_length"), F.avg("_n").alias("avg_length"))


def citation_flags(df: DataFrame) -> dict[str, Column]:
    a = _text(df, "answer")
    return {"has_legal_citation": matches(a, r"(Điều|Khoản|Điểm)\s+\d+"), "has_document_number": matches(a, r"\d+/\d{4}/[A-Za-zĐ]+", "")}


def citation_counts(df: DataFrame) -> DataFrame:
    return _counted(df, citation_flags(df))


def _counted(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(p).alias(n) for n, p in flags.items()])


def issue_flags(df: DataFrame) -> dict[str, Column]:
    q, a = _text(df, "question"), _text(df, "answer")
    sq, sa = strip(q), strip(a)
    has_q, has_a = F.length(q) > 0, F.length(a) > 0
    return {
        "empty_question": F.length(sq) == 0,
        "empty_answer": F.length(sa) == 0,
        "truncated": has_a & ~matches(sa, r"[.!?。]\z", ""),
        "encoding_issues": matches(F.concat(q, a), r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]|�", ""),
        "too_short": has_a & (F.length(sa) < 30),
        "too_long": has_a & (F.length(sa) > 2000),
        "missing_punctuation": has_q & ~sq.endswith("?"),
    }


def format_issues(df: DataFrame) -> DataFrame:
    return _counted(df, issue_flags(df))


def format_issue_rows(df: DataFrame, order: str = "seq") -> DataFrame:
    """issue, idx (source:place), length, ending: one row per issue of a pair; order holds places from 0."""
    flags = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in issue_flags(df).items()]))
    a = _text(df, "answer")
    idx = F.concat(F.coalesce(F.col("source_doc"), F.lit("unknown")), F.lit(":"), F.col(order).cast("string"))
    return df.select(F.explode(flags).alias("issue"), idx.alias("idx"), F.length(a).alias("length"), F.when(F.length(a) > 50, F.substring(a, -50, 50)).otherwise(a).alias("ending"))


def quality_summary(labelled: DataFrame) -> DataFrame:
    """high (8 on), medium (7 to 8) among good, low (bad), good_rate, health_score and its band."""
    good, s = F.col("label") == "good", F.coalesce(F.col("eval_score"), F.lit(0.0))
    out = labelled.agg(
        F.count("*").alias("_n"),
        F.count_if(good & (s >= 8)).alias("high_quality"),
        F.count_if(good & (s >= 7) & (s < 8)).alias("medium_quality"),
        F.count_if(F.col("label") == "bad").alias("low_quality"),
        F.count_if(good).alias("_good"),
    )
    health = rounded((F.col("high_quality") + F.col("medium_quality") * 0.7) / F.col("_n") * 100, 1)
    out = out.withColumns({"good_rate": F.col("_good") / F.col("_n") * 100, "health_score": health})
    return out.withColumn("health_band", F.when(F.col("health_score") >= 80, "good").when(F.col("health_score") >= 60, "fair").otherwise("poor")).drop("_n", "_good")


def full_report(labelled: DataFrame, near: DataFrame | None = None, order: str = "seq") -> DataFrame:
    """One row of structs: statistics, format_issues, quality_summary, top lists and (where given) near duplicates.

    Texts are read once, for a table of what the parts need of each pair; the parts are aggregates of that.
    """
    cited, issues = citation_flags(labelled), issue_flags(labelled)
    facts = labelled.select("label", "eval_score", "eval_reason", "source_doc", order, F.length(_text(labelled, "question")).alias("_q"), F.length(_text(labelled, "answer")).alias("_a"), *[p.alias(f"_{n}") for n, p in (cited | issues).items()])
    facts = written(facts, "report")
    flags = lambda names: {n: F.col(f"_{n}") for n in names}
    rows = lambda df, to, by: df.agg(F.transform(F.array_sort(F.collect_list(F.struct(*by))), lambda x: x).alias(to))
    one = lambda df, to: df.select(F.struct(*[F.col(n) for n in df.columns]).alias(to))
    out = one(evaluation_stats(facts), "evaluation")
    parts = [
        one(_counted(facts, flags(cited)), "citations"),
        one(_counted(facts, flags(issues)), "format_issues"),
        one(quality_summary(facts), "quality_summary"),
        rows(by_source(facts, order=order).withColumn("m", -F.col("n")), "by_source", ["m", "source_doc"]),
        rows(score_histogram(facts), "by_score", ["score", "n"]),
        rows(_length_stats(facts, F.col("_q"), F.col("_a")), "lengths", ["field", "min_length", "max_length", "avg_length"]),
        rows(top_reasons(facts, order=order).withColumn("m", -F.col("n")), "top_reasons", ["m", "eval_reason"]),
    ]
    if near is not None:
        parts.append(near.agg(F.count("*").alias("near_duplicates")))
        parts.append(near.orderBy("i", "j").limit(20).agg(F.array_sort(F.collect_list(F.struct("i", "j", "similarity"))).alias("near_duplicate_pairs")))
    for p in parts:  # single rows
        out = out.crossJoin(F.broadcast(p))
    return out


# Checks of a finished dataset.


def check_lengths(df: DataFrame) -> DataFrame:
    q, a = F.length(_text(df, "question")), F.length(_text(df, "answer"))
    return df.agg(
        F.avg(q).alias("avg_question_length"),
        F.avg(a).alias("avg_answer_length"),
        F.min(q).alias("min_question_length"),
        F.max(q).alias("max_question_length"),
        F.min(a).alias("min_answer_length"),
        F.max(a).alias("max_answer_length"),
        F.count_if(q < 15).alias("short_questions"),
        F.count_if(a < 50).alias("short_answers"),
        F.count_if(a > 3000).alias("long_answers"),
    )


def check_citations(df: DataFrame) -> DataFrame:
    """Counts with percents: with_doc_number, with_article, with_clause, with_point, no_citation."""
    a = _text(df, "answer")
    flags = {n: matches(a, p) for n, p in X.CHECKED_CITATIONS.items()}
    none = F.lit(True)
    for p in flags.values():
        none = none & ~p
    out = df.agg(F.count("*").alias("_n"), *[F.count_if(p).alias(n) for n, p in (flags | {"no_citation": none}).items()])
    return out.select(*[percent_text(F.col(n), F.col("_n")).alias(n) for n in [*flags, "no_citation"]])


def check_format(df: DataFrame) -> DataFrame:
    q, a = _text(df, "question"), _text(df, "answer")
    flags = {"no_question_mark": ~strip(q).endswith("?"), "starts_lowercase": matches(q, r"\A\p{Ll}", ""), "has_placeholder": a.contains("...") | a.contains("____") | a.contains("…")}
    out = df.agg(F.count("*").alias("_n"), *[F.count_if(p).alias(n) for n, p in flags.items()])
    return out.select(*[percent_text(F.col(n), F.col("_n")).alias(n) for n in flags])


def check_content(df: DataFrame) -> DataFrame:
    q, a = F.lower(_text(df, "question")), F.lower(_text(df, "answer"))
    vague = matches(a, X.VAGUE_ANSWER, "d")
    generic = matches(q, X.GENERIC_QUESTION, "")
    out = df.agg(F.count("*").alias("_n"), F.count_if(vague).alias("vague_answers"), F.count_if(generic).alias("generic_questions"))
    return out.select(*[percent_text(F.col(n), F.col("_n")).alias(n) for n in ("vague_answers", "generic_questions")])


def document_counts(df: DataFrame, order: str = "seq") -> DataFrame:
    return df.groupBy(F.coalesce(F.col("source_doc"), F.lit("unknown")).alias("source_doc")).agg(F.count("*").alias("n"), F.min(order).alias("_first"))


def distribution(df: DataFrame, ends: int = 5, order: str = "seq") -> DataFrame:
    """part (top or bottom), source_doc, n: the documents with most and fewest pairs; ties by first appearance."""
    counts = document_counts(df, order)
    top = counts.orderBy(F.col("n").desc(), "_first").limit(ends).withColumn("part", F.lit("top"))
    low = counts.orderBy("n", F.col("_first").desc()).limit(ends).withColumn("part", F.lit("bottom"))
    return top.unionByName(low).select("part", "source_doc", "n")


def distribution_totals(df: DataFrame, order: str = "seq") -> DataFrame:
    return document_counts(df, order).agg(F.count("*").alias("total_documents"), F.avg("n").alias("avg_qa_per_doc"), F.max("n").alias("max_qa"), F.min("n").alias("min_qa"))


def dataset_issues(df: DataFrame) -> DataFrame:
    """duplicate_questions, short_answers, no_citation and whether each is an issue."""
    from ..functions.text import question_key

    dup = df.groupBy(question_key("question").alias("k")).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_questions"))
    a = _text(df, "answer")
    found = matches(a, "|".join(X.CHECKED_CITATIONS.values()))
    rest = df.agg(F.count("*").alias("_n"), F.count_if(F.length(a) < 50).alias("short_answers"), F.count_if(~found).alias("no_citation"))
    out = dup.crossJoin(F.broadcast(rest))
    return out.select("duplicate_questions", "short_answers", "no_citation", ((F.col("duplicate_questions") > 0) | (F.col("short_answers") > 0) | (F.col("no_citation") > F.col("_n") * 0.1)).alias("has_issues"))


# Run statistics.


def pipeline_summary(labelled: DataFrame) -> DataFrame:
    out = labelled.agg(F.count("*").alias("qa_total"), F.count_if(F.col("label") == "good").alias("qa_good"))
    return out.withColumn("success_rate", F.col("qa_good") / F.greatest(F.lit(1), F.col("qa_total")) * 100)


def file_metrics(docs: DataFrame, qa: DataFrame, content: str = "content", chars_a_chunk: int = 3800) -> DataFrame:
    """chunks_total (estimated from lengths) and chunks_processed (distinct chunk keys of pairs)."""
    total = docs.agg(F.sum(F.greatest(F.lit(1), F.floor(F.length(F.coalesce(F.col(content), F.lit(""))) / chars_a_chunk))).alias("chunks_total"))
    done = qa.agg(F.countDistinct(F.struct("source_doc", "chunk_id")).alias("chunks_processed"), F.count("*").alias("qa_generated"))
    return total.crossJoin(F.broadcast(done))


def event_stats(events: DataFrame, total: int | None = None) -> DataFrame:
    """events: ts, success, duration, qa_count, from_cache -> counters and rates in percent."""
    ok, hit = F.col("success"), F.col("from_cache")
    out = events.agg(F.count("*").alias("processed"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"), F.sum("qa_count").alias("qa_generated"), F.count_if(hit).alias("cache_hits"), F.count_if(~hit).alias("cache_misses"), F.avg("duration").alias("avg_duration"))
    rate = F.when(F.col("cache_hits") + F.col("cache_misses") > 0, F.col("cache_hits") / (F.col("cache_hits") + F.col("cache_misses")) * 100).otherwise(0.0)
    out = out.withColumn("hit_rate", rate)
    return out if total is None else out.withColumn("progress_percent", F.col("processed") / F.greatest(F.lit(1), F.lit(total)) * 100)


def recent_rate(events: DataFrame, now: str, seconds: int = 60) -> DataFrame:
    """Events a minute: those of the last `seconds` by the time since the first of them; 0 for fewer than two events."""
    age = F.lit(now).cast("timestamp").cast("double") - F.col("ts").cast("timestamp").cast("double")
    recent = (age < seconds) & (age >= 0)
    out = events.agg(F.count_if(age >= 0).alias("_n"), F.count_if(recent).alias("recent"), F.max(F.when(recent, age)).alias("span"))
    return out.select("recent", F.when((F.col("_n") >= 2) & (F.col("span") > 0), F.col("recent") / (F.col("span") / 60)).otherwise(0.0).alias("rate"))


def remaining_text(remaining: Column | str, rate: Column | str) -> Column:
    """'~45 giây', '~12 phút', '~2.5 giờ' or 'N/A'."""
    m = c(remaining) / c(rate)
    text = F.when(m < 1, F.concat(F.lit("~"), F.floor(m * 60).cast("string"), F.lit(" giây"))).when(m < 60, F.concat(F.lit("~"), F.floor(m).cast("string"), F.lit(" phút"))).otherwise(F.concat(F.lit("~"), F.format_string("%.1f", F.bround(m / 60, 1)), F.lit(" giờ")))
    return F.when((c(rate) > 0) & (c(remaining) > 0), text).otherwise("N/A")


def error_summary(errors: DataFrame) -> DataFrame:
    """category, severity, n, critical."""
    return errors.groupBy("category", "severity").agg(F.count("*").alias("n")).withColumn("critical", F.col("severity") == "critical")


def recent_errors(errors: DataFrame, limit: int = 50) -> DataFrame:
    return errors.withColumn("message", F.substring("message", 1, 200)).orderBy(F.col("ts").desc()).limit(limit)


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The last status of each sample."""
    return reviews.groupBy("sample_idx").agg(F.max_by(F.struct("status", "note"), "ts").alias("r")).select("sample_idx", "r.status", "r.note")


def review_stats(reviews: DataFrame) -> DataFrame:
    """Decisions by status; a sample that was reviewed again counts each time."""
    return reviews.groupBy("status").agg(F.count("*").alias("n"))


def review_export(samples: DataFrame, reviews: DataFrame, order: str = "seq") -> DataFrame:
    """Reviewed samples with review_status and review_note."""
    r = latest_reviews(reviews).select("sample_idx", F.col("status").alias("review_status"), F.col("note").alias("review_note"))
    return samples.join(r, samples[order] == r["sample_idx"]).drop("sample_idx")
