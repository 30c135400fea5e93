"""The rule score of question-answer pairs, routing by it, and question filters: one projection each, no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import distinct_chars, first_filled, matches, strip


@dataclass(frozen=True)
class ScoreRules:
    min_score: float = 7.0
    min_question: int = 10
    min_answer: int = 20
    max_answer: int = 5000


def _any(x: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | x.contains(w)
    return out


def rule_flags(df: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """The predicates of the score, as boolean columns; null texts count as empty."""
    q, a = strip(F.coalesce(F.col(question), F.lit(""))), strip(F.coalesce(F.col(answer), F.lit("")))
    df = df.withColumns({"_q": q, "_a": a}).withColumns({"_ql": F.lower("_q"), "_al": F.lower("_a")})
    return df.withColumns(
        {
            "has_number": matches("_a", X.SCORED_NUMBER),
            "has_article": matches("_al", X.ARTICLE, "U"),
            "has_clause": matches("_al", X.CLAUSE, "U"),
            "has_words": _any(F.col("_al"), X.LEGAL_WORDS),
            "has_figure": matches("_a", X.FIGURE, ""),
            "is_vague": matches("_ql", X.VAGUE_QUESTION, "U"),
            "is_personal": _any(F.col("_ql"), X.PERSONAL_WORDS),
            "vague_reference": _any(F.col("_al"), X.VAGUE_REFERENCES),
            "is_odd": (distinct_chars("_q") < 5) | (distinct_chars("_a") < 10),
        }
    )


def rule_score(df: DataFrame, rules: ScoreRules = ScoreRules(), question: str = "question", answer: str = "answer") -> DataFrame:
    """df with eval_score (0 to 10) and eval_reason; other columns stay."""
    keep = df.columns
    f = rule_flags(df, question, answer)
    n, a, g = F.col("has_number"), F.col("has_article"), F.col("has_words")
    # (condition, points, reason); those of one list exclude each other, the first that holds counts.
    basis = [
        (~n & ~a & ~g, -6.0, X.REASON_NOTHING),
        (a & g & ~n, -5.0, X.REASON_ARTICLE_ONLY),
        (g & ~n & ~a, -4.0, X.REASON_WORDS_ONLY),
        (n & ~a, -1.0, X.REASON_NUMBER_ONLY),
        (n & a & F.col("has_clause"), 0.5, None),
    ]
    steps = [
        basis,
        [(~F.col("has_figure") & n, -0.5, X.REASON_NO_FIGURE), (~F.col("has_figure"), -1.0, X.REASON_NO_FIGURE)],
        [(F.length("_q") < rules.min_question, -2.0, X.REASON_SHORT_QUESTION)],
        [(F.length("_a") < rules.min_answer, -3.0, X.REASON_SHORT_ANSWER), (F.length("_a") > rules.max_answer, -1.0, X.REASON_LONG_ANSWER)],
        [(~F.col("_q").endswith("?"), -0.5, X.REASON_NO_MARK)],
        [(F.col("is_vague") & ~F.col("is_personal"), -5.0, X.REASON_VAGUE)],
        [(F.col("_a").contains("...") & (F.length("_a") < 50), -3.0, X.REASON_UNFINISHED)],
        [(F.col("is_odd"), -5.0, X.REASON_ODD)],
        [(F.col("vague_reference") & ~n, -2.0, X.REASON_REFERENCE)],
    ]

    def chosen(cases: list, at: int, otherwise) -> Column:
        out = None
        for case in cases:
            value = F.lit(case[at])
            out = F.when(case[0], value) if out is None else out.when(case[0], value)
        return out.otherwise(F.lit(otherwise))

    score = F.lit(10.0)
    for cases in steps:
        score = score + chosen(cases, 1, 0.0)
    reasons = F.array_compact(F.array(*[chosen(cases, 2, None).cast("string") for cases in steps]))
    good = F.when(n & a, X.REASON_ALL).when(n, X.REASON_NUMBER).otherwise(X.REASON_OK)
    f = f.withColumns({"eval_score": F.greatest(F.lit(0.0), F.least(F.lit(10.0), score)), "_r": reasons})
    return f.select(*[c for c in keep if c not in ("eval_score", "eval_reason")], "eval_score", F.when(F.size("_r") == 0, good).otherwise(F.array_join("_r", "; ")).alias("eval_reason"))


def routed(df: DataFrame, min_score: float = 7.0) -> DataFrame:
    """label: good from min_score on, else bad."""
    return df.withColumn("label", F.when(F.col("eval_score") >= min_score, "good").otherwise("bad"))


def routed_hybrid(df: DataFrame, high: float = 8.0, low: float = 5.0) -> DataFrame:
    """label: good, bad, or borderline for what a model has to judge."""
    return df.withColumn("label", F.when(F.col("eval_score") >= high, "good").when(F.col("eval_score") < low, "bad").otherwise("borderline"))


def low_quality(question: Column | str = "question", answer_alias: str | None = None) -> Column:
    """Whether a question asks about its own text instead of a case."""
    q = F.col(question) if isinstance(question, str) else question
    return matches(F.lower(F.coalesce(q, F.lit(""))), X.LOW_QUALITY_QUESTION, "Ud")


def filter_low_quality(df: DataFrame, question: str = "question") -> tuple[DataFrame, DataFrame]:
    """(kept, removed)."""
    p = low_quality(question)
    return df.filter(~p), df.filter(p)


def keyword_search(df: DataFrame, keyword: str, question: str = "question", answer: str = "answer") -> DataFrame:
    """Rows with the keyword in question or answer, ignoring case; aliases instruction and output count."""
    q = first_filled(*[n for n in (question, "instruction") if n in df.columns])
    a = first_filled(*[n for n in (answer, "output") if n in df.columns])
    k = F.lit(keyword.lower())
    return df.filter(F.lower(q).contains(k) | F.lower(a).contains(k))


def preview(df: DataFrame, rows: int = 20, chars: int = 100, order: str = "seq") -> DataFrame:
    """The first rows with their texts cut."""
    texts = {n: F.substring(F.col(n), 1, chars) for n, t in df.dtypes if t == "string"}
    return df.orderBy(order).limit(rows).withColumns(texts)
