"""The queries of the curation engine over the driver's tables, each with DuckDB SQL where SQL can express it.

Pairs are derived from `documents` by the expressions in QA, which both engines read: eight kinds of answers, each before a
whole text, and four kinds of questions make every branch of the rules occur. A question is a document's first sentence or
line, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed as X
from .functions import text as T
from .operators import chunk, dedup, export, generate, metadata, parse, regenerate, report, rescue, score, split, temporal, tokenize
from .plans import monitor
from .sources import logtable, storage
from .streaming import events as stream
from .streaming.generation import Generation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
DAY = "2025-12-01"
RULES = score.ScoreRules(min_score=6.0, min_answer=100)

QA = [
    "doc_id AS seq",
    "'d' || CAST(doc_id % 40 AS VARCHAR(20)) AS source_doc",
    "CAST(doc_id % 7 AS INT) AS chunk_id",
    "CASE doc_id % 11 WHEN 3 THEN 'Thông tư này quy định ' WHEN 5 THEN 'Văn bản này là gì ' WHEN 7 THEN 'Tôi muốn biết Nghị định này áp dụng ' ELSE '' END || regexp_extract(text, '^[^.!?\\n]*', 0) || CASE doc_id % 5 WHEN 0 THEN '' ELSE '?' END AS question",
    "CASE doc_id % 8 WHEN 0 THEN 'Căn cứ Điều 12, Khoản 3 Luật số 41/2024/QH15, mức hưởng là 75%. ' WHEN 1 THEN 'Theo Nghị định số 158/2025/NĐ-CP thì thời hạn là 30 ngày. ' WHEN 2 THEN 'Căn cứ Điều 21, Khoản 2 Thông tư này, mức đóng là 8%. ' WHEN 3 THEN 'Theo quy định tại văn bản hiện hành, người lao động được hưởng. ' WHEN 4 THEN 'Điều 5 nêu rõ trợ cấp 2 triệu đồng. ' WHEN 5 THEN '' WHEN 6 THEN 'Theo Điều 7 của văn bản không có số hiệu, mức hưởng là 60%. ' ELSE 'Căn cứ Điều 9: trợ cấp 3 tháng lương theo 58/2014/QH13 và Thông tư 59/2015/TT-BLDTBXH. ' END || text AS answer",
]
LAWS = [
    ("41/2024/QH15", "Bảo hiểm xã hội", "Luật", "2025-07-01", None),
    ("58/2014/QH13", "Bảo hiểm xã hội cũ", "Luật", "2016-01-01", "2025-07-01"),
    ("158/2025/NĐ-CP", "Bảo hiểm bắt buộc", "Nghị định", "2025-07-01", None),
    ("74/2025/QH15", "Việc làm", "Luật", "2027-01-01", None),
    ("59/2015/TT-BLDTBXH", "Hướng dẫn", "Thông tư", "2016-02-15", "2025-12-01"),
]
HEADERS = "CASE doc_id % 6 WHEN 0 THEN 'Luật số: 41/2024/QH15' WHEN 1 THEN 'Số: 143/2018/NĐ - CP' WHEN 2 THEN 'Số: 12/2025/TT-BNV' WHEN 3 THEN 'Số: 2222/QĐ-BHXH' WHEN 4 THEN 'Số: 143/2018/NĐ' ELSE 'Không số' END || chr(10) || CASE doc_id % 4 WHEN 0 THEN 'Hà Nội, ngày 5 tháng 7 năm 2025' WHEN 1 THEN 'ngày 31 tháng 2 năm 2024' WHEN 2 THEN 'ngày 12 tháng 11 năm 2018' ELSE '' END || chr(10) || CASE doc_id % 3 WHEN 0 THEN 'Chính phủ ban hành' WHEN 1 THEN 'Bộ Y Te ban hành' ELSE '' END || chr(10) || 'THÔNG TƯ' || chr(10) || text"

QA_SQL = f"qa AS (SELECT {', '.join(QA)} FROM documents)"
LAWS_SQL = "laws AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, '{i}', '{n}', '{t}', DATE '{e}', {f'DATE {x!r}' if x else 'NULL::DATE'})" for k, (i, n, t, e, x) in enumerate(LAWS)) + ") v(ord, id, name, type, effective_date, expiry_date))"


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr(*QA)


def scored(spark: SparkSession, d: str) -> DataFrame:
    return score.rule_score(qa(spark, d), RULES)


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return score.routed(scored(spark, d), RULES.min_score)


def registry(spark: SparkSession) -> DataFrame:
    rows = [(k, *law) for k, law in enumerate(LAWS)]
    return spark.createDataFrame(rows, "ord int, id string, name string, type string, effective_date string, expiry_date string").withColumns({n: F.to_date(n) for n in ("effective_date", "expiry_date")})


def headed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr("doc_id AS seq", "'d' || CAST(doc_id % 40 AS VARCHAR(20)) AS file_name", f"{HEADERS} AS content")


# SQL pieces.
def sq(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def hit(column: str, pattern: str, flags: str = "i") -> str:
    return f"regexp_matches({column}, {sq((f'(?{flags})' if flags else '') + pattern)})"


def any_of(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {sq(w)})" for w in words) + ")"


STRIP = "regexp_replace({0}, '^[\\s\\x0b\\x1c-\\x1f]+|[\\s\\x0b\\x1c-\\x1f]+$', '', 'g')"
FLAGS_SQL = f"""
t AS (SELECT *, {STRIP.format('question')} AS sq, {STRIP.format('answer')} AS sa FROM qa),
l AS (SELECT *, lower(sq) AS ql, lower(sa) AS al FROM t),
f AS (SELECT *, {hit('sa', X.SCORED_NUMBER)} AS n, {hit('al', X.ARTICLE, '')} AS a, {hit('al', X.CLAUSE, '')} AS c, {any_of('al', X.LEGAL_WORDS)} AS g, {hit('sa', X.FIGURE, '')} AS fig,
  {hit('ql', X.VAGUE_QUESTION, '')} AS vague, {any_of('ql', X.PERSONAL_WORDS)} AS pers, {any_of('al', X.VAGUE_REFERENCES)} AS vref,
  (len(list_distinct(string_split(sq, ''))) < 5 OR len(list_distinct(string_split(sa, ''))) < 10) AS odd FROM l)"""
SCORED_SQL = (
    FLAGS_SQL
    + f""",
p AS (SELECT *, greatest(0.0, least(10.0, 10.0
  + CASE WHEN NOT n AND NOT a AND NOT g THEN -6.0 WHEN a AND g AND NOT n THEN -5.0 WHEN g AND NOT n AND NOT a THEN -4.0 WHEN n AND NOT a THEN -1.0 WHEN n AND a AND c THEN 0.5 ELSE 0 END
  + CASE WHEN fig THEN 0 WHEN n THEN -0.5 ELSE -1.0 END + CASE WHEN length(sq) < 10 THEN -2.0 ELSE 0 END
  + CASE WHEN length(sa) < 100 THEN -3.0 WHEN length(sa) > 5000 THEN -1.0 ELSE 0 END + CASE WHEN suffix(sq, '?') THEN 0 ELSE -0.5 END
  + CASE WHEN vague AND NOT pers THEN -5.0 ELSE 0 END + CASE WHEN contains(sa, '...') AND length(sa) < 50 THEN -3.0 ELSE 0 END
  + CASE WHEN odd THEN -5.0 ELSE 0 END + CASE WHEN vref AND NOT n THEN -2.0 ELSE 0 END))::DOUBLE AS eval_score,
  list_filter([CASE WHEN NOT n AND NOT a AND NOT g THEN {sq(X.REASON_NOTHING)} WHEN a AND g AND NOT n THEN {sq(X.REASON_ARTICLE_ONLY)} WHEN g AND NOT n AND NOT a THEN {sq(X.REASON_WORDS_ONLY)} WHEN n AND NOT a THEN {sq(X.REASON_NUMBER_ONLY)} END,
    CASE WHEN NOT fig THEN {sq(X.REASON_NO_FIGURE)} END, CASE WHEN length(sq) < 10 THEN {sq(X.REASON_SHORT_QUESTION)} END,
    CASE WHEN length(sa) < 100 THEN {sq(X.REASON_SHORT_ANSWER)} WHEN length(sa) > 5000 THEN {sq(X.REASON_LONG_ANSWER)} END,
    CASE WHEN NOT suffix(sq, '?') THEN {sq(X.REASON_NO_MARK)} END, CASE WHEN vague AND NOT pers THEN {sq(X.REASON_VAGUE)} END,
    CASE WHEN contains(sa, '...') AND length(sa) < 50 THEN {sq(X.REASON_UNFINISHED)} END, CASE WHEN odd THEN {sq(X.REASON_ODD)} END,
    CASE WHEN vref AND NOT n THEN {sq(X.REASON_REFERENCE)} END], lambda x: x IS NOT NULL) AS rs FROM f),
s AS (SELECT seq, source_doc, chunk_id, question, answer, eval_score, CASE WHEN len(rs) > 0 THEN array_to_string(rs, '; ') WHEN n AND a THEN {sq(X.REASON_ALL)} WHEN n THEN {sq(X.REASON_NUMBER)} ELSE {sq(X.REASON_OK)} END AS eval_reason FROM p)"""
)
LABELLED_SQL = SCORED_SQL + ", e AS (SELECT *, CASE WHEN eval_score >= 6 THEN 'good' ELSE 'bad' END AS label FROM s)"
W = "WITH " + QA_SQL + ", "


# Scoring and filters.
@query("rule_flags", W + FLAGS_SQL.strip() + " SELECT seq, n AS has_number, a AS has_article, c AS has_clause, g AS has_words, fig AS has_figure, vague AS is_vague, pers AS is_personal, vref AS vague_reference, odd AS is_odd FROM f")
def _(spark, d):
    return score.rule_flags(qa(spark, d)).select("seq", "has_number", "has_article", "has_clause", "has_words", "has_figure", "is_vague", "is_personal", "vague_reference", "is_odd")


@query("rule_score", W + SCORED_SQL.strip() + " SELECT seq, eval_score, eval_reason FROM s")
def _(spark, d):
    return scored(spark, d).select("seq", "eval_score", "eval_reason")


@query("route_good_bad", W + LABELLED_SQL.strip() + " SELECT seq, eval_score, label FROM e")
def _(spark, d):
    return labelled(spark, d).select("seq", "eval_score", "label")


@query("route_hybrid", W + SCORED_SQL.strip() + " SELECT seq, CASE WHEN eval_score >= 8 THEN 'good' WHEN eval_score < 5 THEN 'bad' ELSE 'borderline' END AS label FROM s")
def _(spark, d):
    return score.routed_hybrid(scored(spark, d)).select("seq", "label")


LOW = hit("lower(question)", X.LOW_QUALITY_QUESTION, "")


@query("low_quality_filter", f"WITH {QA_SQL} SELECT seq, question, CASE WHEN {LOW} THEN 'removed' ELSE 'kept' END AS part FROM qa")
def _(spark, d):
    kept, removed = score.filter_low_quality(qa(spark, d))
    return kept.withColumn("part", F.lit("kept")).unionByName(removed.withColumn("part", F.lit("removed"))).select("seq", "question", "part")


@query("keyword_search", f"WITH {QA_SQL} SELECT seq FROM qa WHERE contains(lower(question), 'nghị định') OR contains(lower(answer), 'nghị định')")
def _(spark, d):
    return score.keyword_search(qa(spark, d), "Nghị Định").select("seq")


@query("bad_sample_preview", W + LABELLED_SQL.strip() + " SELECT seq, substring(question, 1, 100) AS question, substring(answer, 1, 100) AS answer, eval_score FROM e WHERE label = 'bad' ORDER BY seq LIMIT 20")
def _(spark, d):
    return score.preview(labelled(spark, d).filter("label = 'bad'").select("seq", "question", "answer", "eval_score"))


@query("label_agreement", W + LABELLED_SQL.strip() + " SELECT label, quality, count(*) AS n FROM e JOIN labels ON seq = doc_id GROUP BY ALL")
def _(spark, d):
    return labelled(spark, d).join(table(spark, d, "labels"), F.col("seq") == F.col("doc_id")).groupBy("label", "quality").agg(F.count("*").alias("n"))


# Text functions.
NORM = "regexp_replace(" + STRIP.format("lower(question)") + ", '[\\s\\x0b\\x1c-\\x1f]+', ' ', 'g')"


@query("normalize_hash", f"WITH {QA_SQL} SELECT seq, {NORM} AS normalized, substring(md5({NORM}), 1, 12) AS hash12 FROM qa")
def _(spark, d):
    q = qa(spark, d)
    return q.select("seq", T.normalized("question").alias("normalized"), T.short_md5(T.normalized("question")).alias("hash12"))


@query("cache_key", "SELECT doc_id, substring(sha256(coalesce(text, '') || '|' || substring('Tạo {num_qa} câu hỏi', 1, 100) || '|' || 'm1'), 1, 16) AS cache_key, substring(md5(coalesce(text, '')), 1, 8) AS content_hash FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", T.cache_key("text", F.lit("Tạo {num_qa} câu hỏi"), F.lit("m1")).alias("cache_key"), F.substring(F.md5(F.coalesce("text", F.lit(""))), 1, 8).alias("content_hash"))


@query("word_char_counts", "SELECT doc_id, length(coalesce(text, '')) AS char_count, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\s\\x0b\\x1c-\\x1f]+'), lambda x: x <> ''))::INTEGER AS word_count, len(list_filter(list_distinct(string_split(coalesce(text, ''), '')), lambda x: x <> ''))::INTEGER AS distinct_chars FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("char_count"), T.word_count("text").alias("word_count"), T.distinct_chars("text").alias("distinct_chars"))


@query("duration_text", "SELECT event_id, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE (s // 3600) || 'h ' || (s % 3600 // 60) || 'm' END AS duration, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM (SELECT event_id, ts, event_id * 7 % 20000 AS s FROM events)")
def _(spark, d):
    return table(spark, d, "events").select("event_id", T.duration_text(F.col("event_id") * 7 % 20000).alias("duration"), T.timestamp_text("ts").alias("at"))


# Duplicates.
@query("dedup_question_hash", f"WITH {QA_SQL}, h AS (SELECT seq, substring(md5({NORM}), 1, 12) AS question_hash FROM qa) SELECT min(seq) AS seq, question_hash FROM h GROUP BY question_hash")
def _(spark, d):
    return dedup.dedup_question_hash(qa(spark, d)).select("seq", "question_hash")


FOLD_SQL = f"""
WITH RECURSIVE {QA_SQL},
k AS (SELECT *, row_number() OVER (ORDER BY seq) AS i, md5(lower({STRIP.format('question')})) AS q, md5(lower({STRIP.format('answer')})) AS a, length(answer) AS n FROM qa),
r AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS qs, []::VARCHAR[] AS ans, []::BIGINT[] AS os
  UNION ALL SELECT k.i, CASE WHEN list_contains(qs, q) OR list_contains(ans, a) THEN qs ELSE list_append(qs, q) END,
    CASE WHEN list_contains(qs, q) OR list_contains(ans, a) THEN ans ELSE list_append(ans, a) END,
    CASE WHEN list_contains(qs, q) OR list_contains(ans, a) THEN os ELSE list_append(os, seq) END FROM r JOIN k ON k.i = r.i + 1),
o AS (SELECT unnest(os) AS opener FROM (SELECT os FROM r ORDER BY i DESC LIMIT 1)),
w AS (SELECT q, opener FROM o JOIN k ON seq = opener),
b AS (SELECT k.q, w.opener, arg_min(seq, (-n, seq)) AS best FROM k JOIN w USING (q) WHERE seq >= w.opener GROUP BY ALL)
SELECT k.seq, w.opener, coalesce(k.seq = b.best, false) AS kept FROM k LEFT JOIN w USING (q) LEFT JOIN b USING (q)
"""


@query("dedup_qa_fold", FOLD_SQL)
def _(spark, d):
    return dedup.fold_pairs(qa(spark, d)).select("seq", "opener", "kept")


@query(
    "duplicate_groups",
    f"WITH {QA_SQL}, q AS (SELECT lower({STRIP.format('question')}) AS key, count(*) AS n FROM qa GROUP BY 1 HAVING count(*) > 1), a AS (SELECT lower({STRIP.format('answer')}) AS k, count(*) AS n FROM qa GROUP BY 1 HAVING count(*) > 1) SELECT 'question' AS kind, key, n FROM q UNION ALL SELECT 'answer', substring(k, 1, 100), max(n) FROM a GROUP BY 2",
)
def _(spark, d):
    return dedup.duplicate_groups(qa(spark, d))


@query(
    "near_dup_pairs",
    f"""WITH {QA_SQL}, t AS MATERIALIZED (SELECT count(*) OVER (ORDER BY seq ROWS UNBOUNDED PRECEDING) - 1 AS i, lower({STRIP.format('question')}) AS s FROM qa),
g AS (SELECT i, CASE WHEN length(s) < 3 THEN [] ELSE list_distinct(list_transform(range(1, length(s) - 1), lambda k: substring(s, k, 3))) END AS g FROM t),
p AS (SELECT a.i, b.i AS j, len(list_intersect(a.g, b.g)) AS n, len(a.g) + len(b.g) AS m FROM g a JOIN g b ON b.i > a.i AND b.i < a.i + 100)
SELECT i, j, round_even(n / greatest(m - n, 1), 3) AS similarity FROM p WHERE n / greatest(m - n, 1) >= 0.8 AND n / greatest(m - n, 1) < 1""",
)
def _(spark, d):
    return dedup.near_pairs(qa(spark, d), limit=None)


# Reports.
def report_query(name: str, f, sql: str):
    query(name, W + LABELLED_SQL.strip() + " " + sql)(lambda spark, d: f(labelled(spark, d)))


report_query("eval_stats", report.evaluation_stats, "SELECT count(*) AS total, count(*) FILTER (label = 'good') AS good, count(*) FILTER (label = 'bad') AS bad, count(*) FILTER (label = 'good') / greatest(1, count(*)) * 100 AS good_rate FROM e")
report_query("score_histogram", report.score_histogram, "SELECT trunc(eval_score)::INTEGER AS score, count(*) AS n FROM e GROUP BY 1")
report_query("source_top20", report.by_source, "SELECT source_doc, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 20")
report_query("top_reasons", report.top_reasons, "SELECT eval_reason, count(*) AS n FROM e GROUP BY 1 ORDER BY n DESC, min(seq) LIMIT 10")
report_query("length_stats", report.length_stats, "SELECT 'question' AS field, min(length(question)) AS min_length, max(length(question)) AS max_length, avg(length(question)) AS avg_length FROM e UNION ALL SELECT 'answer', min(length(answer)), max(length(answer)), avg(length(answer)) FROM e")
report_query("citation_counts", report.citation_counts, f"SELECT count(*) FILTER ({hit('answer', '(Điều|Khoản|Điểm)' + chr(92) + 's+' + chr(92) + 'd+')}) AS has_legal_citation, count(*) FILTER ({hit('answer', chr(92) + 'd+/' + chr(92) + 'd{4}/[A-Za-zĐ]+', '')}) AS has_document_number FROM e")
SQ, SA = STRIP.format("question"), STRIP.format("answer")
report_query(
    "format_issues",
    report.format_issues,
    f"SELECT count(*) FILTER ({SQ} = '') AS empty_question, count(*) FILTER ({SA} = '') AS empty_answer, count(*) FILTER (answer <> '' AND NOT regexp_matches({SA}, '[.!?。]$')) AS truncated, count(*) FILTER (regexp_matches(question || answer, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]|�')) AS encoding_issues, count(*) FILTER (answer <> '' AND length({SA}) < 30) AS too_short, count(*) FILTER (answer <> '' AND length({SA}) > 2000) AS too_long, count(*) FILTER (question <> '' AND NOT suffix({SQ}, '?')) AS missing_punctuation FROM e",
)
report_query(
    "quality_summary",
    report.quality_summary,
    "SELECT *, CASE WHEN health_score >= 80 THEN 'good' WHEN health_score >= 60 THEN 'fair' ELSE 'poor' END AS health_band FROM (SELECT count(*) FILTER (label = 'good' AND eval_score >= 8) AS high_quality, count(*) FILTER (label = 'good' AND eval_score >= 7 AND eval_score < 8) AS medium_quality, count(*) FILTER (label = 'bad') AS low_quality, count(*) FILTER (label = 'good') / count(*) * 100 AS good_rate, round_even((count(*) FILTER (label = 'good' AND eval_score >= 8) + count(*) FILTER (label = 'good' AND eval_score >= 7 AND eval_score < 8) * 0.7::DOUBLE) / count(*) * 100, 1) AS health_score FROM e)",
)
report_query("check_lengths", report.check_lengths, "SELECT avg(length(question)) AS avg_question_length, avg(length(answer)) AS avg_answer_length, min(length(question)) AS min_question_length, max(length(question)) AS max_question_length, min(length(answer)) AS min_answer_length, max(length(answer)) AS max_answer_length, count(*) FILTER (length(question) < 15) AS short_questions, count(*) FILTER (length(answer) < 50) AS short_answers, count(*) FILTER (length(answer) > 3000) AS long_answers FROM e")


def pct(condition: str, name: str) -> str:
    return f"count(*) FILTER ({condition}) || ' (' || printf('%.1f', round_even(count(*) FILTER ({condition}) / count(*) * 100, 1)) || '%)' AS {name}"


CITED = X.CHECKED_CITATIONS
report_query("check_citations", report.check_citations, "SELECT " + ", ".join(pct(hit("answer", p), n) for n, p in CITED.items()) + ", " + pct("NOT (" + " OR ".join(hit("answer", p) for p in CITED.values()) + ")", "no_citation") + " FROM e")
report_query("check_format", report.check_format, "SELECT " + pct(f"NOT suffix({SQ}, '?')", "no_question_mark") + ", " + pct("regexp_matches(question, '^\\p{Ll}')", "starts_lowercase") + ", " + pct("contains(answer, '...') OR contains(answer, '____') OR contains(answer, '…')", "has_placeholder") + " FROM e")
report_query("check_content", report.check_content, "SELECT " + pct(hit("lower(answer)", X.VAGUE_ANSWER, ""), "vague_answers") + ", " + pct(hit("lower(question)", X.GENERIC_QUESTION, ""), "generic_questions") + " FROM e")
report_query("doc_distribution_ends", report.distribution, "SELECT 'top' AS part, source_doc, n FROM (SELECT source_doc, count(*) AS n, min(seq) AS f FROM e GROUP BY 1 ORDER BY n DESC, f LIMIT 5) UNION ALL SELECT 'bottom', source_doc, n FROM (SELECT source_doc, count(*) AS n, min(seq) AS f FROM e GROUP BY 1 ORDER BY n, f DESC LIMIT 5)")
report_query("doc_distribution_totals", report.distribution_totals, "SELECT count(*) AS total_documents, avg(n) AS avg_qa_per_doc, max(n) AS max_qa, min(n) AS min_qa FROM (SELECT count(*) AS n FROM e GROUP BY source_doc)")
report_query(
    "dataset_issues",
    report.dataset_issues,
    f", k AS (SELECT count(*) AS n FROM e GROUP BY lower({SQ})), x AS (SELECT (SELECT count(*) FROM k WHERE n > 1) AS duplicate_questions, count(*) FILTER (length(answer) < 50) AS short_answers, count(*) FILTER (NOT ({' OR '.join(hit('answer', p) for p in CITED.values())})) AS no_citation, count(*) AS n FROM e) SELECT duplicate_questions, short_answers, no_citation, duplicate_questions > 0 OR short_answers > 0 OR no_citation > n * 0.1 AS has_issues FROM x",
)
report_query("pipeline_summary", report.pipeline_summary, "SELECT count(*) AS qa_total, count(*) FILTER (label = 'good') AS qa_good, count(*) FILTER (label = 'good') / greatest(1, count(*)) * 100 AS success_rate FROM e")


@query(
    "full_report",
    SQL["near_dup_pairs"].replace("SELECT i, j, round_even", "SELECT * FROM (SELECT count(*) AS near_duplicates FROM (SELECT i, j, round_even", 1)
    + ")) nd, (SELECT * FROM ("
    + SQL["eval_stats"]
    + ") s, ("
    + SQL["citation_counts"]
    + ") c, ("
    + SQL["format_issues"]
    + ") f, ("
    + SQL["quality_summary"].replace("SELECT *, CASE WHEN health", "SELECT * EXCLUDE (good_rate), CASE WHEN health", 1)
    + ") q)",
)
def _(spark, d):
    out = report.full_report(labelled(spark, d), dedup.near_pairs(qa(spark, d)))
    return out.select("near_duplicates", "evaluation.*", "citations.*", "format_issues.*", *[f"quality_summary.{n}" for n in ("high_quality", "medium_quality", "low_quality", "health_score", "health_band")])


def _listed_sql(name: str, row: str, order: str) -> str:
    return f"(SELECT string_agg({row}, ';' ORDER BY {order}) FROM ({SQL[name]}))"


@query(
    "full_report_lists",
    f"""SELECT {_listed_sql('source_top20', "n || '|' || source_doc", 'n DESC, source_doc')} AS by_source, {_listed_sql('score_histogram', "score || '|' || n", 'score')} AS by_score,
    {_listed_sql('length_stats', "field || '|' || min_length || '|' || max_length || '|' || floor(avg_length)::BIGINT", 'field')} AS lengths, {_listed_sql('top_reasons', "n || '|' || eval_reason", 'n DESC, eval_reason')} AS top_reasons,
    (SELECT string_agg(i || '|' || j, ';' ORDER BY i, j) FROM (SELECT i, j FROM ({SQL['near_dup_pairs']}) ORDER BY i, j LIMIT 20)) AS near_duplicate_pairs""",
)
def _(spark, d):
    """The other parts of full_report: its lists, each as one text."""
    out = report.full_report(labelled(spark, d), dedup.near_pairs(qa(spark, d)))
    text = lambda n, *f: F.array_join(F.transform(n, lambda x: F.concat_ws("|", *[g(x).cast("string") for g in f])), ";").alias(n)
    field = lambda n: lambda x: x[n]
    lengths = (field("field"), field("min_length"), field("max_length"), lambda x: F.floor(x["avg_length"]))
    return out.select(text("by_source", lambda x: -x["m"], field("source_doc")), text("by_score", field("score"), field("n")), text("lengths", *lengths), text("top_reasons", lambda x: -x["m"], field("eval_reason")), text("near_duplicate_pairs", field("i"), field("j")))


ISSUES = {
    "empty_question": f"{SQ} = ''",
    "empty_answer": f"{SA} = ''",
    "truncated": f"answer <> '' AND NOT regexp_matches({SA}, '[.!?。]$')",
    "encoding_issues": "regexp_matches(question || answer, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]|\ufffd')",
    "too_short": f"answer <> '' AND length({SA}) < 30",
    "too_long": f"answer <> '' AND length({SA}) > 2000",
    "missing_punctuation": f"question <> '' AND NOT suffix({SQ}, '?')",
}


@query("format_issue_rows", W + LABELLED_SQL.strip() + " " + " UNION ALL ".join(f"SELECT '{n}' AS issue, source_doc || ':' || seq AS idx, length(answer) AS length, CASE WHEN length(answer) > 50 THEN right(answer, 50) ELSE answer END AS ending FROM e WHERE {p}" for n, p in ISSUES.items()))
def _(spark, d):
    return report.format_issue_rows(labelled(spark, d))


@query("file_metrics", f"WITH {QA_SQL} SELECT (SELECT sum(greatest(1, length(coalesce(text, '')) // 3800))::BIGINT FROM documents) AS chunks_total, count(DISTINCT (source_doc, chunk_id)) AS chunks_processed, count(*) AS qa_generated FROM qa")
def _(spark, d):
    return report.file_metrics(table(spark, d, "documents"), qa(spark, d), "text")


# Regeneration.
CHUNKS_SQL = LABELLED_SQL.strip() + ", g AS (SELECT source_doc, chunk_id, count(*) FILTER (label = 'good') AS good_count, count(*) FILTER (label = 'bad') AS bad_count, count(*) AS total FROM e GROUP BY 1, 2), c AS (SELECT *, good_count / total AS good_rate, good_count < 1 OR good_count / total < 0.5 AS needs_regenerate, CASE WHEN good_count < 1 THEN 'Chỉ có ' || good_count || ' good Q&A (yêu cầu >= 1)' WHEN good_count / total < 0.5 THEN 'Tỷ lệ good chỉ ' || printf('%.1f', round_even(good_count / total * 100, 1)) || '% (yêu cầu >= 50%)' ELSE '' END AS reason FROM g)"


@query("chunk_quality", W + CHUNKS_SQL + " SELECT * FROM c")
def _(spark, d):
    return regenerate.chunk_quality(labelled(spark, d))


@query("chunks_to_regenerate", W + CHUNKS_SQL + " SELECT source_doc, chunk_id, reason FROM c WHERE needs_regenerate")
def _(spark, d):
    return regenerate.chunks_to_regenerate(labelled(spark, d))


@query("regenerate_stats", W + CHUNKS_SQL + " SELECT count(*) AS total_chunks_analyzed, count(*) FILTER (NOT needs_regenerate) AS good_chunks, count(*) FILTER (needs_regenerate) AS bad_chunks, 0::BIGINT AS missing_chunks, count(*) FILTER (needs_regenerate) AS chunks_to_regenerate, count(*) FILTER (needs_regenerate) / greatest(1, count(*)) * 100 AS regenerate_rate FROM c")
def _(spark, d):
    return regenerate.regenerate_stats(labelled(spark, d))


def all_chunks(spark: SparkSession) -> DataFrame:
    return spark.range(45 * 8).select(F.concat(F.lit("d"), F.floor(F.col("id") / 8).cast("string")).alias("doc_name"), (F.col("id") % 8).cast("int").alias("chunk_id"))


ALL_SQL = "ch AS (SELECT 'd' || (i // 8) AS source_doc, (i % 8)::INTEGER AS chunk_id FROM range(360) t(i))"


@query("missing_chunks_anti", f"WITH {QA_SQL}, {ALL_SQL} SELECT *, 'Chưa được generate' AS reason FROM ch WHERE (source_doc, chunk_id) NOT IN (SELECT (source_doc, chunk_id) FROM qa)")
def _(spark, d):
    return regenerate.missing_chunks(all_chunks(spark), qa(spark, d))


@query("regen_semi", W + CHUNKS_SQL + f", {ALL_SQL} SELECT ch.source_doc AS doc_name, ch.chunk_id FROM ch SEMI JOIN (SELECT * FROM c WHERE needs_regenerate) x ON ch.source_doc = x.source_doc AND ch.chunk_id = x.chunk_id")
def _(spark, d):
    return regenerate.only_chunks(all_chunks(spark), regenerate.chunks_to_regenerate(labelled(spark, d)))


@query("remove_regenerated", W + CHUNKS_SQL + " SELECT seq FROM e ANTI JOIN (SELECT * FROM c WHERE needs_regenerate) x ON e.source_doc = x.source_doc AND e.chunk_id = x.chunk_id")
def _(spark, d):
    own = labelled(spark, d)
    return regenerate.without_chunks(own, regenerate.chunks_to_regenerate(own)).select("seq")


# Metadata and rescue.
def _number_sql(text: str, forms) -> str:
    def one(p: str, kind: str) -> str:
        raw = f"regexp_replace(regexp_extract({text}, {sq('(?i)' + p)}, 1), '\\s+', '', 'g')"
        if kind == "Nghị định số":
            raw = f"CASE WHEN contains({raw}, 'NĐ') AND NOT contains({raw}, '-CP') THEN replace({raw}, 'NĐ', 'NĐ-CP') ELSE {raw} END"
        return f"WHEN {hit(text, p)} THEN {{'number': {raw}, 'kind': {sq(kind)}}}"

    return "CASE " + " ".join(one(p, k) for p, k in forms) + " END"


H_SQL = f"d AS (SELECT doc_id AS seq, 'd' || (doc_id % 40) AS file_name, {HEADERS} AS content FROM documents), h AS (SELECT *, regexp_replace(substring(content, 1, 3000), '[\\s\\x0b\\x1c-\\x1f]+', ' ', 'g') AS t FROM d), nn AS (SELECT *, {_number_sql('t', X.HEADER_NUMBERS)} AS nu FROM h)"


def _date_sql(p: str) -> str:
    parts = [f"regexp_extract(t, {sq('(?i)' + p)}, {k})" for k in (1, 2, 3)]
    return f"CASE WHEN {hit('t', p)} AND try_cast(concat_ws('-', {parts[2]}, lpad({parts[1]}, 2, '0'), lpad({parts[0]}, 2, '0')) AS DATE) IS NOT NULL THEN lpad({parts[0]}, 2, '0') || '/' || lpad({parts[1]}, 2, '0') || '/' || {parts[2]} END"


def _issuer_sql() -> str:
    return "CASE " + " ".join(f"WHEN {hit('t', p)} THEN " + (f"{sq(n)} || trim(regexp_extract(t, {sq('(?i)' + p)}, 1))" if named else sq(n)) for p, n, named in X.ISSUERS) + " END"


META_SQL = H_SQL + f", m AS (SELECT seq, file_name, nu.kind || ' ' || nu.number AS doc_number, nu.number AS doc_number_short, nu.kind AS doc_type, coalesce({_date_sql(X.DATES[0])}, {_date_sql(X.DATES[1])}) AS issued_date, {_issuer_sql()} AS issued_by FROM nn)"


@query("doc_metadata", f"WITH {META_SQL} SELECT * FROM m")
def _(spark, d):
    return metadata.extract_metadata(headed(spark, d)).select("seq", "file_name", *[f"metadata.{f}" for f in ("doc_number", "doc_number_short", "doc_type", "issued_date", "issued_by")])


@query(
    "doc_title",
    f"WITH d AS (SELECT doc_id AS seq, {HEADERS} AS content FROM documents), l AS (SELECT seq, string_split(substring(content, 1, 3000), chr(10)) AS x FROM d), p AS (SELECT seq, generate_subscripts(x, 1) AS i, x FROM l), k AS (SELECT seq, i, {STRIP.format('x[i + 1]')} AS nx FROM p WHERE i < len(x) AND ({' OR '.join(f'contains(upper(x[i]), {sq(w)})' for w in X.TITLE_WORDS)})) SELECT d.seq, (SELECT substring(arg_min(nx, i), 1, 200) FROM k WHERE k.seq = d.seq AND length(nx) > 10) AS title FROM d",
)
def _(spark, d):
    return headed(spark, d).select("seq", metadata.title("content").alias("title"))


@query("doc_number_text", f"WITH {META_SQL} SELECT seq, coalesce(doc_number, {sq(X.UNKNOWN_NUMBER)}) AS number_text FROM m")
def _(spark, d):
    return headed(spark, d).select("seq", metadata.number_text("content").alias("number_text"))


SPLIT_NUMBER = r"^(.+?)\s+(\d+/.+)$"


@query("doc_number_split", f"WITH {META_SQL}, n AS (SELECT seq, coalesce(doc_number, {sq(X.UNKNOWN_NUMBER)}) AS t FROM m) SELECT seq, CASE WHEN regexp_matches(t, {sq(SPLIT_NUMBER)}) THEN regexp_extract(t, {sq(SPLIT_NUMBER)}, 2) END AS number, CASE WHEN regexp_matches(t, {sq(SPLIT_NUMBER)}) THEN regexp_extract(t, {sq(SPLIT_NUMBER)}, 1) END AS kind FROM n")
def _(spark, d):
    out = headed(spark, d).select("seq", metadata.number_text("content").alias("t")).select("seq", metadata.split_number_text("t").alias("n"))
    return out.select("seq", "n.number", "n.kind")


FILE_NAME = "CASE doc_id % 6 WHEN 0 THEN '11_2025_TT-BNV_' WHEN 1 THEN '274_2025_ND-CP_' WHEN 2 THEN '74_2025_QH15_' WHEN 3 THEN '2222_QD-BHXH_' WHEN 4 THEN '158_2025_NĐ-CP_' ELSE 'van_ban_' END || CAST(doc_id AS VARCHAR(20)) || '.txt'"


def _file_sql(what: int) -> str:
    def one(pattern: str, kind: str, made: tuple) -> str:
        parts = " || ".join(f"regexp_extract(n, {sq(pattern)}, {m})" if isinstance(m, int) else sq(m) for m in made)
        return f"WHEN regexp_matches(n, {sq(pattern)}) THEN {sq(kind) if what else parts}"

    return "CASE " + " ".join(one(*f) for f in X.FILE_NUMBERS) + " END"


@query("doc_number_from_file", f"SELECT doc_id, {_file_sql(0)} AS number, {_file_sql(1)} AS kind FROM (SELECT doc_id, {FILE_NAME} AS n FROM documents)")
def _(spark, d):
    out = table(spark, d, "documents").select("doc_id", metadata.number_from_file(F.expr(FILE_NAME)).alias("n"))
    return out.select("doc_id", "n.number", "n.kind")


ANSWERS = "CASE doc_id % 5 WHEN 0 THEN 'a [1, 2, \"b\"] c' WHEN 1 THEN '[1] và [2]' WHEN 2 THEN 'không có' WHEN 3 THEN '{\"a\": [3]}' ELSE 'hỏng [1, ' END"


@query("json_list", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '[1, 2, \"b\"]' WHEN 1 THEN '[1]' WHEN 3 THEN '[3]' END AS list FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", parse.parse_list(F.expr(ANSWERS)).alias("list"))


RESOLVED_SQL = META_SQL + ", dm AS (SELECT file_name, arg_max({'number': doc_number_short, 'kind': doc_type, 'issued_date': issued_date, 'issued_by': issued_by, 'has': doc_number IS NOT NULL}, seq) AS info FROM m GROUP BY 1), " + QA_SQL + ", qi AS (SELECT qa.*, CASE WHEN dm.info.has THEN dm.info END AS info FROM qa LEFT JOIN dm ON source_doc = file_name)"


@query("doc_number_resolve", f"WITH {RESOLVED_SQL} SELECT seq, info.number AS number, info.kind AS kind, info.issued_date AS issued_date, info.issued_by AS issued_by FROM qi")
def _(spark, d):
    out = rescue.resolve_numbers(qa(spark, d), metadata.extract_metadata(headed(spark, d)))
    return out.select("seq", *[f"doc_info.{f}" for f in ("number", "kind", "issued_date", "issued_by")])


def _rewrite_sql() -> str:
    cases = []
    for pattern, lead, tail, full in X.RESCUE_RULES:
        groups = T.count_groups(pattern)
        text = f"{sq(chr(92) + '1' if groups else '')} || {sq(lead)} || {'full_n' if full else 'plain_n'} || {sq(tail + (chr(92) + '2' if groups > 1 else ''))}"
        new = f"regexp_replace(answer, {sq('(?s:)' + pattern)}, {text})"
        cases.append(f"WHEN {new} <> answer THEN {new}")
    return "CASE " + " ".join(cases) + " END"


RESCUE_SQL = RESOLVED_SQL + ", rn AS (SELECT *, info.kind || ' ' || info.number AS plain_n, info.kind || ' ' || info.number || coalesce(' ngày ' || info.issued_date, '') || coalesce(' của ' || info.issued_by, '') AS full_n FROM qi), rw AS (SELECT *, " + _rewrite_sql() + f" AS new FROM rn), rr AS (SELECT *, info IS NOT NULL AND NOT (NOT contains(lower(answer), {sq(X.NO_NUMBER)}) AND {hit('answer', X.RESCUED_NUMBER, '')}) AND NOT {hit('answer', X.INVALID_CITATION, '')} AND new IS NOT NULL AS ok FROM rw)"


@query("rescue_answers", f"WITH {RESCUE_SQL} SELECT seq, new AS answer, info.number AS doc_added, true AS rescued, 10.0::DOUBLE AS eval_score, {sq(X.REASON_RESCUED)} || info.number AS eval_reason FROM rr WHERE ok")
def _(spark, d):
    good, _ = rescue.rescue(qa(spark, d), metadata.extract_metadata(headed(spark, d)))
    return good.select("seq", "answer", "doc_added", "rescued", "eval_score", "eval_reason")


@query("rescue_stats", f"WITH {RESCUE_SQL} SELECT count(*) AS processed, count(*) FILTER (ok) AS rescued, count(*) FILTER (NOT ok) AS still_bad, count(*) FILTER (ok) / greatest(1, count(*)) AS rescue_rate FROM rr")
def _(spark, d):
    return rescue.rescue_stats(*rescue.rescue(qa(spark, d), metadata.extract_metadata(headed(spark, d))))


@query("fix_placeholders", f"WITH {RESCUE_SQL} SELECT seq, contains(lower(answer), {sq(X.NO_NUMBER)}) AND new IS NOT NULL AND info IS NOT NULL AS fixed_by_postprocess, CASE WHEN contains(lower(answer), {sq(X.NO_NUMBER)}) AND new IS NOT NULL AND info IS NOT NULL THEN new ELSE answer END AS answer FROM rr")
def _(spark, d):
    return rescue.fix_placeholders(qa(spark, d), metadata.extract_metadata(headed(spark, d))).select("seq", "fixed_by_postprocess", "answer")


# Temporal validity.
def _every_citation(text: str) -> str:
    out = f"regexp_extract_all({text}, {sq(X.CITATIONS[0][0])}, 1)"
    for p, _ in X.CITATIONS[1:]:
        out = f"list_concat({out}, regexp_extract_all({text}, {sq(p)}, 1))"
    return out


CIT_SQL = QA_SQL + f", ci AS (SELECT *, {_every_citation('question || chr(10) || answer')} AS raw FROM qa), cc AS (SELECT * EXCLUDE raw, list_filter(raw, lambda x, i: list_position(raw, x) = i) AS cited FROM ci), " + LAWS_SQL + f", st AS (SELECT *, CASE WHEN effective_date <= DATE '{DAY}' AND (expiry_date IS NULL OR expiry_date > DATE '{DAY}') THEN 'active' ELSE 'expired' END AS status FROM laws), vv AS (SELECT *, list_filter(cited, lambda x: list_contains(on_, x)) AS active, list_filter(cited, lambda x: list_contains(off_, x)) AS expired, list_filter(cited, lambda x: NOT list_contains(on_, x) AND NOT list_contains(off_, x)) AS unknown FROM cc, (SELECT list(id) FILTER (status = 'active') AS on_, list(id) FILTER (status = 'expired') AS off_ FROM st))"


@query("citations_detect", f"WITH {CIT_SQL} SELECT seq, array_to_string(cited, ',') AS cited, len(cited)::INTEGER AS n FROM vv")
def _(spark, d):
    q = qa(spark, d).withColumn("c", temporal.citations(F.concat("question", F.lit("\n"), "answer")))
    return q.select("seq", F.array_join("c", ",").alias("cited"), F.size("c").alias("n"))


#: Each pair's own reference date: that of an order, moved to the years of the registry.
DATED = "CAST(o_orderdate AS DATE) + {days}"
DAYS_SQL = f"ds AS (SELECT o_orderkey AS seq, {DATED.format(days=8766)} AS day FROM orders)"


def days(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("seq"), F.date_add(F.col("o_orderdate").cast("date"), 8766).alias("day"))


IN_FORCE = "effective_date <= day AND (expiry_date IS NULL OR expiry_date > day)"


@query("law_status_asof", f"WITH {LAWS_SQL}, {DAYS_SQL} SELECT day, id, type, CASE WHEN {IN_FORCE} THEN 'active' ELSE 'expired' END AS status FROM (SELECT DISTINCT day FROM ds), laws")
def _(spark, d):
    return temporal.law_status_on(registry(spark), days(spark, d), "day").select("day", "id", "type", "status")


BY_DATE_SQL = (
    f"{CIT_SQL}, {DAYS_SQL}, x AS (SELECT seq, day, unnest(cited) AS id, generate_subscripts(cited, 1) AS pos FROM cc LEFT JOIN ds USING (seq)), "
    f"y AS (SELECT x.*, CASE WHEN day IS NULL THEN 'unknown' WHEN EXISTS (SELECT 1 FROM laws WHERE laws.id = x.id AND {IN_FORCE}) THEN 'active' WHEN EXISTS (SELECT 1 FROM laws WHERE laws.id = x.id) THEN 'expired' ELSE 'unknown' END AS status FROM x), "
    "z AS (SELECT seq, count(*)::INTEGER AS n, string_agg(id, ',' ORDER BY pos) FILTER (status = 'active') AS a, string_agg(id, ',' ORDER BY pos) FILTER (status = 'expired') AS e, string_agg(id, ',' ORDER BY pos) FILTER (status = 'unknown') AS u FROM y GROUP BY seq)"
)


@query("temporal_validate_by_date", f"WITH {BY_DATE_SQL} SELECT seq, e IS NULL AS is_valid, coalesce(n, 0) AS total_citations, coalesce(a, '') AS active, coalesce(e, '') AS expired, coalesce(u, '') AS unknown FROM cc LEFT JOIN z USING (seq)")
def _(spark, d):
    dated = qa(spark, d).join(days(spark, d), "seq", "left")
    v = temporal.validated_on(dated, registry(spark), "day", "seq")
    return v.select("seq", "_validation.is_valid", "_validation.total_citations", *[F.array_join(f"_validation.{n}", ",").alias(n) for n in ("active", "expired", "unknown")])


def _validated(name: str, strict: bool) -> None:
    rule = "len(expired) = 0" if strict else "len(active) > 0 OR len(expired) = 0"

    @query(name, f"WITH {CIT_SQL} SELECT seq, {rule} AS is_valid, len(cited)::INTEGER AS total_citations, array_to_string(active, ',') AS active, array_to_string(expired, ',') AS expired, array_to_string(unknown, ',') AS unknown FROM vv")
    def _(spark, d):
        v = temporal.validated(qa(spark, d), registry(spark), DAY, strict)
        return v.select("seq", "_validation.is_valid", "_validation.total_citations", *[F.array_join(f"_validation.{n}", ",").alias(n) for n in ("active", "expired", "unknown")])


_validated("temporal_validate_strict", True)
_validated("temporal_validate_lenient", False)


@query("temporal_stats", f"WITH {CIT_SQL} SELECT count(*) AS total, count(*) FILTER (len(expired) = 0) AS valid, count(*) FILTER (len(expired) > 0) AS invalid, count(*) FILTER (len(expired) = 0) / greatest(1, count(*)) * 100 AS valid_rate FROM vv")
def _(spark, d):
    return temporal.validity_stats(temporal.validated(qa(spark, d), registry(spark), DAY))


@query("law_usage_counts", f"WITH {CIT_SQL} SELECT law_id, kind, count(*) AS n FROM (SELECT unnest(CASE WHEN len(expired) = 0 THEN active ELSE expired END) AS law_id, CASE WHEN len(expired) = 0 THEN 'active' ELSE 'expired' END AS kind FROM vv) GROUP BY ALL")
def _(spark, d):
    return temporal.law_usage(temporal.validated(qa(spark, d), registry(spark), DAY))


@query("filter_by_validity", f"WITH {CIT_SQL} SELECT seq, len(expired) = 0 AS is_valid, array_to_string(list_sort(expired), ',') AS invalid_citations FROM vv")
def _(spark, d):
    good, bad = temporal.filter_by_validity(qa(spark, d), registry(spark), DAY)
    return good.select("seq", F.lit(True).alias("is_valid"), F.lit("").alias("invalid_citations")).unionByName(bad.select("seq", F.lit(False).alias("is_valid"), F.array_join("_invalid_citations", ",").alias("invalid_citations")))


@query("temporal_context", f"WITH {CIT_SQL}, hd AS (SELECT string_agg(id, ', ' ORDER BY ord) AS main FROM (SELECT * FROM st WHERE status = 'active' AND type = 'Luật' ORDER BY ord LIMIT 3)) SELECT seq, '### Ngày tham chiếu: 01/12/2025' || chr(10) || '### Văn bản áp dụng: ' || main || chr(10) || chr(10) || '### Câu hỏi:' || chr(10) || question AS question, '{DAY}' AS reference_date, array_to_string(active, ',') AS applicable_laws FROM vv, hd")
def _(spark, d):
    out = temporal.add_context(qa(spark, d), registry(spark), DAY)
    return out.select("seq", "question", "reference_date", F.array_join("applicable_laws", ",").alias("applicable_laws"))


@query("temporal_prompt", f"WITH {CIT_SQL}, ls AS (SELECT string_agg('- ' || id || ': ' || name, chr(10) ORDER BY CASE type WHEN 'Luật' THEN 0 ELSE 1 END, ord) AS x FROM st WHERE status = 'active' AND type IN ('Luật', 'Nghị định')) SELECT seq, md5('### Ngày tham chiếu: 01/12/2025' || chr(10) || '### Văn bản pháp luật đang có hiệu lực:' || chr(10) || x || chr(10) || chr(10) || '### Câu hỏi:' || chr(10) || question || chr(10) || chr(10) || '### Lưu ý: Trả lời theo văn bản pháp luật đang có hiệu lực tại ngày tham chiếu.' || chr(10) || chr(10) || '### Trả lời:' || chr(10)) AS prompt_md5 FROM vv, ls")
def _(spark, d):
    return temporal.temporal_prompt(qa(spark, d), registry(spark), DAY).select("seq", F.md5("prompt").alias("prompt_md5"))


# Split.
SPLIT_SQL = QA_SQL + ", dd AS (SELECT DISTINCT source_doc FROM qa), rk AS (SELECT source_doc, row_number() OVER (ORDER BY md5('42|' || source_doc), source_doc) - 1 AS r, count(*) OVER () AS n FROM dd), sp AS (SELECT source_doc, CASE WHEN r < trunc(n * 0.7::DOUBLE) THEN 'train' WHEN r < trunc(n * 0.7::DOUBLE) + trunc(n * 0.15::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM rk)"


@query("doc_split", f"WITH {SPLIT_SQL} SELECT seq, source_doc, split FROM qa JOIN sp USING (source_doc)")
def _(spark, d):
    return split.split_by_document(qa(spark, d)).select("seq", "source_doc", "split")


@query("split_info", f"WITH {SPLIT_SQL} SELECT split, count(*) AS samples, count(DISTINCT source_doc) AS documents, array_to_string(list_sort(list_distinct(list(source_doc))), ',') AS doc_ids FROM qa JOIN sp USING (source_doc) GROUP BY split")
def _(spark, d):
    return split.split_info(split.split_by_document(qa(spark, d))).withColumn("doc_ids", F.array_join("doc_ids", ","))


@query("split_leakage", f"WITH {SPLIT_SQL} SELECT a.split || '_' || b.split AS pair, (SELECT count(*) FROM sp x JOIN sp y ON x.source_doc = y.source_doc AND x.split = a.split AND y.split = b.split)::BIGINT AS overlap FROM (VALUES ('train'), ('validation')) a(split), (VALUES ('validation'), ('test')) b(split) WHERE a.split <> b.split")
def _(spark, d):
    return split.leakage(split.split_by_document(qa(spark, d)))


QUERIES["split_exact_shuffle"] = lambda spark, d: split.split_by_document(qa(spark, d), exact=True).select("seq", "source_doc", "split")
QUERIES["legacy_random_split"] = lambda spark, d: split.random_split(qa(spark, d)).select("seq", "split")


@query("merge_splits", f"WITH {SPLIT_SQL} SELECT split, count(*) AS n FROM qa JOIN sp USING (source_doc) GROUP BY split")
def _(spark, d):
    return export.merged(split.split_by_document(qa(spark, d))).groupBy("split").agg(F.count("*").alias("n"))


# Export.
@query("format_chatml", f"WITH {QA_SQL} SELECT seq, to_json([{{'role': 'system', 'content': {sq(X.PROMPT_EXPORT)}}}, {{'role': 'user', 'content': question}}, {{'role': 'assistant', 'content': answer}}])::VARCHAR AS messages, source_doc AS source FROM qa")
def _(spark, d):
    return export.formatted(qa(spark, d), "chat", source=True, keep=("seq",)).withColumn("messages", F.to_json("messages"))


@query("format_instruction", f"WITH {QA_SQL} SELECT seq, question AS instruction, '' AS input, answer AS output FROM qa")
def _(spark, d):
    return export.formatted(qa(spark, d), "instruction", keep=("seq",))


@query("format_simple", f"WITH {QA_SQL} SELECT seq, question, answer FROM qa")
def _(spark, d):
    return export.formatted(qa(spark, d), "simple", keep=("seq",))


def layout_sql(layout: str, **parts: str) -> str:
    out = sq(layout)
    for k, v in parts.items():
        out = f"replace({out}, '{{{k}}}', {v})"
    return out


@query("chat_templates", f"WITH {QA_SQL} SELECT seq, " + ", ".join(f"md5({layout_sql(a, system=sq(X.PROMPT_TOKENS), user='question')} || answer || {sq(z)}) AS {n}" for n, (a, z) in X.CHAT_TEMPLATES.items()) + " FROM qa")
def _(spark, d):
    return qa(spark, d).select("seq", *[F.md5(export.chat_text("question", "answer", n)).alias(n) for n in X.CHAT_TEMPLATES])


def _cited_sql() -> str:
    one = lambda p, k: f"list_transform(regexp_extract_all(answer, {sq('(?i)' + p)}, 1), lambda x: {{'t': {sq(k)}, 'i': x}})"
    out = one(*X.CITED_DOCUMENTS[0])
    for p, k in X.CITED_DOCUMENTS[1:]:
        out = f"list_concat({out}, {one(p, k)})"
    return out


PROMPT_SQL = QA_SQL + ", " + LAWS_SQL + f", r0 AS (SELECT *, {_cited_sql()} AS raw FROM qa), r1 AS (SELECT * EXCLUDE raw, list_filter(raw, lambda x, i: list_position(list_transform(raw, lambda y: y.i), x.i) = i) AS cited FROM r0), r2 AS (SELECT *, array_to_string(list_transform(cited[1:3], lambda x: '- ' || coalesce((list_filter(known, lambda l: l.i = x.i))[1].t || ' số ' || x.i || ' (active)', x.t || ' số ' || x.i)), chr(10)) AS docs FROM r1, (SELECT list({{'i': id, 't': type}}) AS known FROM laws))"
BASE = X.PROMPT_BASE.format(date="01/12/2025")


@query("system_prompt_specific", f"WITH {PROMPT_SQL} SELECT seq, len(cited)::INTEGER AS n_cited, CASE WHEN len(cited) > 0 THEN {sq(BASE + X.PROMPT_SPECIFIC[0])} || docs || {sq(X.PROMPT_SPECIFIC[1])} ELSE {sq(BASE + X.PROMPT_GENERAL)} END AS system_prompt FROM r2")
def _(spark, d):
    laws = registry(spark).withColumn("status", F.lit("active"))
    return export.with_system_prompt(qa(spark, d), laws).select("seq", F.size("cited_documents").alias("n_cited"), "system_prompt")


@query("system_prompt_layouts", f"WITH {PROMPT_SQL}, r3 AS (SELECT *, CASE WHEN len(cited) > 0 THEN {sq(BASE + X.PROMPT_SPECIFIC[0])} || docs || {sq(X.PROMPT_SPECIFIC[1])} ELSE {sq(BASE + X.PROMPT_GENERAL)} END AS sp FROM r2) SELECT seq, md5('<|system|>' || chr(10) || sp || chr(10) || '<|user|>' || chr(10) || question || chr(10) || '<|assistant|>' || chr(10) || answer) AS chat, md5('### Hệ thống:' || chr(10) || sp || chr(10) || chr(10) || '### Câu hỏi:' || chr(10) || question || chr(10) || chr(10) || '### Trả lời:' || chr(10) || answer) AS instruction FROM r3")
def _(spark, d):
    laws = registry(spark).withColumn("status", F.lit("active"))
    out = export.with_system_prompt(qa(spark, d), laws)
    out = export.laid_out(export.laid_out(out, "chat", "chat"), "instruction", "instruction_text")
    return out.select("seq", F.md5("chat").alias("chat"), F.md5("instruction_text").alias("instruction"))


@query("token_stats", f"WITH {QA_SQL}, t AS (SELECT least(600, 1 + strlen({layout_sql(X.CHAT_TEMPLATES['chatml'][0], system=sq('S'), user='question')} || answer || {sq(X.CHAT_TEMPLATES['chatml'][1])})) AS n, strlen({layout_sql(X.CHAT_TEMPLATES['chatml'][0], system=sq('S'), user='question')}) AS p FROM qa WHERE question <> '' AND answer <> '') SELECT count(*) AS total_samples, (count(*) * 600)::BIGINT AS total_tokens, sum(600 - n + least(p, n))::BIGINT AS masked_tokens, 600.0::DOUBLE AS avg_length, 600::INTEGER AS max_length, 600::INTEGER AS min_length, count(*) AS truncated, sum(n - least(p, n))::BIGINT AS trainable_tokens FROM t")
def _(spark, d):
    return tokenize.token_stats(tokenize.tokenized(qa(spark, d), template="chatml", system="S", max_length=600), 600)


@query("token_label_mask", f"WITH {QA_SQL}, t AS (SELECT source_doc, chunk_id, 1 + strlen({layout_sql(X.CHAT_TEMPLATES['chatml'][0], system=sq('S'), user='question')} || answer || {sq(X.CHAT_TEMPLATES['chatml'][1])}) AS n, strlen({layout_sql(X.CHAT_TEMPLATES['chatml'][0], system=sq('S'), user='question')}) AS p FROM qa WHERE question <> '' AND answer <> '') SELECT source_doc, chunk_id, least(n, 400)::INTEGER AS n_tokens, least(p, least(n, 400))::INTEGER AS n_masked FROM t")
def _(spark, d):
    t = tokenize.tokenized(qa(spark, d), template="chatml", system="S", max_length=400, pad=False)
    return t.select("source_doc", "chunk_id", F.size("input_ids").alias("n_tokens"), F.size(F.filter("labels", lambda x: x == X.LABEL_IGNORED)).alias("n_masked"))


# Chunks and generation.
def _rfind(s: str, sub: str) -> str:
    """Place of the last occurrence from 0, or -1."""
    n = len(sub.replace("\n", "x"))
    lit = "chr(10) || chr(10)" if sub == "\n\n" else " || ".join("chr(10)" if ch == "\n" else f"'{ch}'" for ch in sub)
    return f"CASE WHEN contains({s}, {lit}) THEN length({s}) - strpos(reverse({s}), reverse({lit})) - {n - 1} ELSE -1 END"


_WIN = "substring(t, st + 1, 1200)"
CHUNK_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n FROM documents WHERE length(coalesce(text, '')) > 1200),
w AS (SELECT doc_id, t, n, 0::BIGINT AS st, 0 AS k, NULL::BIGINT AS en FROM d
  UNION ALL SELECT doc_id, t, n, CASE WHEN e2 < n THEN greatest(e2 - 100, st + 1) ELSE e2 END, k + 1, e2 FROM (
    SELECT *, CASE WHEN st + 1200 >= n THEN st + 1200 WHEN pp > 600 THEN st + pp + 2 WHEN ss > 600 THEN st + ss + 1 ELSE st + 1200 END AS e2 FROM (
      SELECT *, {_rfind(_WIN, chr(10) * 2)} AS pp, greatest({_rfind(_WIN, '. ')}, {_rfind(_WIN, '.' + chr(10))}, {_rfind(_WIN, '? ')}, {_rfind(_WIN, '! ')}) AS ss FROM w WHERE st < n))),
s AS (SELECT a.doc_id, a.k, a.st, b.en, {STRIP.format('substring(a.t, a.st + 1, b.en - a.st)')} AS content FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.k = a.k + 1)
SELECT doc_id::VARCHAR AS doc_name, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INTEGER AS chunk_id, md5(content) AS content_md5 FROM s WHERE content <> ''
UNION ALL SELECT doc_id::VARCHAR, 0, md5(text) FROM documents WHERE length(text) BETWEEN 1 AND 1200
"""


@query("chunk_text", CHUNK_SQL)
def _(spark, d):
    return chunk.chunked(table(spark, d, "documents"), "doc_id", "text", 1200, 100).select("doc_name", "chunk_id", F.md5("content").alias("content_md5"))


RESPONSES = "CASE doc_id % 5 WHEN 0 THEN '```json' || chr(10) || '[{\"question\": \" q' || CAST(doc_id AS VARCHAR(20)) || '\", \"answer\": \"a \"}, {\"question\": \"only\"}]' || chr(10) || '```' WHEN 1 THEN 'Here: [{\"question\": \"x\", \"answer\": \"y' || CAST(doc_id AS VARCHAR(20)) || '\"}] done' WHEN 2 THEN 'no json' WHEN 3 THEN '[]' ELSE '```' || chr(10) || '[{\"answer\": \"z\", \"question\": \"w\"}]' || chr(10) || '```' END"


@query("qa_json_parse", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'q' || doc_id WHEN 1 THEN 'x' ELSE 'w' END AS question, CASE doc_id % 5 WHEN 0 THEN 'a' WHEN 1 THEN 'y' || doc_id ELSE 'z' END AS answer FROM documents WHERE doc_id % 5 NOT IN (2, 3)")
def _(spark, d):
    r = table(spark, d, "documents").selectExpr("doc_id", f"{RESPONSES} AS response")
    return r.select("doc_id", F.explode(parse.parse_pairs("response")).alias("p")).select("doc_id", "p.question", "p.answer")


@query("verdict_parse", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN doc_id % 11 ELSE 5 END::DOUBLE AS score, CASE doc_id % 3 WHEN 0 THEN 'ok' WHEN 1 THEN 'Parse error' ELSE 'N/A' END AS reason FROM documents")
def _(spark, d):
    r = table(spark, d, "documents").selectExpr("doc_id", "CASE doc_id % 3 WHEN 0 THEN '```json{\"score\": ' || CAST(doc_id % 11 AS VARCHAR(20)) || ', \"reason\": \"ok\"}```' WHEN 1 THEN 'nothing' ELSE 'so {\"keep\": true} is it' END AS response")
    return r.withColumn("v", parse.parse_verdict("response")).select("doc_id", "v.score", "v.reason")


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr("'d' || CAST(doc_id AS VARCHAR(20)) AS doc_name", "0 AS chunk_id", "text AS content", "CAST(NULL AS STRING) AS doc_number", "CAST(NULL AS STRING) AS issued_date", "CAST(NULL AS STRING) AS issued_by")


TEMPLATE = "Tạo {num_qa} câu hỏi: {content}"
KEY_SQL = f"substring(sha256(coalesce(text, '') || '|{TEMPLATE}|template'), 1, 16)"
HEAD_SQL = "substring(" + STRIP.format("regexp_replace('Tạo 5 câu hỏi: ' || coalesce(text, ''), '[\\s\\x0b\\x1c-\\x1f]+', ' ', 'g')") + ", 1, 80)"


@query(
    "generate_with_cache",
    f"WITH c AS (SELECT {KEY_SQL} AS k, TIMESTAMP '2025-11-30' - to_days((doc_id % 60)::INTEGER) AS made FROM documents WHERE doc_id % 3 = 0), f AS (SELECT DISTINCT k FROM c WHERE made > TIMESTAMP '{DAY}' - INTERVAL 30 DAY), d AS (SELECT 'd' || doc_id AS source_doc, {KEY_SQL} AS key, {HEAD_SQL} AS head FROM documents) SELECT source_doc, 0 AS chunk_id, CASE WHEN k IS NULL THEN head || '?' ELSE 'c' || key END AS question, CASE WHEN k IS NULL THEN {STRIP.format("'Căn cứ Điều 1 Luật số 41/2024/QH15: ' || head")} ELSE 'a' || key END AS answer, k IS NOT NULL AS from_cache FROM d LEFT JOIN f ON k = key",
)
def _(spark, d):
    key = T.cache_key("content", F.lit(TEMPLATE), F.lit("template"))
    own = F.array(F.struct(F.concat(F.lit("c"), key).alias("question"), F.concat(F.lit("a"), key).alias("answer")))
    third = table(spark, d, "documents").filter("doc_id % 3 = 0").withColumnRenamed("text", "content")  # every third document is in the cache, half of them too old
    cache = third.select(key.alias("cache_key"), (F.lit("2025-11-30").cast("timestamp") - F.make_dt_interval(days=(F.col("doc_id") % 60).cast("int"))).alias("created_at"), own.alias("result"))
    return generate.generated(chunks(spark, d), generate.TemplateProvider(), TEMPLATE, "template", cache, 30, DAY)[0].select("source_doc", "chunk_id", "question", "answer", "from_cache")


CACHE_SQL = "SELECT substring(sha256(coalesce(text, '') || '|t|m'), 1, 16) AS cache_key, TIMESTAMP '2025-11-30' - to_days((doc_id % 60)::INTEGER) AS created_at FROM documents WHERE doc_id % 3 = 0"


@query("cache_ttl_join", f"WITH c AS ({CACHE_SQL}), f AS (SELECT DISTINCT cache_key FROM c WHERE created_at > TIMESTAMP '{DAY}' - INTERVAL 30 DAY) SELECT count(f.cache_key) AS hits, count(*) - count(f.cache_key) AS misses, count(f.cache_key) / greatest(1, count(*)) * 100 AS hit_rate, (SELECT count(*) FROM c) AS entries FROM documents d LEFT JOIN f ON f.cache_key = substring(sha256(coalesce(text, '') || '|t|m'), 1, 16)")
def _(spark, d):
    cache = table(spark, d, "documents").filter("doc_id % 3 = 0").select(T.cache_key("text", F.lit("t"), F.lit("m")).alias("cache_key"), (F.lit("2025-11-30").cast("timestamp") - F.make_dt_interval(days=(F.col("doc_id") % 60).cast("int"))).alias("created_at"), F.lit(None).cast(parse.PAIRS).alias("result"))
    return generate.cache_stats(cache, table(spark, d, "documents").withColumnRenamed("text", "content"), "t", "m", 30, DAY)


LOG_SQL = """WITH r AS (SELECT 'k' || (doc_id % 500) AS cache_key, doc_id % 500 AS no, CASE doc_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS run, 1735689600 + doc_id AS at_seconds, doc_id AS v FROM documents WHERE doc_id % 3 < 2 OR doc_id % 5 = 0),
early AS (SELECT cache_key, max(struct_pack(run := run, at_seconds := at_seconds, v := v)) AS w FROM r WHERE run < 3 AND no % 7 <> 0 GROUP BY cache_key),
late AS (SELECT cache_key, max(struct_pack(run := run, at_seconds := at_seconds, v := v)) AS w FROM r WHERE run = 3 GROUP BY cache_key)
SELECT cache_key, w.at_seconds AS at_seconds, w.v AS v FROM late UNION ALL SELECT cache_key, w.at_seconds, w.v FROM early WHERE w.at_seconds > 1735690000 AND cache_key NOT IN (SELECT cache_key FROM late)"""


@query("cache_log_live", LOG_SQL)
def _(spark, d):
    """Two runs, tombstones of some keys, a time before which all is dead, a third run, a compaction: what is alive."""
    rows = table(spark, d, "documents").select(F.concat(F.lit("k"), F.col("doc_id") % 500).alias("cache_key"), F.timestamp_seconds(1735689600 + F.col("doc_id")).alias("at"), F.col("doc_id").alias("v"))
    log = logtable.LogTable(spark, storage.fresh_path(spark, "cache-log"), "cache_key string, at timestamp, v long", "cache_key", "at")
    log.append(rows.filter("v % 3 = 0"))
    log.append(rows.filter("v % 3 = 1"))
    log.drop_keys(rows.filter("v % 500 % 7 = 0"))
    log.drop_before(1735690000 * 1_000_000)
    log.append(rows.filter("v % 3 = 2 AND v % 5 = 0"))
    log.compact(all_=True)
    return log.read().select("cache_key", F.unix_seconds("at").alias("at_seconds"), "v")


STREAM_PAIRS_SQL = f"WITH d AS (SELECT 'd' || doc_id AS source_doc, {HEAD_SQL} AS head FROM documents) SELECT source_doc, 0 AS chunk_id, head || '?' AS question, {STRIP.format("'Căn cứ Điều 1 Luật số 41/2024/QH15: ' || head")} AS answer, false AS from_cache FROM d"


@query("generate_stream", STREAM_PAIRS_SQL)
def _(spark, d):
    """Pairs of all documents by the resumable generation: chunks as a stream, a table of answers for each batch."""
    work = Generation(spark, storage.fresh_path(spark, "generation"), generate.TemplateProvider(), TEMPLATE, "template", files=2)
    return generate.outcome(work.run(chunks(spark, d)), "template")[0].select("source_doc", "chunk_id", "question", "answer", "from_cache")


@query("chunk_parts", CHUNK_SQL)
def _(spark, d):
    """The chunks of chunk_text, with documents above 4,000 characters cut in parts of 3,000 that are walked at once."""
    return chunk.chunked_parts(table(spark, d, "documents"), "doc_id", "text", 1200, 100, huge=4000, part=3000).select("doc_name", "chunk_id", F.md5("content").alias("content_md5"))


@query("run_counters", W + LABELLED_SQL.strip() + " SELECT count(*) AS rows, count(*) FILTER (label = 'good') AS good, count(*) FILTER (label = 'bad') AS bad FROM e")
def _(spark, d):
    """What a stage's own write has counted."""
    seen = monitor.observed(labelled(spark, d).select("seq", "label"), lambda x: x.write.parquet(storage.fresh_path(spark, "counted")))
    return spark.createDataFrame([(seen["rows"], seen["good"], seen["bad"])], "rows long, good long, bad long")


# Conversations, reviews, events.
TURNS = "SELECT conv_id, turn, role, text, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations"


@query("qa_pairs_from_turns", f"SELECT conv_id, turn, text AS question, next_text AS answer FROM ({TURNS}) WHERE role = 'user' AND next_role = 'assistant'")
def _(spark, d):
    return pairs_from_turns(spark, d)


def pairs_from_turns(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)})
    return c.filter("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("question"), F.col("next_text").alias("answer"))


@query("conversation_good_rate", W.replace(QA_SQL, f"qa AS (SELECT conv_id * 1000 + turn AS seq, 'c' || (conv_id % 10) AS source_doc, 0 AS chunk_id, text AS question, coalesce(next_text, '') AS answer FROM ({TURNS}) WHERE role = 'user' AND next_role = 'assistant')") + LABELLED_SQL.strip() + " SELECT source_doc AS bucket, count(*) AS total, count(*) FILTER (label = 'good') / count(*) * 100 AS good_rate, avg(eval_score) AS avg_score FROM e GROUP BY 1")
def conversation_good_rate(spark, d):
    p = score.routed(score.rule_score(pairs_from_turns(spark, d), RULES), RULES.min_score)
    return p.groupBy(F.concat(F.lit("c"), (F.col("conv_id") % 10).cast("string")).alias("bucket")).agg(F.count("*").alias("total"), (F.count_if(F.col("label") == "good") / F.count("*") * 100).alias("good_rate"), F.avg("eval_score").alias("avg_score"))


REVIEWS = "SELECT doc_id AS sample_idx, CASE doc_id % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'flagged' END AS status, 'n' || CAST(quality AS VARCHAR(20)) AS note, 1 AS ts FROM labels UNION ALL SELECT doc_id, 'flagged', 'again', 2 FROM labels WHERE doc_id % 5 = 0"


def reviews(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    first = labels.selectExpr("doc_id AS sample_idx", "CASE doc_id % 3 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' ELSE 'flagged' END AS status", "'n' || CAST(quality AS STRING) AS note", "1 AS ts")
    return first.unionByName(labels.filter("doc_id % 5 = 0").selectExpr("doc_id AS sample_idx", "'flagged' AS status", "'again' AS note", "2 AS ts"))


@query("review_export", f"WITH {QA_SQL}, r AS ({REVIEWS}), l AS (SELECT sample_idx, arg_max(status, ts) AS review_status, arg_max(note, ts) AS review_note FROM r GROUP BY 1) SELECT seq, question, review_status, review_note FROM qa JOIN l ON seq = sample_idx")
def _(spark, d):
    return report.review_export(qa(spark, d), reviews(spark, d)).select("seq", "question", "review_status", "review_note")


@query("review_stats", f"SELECT status, count(*) AS n FROM ({REVIEWS}) GROUP BY 1")
def _(spark, d):
    return report.review_stats(reviews(spark, d))


def chunk_events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "ts", (F.col("event_id") % 7 != 0).alias("success"), F.col("value").alias("duration"), (F.col("event_id") % 4).alias("qa_count"), (F.col("event_id") % 3 == 0).alias("from_cache"))


EV = "ev AS (SELECT event_id, ts, event_id % 7 <> 0 AS success, value AS duration, event_id % 4 AS qa_count, event_id % 3 = 0 AS from_cache FROM events)"


@query("event_stats", f"WITH {EV} SELECT count(*) AS processed, count(*) FILTER (success) AS success, count(*) FILTER (NOT success) AS failed, sum(qa_count)::BIGINT AS qa_generated, count(*) FILTER (from_cache) AS cache_hits, count(*) FILTER (NOT from_cache) AS cache_misses, avg(duration) AS avg_duration, count(*) FILTER (from_cache) / count(*) * 100 AS hit_rate, count(*) / 1000000 * 100 AS progress_percent FROM ev")
def _(spark, d):
    return report.event_stats(chunk_events(spark, d), 1_000_000)


@query("rate_60s_window", "WITH m AS (SELECT max(ts) + INTERVAL 1 SECOND AS now, count(*) AS n FROM events), r AS (SELECT count(*) FILTER (epoch(now) - epoch(ts) < 60) AS recent, max(epoch(now) - epoch(ts)) FILTER (epoch(now) - epoch(ts) < 60) AS span FROM events, m) SELECT recent, recent / (span / 60) AS rate FROM r")
def _(spark, d):
    ev = table(spark, d, "events")
    now = ev.agg((F.max("ts") + F.expr("INTERVAL 1 SECOND")).cast("string").alias("n")).first()["n"]
    return report.recent_rate(ev, now)


@query("remaining_text", "SELECT event_id, CASE WHEN event_id % 6 = 0 OR event_id % 50 = 0 THEN 'N/A' WHEN m < 1 THEN '~' || floor(m * 60)::BIGINT || ' giây' WHEN m < 60 THEN '~' || floor(m)::BIGINT || ' phút' ELSE '~' || printf('%.1f', round_even(m / 60, 1)) || ' giờ' END AS remaining FROM (SELECT event_id, (event_id % 50) * 10 / nullif(event_id % 6, 0) AS m FROM events)")
def _(spark, d):
    return table(spark, d, "events").select("event_id", report.remaining_text((F.col("event_id") % 50) * 10, F.col("event_id") % 6).alias("remaining"))


@query("error_summary", "SELECT event_type AS category, CASE WHEN event_id % 10 = 0 THEN 'critical' ELSE 'error' END AS severity, count(*) AS n, bool_or(event_id % 10 = 0) AS critical FROM events GROUP BY 1, 2")
def _(spark, d):
    return report.error_summary(table(spark, d, "events").select(F.col("event_type").alias("category"), F.when(F.col("event_id") % 10 == 0, "critical").otherwise("error").alias("severity")))


@query("tumbling_event_counts", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2")
def _(spark, d):
    return stream.tumbling_counts(table(spark, d, "events"))


@query("sliding_event_rate", "WITH w AS (SELECT unnest([time_bucket(INTERVAL 2 HOUR, ts), time_bucket(INTERVAL 2 HOUR, ts - INTERVAL 1 HOUR) + INTERVAL 1 HOUR]) AS s FROM events) SELECT s AS window_start, count(*) AS n, count(*) / 120 AS rate FROM w GROUP BY 1")
def _(spark, d):
    return stream.sliding_rate(table(spark, d, "events"), "2 hours", "1 hour")


@query("session_windows", "WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new, event_id FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, min(ts) AS session_start, (max(ts) + INTERVAL 30 MINUTE) AS session_end, count(*) AS n FROM s GROUP BY user_id, k")
def _(spark, d):
    return stream.sessions(table(spark, d, "events"))


@query("stream_event_counts", SQL["tumbling_event_counts"])
def _(spark, d):
    return stream.ran(stream.tumbling_counts(stream.table_stream(spark, d, "events")), "events")


@query("stream_scored_pairs", SQL["route_good_bad"])
def _(spark, d):
    pairs = stream.table_stream(spark, d, "documents").selectExpr(*QA)
    return stream.ran(stream.scored(pairs, RULES).select("seq", "eval_score", "label"), "pairs", "append")


def _hits_sql(key: str, hours: int) -> str:
    """A key's entries are a chain of requests, each the first one at least the time to live after the last."""
    return f"""WITH RECURSIVE q AS (SELECT {key} AS k, ts FROM events), r AS (SELECT DISTINCT k, ts, ts + INTERVAL {hours} HOUR AS till FROM q),
    nx AS MATERIALIZED (SELECT a.k, a.ts, b.ts AS nxt FROM r a ASOF JOIN r b ON a.k = b.k AND a.till <= b.ts),
    e AS (SELECT k, min(ts) AS ts FROM r GROUP BY k UNION ALL SELECT e.k, nx.nxt FROM e JOIN nx ON nx.k = e.k AND nx.ts = e.ts)
    SELECT q.k AS cache_key, q.ts, e.ts IS NULL OR row_number() OVER (PARTITION BY q.k, q.ts) > 1 AS hit FROM q LEFT JOIN e ON e.k = q.k AND e.ts = q.ts"""


@query("stream_cache_hits", _hits_sql("user_id::VARCHAR", 1))
def _(spark, d):
    requests = stream.table_stream(spark, d, "events").select(F.col("user_id").cast("string").alias("cache_key"), "ts")
    return stream.ran(stream.cache_hits(requests), "cache", "append").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("cache_hits", _hits_sql("CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE user_id::VARCHAR END", 6))
def _(spark, d):
    """A third of all requests has one key."""
    key = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string"))
    return stream.cache_hits(table(spark, d, "events").select(key.alias("cache_key"), "ts"), "6 hours").withColumn("ts", F.col("ts").cast("timestamp_ntz"))



# Smaller pieces.
NAMES = [("d1", "Luật một"), ("d3", "Nghị định ba")]


@query("document_name_mapping", f"WITH {QA_SQL} SELECT DISTINCT source_doc, CASE WHEN contains(source_doc, 'd1') THEN 'Luật một' WHEN contains(source_doc, 'd3') THEN 'Nghị định ba' ELSE source_doc END AS name FROM qa")
def _(spark, d):
    from .sources.files import document_name

    return qa(spark, d).select("source_doc").distinct().withColumn("name", document_name("source_doc", NAMES))


TOPIC = "CASE event_type WHEN 'click' THEN 'bhyt' WHEN 'purchase' THEN 'bhtn' ELSE 'other' END"


@query("topic_prompt", f"SELECT DISTINCT event_type, CASE {TOPIC} WHEN 'bhyt' THEN {sq(X.TOPIC_PROMPTS['bhyt'].replace('{date}', '01/12/2025'))} WHEN 'bhtn' THEN {sq(X.TOPIC_PROMPTS['bhtn'].replace('{date}', '01/12/2025'))} ELSE {sq(X.TOPIC_PROMPTS['default'].replace('{date}', '01/12/2025'))} END AS prompt FROM events")
def _(spark, d):
    return table(spark, d, "events").select("event_type", export.topic_prompt(F.expr(TOPIC), "01/12/2025").alias("prompt")).distinct()


@query("prompt_render", f"WITH {META_SQL} SELECT seq, md5('Tạo 5 câu cho ' || coalesce(doc_number, '(Không xác định số hiệu)') || coalesce(' ngày ' || issued_date, '') || coalesce(' của ' || issued_by, '') || ': ' || file_name) AS prompt_md5 FROM m")
def _(spark, d):
    docs = metadata.extract_metadata(headed(spark, d)).select("seq", F.col("file_name").alias("content"), *[f"metadata.{f}" for f in ("doc_number", "issued_date", "issued_by")])
    return generate.prompts(docs, "Tạo {num_qa} câu cho {doc_number}: {content}").select("seq", F.md5("prompt").alias("prompt_md5"))


@query("recent_errors", "SELECT event_id, substring(props, 1, 200) AS message FROM events ORDER BY ts DESC LIMIT 50")
def _(spark, d):
    return report.recent_errors(table(spark, d, "events").select("event_id", "ts", F.col("props").alias("message"))).select("event_id", "message")


@query("applicable_laws", f"WITH {LAWS_SQL}, {DAYS_SQL} SELECT day, id, name FROM (SELECT DISTINCT day FROM ds), laws WHERE {IN_FORCE}")
def _(spark, d):
    return temporal.law_status_on(registry(spark), days(spark, d), "day").filter("status = 'active'").select("day", "id", "name")


@query("chunk_total", "SELECT count(*) AS chunks FROM (" + CHUNK_SQL + ")")
def _(spark, d):
    return chunk.chunk_total(table(spark, d, "documents"), name="doc_id", content="text", size=1200, overlap=100)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
