"""The queries opN_<name> over the driver's tables, with production parameters, and DuckDB SQL where it can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, fim, langid, lexical, licenses, mixing, packing, secrets, simhash, token_store, tokens, topk, toxicity
from .common import WORD, crc_mod

BYTE_BPE = "byte_bpe_50k.json"


def vocabulary(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs, crc_mod(F.col("doc_id"), 3) != 1)
    out = langid.predict(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


#: A document is its directory's LICENSE if a statement makes up a good part of it: below so many words.
STATEMENT_WORDS = 200


def paths(docs: DataFrame) -> DataFrame:
    """doc_id, text and a path, which documents do not have: source/lang/<thousands>/<hundreds>/<tens>/doc_id.txt.

    A short text (below STATEMENT_WORDS words) that has a line on a licence stands as the file LICENSE-doc_id of one of the directories
    above it, by its id at the level of its source and language, of the thousand or of the hundred: so licences are inherited from
    near and far.
    """
    id_ = F.coalesce("doc_id", F.lit(0))
    level = [F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")), F.floor(id_ / 1000).cast("string"), F.floor(id_ / 100).cast("string"), F.floor(id_ / 10).cast("string")]
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("_"))
    text = F.coalesce("text", F.lit(""))
    stands = F.lower(text).rlike(r"licen[cs]e") & (F.regexp_count(text, F.lit(WORD)) < STATEMENT_WORDS)
    depth = F.pmod(F.crc32(name), F.lit(3))
    licence = F.when(depth == 0, F.concat_ws("/", *level[:2], F.concat(F.lit("LICENSE-"), name))).when(depth == 1, F.concat_ws("/", *level[:3], F.concat(F.lit("LICENSE-"), name))).otherwise(F.concat_ws("/", *level[:4], F.concat(F.lit("LICENSE-"), name)))
    return docs.select("doc_id", "text", F.when(stands, licence).otherwise(F.concat_ws("/", *level, F.concat(name, F.lit(".txt")))).alias("path"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(paths(table(spark, sf_dir, "documents")), id_col="doc_id")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("id"), 4) != 2)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = mixing.quality_weights(table(spark, sf_dir, "labels"))
    out = mixing.mix_counts(table(spark, sf_dir, "documents"), quality)
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_tokens(token_store.write_tokens(table(spark, sf_dir, "documents"), vocabulary()))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fim.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is an owner; its documents of one language are a repository."""
    docs = table(spark, sf_dir, "documents")
    out = secrets.secret_scan(docs, F.col("lang"), F.col("source"))
    found = F.col("found")
    kinds = [secrets.of_kind(found, k).alias(f"n_{k}") for k in secrets.KINDS[:3]]
    flags = [secrets.with_flag(found, k).alias(f"n_{k}") for k in ("live", "copied")]
    return out.select("doc_id", *kinds, F.sha2(secrets.joined(found, base_only=True), 256).alias("base_sha256"), secrets.joined(found).alias("spans"), *flags)


def queries() -> dict:
    return {
        "op1_language": op1,
        "op2_exact_dedup": op2,
        "op3_licenses": op3,
        "op4_source_mix": op4,
        "op5_toxicity": op5,
        "op6_token_files": op6,
        "op7_packing": op7,
        "op8_simhash": op8,
        "op9_token_counts": op9,
        "op10_top_k": op10,
        "op11_fill_in_middle": op11,
        "op12_lexical_search": op12,
        "op13_secrets": op13,
    }


OP2_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""

OP4_SQL = r"""
WITH RECURSIVE q AS (SELECT doc_id, CASE WHEN max(quality) >= 1 THEN 2.0 WHEN max(quality) >= 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS w FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source, length(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+')) AS size,
        -ln((('0x' || md5('7|' || coalesce(d.doc_id::VARCHAR, md5(coalesce(d.text, ''))))[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / coalesce(q.w, 1.0) AS key
      FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, CASE rk % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM r),
p AS (SELECT *, 1.5::DOUBLE * sum(source_size::DOUBLE) OVER () AS budget, sum(w) OVER () AS all_w,
        sum(cap) OVER o AS to_cap, sum(w) OVER o AS to_w FROM w WINDOW o AS (ORDER BY cap / w, rk ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, (budget - (to_cap - cap)) / (all_w - (to_w - w)) * w >= cap AS is_full FROM p),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE (budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) * w / sum(w) FILTER (NOT is_full) OVER () END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(2, floor(target / source_size)) ELSE 0 END::BIGINT AS epochs FROM t),
u AS (SELECT d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * copies)::BIGINT AS taken, copies
FROM (SELECT *, epochs + CASE WHEN rest > 0 AND upto - size / 2.0 <= rest THEN 1 ELSE 0 END AS copies FROM u)
"""

OP10_SQL = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS s FROM documents),
h AS (SELECT *, ('0x' || s[1:8])::BIGINT % (n + 1) AS c1, ('0x' || s[9:16])::BIGINT % (n + 1) AS c2, ('0x' || s[17:24])::BIGINT % 100 AS h3, ('0x' || s[25:32])::BIGINT % 100 AS h4 FROM d),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS z,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, z - a) AS mid, substring(t, z + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
b AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM benchmark),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d WHERE len(ts) > 0),
q AS (SELECT i, item_id, t, count(*)::BIGINT AS qtf FROM (SELECT i, item_id, unnest(ts) AS t FROM b) GROUP BY ALL),
p AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(ts)::BIGINT AS n, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY t, n_docs),
x AS (SELECT r, doc_id, t, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * n_docs) // n_terms))) AS impact FROM p, c),
s AS (SELECT i, item_id, r, doc_id, sum(qtf * w * impact)::BIGINT AS score FROM q JOIN x USING (t) JOIN w USING (t) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

#: Matches are put between two private-use marks, so that their places are the lengths of what stands before them.
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, source AS owner, lang AS repo FROM documents),
m AS (SELECT r, 'assign' AS kind, 0 AS o, regexp_replace(t, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', chr(57344) || '\0' || chr(57345) || '\2' || chr(57344), 'g') AS x FROM d
  UNION ALL SELECT r, 'access', 1, regexp_replace(t, 'AKIA[A-Z0-9]+', chr(57344) || '\0' || chr(57345) || '\0' || chr(57344), 'g') FROM d
  UNION ALL SELECT r, 'hex', 2, regexp_replace(t, '[0-9a-f]+', chr(57344) || '\0' || chr(57345) || '\0' || chr(57344), 'g') FROM d
  UNION ALL SELECT r, 'bare', 3, regexp_replace(t, '[A-Za-z0-9+/_-]{20,}', chr(57344) || '\0' || chr(57345) || '\0' || chr(57344), 'g') FROM d),
u AS (SELECT r, kind, o, unnest(string_split(x, chr(57344))) AS part, generate_subscripts(string_split(x, chr(57344)), 1) AS i FROM m),
w AS (SELECT r, kind, o, i, split_part(part, chr(57345), 1) AS whole, CASE WHEN contains(part, chr(57345)) THEN split_part(part, chr(57345), 2) END AS v FROM u),
s AS (SELECT *, coalesce(sum(length(whole)) OVER (PARTITION BY r, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a FROM w),
c AS (SELECT r, kind, o, a, a + length(whole) AS z, v,
        len(list_distinct(string_split(v, ''))) >= 8 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AS random
      FROM s WHERE v IS NOT NULL AND length(v) >= CASE kind WHEN 'assign' THEN 6 WHEN 'access' THEN 20 WHEN 'hex' THEN 24 ELSE 20 END),
e AS (SELECT * FROM c WHERE o < 3 OR random AND NOT EXISTS (SELECT 1 FROM c b WHERE b.r = c.r AND b.o < 3 AND b.a < c.z AND b.z > c.a)),
n AS (SELECT v, count(DISTINCT coalesce(owner, chr(1))) AS owners, count(DISTINCT (coalesce(owner, chr(1)), coalesce(repo, chr(1)))) AS repos FROM e JOIN d USING (r) GROUP BY v),
q AS (SELECT e.*, owners >= 3 OR repos >= 10 AS copied, random AND NOT (owners >= 3 OR repos >= 10) AS live FROM e JOIN n USING (v)),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, o) FILTER (o < 3) AS base, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, o) AS spans,
        count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied
      FROM q WHERE o < 3 OR live GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN g USING (r)
"""


def oracle_sql() -> dict:
    return {"op2_exact_dedup": OP2_SQL, "op4_source_mix": OP4_SQL, "op10_top_k": OP10_SQL, "op11_fill_in_middle": OP11_SQL, "op12_lexical_search": OP12_SQL, "op13_secrets": OP13_SQL}
