"""Which chunks have to be generated again, and the joins on chunk keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["source_doc", "chunk_id"]


def _keyed(df: DataFrame) -> DataFrame:
    """Missing parts of a chunk key count as '' and 0."""
    source = F.coalesce(F.col("source_doc"), F.lit("")) if "source_doc" in df.columns else F.lit("")
    chunk = F.coalesce(F.col("chunk_id").cast("int"), F.lit(0)) if "chunk_id" in df.columns else F.lit(0)
    return df.withColumns({"source_doc": source, "chunk_id": chunk})


def chunk_quality(labelled: DataFrame, min_good_rate: float = 0.5, min_good_count: int = 1) -> DataFrame:
    """Per chunk: good_count, bad_count, total, good_rate, needs_regenerate, reason. labelled has label good or bad."""
    g = _keyed(labelled).groupBy(*KEY).agg(F.count_if(F.col("label") == "good").alias("good_count"), F.count_if(F.col("label") == "bad").alias("bad_count"))
    g = g.withColumn("total", F.col("good_count") + F.col("bad_count")).filter("total > 0").withColumn("good_rate", F.col("good_count") / F.col("total"))
    few = F.col("good_count") < min_good_count
    low = F.col("good_rate") < min_good_rate
    reason = F.when(few, F.concat(F.lit("Chỉ có "), F.col("good_count").cast("string"), F.lit(f" good Q&A (yêu cầu >= {min_good_count})"))).when(
        low, F.concat(F.lit("Tỷ lệ good chỉ "), F.format_string("%.1f", F.bround(F.col("good_rate") * 100, 1)), F.lit(f"% (yêu cầu >= {min_good_rate * 100:.0f}%)"))
    )
    return g.withColumns({"needs_regenerate": few | low, "reason": F.coalesce(reason, F.lit(""))})


def missing_chunks(all_chunks: DataFrame, qa: DataFrame) -> DataFrame:
    """Chunks of which there is no pair yet; the chunks' doc_name counts as their source_doc."""
    chunks = all_chunks if "source_doc" in all_chunks.columns else all_chunks.withColumnRenamed("doc_name", "source_doc")
    return _keyed(chunks).select(*KEY).join(_keyed(qa).select(*KEY), KEY, "left_anti").withColumn("reason", F.lit("Chưa được generate"))


def chunks_to_regenerate(labelled: DataFrame, all_chunks: DataFrame | None = None, **limits) -> DataFrame:
    bad = chunk_quality(labelled, **limits).filter("needs_regenerate").select(*KEY, "reason")
    return bad if all_chunks is None else bad.unionByName(missing_chunks(all_chunks, labelled))


def regenerate_stats(labelled: DataFrame, all_chunks: DataFrame | None = None, **limits) -> DataFrame:
    q = chunk_quality(labelled, **limits).agg(F.count("*").alias("total_chunks_analyzed"), F.count_if(~F.col("needs_regenerate")).alias("good_chunks"), F.count_if("needs_regenerate").alias("bad_chunks"))
    m = (missing_chunks(all_chunks, labelled) if all_chunks is not None else labelled.limit(0)).agg(F.count("*").alias("missing_chunks"))
    out = q.crossJoin(m).withColumn("chunks_to_regenerate", F.col("bad_chunks") + F.col("missing_chunks"))
    return out.withColumn("regenerate_rate", F.col("chunks_to_regenerate") / F.greatest(F.lit(1), F.col("total_chunks_analyzed")) * 100)


def only_chunks(chunks: DataFrame, wanted: DataFrame) -> DataFrame:
    """Chunks (doc_name, chunk_id) that are on the list."""
    w = wanted.select(F.col("source_doc").alias("_s"), F.col("chunk_id").alias("_c")).distinct()
    return chunks.join(w, chunks["doc_name"].eqNullSafe(w["_s"]) & chunks["chunk_id"].eqNullSafe(w["_c"]), "left_semi")


def without_chunks(qa: DataFrame, redone: DataFrame) -> DataFrame:
    """Pairs whose chunk is not generated again; null keys compare as equal."""
    w = redone.select(F.col("source_doc").alias("_s"), F.col("chunk_id").alias("_c")).distinct()
    return qa.join(w, qa["source_doc"].eqNullSafe(w["_s"]) & qa["chunk_id"].eqNullSafe(w["_c"]), "left_anti")
