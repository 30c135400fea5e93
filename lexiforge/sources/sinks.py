"""Sinks: what each stage leaves, as committed folders of JSON lines or Parquet under one output folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import export, report, split, temporal
from . import files
from .storage import exists


def _json(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (w.partitionBy(by) if by else w).json(path)


def write_evaluated(labelled: DataFrame, out: str) -> None:
    """Good and bad pairs by label, and their counts."""
    _json(labelled, f"{out}/evaluated", "label")
    _json(report.evaluation_stats(labelled), f"{out}/evaluation_stats")


def write_duplicates(duplicates: DataFrame, out: str) -> None:
    _json(duplicates, f"{out}/qa_duplicates")


def write_generated(pairs: DataFrame, failed: DataFrame, out: str) -> None:
    _json(pairs, f"{out}/qa_generated")
    _json(failed, f"{out}/failed_chunks")


def write_rescued(rescued: DataFrame, still_bad: DataFrame, out: str) -> None:
    _json(rescued, f"{out}/qa_rescued")
    _json(still_bad, f"{out}/qa_still_bad")


def read_rescued(spark, out: str) -> DataFrame:
    """The rescued pairs of an earlier run; none where there was no such run."""
    return files.read_jsonl(spark, f"{out}/qa_rescued", files.QA) if exists(spark, f"{out}/qa_rescued") else spark.createDataFrame([], files.QA)


def write_legacy(good: DataFrame, out: str, kind: str = "instruction") -> None:
    """Good pairs as instructions or chats, split by row at random and without a seed."""
    _json(export.formatted(split.random_split(good), kind, keep=("split",)), f"{out}/legacy_{kind}", "split")


def write_final(merged: DataFrame, out: str, formats: tuple[str, ...] = ("json", "jsonl")) -> None:
    """All splits together, as JSON arrays and as JSON lines."""
    for name, write in (("json", files.write_json), ("jsonl", files.write_jsonl)):
        if name in formats:
            write(merged, f"{out}/dataset_final_{name}")


def write_regenerate_list(chunks: DataFrame, out: str) -> None:
    _json(chunks, f"{out}/chunks_to_regenerate")


def write_splits(df: DataFrame, out: str) -> None:
    """Splits by folder (those of an earlier run go), their counts and their overlaps."""
    _json(df, f"{out}/splits", "split")
    _json(split.split_info(df, ids=False), f"{out}/split_info")
    _json(split.split_documents(df), f"{out}/split_documents")
    _json(split.leakage(df), f"{out}/leakage")


def write_validated(checked: DataFrame, out: str) -> None:
    """Valid pairs with and without private columns, invalid ones, and the counts."""
    valid = F.col("_validation.is_valid")
    _json(checked.filter(valid), f"{out}/valid")
    _json(temporal.without_private(checked.filter(valid)), f"{out}/clean")
    _json(checked.filter(~valid), f"{out}/invalid")
    _json(temporal.validity_stats(checked), f"{out}/validation_stats")
    _json(temporal.law_usage(checked), f"{out}/law_usage")


def write_tokens(tokens: DataFrame, out: str) -> None:
    tokens.write.mode("overwrite").parquet(f"{out}/tokenized")


def write_reviews(reviewed: DataFrame, out: str) -> None:
    _json(reviewed, f"{out}/reviewed", "review_status")


def write_filtered(kept: DataFrame, removed: DataFrame, out: str) -> None:
    """Kept and removed pairs side by side; the input stays as it is."""
    _json(kept, f"{out}/kept")
    _json(removed, f"{out}/removed")


def append_status(spark, out: str, step: str, processed: int, total: int, batch: int | None = None) -> bool:
    """Puts a stage's row into the live status; a batch that was put before changes nothing."""
    from ..plans.monitor import Monitor

    return Monitor(spark, out, "status")._put(step, "running", processed, total, batch)


def status(spark, out: str) -> DataFrame:
    """step, processed, total, percent: the live status, or what the stages' tables hold where there is none."""
    if latest_status(spark, out) is not None:
        return latest_status(spark, out)
    rows = [(name, spark.read.parquet(f"{out}/{name}").count()) for name in ("extract", "generate", "evaluate", "split") if exists(spark, f"{out}/{name}")]
    return spark.createDataFrame([(n, c, c, 100.0) for n, c in rows], "step string, processed long, total long, percent double")


def latest_status(spark, out: str) -> DataFrame | None:
    """The live rows with their state and counters; None where nobody has put any."""
    from ..plans.monitor import status_table

    live = status_table(spark, out).read()
    return None if live is None else live.withColumn("percent", F.col("processed") / F.greatest(F.lit(1), F.col("total")) * 100)
