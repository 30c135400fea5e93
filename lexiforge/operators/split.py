"""Train, validation and test by document, and leakage between them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_filled

SPLITS = ("train", "validation", "test")


def thresholds(n: int, train: float = 0.70, validation: float = 0.15) -> tuple[int, int]:
    """Places at which validation and test begin: int() of each share, the rest is test."""
    first = int(n * train)
    return first, first + int(n * validation)


def document_key(df: DataFrame):
    return first_filled(*[n for n in ("source_doc", "source", "doc_id", "document") if n in df.columns])


def split_by_document(df: DataFrame, train: float = 0.70, validation: float = 0.15, seed: int = 42, exact: bool = False, order: str = "seq", most: int = 1_000_000) -> DataFrame:
    """df with split. Documents are ranked by a hash of seed and name; exact ranks them as Python's seeded shuffle of the
    names in order of first appearance does: the distinct names then go to the driver, so more than `most` are an error."""
    df = df.withColumn("_doc", document_key(df).cast("string"))
    docs = df.groupBy("_doc").agg(F.min(order).alias("_first")) if order in df.columns else df.select("_doc").distinct().withColumn("_first", F.lit(0))
    if exact:
        if (n := docs.count()) > most:
            raise ValueError(f"{n} documents are too many for an exact shuffle; ranks by hash have no such bound")
        names = [r["_doc"] for r in docs.orderBy("_first", "_doc").select("_doc").collect()]
        random.Random(seed).shuffle(names)
        first, second = thresholds(len(names), train, validation)
        rows = [(n, "train" if k < first else "validation" if k < second else "test") for k, n in enumerate(names)]
        placed = df.sparkSession.createDataFrame(rows, "_doc string, split string")
    else:
        ranked = hash_ranks(docs.select("_doc"), seed)
        first, second = thresholds(docs.count(), train, validation)
        placed = ranked.select("_doc", F.when(F.col("_rank") < first, "train").when(F.col("_rank") < second, "validation").otherwise("test").alias("split"))
    return df.join(placed, "_doc").drop("_doc")


def hash_ranks(docs: DataFrame, seed: int) -> DataFrame:
    """_doc and _rank from 0 by md5(seed|name). Counts of the hash's first four digits are added up (65,536 rows), and each
    such bucket is ranked in its own task, so that no task holds all names."""
    hashed = docs.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), F.col("_doc")))).withColumn("_b", F.substring("_h", 1, 4))
    counts = hashed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = counts.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", "_doc")) - 1
    return hashed.withColumn("_in", inside).join(F.broadcast(before), "_b").select("_doc", (F.col("_before") + F.col("_in")).alias("_rank"))


def random_split(df: DataFrame, train: float = 0.8, validation: float = 0.1) -> DataFrame:
    """By row and without a seed, as the old export has it."""
    u = F.rand()
    return df.withColumn("_u", u).withColumn("split", F.when(F.col("_u") < train, "train").when(F.col("_u") < train + validation, "validation").otherwise("test")).drop("_u")


def split_documents(df: DataFrame) -> DataFrame:
    """split, document, samples."""
    return df.groupBy("split", document_key(df).cast("string").alias("document")).agg(F.count("*").alias("samples"))


def split_info(df: DataFrame, ids: bool = True) -> DataFrame:
    """split, samples, documents, and doc_ids (sorted), which for many documents split_documents has as a table."""
    by = split_documents(df)
    listed = [F.array_sort(F.collect_list("document")).alias("doc_ids")] if ids else []
    return by.groupBy("split").agg(F.sum("samples").alias("samples"), F.count("*").alias("documents"), *listed)


def leakage(df: DataFrame) -> DataFrame:
    """pair, overlap: documents that two splits share, for each of the three pairs."""
    doc = document_key(df).cast("string")
    sides = df.groupBy(doc.alias("_doc")).agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in SPLITS])
    counts = sides.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).alias(f"{a}_{b}") for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))])
    pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in counts.columns]), F.array(*[F.col(c) for c in counts.columns])))
    return counts.select(pairs.alias("pair", "overlap"))
