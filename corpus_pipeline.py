"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing and packing, each stage over all that the last one kept.

Every stage is a function of (spark, docs, sf_dir). Its result is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiforge.llm import common, exact_dedup, mixing, packing, simhash, toxicity
from lexiforge.llm.queries import table, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity model does not reject; it learns from `labels`."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), common.crc_mod(F.col("id"), 4) != 2)
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    quality = mixing.quality_weights(table(spark, sf_dir, "labels"))
    mixed = mixing.mix_sources(docs, quality).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as packed sequences; a document that was taken twice is packed twice."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix),
    ("packing", pack),
]

#: Learned scores and a genetic algorithm have no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = common.written_at(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if last:  # nothing reads the stage before any more
            common.remove(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
