import random

import pytest
from pyspark.sql import functions as F

from lexiforge.llm import common, exact_dedup, simhash


@pytest.mark.parametrize("bits", [1 << 28, 64])
def test_keys_by_broadcast_and_by_filter_agree(spark, monkeypatch, bits):
    """With 64 bits nearly every row is taken for one of the keys, and the answer is the same."""
    rng = random.Random(1)
    rows = [(None if k % 13 == 0 else k % 40, None if k % 17 == 0 else f"h{k % 7}", f"text {k}") for k in range(600)]
    wide = spark.createDataFrame(rows, "a long, b string, t string")
    some = {(r[0], r[1]) for r in rng.sample(rows, 90)} | {(9999, "x")}
    keys = spark.createDataFrame(sorted(some, key=str), "k long, l string")
    own = [F.col("a"), F.col("b")]
    monkeypatch.setattr(common, "FILTER_BITS", bits)
    for limit in (common.BROADCAST_BYTES, -1):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        for without in (False, True):
            got = sorted((tuple(r) for r in common.having(wide, keys, own, len(some), 40, without).collect()), key=str)
            assert got == sorted((r for r in rows if ((r[0], r[1]) in some) != without), key=str)


def test_rows_that_stay_are_not_shuffled(spark, monkeypatch):
    """Of 4,000 rows 40 are dropped: the join beside the filter reads little more than these."""
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    wide = spark.range(4000).select(F.col("id").alias("a"), F.lit("text").alias("t"))
    keys = common.cut(spark.range(0, 4000, 100).select(F.col("id").alias("k")))
    marked, hit = common.may_hold(wide, keys, [F.col("a")])
    assert 40 <= marked.filter(hit).count() <= 42
    assert common.having(wide, keys, [F.col("a")], 40, 8, without=True).count() == 3960


def test_stages_agree_where_dropped_keys_are_many(odd, sample, monkeypatch):
    wide = sample.unionByName(sample.filter("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 10_000)).unionByName(odd.select(*sample.columns) if set(sample.columns) <= set(odd.columns) else odd.select("doc_id", "text", "lang", "source").withColumn("n_chars", F.lit(1).cast("long")))
    key = lambda df: sorted((str(r.doc_id), r.text or "") for r in df.collect())
    for stage in (exact_dedup.drop_copies, simhash.drop_near_copies):
        want = key(stage(wide))
        with monkeypatch.context() as m:
            m.setattr(common, "BROADCAST_BYTES", -1)
            assert key(stage(wide)) == want
