import importlib

import pytest
from pyspark.sql import functions as F

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("d", [D, "/root/testdata/sf0.01"])
def test_stages_against_plain_versions(spark, d):
    """Every stage on all that its predecessor kept, row by row against a plain version of it."""
    import duckdb

    import corpus_pipeline as c
    from lexiforge.llm import common, toxicity
    from lexiforge.llm.queries import OP4_SQL

    from .test_exact_dedup import brute
    from .test_simhash import brute_components, brute_print

    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    kept = docs
    names = [n for n, _ in c.STAGES]
    assert names == ["toxicity", "exact dedup", "near dedup", "source mix", "packing"]
    for name, stage in c.STAGES:
        before = [(r.doc_id, r.text) for r in kept.collect()]
        out = common.written(stage(spark, kept, d), "t")
        after = sorted(r.doc_id for r in out.collect())
        if name != "packing":
            assert out.columns == docs.columns
            assert set(after) <= {i for i, _ in before}
        if name == "toxicity":
            model = toxicity.learn(docs, labels, common.crc_mod(F.col("id"), 4) != 2)
            assert after == sorted(i for i, t in before if model.score(t) < toxicity.THRESHOLD)
            assert d == D or len(after) < len(before)  # the smallest table has too few toxic rows to learn from
        if name == "exact dedup":
            assert after == sorted({k for _, k, *_ in brute(before)})
        if name == "near dedup":
            comp = brute_components([brute_print(t) for _, t in before])
            least = {}
            for (i, _), k in zip(before, comp, strict=True):
                least[k] = min(i, least.get(k, i))
            assert after == sorted(least.values())
        if name == "source mix":
            con = duckdb.connect()
            con.register("documents", kept.toPandas())
            con.register("labels", labels.toPandas())
            want = [i for i, n in con.execute(f"SELECT doc_id, copies FROM ({OP4_SQL})").fetchall() for _ in range(n)]
            assert after == sorted(want)
        if name == "packing":
            assert set(after) == {i for i, _ in before}
            assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
        kept = out
    assert c.run(spark, d).count() == kept.count()


def test_entry_lists_every_operator(spark):
    entry = importlib.import_module("__spark_entry__")
    q = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in q) == 1 for k in range(1, 14)) and "pipeline" in q
    assert set(entry.oracle_sql()) <= set(q)


def test_stages_take_odd_rows_and_empty_tables(spark, odd, empty):
    import corpus_pipeline as c

    for name, stage in c.STAGES:
        out = stage(spark, odd, D)
        assert {str(r.doc_id) for r in out.select("doc_id").collect()} <= {"1", "2", "3", "4", "5", "6", "7", "8", "None"}
        if name != "packing":
            assert out.columns == odd.columns
        assert stage(spark, empty, D).count() == 0
