from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiforge.operators import chunk, regenerate, split


@given(st.text(alphabet="ab .\n?!", max_size=400), st.integers(5, 60), st.integers(0, 59))
@settings(max_examples=200, deadline=None)
def test_chunks_end_and_cover_the_text(text, size, overlap):
    spans = list(chunk.chunk_spans(text, size, min(overlap, size - 1)))
    assert all(a < z for a, z in spans)
    covered = set()
    for a, z in spans:
        covered.update(range(a, min(z, len(text))))
    assert covered == set(range(len(text)))


def test_boundaries():
    text = "A" * 60 + "\n\n" + "B" * 60
    assert chunk.chunk_text(text, 100, 0) == ["A" * 60, "B" * 60]
    assert chunk.chunk_text("x" * 40 + ". " + "y" * 80, 70, 0)[0] == "x" * 40 + "."
    assert chunk.chunk_text("  short  ", 100) == ["  short  "]
    assert chunk.chunk_text("", 10) == [] == chunk.chunk_text(None, 10)
    assert len(chunk.chunk_text("A" * 5000, 1000, 100)) == 6


def test_chunk_table(spark):
    df = spark.createDataFrame([("a", "x" * 250), ("b", None), ("c", "y")], "file_name string, content string")
    rows = chunk.chunked(df, size=100, overlap=20).collect()
    assert [(r.doc_name, r.chunk_id) for r in rows] == [("a", 0), ("a", 1), ("a", 2), ("c", 0)]


def many(spark, docs):
    return spark.range(docs * 3).select((F.col("id")).alias("seq"), F.concat(F.lit("d"), (F.col("id") % docs).cast("string")).alias("source_doc"))


def test_split_by_document(spark):
    for exact in (False, True):
        out = split.split_by_document(many(spark, 20), exact=exact)
        info = {r.split: (r.samples, r.documents) for r in split.split_info(out).collect()}
        assert info == {"train": (42, 14), "validation": (9, 3), "test": (9, 3)}
        assert {r.overlap for r in split.leakage(out).collect()} == {0}


def test_exact_split_follows_the_seeded_shuffle(spark):
    import random

    names = [f"d{k}" for k in range(20)]
    random.Random(42).shuffle(names)
    out = split.split_by_document(many(spark, 20), exact=True)
    assert {r.source_doc for r in out.filter("split = 'train'").collect()} == set(names[:14])


def test_few_documents(spark):
    assert {r.split for r in split.split_by_document(many(spark, 1)).collect()} == {"test"}
    assert split.thresholds(2) == (1, 1)
    assert split.split_by_document(many(spark, 1).limit(0)).count() == 0


def test_leakage_is_found(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "test"), ("b", "train"), ("c", "validation")], "source_doc string, split string")
    assert {r.pair: r.overlap for r in split.leakage(df).collect()} == {"train_validation": 0, "train_test": 1, "validation_test": 0}


def test_chunk_quality_and_joins(spark):
    rows = [("a", 0, "bad"), ("a", 0, "bad"), ("a", 1, "good"), ("a", 1, "bad"), ("a", 2, "good"), ("a", 2, "bad"), ("a", 2, "bad"), (None, None, "good")]
    df = spark.createDataFrame(rows, "source_doc string, chunk_id int, label string")
    got = {(r.source_doc, r.chunk_id): (r.needs_regenerate, r.reason) for r in regenerate.chunk_quality(df).collect()}
    assert got[("a", 0)] == (True, "Chỉ có 0 good Q&A (yêu cầu >= 1)")
    assert got[("a", 1)] == (False, "") and got[("", 0)] == (False, "")
    assert got[("a", 2)] == (True, "Tỷ lệ good chỉ 33.3% (yêu cầu >= 50%)")
    weak = regenerate.chunks_to_regenerate(df)
    assert regenerate.without_chunks(df, weak).count() == 3
    chunks = spark.createDataFrame([("a", k) for k in range(4)], "doc_name string, chunk_id int")
    assert sorted(r.chunk_id for r in regenerate.only_chunks(chunks, weak).collect()) == [0, 2]
    assert [r.chunk_id for r in regenerate.missing_chunks(chunks, df).collect()] == [3]
