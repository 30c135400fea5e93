import random

import pytest
from pyspark.sql import functions as F

from lexiforge.operators import chunk


def text(seed, n, ends=("\n\n", ". ", ".\n", "? ", "! ")):
    rng, out, size = random.Random(seed), [], 0
    while size < n:
        out.append("w" * rng.randint(1, 12) + rng.choice([" "] * 6 + list(ends)))
        size += len(out[-1])
    return "".join(out)[:n]


def plain(rows, size, overlap):
    return sorted((d, k, c) for d, t in rows for k, c in enumerate(chunk.chunk_text(t, size, overlap)))


def got(df):
    return sorted((r.doc_name, r.chunk_id, r.content) for r in df.collect())


@pytest.mark.parametrize(("size", "overlap", "part"), [(100, 10, 250), (60, 0, 997), (50, 49, 120), (300, 40, 100)])
def test_parts_give_the_chunks_of_the_plain_walk(spark, size, overlap, part):
    rows = [(f"d{k}", text(k, 200 * k + 7)) for k in range(1, 14)]
    rows += [("none", None), ("empty", ""), ("blank", " " * 3000), ("same", "A" * 2500), ("late", "A" * 1500 + text(99, 1500)), ("é", "é日😀 " * 500), ("twice", text(5, 900)), ("twice2", text(5, 900)), ("gaps", ("x" + " " * 130 + "\n\n") * 20)]
    docs = spark.createDataFrame(rows, "file_name string, content string").withColumns({n: F.lit("z") for n in ("rid", "n", "k", "t", "from", "start")})
    assert got(chunk.chunked_parts(docs, size=size, overlap=overlap, huge=400, part=part, starts=3)) == plain(rows, size, overlap)


def test_a_text_of_ten_million_characters(spark):
    rows = [("huge", text(3, 10_000_000)), ("short", "one. two"), ("no ends", "b" * 1_100_000)]
    docs = spark.createDataFrame(rows, "file_name string, content string")
    found = chunk.chunked_parts(docs, size=3000, overlap=200)
    assert got(found) == plain(rows, 3000, 200)


def test_no_huge_documents(spark):
    docs = spark.createDataFrame([("a", "x. y"), ("b", None)], "file_name string, content string")
    assert got(chunk.chunked_parts(docs)) == [("a", 0, "x. y")]
    assert chunk.chunked_parts(docs.limit(0)).collect() == []
