import math

import numpy as np
from pyspark.sql import functions as F

from lexiforge.llm import topk


def brute(rows, every, k=5):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in good:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(y) == len(x))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def got(df, every, k=5):
    return sorted(map(tuple, topk.top_k(df, F.col("id") % every == 0, k).collect()))


def test_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df, 50) == brute(rows, 50)


def test_small_blocks_and_levels(spark, monkeypatch):
    """Several blocks of queries, groups of candidates and steps of a group; some pairs have no candidate."""
    for name, size in (("QUERIES", 3), ("GROUP", 7), ("LEAST", 1), ("CANDIDATES", 2)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=7)]) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df, 7) == brute(rows, 7)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (None, [1.0, 1.0]), (6, []), (7, [1.0]), (8, [-1.0, 0.5]), (20, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({n: F.lit(1) for n in ("id", "x", "n", "score", "rank", "block")})
    assert got(df, 10) == brute(rows, 10)
    assert got(df.limit(0), 10) == []


def test_no_queries_and_one_hot_id(spark):
    rows = [(k, [float(k), 1.0]) for k in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, 100) == []  # candidates, but no query
    hot = spark.createDataFrame([(50, [1.0, 1.0])] + [(7, [2.0, float(k % 3)]) for k in range(60)], "vec_id long, embedding array<double>")
    assert got(hot, 50) == [(50, n + 1, 7, 65536 * 4) for n in range(5)]


def test_huge_components(spark):
    rows = [(k, [float(2**40 + k), -3.0 * k]) for k in range(0, 30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [(q, r, i, min(max(s, -(2**63)), 2**63 - 1)) for q, r, i, s in brute(rows, 10)]
    assert [x[3] for x in got(df, 10)] == [x[3] for x in want]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, x = rng.normal(size=(5, 13)), rng.normal(size=(40, 13))
    for level in range(4):
        (mq, sq, n), (mx, sx, _) = topk.segments(q, level), topk.segments(x, level)
        assert ((mq * n) @ mx.T + (sq * n) @ sx.T + 1e-9 >= q @ x.T).all()


def test_scores_at_the_ends_of_a_long(spark):
    """A clipped lowest score stays the lowest: its negative is a long too."""
    big = float(2**30)
    rows = [(0, [big, big]), (1, [big, big]), (2, [-big, -big]), (3, [0.0, 0.0]), (4, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [(q, r, i, min(max(s, -topk.MOST), topk.MOST)) for q, r, i, s in brute(rows, 10)]
    out = got(df, 10)
    assert out == want and out[0][3] == 2**63 - 1 and out[-1][3] == -(2**63) + 1 and topk.MOST == -np.int64(-topk.MOST)


def test_only_parts_within_the_bounds_move(spark, monkeypatch):
    """Smooth vectors of ten directions: after its first part a query visits few others, and the answer is exact."""
    for name, size in (("QUERIES", 5), ("LEAST", 20), ("GROUP", 20), ("CANDIDATES", 7)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(size=(10, 8)), 4, axis=1)
    rows = [(k, [float(x) for x in centres[k % 10] + 0.02 * rng.normal(size=32)]) for k in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    moved, plain = [], topk.met
    monkeypatch.setattr(topk, "met", lambda asked, rows, k: (moved.append(asked.agg(F.sum(F.size("parts"))).first()[0] or 0), plain(asked, rows, k))[1])
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df, 30) == brute(rows, 30)
    _, boxes = topk.dealt(df, "vec_id", "embedding")
    assert boxes.total >= 20 and moved[0] == 20 and moved[1] < 0.5 * 20 * boxes.total


def test_boxes_hold():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(300, 19)) * 100, rng.normal(size=(7, 19)) * 100
    tree = topk.Tree(list(x[:80]), 3)
    means, devs, _ = topk.segments(x, 3)
    leaf = tree.leaf(means, 19)
    assert len(set(leaf.tolist())) > 4

    class Row:
        def __init__(self, k):
            own = leaf == k
            self.n, self.leaf, self.rows = 19, int(k), int(own.sum())
            self.lo, self.hi, self.dev = means[own].min(0), means[own].max(0), devs[own].max(0)

    kinds = sorted(set(leaf.tolist()))
    bounds = topk.Boxes([Row(k) for k in kinds], 10).bounds(q)
    for j, k in enumerate(kinds):
        assert ((q @ x[leaf == k].T).max(axis=1) <= bounds[:, j] + 1e-6).all()
