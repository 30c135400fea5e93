"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into 1, 2, 4, ... segments. With segment means m and deviations s, the inner product of a segment of n
components is at most n * (m_q * m_x + s_q * s_x), so a coarse level bounds the score of a candidate from above.

Candidates are dealt to leaves of a k-d tree over their segment means; a leaf keeps the box of its means and its greatest
deviations, which bound the scores of all its rows at once. A query first meets a part of its best leaf, which gives it a
lower bound of its k-th best score, and then the parts of those leaves only whose bound reaches that; other vectors do
not move. Inside a task the bounds go from coarse to fine over the candidates, and survivors get exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, col, cut, release, small, written

SCALE = 256
#: Queries that meet a part in one task; rows of a part, at least (where that makes more tasks) and at most; rows of one step.
QUERIES, LEAST, GROUP, CANDIDATES = 4096, 1024, 65_536, 4096
LEVELS = 4
#: Vectors that the tree is fitted on, at most, and those of one of its leaves.
SAMPLE, LEAF = 16_384, 16
EXACT = 2**53
#: Scores beyond it are clipped; the negative of either end is a long too.
MOST = 2**63 - 1


def segments(x: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the means and deviations of 2**level segments, and the segments' lengths."""
    edges = np.unique(np.linspace(0, x.shape[1], min(2**level, x.shape[1]) + 1).astype(int))
    n = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / n
    deviation = np.sqrt(np.maximum(np.add.reduceat(x * x, edges[:-1], axis=1) / n - mean * mean, 0))
    return mean, deviation, n


def best_of(queries: np.ndarray, query_ids: np.ndarray, xs: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray, levels: int = LEVELS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's index, candidates' indexes, exact scores) of those that may be among the k best; floor: lower bounds of the k-th score.

    Scores are exact where |score| < 2**53; larger ones go through Python integers.
    """
    q_s, x_s = [segments(queries, level) for level in range(levels)], [segments(xs, level) for level in range(levels)]
    big = float(np.abs(queries).max(initial=0)) * float(np.abs(xs).max(initial=0)) * queries.shape[1] >= EXACT
    slack = 1e-9 * np.abs(queries).sum(axis=1) * float(np.abs(xs).max(initial=0)) + 1e-6
    bounds = [np.hstack([m * n, d * n]) @ np.hstack([x_s[level][0], x_s[level][1]]).T for level, (m, d, n) in enumerate(q_s[:1])]
    for i in range(len(queries)):
        alive = np.flatnonzero((bounds[0][i] + slack[i] >= floor[i]) & (ids != query_ids[i]))
        for level in range(1, levels):
            if len(alive) <= k or floor[i] == -np.inf:
                break
            m, d, n = q_s[level]
            bound = x_s[level][0][alive] @ (m[i] * n) + x_s[level][1][alive] @ (d[i] * n)
            alive = alive[bound + slack[i] >= floor[i]]
        if not len(alive):
            continue
        if big:
            own = [int(v) for v in queries[i]]
            score = np.array([sum(a * int(v) for a, v in zip(own, xs[j], strict=True)) for j in alive], object)
            score = np.array([min(max(s, -MOST), MOST) for s in score], np.int64)
        else:
            score = (xs[alive] @ queries[i]).astype(np.int64)
        if len(alive) > k:
            order = np.lexsort((ids[alive], -score))[:k]
            alive, score = alive[order], score[order]
        yield i, alive, score


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, x (as doubles), n (components), for vectors without null or non-finite components."""
    v = col(vectors, vector_col).cast("array<double>")
    x = vectors.select(col(vectors, id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null")
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return x.filter(F.coalesce(finite, F.lit(False))).select("id", F.col("v").alias("x"), F.size("v").alias("n"))


def rectangular(x, sizes: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Number of components -> the rows that have so many, and their vectors; x: an Arrow column of lists."""
    flat = x.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    return {int(n): (np.flatnonzero(sizes == n), flat[starts[sizes == n][:, None] + np.arange(n)[None, :]]) for n in np.unique(sizes)}


class Tree:
    """A k-d tree over the segment means of vectors of one number of components; others have one leaf."""

    def __init__(self, sample: list[np.ndarray], depth: int):
        sizes = np.array([len(x) for x in sample])
        self.n = int(np.bincount(sizes).argmax()) if len(sizes) else 0
        self.axes, self.cuts = [], []
        means = segments(np.array([x for x in sample if len(x) == self.n]), LEVELS - 1)[0] if self.n else np.empty((0, 0))
        node = np.zeros(len(means), np.int64)
        for level in range(depth if len(means) else 0):
            axes, cuts = np.zeros(2**level, np.int64), np.zeros(2**level)
            for k in range(2**level):
                own = means[node == k]
                if len(own):
                    axes[k] = int(own.var(axis=0).argmax())
                    cuts[k] = np.median(own[:, axes[k]])
            self.axes.append(axes)
            self.cuts.append(cuts)
            node = self._down(node, means, level)

    def _down(self, node: np.ndarray, means: np.ndarray, level: int) -> np.ndarray:
        return 2 * node + (means[np.arange(len(node)), self.axes[level][node]] > self.cuts[level][node])

    def leaf(self, means: np.ndarray, n: int) -> np.ndarray:
        node = np.zeros(len(means), np.int64)
        for level in range(len(self.axes) if n == self.n else 0):
            node = self._down(node, means, level)
        return node


class Boxes:
    """Per number of components the leaves, with the least and greatest means and the greatest deviations of their segments, and their parts."""

    def __init__(self, rows: list, each: int):
        """rows: n, leaf, rows, lo, hi, dev of all leaves; a leaf has parts of about `each` rows."""
        self.of: dict[int, tuple[np.ndarray, ...]] = {}
        self.parts, total = [], 0
        by: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: (r.n, r.leaf)):
            parts = -(-r.rows // each)
            self.parts.append((r.n, r.leaf, total, parts))
            by.setdefault(r.n, []).append((total, parts, r.lo, r.hi, r.dev))
            total += parts
        for n, own in by.items():
            first, parts, lo, hi, dev = zip(*own, strict=True)
            width = min(2 ** (LEVELS - 1), n)
            self.of[n] = (np.array(first), np.array(parts), *(np.array([x[:width] for x in m], float).reshape(len(own), width) for m in (lo, hi, dev)))
        self.total = total

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Of each query and leaf: no row of the leaf scores more."""
        _, _, lo, hi, dev = self.of[x.shape[1]]
        m, d, n = segments(x, LEVELS - 1) if x.shape[1] else (np.zeros((len(x), 0)),) * 3
        m, d = m * n, d * n
        return np.maximum(m, 0) @ hi.T + np.minimum(m, 0) @ lo.T + d @ dev.T


def visits(asked: DataFrame, boxes: Boxes, first: bool) -> DataFrame:
    """id, n, x, floor, parts: a part of the query's best leaf (first), or all other parts whose leaf's bound reaches its floor.

    asked: id, n, x, floor (null: any row may still be among the k best).
    """
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            parts: list[np.ndarray] = [np.empty(0, np.int64)] * b.num_rows
            floors = b.column("floor").to_numpy(zero_copy_only=False).astype(float)
            ids = b.column("id").to_numpy()
            for n, (rows, x) in rectangular(b.column("x"), b.column("n").to_numpy()).items():
                starts, counts = boxes.of[n][:2]
                bounds = boxes.bounds(x)
                slack = 1e-9 * np.abs(bounds) + 1e-6
                for k, row in enumerate(rows):
                    best = int(bounds[k].argmax())
                    own = int(starts[best] + ids[row] % counts[best])
                    if first:
                        parts[row] = np.array([own])
                        continue
                    floor = -np.inf if np.isnan(floors[row]) else floors[row]
                    some = np.flatnonzero(bounds[k] + slack[k] + 1e-9 * abs(floor) >= floor)
                    every = np.concatenate([np.arange(starts[j], starts[j] + counts[j]) for j in some]) if len(some) else parts[row]
                    parts[row] = every[every != own]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(parts, pa.list_(pa.int64()))], names=[*b.schema.names, "parts"])

    return asked.select("id", "n", "x", "floor").mapInArrow(run, "id long, n int, x array<double>, floor long, parts array<long>")


def met(asked: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: of each query and part that it visits the k best rows of at least its floor.

    asked: as of visits; rows: id, n, x, part. A part is copied once for each QUERIES queries that visit it; parts that no query
    visits do not move.
    """
    import pyarrow as pa

    asked = written(asked.filter(F.size("parts") > 0), "top-k-visits")
    counts = cut(asked.select(F.explode("parts").alias("part")).groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks")))
    near = small(counts, counts.count(), 16)
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    left = asked.select("id", "x", "n", "floor", F.explode("parts").alias("part")).join(near, "part").withColumn("block", block).drop("blocks")
    right = rows.select("id", "x", "n", "part").join(near, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")

    def matrices(t: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Number of components -> places of the rows and vectors."""
        return rectangular(t["x"].combine_chunks(), t["n"].to_numpy())

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        found = matrices(right)
        known, asking, floors = right["id"].to_numpy(), left["id"].to_numpy(), left["floor"].to_numpy().astype(float)
        for n, (places, x) in matrices(left).items():
            if n not in found:
                continue
            ids, every, xs = asking[places], known[found[n][0]], found[n][1]
            best: list[list] = [[] for _ in ids]
            floor = np.where(np.isnan(floors[places]), -np.inf, floors[places])
            for a in range(0, len(every), CANDIDATES):
                part = every[a : a + CANDIDATES]
                for i, alive, score in best_of(x, ids, xs[a : a + CANDIDATES], part, k, floor):
                    best[i] = sorted([*best[i], *zip((-score).tolist(), part[alive].tolist(), strict=True)])[:k]
                    if len(best[i]) == k:
                        floor[i] = max(floor[i], -best[i][-1][0])
            out += [(q, v, -s) for q, pairs in zip(ids.tolist(), best, strict=True) for s, v in pairs]
        q, v, s = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.int64())})

    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(meet, "query_id long, vec_id long, score long")


def dealt(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, Boxes]:
    """id, n, x (components times SCALE, rounded down), part of all usable vectors, and the leaves' boxes."""
    import pyarrow as pa

    spark = vectors.sparkSession
    raw = usable(vectors, id_col, vector_col)
    total = vectors.count()
    some = raw.orderBy(F.xxhash64("id", "x"), "id").limit(SAMPLE).select("x").toArrow()["x"]
    depth = int(np.log2(max(1, min(total // LEAST, SAMPLE // LEAF))))
    tree = Tree([np.floor(SCALE * x.values.to_numpy()) for x in some], depth)
    width = 2 ** (LEVELS - 1)

    def route(batches: Iterator) -> Iterator:
        for b in batches:
            sizes, x = b.column("n").to_numpy(), b.column("x")
            leaf, means, devs = np.zeros(len(sizes), np.int64), [None] * len(sizes), [None] * len(sizes)
            for n, (rows, flat) in rectangular(x, sizes).items():
                m, d, _ = segments(np.floor(SCALE * flat), LEVELS - 1) if n else (np.zeros((len(rows), 0)),) * 3
                leaf[rows] = tree.leaf(m, n)
                for k, row in enumerate(rows):
                    means[row], devs[row] = m[k], d[k]
            floored = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(np.floor(SCALE * x.flatten().to_numpy(zero_copy_only=False))))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n"), floored, pa.array(leaf, pa.int32()), pa.array(means, pa.list_(pa.float64())), pa.array(devs, pa.list_(pa.float64()))], names=["id", "n", "x", "leaf", "means", "devs"])
        release()

    rows = written(raw.select("id", "n", "x").mapInArrow(route, "id long, n int, x array<double>, leaf int, means array<double>, devs array<double>").withColumn("place", F.monotonically_increasing_id()), "top-k")
    of = lambda f, c: F.array(*[f(F.get(c, F.lit(j))) for j in range(width)])
    # One row for each leaf and number of components.
    boxes = rows.groupBy("n", "leaf").agg(F.count("*").alias("rows"), of(F.min, "means").alias("lo"), of(F.max, "means").alias("hi"), of(F.max, "devs").alias("dev")).collect()
    boxes = Boxes(boxes, max(LEAST, min(GROUP, 2 * total // 2**depth)))
    parts = spark.createDataFrame(boxes.parts, "n int, leaf int, first long, parts long")
    placed = rows.join(F.broadcast(parts), ["n", "leaf"]) if 24 * len(boxes.parts) <= BROADCAST_BYTES else rows.join(parts, ["n", "leaf"])
    return placed.select("id", "n", "x", (F.col("first") + F.pmod(F.xxhash64("place"), F.col("parts"))).alias("part")), boxes


def top_k(vectors: DataFrame, queries: Column | str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each query row its k best other rows by integer inner product, ties to smaller ids.

    queries: a condition on the column id. Rows with a null id, and vectors that are null or hold null or non-finite
    components, take no part; vectors of another number of components than the query's are no candidates of it. Rows
    repeated under one id are candidates each; a query id that is repeated counts once, with its least vector. Other
    columns are ignored. Scores beyond a long are clipped to it. Each query and part that it visits leave k rows, of which a
    window keeps the best.
    """
    rows, boxes = dealt(vectors, id_col, vector_col)
    none = F.lit(None).cast("long")
    asked = cut(rows.filter(queries).groupBy("id").agg(F.min("x").alias("x")).select("id", F.size("x").alias("n"), "x"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = ranked(met(visits(asked.withColumn("floor", none), boxes, True), rows, k))
    if max((int(parts.sum()) for _, parts, *_ in boxes.of.values()), default=0) <= 1:  # every query has met all rows
        return found.select("query_id", "rank", "vec_id", "score")
    found = cut(found)
    floors = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = met(visits(asked.join(floors, "id", "left"), boxes, False), rows, k)
    return ranked(rest.unionByName(found.drop("rank"))).select("query_id", "rank", "vec_id", "score")
