"""SimHash near-dedup with BK-trees.

Fingerprints of whole texts are made in Arrow batches. Distinct fingerprints are dealt to shards by the values of all
but `radius` of their bit blocks: two fingerprints that differ in at most `radius` bits agree in some such choice of
blocks, so each link lies inside a shard. Every shard is a BK-tree (children keyed by the Hamming distance to their
parent, only edges within the radius followed) that its task builds and searches; a shard leaves one edge per member to
its component's root and never all pairs. Shard trees travel to their queries by a shuffle, not by a broadcast, because
their size grows with the corpus. Edges of all shards meet in a distributed star contraction.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, cut, having, release, salted_join, written

BITS = 64
WORDS, RADIUS, SEED = 4, 4, 42
#: Bit blocks; each shard key fixes BLOCKS - RADIUS of them.
BLOCKS = 6
#: Largest number of fingerprints that one task holds of a shard; larger shards are split into pairs of parts.
PART = 20_000
LEAF = 64


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text's word shingles (see op8's contract); 0 for a text without words."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    count = max(1, len(found) - words + 1)
    total, h64 = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, count, 65536):  # a long text goes by in blocks
        part = found[at : min(count, at + 65536) + words - 1]
        line, ends, n = b" ".join(part), [], 0
        for w in part:
            n += len(w) + 1
            ends.append(n)
        if count == 1:
            hashes = [h64(line, seed)]
        else:
            hashes = [h64(line[a : b - 1], seed) for a, b in zip([0, *ends], ends[words - 1 :], strict=False)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        for k in range(0, len(bits), 255):  # sums of at most 255 ones fit a byte
            total += bits[k : k + 255].sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * total > count, bitorder="little").tobytes(), "little")


def text_hash(text: Column) -> Column:
    """The md5 of a text; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED, hashed: bool = False) -> DataFrame:
    """id, fp (the fingerprint as a signed long) of every row; h (text_hash), too, where hashed."""
    import pyarrow as pa

    names = ["id", "fp", *["h"] * hashed]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            got = np.array([fingerprint(t.as_py(), words, seed) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got), *b.columns[2:]], names=names)
        release()

    text = col(docs, text_col)
    ids = docs.select(col(docs, id_col).alias("id"), text.alias("t"), *[text_hash(text).alias("h")] * hashed)
    return ids.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, fp long" + ", h string" * hashed)


class BKTree:
    """A BK-tree over distinct 64-bit numbers, by index; up to LEAF of them stay together in a leaf and are compared at once."""

    def __init__(self, numbers: np.ndarray, leaf: int = LEAF):
        self.numbers = numbers
        self.root = self._grow(np.arange(len(numbers)), leaf)

    def _grow(self, own: np.ndarray, leaf: int):
        if len(own) <= leaf:
            return own
        pivot, rest = own[0], own[1:]
        far = np.bitwise_count(self.numbers[rest] ^ self.numbers[pivot])
        return pivot, {int(k): self._grow(rest[far == k], leaf) for k in np.unique(far)}

    def near(self, queries: np.ndarray, radius: int, alive: np.ndarray) -> np.ndarray:
        """Indexes among alive of all numbers within the radius of any of the queries (numbers themselves)."""
        hit = np.zeros(len(self.numbers), bool)
        todo = [(self.root, queries)]
        while todo:
            node, asked = todo.pop()
            if isinstance(node, np.ndarray):
                node = node[alive[node] & ~hit[node]]
                for at in range(0, len(asked), 4096):
                    if not len(node):
                        break
                    close = (np.bitwise_count(asked[at : at + 4096, None] ^ self.numbers[node][None, :]) <= radius).any(axis=0)
                    hit[node[close]] = True
                    node = node[~close]
                continue
            pivot, children = node
            far = np.bitwise_count(asked ^ self.numbers[pivot]).astype(int)
            if alive[pivot] and (far <= radius).any():
                hit[pivot] = True
            for key, child in children.items():
                if (inside := np.abs(far - key) <= radius).any():
                    todo.append((child, asked[inside]))
        return np.flatnonzero(hit)


def components(numbers: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each of distinct 64-bit numbers the index of its component's first member: breadth-first searches of a BK-tree."""
    n = len(numbers)
    root, alive = np.full(n, -1), np.ones(n, bool)
    tree = BKTree(numbers)
    for start in range(n):
        if not alive[start]:
            continue
        front = np.array([start])
        while len(front):
            root[front] = start
            alive[front] = False
            front = tree.near(numbers[front], radius, alive)
    return root


def _shard_keys(fp, blocks: int, radius: int) -> list:
    """One long per choice of blocks - radius blocks: the choice's number above its blocks' bits."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for no, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = 0
        for b in chosen:
            mask |= ((1 << cuts[b + 1]) - 1) ^ ((1 << cuts[b]) - 1)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(no).alias("choice"), fp.bitwiseAND(F.lit(signed)).alias("bits")))
    return keys


def _shard_edges(batches: Iterator, radius: int) -> Iterator:
    """Sorted rows (shard columns, fp) -> (fp, root) for members of a shard that are linked to another."""
    import pyarrow as pa

    def of(run: np.ndarray):
        if len(run) > 1:
            root = components(run.view(np.uint64), radius)
            other = np.flatnonzero(root != np.arange(len(run)))
            return run[other], run[root[other]]
        return run[:0], run[:0]

    held_key, held = None, np.empty(0, np.int64)
    for b in batches:
        key = np.stack([b.column(i).to_numpy() for i in range(4)], axis=1)
        fp = b.column(4).to_numpy()
        if held_key is not None:
            key = np.concatenate([np.repeat(held_key[None], len(held), axis=0), key])
            fp = np.concatenate([held, fp])
        if not len(fp):
            continue
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        ends = np.r_[starts[1:], len(fp)]
        whole = [of(fp[a:z]) for a, z in zip(starts[:-1], ends[:-1], strict=True) if z - a > 1]
        held_key, held = key[starts[-1]], fp[starts[-1] :]
        if whole:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([w[k] for w in whole])) for k in (0, 1)], names=["fp", "root"])
    if len(held) > 1:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in of(held)], names=["fp", "root"])


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """fp, root: edges that connect exactly those distinct fingerprints that chains of links connect."""
    spread = distinct.select("fp", F.explode(F.array(*_shard_keys(F.col("fp"), blocks, radius))).alias("s")).select("fp", "s.choice", "s.bits")
    sizes = spread.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter("n > 1")
    spread = spread.join(sizes, ["choice", "bits"])
    parts = F.ceil(F.col("n") / part).cast("int")
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    other = F.when(parts == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), parts - 1), lambda j: j != F.col("mine")))
    tiles = spread.withColumn("mine", mine).withColumn("j", F.explode(other))
    tiles = tiles.select("choice", "bits", F.least("mine", "j").alias("lo"), F.greatest("mine", "j").alias("hi"), "fp")
    by = ["choice", "bits", "lo", "hi"]
    return tiles.repartition(*by).sortWithinPartitions(*by, "fp").mapInArrow(lambda batches: _shard_edges(batches, radius), "fp long, root long").distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """node, comp: the least node of each edge list's component, by alternating large and small stars until nothing changes.

    Each round keeps as many edges at most and is a group-by and a salted join on them; lineage is cut every round.
    """
    edges = cut(edges.select(F.greatest("fp", "root").alias("u"), F.least("fp", "root").alias("v")).filter("u <> v").distinct())
    seen, n = None, edges.count()
    while True:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"))
        large = cut(salted_join(both.filter("v > u"), low, "u", "n", 2 * n).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct())
        least = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        rest = salted_join(large, least, "u", "n", 2 * n).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(rest.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.countDistinct("u")).first())
        if now == seen and now[0] == now[2]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        seen, n = now, now[0]


def _with_component(distinct: DataFrame, radius: int) -> DataFrame:
    """distinct (one row per fingerprint fp), with comp: the least fingerprint of its component."""
    found = cut(contracted(links(distinct.select("fp"), radius)))
    return cut(distinct.join(found, distinct.fp == found.node, "left").select(*distinct.columns, F.coalesce("comp", "fp").alias("comp")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row per input row: id, fp (signed long), fingerprint (hex), component_id (least id reachable).

    Null and blank texts have fingerprint zero and are linked like any other. Null ids take part; a component of null ids
    only has a null id. Repeated rows and ties share a component. Other columns are ignored. Empty in, empty out. Rows of
    one fingerprint and fingerprints of one component may be any share of all: both joins are salted.
    """
    prints = written(fingerprints(docs, id_col, text_col, words, seed), "simhash")
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("rows")))
    of = _with_component(distinct, radius)
    ids = cut(of.groupBy("comp").agg(F.min("least").alias("component_id"), F.count("*").alias("n"), F.sum("rows").alias("all_rows")))
    rows = ids.agg(F.sum("all_rows")).first()[0] or 0
    of = salted_join(of.select("fp", "comp", "rows"), ids.drop("all_rows"), "comp", "n", rows).select("fp", "component_id", "rows")
    out = salted_join(prints, cut(of), "fp", "rows", rows)
    return out.select(F.col("id").alias(id_col), "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """The rows of docs that stand for their component, one for each: the least id (null last), then the least md5 of the text.

    Rows are found again by (id, md5 of the text), because ids may be null or shared by different texts; of rows repeated
    whole one stays.
    """
    prints = written(fingerprints(docs, id_col, text_col, words, seed, hashed=True), "simhash")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    distinct = cut(prints.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("n")))
    of = _with_component(distinct, radius)
    groups = of.groupBy("comp").agg(F.min("first").alias("stays"), F.sum("n").alias("rows"), F.count("*").alias("prints"))
    groups = cut(groups.filter("rows > 1"))
    total = groups.agg(F.sum("rows")).first()[0] or 0
    shared = cut(salted_join(of.select("fp", "comp", "n"), groups.drop("rows"), "comp", "prints", total).select("fp", "stays", "n"))
    rows = salted_join(prints, shared, "fp", "n", total)
    rows = written(rows.groupBy("id", "h").agg(F.count("*").alias("c"), F.first("stays").alias("stays")), "near-shared")
    stays = F.col("id").eqNullSafe(F.col("stays.id")) & (F.col("h") == F.col("stays.h"))
    key = F.col("id").alias("g_id"), F.col("h").alias("g_h")
    # A row that is repeated whole goes as well, and comes back once.
    gone = rows.filter(~stays | (F.col("c") > 1)).select(*key)
    twice = rows.filter(stays & (F.col("c") > 1)).select(*key)
    n_gone, n_twice = gone.count(), twice.count()
    wide = docs.select(F.struct(*[col(docs, c) for c in docs.columns]).alias("row"), col(docs, id_col).alias("d_id"), text_hash(col(docs, text_col)).alias("d_h"))
    own = [F.col("d_id"), F.col("d_h")]
    out = having(wide, gone, own, n_gone, 80, without=True).select("row")
    if n_twice:
        again = having(wide, twice, own, n_twice, 80).groupBy("d_id", "d_h").agg(F.first("row").alias("row"))
        out = out.unionByName(again.select("row"))
    return out.select("row.*")
