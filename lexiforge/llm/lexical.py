"""Exact ranked lexical search over a clustered index whose documents are ordered by recursive graph bisection.

Documents and query terms form a bipartite graph. Recursive bisection puts documents that share terms near each other: each
range of documents is cut into two halves, and pairs change sides while that lowers the cost of coding the terms' gaps.
The upper levels are fitted on a bounded sample; every document then goes down that tree, and the documents of a leaf form
shards of bounded size, in which the bisection goes on over all of them down to clusters. For every shard and cluster the
index holds the greatest impact of each term, so that a query's score inside is bounded from above. Shards are visited in
the order of their bounds, in three rounds; a shard, and inside it a cluster, is passed over only if its bound is below the
query's k-th best score so far. What is left is mapped back to document ids, by which equal scores are ordered.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, col, cut, release, remove, slices, written_at
from .tokens import strings

# Terms, in lower-cased UTF-8, and what stands between them.
_TERM, _BETWEEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20
#: Rows of one step of a task.
ROWS = 1024
#: Queries that are answered together: at most so many items, of so many bytes in all; each block reads the texts once.
ITEMS, ITEM_BYTES = 2_000, 1 << 20
#: Documents that the tree is fitted on, at most, and those of one of its leaves, at least.
SAMPLE, LEAF = 8_192, 64
#: Documents of a shard, at most, and of a cluster.
SHARD, CLUSTER = 2_048, 64
#: Rounds of swaps of one level.
SWAPS = 12
#: Shards that each query visits in the first and the second round; the third visits all that are left.
VISITS = (4, 32)


def terms_of(data: bytes) -> Iterator[bytes]:
    """The terms of a text in UTF-8, A-Z in lower case. Long texts are cut between terms into pieces of about PIECE bytes."""
    if len(data) <= PIECE:
        yield from _TERM.findall(data.lower())
        return
    at = 0
    while at < len(data):
        stop = _BETWEEN.search(data, min(len(data), at + PIECE))
        end = stop.start() if stop else len(data)
        yield from _TERM.findall(data[at:end].lower())
        at = end


class Block:
    """Some items: their ids, and the distinct terms of all of them by number."""

    def __init__(self, items: list[tuple]):
        self.ids = [i for i, _ in items]
        counts = [Counter(terms_of((t or "").encode())) for _, t in items]
        self.vocabulary = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        self.terms = [np.array(sorted(self.vocabulary[t] for t in c), np.int64) for c in counts]
        names = list(self.vocabulary)
        self.times = [np.array([c[names[k]] for k in ts], np.int64) for c, ts in zip(counts, self.terms, strict=True)]


def blocks_of(items: DataFrame) -> Iterator[Block]:
    """The items, read through a local iterator in blocks of bounded size."""
    some, size = [], 0
    for i, t in items.toLocalIterator():
        if some and (len(some) == ITEMS or size + len(t or "") > ITEM_BYTES):
            yield Block(some)
            some, size = [], 0
        some.append((i, t))
        size += len(t or "")
    if some:
        yield Block(some)


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """One row per input row: rid, id, n (all terms with repeats), terms (of the vocabulary, ascending), times."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        known = vocabulary.__contains__
        for b in (part for whole in batches for part in slices(whole, ROWS)):
            sizes, terms, times = [], [], []
            for t in strings(b.column(1)):
                n, found = 0, Counter()
                data = t.as_buffer().to_pybytes()
                if len(data) <= PIECE:
                    every = _TERM.findall(data.lower())
                    n, found = len(every), Counter(filter(known, every))
                else:
                    for term in terms_of(data):
                        n += 1
                        if known(term):
                            found[term] += 1
                pairs = sorted((vocabulary[x], c) for x, c in found.items())
                sizes.append(n)
                terms.append([x for x, _ in pairs])
                times.append([c for _, c in pairs])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))], names=["id", "n", "terms", "times"])
        release()

    rows = docs.select(col(docs, id_col).cast("long").alias("id"), col(docs, text_col).alias("t"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, times array<int>").withColumn("rid", F.monotonically_increasing_id())


def halves(node: np.ndarray, nodes: int, ptr: np.ndarray, terms: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cuts the documents of every node into halves: (side of each document, degrees [node, side, term]).

    Documents are rows of (ptr, terms) with at least one term each. The halves are first those of the given order; then the
    documents of both sides are sorted by what moving them would save, and pairs of the same rank swap while the two save
    something together. Each side keeps its number of documents.
    """
    n_docs = len(node)
    counts = np.bincount(node, minlength=nodes)
    by_node = np.argsort(node, kind="stable")
    rank = np.empty(n_docs, np.int64)
    rank[by_node] = np.arange(n_docs) - np.repeat(np.cumsum(counts) - counts, counts)
    side = (rank >= (counts[node] + 1) // 2).astype(np.int64)
    doc_of = np.repeat(np.arange(n_docs), np.diff(ptr))
    n = np.bincount(node * 2 + side, minlength=2 * nodes).reshape(nodes, 2)
    log_n = np.log2(np.maximum(n, 1))[:, :, None]
    pairs = n.min(axis=1)
    of = np.repeat(np.arange(nodes), pairs)
    k = np.arange(len(of)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
    for step in range(SWAPS + 1):
        group = node * 2 + side
        degree = np.bincount(group[doc_of] * size + terms, minlength=nodes * 2 * size).reshape(nodes, 2, size)
        if step == SWAPS:
            break
        cost = lambda d: d * (log_n - np.log2(np.maximum(d, 0) + 1))
        less, now, more = cost(degree - 1), cost(degree), cost(degree + 1)
        # What a move of one document with the term saves: its own side has one less, the other one more.
        saved = now - less + (now - more)[:, ::-1]
        gain = np.add.reduceat(saved.reshape(-1)[group[doc_of] * size + terms], ptr[:-1])
        order = np.lexsort((-gain, group))
        first = np.searchsorted(group[order], np.arange(2 * nodes))
        left, right = order[first[2 * of] + k], order[first[2 * of + 1] + k]
        swap = gain[left] + gain[right] > 1e-6
        if not swap.any():
            break
        side[left[swap]], side[right[swap]] = 1, 0
    return side, degree


def reordered(ptr: np.ndarray, terms: np.ndarray, size: int, least: int) -> np.ndarray:
    """An order of the documents by recursive bisection until ranges hold at most `least`."""
    node, nodes = np.zeros(len(ptr) - 1, np.int64), 1
    while len(node) and np.bincount(node).max() > least:
        side, _ = halves(node, nodes, ptr, terms, size)
        node, nodes = node * 2 + side, nodes * 2
    return np.argsort(node, kind="stable")


def fitted(ptr: np.ndarray, terms: np.ndarray, size: int, depth: int) -> list[np.ndarray]:
    """The tree's levels: per node and term, by how much a document with the term is dearer on the left than on the right."""
    node, levels = np.zeros(len(ptr) - 1, np.int64), []
    for level in range(depth):
        side, degree = halves(node, 2**level, ptr, terms, size)
        n = np.maximum(np.bincount(node * 2 + side, minlength=2 ** (level + 1)).reshape(-1, 2, 1), 1)
        dear = np.log2(n / (degree + 1))
        levels.append((dear[:, 0] - dear[:, 1]).astype(np.float32))
        node = node * 2 + side
    return levels


def leaves(levels: list[np.ndarray], ptr: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Each document's leaf, down the tree to the side where it is cheaper."""
    node = np.zeros(len(ptr) - 1, np.int64)
    doc_of = np.repeat(np.arange(len(node)), np.diff(ptr))
    for level in levels:
        dearer = np.add.reduceat(level[node[doc_of], terms], ptr[:-1])
        node = node * 2 + (dearer > 0)
    return node


def lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(ptr, values) of an Arrow column of lists without nulls."""
    import pyarrow as pa

    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.r_[0, np.cumsum(whole.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))].astype(np.int64), whole.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


class Scores:
    """The block's weights and the corpus's figures: impacts of postings, and bounds and scores of items."""

    def __init__(self, block: Block, documents: int, length: int, holding: np.ndarray):
        self.documents, self.length, self.size = documents, length, len(block.vocabulary)
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in holding], np.int64)
        self.terms = block.terms
        self.weights = [weight[t] * c for t, c in zip(block.terms, block.times, strict=True)]

    def impacts(self, n: np.ndarray, ptr: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Per posting the part of the score that is the same for all items; m goes through Python's integers where a long is too short."""
        if 25 * int(n.max(initial=0)) * self.documents < 2**63:
            m = 75 + 25 * n * self.documents // self.length
        else:
            m = np.array([75 + 25 * int(x) * self.documents // self.length for x in n], np.int64)
        return 10**9 * times // (1000 * times + 12 * np.repeat(m, np.diff(ptr)))

    def bounds(self, terms: np.ndarray, greatest: np.ndarray) -> np.ndarray:
        """Of each item: no document whose terms have at most these impacts scores more."""
        most = np.zeros(self.size, np.int64)
        most[terms] = greatest
        return np.array([int((w * most[t]).sum()) for t, w in zip(self.terms, self.weights, strict=True)], np.int64)


def greatest(terms: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct terms, the greatest impact of each)."""
    order = np.argsort(terms, kind="stable")
    terms, impacts = terms[order], impacts[order]
    first = np.flatnonzero(np.diff(terms, prepend=-1))
    return terms[first], np.maximum.reduceat(impacts, first) if len(first) else impacts


INDEX = "shard int, ids array<long>, sizes array<int>, terms array<int>, impacts array<int>, c_docs array<int>, c_sizes array<int>, c_terms array<int>, c_most array<int>, bounds array<long>"


def shard_row(table, scores: Scores):
    """One shard's row of the index: documents in bisection order with their postings, clusters with their greatest impacts, the items' bounds."""
    import pyarrow as pa

    ptr, terms = lists(table["terms"])
    _, times = lists(table["times"])
    impacts = scores.impacts(table["n"].to_numpy(), ptr, times)
    own, local = np.unique(terms, return_inverse=True)
    order = reordered(ptr, local, len(own), CLUSTER)
    sizes = np.diff(ptr)[order]
    at = np.repeat(ptr[:-1][order], sizes) + np.arange(len(terms)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms, impacts, ptr = terms[at], impacts[at], np.r_[0, np.cumsum(sizes)]
    edges = np.unique(np.linspace(0, len(order), -(-len(order) // CLUSTER) + 1).astype(int))
    clusters = [greatest(terms[ptr[a] : ptr[z]], impacts[ptr[a] : ptr[z]]) for a, z in zip(edges[:-1], edges[1:], strict=True)]
    row = {
        "shard": table["shard"][0].as_py(),
        "ids": table["id"].combine_chunks().take(pa.array(order)),
        "sizes": sizes,
        "terms": terms,
        "impacts": impacts,
        "c_docs": np.diff(edges),
        "c_sizes": np.array([len(t) for t, _ in clusters]),
        "c_terms": np.concatenate([t for t, _ in clusters]),
        "c_most": np.concatenate([x for _, x in clusters]),
        "bounds": scores.bounds(*greatest(terms, impacts)),
    }
    kinds = {"shard": pa.int32(), "ids": pa.list_(pa.int64()), "bounds": pa.list_(pa.int64())}
    return pa.table({k: pa.array([v], kinds.get(k, pa.list_(pa.int32()))) if k == "shard" else _listed(v, kinds.get(k, pa.list_(pa.int32()))) for k, v in row.items()})


def _listed(values, kind):
    """An Arrow array of one list."""
    import pyarrow as pa

    flat = values.cast(kind.value_type) if isinstance(values, pa.Array) else pa.array(values, kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def best(found: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest id, null last."""
    return np.lexsort((ids, null, -found))[:k]


class Shard:
    """A row of the index, ready for visits."""

    def __init__(self, row: dict[str, np.ndarray], null: np.ndarray, scores: Scores):
        self.row, self.null, self.scores = row, null, scores
        self.ptr = np.r_[0, np.cumsum(row["sizes"])].astype(np.int64)
        self.docs = np.r_[0, np.cumsum(row["c_docs"])].astype(np.int64)
        of = np.repeat(np.arange(len(row["c_sizes"])), row["c_sizes"])
        self.most = np.zeros((len(row["c_sizes"]), scores.size), np.int64)
        self.most[of, row["c_terms"]] = row["c_most"]

    def visit(self, item: int, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents' places, scores) of the shard's k best for an item among those of at least `floor`; clusters in the order of their bounds."""
        terms, weights = self.scores.terms[item], self.scores.weights[item]
        weight = np.zeros(self.scores.size, np.int64)
        weight[terms] = weights
        bounds = self.most[:, terms] @ weights
        places, values = np.empty(0, np.int64), np.empty(0, np.int64)
        for c in np.argsort(-bounds, kind="stable"):
            if bounds[c] < floor:
                break
            a, z = self.docs[c], self.docs[c + 1]
            part = slice(self.ptr[a], self.ptr[z])
            found = np.add.reduceat(weight[self.row["terms"][part]] * self.row["impacts"][part], self.ptr[a:z] - self.ptr[a])
            good = np.flatnonzero(found >= floor)
            places, values = np.r_[places, a + good], np.r_[values, found[good]]
            keep = best(values, self.row["ids"][places], self.null[places], k)
            places, values = places[keep], values[keep]
            if len(keep) == k:
                floor = max(floor, int(values[-1]))
        return places, values


def visited(index: DataFrame, visits: DataFrame, scores: Scores, k: int) -> DataFrame:
    """item, doc_id, score: the k best of each (shard, item) that is to be visited; visits: shard, asked (array of item, floor)."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for j in range(b.num_rows):
                ids = b.column("ids")[j].values
                row = {n: b.column(n)[j].values.to_numpy(zero_copy_only=False).astype(np.int64) for n in ("sizes", "terms", "impacts", "c_docs", "c_sizes", "c_terms", "c_most")}
                null = ids.is_null().to_numpy(zero_copy_only=False)
                row["ids"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
                shard, out = Shard(row, null, scores), []
                for x in b.column("asked")[j].as_py():
                    places, values = shard.visit(x["item"], x["floor"], k)
                    out.append((np.full(len(places), x["item"]), places, values))
                item, places, values = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), ids.take(pa.array(places)), pa.array(values, pa.int64())], names=["item", "doc_id", "score"])
        release()

    return index.drop("bounds").join(visits, "shard").mapInArrow(run, "item int, doc_id long, score long")


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def answered(index: DataFrame, scores: Scores, k: int) -> DataFrame:
    """item, doc_id, score, rank: all rounds over the index."""
    spark = index.sparkSession
    bounds = cut(index.select("shard", F.posexplode("bounds").alias("item", "bound")).filter("bound > 0"))
    found, seen = None, None
    for size in (*VISITS, None):
        left = bounds
        if found is not None:
            # A query's k-th best score so far; at most k rows for each of at most ITEMS items.
            floors = found.filter(F.col("rank") == k).select("item", F.col("score").alias("floor"))
            left = left.join(F.broadcast(seen), ["shard", "item"], "left_anti").join(F.broadcast(floors), "item", "left").filter("floor is null or bound >= floor")
        else:
            left = left.withColumn("floor", F.lit(None).cast("long"))
        if size:
            by = Window.partitionBy("item").orderBy(F.col("bound").desc(), "shard")
            left = left.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= size)
        visits = cut(left.groupBy("shard").agg(F.collect_list(F.struct("item", F.coalesce("floor", F.lit(1)).alias("floor"))).alias("asked")))
        n, pairs = visits.agg(F.count("*"), F.sum(F.size("asked"))).first()
        if not n:
            break
        hinted = F.broadcast(visits) if 16 * pairs <= BROADCAST_BYTES else visits
        new = visited(index, hinted, scores, k)
        found = cut(top(new if found is None else new.unionByName(found.drop("rank")), k))
        pair = visits.select("shard", F.explode("asked.item").alias("item"))
        seen = pair if seen is None else seen.unionByName(pair)
    return found if found is not None else spark.createDataFrame([], "item int, doc_id long, score long, rank int")


def indexed(docs: DataFrame, block: Block, id_col: str, text_col: str) -> tuple[DataFrame, Scores]:
    """The clustered index of all documents over a block's terms, and the figures it was made with."""
    spark = docs.sparkSession
    size = len(block.vocabulary)
    raw, raw_at = written_at(postings(docs, block.vocabulary, id_col, text_col), "lexical-postings")
    documents, length = raw.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    holding = np.zeros(size, np.int64)
    for t, c in raw.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect():  # a row for each term of the block at most
        holding[t] = c
    scores = Scores(block, documents, length or 0, holding)
    some = raw.filter(F.size("terms") > 0)
    ptr, terms = lists(some.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("terms").toArrow()["terms"])
    depth = max(0, int(math.log2(max(1, (len(ptr) - 1) // LEAF))))
    levels = fitted(ptr, terms, size, depth)

    def route(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaves(levels, *lists(b.column("terms"))), pa.int32())], names=[*b.schema.names, "leaf"])

    routed, routed_at = written_at(some.select("rid", "id", "n", "terms", "times").mapInArrow(route, "rid long, id long, n long, terms array<int>, times array<int>, leaf int"), "lexical-routed")
    remove(spark, raw_at)
    counts = dict(map(tuple, routed.groupBy("leaf").count().collect()))  # a row for each leaf: SAMPLE / LEAF at most
    each = min(SHARD, max(CLUSTER, -(-sum(counts.values()) // 2**depth)))
    shards = {leaf: -(-c // each) for leaf, c in counts.items()}
    firsts, total = {}, 0
    for leaf, n in sorted(shards.items()):
        firsts[leaf], total = total, total + n
    of = spark.createDataFrame([(leaf, firsts[leaf], n) for leaf, n in shards.items()], "leaf int, first long, n_shards long")
    dealt = routed.join(F.broadcast(of), "leaf").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("rid"), F.col("n_shards"))).cast("int"))
    index, _ = written_at(dealt.select("shard", "id", "n", "terms", "times").groupBy("shard").applyInArrow(lambda t: shard_row(t, scores), INDEX), "lexical-index")
    remove(spark, routed_at)
    return index, scores


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of the highest score above 0, equal scores by ascending id.

    Null texts have no terms; items without terms, or with terms that no document has, give no rows. Ids are longs; rows with
    a null id take part and come last among equals; rows repeated under one id are documents each, and items repeated under
    one id are answered each. Other columns are ignored, whatever their names; an empty table of either kind gives an empty
    result. Items are answered in blocks of bounded size, each of which reads all texts once. Scores are exact integers.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks_of(items.select(col(items, item_col).cast("long"), col(items, item_text_col))):
        if not block.vocabulary:
            continue
        index, scores = indexed(docs, block, id_col, text_col)
        named = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")
        out = out.unionByName(answered(index, scores, k).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return out.withColumnRenamed("item_id", item_col)
