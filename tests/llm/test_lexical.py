import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiforge.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) of every item by scoring all documents with Python's integers."""
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        wanted, scored = Counter(plain_terms(text)), []
        for i, c in counted:
            n = sum(c.values())
            score = 0
            for t, q in wanted.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += q * w * (10**9 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // length)))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@given(st.lists(st.sampled_from(["Ab", "é", "Ünï", "9", " ", ".", "\n", "日本", "x_y", "K", "\x7f", "İ"]), max_size=40).map("".join), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_terms_in_pieces(text, piece):
    before, lexical.PIECE = lexical.PIECE, piece
    try:
        assert [t.decode() for t in lexical.terms_of(text.encode())] == plain_terms(text)
    finally:
        lexical.PIECE = before


def graph(seed, n, kinds=4, words=12):
    """Documents of a few kinds, shuffled; each kind has words of its own and some that all share."""
    rng = np.random.default_rng(seed)
    kind = rng.permutation(np.arange(n) % kinds)
    rows = [np.unique(np.r_[rng.integers(0, words, 5) + words * k, kinds * words + rng.integers(0, 5, 2)]) for k in kind]
    return kind, np.r_[0, np.cumsum([len(r) for r in rows])], np.concatenate(rows), kinds * words + 5


def test_halves_keep_their_sizes_and_find_kinds():
    kind, ptr, terms, size = graph(1, 200)
    side, degree = lexical.halves(np.zeros(200, np.int64), 1, ptr, terms, size)
    assert side.sum() == 100 and degree.sum() == len(terms)
    order = lexical.reordered(ptr, terms, size, 50)
    assert sorted(order) == list(range(200))
    # Neighbours are of one kind far oftener than a quarter of the time.
    assert (np.diff(kind[order]) == 0).mean() > 0.8


def test_documents_go_down_the_tree_to_their_like():
    kind, ptr, terms, size = graph(2, 400)
    levels = lexical.fitted(ptr, terms, size, 2)
    other, ptr2, terms2, _ = graph(3, 300)
    leaf = lexical.leaves(levels, ptr2, terms2)
    purity = sum(np.bincount(other[leaf == k]).max(initial=0) for k in range(4)) / 300
    assert purity > 0.9


def corpus(seed=5, n=400):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(60)] + ["Ünï", "日本", "the", "The"]
    rows = [(int(k), " ".join(rng.choice(words, int(rng.integers(0, 30))))) for k in rng.permutation(n)]
    rows += [(1000 + k, "the same w1 w2 text of many copies") for k in range(150)]
    rows += [(7, "w3 w3 w4"), (7, "w3 w3 w4"), (None, "w5 w6 w7"), (None, None), (2000, ""), (2001, "... ---"), (2002, "w8 " * 3000)]
    items = [(k, " ".join(rng.choice(words, 6))) for k in range(25)] + [(90, "many copies"), (91, None), (92, "nowhere"), (93, "w3 w3 w4 w5"), (93, "THE")]
    return rows, items


def test_against_brute_force_with_many_shards(spark, monkeypatch):
    for name, value in (("SHARD", 24), ("CLUSTER", 4), ("LEAF", 16), ("SAMPLE", 128), ("VISITS", (1, 2))):
        monkeypatch.setattr(lexical, name, value)
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("z") for n in ("id", "n", "t", "terms", "times", "rid", "leaf", "shard", "score", "item", "rank", "bound")})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    assert got(lexical.lexical_search(docs, asked, 7)) == brute(rows, items, 7)


def test_bounds_pass_shards_over(spark, monkeypatch):
    """Shards of other kinds are never visited, and the answer is exact all the same."""
    for name, value in (("SHARD", 20), ("CLUSTER", 4), ("LEAF", 20), ("VISITS", (1, 2))):
        monkeypatch.setattr(lexical, name, value)
    rows = [(k, " ".join(f"k{k % 8}w{j}" for j in range((k // 8) % 3, 6 + (k // 8) % 5))) for k in range(400)]
    items = [(k, " ".join(f"k{k}w{j}" for j in range(9))) for k in range(8)]
    docs, asked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    pairs = []
    plain = lexical.visited
    monkeypatch.setattr(lexical, "visited", lambda index, visits, scores, k: (pairs.append(visits.agg(F.sum(F.size("asked"))).first()[0]), plain(index, visits, scores, k))[1])
    block = next(lexical.blocks_of(asked))
    index, scores = lexical.indexed(docs, block, "doc_id", "text")
    found = lexical.answered(index, scores, 5).select(F.col("item").cast("long"), "rank", "doc_id", "score")
    assert got(found) == brute(rows, items, 5)
    assert index.count() > 20 and sum(pairs) < 0.5 * index.count() * len(items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 9)
    rows, items = corpus(6, 60)
    docs, asked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.lexical_search(docs, asked)) == brute(rows, items)


def test_odd_rows_and_empty_tables(spark, odd, empty):
    items = [(1, "hello WORLD wort"), (2, "x no id")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(lexical.lexical_search(odd, asked)) == brute([(r.doc_id, r.text) for r in odd.collect()], items)
    assert lexical.lexical_search(empty, asked).collect() == []
    assert lexical.lexical_search(odd, asked.limit(0)).collect() == []


def test_figures_beyond_a_long():
    block = lexical.Block([(1, "a")])
    scores = lexical.Scores(block, 10**12, 10**15, np.array([5]))
    assert scores.impacts(np.array([10**7]), np.array([0, 1]), np.array([3])).tolist() == [10**9 * 3 // (3000 + 12 * (75 + 25 * 10**7 * 10**12 // 10**15))]


def test_query_against_brute_force(spark):
    where = "/root/testdata/sf0.01"
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{where}/documents.parquet").collect()]
    items = [(d.item_id, d.text) for d in spark.read.parquet(f"{where}/benchmark.parquet").collect()]
    assert got(queries.op12(spark, where)) == brute(docs, items)
