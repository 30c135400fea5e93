import hashlib

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiforge.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    root = list(range(len(prints)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(prints))]


@given(st.lists(st.sampled_from(["a", "B", "ä", "cc", "\t", "\n", "\x0b", " "]), max_size=20).map(" ".join))
@settings(max_examples=60, deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_print(text)


def test_long_texts_go_by_in_blocks():
    text = " ".join(str(k * k % 977) for k in range(140_000))
    words = text.split()
    counts = np.zeros(64, int)
    for k in range(len(words) - 3):
        h = xxhash.xxh64_intdigest(" ".join(words[k : k + 4]), 42)
        counts += np.array([h >> b & 1 for b in range(64)])
    assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * counts[b] > len(words) - 3)


def near(rng, base, bits):
    for b in rng.choice(64, bits, replace=False):
        base ^= 1 << int(b)
    return base


def family(rng, n):
    out = [int(x) for x in rng.integers(0, 2**63, 20)]
    while len(out) < n:
        out.append(near(rng, out[rng.integers(0, len(out))], int(rng.integers(1, 8))))
    return sorted(set(out))


def test_bk_tree_components():
    rng = np.random.default_rng(5)
    prints = family(rng, 700)
    root = simhash.components(np.array(prints, np.uint64))
    want = brute_components(prints)
    pairs = {}
    for a, b in zip(root.tolist(), want, strict=True):
        assert pairs.setdefault(a, b) == b
    assert len(set(root.tolist())) == len(set(want))


def test_links_and_contraction(spark):
    rng = np.random.default_rng(9)
    prints = family(rng, 600)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = brute_components(prints)
    for part in (simhash.PART, 40):  # large shards are split into pairs of parts
        found = {r.node: r.comp for r in simhash.contracted(simhash.links(df, part=part)).collect()}
        groups = {}
        for p, w in zip(signed, want, strict=True):
            assert groups.setdefault(found.get(p, p), w) == w
        assert len(groups) == len(set(want))


def test_documents_against_brute_force(sample):
    rows = [(r.doc_id, r.text) for r in sample.collect()]
    prints = [brute_print(t) for _, t in rows]
    comp = brute_components(prints)
    least = {}
    for (i, _), c in zip(rows, comp, strict=True):
        least[c] = min(i, least.get(c, i))
    want = sorted((i, f"{p:016x}", least[c]) for (i, _), p, c in zip(rows, prints, comp, strict=True))
    got = simhash.simhash_components(sample).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got)) == want


def test_odd_rows(odd, empty):
    rows = simhash.simhash_components(odd).collect()
    assert len(rows) == odd.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {3, 4, 5} and {r.component_id for r in zero} == {3}
    assert simhash.simhash_components(empty).count() == 0
    out = simhash.drop_near_copies(odd)
    assert out.columns == odd.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3", "6", "8", "None"]
    assert simhash.drop_near_copies(odd.filter("doc_id = 7")).count() == 1
    assert simhash.drop_near_copies(empty).count() == 0


def test_null_and_shared_ids_keep_one_row_of_each_component(spark):
    rng = np.random.default_rng(3)
    text = lambda: " ".join(f"w{k}" for k in rng.integers(0, 10**6, 3000))
    t = [text() for _ in range(9)]
    close = lambda k: t[k] + " more"
    rows = [(3, t[0]), (5, t[1]), (5, close(0)), (None, close(0)), (None, t[2]), (None, t[3]), (None, close(3)), (None, t[4]), (None, t[4])]
    rows += [(5, t[5]), (7, t[6]), (7, t[7]), (7, close(7)), (8, t[8]), (8, t[8]), (9, close(1))]
    prints = [brute_print(x) for _, x in rows]
    comp = brute_components(prints)
    assert len(set(comp)) == len(t)
    want = {}
    for (i, x), c in zip(rows, comp, strict=True):
        key = (i is None, i or 0, hashlib.md5(x.encode()).hexdigest())
        want[c] = min(want.get(c, (key, i, x)), (key, i, x), key=lambda v: v[0])
    out = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in out) == sorted((str(i), x) for _, i, x in want.values())
