import io
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiforge.llm import token_store, tokens

PIECES = st.sampled_from([" ", "  ", "a", "Wort", "1", "'s", "\n", "\t", "!", ".", " ", "<|endoftext|>", "é", "\x1c", "\x85", "﻿", "​", "　", "the"])
TEXTS = st.lists(PIECES, max_size=40).map("".join)


def library(vocabulary, text):
    return tokens.tokenizer(vocabulary).encode(text, add_special_tokens=False)


@given(texts=st.lists(TEXTS, max_size=6))
@settings(max_examples=80, deadline=None)
def test_units_give_the_librarys_ids(texts):
    import public_tokenizers

    v = public_tokenizers.path("byte_bpe_50k.json")
    assert [x.tolist() for x in tokens.Encoder(v).many(texts)] == [library(v, t).ids for t in texts]


@given(st.lists(TEXTS, max_size=4), st.integers(3, 12), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_spliced_counts(texts, chunk, overlap):
    import public_tokenizers

    v = public_tokenizers.path("byte_bpe_50k.json")
    starts = tokens._starts_by_units(tokens.Encoder(v))
    got = tokens.spliced_counts([t.encode() for t in texts], starts, chunk, overlap)
    assert [n for n, _ in got] == [len(library(v, t).ids) for t in texts]


def test_splices_lie_inside_overlaps_and_overlaps_widen(vocabulary):
    starts = tokens._starts_by_units(tokens.Encoder(vocabulary))
    text = ("word " * 40 + "x" * 90 + " ") * 6
    o = tokens.Overlaps(text.encode(), 128, 8)
    rounds = 0
    while asked := o.missing():
        rounds += 1
        for (c, _), at in zip(asked, starts([t for _, t in asked]), strict=True):
            c.tokens = c.start + at
        o.align()
    assert rounds > 1 and any(c.width > 8 for c in o.chunks)
    assert all(c.start < c.splice < c.start + c.width for c in o.chunks[1:])
    assert o.count() == len(library(vocabulary, text).ids)


def test_counts(odd, empty, vocabulary):
    rows = tokens.count_tokens(odd, vocabulary).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    assert len(rows) == odd.count()
    for r in rows:
        t = texts[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n := len(library(vocabulary, t).ids), n > 1024)
    assert max(r.n_chunks for r in rows) > 1
    assert tokens.count_tokens(empty, vocabulary).count() == 0


def test_counts_of_sample(sample, vocabulary):
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(sample, vocabulary, chunk=2000, overlap=64).collect()}
    assert got == {r.doc_id: len(library(vocabulary, r.text).ids) for r in sample.collect()}


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_tokenizers(sample, odd, name):
    """Sentencepiece texts are spliced; a lower-casing word-piece file gets whole texts."""
    public = pytest.importorskip("public_tokenizers")
    path = public.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        count = lambda t: len(library(path, t).ids)
        assert not tokens.Encoder(path).by_units
    for df in (sample, odd):
        got = sorted((r.doc_id or -1, r.n_tokens, r.n_chunks) for r in tokens.count_tokens(df, path, chunk=700, overlap=32).collect())
        assert [g[:2] for g in got] == sorted((r.doc_id or -1, count(r.text or "")) for r in df.collect())
        assert (max(g[2] for g in got) > 1) == name.endswith(".model")


def test_file_round_trip(vocabulary):
    out = io.BytesIO()
    w = token_store.Writer(out, frame_bytes=64)
    docs = [(None, [5]), (1, []), (2, list(range(40))), (2, [7, 8]), (9, [1] * 3)]
    for i, ids in docs:
        w.add(i, np.array(ids, "<u4").tobytes())
    w.close()
    r = token_store.Reader(out)
    assert [(i, x.tolist()) for i, _, x in r] == docs
    assert [s for _, s, _ in r] == [0, 1, 1, 41, 43]
    assert len(r.frames) > 1
    assert [x.tolist() for x in r.find(2)] == [list(range(40)), [7, 8]]


def test_readers_decompress_only_requested_frames():
    out = io.BytesIO()
    w = token_store.Writer(out, frame_bytes=400)
    for i in range(50):
        w.add(i, np.arange(i, i + 50, dtype="<u4").tobytes())
    w.close()
    r = token_store.Reader(out)
    read = []
    whole = r.frame
    r.frame = lambda k: read.append(k) or whole(k)
    assert r.find(30)[0].tolist() == list(range(30, 80))
    assert len(read) == 1


def test_frames_are_plain_zstandard_and_checked():
    import zstandard

    out = io.BytesIO()
    w = token_store.Writer(out, frame_bytes=16)
    for i in range(5):
        w.add(i, np.array([i, i + 1, i + 2], "<u4").tobytes())
    w.close()
    raw = bytearray(out.getvalue())
    size = token_store.Reader(out).frames[0][0]
    assert np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(raw[:size])), "<u4")[0] == 0
    raw[size - 2] ^= 1
    with pytest.raises(Exception, match="damaged|rror"):
        token_store.Reader(io.BytesIO(bytes(raw))).frame(0)


def test_table_round_trip(odd, empty, sample, vocabulary):
    for df in (odd, sample):
        rows = token_store.read_tokens(token_store.write_tokens(df, vocabulary)).collect()
        texts = [(r.doc_id, r.text or "") for r in df.collect()]
        want = sorted(((i is not None, i or 0), library(vocabulary, t).ids + [2]) for i, t in texts)
        assert len(rows) == len(want)
        start = 0
        for r, (key, ids) in zip(sorted(rows, key=lambda r: r.start), want, strict=True):
            assert (r.doc_id is not None, r.doc_id or 0) == key
            assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)
    assert token_store.read_tokens(token_store.write_tokens(empty, vocabulary)).count() == 0


def test_rows_of_one_id_fill_several_files(spark, vocabulary):
    """A third of the rows have one id, others none; files stay even and in order, and their number is capped."""
    rows = [((None, 5, k)[k % 3], f"text {k} " * 50) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    manifest = token_store.write_tokens(df, vocabulary, file_ids=12_000).orderBy("file_no").collect()
    assert len(manifest) >= 4
    assert max(m.n_docs for m in manifest) <= 300
    got = token_store.read_tokens(token_store.write_tokens(df, vocabulary, file_ids=12_000)).orderBy("start").collect()
    assert len(got) == 600
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    few = token_store.write_tokens(df, vocabulary, file_ids=12_000, files=2)
    assert few.count() <= 2
    assert token_store.read_tokens(few).count() == 600


def test_long_texts_without_stable_cuts(spark, vocabulary):
    """Long runs of one letter, of spaces, of line feeds and of special strings go through the operators whole."""
    from lexiforge.llm import packing

    texts = ["x" * 40_000, "  " * 20_000, "a\n" * 20_000, "<|endoftext|> " * 3000, "đ'ư " * 10_000, "y" * 20_000 + " z" * 10_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: library(vocabulary, t).ids for i, t in enumerate(texts)}
    counts = tokens.count_tokens(df, vocabulary, chunk=1000, overlap=16).collect()
    assert {r.doc_id: r.n_tokens for r in counts} == {i: len(x) for i, x in want.items()}
    stored = token_store.read_tokens(token_store.write_tokens(df, vocabulary), ids=True).collect()
    assert {r.doc_id: r.ids for r in stored} == {i: [*x, 2] for i, x in want.items()}
    pieces = packing.pack_documents(df, vocabulary).collect()
    for i, x in want.items():
        own = sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.piece)
        assert sum(r.length for r in own) == len(x) + 1
        assert all(r.ids_crc32 == zlib.crc32(np.array([*x, 2][r.start : r.start + r.length], "<u4").tobytes()) for r in own)
