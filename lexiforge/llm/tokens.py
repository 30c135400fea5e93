"""Encoding with the tokenizers library, and token counts of huge documents by overlap resynchronisation.

Byte-level BPE first cuts a text into pieces and no piece reaches across the place between a character that isn't white
space and a single space with another such character after it: each of the cutter's alternatives takes a space only as
the first character of a piece, and runs of white space are looked at one character ahead only. A text is therefore
encoded as the concatenation of its units between those places, and the library is asked once for each unit. Units of
letters, digits and marks only are cut further into the cutter's own pieces, which units share.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, release, slices

END_ID = 2
#: Units of at most UNIT bytes are remembered, about CACHE of them per worker.
UNIT, CACHE = 40, 250_000
#: Bytes of texts that are encoded together, and units of one call's texts.
TOGETHER, JOINED = 3_000_000, 128
#: Rows of one step of a task.
ROWS = 1024
#: Documents of more bytes are counted in overlapping chunks.
CHUNK, OVERLAP = 16_384, 256

# Fixed values, in RE2: white space (Unicode's White_Space and U+001C to U+001F); letters, digits and marks (neither
# letter, number nor white space) of the Latin blocks and general punctuation, without the apostrophe.
_WHITE = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_LETTER = r"A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}"
_DIGIT = "0-9"
_MARK = r"!-&(-/:-@\[-`{-~\x{A1}-\x{A9}\x{AB}-\x{B1}\x{B4}\x{B6}-\x{B8}\x{BB}\x{BF}\x{D7}\x{F7}\x{2010}-\x{2027}"
_SOLID = f"[{_LETTER}{_DIGIT}{_MARK}]+"
#: Units whose pieces are exactly the matches of _PIECE; a line feed in them stands between two solid characters.
_REGULAR = rf"^ ?{_SOLID}(?:\n{_SOLID})*$"
_PIECE = rf"( ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[{_MARK}]+|\n)"
#: Stands between pieces; _REGULAR holds none.
_BETWEEN = "\x01"


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_level(spec: dict) -> bool:
    """Whether a tokenizer file's parts are those that the cuts are proven for; others get whole texts."""
    cutter, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
    cut = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    pairs = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    added = all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) and t["content"] and not any(map(str.isspace, t["content"])) for t in spec.get("added_tokens", []))
    if not (plain and cut and pairs and added):
        return False
    from tokenizers.pre_tokenizers import ByteLevel

    return all(c in model["vocab"] for c in ByteLevel.alphabet())


def _bytes_of(texts) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def strings(texts):
    """An Arrow array of whole texts without nulls (null: empty)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.large_string())
    return pc.fill_null(texts.cast(pa.large_string()), "")


class Encoder:
    """ids of whole texts as unsigned 32-bit numbers, exactly as the library's encode() gives them."""

    def __init__(self, path: str):
        import pyarrow as pa

        self.library = tokenizer(path)
        spec = json.loads(self.library.to_str())
        self.by_units = byte_level(spec)
        if self.by_units:
            from tokenizers import Tokenizer, pre_tokenizers

            self.pieces = Tokenizer(self.library.model)
            self.pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(_BETWEEN), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            self.added = [t["content"] for t in spec["added_tokens"]]
            self.bar = next(((t["content"], t["id"]) for t in spec["added_tokens"]), None)
            of = spec["model"]["vocab"]
            #: Bytes of the text that each token stands for.
            self.widths = np.zeros(max([*of.values(), *(t["id"] for t in spec["added_tokens"])]) + 1, np.int64)
            self.widths[list(of.values())] = [len(t) for t in of]
            for t in spec["added_tokens"]:
                self.widths[t["id"]] = len(t["content"].encode())
        #: Remembered keys (a unit with the space before it, if it has one) and the places of their ids in the pool.
        self.known, self.begins, self.sizes, self.pool = pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def flat(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where those of each text end."""
        texts, ids, ends, base = strings(texts), [], [], 0
        for part in self._parts(texts):
            if self.by_units:
                at, last = self._runs(part)
                got, to = self._gather(at)
                to = to[last]
                self._trim(at)
            else:
                found = [e.ids for e in self.library.encode_batch_fast(part.to_pylist(), add_special_tokens=False)]
                got, to = np.fromiter(chain.from_iterable(found), np.uint32), np.cumsum([len(x) for x in found])
            ids.append(got)
            ends.append(to + base)
            base += len(got)
        return (np.concatenate(ids), np.concatenate(ends)) if ids else (np.empty(0, np.uint32), np.empty(0, np.int64))

    def many(self, texts) -> list[np.ndarray]:
        ids, ends = self.flat(texts)
        return [ids[a:z] for a, z in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    def counts(self, texts) -> np.ndarray:
        """The number of ids of each text."""
        texts, out = strings(texts), [np.empty(0, np.int64)]
        for part in self._parts(texts):
            if self.by_units:
                at, last = self._runs(part)
                out.append(np.diff(np.cumsum(self.sizes[at])[last], prepend=0))
                self._trim(at)
            else:
                out.append(np.array([len(e.ids) for e in self.library.encode_batch_fast(part.to_pylist(), add_special_tokens=False)], np.int64))
        return np.concatenate(out)

    def _parts(self, texts) -> Iterator:
        ends, at = np.cumsum(_bytes_of(texts)), 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TOGETHER, "right")))
            yield texts.slice(at, to - at)
            at = to

    def _runs(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Places among the remembered keys of all units of the texts, and the place of each text's last unit."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.split_pattern(texts, " ")
        lengths = pc.list_value_length(lists).to_numpy().astype(np.int64)
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        words, which = coded.dictionary, coded.indices.to_numpy()
        first = np.zeros(len(which), bool)
        first[np.cumsum(lengths) - lengths] = True
        # A space is no cut where the word before it ends or the word after it begins with white space, or is empty.
        before = pc.match_substring_regex(words, rf"(?:^|[{_WHITE}])$").to_numpy(zero_copy_only=False)
        after = pc.match_substring_regex(words, rf"^(?:$|[{_WHITE}])").to_numpy(zero_copy_only=False)
        begins = np.r_[True, first[1:] | ~(before[which[:-1]] | after[which[1:]])]
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], len(which)]
        long, opens = ends - starts > 1, first[starts]
        single = starts[~long & ~opens]
        used = np.zeros(len(words), bool)
        used[which[single]] = True
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words.filter(pa.array(used)), pa.scalar(" ", pa.large_string()))
        odd, other = np.flatnonzero(long | opens), []
        for run in odd.tolist():
            a, z = starts[run], ends[run]
            text = flat[a].as_py() if z - a == 1 else " ".join(words.take(pa.array(which[a:z])).to_pylist())
            other.append(text if opens[run] else f" {text}")
        rest = pa.array(other, pa.large_string()).dictionary_encode()
        at = self._keyed(pa.concat_arrays([spaced, rest.dictionary]))
        out = np.empty(len(starts), np.int64)
        out[~long & ~opens] = at[(np.cumsum(used) - 1)[which[single]]]
        out[odd] = at[len(spaced) + rest.indices.to_numpy()]
        return out, np.r_[np.flatnonzero(opens)[1:] - 1, len(starts) - 1]

    def _keyed(self, keys) -> np.ndarray:
        import pyarrow as pa
        import pyarrow.compute as pc

        at = pc.fill_null(pc.index_in(keys, value_set=self.known), -1).to_numpy().astype(np.int64)
        missing = at < 0
        if missing.any():
            at[missing] = self._learn(keys.filter(pa.array(missing)))
        return at

    def _learn(self, new) -> np.ndarray:
        """Asks the library for new keys; returns their places among the remembered ones."""
        import pyarrow as pa
        import pyarrow.compute as pc

        regular = pc.match_substring_regex(new, _REGULAR)
        for content in self.added:
            regular = pc.and_not(regular, pc.match_substring(new, content))
        regular = regular.to_numpy(zero_copy_only=False)
        out = np.empty(len(new), np.int64)
        if not regular.all():
            odd = new.filter(pa.array(~regular))
            out[~regular] = self._remember(odd, *self._ask(odd.to_pylist()))
        if not regular.any():
            return out
        solid = new.filter(pa.array(regular))
        marked = pc.replace_substring_regex(solid, _PIECE, rf"\1{_BETWEEN}")
        counts = pc.count_substring(marked, _BETWEEN).to_numpy().astype(np.int64)
        parts = pc.split_pattern(_joined(marked), _BETWEEN).flatten()
        coded = parts.slice(0, len(parts) - 1).dictionary_encode()
        pieces, which = coded.dictionary, coded.indices.to_numpy()
        at = pc.fill_null(pc.index_in(pieces, value_set=self.known), -1).to_numpy().astype(np.int64)
        if (at < 0).any():
            ask = pieces.filter(pa.array(at < 0))
            at[at < 0] = self._remember(ask, *self._ask_pieces(ask))
        places = at[which]
        ends = np.cumsum(counts)
        own = places[ends - 1]
        several = counts > 1
        if several.any():
            inside = np.repeat(several, counts)
            ids, to = self._gather(places[inside])
            to = to[np.cumsum(counts[several]) - 1]
            own[several] = self._remember(solid.filter(pa.array(several)), ids, np.diff(to, prepend=0))
        out[regular] = own
        return out

    def _ask_pieces(self, pieces) -> tuple[np.ndarray, np.ndarray]:
        """ids and numbers of ids of single pieces: many in a text, which the second tokenizer cuts between them only."""
        words = pieces.to_pylist()
        asked = [_BETWEEN.join(words[k : k + JOINED]) for k in range(0, len(words), JOINED)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.pieces.encode_batch_fast(asked, add_special_tokens=False)), np.uint32)
        ends, to = np.cumsum(self.widths[ids]), np.cumsum(_bytes_of(pieces))
        at = np.searchsorted(ends, to)
        if len(ids) and (at[-1] != len(ids) - 1 or (ends[at] != to).any()):
            raise ValueError("pieces and tokens do not end together")
        return ids, np.diff(at, prepend=-1)

    def _ask(self, asked: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids and numbers of ids of any texts: many at once with an added token between, which the library cuts out before all else."""
        if self.bar is None or any(c in t for c in self.added for t in asked):
            found = [e.ids for e in self.library.encode_batch_fast(asked, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(x) for x in found], np.int64)
        content, bar = self.bar
        texts = [content.join(asked[k : k + JOINED]) + content for k in range(0, len(asked), JOINED)]
        ids = np.fromiter(chain.from_iterable(e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)), np.uint32)
        bars = ids == bar
        return ids[~bars], np.diff(np.flatnonzero(bars), prepend=-1) - 1

    def _remember(self, keys, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        import pyarrow as pa

        n, base = len(self.known), len(self.pool)
        self.known = pa.concat_arrays([self.known, keys])
        self.begins = np.r_[self.begins, base + np.cumsum(sizes) - sizes]
        self.sizes = np.r_[self.sizes, sizes]
        self.pool = np.concatenate([self.pool, ids])
        return n + np.arange(len(keys))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of keys in a row, and where those of each end."""
        n = self.sizes[at]
        ends = np.cumsum(n)
        return self.pool[np.repeat(self.begins[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], ends

    def _trim(self, at: np.ndarray) -> None:
        """Forgets all but the short keys that were just used, once there are too many."""
        import pyarrow as pa

        if len(self.known) <= CACHE and len(self.pool) <= 8 * CACHE:
            return
        keep = np.zeros(len(self.known), bool)
        keep[at] = True
        keep &= _bytes_of(self.known) <= UNIT
        kept = np.flatnonzero(keep)
        ids, ends = self._gather(kept)
        self.known, self.pool, self.sizes = self.known.filter(pa.array(keep)), ids, self.sizes[kept]
        self.begins = ends - self.sizes

    def __call__(self, text: str) -> bytes:
        return self.flat([text])[0].tobytes()


def _joined(texts):
    """An Arrow array of one string: all strings in a row."""
    import pyarrow as pa

    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2].slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(data)], np.int64)), data)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _floor(raw: bytes, at: int) -> int:
    """The place of the character that the byte at `at` belongs to."""
    while 0 < at < len(raw) and raw[at] & 0xC0 == 0x80:
        at -= 1
    return min(at, len(raw))


def _around(raw: bytes, at: int) -> tuple[str, str]:
    """The characters before and after a byte of one's own."""
    return raw[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:], raw[at + 1 : at + 5].decode("utf-8", "ignore")[:1]


def stable(raw: bytes, at: int) -> bool:
    """Whether a single space between two characters that aren't white space is there: a cut of byte-level BPE."""
    if raw[at : at + 1] != b" ":
        return False
    left, right = _around(raw, at)
    return bool(left and right) and not left.isspace() and not right.isspace()


def stable_ascii(raw: bytes, at: int) -> bool:
    """Whether a single space between two ASCII letters or digits is there: normalisers leave it and no piece crosses it."""
    if raw[at : at + 1] != b" ":
        return False
    around = "".join(_around(raw, at))
    return len(around) == 2 and around.isascii() and around.isalnum()


@dataclass
class Chunk:
    """start and width of the overlap with the chunk before; starts of the tokens; the place of its splice with the chunk before."""

    start: int
    width: int
    tokens: np.ndarray | None = None
    splice: int | None = None


class Overlaps:
    """One text in overlapping chunks, which are spliced at common token boundaries.

    Both chunks' encodings of an overlap are compared. They are spliced at a boundary that both have, where both have the
    same token before it and after it, and that is a cut which no token crosses whatever stands around it. Where there is
    none the overlap is doubled, up to half a chunk; after that both chunks become one. The bound on what is encoded at
    once is thus the longest stretch without such a cut.
    """

    def __init__(self, text: bytes, chunk: int = CHUNK, overlap: int = OVERLAP, cut=stable):
        self.text, self.chunk, self.cut = text, chunk, cut
        self.chunks = [Chunk(at, overlap) for at in sorted({_floor(text, k) for k in range(0, len(text), chunk)} | {0})]

    def missing(self) -> list[tuple[Chunk, bytes]]:
        """The chunks that have to be encoded next, and their texts."""
        out = []
        for c, after in zip(self.chunks, [*self.chunks[1:], None], strict=True):
            if c.tokens is None:
                end = len(self.text) if after is None else _floor(self.text, min(len(self.text), after.start + after.width))
                out.append((c, self.text[c.start : end]))
        return out

    def align(self) -> None:
        """Splices neighbours that are encoded; widens the overlaps of those that have no common boundary."""
        out = self.chunks[:1]
        for c, after in zip(self.chunks[1:], [*self.chunks[2:], None], strict=False):
            left = out[-1]
            if c.splice is None and left.tokens is not None and c.tokens is not None:
                c.splice = self._splice(left.tokens, c.tokens)
                if c.splice is None:
                    left.tokens, c.width = None, 2 * c.width
                    if 2 * c.width > self.chunk or after is not None and c.start + c.width > after.start:
                        continue  # left takes its place
            out.append(c)
        self.chunks = out

    def _splice(self, left: np.ndarray, right: np.ndarray) -> int | None:
        common = np.intersect1d(left[left > right[0]], right) if len(right) else right
        a, b = np.searchsorted(left, common), np.searchsorted(right, common)
        inside = (a > 0) & (b > 0) & (a + 1 < len(left)) & (b + 1 < len(right))
        common, a, b = common[inside], a[inside], b[inside]
        same = (left[a - 1] == right[b - 1]) & (left[a + 1] == right[b + 1])
        return next((at for at in common[same][::-1].tolist() if self.cut(self.text, at)), None)

    def count(self) -> int:
        """Tokens between the splices."""
        total = 0
        for c, after in zip(self.chunks, [*self.chunks[1:], None], strict=True):
            total += (len(c.tokens) if after is None else int(np.searchsorted(c.tokens, after.splice))) - (0 if c.splice is None else int(np.searchsorted(c.tokens, c.splice)))
        return total


def spliced_counts(texts: list[bytes], token_starts, chunk: int = CHUNK, overlap: int = OVERLAP, cut=stable) -> list[tuple[int, int]]:
    """(tokens, chunks) of each text. token_starts: texts in UTF-8 -> the byte offsets of each one's tokens."""
    every = [Overlaps(t, chunk, overlap, cut) for t in texts]
    while asked := [x for o in every for x in o.missing()]:
        for (c, _), starts in zip(asked, token_starts([t for _, t in asked]), strict=True):
            c.tokens = c.start + starts
        for o in every:
            o.align()
    return [(o.count(), len(o.chunks)) for o in every]


def _starts_by_units(own: Encoder):
    """Token offsets from the ids: every byte-level token stands for a known number of bytes."""

    def of(texts: list[bytes]) -> list[np.ndarray]:
        import pyarrow as pa

        ids, ends = own.flat(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        to = np.cumsum(own.widths[ids])
        from_ = to - own.widths[ids]
        return [from_[a:z] - (from_[a] if z > a else 0) for a, z in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    return of


def _groups(rows: np.ndarray, sizes: np.ndarray) -> Iterator[list[int]]:
    """Rows in groups of about TOGETHER bytes."""
    if len(rows):
        group = np.cumsum(sizes[rows]) // TOGETHER
        yield from (x.tolist() for x in np.split(rows, np.flatnonzero(np.diff(group)) + 1))


@lru_cache(maxsize=4)
def sentences(path: str):
    """(the model, whether no piece has a space inside, so that texts may be spliced)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = map(model.id_to_piece, range(len(model)))
    return model, not any("▁" in p[1:] and set(p) != {"▁"} for p in pieces)


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit, n_chunks.

    Null counts as empty (0 tokens). Texts of more than `chunk` bytes are counted chunk by chunk with overlaps. Other
    columns are ignored; null and repeated ids give rows of their own. .json files go to tokenizers, .model to sentencepiece.
    Texts are encoded whole where no cut is proven: with .json files that aren't plain byte-level BPE (see byte_level), and
    with .model files that have a piece with a space inside.
    """
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        if tokenizer_path.endswith(".model"):
            model, splices = sentences(tokenizer_path)
            counts_of = lambda texts: np.array([len(x) for x in model.encode(texts.to_pylist(), num_threads=1)], np.int64)
            starts_of, cut = (lambda texts: [np.array([p.begin for p in model.encode(t.decode(), return_type="proto").pieces], np.int64) for t in texts]), stable_ascii
        else:
            own = encoder(tokenizer_path)
            splices, counts_of, starts_of, cut = own.by_units, own.counts, _starts_by_units(own), stable
        for b in (part for whole in batches for part in slices(whole, ROWS)):
            texts = strings(b.column(1))
            sizes = _bytes_of(texts)
            long = sizes > chunk if splices else np.zeros(len(sizes), bool)
            counts, chunks = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
            counts[~long] = counts_of(texts.filter(pa.array(~long)))
            for some in _groups(np.flatnonzero(long), sizes):
                found = spliced_counts([texts[k].as_buffer().to_pybytes() for k in some], starts_of, chunk, overlap, cut)
                counts[some], chunks[some] = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(counts), pa.array(counts > limit), pa.array(chunks.astype(np.int32))], names=["id", "n_bytes", "n_tokens", "over_limit", "n_chunks"])
        release()

    ids = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"))
    out = ids.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean, n_chunks int")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", "over_limit", "n_chunks")
