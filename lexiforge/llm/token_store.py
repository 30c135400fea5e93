"""Token-ID files: independent zstandard frames with a document index, a trailing seek table and per-frame checksums.

A file is a row of frames, each of which holds the little-endian unsigned 32-bit ids of whole documents (one very long
document may have a frame for itself). After them comes a skippable frame with the document index (ids, number of ids),
then the seek table of the public seekable format: for each frame its compressed size, its size and the low 32 bits of
the XXH64 of its content, and a footer. A reader opens the tail and then reads and decompresses only the frames that hold
the requested documents. Files are written under a temporary name and renamed, so that a task that is run again replaces
its own file.
"""

from __future__ import annotations

import io
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, cut, fresh_path, release, remove, slices, written, written_at
from .tokens import END_ID, ROWS, encoder, tokenizer

# Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A5D
SEEKABLE_FOOTER = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

FRAME_BYTES = 1 << 20
#: ids of one file, about, and the most files: beyond FILES * FILE_IDS ids files grow (a task's sort spills).
FILE_IDS, FILES = 8 << 20, 16_384
LEVEL = 3


def _low32(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class Writer:
    """Writes one file to a binary stream; documents must come in ascending order of their id."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard

        self.out, self.frame_bytes, self.zstd = out, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.pending, self.size, self.frames = [], 0, []
        self.ids, self.null, self.counts, self.frame_of = array("q"), array("B"), array("Q"), array("I")

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.pending.append(ids)
        self.size += len(ids)
        self.ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.counts.append(len(ids) // 4)
        self.frame_of.append(len(self.frames))

    def _flush(self) -> None:
        raw = b"".join(self.pending)
        packed = self.zstd.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), _low32(raw)))
        self.pending, self.size = [], 0

    def close(self) -> None:
        if self.pending:
            self._flush()
        index = self.zstd.compress(b"".join(np.array(x).astype(kind).tobytes() for x, kind in ((self.ids, "<i8"), (self.null, "u1"), (self.counts, "<u8"), (self.frame_of, "<u4"))))
        self.out.write(struct.pack("<III", SKIPPABLE_INDEX, len(index) + 4, len(self.ids)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE_FOOTER)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class Reader:
    """Reads single documents of a file through a seekable stream."""

    def __init__(self, stream):
        import zstandard

        self.stream, self.zstd = stream, zstandard.ZstdDecompressor()
        size = stream.seek(0, io.SEEK_END)
        stream.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEKABLE_FOOTER or not flags & WITH_CHECKSUMS:
            raise ValueError("no seek table with checksums at the file's end")
        stream.seek(size - 9 - 12 * n)
        self.frames = [struct.unpack("<III", stream.read(12)) for _ in range(n)]
        self.at = np.r_[0, np.cumsum([f[0] for f in self.frames])].astype(int)
        stream.seek(int(self.at[-1]))
        magic, length, docs = struct.unpack("<III", stream.read(12))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("no document index after the frames")
        raw = self.zstd.decompress(stream.read(length - 4)) if docs else b""
        self.ids = np.frombuffer(raw, "<i8", docs)
        self.null = np.frombuffer(raw, "u1", docs, 8 * docs).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", docs, 9 * docs).astype(np.int64)
        self.frame_of = np.frombuffer(raw, "<u4", docs, 17 * docs).astype(int)
        ends = np.cumsum(self.counts)
        self.starts = ends - self.counts
        first = np.r_[True, self.frame_of[1:] != self.frame_of[:-1]] if docs else np.empty(0, bool)
        base = self.starts[first]
        self.inside = self.starts - base[self.frame_of] if docs else self.starts

    def frame(self, k: int) -> bytes:
        packed, size, check = self.frames[k]
        self.stream.seek(int(self.at[k]))
        raw = self.zstd.decompress(self.stream.read(packed), max_output_size=size)
        if len(raw) != size or _low32(raw) != check:
            raise ValueError(f"frame {k} is damaged")
        return raw

    def document(self, k: int) -> np.ndarray:
        raw = self.frame(self.frame_of[k])
        return np.frombuffer(raw, "<u4", int(self.counts[k]), 4 * int(self.inside[k]))

    def find(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every document of that id; only their frames are decompressed."""
        return [self.document(k) for k in np.flatnonzero((self.ids == doc_id) & ~self.null)]

    def __iter__(self) -> Iterator[tuple]:
        held, raw = -1, b""
        for k in range(len(self.ids)):
            if self.frame_of[k] != held:
                held, raw = self.frame_of[k], self.frame(self.frame_of[k])
            yield (None if self.null[k] else int(self.ids[k])), int(self.starts[k]), np.frombuffer(raw, "<u4", int(self.counts[k]), 4 * int(self.inside[k]))


def opened(path: str):
    """(pyarrow file system, path in it) for a path or URI."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def binaries(data, ends: np.ndarray):
    """A binary Arrow array of consecutive parts of a buffer; ends: where each ends, in bytes."""
    import pyarrow as pa

    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(data)])


def encoded(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """id, ids (little-endian numbers of the narrowest type that holds the vocabulary) of every row; that type."""
    import pyarrow as pa

    kind = "<u2" if tokenizer(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"
    width = np.dtype(kind).itemsize

    def run(batches: Iterator) -> Iterator:
        own = encoder(tokenizer_path)
        for b in (part for whole in batches for part in slices(whole, ROWS)):
            ids, ends = own.flat(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), binaries(ids.astype(kind), width * ends)], names=["id", "ids"])
        release()

    rows = docs.select(col(docs, id_col).cast("long").alias("id"), col(docs, text_col).alias("t"))
    return rows.mapInArrow(run, "id long, ids binary"), kind


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_ids: int = FILE_IDS, files: int = FILES) -> DataFrame:
    """Encodes every text (null: empty), appends end_id, writes files in ascending id order; returns their manifest.

    Manifest: file_no, path, n_docs, n_ids, n_bytes. Null ids come first; repeated ids stand next to each other. Other
    columns are ignored. An empty table has an empty manifest. path: a folder that all executors share; file_ids: about so
    many ids go to one file, more where that would make more than `files` files. Texts are encoded where they are read;
    only ids are shuffled. Rows of one id are told apart by their place, so that they may fill several files.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    path = path or fresh_path(spark, "token-files")
    ids, kind = encoded(docs, tokenizer_path, id_col, text_col)

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        no, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        out, writer, end = None, None, np.array([end_id], "<u4").tobytes()
        system, folder = opened(path)
        temporary, final = f"{folder}/_{no:06d}.{attempt}", f"{folder}/tokens-{no:06d}.zst"
        for b in batches:
            if writer is None and b.num_rows:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(temporary)
                writer = Writer(out)
            for part in slices(b, ROWS):
                for x, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    writer.add(x, np.frombuffer(raw, kind).astype("<u4").tobytes() + end)
        if writer is not None:
            writer.close()
            size = out.tell()
            out.close()
            system.move(temporary, final)
            yield pa.RecordBatch.from_pydict({"file_no": pa.array([no], pa.int32()), "path": [f"{path}/tokens-{no:06d}.zst"], "n_docs": [len(writer.ids)], "n_ids": [sum(writer.counts)], "n_bytes": [size]})

    rows, at = written_at(ids.withColumn("place", F.monotonically_increasing_id()), "token-ids", compression="zstd")
    total = (rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // np.dtype(kind).itemsize
    wanted = max(1, -(-total // file_ids), min(spark.sparkContext.defaultParallelism, -(-total // (1 << 20))))
    order = [F.col("id").asc_nulls_first(), F.col("place").asc()]
    ordered = rows.repartitionByRange(int(min(wanted, files)), *order).sortWithinPartitions(*order).select("id", "ids")
    manifest = written(ordered.mapInArrow(run, "file_no int, path string, n_docs long, n_ids long, n_bytes long"), "token-manifest")
    remove(spark, at)
    return manifest


def read_tokens(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and the ids) of every document of the files."""
    import pyarrow as pa

    spark = manifest.sparkSession
    before = F.sum("n_ids").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))  # a row per file, of which there are FILES at most
    files = cut(manifest.select("path", F.coalesce(before, F.lit(0)).alias("base")))
    n = max(1, files.count())

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                system, at = opened(path)
                with system.open_input_file(at) as stream:
                    rows = []
                    for doc, start, got in Reader(stream):
                        rows.append((doc, base + start, len(got), zlib.crc32(got.tobytes()), got if ids else None))
                        if len(rows) == 4096 or ids and len(rows) == 64:
                            yield batch(rows)
                            rows = []
                    if rows:
                        yield batch(rows)

    def batch(rows: list) -> pa.RecordBatch:
        doc, start, n, crc, got = zip(*rows, strict=True)
        out = {"doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()), "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
        return pa.RecordBatch.from_pydict(out | ({"ids": pa.array([x.astype(np.int32) for x in got], pa.list_(pa.int32()))} if ids else {}))

    return files.repartition(min(n, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else ""))
