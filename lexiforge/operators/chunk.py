"""Overlapping chunks of documents, cut at paragraphs or sentences where that is possible."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import written

ENDS = (". ", ".\n", "? ", "! ")


def window(text: str, start: int, n: int, size: int, overlap: int, base: int = 0) -> tuple[int, int]:
    """(end, next start) of the window at `start` of a text of n characters, of which `text` holds those from `base` on, up to start + size at least.

    It ends after a blank line, else after a sentence, if that lies in its second half; the next one begins `overlap`
    before. Progress is guaranteed whatever the overlap.
    """
    end = start + size
    if end < n:
        half, a, z = start + size // 2, start - base, end - base
        cut = text.rfind("\n\n", a, z) + base
        if cut > half:
            end = cut + 2
        else:
            cut = max(text.rfind(e, a, z) for e in ENDS) + base
            if cut > half:
                end = cut + 1
    return end, max(end - overlap, start + 1) if end < n else end


def chunk_spans(text: str, size: int = 3000, overlap: int = 200) -> Iterator[tuple[int, int]]:
    """Start and end of each window, one after the other."""
    start, n = 0, len(text)
    while start < n:
        end, following = window(text, start, n, size, overlap)
        yield start, end
        start = following


def chunk_text(text: str | None, size: int = 3000, overlap: int = 200) -> list[str]:
    """Stripped non-empty chunks; a text of at most `size` characters stays as it is, an empty one has none."""
    if not text:
        return []
    if len(text) <= size:
        return [text]
    return [piece for a, z in chunk_spans(text, size, overlap) if (piece := text[a:z].strip())]


def chunked(docs: DataFrame, name: str = "file_name", content: str = "content", size: int = 3000, overlap: int = 200) -> DataFrame:
    """doc_name, chunk_id (from 0 within its document), content, and doc_number, issued_date, issued_by if docs has metadata.

    The windows depend on one another, so they are cut in Arrow batches; nothing is shuffled.
    """
    import pyarrow as pa

    meta = "metadata" in docs.columns
    none = F.lit(None).cast("string")
    rows = docs.select(F.col(name).cast("string").alias("doc_name"), F.col(content).alias("content"), *[(F.col(f"metadata.{f}") if meta else none).alias(f) for f in ("doc_number", "issued_date", "issued_by")])

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                every = [chunk_text(x.as_py(), size, overlap) for x in part.column(1)]
                from_row = pa.array([k for k, chunks in enumerate(every) for _ in chunks], pa.int64())
                columns = [part.column(0).take(from_row), pa.array([n for chunks in every for n in range(len(chunks))], pa.int32()), pa.array([x for chunks in every for x in chunks], pa.string())]
                yield pa.RecordBatch.from_arrays(columns + [part.column(k).take(from_row) for k in (2, 3, 4)], names=["doc_name", "chunk_id", "content", "doc_number", "issued_date", "issued_by"])

    return rows.mapInArrow(run, "doc_name string, chunk_id int, content string, doc_number string, issued_date string, issued_by string")


def chunk_total(docs: DataFrame, **limits) -> DataFrame:
    return chunked(docs, **limits).agg(F.count("*").alias("chunks"))


#: Characters of a document that is cut in parts, and of a part; places in a part from which windows are tried.
HUGE, PART, STARTS = 1_000_000, 250_000, 4
#: Rounds in which parts whose windows were not met are walked again, before one task goes through the rest.
ROUNDS = 4
GRAPH = "rid long, start long, end long, next long, blank boolean"
CHUNKS = "doc_name string, chunk_id int, content string, doc_number string, issued_date string, issued_by string"


def walked(text: str, starts: list[int], base: int, stop: int, n: int, size: int, overlap: int) -> list[tuple[int, int, int, bool]]:
    """(start, end, next start, whether it is blank) of the windows that begin at `starts` and of all after them that begin before `stop`."""
    seen: dict[int, tuple] = {}
    for start in starts:
        while start < min(stop, n) and start not in seen:
            end, following = window(text, start, n, size, overlap, base)
            seen[start] = (start, end, following, not text[start - base : end - base].strip())
            start = following
    return list(seen.values())


def chunked_parts(docs: DataFrame, name: str = "file_name", content: str = "content", size: int = 3000, overlap: int = 200, huge: int = HUGE, part: int = PART, starts: int = STARTS) -> DataFrame:
    """As chunked, for tables with documents that are too long for one task: those of more than `huge` characters are cut in parts.

    Where a window begins depends on the one before it, but on nothing else; and windows end at paragraphs and sentences, so
    that walks from different places soon meet. Tasks walk all parts at once from a few places each; then each document's
    windows are linked from its start, by their places alone. A part that the linked windows enter at a place from which
    nobody walked is walked again from there; after ROUNDS rounds one task walks what is left of such a document.
    """
    import pyarrow as pa

    length = F.length(F.coalesce(F.col(content), F.lit("")))
    plain = chunked(docs.filter(length <= huge), name, content, size, overlap)
    meta = "metadata" in docs.columns
    none = F.lit(None).cast("string")
    fields = ("doc_number", "issued_date", "issued_by")
    big = docs.filter(length > max(huge, size)).select(F.monotonically_increasing_id().alias("rid"), F.col(name).cast("string").alias("doc_name"), F.col(content).alias("t"), *[(F.col(f"metadata.{f}") if meta else none).alias(f) for f in fields])
    if huge < size:  # documents of one window
        plain = plain.unionByName(chunked(docs.filter((length > huge) & (length <= size)), name, content, size, overlap))
    k = F.explode(F.sequence(F.lit(0), F.ceil(F.length("t") / part).cast("int") - 1)).alias("k")
    cut = big.select("rid", "doc_name", *fields, F.length("t").cast("long").alias("n"), "t", k)
    cut = cut.select("rid", "doc_name", *fields, "n", "k", F.col("t").substr(F.col("k") * part + 1, F.lit(part + size)).alias("t"))
    parts = written(cut.repartition("rid", "k"), "chunk-parts")
    if parts.isEmpty():
        return plain

    def graph(rows: DataFrame) -> DataFrame:
        """The windows of parts: rid, n, k, t, from (places; null: the part's own)."""

        def run(batches: Iterator) -> Iterator:
            for b in batches:
                out = []
                for rid, n, no, t, places in zip(*(b.column(c).to_pylist() for c in ("rid", "n", "k", "t", "from")), strict=True):
                    base = no * part
                    places = [base + j * min(size, part) // starts for j in range(starts if no else 1)] if places is None else places
                    out += [(rid, *w) for w in walked(t, places, base, base + part, n, size, overlap)]
                if out:
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.bool_())], names=["rid", "start", "end", "next", "blank"])

        return rows.select("rid", "n", "k", "t", "from").mapInArrow(run, GRAPH)

    def link(t: pa.Table) -> pa.Table:
        """A document's windows in order, with the number of each chunk (null: blank), and where the links break off, if they do."""
        of = dict(zip(t["start"].to_pylist(), zip(t["end"].to_pylist(), t["next"].to_pylist(), t["blank"].to_pylist(), strict=True), strict=True))
        rid, n, at, no, out = t["rid"][0].as_py(), t["n"][0].as_py(), 0, 0, []
        while at in of:
            end, following, blank = of[at]
            out.append((at, end, None if blank else no))
            no += not blank
            at = following
        if at < n:
            out.append((at, -1, no))
        s, e, c = zip(*out, strict=True)
        return pa.table({"rid": pa.array([rid] * len(out), pa.int64()), "start": pa.array(s, pa.int64()), "end": pa.array(e, pa.int64()), "chunk_id": pa.array(c, pa.int32())})

    sizes = parts.filter("k = 0").select("rid", "n")
    windows = written(graph(parts.withColumn("from", F.lit(None).cast("array<long>"))), "chunk-windows")
    for last in range(ROUNDS + 1):
        linked = written(windows.join(sizes, "rid").groupBy("rid").applyInArrow(link, "rid long, start long, end long, chunk_id int"), "chunk-links")
        broken = linked.filter("end = -1").select("rid", F.floor(F.col("start") / part).cast("int").alias("k"), F.array("start").alias("from"))
        if broken.isEmpty():
            break
        if last < ROUNDS:
            more = graph(parts.join(broken, ["rid", "k"]))
        else:  # nothing to meet at: a document without ends of sentences
            rest = big.join(broken.select(F.col("rid").alias("_r"), "from"), F.col("rid") == F.col("_r")).select("rid", F.length("t").cast("long").alias("n"), "t", "from")
            more = _walked_on(rest, size, overlap)
        windows = written(windows.unionByName(more).dropDuplicates(["rid", "start"]), "chunk-windows")
    if last == ROUNDS:
        linked = written(windows.join(sizes, "rid").groupBy("rid").applyInArrow(link, "rid long, start long, end long, chunk_id int"), "chunk-links")

    def pieces(batches: Iterator) -> Iterator:
        for b in batches:
            for j in range(b.num_rows):
                t, base, spans = b.column("t")[j].as_py(), b.column("k")[j].as_py() * part, b.column("w")[j].as_py()
                texts = [t[w["start"] - base : w["end"] - base].strip() for w in spans]
                of = pa.array([j] * len(spans), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("doc_name").take(of), pa.array([w["chunk_id"] for w in spans], pa.int32()), pa.array(texts, pa.string()), *[b.column(f).take(of) for f in fields]], names=["doc_name", "chunk_id", "content", *fields])

    spans = linked.filter("chunk_id is not null").withColumn("k", F.floor(F.col("start") / part).cast("int"))
    lists = spans.groupBy("rid", "k").agg(F.collect_list(F.struct("start", "end", "chunk_id")).alias("w"))  # a part's windows
    return plain.unionByName(parts.join(lists, ["rid", "k"]).select("doc_name", *fields, "t", "k", "w").mapInArrow(pieces, CHUNKS))


def _walked_on(rows: DataFrame, size: int, overlap: int) -> DataFrame:
    """All windows from a place to the end of whole texts: rid, n, t, from."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for rid, n, t, places in zip(*(b.column(c).to_pylist() for c in ("rid", "n", "t", "from")), strict=True):
                columns = list(zip(*((rid, *w) for w in walked(t, places, 0, n, n, size, overlap)), strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.bool_())], names=["rid", "start", "end", "next", "blank"])

    return rows.mapInArrow(run, GRAPH)
