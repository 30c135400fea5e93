"""Secret scans with corpus-wide ownership frequency.

A pass over the texts finds spans that may hold credentials and leaves their places and the hashes of their values. The
hashes are counted over the whole corpus by distinct owners and repositories: a value that many owners or repositories
have is a widely copied example; one that stays with its owner and looks random is probably live. Bare tokens, which no
key word marks, are reported only if they are live by that measure.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, col, release, salted_join, slices, written
from .tokens import strings

# Kinds in their order and their patterns.
KINDS = ("assign", "access", "hex", "bare")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: A token that stands for itself.
BARE = r"[A-Za-z0-9+/_-]{20,}"
#: A value looks random with a letter, a digit and so many different characters.
DIFFERENT = 8
#: So many distinct owners, or repositories, make a value a widely copied example.
OWNERS, REPOSITORIES = 3, 10
#: Rows of one step of a task.
ROWS = 1024

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS, _HEX, _BARE = (re.compile(p) for p in (ACCESS, HEX.replace("+", "{%d,}" % LEAST["hex"]), BARE))
#: For RE2: texts without a match of it have no span. A superset of the four.
_ANY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|[A-Za-z0-9+/_-]{20}"""


def looks_live(value: str) -> bool:
    return len(set(value)) >= DIFFERENT and re.search("[0-9]", value) is not None and re.search("[A-Za-z]", value) is not None


def spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place in KINDS, end, value) of the base spans and of bare tokens that look random, in this order.

    Matches of a kind are leftmost and do not overlap; those that are too short are dropped after they were matched. (A run of
    hexadecimal digits is matched whole or not at all, so the least length may stand in its pattern.) Bare tokens do not touch
    base spans. The value of an assignment is what is assigned; of the others, the span.
    """
    base = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    base += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    base += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    base.sort()
    found, k, reach = list(base), 0, 0
    for m in _BARE.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            reach = max(reach, base[k][2])
            k += 1
        if reach <= m.start() and looks_live(m[0]):
            found.append((m.start(), 3, m.end(), m[0]))
    found.sort()
    return found


def candidates(docs: DataFrame, repository: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: rid, id, repository, owner, found (array of start, kind, end, live, value's hash)."""
    import pyarrow as pa

    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("live", pa.bool_()), ("h", pa.binary())])

    def of(text: str) -> list[dict]:
        return [{"start": a, "kind": k, "end": z, "live": looks_live(v), "h": hashlib.sha256(v.encode()).digest()[:16]} for a, k, z, v in spans(text)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow.compute as pc

        for b in (part for whole in batches for part in slices(whole, ROWS)):
            texts = strings(b.column(1))
            some = pc.match_substring_regex(texts, _ANY)
            found = [of(t.as_py()) if hit else [] for t, hit in zip(texts, some.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(found, pa.list_(span))], names=["id", "repository", "owner", "found"])
        release()

    rows = docs.select(col(docs, id_col).alias("id"), col(docs, text_col).alias("t"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, repository string, owner string, found array<struct<start: long, kind: int, end: long, live: boolean, h: binary>>"
    return rows.mapInArrow(run, schema).withColumn("rid", F.monotonically_increasing_id())


def ownership(found: DataFrame) -> DataFrame:
    """h, owners, repositories, spans: distinct owners and repositories of each value's hash; found: h, repository, owner.

    Repositories of one name under different owners are different; a null owner or repository counts as one. Rows are summed
    up before each shuffle, so a value that every document holds costs a task one row for each repository it reads.
    """
    pairs = found.groupBy("h", "owner", "repository").agg(F.count("*").alias("n"))
    owned = pairs.groupBy("h", "owner").agg(F.count("*").alias("repositories"), F.sum("n").alias("n"))
    return owned.groupBy("h").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("spans"))


def secret_scan(
    docs: DataFrame,
    repository: Column,
    owner: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    owners: int = OWNERS,
    repositories: int = REPOSITORIES,
) -> DataFrame:
    """One row per input row: id, found: array of (start, kind, end, copied, live), by start, then by kind as listed.

    copied: at least `owners` distinct owners or `repositories` distinct repositories have the value. live: not copied, and the
    value looks random. Base spans (assign, access, hex) are all there; bare tokens only if they are live. Places are code
    points, the end exclusive. Null texts count as empty; rows without spans have an empty array; null and repeated ids have
    rows of their own, and copies of one document in one repository count once. Other columns are ignored, whatever their
    names; an empty table gives an empty result. Values leave the tasks as hashes only.
    """
    rows = written(candidates(docs, repository, owner, id_col, text_col), "secrets")
    each = rows.filter(F.size("found") > 0).select("rid", "id", "repository", "owner", F.explode("found").alias("s")).select("rid", "id", "repository", "owner", "s.*")
    counted = written(ownership(each.select("h", "repository", "owner")), "secret-owners")
    many = (F.col("owners") >= owners) | (F.col("repositories") >= repositories)
    sums = counted.agg(F.count(F.when(many, 1)), F.sum("spans")).first()
    wide, total = sums[0], sums[1] or 0
    narrow = each.drop("repository", "owner")
    if wide * 64 <= BROADCAST_BYTES:
        shared = F.broadcast(counted.filter(many).select("h", F.lit(True).alias("copied")))
        marked = narrow.join(shared, "h", "left").withColumn("copied", F.coalesce("copied", F.lit(False)))
    else:
        marked = salted_join(narrow, counted.select("h", many.alias("copied"), "spans"), "h", "spans", total)
    live = F.col("live") & ~F.col("copied")
    kept = F.when((F.col("kind") < KINDS.index("bare")) | live, F.struct("start", "kind", "end", "copied", live.alias("live")))
    lists = marked.groupBy("rid").agg(F.first("id").alias("id"), F.sort_array(F.collect_list(kept)).alias("found"))
    none = rows.filter(F.size("found") == 0).select("id", F.array().cast("array<struct<start: long, kind: int, end: long, copied: boolean, live: boolean>>").alias("found"))
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    named = F.transform("found", lambda s: F.struct(s["start"].alias("start"), kind(s).alias("kind"), s["end"].alias("end"), s["copied"].alias("copied"), s["live"].alias("live")))
    return lists.select("id", "found").unionByName(none).select(F.col("id").alias(id_col), named.alias("found"))


def joined(found: Column, base_only: bool = False) -> Column:
    """`kind:start:end` of the spans, joined by commas."""
    some = F.filter(found, lambda s: s["kind"] != "bare") if base_only else found
    return F.concat_ws(",", F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def with_flag(found: Column, flag: str) -> Column:
    return F.size(F.filter(found, lambda s: s[flag])).cast("long")
