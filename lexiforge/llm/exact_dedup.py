"""Exact dedup: group by a 128-bit content hash, prove equality by bytes inside groups, keep one row.

The texts are read twice and never gathered: the first pass leaves a narrow table (hash, length, id) and the second
compares bytes inside those hashes that more than one row has. Both group with map-side partial sums, so that a hash
that a third of all rows share costs each task one row. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, col, cut, having, small, written


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _hash(norm: Column, bits: int) -> Column:
    full = F.unhex(F.md5(norm))
    return full if bits >= 128 else F.substring(full, 1, max(1, bits // 8))


def _first() -> Column:
    """The row that stays: most code points, smallest id (null last), then any one of repeated rows."""
    return F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), "id", "rid")).alias("first")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 128) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space; of equal ones the row with the most code points, then the
    smallest id stays. Null texts count as empty, and all empty texts are one group. Null ids sort last. Of rows repeated
    whole (same id, same text) one is marked kept. Other columns are ignored, whatever their names. An empty table gives
    an empty result. hash_bits below 128 exists for tests of the byte comparison.
    """
    spark = docs.sparkSession
    base = docs.select(col(docs, id_col).alias("id"), F.coalesce(col(docs, text_col), F.lit("")).alias("t"))
    base = base.withColumn("norm", normalised(F.col("t"))).withColumn("h", _hash(F.col("norm"), hash_bits))
    rows = written(
        base.select("id", "h", F.length("t").alias("n"), F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("rid")),
        "exact-rows",
    )
    groups = rows.groupBy("h").agg(F.count("*").alias("size"), _first()).filter("size > 1")
    groups = cut(groups)
    n_groups = groups.count()
    shared = small(groups.select("h"), n_groups, 48)

    # Bytes: inside a shared hash, each distinct text is one group of (h, norm); a hash with two of them has collided.
    kinds = base.select("h", "norm").join(shared, "h", "left_semi").groupBy("h", "norm").agg(F.count("*").alias("c"))
    collided = cut(kinds.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("h"))
    n_collided = collided.count()

    whole = groups.join(small(collided, n_collided, 48), "h", "left_anti") if n_collided else groups
    same = rows.join(small(collided, n_collided, 48), "h", "left_anti") if n_collided else rows
    out = same.join(small(whole, n_groups, 96), "h", "left").select(
        "id",
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (F.col("rid") == F.col("first.rid"))).alias("kept"),
        "text_sha256",
    )
    if n_collided:  # the same again for the few collided hashes, with the bytes themselves as the key
        odd = base.join(small(collided, n_collided, 48), "h", "left_semi")
        odd = written(odd.select("id", "norm", F.length("t").alias("n"), F.monotonically_increasing_id().alias("rid")), "exact-odd")
        by = odd.groupBy("norm").agg(F.count("*").alias("size"), _first())
        out = out.unionByName(
            odd.join(by, "norm").select("id", F.col("first.id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("rid") == F.col("first.rid")).alias("kept"), F.sha2("norm", 256).alias("text_sha256"))
        )
    return out.withColumnRenamed("id", id_col)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns.

    Rows are found again by (id, hash of the text without white space); of rows repeated whole one stays. Rows that stay
    are not shuffled, but for those that the filter of dropped keys (common.having) takes for dropped by chance.
    """
    found = exact_dedup(docs, id_col, text_col)
    own = found.columns[0]
    gone = written(found.filter(~F.col("kept")).select(F.col(own).alias("g_id"), F.col("text_sha256").alias("g_h")).withColumn("g_keep", F.lit(True)), "exact-gone")
    # A repeated row has both a kept and a dropped copy under the same key; such keys are told apart by their numbers.
    kept = found.filter("kept").select(F.col(own).alias("g_id"), F.col("text_sha256").alias("g_h"))
    twice = cut(kept.join(gone, (kept.g_id.eqNullSafe(gone.g_id)) & (kept.g_h == gone.g_h), "left_semi").distinct())
    n_gone, n_twice = gone.count(), twice.count()
    names = docs.columns
    wide = docs.select(F.struct(*[col(docs, c) for c in names]).alias("row"), col(docs, id_col).alias("d_id"), F.sha2(normalised(col(docs, text_col)), 256).alias("d_h"))
    own = [F.col("d_id"), F.col("d_h")]
    out = having(wide, gone.select("g_id", "g_h").distinct(), own, n_gone, 112, without=True)
    if n_twice:
        again = having(wide, twice, own, n_twice, 112)
        n = F.length(F.coalesce(F.col("row")[text_col], F.lit("")))
        again = again.withColumn("n", n).groupBy("d_id", "d_h").agg(F.max_by("row", "n").alias("row"))
        out = out.select("row").unionByName(again.select("row"))
    return out.select("row.*")
