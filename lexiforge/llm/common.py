"""Helpers that every operator of this package shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.storage import cut, fresh_path, remove, shared_dir, written, written_at  # noqa: F401

#: The ASCII white space that the operators' contracts name: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
#: A side of a join is broadcast only if its measured size is below this; beyond it the join shuffles.
BROADCAST_BYTES = 32 << 20
#: Rows of one key that a task of a join may meet without more ado.
HOT = 1_000


def small(df: DataFrame, rows: int, bytes_a_row: int) -> DataFrame:
    """df with a broadcast hint if rows that were counted before prove that it is small; else as it is."""
    return F.broadcast(df) if rows * bytes_a_row <= BROADCAST_BYTES else df


def salted_join(big: DataFrame, lookup: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """The inner join of big with lookup (one row a key, with the number `rows` of big's rows that have it), without big's hot keys in one task.

    A key with more than HOT rows, or a hundred-thousandth of all `total`, is dealt to as many salts as it has such shares, and its
    lookup row is copied to each. At most 100,000 keys are hot, so that their list may be broadcast. `rows` is dropped.
    """
    hot_rows = max(HOT, total // 100_000)
    hot = lookup.filter(F.col(rows) > hot_rows).select(F.col(key).alias("_hot"), F.ceil(F.col(rows) / hot_rows).cast("int").alias("_salts"))
    if not hot.count():
        return big.join(lookup.drop(rows), key)
    hot = cut(hot)
    marked = big.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    dealt = marked.withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_salts")).cast("int"))).drop("_hot", "_salts")
    copies = lookup.drop(rows).join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    copies = copies.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))).drop("_hot", "_salts")
    return dealt.join(copies, [key, "_salt"]).drop("_salt")


#: Bits of a filter of keys: 32 MB, whatever the number of keys is.
FILTER_BITS = 1 << 28


def may_hold(wide: DataFrame, keys: DataFrame, own: list[Column]) -> tuple[DataFrame, Column]:
    """wide beside a bitmap of keys' hashes, and whether a row's hash (of its own key columns) is in it; wrong at most by chance, and never for a key that is there."""
    place = lambda *c: F.pmod(F.xxhash64(*c), F.lit(FILTER_BITS)) + 1
    of = place(*[F.col(c) for c in keys.columns])
    maps = keys.groupBy(F.bitmap_bucket_number(of).alias("_map")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(of)).alias("_bits"))
    marked = wide.withColumn("_place", place(*own))
    marked = marked.join(F.broadcast(maps), F.bitmap_bucket_number("_place") == F.col("_map"), "left").withColumn("_at", F.bitmap_bit_position("_place"))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return marked, F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False))


def having(wide: DataFrame, keys: DataFrame, own: list[Column], n: int, bytes_a_row: int, without: bool = False) -> DataFrame:
    """wide's rows whose key (own, in the order of keys' columns; nulls are equal) is among keys, which have n rows, or those that lack it (without).

    Few keys are broadcast. Of many keys a bitmap of their hashes is, so that of wide's rows, which may hold whole texts, only
    those are shuffled whose key is there, and a share as large as the keys' share of FILTER_BITS.
    """
    same = F.lit(True)
    for c, k in zip(own, keys.columns, strict=True):
        same = same & c.eqNullSafe(F.col(k))
    how = "left_anti" if without else "left_semi"
    if n * bytes_a_row <= BROADCAST_BYTES:
        return wide.join(F.broadcast(keys), same, how)
    marked, hit = may_hold(wide, keys, own)
    met = marked.filter(hit).select(*wide.columns).join(keys, same, how)
    return marked.filter(~hit).select(*wide.columns).unionByName(met) if without else met


def col(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def crc_mod(column: Column, m: int) -> Column:
    """crc32 of an id's decimal text, modulo m; -1 for a null id."""
    return F.coalesce(F.crc32(column.cast("string")) % F.lit(m), F.lit(-1))


def release() -> None:
    """Gives memory that a task no longer needs back to the system: reused Python workers would hold it until they end."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batch, rows: int, size: int = 8 << 20):
    """An Arrow batch in pieces of at most so many rows and about so many bytes; an empty one has none."""
    each = max(1, batch.nbytes // max(1, batch.num_rows))
    rows = max(1, min(rows, size // each))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
