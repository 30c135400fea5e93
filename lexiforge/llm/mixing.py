"""Mixing sources to target weights by Efraimidis-Spirakis keys. Only DataFrame functions are used.

A document's key is -ln(u) / w for a uniform u made from its id and its quality weight w; the smallest keys of a source
form a weighted sample without replacement. No source is sorted in one task: keys fall into equal steps of a monotone
measure, the steps' word sums are added up per source, and only the one step that the budget ends in is ordered.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .common import WORD, col, cut, small, written

#: Base weights by a source's rank, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of the words of all sources.
SHARE = 1.5
#: No source gives more than so many complete epochs.
EPOCHS = 2
#: Documents in one step of the key, on average, at least: the square root of all where that is more, so that neither a step's
#: documents nor a source's steps are many for one task.
STEP_ROWS = 1_000


def words(text: Column) -> Column:
    """Number of runs without ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*parts: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of an md5."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size -> rank by code point (null last), target.

    Water filling in closed form: by ascending cap / weight, sources are capped for as long as the level of what is left
    exceeds their cap; the others share the rest by weight. One window over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("w", w).withColumn("cap", F.col("source_size").cast("double") * epochs)
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranked.withColumns({"budget": F.sum(F.col("source_size").cast("double")).over(everything) * share, "all_w": F.sum("w").over(everything), "to_cap": F.sum("cap").over(order), "to_w": F.sum("w").over(order)})
    level = (F.col("budget") - (F.col("to_cap") - F.col("cap"))) / (F.col("all_w") - (F.col("to_w") - F.col("w")))
    ranked = ranked.withColumn("full", level * F.col("w") >= F.col("cap"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    left_w = F.sum(F.when(~F.col("full"), F.col("w"))).over(everything)
    return ranked.select("source", "source_size", "rank", F.when(F.col("full"), F.col("cap")).otherwise(left * F.col("w") / left_w).alias("target"))


def _keyed(docs: DataFrame, id_col: str, source_col: str, text_col: str, quality: DataFrame | None, seed: int) -> DataFrame:
    """docs as a struct `row` beside id, source, size, key and place (which tells rows apart that are repeated under an id)."""
    text = col(docs, text_col)
    wide = docs.select(F.struct(*[col(docs, c) for c in docs.columns]).alias("row"), col(docs, id_col).alias("id"), col(docs, source_col).alias("source"), words(text).alias("size"), uniform(F.coalesce(col(docs, id_col).cast("string"), F.md5(F.coalesce(text, F.lit("")))), seed=seed).alias("u"), F.monotonically_increasing_id().alias("place"))
    if quality is None:
        return wide.withColumn("key", -F.log("u"))
    quality = cut(quality.filter("q_w <> 1"))
    weighed = weighted(wide, quality, quality.count())
    return weighed.withColumn("key", -F.log("u") / F.coalesce(F.col("q_w"), F.lit(1.0))).drop("q_id", "q_w")


def weighted(wide: DataFrame, quality: DataFrame, n: int) -> DataFrame:
    """wide with q_id and q_w of the n rows of quality; documents without a weight of their own do not move to meet the others'."""
    same = F.col("id") == F.col("q_id")
    if n * 32 <= common.BROADCAST_BYTES:
        return wide.join(F.broadcast(quality), same, "left")
    marked, hit = common.may_hold(wide, quality.select("q_id"), [F.col("id")])
    met = marked.filter(hit).select(*wide.columns).join(quality, same, "left")
    alone = marked.filter(~hit).select(*wide.columns, F.lit(None).cast(quality.schema["q_id"].dataType).alias("q_id"), F.lit(None).cast("double").alias("q_w"))
    return alone.unionByName(met)


def quality_weights(labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", high: float = 2.0, low: float = 0.5) -> DataFrame:
    """q_id, q_w: one weight per labelled document (high if any of its labels is 1); documents without one weigh 1."""
    return labels.filter(col(labels, id_col).isNotNull()).groupBy(col(labels, id_col).alias("q_id")).agg(F.max(F.coalesce(col(labels, good_col).cast("double"), F.lit(-1.0))).alias("q")).select("q_id", F.when(F.col("q") >= 1, high).when(F.col("q") >= 0, low).otherwise(1.0).alias("q_w"))


def plan_mix(keyed: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """Per source: m_source, source_size, target, epochs (whole ones) and the last document of the fractional one.

    A document with (key, id, size) up to `cut` is taken once more. The document that crosses the budget is taken if that
    brings the source nearer to its target. Of rows that are repeated there, those up to cut_place are.
    """
    rows = keyed.select("source", "id", "size", "key", "place")
    total = rows.count()
    n = max(1, total // max(STEP_ROWS, isqrt(total)))
    rows = rows.withColumn("step", F.floor((1 - F.exp(-F.col("key"))) * n))
    steps = cut(rows.groupBy("source", "step").agg(F.sum("size").alias("step_size")))
    plan = targets(steps.groupBy("source").agg(F.sum("step_size").alias("source_size")), weights, share, epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    plan = plan.withColumn("epochs", whole.cast("long")).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = cut(plan.withColumnsRenamed({"source": "m_source"}))
    before = F.sum("step_size").over(Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1))
    last = steps.withColumn("before", F.coalesce(before, F.lit(0))).join(plan.select("m_source", "rest"), F.col("source").eqNullSafe(F.col("m_source"))).filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("step_size") >= F.col("rest")))
    last = last.select("m_source", F.col("step").alias("m_step"), "before", "rest")
    inside = rows.join(last, F.col("source").eqNullSafe(F.col("m_source")) & (F.col("step") == F.col("m_step")))
    tied = inside.groupBy("m_source", "before", "rest", "key", "id", "size").agg(F.sum("size").alias("run"), F.count("*").alias("c"))  # repeated rows are one run
    upto = F.sum("run").over(Window.partitionBy("m_source").orderBy("key", F.col("id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    tied = tied.withColumn("upto", F.col("before") + upto)
    # Taken while that does not lead further away: the middle of the document lies within the budget.
    room = (F.col("rest") - (F.col("upto") - F.col("run"))) / F.col("size")
    m = F.when(F.col("upto") <= F.col("rest"), F.col("c")).when(F.col("size") > 0, F.least(F.col("c"), F.floor(room + 0.5))).otherwise(0)
    taken = tied.withColumn("m", m).filter("m > 0")
    ends = taken.groupBy(F.col("m_source").alias("e_source")).agg(F.max(F.struct("key", F.col("id").isNull().alias("no_id"), "id", "size", "m", "c")).alias("x"))
    ends = cut(ends.select("e_source", F.struct("x.key", "x.no_id", "x.id", "x.size").alias("cut"), "x.m", "x.c"))
    parted = ends.filter("m < c")
    if n_parted := parted.count():
        ends = ends.join(small(_part_places(rows, parted, n_parted), n_parted, 64), ends.e_source.eqNullSafe(F.col("p_source")), "left")
    else:
        ends = ends.withColumn("cut_place", F.lit(None).cast("long"))
    first = last.select(F.col("m_source").alias("l_source"), F.col("m_step").alias("l_step"))
    out = plan.join(first, plan.m_source.eqNullSafe(F.col("l_source")), "left").join(ends, plan.m_source.eqNullSafe(F.col("e_source")), "left")
    return cut(out.select("m_source", "source_size", "target", "epochs", F.lit(n).alias("n_steps"), F.col("l_step").alias("cut_step"), "cut", "cut_place"))


def _part_places(rows: DataFrame, parted: DataFrame, n: int) -> DataFrame:
    """p_source, cut_place: the place of the m-th row of each source's parted run. A run may have any share of the rows: its
    places are counted in blocks of 2**20, and only the block of the m-th is ordered."""
    wanted = parted.select(F.col("e_source").alias("p_source"), F.col("cut.key").alias("p_key"), F.col("cut.id").alias("p_id"), F.col("cut.size").alias("p_size"), "m")
    same = F.col("source").eqNullSafe(F.col("p_source")) & (F.col("key") == F.col("p_key")) & F.col("id").eqNullSafe(F.col("p_id")) & (F.col("size") == F.col("p_size"))
    run = rows.join(small(wanted, n, 64), same).select("p_source", "place", "m", F.shiftright("place", 20).alias("block"))
    blocks = run.groupBy("p_source", "m", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("p_source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    hit = blocks.withColumn("before", before).filter((F.col("before") < F.col("m")) & (F.col("m") <= F.col("before") + F.col("n")))
    hit = hit.select(F.col("p_source").alias("h_source"), F.col("block").alias("h_block"), (F.col("m") - F.col("before")).cast("int").alias("nth"))
    own = run.join(small(hit, n, 64), F.col("p_source").eqNullSafe(F.col("h_source")) & (F.col("block") == F.col("h_block")))
    return own.groupBy("p_source", "nth").agg(F.sort_array(F.collect_list("place")).alias("places")).select("p_source", F.element_at("places", F.col("nth")).alias("cut_place"))


def mix_sources(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """row (the input row as a struct), id, size, source_size, target, copies, taken (= size * copies).

    Null texts have size 0; the null source is a source of its own and ranks last; a source without words has target 0.
    Rows repeated under one id have one key; where the budget ends among them, the first ones are taken. Reruns agree: the only
    randomness is a hash of the id (of the text where the id is null). Extra columns only travel inside row. An empty table gives an empty result.
    """
    keyed = _keyed(docs, id_col, source_col, text_col, quality, seed)
    narrow = written(keyed.select("source", "id", "size", "key", "place"), "mix-keys")
    return _applied(keyed, plan_mix(narrow, weights, share, epochs))


def _applied(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    own = F.struct("key", F.col("id").isNull().alias("no_id"), "id", "size")
    step = F.floor((1 - F.exp(-F.col("key"))) * F.col("n_steps"))
    extra = F.when(F.col("cut_step").isNull(), F.lit(0)).when(step < F.col("cut_step"), 1).when((step == F.col("cut_step")) & ((own < F.col("cut")) | (own == F.col("cut")) & (F.col("cut_place").isNull() | (F.col("place") <= F.col("cut_place")))), 1).otherwise(0)
    # One row a source: where they are few, documents need not be shuffled to meet them.
    out = keyed.join(small(plan, plan.count(), 512), F.col("source").eqNullSafe(F.col("m_source")))
    out = out.withColumn("copies", F.col("epochs") + F.coalesce(extra, F.lit(0)))
    kept = [c for c in ("row", "id") if c in keyed.columns]
    return out.select(*kept, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix_counts(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7, **plan) -> DataFrame:
    """As mix_sources without the row: texts are read once, for their sizes."""
    narrow = written(_keyed(docs, id_col, source_col, text_col, quality, seed).select("source", "id", "size", "key", "place"), "mix-keys")
    return _applied(narrow, plan_mix(narrow, **plan))
