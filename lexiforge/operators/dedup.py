"""Duplicates of question-answer pairs: by question hash, by the order-first matching of questions and answers, and near."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import c, normalized, question_key, rounded, short_md5, strip
from ..sources.storage import cut, written

#: A side of a join is broadcast only if its measured size is below this.
BROADCAST_BYTES = 32 << 20
#: Keys that one task may fold in order.
SMALL_REST = 200_000


def dedup_question_hash(df: DataFrame, question: str = "question", order: str = "seq") -> DataFrame:
    """The first row of each normalised question. Only (hash, order) is aggregated, and rows join back by their order."""
    keyed = df.withColumn("question_hash", short_md5(F.coalesce(normalized(question), F.lit(""))))
    first = keyed.groupBy("question_hash").agg(F.min(order).alias(order))
    return keyed.join(first, ["question_hash", order], "left_semi")


def fold_pairs(df: DataFrame, question: str = "question", answer: str = "answer", order: str = "seq", small_rest: int = SMALL_REST) -> DataFrame:
    """df with opener and kept: the greedy order-first matching between question keys and answer keys.

    A row opens a slot if its question is new and its answer was not seen with an opened question; later rows of an
    opened question compete with a longer answer, the first of the longest stays in the opener's place. Each round finds
    all rows that are first of both their question and their answer among what is left and removes what they block, over
    distinct (question, answer) keys only. Once at most small_rest keys are left (they were counted), one task folds them in
    order, so that long chains of few keys do not take a round for each link.
    """
    rows = df.withColumns({"_q": F.md5(question_key(question)), "_a": F.md5(question_key(answer)), "_len": F.length(F.coalesce(c(answer), F.lit("")))})
    left = rows.groupBy("_q", "_a").agg(F.min(order).alias("_s"))
    opened = None
    while True:
        first_q = left.groupBy("_q").agg(F.min("_s").alias("_qs"))
        first_a = left.groupBy("_a").agg(F.min("_s").alias("_as"))
        now = cut(left.join(first_q, "_q").join(first_a, "_a").filter("_s = _qs and _s = _as").select("_q", "_a", "_s"))
        opened = now if opened is None else opened.unionByName(now)
        left = cut(left.join(now.select("_q"), "_q", "left_anti").join(now.select("_a"), "_a", "left_anti"))
        if (rest := left.count()) <= small_rest:
            break
    if rest:
        opened = opened.unionByName(_opened_in_order(left))
    slots = opened.select("_q", F.col("_s").alias("opener"))
    rivals = rows.join(slots, "_q").filter(F.col(order) >= F.col("opener"))
    best = rivals.groupBy("_q").agg(F.min(F.struct(-F.col("_len"), F.col(order).alias("s"))).alias("b")).select("_q", F.col("b.s").alias("_best"))
    out = rows.join(slots.join(best, "_q"), "_q", "left").withColumn("kept", F.coalesce(F.col(order) == F.col("_best"), F.lit(False)))
    return out.drop("_q", "_a", "_len", "_best")


def _opened_in_order(left: DataFrame) -> DataFrame:
    """_q, _a, _s of the keys that open a slot; one task, for a small rest."""
    import pyarrow as pa

    def run(batches):
        questions, answers = set(), set()
        for b in batches:
            q, a = b.column(0).to_pylist(), b.column(1).to_pylist()
            keep = []
            for k, (x, y) in enumerate(zip(q, a, strict=True)):
                if x not in questions and y not in answers:
                    questions.add(x)
                    answers.add(y)
                    keep.append(k)
            yield b.take(pa.array(keep, pa.int64()))

    own = left.select("_q", "_a", "_s")
    return own.repartition(1).sortWithinPartitions("_s").mapInArrow(run, own.schema)


def dedup_pairs(df: DataFrame, **columns) -> tuple[DataFrame, DataFrame]:
    """(unique pairs, duplicates)."""
    out = fold_pairs(df, **columns)
    return out.filter("kept").drop("kept"), out.filter(~F.col("kept")).drop("kept", "opener")


def code_points(x):
    """The stripped lower-case text as an array of longs."""
    t = F.lower(strip(F.coalesce(c(x), F.lit(""))))
    return F.transform(F.regexp_extract_all(t, F.lit("(?s)(.)"), F.lit(1)), lambda x: F.ascii(x).cast("long"))


def trigrams(codes):
    """Distinct runs of three code points, each as a long of 21 bits a code point."""
    shifted = lambda k, bits: F.transform(F.slice(codes, k, F.greatest(F.size(codes) - 2, F.lit(0))), lambda x: F.shiftleft(x, bits))
    return F.array_distinct(F.zip_with(F.zip_with(shifted(1, 42), shifted(2, 21), lambda x, y: x + y), shifted(3, 0), lambda x, y: x + y))


#: A trigram is frequent if it stands in so large a share of the rows; rarer ones are of one rank. So at most the mean number of
#: a row's trigrams divided by it are frequent.
FREQUENT = 1 / 1000


def ranked_trigrams(rows: DataFrame) -> DataFrame:
    """i, size and s, the row's trigrams from the globally rarest to the most frequent; rows: i, g."""
    each = rows.select("i", F.explode("g").alias("gram"))
    n = rows.count()
    frequent = cut(each.groupBy("gram").agg(F.count("*").alias("times")).filter(F.col("times") >= max(2, int(n * FREQUENT))))
    near = F.broadcast(frequent) if 16 * frequent.count() <= BROADCAST_BYTES else frequent
    ranked = each.join(near, "gram", "left").select("i", F.struct(F.coalesce("times", F.lit(0)).alias("times"), "gram").alias("r"))
    return ranked.groupBy("i").agg(F.sort_array(F.collect_list("r")).alias("r")).select("i", F.size("r").alias("size"), F.col("r.gram").alias("s"))


def near_pairs(df: DataFrame, question: str = "question", order: str = "seq", threshold: float = 0.8, limit: int | None = None, band: int = 99) -> DataFrame:
    """i, j, similarity: pairs of questions at most `band` places apart whose trigram sets are alike but not equal.

    Two sets that are alike share one of the few rarest trigrams of both (the prefix filter), and from that place on enough
    of them can be left (the position filter). So rows meet by (trigram of the prefix, bucket of band + 1 places), in the
    own bucket and the next one, where a key has at most two buckets' rows; only pairs that are left are intersected, once.
    All rows are compared; limit, which is off, bounds them to the first ones.
    """
    codes = df.select(F.col(order).alias("_o"), code_points(question).alias("codes"))
    numbered = in_order(codes.select("_o", trigrams("codes").alias("g")), "_o").select("i", "g")
    if limit is not None:
        numbered = numbered.filter(F.col("i") < limit)
    ordered = written(ranked_trigrams(numbered), "trigrams")
    width, exact = band + 1, 1e-9  # what floating point may add to a product
    prefix = (F.col("size") - F.ceil(F.col("size") * threshold - exact) + 1).cast("int")
    left = ordered.select("i", "size", F.floor(F.col("i") / width).alias("b"), F.posexplode(F.slice("s", 1, prefix)).alias("at", "gram"))
    right = left.select("gram", F.col("i").alias("j"), F.col("size").alias("other"), F.col("at").alias("place"), F.explode(F.array(F.col("b"), F.col("b") - 1)).alias("b"))
    close = (F.col("j") > F.col("i")) & (F.col("j") <= F.col("i") + band)
    alike = F.least("size", "other") >= F.lit(threshold) * F.greatest("size", "other") - exact  # sets of other sizes can't be alike
    needed = F.ceil((F.col("size") + F.col("other")) * (threshold / (1 + threshold)) - exact)
    enough = F.least(F.col("size") - F.col("at"), F.col("other") - F.col("place")) >= needed
    pairs = left.join(right, ["gram", "b"]).filter(close & alike & enough).select("i", "j").distinct()
    own = ordered.select("i", F.col("s").alias("g"))
    other = ordered.select(F.col("i").alias("j"), F.col("s").alias("h"))
    # The generator keeps the optimiser from copying the intersection into every condition on it.
    both = pairs.join(own, "i").join(other, "j").select("i", "j", (F.size("g") + F.size("h")).alias("m"), F.explode(F.array(F.size(F.array_intersect("g", "h")))).alias("n"))
    found = both.withColumn("s", F.col("n") / F.greatest(F.col("m") - F.col("n"), F.lit(1)))
    return found.filter((F.col("s") >= threshold) & (F.col("s") < 1)).select("i", "j", rounded(F.col("s"), 3).alias("similarity"))


def in_order(df: DataFrame, order: str) -> DataFrame:
    """df with i, its place from 0 by order. Rows are dealt by ranges of order and sorted in their tasks; the counts of the
    tasks are added up, so that no task holds all rows whatever the values of order are."""
    place = F.monotonically_increasing_id()
    dealt = written(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("_place", place), "in-order")
    task = F.shiftrightunsigned("_place", 33)
    counts = dealt.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))  # a row per task
    before = counts.select("_task", F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.col("_place") - F.shiftleft(task, 33)
    return dealt.withColumn("_task", task).join(F.broadcast(before), "_task").withColumn("i", F.col("_before") + inside).drop("_task", "_place", "_before")


def duplicate_groups(df: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    """kind, key, n: questions that occur more than once, and first 100 characters of such answers (the counts of answers
    that share them: the one that occurs last stays, so the largest is reported)."""
    q = df.groupBy(question_key(question).alias("key")).agg(F.count("*").alias("n")).filter("n > 1")
    a = df.groupBy(question_key(answer).alias("full")).agg(F.count("*").alias("n")).filter("n > 1")
    a = a.groupBy(F.substring("full", 1, 100).alias("key")).agg(F.max("n").alias("n"))
    return q.select(F.lit("question").alias("kind"), "key", "n").unionByName(a.select(F.lit("answer").alias("kind"), "key", "n"))
