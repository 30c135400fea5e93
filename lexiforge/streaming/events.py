"""Structured Streaming: windows over chunk events, scoring and dedup of pairs as they come, a status table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from ..functions.text import normalized, short_md5
from ..operators.score import ScoreRules, routed, rule_score
from ..sources.storage import cut, shared_dir, written


def _timed(events: DataFrame, late: str) -> DataFrame:
    """Watermarks want instants; windows of a batch take times as they are."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def tumbling_counts(events: DataFrame, size: str = "1 hour", late: str = "1 day", key: str = "event_type") -> DataFrame:
    """window_start, key, n, total. Late rows are dropped after `late` on a stream; a batch has no late rows."""
    own = _timed(events, late)
    return own.groupBy(F.window("ts", size).alias("w"), key).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), key, "n", "total")


def sliding_rate(events: DataFrame, size: str = "60 seconds", slide: str = "30 seconds", late: str = "10 minutes") -> DataFrame:
    """window_start, n, rate a minute."""
    own = _timed(events, late)
    out = own.groupBy(F.window("ts", size, slide).alias("w")).agg(F.count("*").alias("n"))
    minutes = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end")) / 60
    return out.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "n", (F.col("n") / minutes).alias("rate"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day", key: str = "user_id") -> DataFrame:
    """key, session_start, session_end, n."""
    own = _timed(events, late)
    return own.groupBy(key, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n")


def scored(pairs: DataFrame, rules: ScoreRules = ScoreRules()) -> DataFrame:
    """Stateless: the rule score and its label."""
    return routed(rule_score(pairs, rules), rules.min_score)


def first_questions(pairs: DataFrame, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Pairs without repeats of a normalised question; a stream forgets keys after `late`."""
    keyed = pairs.withColumn("question_hash", short_md5(F.coalesce(normalized("question"), F.lit(""))))
    if pairs.isStreaming:
        return keyed.withWatermark(ts, late).dropDuplicatesWithinWatermark(["question_hash"])
    return keyed.dropDuplicates(["question_hash"])


def _created(points: DataFrame, span: Column) -> DataFrame:
    """cache_key, ts of the requests that make an entry; points: distinct (cache_key, ts). A key's entries are a chain: its first
    request, the first one at least `span` later, and so on.

    Every request's successor is found by one scan over ranges sorted by (key, time), in which a range hands its first
    request to those before it; so a key that has any share of the rows is cut like the others. The chains are then
    followed by pointer doubling: round r adds 2**r entries to each chain and doubles what a pointer jumps over.
    """
    wanted = points.select("cache_key", (F.col("ts") + span).alias("t"), F.lit(0).alias("kind"), F.col("ts").alias("origin"))
    marks = points.select("cache_key", F.col("ts").alias("t"), F.lit(1).alias("kind"), F.lit(None).cast("timestamp").alias("origin")).unionByName(wanted)
    ranged = marks.repartitionByRange("cache_key", "t", "kind").sortWithinPartitions("cache_key", "t", "kind").withColumn("at", F.monotonically_increasing_id())
    ranged = written(ranged.withColumn("range", F.shiftright("at", 33).cast("int")), "requests-ranged")
    request = F.when(F.col("kind") == 1, F.struct("cache_key", "t"))
    # One row for each range: the first request of the ranges after it.
    firsts = {r["range"]: r.f for r in ranged.groupBy("range").agg(F.min_by(request, F.when(F.col("kind") == 1, F.col("at"))).alias("f")).collect()}
    after, carry = None, []
    for k in sorted(firsts, reverse=True):
        carry.append((k, *(after or (None, None)), after is not None))
        after = firsts[k] or after
    carried = points.sparkSession.createDataFrame(carry, "range int, c_key string, c_t timestamp, c_any boolean")
    down = Window.partitionBy("range").orderBy(F.col("at").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = ranged.withColumn("own", F.last(request, ignorenulls=True).over(down)).filter("kind = 0").join(F.broadcast(carried), "range")
    following = F.coalesce("own", F.when(F.col("c_any"), F.struct(F.col("c_key").alias("cache_key"), F.col("c_t").alias("t"))))
    jumps = found.withColumn("next", following).filter(F.col("next.cache_key").eqNullSafe(F.col("cache_key"))).select("cache_key", F.col("origin").alias("ts"), F.col("next.t").alias("next"))
    jumps = written(jumps, "requests-next")
    entries = cut(points.groupBy("cache_key").agg(F.min("ts").alias("ts")))
    while True:
        ends = entries.select(F.col("cache_key").alias("e_key"), F.col("ts").alias("e_ts"))
        more = cut(jumps.join(ends, F.col("cache_key").eqNullSafe(F.col("e_key")) & (F.col("ts") == F.col("e_ts"))).select("cache_key", F.col("next").alias("ts")))
        if more.isEmpty():
            return entries
        entries = cut(entries.unionByName(more))
        second = jumps.select(F.col("cache_key").alias("s_key"), F.col("ts").alias("s_ts"), F.col("next").alias("after"))
        jumps = cut(jumps.join(second, F.col("cache_key").eqNullSafe(F.col("s_key")) & (F.col("next") == F.col("s_ts"))).select("cache_key", "ts", F.col("after").alias("next")))


class KeyedCache(StatefulProcessor):
    """One value a key, the time of its entry; a timer of event time clears it once the watermark has passed its end."""

    def __init__(self, span_us: int):
        self.span = span_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.created = handle.getValueState("created", "us long")

    def handleInputRows(self, key, rows, timerValues):
        held = self.created.get()
        created = held[0] if held else None
        for t in sorted(r["us"] for r in rows):
            hit = created is not None and t - created < self.span
            if not hit:
                created = t
            yield Row(cache_key=key[0], us=t, hit=hit)
        end, mark = (created + self.span) // 1000, timerValues.getCurrentWatermarkInMs()
        if end > mark:
            self.created.update((created,))
            self.handle.registerTimer(end)
        else:
            self.created.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.created.get()
        if held and (held[0] + self.span) // 1000 <= expiredTimerInfo.getExpiryTimeInMs():  # not a newer entry's
            self.created.clear()
        return iter(())

    def close(self) -> None:
        pass


def cache_hits(requests: DataFrame, ttl: str = "1 hour", late: str = "1 day", key: str = "cache_key", ts: str = "ts") -> DataFrame:
    """cache_key, ts, hit: requests against a keyed cache whose entries live for ttl; a request that finds none makes one.

    A stream keeps one time per key as state, which an event-time timer clears (a life by the clock of the machine would
    end entries that late data still needs). A batch gathers no key: of requests at one time the first is the miss, and one
    without a time is neither.
    """
    span = F.expr(f"INTERVAL {ttl}")
    rows = requests.select(F.col(key).cast("string").alias("cache_key"), F.col(ts).cast("timestamp").alias("ts"))
    if not requests.isStreaming:
        points = written(rows.groupBy("cache_key", "ts").agg(F.count("*").alias("n")), "requests")
        made = _created(points.filter("ts is not null"), span).select(F.col("cache_key").alias("e_key"), F.col("ts").alias("e_ts"), F.lit(True).alias("made"))
        every = points.join(made, F.col("cache_key").eqNullSafe(F.col("e_key")) & (F.col("ts") == F.col("e_ts")), "left")
        no = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("no")
        return every.select("cache_key", "ts", "made", no).select("cache_key", "ts", F.when(F.col("ts").isNotNull(), F.col("made").isNull() | (F.col("no") > 1)).alias("hit"))
    spark = requests.sparkSession
    us = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + span)).first()[0]
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    marked = rows.withWatermark("ts", late).withColumn("us", F.unix_micros("ts"))
    out = marked.groupBy("cache_key").transformWithState(KeyedCache(us), "cache_key string, us long, hit boolean", "append", "EventTime")
    return out.select("cache_key", F.timestamp_micros("us").alias("ts"), "hit")


def ran(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """What a stream gives once all that is there has been read; state and output live in the shared folder."""
    import uuid

    spark = stream.sparkSession
    at = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = f"{at}/out"
    if mode == "append":
        query = stream.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start(path)
    else:  # the whole result of every batch replaces the last one
        query = stream.writeStream.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def table_stream(spark: SparkSession, folder: str, table: str, files: int = 8) -> DataFrame:
    """A table's Parquet file or folder as a stream."""
    one = spark.read.parquet(f"{folder}/{table}.parquet")
    return spark.readStream.schema(one.schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{table}*.parquet")


class StatusListener(StreamingQueryListener):
    """Keeps the last `history` progress records and hands each to the callbacks."""

    def __init__(self, history: int = 100):
        self.history, self.records, self.callbacks = history, [], []

    def onQueryStarted(self, event) -> None:
        self._put({"name": event.name, "status": "started"})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self._put({"name": p.name, "status": "running", "batch": p.batchId, "rows": p.numInputRows, "rows_per_second": p.processedRowsPerSecond})

    def onQueryTerminated(self, event) -> None:
        self._put({"id": str(event.id), "status": "failed" if event.exception else "done"})

    def _put(self, record: dict) -> None:
        self.records = [*self.records, record][-self.history :]
        for f in self.callbacks:
            try:
                f(record)
            except Exception:  # noqa: BLE001, S110  a callback must not end the stream
                pass
