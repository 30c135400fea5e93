import pytest
from pyspark.sql import functions as F

from lexiforge.streaming import events

D = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_streams_give_what_batches_give(spark):
    batch = spark.read.parquet(f"{D}/events.parquet")
    for f in (events.tumbling_counts, events.sliding_rate):
        want, got = rows(f(batch)), rows(events.ran(f(events.table_stream(spark, D, "events")), "t"))
        assert [r[:-1] for r in want] == [r[:-1] for r in got]
        assert [r[-1] for r in got] == pytest.approx([r[-1] for r in want])


def test_sessions_of_a_batch(spark):
    at = ["10:00", "10:10", "10:39", "11:30", "11:59"]
    df = spark.createDataFrame([(1, f"2024-01-01 {t}") for t in at], "user_id int, t string").select("user_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    assert sorted(r.n for r in events.sessions(df).collect()) == [2, 3]


def test_repeated_questions_of_a_stream(spark, tmp_path):
    df = spark.createDataFrame([("A  b", "2024-01-01"), (" a B", "2024-01-01"), ("c", "2024-01-01")], "question string, t string").select("question", F.col("t").cast("timestamp").alias("ts"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    assert events.ran(events.first_questions(stream), "q", "append").count() == 2
    assert events.first_questions(df).count() == 2


def test_status_listener(spark):
    seen = []
    listener = events.StatusListener(history=2)
    listener.callbacks.append(seen.append)
    listener.callbacks.append(lambda r: 1 / 0)  # must not end the stream
    spark.streams.addListener(listener)
    try:
        events.ran(events.tumbling_counts(events.table_stream(spark, D, "events")), "s")
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    finally:
        spark.streams.removeListener(listener)
    assert len(listener.records) <= 2


def brute_hits(rows, ttl):
    """(key, ts, hit) by one dictionary in order of time."""
    made, out = {}, []
    for k, t in sorted(rows, key=lambda r: r[1]):
        hit = k in made and t - made[k] < ttl
        out.append((k, t, hit))
        if not hit:
            made[k] = t
    return sorted(out, key=str)


def test_keyed_cache_with_a_time_to_live(spark, tmp_path):
    import datetime as dt

    ev = spark.read.parquet(f"{D}/events.parquet").select(F.col("user_id").cast("string").alias("cache_key"), F.col("ts").cast("timestamp").alias("ts"))
    want = brute_hits([(r.cache_key, r.ts) for r in ev.collect()], dt.timedelta(hours=6))
    assert 0 < sum(h for *_, h in want) < len(want)
    batch = sorted(map(tuple, events.cache_hits(ev, "6 hours").collect()), key=str)
    assert batch == want
    ev.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ev.schema).parquet(str(tmp_path / "in"))
    got = sorted(map(tuple, events.ran(events.cache_hits(stream, "6 hours"), "c", "append").collect()), key=str)
    assert got == want


def test_one_hot_key_repeats_and_nulls(spark):
    """A third of the requests have one key; some stand twice, some have no key or no time."""
    import datetime as dt
    import random

    rng, start = random.Random(2), dt.datetime(2025, 1, 1)
    rows = [("hot" if k % 3 == 0 else f"k{k % 17}", start + dt.timedelta(seconds=rng.randint(0, 4000))) for k in range(900)]
    rows += rows[:50] + [(None, start + dt.timedelta(seconds=k * 7)) for k in range(30)]
    df = spark.createDataFrame(rows, "cache_key string, ts timestamp")
    want = brute_hits(rows, dt.timedelta(seconds=90))
    assert sorted(map(tuple, events.cache_hits(df, "90 seconds").collect()), key=str) == want
    timeless = spark.createDataFrame([("a", None), ("a", None)], "cache_key string, ts timestamp")
    assert [r.hit for r in events.cache_hits(timeless, "1 hour").collect()] == [None, None]
    assert events.cache_hits(df.limit(0), "1 hour").collect() == []


def test_state_is_kept_between_batches(spark, tmp_path):
    """Three files, three batches in order of time: the same hits as of all at once."""
    import datetime as dt

    start = dt.datetime(2025, 1, 1)
    rows = [(f"k{k % 5}", start + dt.timedelta(minutes=k)) for k in range(90)]
    for part in range(3):
        spark.createDataFrame(rows[30 * part : 30 * part + 30], "cache_key string, ts timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("cache_key string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = sorted(map(tuple, events.ran(events.cache_hits(stream, "11 minutes"), "b", "append").collect()), key=str)
    assert got == brute_hits(rows, dt.timedelta(minutes=11))
