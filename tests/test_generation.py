import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lexiforge.operators import generate
from lexiforge.streaming.generation import Generation

CHUNK = "doc_name string, chunk_id int, content string, doc_number string, issued_date string, issued_by string"


class Noted:
    """Answers every prompt and notes the call in a file; ends its process at the calls whose numbers are given."""

    name, paced = "noted", False

    def __init__(self, folder, ends=()):
        self.folder, self.ends = str(folder), set(ends)

    def call(self, prompt):
        n = len(os.listdir(self.folder))
        if n + 1 in self.ends and not os.path.exists(f"{self.folder}.ended-{n + 1}"):
            open(f"{self.folder}.ended-{n + 1}", "w").close()
            os._exit(3)
        with open(f"{self.folder}/{time.time_ns()}-{os.getpid()}", "w") as f:
            f.write(prompt)
        return json.dumps([{"question": f"{prompt[-8:]}?", "answer": "a" * 120}])


def asked_for(folder):
    return sorted(open(f"{folder}/{n}").read() for n in os.listdir(folder))


def chunks(spark, n):
    rows = [(f"d{k}", k % 3, f"content {k:04d}", None, None, None) for k in range(n)]
    return spark.createDataFrame(rows, CHUNK).repartition(5, "doc_name")


def test_a_stopped_run_asks_for_each_chunk_once(spark, tmp_path):
    """The process of the seventh and of the twelfth call ends; every chunk is asked for once all the same."""
    calls = tmp_path / "calls"
    calls.mkdir()
    cache = generate.CacheTable(spark, str(tmp_path / "cache"))
    own = lambda: Generation(spark, str(tmp_path / "work"), Noted(calls, (7, 12)), "Q {content}", "m", cache, files=2)
    stops = 0
    for _ in range(4):
        try:
            out = own().run(chunks(spark, 25))
            break
        except Exception:  # noqa: BLE001  the stream fails with its task
            stops += 1
            assert 0 < len(os.listdir(calls)) < 25
    assert stops == 2
    texts = asked_for(calls)
    assert len(texts) == 25 == len(set(texts))
    assert sorted(r.content for r in out.collect()) == [f"content {k:04d}" for k in range(25)]
    assert out.filter("result is null or from_cache").count() == 0
    assert cache.read().count() == 25
    # Another generation of the same chunks finds all of them in the cache.
    again = Generation(spark, str(tmp_path / "again"), Noted(calls), "Q {content}", "m", cache).run(chunks(spark, 25))
    assert again.filter("from_cache").count() == 25 and len(os.listdir(calls)) == 25


@pytest.mark.parametrize("step", ["answers", "cache", "journal"])
def test_a_stop_between_a_batchs_writes(spark, tmp_path, monkeypatch, step):
    calls = tmp_path / "calls"
    calls.mkdir()
    cache = generate.CacheTable(spark, str(tmp_path / "cache"))
    own = lambda: Generation(spark, str(tmp_path / "work"), Noted(calls), "Q {content}", "m", cache)
    with monkeypatch.context() as m:

        def fail(*_, **__):
            raise RuntimeError("stopped")

        if step == "answers":
            m.setattr("lexiforge.streaming.generation.remove", fail)  # after the table, before what it was made of goes
        elif step == "cache":
            m.setattr(generate.CacheTable, "append", fail)
        else:
            m.setattr(generate, "outcome", fail)
        with pytest.raises(Exception, match="stopped"):
            own().run(chunks(spark, 9))
    out = own().run(chunks(spark, 9))
    assert out.count() == 9 and len(asked_for(calls)) == 9 and cache.read().count() == 9


def test_no_chunks(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    out = Generation(spark, str(tmp_path / "work"), Noted(calls), "Q {content}", "m").run(chunks(spark, 9).limit(0))
    assert out.count() == 0 and not os.listdir(calls)


def test_journal_keeps_what_each_task_was_told(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    df = spark.range(10).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("prompt"))
    journal = generate.Journal(str(tmp_path / "journal"), every=3)
    assert generate.asked(df, Noted(calls), journal=journal, key="key").count() == 10
    kept = {r.key: (r.response[:14], r.calls) for r in generate.journaled(spark, str(tmp_path / "journal")).collect()}
    assert len(kept) == 10 and set(kept) == set(map(str, range(10)))
    assert generate.asked(df, Noted(calls), journal=journal, key="key").filter("calls = 1 and response is not null").count() == 10
    assert len(os.listdir(calls)) == 10  # the second job had the same partitions
    assert generate.journaled(spark, str(tmp_path / "nowhere")).count() == 0


def test_shares():
    assert generate.shares([5, 1, 0, 9], 6) == [3, 1, 0, 2] or sum(generate.shares([5, 1, 0, 9], 6)) == 6
    assert generate.shares([2, 2], 10) == [2, 2] and generate.shares([0, 0], 3) == [0, 0]
    turns = [generate.shares([1, 1, 1], 1, t) for t in range(3)]
    assert sorted(turns) == [[0, 0, 1], [0, 1, 0], [1, 0, 0]]


class Timed:
    """Notes when calls begin; each takes a while, and every fifth fails once with a limit of the rate."""

    name, paced = "timed", True

    def __init__(self, folder, fails=False):
        self.folder, self.fails, self.seen = str(folder), fails, set()

    def call(self, prompt):
        open(f"{self.folder}/{time.time_ns()}-{os.getpid()}", "w").close()
        time.sleep(0.15)
        if self.fails and prompt.endswith("5") and prompt not in self.seen:
            self.seen.add(prompt)
            raise RuntimeError("429 rate limit")
        return "x" + prompt


@pytest.mark.parametrize("fails", [False, True])
def test_uneven_tasks_share_one_rate(spark, tmp_path, fails):
    """One partition has nearly all rows: the rate is never exceeded, and 90 % of it is used."""
    spark.range(4).repartition(4).mapInArrow(lambda it: it, "id long").count()  # workers are there
    df = spark.sparkContext.parallelize([[f"p{k}" for k in range(60)], ["a"], ["b"], []], 4).flatMap(lambda x: x).map(lambda x: (x,)).toDF("prompt string")
    rpm, retries = 900, generate.Retries(3, 0.0)
    began = time.time()
    rows = generate.asked(df, Timed(tmp_path, fails), rpm=rpm, threads=32, retries=generate.Retries(3, 0.01) if fails else retries, tasks=0).collect()
    assert sorted(r.response for r in rows) == sorted(f"x{p}" for p in [*(f"p{k}" for k in range(60)), "a", "b"])
    assert all(r.error is None and r.calls == (2 if fails and r.prompt.endswith("5") else 1) for r in rows)
    at = sorted(int(n.split("-")[0]) / 1e9 for n in os.listdir(tmp_path))
    assert len(at) == (68 if fails else 62)
    per = rpm / 60
    for k, t in enumerate(at):  # calls of any second
        assert sum(t <= u < t + 1 for u in at[k:]) <= per * 1.2 + 1
    if not fails:
        assert len(at) / (at[-1] - at[0]) >= 0.9 * per, (at[-1] - at[0], time.time() - began)
