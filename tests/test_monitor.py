import pytest
from pyspark.sql import functions as F

from lexiforge.plans.curate import Curation
from lexiforge.plans.monitor import Monitor, counters, observed, status_table
from lexiforge.sources import sinks

from .test_plans import settings


def documents(tmp_path, n=6):
    (tmp_path / "in").mkdir()
    for k in range(n):
        (tmp_path / "in" / f"{k}.txt").write_text(f"Luật số: {k + 1}/2024/QH15\nLUẬT\n" + f"Điều {k}. Nội dung quy định về mức hưởng 30 ngày. " * 30)


def test_counters_are_those_of_aggregates(spark, tmp_path):
    df = spark.range(50).selectExpr("id", "if(id % 3 = 0, 'good', 'bad') AS label", "id % 5 = 0 AS from_cache", "if(id % 7 = 0, null, array(id, id)) AS result", "if(id % 2 = 0, true, null) AS rescued")
    seen = observed(df, lambda x: x.write.parquet(str(tmp_path / "t")))
    want = df.agg(*[c.alias(k) for k, c in counters(df).items()]).first().asDict()
    assert seen == want and seen["rows"] == 50 and seen["failed"] == 8 and seen["qa_generated"] == 84 and seen["rescued"] == 25
    assert observed(df.limit(0), lambda x: x.write.parquet(str(tmp_path / "u")))["qa_generated"] == 0


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path)
    m = Monitor(spark, out, "run")
    m.start("generate", 40)
    assert m.progress("generate", 0, 10) and m.progress("generate", 1, 10)
    again = Monitor(spark, out, "run")  # another process of the same run
    assert not again.progress("generate", 1, 10)
    assert again.progress("generate", 2, 5)
    r = sinks.status(spark, out).first()
    assert (r.step, r.processed, r.total, r.percent, r.state) == ("generate", 25, 40, 62.5, "running")
    assert m.rate() > 0 and Monitor(spark, out, "x").rate() == 0
    m.end("generate", {"rows": 25, "good": 3})
    r = sinks.status(spark, out).first()
    assert r.state == "completed" and r.counters == {"rows": 25, "good": 3}
    assert sum("run" in e for e in status_table(spark, out).state()[1]["entries"]) <= 4  # compacted


def test_errors_are_cut(spark, tmp_path):
    m = Monitor(spark, str(tmp_path))
    m.record_error("x" * 300, "api", "critical")
    assert [len(r.message) for r in m.errors_at.read().collect()] == [200] and m.errors.maxlen == 100


def test_a_run_leaves_its_status_counters_and_errors(spark, tmp_path):
    documents(tmp_path)
    run = Curation(spark, settings(tmp_path))
    assert run.run() == ["extract", "generate", "evaluate", "split", "export"]
    live = {r.step: r for r in sinks.status(spark, run.out).collect()}
    assert set(live) == {"extract", "generate", "evaluate", "split", "export"} and {r.state for r in live.values()} == {"completed"}
    e = run.read("evaluate").agg(F.count("*").alias("n"), F.count_if(F.col("label") == "good").alias("good")).first()
    assert live["evaluate"].counters["rows"] == e.n == live["evaluate"].processed and live["evaluate"].counters["good"] == e.good
    assert live["generate"].counters["rows"] == run.read("generate").count() and live["generate"].counters["cache_misses"] > 0
    applied = status_table(spark, run.out).state()[1]["applied"]
    assert applied == {f"{run.out}:generate": 0}  # the stream's one batch was told by the listener
    run.monitor.table.vacuum()
    run.split = lambda: (_ for _ in ()).throw(RuntimeError("no split"))
    with pytest.raises(RuntimeError):
        run.run(["split"])
    assert {r.step: r.state for r in sinks.status(spark, run.out).collect()}["split"] == "failed"
    assert run.monitor.errors_at.read().first().message == "no split"
