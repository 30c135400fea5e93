"""What a run tells while it runs: live status, counters of its writes, errors.

Counters come from `DataFrame.observe` on the writes that the stages make anyway, so nothing is scanned a second time. The
status is a log table with one live row a stage: a change is one small run, named by its batch, so that a batch that is
replayed after a stop changes nothing, and readers see either the old or the new row.
"""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections import deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.logtable import LogTable
from ..streaming.events import StatusListener

log = logging.getLogger("lexiforge.run")
#: Characters of an error's message that are kept, and errors.
MESSAGE, ERRORS = 200, 100
STATUS = "step string, at timestamp, state string, processed long, total long, started timestamp, counters map<string, long>"
ERROR = "id string, at timestamp, step string, category string, severity string, message string"


def status_table(spark: SparkSession, out: str) -> LogTable:
    return LogTable(spark, f"{out}/live_status", STATUS, "step", "at")


def counters(df: DataFrame) -> dict[str, Column]:
    """The counters that a stage's table has columns for."""
    have, out = set(df.columns), {"rows": F.count(F.lit(1))}
    if "label" in have:
        out |= {"good": F.count_if(F.col("label") == "good"), "bad": F.count_if(F.col("label") == "bad")}
    if "rescued" in have:
        out["rescued"] = F.count_if(F.col("rescued"))
    if "from_cache" in have:
        out |= {"cache_hits": F.count_if(F.col("from_cache")), "cache_misses": F.count_if(~F.col("from_cache"))}
    if "result" in have:
        out |= {"failed": F.count_if(F.col("result").isNull()), "qa_generated": F.coalesce(F.sum(F.size("result")), F.lit(0))}
    return {k: F.coalesce(c, F.lit(0)).cast("long") for k, c in out.items()}


def observed(df: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """The counters of df, taken by its own write."""
    seen = Observation(f"o{uuid.uuid4().hex}")
    write(df.observe(seen, *[c.alias(k) for k, c in counters(df).items()]))
    return {k: int(v or 0) for k, v in seen.get.items()}


class Monitor:
    """Status, counters and errors of one run under an output folder."""

    def __init__(self, spark: SparkSession, out: str, name: str | None = None):
        """name: what batches are told apart by; a run that goes on after a stop has the same one."""
        self.spark, self.name = spark, name or uuid.uuid4().hex
        self.table = status_table(spark, out)
        self.errors_at = LogTable(spark, f"{out}/errors", ERROR, "id", "at")
        self.errors: deque[dict] = deque(maxlen=ERRORS)
        self.lock, self.step, self.began = threading.RLock(), "idle", None
        self.history: deque[tuple[float, int]] = deque(maxlen=1000)
        self.counters: dict[str, dict[str, int]] = {}

    def _put(self, step: str, state: str, processed: int, total: int, batch: int | None = None) -> bool:
        began = self.began or time.time()
        own = F.create_map(*[x for k, v in self.counters.get(step, {}).items() for x in (F.lit(k), F.lit(v))]) if self.counters.get(step) else F.lit(None)
        row = self.spark.range(1).select(F.lit(step).alias("step"), F.current_timestamp().alias("at"), F.lit(state).alias("state"), F.lit(processed).cast("long").alias("processed"), F.lit(total).cast("long").alias("total"), F.timestamp_seconds(F.lit(began)).alias("started"), own.cast("map<string,long>").alias("counters"))
        source = None if batch is None else f"{self.name}:{step}"
        return self.table.append(row.coalesce(1), source, batch or 0)

    def start(self, step: str, total: int = 0) -> None:
        with self.lock:
            self.step, self.began = step, time.time()
            self.history.clear()
            self._put(step, "running", 0, total)
            log.info("%s begins", step)

    def progress(self, step: str, batch: int, rows: int, total: int = 0) -> bool:
        """Adds a batch's rows to what is processed; False for a batch that was added before."""
        with self.lock:
            live = self.table.read()
            before = live.filter(F.col("step") == step).first() if live is not None else None
            done = (before.processed if before else 0) + rows
            added = self._put(step, "running", done, max(total, before.total if before else 0), batch)
            if added:
                self.history.append((time.time(), rows))
            return added

    def end(self, step: str, own: dict[str, int], failed: bool = False) -> None:
        with self.lock:
            self.counters[step] = own
            rows = own.get("rows", 0)
            self._put(step, "failed" if failed else "completed", rows, rows)
            self.step = "idle"
            log.info("%s: %s", step, ", ".join(f"{k} {v}" for k, v in own.items()) or "failed")

    def record_error(self, error: BaseException | str, category: str = "error", severity: str = "error") -> None:
        """Keeps the first 200 characters of the message, and the last 100 errors."""
        with self.lock:
            self.errors.append({"step": self.step, "category": category, "severity": severity, "message": str(error)[:MESSAGE]})
            e = self.errors[-1]
            row = self.spark.range(1).select(F.lit(uuid.uuid4().hex).alias("id"), F.current_timestamp().alias("at"), *[F.lit(e[n]).alias(n) for n in ("step", "category", "severity", "message")])
            self.errors_at.append(row.coalesce(1))
            log.error("%s: %s", self.step, e["message"])

    def rate(self, seconds: float = 60) -> float:
        """Rows a minute of the last batches: those of `seconds` by the time since the first of them."""
        now = time.time()
        recent = [(t, n) for t, n in self.history if now - t < seconds]
        return sum(n for _, n in recent) / ((now - recent[0][0]) / 60) if len(recent) >= 2 and now > recent[0][0] else 0.0

    def listening(self, step: str) -> Listening:
        return Listening(self, step)


class Listening:
    """While it is entered, the batches of the run's stream become progress of a stage."""

    def __init__(self, monitor: Monitor, step: str):
        self.monitor, self.step, self.listener = monitor, step, StatusListener()
        self.listener.callbacks.append(self._told)

    def _told(self, record: dict) -> None:
        if record["status"] == "running" and record.get("rows") and record.get("name") == self.step:
            self.monitor.progress(self.step, record["batch"], record["rows"])

    def __enter__(self) -> Listening:
        self.monitor.spark.streams.addListener(self.listener)
        return self

    def __exit__(self, *_) -> None:
        self.monitor.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
        self.monitor.spark.streams.removeListener(self.listener)
