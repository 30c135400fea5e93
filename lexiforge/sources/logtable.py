"""A keyed table as a log of immutable runs, with tombstones, a manifest that one rename replaces, and compaction.

A folder holds `runs/<id>` (Parquet tables that are never changed) and `manifest/<number>` (JSON). The manifest of the highest
number is the table's state: a list of entries in the order in which they were committed. An entry is a run (rows, or
tombstones of single keys) or a time before which all earlier rows are dead. Of a key's rows the one of the latest run
counts, of those of one run the newest. A change writes its run first and then, under another name, the next manifest; the
rename of that one file commits it. Whatever fails before, readers find the state before. There is one writer at a time:
a second one finds its manifest's number taken and raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .storage import _system, remove

DEAD, RUN = "_dead", "_run"


class ConcurrentWrite(RuntimeError):
    """Another writer has committed since this one has read the table's state."""


class LogTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, at: str):
        """schema: the columns as DDL; key: the column that rows replace each other by; at: their time."""
        self.spark, self.path, self.key, self.at = spark, path.rstrip("/"), key, at
        self.schema = spark.createDataFrame([], schema).schema
        self.others = [n for n in self.schema.names if n != key]
        self.stored = spark.createDataFrame([], f"{schema}, {DEAD} boolean").schema
        #: Called with the name of each write that is about to be made.
        self.before: Callable[[str], None] = lambda _: None

    # The manifest.

    def state(self) -> tuple[int, dict]:
        """(number of the last manifest, its content); (-1, an empty state) where there is none."""
        at, system = _system(self.spark, f"{self.path}/manifest")
        names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
        numbers = [int(n) for n in names if n.isdigit()]
        if not numbers:
            return -1, {"entries": [], "applied": {}}
        return max(numbers), json.loads(self._text(f"{self.path}/manifest/{max(numbers):020d}"))

    def _text(self, path: str) -> str:
        at, system = _system(self.spark, path)
        stream = system.open(at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _commit(self, number: int, state: dict) -> None:
        """Puts the manifest of this number in its place, if nobody else has."""
        temporary, system = _system(self.spark, f"{self.path}/manifest/.{uuid.uuid4().hex}")
        final, _ = _system(self.spark, f"{self.path}/manifest/{number:020d}")
        self.before("manifest")
        stream = system.create(temporary, True)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        self.before("rename")
        if system.exists(final) or not system.rename(temporary, final):
            system.delete(temporary, False)
            raise ConcurrentWrite(f"manifest {number} of {self.path} is there already")

    # Reading.

    def exists(self) -> bool:
        return bool(self.state()[1]["entries"])

    def read(self) -> DataFrame | None:
        """The live rows, one a key; None for a table that was never written or has been cleared."""
        entries = self.state()[1]["entries"]
        return self._winners(entries, 0).filter(~F.col(DEAD)).drop(DEAD) if entries else None

    def _run(self, id_: str) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(f"{self.path}/runs/{id_}")

    def _winners(self, entries: list[dict], first: int) -> DataFrame:
        """One row a key with its mark, of the entries from `first` on; rows that a later time kills are marked, so that they still hide older ones."""
        frames = []
        for k in range(first, len(entries)):
            if "run" in entries[k]:
                rows = self._run(entries[k]["run"])
                if times := [e["before"] for e in entries[k + 1 :] if "before" in e]:
                    rows = rows.withColumn(DEAD, F.col(DEAD) | F.coalesce(F.col(self.at) <= F.timestamp_micros(F.lit(max(times))), F.lit(False)))
                frames.append((entries[k], rows.withColumn(RUN, F.lit(k))))
        names = [*self.others, DEAD]
        if not frames:
            return self.spark.createDataFrame([], self.stored).select(self.key, *names)
        if len(frames) == 1 and frames[0][0].get("single"):  # each key once already
            return frames[0][1].select(self.key, *names)
        every = reduce(DataFrame.unionByName, (f for _, f in frames))
        last = F.max_by(F.struct(*names), F.struct(RUN, F.col(self.at)))
        return every.groupBy(self.key).agg(last.alias("_w")).select(self.key, *[F.col("_w")[n].alias(n) for n in names])

    # Changes.

    def _write(self, rows: DataFrame) -> dict:
        """Writes a run that nothing refers to yet."""
        id_ = uuid.uuid4().hex
        self.before("run")
        rows.select(*self.stored.names).write.parquet(f"{self.path}/runs/{id_}")
        return {"run": id_, "rows": self.spark.read.parquet(f"{self.path}/runs/{id_}").count()}

    def append(self, rows: DataFrame, source: str | None = None, batch: int = 0) -> bool:
        """Adds rows, which replace those of the same keys. A (source, batch) that was added before is passed over: False.

        Batches of a source come in ascending order, so that the last one is all that the manifest has to keep of it.
        """
        number, state = self.state()
        if source is not None and state["applied"].get(source, -1) >= batch:
            return False
        run = self._write(rows.withColumn(DEAD, F.lit(False)))
        applied = {**state["applied"], source: batch} if source is not None else state["applied"]
        self._commit(number + 1, {"entries": [*state["entries"], run], "applied": applied})
        self.compact()
        return True

    def drop_keys(self, keys: DataFrame) -> None:
        """Tombstones for the keys, whether they are there or not."""
        number, state = self.state()
        if not state["entries"]:
            return
        other = [F.lit(None).cast(self.schema[n].dataType).alias(n) for n in self.others]
        run = self._write(keys.select(self.key).distinct().select(self.key, *other).withColumn(DEAD, F.lit(True)))
        self._commit(number + 1, {**state, "entries": [*state["entries"], run]})
        self.compact()

    def drop_before(self, micros: int) -> int:
        """Kills all rows of this time or an earlier one by one entry of the manifest; returns how many were alive."""
        number, state = self.state()
        live = self.read()
        old = live.filter(F.col(self.at) <= F.timestamp_micros(F.lit(micros))).count() if live is not None else 0
        if old:
            self._commit(number + 1, {**state, "entries": [*state["entries"], {"before": micros}]})
        return old

    def clear(self) -> None:
        number, state = self.state()
        if state["entries"]:
            self._commit(number + 1, {"entries": [], "applied": state["applied"]})

    # Compaction.

    @staticmethod
    def suffix(entries: list[dict]) -> int:
        """Where the entries that are merged begin: the last run, and each run before it that has no more rows than those after it.

        Runs that stay at least double in size from the newest to the oldest, so that a row is written again a logarithmic
        number of times, and a table has a logarithmic number of runs.
        """
        first, rows = len(entries), 0
        for k in range(len(entries) - 1, -1, -1):
            if "run" in entries[k]:
                if first < len(entries) and entries[k]["rows"] > rows:
                    break
                rows += entries[k]["rows"]
                first = k
        return first

    def compact(self, all_: bool = False) -> bool:
        """Merges the newest runs (all_: all) into one. The runs that were merged stay until vacuum()."""
        number, state = self.state()
        entries = state["entries"]
        first = 0 if all_ else self.suffix(entries)
        if sum("run" in e for e in entries[first:]) < 2 and not (all_ and len(entries) > 1):
            return False
        oldest = not any("run" in e for e in entries[:first])
        rows = self._winners(entries, first)
        run = self._write(rows.filter(~F.col(DEAD)) if oldest else rows) | {"single": True}
        times = [e["before"] for e in entries[first:] if "before" in e]
        # Marks and times of death are kept as long as an older run may hold a row that they kill.
        kept = [] if oldest else [*entries[:first], *([{"before": max(times)}] if times else [])]
        self._commit(number + 1, {**state, "entries": [*kept, run]})
        return True

    def vacuum(self, keep: int = 1) -> int:
        """Deletes runs that none of the last `keep` states refers to (readers of older ones must have ended); returns how many."""
        number, _ = self.state()
        if number < 0:
            return 0
        used: set[str] = set()
        folder, system = _system(self.spark, f"{self.path}/manifest")
        for status in system.listStatus(folder):
            name = status.getPath().getName()
            if name.isdigit() and int(name) > number - keep:
                used |= {e["run"] for e in json.loads(self._text(f"{self.path}/manifest/{name}"))["entries"] if "run" in e}
        old = [s.getPath() for s in system.listStatus(folder) if not s.getPath().getName().isdigit() or int(s.getPath().getName()) <= number - keep]
        for path in old:
            self.before("vacuum")
            system.delete(path, False)
        runs, _ = _system(self.spark, f"{self.path}/runs")
        gone = [s.getPath().getName() for s in system.listStatus(runs) if s.getPath().getName() not in used] if system.exists(runs) else []
        for id_ in gone:
            self.before("vacuum")
            remove(self.spark, f"{self.path}/runs/{id_}")
        return len(gone)

    def size_mb(self) -> float:
        """Megabytes of the runs that the table's state refers to."""
        total = 0
        for e in self.state()[1]["entries"]:
            if "run" in e:
                at, system = _system(self.spark, f"{self.path}/runs/{e['run']}")
                total += system.getContentSummary(at).getLength()
        return total / 1e6
