"""Calls to language models as an operator: cache, prompt, call with retries, parse. Providers are injected."""

from __future__ import annotations

import itertools
import random
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as X
from ..functions.text import cache_key
from ..sources.logtable import LogTable
from ..sources.storage import _system, opened
from .parse import PAIRS, parse_pairs, parse_verdict


class Provider(Protocol):
    name: str

    def call(self, prompt: str) -> str | None: ...


def error_kind(message: str) -> tuple[str, bool]:
    """(kind, whether to try again) by what a message says; the first row that fits counts."""
    m = message.lower()
    for words, kind, again in X.CALL_ERRORS:
        if any(w in m for w in words):
            return kind, again
    return "unknown", True


@dataclass
class Retries:
    attempts: int = 5
    delay: float = 1.0
    sleep: Callable[[float], None] = time.sleep

    def wait(self, kind: str, attempt: int) -> float:
        """Exponential after rate limits, else linear, with some chance in it."""
        return self.delay * 2**attempt + random.uniform(1, 3) if kind == "rate_limit" else self.delay * (attempt + 1) + random.uniform(0, 1)

    def once(self, provider: Provider, prompt: str, attempt: int) -> tuple[str | None, str | None, float | None]:
        """(text, error, seconds to wait before the next attempt; None: there is none) of attempt 0, 1, ... Empty answers are asked for again at once."""
        last = attempt + 1 >= self.attempts
        try:
            if text := provider.call(prompt):
                return text, None, None
        except Exception as e:  # noqa: BLE001  a provider may raise anything
            kind, again = error_kind(str(e))
            return None, str(e)[:200], None if last or not again else self.wait(kind, attempt)
        return None, None, None if last else 0.0

    def run(self, provider: Provider, prompt: str, before: Callable[[], None] = lambda: None) -> tuple[str | None, str | None, int]:
        """(text, last error, calls). before: is called before each call."""
        error = None
        for attempt in range(self.attempts):
            before()
            text, now, wait = self.once(provider, prompt, attempt)
            error = None if text else now or error
            if wait is None:
                return text, error, attempt + 1
            if wait:
                self.sleep(wait)
        return None, error, self.attempts


@dataclass(frozen=True)
class Journal:
    """Answers as they come, in small files of a shared folder: what was answered before a stop need not be asked again.

    A file holds `every` answers of a task and appears by a rename; a task that is run again reads the files of its partition.
    """

    path: str
    every: int = 1

    def known(self, partition: int) -> dict[str, tuple]:
        """key -> (response, error, calls) of a partition of this job."""
        import json

        from pyarrow import fs

        system, at = opened(f"{self.path}/part-{partition:05d}")
        found = {}
        for f in system.get_file_info(fs.FileSelector(at, allow_not_found=True)):
            if not f.base_name.startswith("_"):
                with system.open_input_stream(f.path) as stream:
                    for line in stream.readall().decode().splitlines():
                        r = json.loads(line)
                        found[r["key"]] = (r["response"], None, r["calls"])
        return found

    def pages(self, partition: int) -> Pages:
        return Pages(self, partition)


class Pages:
    """Where a task's threads put their answers."""

    def __init__(self, journal: Journal, partition: int):
        self.system, self.folder = opened(f"{journal.path}/part-{partition:05d}")
        self.every, self.lines, self.lock = journal.every, [], threading.Lock()
        self.system.create_dir(self.folder, recursive=True)

    def put(self, key: str, response: str | None, calls: int) -> None:
        import json

        if response is not None:
            with self.lock:
                self.lines.append(json.dumps({"key": key, "response": response, "calls": calls}, ensure_ascii=False))
                if len(self.lines) >= self.every:
                    self._flush()

    def _flush(self) -> None:
        import uuid

        if self.lines:
            name = uuid.uuid4().hex
            with self.system.open_output_stream(f"{self.folder}/_{name}") as out:
                out.write(("\n".join(self.lines) + "\n").encode())
            self.system.move(f"{self.folder}/_{name}", f"{self.folder}/{name}.json")
            self.lines = []

    def close(self) -> None:
        with self.lock:
            self._flush()


def journaled(spark, path: str) -> DataFrame:
    """key, response, calls of all journals below a folder, one row a key."""
    at, system = _system(spark, path)
    schema = "key string, response string, calls int"
    if not system.exists(at):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(path)
    return rows.groupBy("key").agg(F.max(F.struct("response", "calls")).alias("r")).select("key", "r.response", "r.calls")


#: Seconds of a round, about, in which tasks share out the calls of a run. Telling each other takes Spark up to a second.
ROUND = 2.0


def shares(wanted: list[int], budget: int, turn: int = 0) -> list[int]:
    """The budget dealt out as evenly as what each one wants allows; what cannot be dealt evenly goes round with the turns."""
    got, n = [0] * len(wanted), len(wanted)
    while budget and (open_ := [k for k in range(n) if got[k] < wanted[k]]):
        each = budget // len(open_)
        if not each:
            for k in sorted(open_, key=lambda k: (k - turn) % n)[:budget]:
                got[k] += 1
            break
        for k in open_:
            more = min(each, wanted[k] - got[k])
            got[k] += more
            budget -= more
    return got


class SharedRate:
    """Calls of all tasks of a barrier stage at one rate: in each round tasks tell what they could begin and share the round's budget."""

    def __init__(self, rpm: float, seconds: float = ROUND):
        self.budget = max(1, int(rpm * seconds / 60))
        self.seconds = self.budget * 60 / rpm  # of a round; calls begin seconds / budget apart over all tasks

    def run(self, rows: Iterator, call: Callable, threads: int, context) -> Iterator[tuple]:
        """(row, text, error, calls) of each row as they come. call(row, attempt) -> (text, error, wait) as Retries.once; every attempt counts.

        While a round's calls begin, the tasks already tell each other what they want of the next one.
        """
        import heapq
        import json
        from concurrent.futures import ThreadPoolExecutor

        ready, waiting, running, ends, turn, own = deque(), [], {}, False, 0, context.partitionId()
        took = 0.2  # seconds of a call, as they were of late; what is too many for the threads is wanted less in the next round

        def timed(row, attempt) -> tuple:
            began = time.monotonic()
            return *call(row, attempt), time.monotonic() - began

        def finished() -> Iterator[tuple]:
            nonlocal took
            for f in [f for f in running if f.done()]:
                row, attempt, last = running.pop(f)
                text, error, wait, seconds = f.result()
                took += 0.2 * (seconds - took)
                if wait is None:
                    yield row, text, None if text else error or last, attempt + 1
                else:
                    heapq.heappush(waiting, (time.monotonic() + wait, next(ticket), row, attempt + 1, error or last))

        def refill() -> None:
            nonlocal ends
            while waiting and waiting[0][0] <= time.monotonic():
                _, _, row, attempt, last = heapq.heappop(waiting)
                ready.append((row, attempt, last))
            while not ends and len(ready) < self.budget:
                row = next(rows, None)
                ends = row is None
                if not ends:
                    ready.append((row, 0, None))

        def tell(pool, granted: int):
            """Asks for as many calls as there are rows and the threads can make in a round."""
            can = int(threads * self.seconds / max(took, 1e-3)) - max(0, len(running) - threads)
            message = [max(0, min(len(ready), can)), bool(ready or waiting or running or granted)]
            return pool.submit(context.allGather, json.dumps(message))

        ticket = itertools.count()
        with ThreadPoolExecutor(threads) as pool, ThreadPoolExecutor(1) as teller:
            refill()
            told_by = tell(teller, 0)
            while True:
                told = [json.loads(x) for x in told_by.result()]
                if not any(more for _, more in told):
                    return
                began = time.monotonic()
                got = shares([w for w, _ in told], self.budget, turn)
                first, some = sum(got[:own]), [ready.popleft() for _ in range(got[own])]
                refill()
                told_by = tell(teller, len(some))
                for j, (row, attempt, last) in enumerate(some):
                    if (wait := began + self.seconds * (first + j) / self.budget - time.monotonic()) > 0:
                        time.sleep(wait)
                    running[pool.submit(timed, row, attempt)] = (row, attempt, last)
                yield from finished()
                # A round that nobody fills is cut short; the rate holds all the same.
                if (wait := began + self.seconds * sum(got) / self.budget - time.monotonic()) > 0:
                    time.sleep(wait)
                yield from finished()
                refill()
                turn += 1


class TemplateProvider:
    """Answers every prompt with pairs made from it: for tests and dry runs, at any rate."""

    name, paced = "template", False

    def call(self, prompt: str) -> str:
        import json

        head = " ".join(prompt.split())[:80]
        return "```json\n" + json.dumps([{"question": f"{head}?", "answer": f"Căn cứ Điều 1 Luật số 41/2024/QH15: {head}"}], ensure_ascii=False) + "\n```"


def asked(
    df: DataFrame,
    provider: Provider | list[Provider],
    prompt: str = "prompt",
    retries: Retries = Retries(),
    rpm: float | None = None,
    threads: int = 1,
    journal: Journal | None = None,
    key: str | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """df with response, error and calls.

    provider: one, or one for each key; calls take turns with them. rpm and threads are those of the whole run. With a rate
    the calls run in a barrier stage of `tasks` tasks (all cores, if None; df's own partitions, if 0), which share out what is
    left of it. Calls run in the tasks; with a journal answers are kept under `key` (a column of unique texts) as they come, and a
    task that is run again asks for the others only.
    """
    import pyarrow as pa

    schema = f"{', '.join(f'`{n}` {t}' for n, t in df.dtypes)}, response string, error string, calls int"
    at, key_at = df.columns.index(prompt), df.columns.index(key) if key else None
    every = list(provider) if isinstance(provider, (list, tuple)) else [provider]
    slots = df.sparkSession.sparkContext.defaultParallelism
    rate = SharedRate(rpm) if rpm and all(getattr(p, "paced", True) for p in every) else None
    own_threads = max(1, threads // slots)

    def results(rows: Iterator, context) -> Iterator[tuple]:
        """(row, text, error, calls) of rows (batch, number in it, prompt, key)."""
        from concurrent.futures import ThreadPoolExecutor

        turns, partition = itertools.count(context.partitionId()), context.partitionId()
        known = journal.known(partition) if journal else {}
        pages = journal.pages(partition) if journal else None
        done = []

        def open_(rows: Iterator) -> Iterator:
            for row in rows:
                if row[3] in known:
                    done.append((row, *known[row[3]]))
                else:
                    yield row

        def kept(row, text, calls) -> None:
            if pages:
                pages.put(row[3], text, calls)

        def once(row, attempt) -> tuple:
            out = retries.once(every[next(turns) % len(every)], row[2] or "", attempt)
            kept(row, out[0], attempt + 1)
            return out

        def whole(row) -> tuple:
            text, error, calls = retries.run(every[next(turns) % len(every)], row[2] or "")
            kept(row, text, calls)
            return row, text, error, calls

        try:
            if rate:
                yield from rate.run(open_(rows), once, own_threads, context)
            else:
                with ThreadPoolExecutor(own_threads) as pool:
                    rows = open_(rows)
                    while some := list(itertools.islice(rows, 32 * own_threads)):
                        yield from pool.map(whole, some)
            yield from done
        finally:
            if pages:
                pages.close()

    def run(batches: Iterator) -> Iterator:
        from pyspark import BarrierTaskContext, TaskContext

        held: dict[int, tuple] = {}  # batches of which some rows are not answered yet

        def rows() -> Iterator:
            for no, b in enumerate(batches):
                if b.num_rows:
                    held[no] = (b, [None] * b.num_rows)
                    keys = b.column(key_at).to_pylist() if key else [None] * b.num_rows
                    for j, text in enumerate(b.column(at).to_pylist()):
                        yield no, j, text, keys[j]

        left: dict[int, int] = {}
        for (no, j, *_), text, error, calls in results(rows(), BarrierTaskContext.get() if rate else TaskContext.get()):
            b, got = held[no]
            got[j] = (text, error, calls)
            left[no] = left.get(no, b.num_rows) - 1
            if not left[no]:
                del held[no]
                columns = [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names, "response", "error", "calls"])

    if rate:
        df = df if tasks == 0 else df.repartition(tasks or slots)
    return df.mapInArrow(run, schema, barrier=rate is not None)


def call_stats(answers: DataFrame) -> DataFrame:
    """requests, calls, errors and success_rate of what was asked."""
    out = answers.agg(F.count("*").alias("requests"), F.coalesce(F.sum("calls"), F.lit(0)).alias("calls"), F.count_if(F.col("response").isNull()).alias("errors"))
    return out.withColumn("success_rate", (F.col("requests") - F.col("errors")) / F.greatest(F.lit(1), F.col("requests")) * 100)


def prompts(chunks: DataFrame, template: str, num_qa: int = 5) -> DataFrame:
    """chunks with prompt: {num_qa}, {doc_number} (with date and issuer where known) and {content} filled in."""
    number = F.coalesce(F.col("doc_number"), F.lit(X.UNKNOWN_NUMBER))
    number = F.concat(number, F.coalesce(F.concat(F.lit(" ngày "), F.col("issued_date")), F.lit("")), F.coalesce(F.concat(F.lit(" của "), F.col("issued_by")), F.lit("")))
    text = F.replace(F.replace(F.lit(template), F.lit("{num_qa}"), F.lit(str(num_qa))), F.lit("{doc_number}"), number)
    return chunks.withColumn("prompt", F.replace(text, F.lit("{content}"), F.coalesce(F.col("content"), F.lit(""))))


CHUNK = ("doc_name", "chunk_id", "content", "doc_number", "issued_date", "issued_by")


def outcome(answers: DataFrame, model: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, failed chunks, new cache rows) of answered chunks: CHUNK, cache_key, result, error, from_cache."""
    pairs = answers.filter("result is not null").select(F.col("doc_name").alias("source_doc"), "chunk_id", "from_cache", F.posexplode("result").alias("place", "p")).select("source_doc", "chunk_id", "from_cache", "place", "p.question", "p.answer")
    failed = answers.filter("result is null").select(*CHUNK, "error")
    new = answers.filter("result is not null and not from_cache").select("cache_key", F.current_timestamp().alias("created_at"), F.substring(F.md5("content"), 1, 8).alias("content_hash"), F.lit(model).alias("model"), "result")
    return pairs, failed, new


def keyed_prompts(chunks: DataFrame, template: str, model: str, cache: DataFrame | None, ttl_days: int = 30, now: str | None = None, num_qa: int = 5) -> DataFrame:
    """chunks with prompt, cache_key and _hit, the cache's answer (null: none that is fresh)."""
    keyed = prompts(chunks, template, num_qa).withColumn("cache_key", cache_key("content", F.lit(template), F.lit(model)))
    if cache is None:
        return keyed.withColumn("_hit", F.lit(None).cast(PAIRS))
    return keyed.join(fresh(cache, ttl_days, now).select("cache_key", F.col("result").alias("_hit")), "cache_key", "left")


def generated(chunks: DataFrame, provider: Provider, template: str, model: str, cache: DataFrame | None = None, ttl_days: int = 30, now: str | None = None, num_qa: int = 5, **call) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, failed chunks, new cache rows). Hits of the cache are not asked for; empty lists count as failed."""
    from ..sources.storage import written

    keyed = keyed_prompts(chunks, template, model, cache, ttl_days, now, num_qa)
    hits = keyed.filter("_hit is not null").select(*CHUNK, "cache_key", F.col("_hit").alias("result"), F.lit(None).cast("string").alias("error"), F.lit(True).alias("from_cache"))
    answers = written(asked(keyed.filter("_hit is null").drop("_hit"), provider, **call).withColumn("result", parse_pairs("response")), "responses")
    return outcome(hits.unionByName(answers.select(*CHUNK, "cache_key", "result", "error", F.lit(False).alias("from_cache"))), model)


def judged(df: DataFrame, provider: Provider, template: str, **call) -> DataFrame:
    """df with eval_score, eval_reason and eval_method: llm, or rule_fallback with the rule score where a call failed."""
    text = F.replace(F.replace(F.lit(template), F.lit("{question}"), F.coalesce(F.col("question"), F.lit(""))), F.lit("{answer}"), F.coalesce(F.col("answer"), F.lit("")))
    out = asked(df.withColumn("prompt", text), provider, **call).withColumn("_v", parse_verdict("response"))
    ok = F.col("response").isNotNull()
    return out.withColumns({"eval_score": F.when(ok, F.col("_v.score")).otherwise(F.col("eval_score")), "eval_reason": F.when(ok, F.col("_v.reason")).otherwise(F.col("eval_reason")), "eval_method": F.when(ok, "llm").otherwise("rule_fallback")}).drop("_v", "prompt", "response", "error", "calls")


CACHE = "cache_key string, created_at timestamp, content_hash string, model string, result array<struct<question: string, answer: string>>"


def fresh(cache: DataFrame, ttl_days: int = 30, now: str | None = None) -> DataFrame:
    """Rows within their time to live; of several with a key the newest."""
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    live = cache.filter(F.col("created_at") > at - F.make_interval(days=F.lit(ttl_days)))
    return live.groupBy("cache_key").agg(F.max_by(F.struct(*[c for c in cache.columns if c != "cache_key"]), "created_at").alias("r")).select("cache_key", "r.*")


def expired(cache: DataFrame, ttl_days: int = 30, now: str | None = None) -> DataFrame:
    at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    return cache.filter(F.col("created_at") <= at - F.make_interval(days=F.lit(ttl_days)))


def invalidated(cache: DataFrame, keys: DataFrame) -> DataFrame:
    return cache.join(keys.select("cache_key").distinct(), "cache_key", "left_anti")


class CacheTable(LogTable):
    """The cache as a log of immutable runs, so that a change that fails half-way changes nothing."""

    def __init__(self, spark, path: str):
        super().__init__(spark, path, CACHE, "cache_key", "created_at")

    def drop_expired(self, ttl_days: int = 30, now: str | None = None) -> int:
        """Kills rows whose time is over; returns how many were alive."""
        at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
        limit = self.spark.range(1).select(F.unix_micros(at - F.make_interval(days=F.lit(ttl_days)))).first()[0]
        return self.drop_before(limit)

    def clear(self) -> None:
        super().clear()
        self.vacuum()


def cache_stats(cache: DataFrame, chunks: DataFrame, template: str, model: str, ttl_days: int = 30, now: str | None = None) -> DataFrame:
    """entries, hits, misses, hit_rate of a cache against chunks."""
    keyed = chunks.select(cache_key("content", F.lit(template), F.lit(model)).alias("cache_key"))
    live = fresh(cache, ttl_days, now).select("cache_key", F.lit(1).alias("_h"))
    out = keyed.join(live, "cache_key", "left").agg(F.count("_h").alias("hits"), F.count_if(F.col("_h").isNull()).alias("misses"))
    out = out.withColumn("hit_rate", F.col("hits") / F.greatest(F.lit(1), F.col("hits") + F.col("misses")) * 100)
    return out.crossJoin(F.broadcast(cache.agg(F.count("*").alias("entries"))))
