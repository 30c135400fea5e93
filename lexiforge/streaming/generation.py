"""Generation that goes on where it stopped: chunks as a stream, one committed table of answers for each batch.

A folder holds the chunks, the stream's checkpoint, the answers of each batch and the journal of the batch in work. A batch
that is replayed after a stop has the same chunks (the checkpoint's log says which) and finds its table written, or the
journal of what its tasks were told; only chunks that nobody has answered are asked for. The cache gets each batch once.
"""

from __future__ import annotations

import uuid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import generate
from ..operators.parse import parse_pairs
from ..sources.storage import exists, remove, written_at

ANSWER = (*generate.CHUNK, "cache_key", "result", "error", "from_cache")


class Generation:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        provider,
        template: str,
        model: str,
        cache: generate.CacheTable | None = None,
        ttl_days: int = 30,
        num_qa: int = 5,
        every: int = 1,
        files: int = 8,
        **call,
    ):
        """every: answers of a journal's file; files: of the chunk table that make up a batch; call: as asked()."""
        self.spark, self.path, self.provider, self.call = spark, path.rstrip("/"), provider, call
        self.template, self.model, self.cache, self.ttl_days, self.num_qa = template, model, cache, ttl_days, num_qa
        self.every, self.files = every, files

    def begun(self) -> bool:
        return exists(self.spark, f"{self.path}/chunks")

    def run(self, chunks: DataFrame, name: str = "generation") -> DataFrame:
        """The answered chunks (ANSWER). chunks are written once; a generation that has begun goes on with those it has."""
        if not self.begun():
            chunks.select(*generate.CHUNK).write.mode("overwrite").parquet(f"{self.path}/chunks")
        schema = self.spark.read.parquet(f"{self.path}/chunks").schema
        stream = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files).parquet(f"{self.path}/chunks")
        query = stream.writeStream.queryName(name).foreachBatch(self.batch).option("checkpointLocation", f"{self.path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        return self.answers()

    def answers(self) -> DataFrame:
        empty = self.spark.createDataFrame([], "doc_name string, chunk_id int, content string, doc_number string, issued_date string, issued_by string, cache_key string, result array<struct<question: string, answer: string>>, error string, from_cache boolean")
        return self.spark.read.schema(empty.schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/answers") if self._any() else empty

    def _any(self) -> bool:
        return exists(self.spark, f"{self.path}/answers/0")

    def batch(self, chunks: DataFrame, no: int) -> None:
        at, journal = f"{self.path}/answers/{no}", f"{self.path}/journal/{no}"
        if not exists(self.spark, at):
            self._answer(chunks, at, journal)
        done = self.spark.read.parquet(at)
        if self.cache is not None:
            self.cache.append(generate.outcome(done, self.model)[2], self.path, no)
        remove(self.spark, journal)

    def _answer(self, chunks: DataFrame, at: str, journal: str) -> None:
        cache = self.cache.read() if self.cache is not None else None
        keyed = generate.keyed_prompts(chunks, self.template, self.model, cache, self.ttl_days, num_qa=self.num_qa)
        # A chunk's own key: equal contents of two chunks are two calls, as in a run without stops.
        keyed = keyed.withColumn("key", F.md5(F.to_json(F.struct("doc_name", "chunk_id", "cache_key"))))
        hits = keyed.filter("_hit is not null").withColumns({"result": F.col("_hit"), "error": F.lit(None).cast("string"), "from_cache": F.lit(True)})
        known = generate.journaled(self.spark, journal)
        open_ = keyed.filter("_hit is null").drop("_hit")
        earlier = open_.join(known, "key").withColumns({"result": parse_pairs("response"), "error": F.lit(None).cast("string"), "from_cache": F.lit(False)})
        misses = open_.join(known.select("key"), "key", "left_anti")
        own = generate.Journal(f"{journal}/{uuid.uuid4().hex}", self.every)
        told, told_at = written_at(generate.asked(misses, self.provider, journal=own, key="key", **self.call), "responses")
        now = told.withColumns({"result": parse_pairs("response"), "from_cache": F.lit(False)})
        every = hits.select(*ANSWER).unionByName(earlier.select(*ANSWER)).unionByName(now.select(*ANSWER))
        every.write.mode("overwrite").parquet(at)
        remove(self.spark, told_at)
