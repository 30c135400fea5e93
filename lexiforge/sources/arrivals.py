"""Documents of a folder as they arrive: only files that are new or changed are read, and those that have gone are dropped.

The state is the table itself, a log by file path: each row keeps the file's length and time of change beside its text, so what
has been read and what it gave are committed by one rename. A run that stops half-way has read the batches that it
committed; the next one goes on with the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .logtable import LogTable
from .storage import written

META = "struct<doc_number: string, doc_number_short: string, doc_type: string, issued_date: string, issued_by: string, title: string>"
ROW = f"file_path string, modified timestamp, size long, file_name string, content string, char_count int, word_count int, metadata {META}, error string"
#: Files of a batch, whose paths the driver holds.
BATCH = 10_000


class Documents(LogTable):
    def __init__(self, spark: SparkSession, path: str, folder: str, batch: int = BATCH, **reading):
        """folder: where the documents are; reading: extensions, ignore and readers as of files.read_documents."""
        super().__init__(spark, path, ROW, "file_path", "modified")
        self.folder, self.batch, self.reading = folder, batch, reading

    def changes(self) -> tuple[DataFrame, DataFrame]:
        """(new and changed files: path, modified, size; the paths of files that are gone). No file is opened."""
        names = {k: v for k, v in self.reading.items() if k != "readers"}
        there = files.list_files(self.spark, self.folder, **names).select(F.col("path").alias("file_path"), "modified", "size")
        known = self.read()
        if known is None:
            return there, there.select("file_path").limit(0)
        same = known.select("file_path", "modified", "size")
        return there.join(same, ["file_path", "modified", "size"], "left_anti"), known.select("file_path").join(there, "file_path", "left_anti")

    def update(self) -> int:
        """Reads what has changed, batch by batch; returns how many files that were."""
        new, gone = (written(x, "arrivals") for x in self.changes())
        if not gone.isEmpty():
            self.drop_keys(gone)
        total = 0
        paths: Iterator = (r.file_path for r in new.select("file_path").toLocalIterator())
        while some := list(islice(paths, self.batch)):
            own = self.spark.createDataFrame([(p,) for p in some], "file_path string")
            texts = files.read_documents(self.spark, [p for p in some], **self.reading)
            # A blank document has a row without a text, so that it is not read again.
            rows = new.join(F.broadcast(own), "file_path").join(texts, "file_path", "left").withColumn("file_name", F.regexp_extract("file_path", r"([^/]*)$", 1))
            self.append(rows)
            total += len(some)
        return total

    def documents(self) -> DataFrame:
        """As files.read_documents, of all files that are there; without blank documents."""
        live = self.read()
        if live is None:
            live = self.spark.createDataFrame([], ROW)
        return live.filter("content is not null or error is not null").select("file_name", "file_path", "content", "char_count", "word_count", "metadata", "error")
