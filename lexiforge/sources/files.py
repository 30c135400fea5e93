"""Sources: text, DOCX and other files, JSON, JSONL, key files, registries. Everything is read by Spark's own readers."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import c, strip, word_count

EXTENSIONS = (".txt", ".doc", ".docx", ".pdf")
QA = T.StructType([T.StructField(n, t) for n, t in (("question", T.StringType()), ("answer", T.StringType()), ("source_doc", T.StringType()), ("chunk_id", T.IntegerType()), ("perspective", T.StringType()), ("eval_score", T.DoubleType()), ("eval_reason", T.StringType()), ("eval_method", T.StringType()), ("from_cache", T.BooleanType()))])
LAW = "struct<id:string,name:string,type:string,issuer:string,issued_date:string,effective_date:string,expiry_date:string,status:string,replaces:array<string>,replaced_by:string,topics:array<string>>"


def list_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = EXTENSIONS, ignore: tuple[str, ...] = ()) -> DataFrame:
    """path, name, size, modified of files with the extensions, without those that match an ignore rule: a* begins so, an inner *
    is any run, others occur anywhere."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    keep = F.lit(False)
    for e in extensions:
        keep = keep | F.lower("name").endswith(e)
    for rule in ignore:
        keep = keep & ~ignored("name", rule)
    return files.filter(keep)


def ignored(name: Column | str, rule: str) -> Column:
    n = c(name)
    if rule.endswith("*") and "*" not in rule[:-1]:
        return n.startswith(rule[:-1])
    if "*" in rule:
        return n.rlike("^" + ".*".join(re.escape(p) for p in rule.split("*")))
    return n.contains(rule)


def decode(raw: bytes) -> str:
    """UTF-8 (a byte-order mark stays), else Latin-1, which any bytes are."""
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def docx_text(raw: bytes) -> str:
    """Paragraphs that aren't blank, one a line."""
    import xml.etree.ElementTree as ET

    name = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    body = ET.fromstring(zipfile.ZipFile(io.BytesIO(raw)).read("word/document.xml"))
    lines = ("".join(t.text or "" for t in p.iter(f"{name}t")) for p in body.iter(f"{name}p"))
    return "\n".join(x for x in lines if x.strip())


def doc_text(raw: bytes) -> str:
    """By antiword, where it is installed."""
    import subprocess

    return subprocess.run(["antiword", "-"], input=raw, capture_output=True, timeout=120, check=True).stdout.decode("utf-8", "replace")


def pdf_text(raw: bytes) -> str:
    """Pages by PyPDF2, else by pdfplumber, where one is installed."""
    try:
        from PyPDF2 import PdfReader

        return "\n".join(p.extract_text() or "" for p in PdfReader(io.BytesIO(raw)).pages)
    except ImportError:
        import pdfplumber

        with pdfplumber.open(io.BytesIO(raw)) as pdf:
            return "\n".join(p.extract_text() or "" for p in pdf.pages)


READERS: dict[str, Callable[[bytes], str]] = {".txt": decode, ".docx": docx_text, ".doc": doc_text, ".pdf": pdf_text}


def read_documents(spark: SparkSession, folder: str | list[str], extensions: tuple[str, ...] = EXTENSIONS, ignore: tuple[str, ...] = (), readers: dict[str, Callable[[bytes], str]] = READERS) -> DataFrame:
    """file_name, file_path, content (stripped), char_count (before that), word_count, metadata, error.

    folder: one, or a list of files. Blank documents are left out; files that can't be read have a null content and an error.
    """
    from ..operators.metadata import extract_metadata

    @F.pandas_udf("struct<text:string,error:string>")
    def text_of(names: pd.Series, raw: pd.Series) -> pd.DataFrame:
        out = []
        for name, data in zip(names, raw, strict=True):
            reader = next((r for e, r in sorted(readers.items(), key=lambda x: -len(x[0])) if name.lower().endswith(e)), None)
            try:
                out.append((reader(data), None) if reader else (None, "unknown kind of file"))
            except Exception as e:  # noqa: BLE001  a damaged file must not end the job
                out.append((None, f"{type(e).__name__}: {e}"[:200]))
        return pd.DataFrame(out, columns=["text", "error"])

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"), "content")
    keep = F.lit(False)
    for e in extensions:
        keep = keep | F.lower("file_name").endswith(e)
    for rule in ignore:
        keep = keep & ~ignored("file_name", rule)
    # As if it were not deterministic, so that the optimiser does not copy it below the filter and open each file twice.
    got = raw.filter(keep).withColumn("_t", text_of.asNondeterministic()("file_name", "content"))
    got = got.select("file_name", F.col("path").alias("file_path"), strip("_t.text").alias("content"), F.length("_t.text").alias("char_count"), word_count("_t.text").alias("word_count"), F.col("_t.error").alias("error"))
    return extract_metadata(got.filter(F.col("error").isNotNull() | (F.length("content") > 0)))


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A file that is one JSON array, or objects."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One object a line; blank lines are skipped."""
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Files that are one JSON array each, which read_json reads; every task writes its own."""
    import pyarrow as pa

    def run(batches):
        first = True
        for b in batches:
            lines = b.column(0).to_pylist()
            if lines:
                yield pa.RecordBatch.from_pydict({"value": [("[" if first and not k else ",") + x for k, x in enumerate(lines)]})
                first = False
        yield pa.RecordBatch.from_pydict({"value": ["[]" if first else "]"]})

    rows = df.select(F.to_json(F.struct(*[F.col(f"`{n}`") for n in df.columns]), {"ignoreNullFields": "false"}).alias("value"))
    rows.mapInArrow(run, "value string").write.mode(mode).text(path)


def read_split(spark: SparkSession, folder: str, split: str, schema: T.StructType | str = None) -> DataFrame:
    """One split of a folder that write_splits left; a split that is missing is empty."""
    path = f"{folder}/splits/split={split}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return read_jsonl(spark, path, schema or QA)
    return spark.createDataFrame([], schema or QA)


def read_labelled(spark: SparkSession, good: str, bad: str) -> DataFrame:
    """Good and bad pairs with their label."""
    return read_json(spark, good, QA).withColumn("label", F.lit("good")).unionByName(read_json(spark, bad, QA).withColumn("label", F.lit("bad")))


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments."""
    key = strip("value").alias("key")
    return spark.read.text(path).select(key).filter((F.length("key") > 0) & ~F.col("key").startswith("#"))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """ord and the laws of a registry file {"documents": [...]}, dates as dates."""
    docs = spark.read.option("multiLine", "true").schema(f"documents array<{LAW}>").json(path)
    rows = docs.select(F.posexplode("documents").alias("ord", "d")).select("ord", "d.*")
    return rows.withColumns({n: F.to_date(n) for n in ("issued_date", "effective_date", "expiry_date")})


def document_name(name: Column | str, mappings: list[tuple[str, str]]) -> Column:
    """The full name of the first pattern that the file name contains, else the file name."""
    n = c(name)
    return F.coalesce(*[F.when(n.contains(p), F.lit(full)) for p, full in mappings], n)
