"""Stage tables in the folder that driver and executors share. All of an application's stand in one folder of its own."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and all runs on this machine (as in tests), a folder of our own."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not context.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="lexiforge-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(at)
    return at


def run_dir(spark: SparkSession) -> str:
    """The application's folder in the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/lexiforge-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df without its lineage, kept in the shared folder (for the small frames of iterations)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_at(df: DataFrame, label: str = "table", **options: str) -> tuple[DataFrame, str]:
    """df, cut from its lineage by a Parquet table, and the table's path, which the caller may remove after its last use."""
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """df, cut from its lineage by a Parquet table in the shared folder, so that a lost executor costs no recomputation."""
    return written_at(df, label)[0]


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table or folder that nothing reads any more."""
    at, system = _system(spark, path)
    system.delete(at, True)


def clean(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; frames that still read them must have been written out before."""
    remove(spark, run_dir(spark))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a stage's output is committed."""
    at, system = _system(spark, f"{path}/_SUCCESS")
    return system.exists(at)


def opened(path: str):
    """(file system, path in it) for code of tasks, which has no JVM; path: a folder that the driver and all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
