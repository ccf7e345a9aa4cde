"""Intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where none is named, only a session
    whose driver and executors are one process may use a folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = "file://" + tempfile.mkdtemp(prefix="shared-")
    return _local[app]


def _hadoop_path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that was never used; removed when the session ends."""
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    where, files = _hadoop_path(spark, path)
    files.deleteOnExit(where)
    return path


# While a table is written: shuffle files of a finished write serve nobody any more, and rows that
# hold whole texts or arrays go to Python in batches of bounded size.
_WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame, written and read back: it is worked out once, and no lost machine matters."""
    spark = df.sparkSession
    path = new_path(spark, label)
    before = {name: spark.conf.get(name) for name in _WHILE_WRITING}
    try:
        for name, value in _WHILE_WRITING.items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    back = spark.read.schema(df.schema).parquet(path)
    back._llm_path = path
    return back


def drop(df: DataFrame | None) -> None:
    """Remove a written table that nothing reads any more."""
    if df is not None:
        spark = df.sparkSession
        where, files = _hadoop_path(spark, df._llm_path)
        files.delete(where, True)
