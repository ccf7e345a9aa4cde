"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC: naive times in the inputs of the queries mean UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all machines share.

    Where none is named, only a session whose driver and executors are one process gets a
    folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="tickloom-")
    return _local[app]


def settled(df: DataFrame, label: str) -> DataFrame:
    """A small intermediate result, written to the shared folder and read back.

    For results that several parts of a plan use; they are then computed only once.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_COALESCED = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"


def kept(df: DataFrame) -> DataFrame:
    """``persist`` in as many partitions as the rows call for.

    Otherwise a kept result has one for each shuffle partition, and every shuffle that reads it
    writes the square of their number in blocks, however few rows there are.
    """
    conf = df.sparkSession.conf
    before = conf.get(_COALESCED)
    try:
        conf.set(_COALESCED, "true")
        return df.persist()
    finally:
        conf.set(_COALESCED, before)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never used before; gone when the session ends."""
    app = spark.sparkContext.applicationId
    path = os.path.join(shared_dir(spark), "tickloom", app, f"{label}-{uuid.uuid4().hex[:12]}")
    # Removed when the session ends.
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
