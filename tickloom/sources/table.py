"""The stored table of enriched trades: Parquet, one folder per day (UTC)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import ago, utc_day
from tickloom.schemas import TABLE_COLUMNS, TRADES_TABLE


def with_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", utc_day(F.col("time")))


def write_trades(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write table rows by day; a day with many rows is spread over several files.

    Rows are sorted by symbol and time inside each file, so that the statistics of
    the row groups let a reader skip other symbols.
    """
    (
        with_day(rows)
        .hint("rebalance", "day")
        .sortWithinPartitions("day", "symbol", "time")
        .write.mode(mode)
        .partitionBy("day")
        .parquet(path)
    )


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    schema = TRADES_TABLE.simpleString()[len("struct<") : -1]
    return (
        spark.read.schema(f"{schema.replace(':', ' ').replace(',', ', ')}, day date")
        .parquet(path)
    )


def scan_after(table: DataFrame, as_of, seconds: float) -> DataFrame:
    """Rows strictly later than ``seconds`` before ``as_of`` (default: now).

    The condition on ``time`` reaches the row groups; the one on ``day``, which the
    optimizer cannot derive from it, skips whole folders.
    """
    start = ago(as_of, seconds)
    rows = table.where(F.col("time") > start)
    if "day" in table.columns:
        rows = rows.where(F.col("day") >= utc_day(start))
    return rows


def scan_recent(table: DataFrame, as_of=None, seconds: float = 300) -> DataFrame:
    return scan_after(table, as_of, seconds).select(*TABLE_COLUMNS)
