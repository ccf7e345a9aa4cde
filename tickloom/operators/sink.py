"""Idempotent writing of enriched trades to the stored table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import utc_day
from tickloom.params import Params
from tickloom.schemas import TABLE_COLUMNS, TABLE_KEY
from tickloom.session import fresh_path, kept
from tickloom.sources.table import read_trades, with_day, write_trades


@dataclass(frozen=True)
class SinkCounts:
    attempted: int
    inserted: int

    @property
    def skipped(self) -> int:
        return self.attempted - self.inserted


def keep_first(
    rows: DataFrame, key: Sequence[str] = TABLE_KEY, order: Column | None = None
) -> DataFrame:
    """The first row of every key by ``order`` (default: by all columns).

    An aggregate combines copies before the shuffle, however many there are.
    """
    columns = rows.columns
    rest = [c for c in columns if c not in key]
    order = F.struct(*rest) if order is None else order
    row = F.min_by(F.struct(*rest), order).alias("row")
    return rows.groupBy(*key).agg(row).select(*key, "row.*").select(*columns)


def stored_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_trades(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def new_rows(
    rows: DataFrame, stored: DataFrame | None, key: Sequence[str] = TABLE_KEY,
    order: Column | None = None,
) -> DataFrame:
    """First row of each key that the stored table does not have yet."""
    first = keep_first(rows, key, order)
    if stored is None:
        return first
    if "day" in stored.columns and "time" in key:
        return (
            with_day(first)
            .join(stored.select("day", *key), ["day", *key], "left_anti")
            .select(*rows.columns)
        )
    return first.join(stored.select(*key), list(key), "left_anti")


def new_rows_of_table(spark: SparkSession, trades: DataFrame, path: str) -> DataFrame:
    """The raw trades that the table does not have; only the days that they touch are looked up."""
    stored = stored_or_none(spark, path)
    if stored is None:
        return trades
    span = trades.agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    keys = stored.where(F.col("time").between(F.lit(span["a"]), F.lit(span["b"]))).where(
        F.col("day").between(utc_day(F.lit(span["a"])), utc_day(F.lit(span["b"])))
    )
    keys = keys.select("trade_id", F.col("time").alias("event_time"))
    return trades.join(keys, ["trade_id", "event_time"], "left_anti").select(*trades.columns)


def compact_days(
    spark: SparkSession, path: str, params: Params = Params(), smallest: int = 8
) -> int:
    """Rewrite the days of the table that have gathered many small files; how many were.

    A day with at least ``smallest`` files is read, written to a folder beside the table, and put
    in its place by one overwrite of that day's folder. Files hold ``batch_flush_size`` rows or
    more. Nothing may append to the table meanwhile.
    """
    table = stored_or_none(spark, path)
    if table is None:
        return 0
    files = table.select("day", F.col("_metadata.file_path").alias("file")).groupBy("day")
    # One row per day with many files.
    days = files.agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n")).where(
        (F.col("files") >= smallest) & (F.col("n") < F.col("files") * params.batch_flush_size)
    )
    found = [r["day"] for r in days.collect()]
    if not found:
        return 0
    draft = fresh_path(spark, "compacted")
    write_trades(table.where(F.col("day").isin(found)).drop("day"), draft)
    (
        read_trades(spark, draft)
        .hint("rebalance", "day")
        .sortWithinPartitions("day", "symbol", "time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )
    return len(found)


def append_new(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    key: Sequence[str] = TABLE_KEY,
    order: Column | None = None,
) -> SinkCounts:
    """Append the rows whose key is new; the first row of a key stays.

    A repeated call with the same rows writes nothing, so a batch that is tried
    again after a failure does no harm. Only the days of the batch are looked up; all
    other folders are skipped. ``order`` says which of several copies came first, and may
    use columns that are not stored, such as an offset; it is needed wherever copies of a
    key may differ.
    """
    rows, fresh = kept(rows), None
    try:
        # One row per day that the batch touches.
        days = (
            rows.groupBy(utc_day(F.col("time")).alias("day"))
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.unix_micros(F.min("time")).alias("first"),
                F.unix_micros(F.max("time")).alias("last"),
            )
            .collect()
        )
        if not days:
            return SinkCounts(0, 0)
        attempted = sum(d["n"] for d in days)
        stored = stored_or_none(spark, path)
        if stored is not None and "time" in key:
            # Days as literals skip all other folders, the outer times skip row groups.
            moment = lambda us: F.timestamp_micros(F.lit(us))
            known = [d for d in days if d["day"] is not None]
            stored = stored.where(F.col("day").isin([d["day"] for d in known])).where(
                F.col("time").between(
                    moment(min((d["first"] for d in known), default=0)),
                    moment(max((d["last"] for d in known), default=0)),
                )
            )
        fresh = kept(new_rows(rows, stored, key, order).select(*TABLE_COLUMNS))
        inserted = fresh.count()
        if inserted:
            write_trades(fresh, path, mode="append")
        return SinkCounts(attempted, inserted)
    finally:
        rows.unpersist()
        if fresh is not None:
            fresh.unpersist()
