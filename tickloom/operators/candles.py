"""Fixed-width price candles from table rows."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import event_order, time_bucket, utc_day
from tickloom.operators.checks import at_most
from tickloom.params import Params
from tickloom.sources.table import scan_after

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

CANDLE_COLUMNS = (
    "bucket",
    "symbol",
    "open",
    "high",
    "low",
    "close",
    "volume",
    "usd_volume",
    "trade_count",
    "anomaly_count",
    "avg_z_score",
)


def candle_aggregates() -> list[Column]:
    """The aggregates of one candle; all of them combine before the shuffle."""
    order = event_order(F.col("time"), F.col("trade_id"))
    return [
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"),
        F.sum("usd_value").alias("usd_volume"),
        F.count(F.lit(1)).alias("trade_count"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        F.avg("z_score").alias("avg_z_score"),
    ]


# A part of a candle: enough to merge it with other parts of the same candle. Open and close go
# with the place of their trade.
PART_COLUMNS = (
    "bucket", "symbol", "open_at", "open", "close_at", "close", "high", "low", "volume",
    "usd_volume", "trade_count", "anomaly_count", "z_sum", "z_count",
)


def candle_parts(table: DataFrame, params: Params = Params()) -> DataFrame:
    """Parts of candles with the UTC day of their bucket."""
    order = event_order(F.col("time"), F.col("trade_id"))
    bucket = time_bucket(params.candle_seconds, F.col("time")).alias("bucket")
    return (
        table.groupBy(bucket, "symbol")
        .agg(
            F.min(order).alias("open_at"),
            F.min_by("price", order).alias("open"),
            F.max(order).alias("close_at"),
            F.max_by("price", order).alias("close"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.sum("quantity").alias("volume"),
            F.sum("usd_value").alias("usd_volume"),
            F.count(F.lit(1)).alias("trade_count"),
            F.count_if("is_anomaly").alias("anomaly_count"),
            F.sum("z_score").alias("z_sum"),
            F.count("z_score").alias("z_count"),
        )
        .select(*PART_COLUMNS, utc_day(F.col("bucket")).alias("day"))
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """One part per candle; the order and grouping of the merges make no difference."""
    return (
        parts.groupBy("bucket", "symbol")
        .agg(
            F.min("open_at").alias("open_at"),
            F.min_by("open", "open_at").alias("open"),
            F.max("close_at").alias("close_at"),
            F.max_by("close", "close_at").alias("close"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            *[
                F.sum(c).alias(c)
                for c in ("volume", "usd_volume", "trade_count", "anomaly_count", "z_sum", "z_count")
            ],
        )
        .select(*PART_COLUMNS)
    )


def candles_of_parts(parts: DataFrame) -> DataFrame:
    return merged_parts(parts).selectExpr(
        "bucket", "symbol", "open", "high", "low", "close", "volume", "usd_volume", "trade_count",
        "anomaly_count", "z_sum / nullif(z_count, 0L) AS avg_z_score",
    )


class PartVersions:
    """Parts of candles by day; each batch writes the days that it touches anew, the last one counts.

    A batch is complete once its mark is there. It reads, for each of its days, the latest version
    before its own and replaces its own, so a repeated batch changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _glob(self, pattern: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [f.getPath() for f in files.globStatus(where) or []], files

    def versions(self, before: int | None = None) -> dict[str, int]:
        """The last complete batch that wrote each day; one entry per day."""
        marks, _ = self._glob("batch=*/_SUCCESS")
        whole = {int(m.getParent().getName()[6:]) for m in marks}
        found: dict[str, int] = {}
        for folder in self._glob("batch=*/day=*")[0]:
            day, batch = folder.getName()[4:], int(folder.getParent().getName()[6:])
            if batch in whole and (before is None or batch < before):
                found[day] = max(batch, found.get(day, batch))
        return found

    def _read(self, versions: dict[str, int]) -> DataFrame:
        folders = [f"{self.path}/batch={b}/day={d}" for d, b in versions.items()]
        return self.spark.read.parquet(*folders).select(*PART_COLUMNS)

    def merge(self, fresh: DataFrame, days: list, batch_id: int) -> None:
        """Merge the parts of a batch, which touches these days, into those stored."""
        touched = {str(d) for d in days}
        older = {d: b for d, b in self.versions(batch_id).items() if d in touched}
        parts = fresh.select(*PART_COLUMNS)
        if older:
            parts = parts.unionByName(self._read(older))
        (
            merged_parts(parts)
            .withColumn("day", utc_day(F.col("bucket")))
            .hint("rebalance", "day")
            .write.mode("overwrite")
            .partitionBy("day")
            .parquet(f"{self.path}/batch={batch_id}")
        )
        self._forget(older, batch_id)

    def _forget(self, older: dict[str, int], batch_id: int) -> None:
        """Remove versions of these days that a repeated batch would not read either."""
        for folder in self._glob("batch=*/day=*")[0]:
            day, batch = folder.getName()[4:], int(folder.getParent().getName()[6:])
            if day in older and batch < older[day]:
                self._glob("")[1].delete(folder, True)

    def candles(self) -> DataFrame:
        """The candles of all days as of the last batch."""
        return candles_of_parts(self._read(self.versions()))


def candles(table: DataFrame, params: Params = Params()) -> DataFrame:
    """Candles of every symbol."""
    bucket = time_bucket(params.candle_seconds, F.col("time")).alias("bucket")
    return table.groupBy(bucket, "symbol").agg(*candle_aggregates()).select(*CANDLE_COLUMNS)


def ohlcv(
    table: DataFrame,
    symbol: str,
    minutes: int = 60,
    as_of: datetime | None = None,
    params: Params = Params(),
) -> DataFrame:
    """Candles of one symbol over the last ``minutes``, oldest first.

    ``minutes`` counts candle widths when candles are not one minute wide.
    """
    at_most("minutes", minutes, 1440)
    recent = scan_after(table, as_of, minutes * params.candle_seconds)
    chosen = recent.where(F.col("symbol") == symbol.upper())
    return candles(chosen, params).drop("symbol").orderBy("bucket")


def refresh_range(
    as_of: datetime, params: Params, start_offset: int = 120, end_offset: int = 1
) -> tuple[datetime, datetime]:
    """First bucket and end of the whole buckets between two offsets, in candle widths."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    width = timedelta(seconds=params.candle_seconds)
    age = as_of - EPOCH
    first = -((-(age - start_offset * width)) // width)
    end = (age - end_offset * width) // width
    return EPOCH + first * width, EPOCH + end * width


def candles_between(
    table: DataFrame, start: datetime, end: datetime, params: Params
) -> DataFrame:
    rows = table.where((F.col("time") >= F.lit(start)) & (F.col("time") < F.lit(end)))
    if "day" in table.columns:
        rows = rows.where(F.col("day").between(F.lit(start.date()), F.lit(end.date())))
    return candles(rows, params)


def refresh_candles(
    spark: SparkSession,
    table: DataFrame,
    path: str,
    as_of: datetime,
    params: Params = Params(),
    start_offset: int = 120,
    end_offset: int = 1,
) -> None:
    """Recompute the whole buckets of the refresh range in the candle table at ``path``.

    Only the days touched are rewritten; their other candles are carried over, so
    trades that arrive for older buckets do not change those.
    """
    start, end = refresh_range(as_of, params, start_offset, end_offset)
    fresh = candles_between(table, start, end, params)
    stored = read_candles(spark, path)
    if stored is not None:
        days = F.col("day").between(F.lit(start.date()), F.lit(end.date()))
        outside = (F.col("bucket") < F.lit(start)) | (F.col("bucket") >= F.lit(end))
        fresh = stored.where(days & outside).drop("day").unionByName(fresh)
    (
        fresh.withColumn("day", utc_day(F.col("bucket")))
        .hint("rebalance", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def read_candles(spark: SparkSession, path: str) -> DataFrame | None:
    """The candle table, or None before its first refresh."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def candle_series(candle_rows: DataFrame) -> DataFrame:
    """Chart points of candles; missing values are drawn as zero."""
    zero = F.lit(0.0)
    return candle_rows.select(
        F.date_format("bucket", "HH:mm:ss").alias("t"),
        *(c for c in ("bucket", "symbol") if c in candle_rows.columns),
        F.coalesce("close", zero).alias("close"),
        F.coalesce("usd_volume", zero).alias("vol"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anom"),
    )
