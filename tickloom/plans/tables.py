"""The given tables seen as trades, and the settings the registered queries use.

The events of the given tables are minutes apart, so with one-minute windows nothing
would ever be scored. The queries pass wider settings; the operators keep theirs.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.carry import CarryStore, advance
from tickloom.operators.enrich import enrich, table_row
from tickloom.params import Params
from tickloom.session import fresh_path, utc
from tickloom.sources.table import read_trades, write_trades

# The two symbols that are compared, in place of the two default ones.
PAIR = ("PURCHASE", "VIEW")

SCALED = Params(
    window_seconds=43_200,
    warmup_min_samples=10,
    data_gap_reset_seconds=5_400,
    stale_purge_seconds=7_200,
    candle_seconds=3_600,
    burst_window_seconds=3_600,
    ingestion_rate_threshold=20 / 3_600,
    symbol_partitions=tuple((s, i) for i, s in enumerate(PAIR)),
)

# For the smallest scale, whose events are hours apart.
SMOKE = SCALED.with_(
    window_seconds=432_000, data_gap_reset_seconds=43_200, stale_purge_seconds=64_800
)

SHORT_SECONDS = 43_200  # stands for one minute
LONG_SECONDS = 216_000  # stands for five minutes
PUSH_TRADES_SECONDS = 3_600
PUSH_ANOMALIES_SECONDS = 21_600


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def as_trades(rows: DataFrame) -> DataFrame:
    """Events as raw trades; works on a stream as well."""
    return rows.where("value > 0").select(
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        ((F.col("event_id") % 100 + 1) * 10).cast("double").alias("quantity"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("trade_id"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_trades(events(spark, sf_dir))


def latest(rows: DataFrame, column: str = "event_time") -> datetime:
    """The one time that stands for the present; a literal, so that scans are pruned."""
    micros = rows.agg(F.unix_micros(F.max(column)).alias("m")).first()["m"]
    return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=micros or 0)


_stored: dict[tuple, str] = {}


def stored_path(spark: SparkSession, sf_dir: str, params: Params = SCALED) -> str:
    """Folder of the enriched table, which is written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, params)
    if key not in _stored:
        path = fresh_path(utc(spark), "trades")
        write_trades(table_row(enrich(trades(spark, sf_dir), params)), path)
        _stored[key] = path
    return _stored[key]


def stored_trades(spark: SparkSession, sf_dir: str, params: Params = SCALED) -> DataFrame:
    """The enriched table as the feeds read it, with pruning by day and statistics."""
    return read_trades(spark, stored_path(spark, sf_dir, params))


_carries: dict[tuple, CarryStore] = {}


def stored_carry(spark: SparkSession, sf_dir: str, params: Params = SCALED) -> CarryStore:
    """What symbols take over, kept up to the last days; made once per application, in two steps."""
    key = (spark.sparkContext.applicationId, sf_dir, params.with_(symbol_partitions=()))
    if key not in _carries:
        rows = trades(utc(spark), sf_dir)
        store, now = CarryStore(spark, fresh_path(spark, "carry")), latest(rows)
        for days in (10, 2):
            advance(store, rows, now - timedelta(days=days), params)
        _carries[key] = store
    return _carries[key]


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps as zone-free UTC times, the type of the given tables."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
