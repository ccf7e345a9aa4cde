"""Newest-first feeds of trades and anomalies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.checks import at_most
from tickloom.schemas import TABLE_COLUMNS
from tickloom.sources.table import scan_after

ANOMALY_COLUMNS = ["trade_id", "time", "symbol", "price", "usd_value", "classification", "z_score"]


def _newest_first():
    return F.col("time").desc(), F.col("trade_id").desc()


def _top_per_symbol(rows: DataFrame, count: int) -> DataFrame:
    """Spark keeps the first ``count`` rows per symbol of each task before the shuffle."""
    order = Window.partitionBy("symbol").orderBy(*_newest_first())
    return (
        rows.withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= count)
        .select(*TABLE_COLUMNS)
    )


def live_trades(
    table: DataFrame,
    limit: int = 50,
    symbol: str | None = None,
    as_of: datetime | None = None,
    seconds: float = 300,
    per_symbol: int | None = None,
) -> DataFrame:
    """Latest trades of one symbol, or the latest few of every symbol."""
    at_most("limit", limit, 200)
    recent = scan_after(table, as_of, seconds)
    if symbol:
        chosen = recent.where(F.col("symbol") == symbol.upper())
        return chosen.select(*TABLE_COLUMNS).orderBy(*_newest_first()).limit(limit)
    count = limit // 2 if per_symbol is None else per_symbol
    return _top_per_symbol(recent, count).orderBy(*_newest_first())


def push_trades(
    table: DataFrame, as_of: datetime | None = None, seconds: float = 2, per_symbol: int = 20
) -> DataFrame:
    return _top_per_symbol(scan_after(table, as_of, seconds), per_symbol).orderBy(
        *_newest_first()
    )


def anomaly_feed(
    table: DataFrame,
    limit: int = 20,
    symbol: str | None = None,
    minutes: int = 60,
    as_of: datetime | None = None,
    minute_seconds: float = 60,
) -> DataFrame:
    """Latest anomalies; ``minute_seconds`` stretches the minute for sparse data."""
    at_most("limit", limit, 100)
    at_most("minutes", minutes, 1440)
    rows = scan_after(table, as_of, minutes * minute_seconds).where("is_anomaly")
    if symbol:
        rows = rows.where(F.col("symbol") == symbol.upper())
    return (
        rows.select(*ANOMALY_COLUMNS, "is_anomaly").orderBy(*_newest_first()).limit(limit)
    )


def push_anomalies(
    table: DataFrame, as_of: datetime | None = None, seconds: float = 5, limit: int = 10
) -> DataFrame:
    rows = scan_after(table, as_of, seconds).where("is_anomaly")
    return rows.select(*ANOMALY_COLUMNS).orderBy(*_newest_first()).limit(limit)


def recent_anomalies(
    table: DataFrame, as_of: datetime | None = None, seconds: float = 3600
) -> DataFrame:
    rows = scan_after(table, as_of, seconds).where("is_anomaly")
    return rows.select(*ANOMALY_COLUMNS).orderBy(*_newest_first())


def merge_feed(
    incoming: DataFrame, previous: DataFrame, cap: int = 100, key: str = "trade_id"
) -> DataFrame:
    """New rows before old ones, each key once (its first showing), ``cap`` rows at most.

    Both inputs are feeds ordered newest first. The first showing of a key is found
    by an aggregate that combines before the shuffle, so many copies do no harm.
    """
    columns = incoming.columns
    both = incoming.withColumn("shown_before", F.lit(0)).unionByName(
        previous.select(*columns).withColumn("shown_before", F.lit(1))
    )
    place = F.struct(
        "shown_before", (-F.unix_micros("time")).alias("recency"), (-F.col("trade_id")).alias("tie")
    )
    first = both.withColumn("place", place).groupBy(key).agg(
        F.min_by(F.struct(*columns, "place"), "place").alias("row")
    )
    return first.select("row.*").orderBy("place").limit(cap).drop("place")


def feed_tab(feed: DataFrame, tab: str = "ALL") -> DataFrame:
    """Rows of one feed tab: everything, one asset by symbol prefix, or whales."""
    if tab == "ALL":
        return feed
    if tab == "WHALE":
        return feed.where(F.col("classification") == "Whale")
    return feed.where(F.col("symbol").startswith(tab))


def feed_tabs(feed: DataFrame, assets: tuple[str, ...] = ("BTC", "ETH")) -> DataFrame:
    """Row and anomaly count of every tab, from one pass over the feed."""
    symbol = F.col("symbol")
    tabs = F.array_compact(
        F.array(
            F.lit("ALL"),
            *[F.when(symbol.startswith(a), F.lit(a)) for a in assets],
            F.when(F.col("classification") == "Whale", F.lit("WHALE")),
        )
    )
    return (
        feed.select(F.explode(tabs).alias("tab"), "is_anomaly")
        .groupBy("tab")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if("is_anomaly").alias("anomaly_count"),
        )
    )


def normalized_series(series: DataFrame, most: int = 1440) -> DataFrame:
    """Chart points scaled to a 100 by 54 canvas, per symbol.

    A symbol's candles are worked on together; more than ``most`` of them, the limit on the
    range of a chart, are refused with an error.
    """
    per_symbol = Window.partitionBy("symbol")
    spot = F.row_number().over(per_symbol.orderBy("bucket")) - 1
    count = F.count(F.lit(1)).over(per_symbol)
    low, high = F.min("close").over(per_symbol), F.max("close").over(per_symbol)
    rows = series.select(
        "symbol",
        "bucket",
        "close",
        spot.alias("i"),
        count.alias("n"),
        low.alias("low"),
        F.when(high == low, F.lit(1.0)).otherwise(high - low).alias("span"),
    )
    return rows.select(
        "symbol",
        "bucket",
        F.when(F.col("n") > most, F.raise_error(F.lit(f"more than {most} points in a chart")))
        .when(F.col("n") == 1, F.lit(0.0))
        .otherwise(F.col("i") / F.nullif(F.col("n") - 1, F.lit(0)) * 100)
        .alias("x"),
        (54 - (F.col("close") - F.col("low")) / F.col("span") * 54).alias("y"),
    )
