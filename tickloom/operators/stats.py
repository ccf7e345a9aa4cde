"""Per-symbol statistics over the latest trades."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import ago, event_order
from tickloom.functions.trade import (
    SUMS,
    limb_sums,
    limbs,
    mean_from_sums,
    stdev_from_sums,
    total_from_sums,
    usd_value,
)
from tickloom.operators.carry import CarryStore, moment, tail
from tickloom.operators.enrich import carry_after
from tickloom.params import Params
from tickloom.sources.table import scan_after


def symbol_list(spark: SparkSession, params: Params = Params()) -> DataFrame:
    """The configured symbols with their topic partition; a few rows by definition."""
    return spark.createDataFrame(
        [tuple(pair) for pair in params.symbol_partitions], "symbol string, partition int"
    )


def live_stats(
    table: DataFrame,
    as_of: datetime | None = None,
    short_seconds: float = 60,
    long_seconds: float = 300,
) -> DataFrame:
    """Counts, volumes and prices per symbol in a short and a long recent range."""
    in_short = F.col("time") > ago(as_of, short_seconds)

    def short(column) -> Column:
        return F.when(in_short, column)

    order = event_order(F.col("time"), F.col("trade_id"))
    return (
        scan_after(table, as_of, long_seconds)
        .groupBy("symbol")
        .agg(
            F.count_if(in_short).alias("trades_1m"),
            F.count(F.lit(1)).alias("trades_5m"),
            F.sum(short(F.col("usd_value"))).alias("vol_1m"),
            F.sum("usd_value").alias("vol_5m"),
            F.count_if("is_anomaly").alias("anomalies_5m"),
            F.max("time").alias("last_trade"),
            F.max(short(F.col("price"))).alias("price_high_1m"),
            F.min(short(F.col("price"))).alias("price_low_1m"),
            F.max_by("price", order).alias("latest_price"),
        )
    )


@dataclass(frozen=True)
class Windows:
    """The windows of the configured symbols as of their own last trades.

    ``ends``: symbol, last_event and in_gap_pause, one row per symbol that has trades.
    ``members``: the trades inside each window, with ``t`` and ``usd_value``.
    """

    ends: DataFrame
    members: DataFrame


def windows(
    trades: DataFrame, params: Params = Params(), store: CarryStore | None = None
) -> Windows:
    """Find the windows; with a store of carries, only trades since its latest moment are read.

    Where each symbol stands, one row per configured symbol, is fetched first: a pause can
    be as old as the data, so without a store all trades count, by symbol, time and id. It comes
    back as a broadcast table and as one literal bound, which lets the scan of the members
    skip all data that is older than every window.
    """
    spark = trades.sparkSession
    carry, since = store.latest() if store else (None, None)
    known = trades.where(F.col("symbol").isin(*params.symbols))
    if carry is not None:
        carry = carry.where(F.col("symbol").isin(*params.symbols))
    last = carry_after(tail(known, since, params), params, carry, since).collect()
    need = params.warmup_min_samples
    # Looking at the window now counts the last trade too, and may find the pause over.
    rows = [(r.symbol, r.last_t, r.stops > 0 and not r.over and r.n_after < need) for r in last]
    ends = spark.createDataFrame(rows, "symbol string, last_t long, in_gap_pause boolean")
    return Windows(
        ends.select("symbol", F.timestamp_micros("last_t").alias("last_event"), "in_gap_pause"),
        _members(known, [(s, t - params.window_us) for s, t, _ in rows], params),
    )


def _members(known: DataFrame, starts: list[tuple[str, int]], params: Params) -> DataFrame:
    """The trades from each symbol's start on; starts are one per configured symbol."""
    bounds = known.sparkSession.createDataFrame(starts, "symbol string, from_t long")
    earliest = moment(min((t for _, t in starts), default=0))
    usd = usd_value(F.col("price"), F.col("quantity"))
    inside = (
        known.where(F.col("event_time") >= F.lit(earliest))
        .select("*", F.unix_micros("event_time").alias("t"), usd.alias("usd_value"))
        .join(F.broadcast(bounds), "symbol")
        .where("t >= from_t")
        .drop("from_t")
    )
    if params.purge_us >= params.window_us:
        return inside
    # A purge inside the window hides everything before it. Times are made distinct and cut into
    # ranges as long as the purge gap; a gap within a range is too short, so only the ends of
    # the ranges count, and of those a window has no more than its length allows.
    width = params.purge_us
    ranges = (
        inside.groupBy("symbol", F.expr(f"t - pmod(t, {width})").alias("range"))
        .agg(F.min("t").alias("first"), F.max("t").alias("last"))
    )
    after = "lead(first) OVER (PARTITION BY symbol ORDER BY range)"
    hidden = (
        ranges.selectExpr("symbol", f"IF({after} - last > {params.purge_us}, last, NULL) AS t")
        .groupBy("symbol")
        .agg(F.max("t").alias("hidden_t"))
    )
    return (
        inside.join(F.broadcast(hidden), "symbol")
        .where("hidden_t IS NULL OR t > hidden_t")
        .drop("hidden_t")
    )


def window_moments(members: DataFrame) -> DataFrame:
    """Size, sums and extremes of every window, and the figures from them."""
    usd = F.col("usd_value")
    sums = limb_sums(F.col("hi"), F.col("lo"))
    moments = members.select("symbol", usd, *limbs(usd)).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("window_size"),
        *[c.alias(f"s_{x}") for x, c in sums.items()],
        F.round(F.min(usd), 2).alias("min_usd"),
        F.round(F.max(usd), 2).alias("max_usd"),
    )
    n, s = F.col("window_size"), {x: F.col(f"s_{x}") for x in SUMS}
    moments = moments.select(
        "*",
        total_from_sums(s).alias("total"),
        mean_from_sums(n, s).alias("mean"),
        stdev_from_sums(n, s).alias("sd"),
    )
    return moments.select(
        "symbol",
        "window_size",
        F.round("total", 2).alias("volume_usd"),
        F.round("mean", 2).alias("avg_trade_usd"),
        F.round("sd", 2).alias("stdev_usd"),
        F.expr("IF(mean > 0, round(sd / mean, 4), NULL) AS volatility_cv"),
        "min_usd",
        "max_usd",
    )


def symbol_windows(found: Windows, params: Params = Params()) -> DataFrame:
    """Window summary and readiness of the configured symbols that have data."""
    warmed = ~F.col("in_gap_pause") & (F.col("window_size") >= params.warmup_min_samples)
    # One row per configured symbol.
    return (
        window_moments(found.members).join(F.broadcast(found.ends), "symbol").withColumn("warmed_up", warmed)
    )


def window_stats(
    spark: SparkSession,
    trades: DataFrame,
    params: Params = Params(),
    symbol: str | None = None,
    store: CarryStore | None = None,
) -> DataFrame:
    """Window snapshot of every configured symbol, or of one; 'no_data' where none."""
    if symbol is not None:
        params = params.with_(symbol_partitions=((symbol.upper(), 0),))
    return (
        symbol_list(spark, params)
        .join(symbol_windows(windows(trades, params, store), params), "symbol", "left")
        .select(
            "symbol",
            F.when(F.col("window_size").isNull(), F.lit("no_data")).alias("status"),
            "window_size",
            "warmed_up",
            "in_gap_pause",
            "last_event",
            F.col("avg_trade_usd").alias("mean_usd"),
            "stdev_usd",
            "min_usd",
            "max_usd",
        )
    )


def zwindow_ready(windows: DataFrame) -> DataFrame:
    """LIVE when every configured symbol is warmed up."""
    warmed = F.coalesce(F.bool_and(F.coalesce("warmed_up", F.lit(False))), F.lit(False))
    return windows.agg(
        F.when(warmed, F.lit("LIVE")).otherwise(F.lit("WARM")).alias("z_window"),
        F.count_if("warmed_up").alias("warmed_symbols"),
        F.count(F.lit(1)).alias("symbol_count"),
    )


def stats_totals(stats: DataFrame) -> DataFrame:
    """Totals over all symbols next to the per-symbol figures."""
    return stats.rollup("symbol").agg(
        F.coalesce(F.sum("trades_1m"), F.lit(0)).alias("trades_1m"),
        F.coalesce(F.sum("vol_1m"), F.lit(0.0)).alias("vol_1m"),
        F.coalesce(F.sum("vol_5m"), F.lit(0.0)).alias("vol_5m"),
        F.coalesce(F.sum("anomalies_5m"), F.lit(0)).alias("anomalies_5m"),
    ).withColumn("symbol", F.coalesce("symbol", F.lit("TOTAL")))


def stats_with_windows(
    spark: SparkSession,
    stats: DataFrame,
    windows: DataFrame,
    as_of: datetime | None = None,
    params: Params = Params(),
) -> DataFrame:
    """Statistics of every symbol with the window state of the configured ones."""
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    state = windows.select(
        "symbol",
        "window_size",
        "warmed_up",
        "in_gap_pause",
        "last_event",
        "mean_usd",
        F.col("stdev_usd"),
    )
    return stats.join(state, "symbol", "left").withColumn("as_of", stamp)


def window_summary(
    table: DataFrame, as_of: datetime | None = None, params: Params = Params()
) -> DataFrame:
    """Count, volume, mean, deviation and extremes over the window before ``as_of``."""
    usd = F.col("usd_value")
    return (
        scan_after(table, as_of, params.window_seconds)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("window_size"),
            F.sum(usd).alias("volume_usd"),
            F.avg(usd).alias("avg_trade_usd"),
            F.stddev_pop(usd).alias("stdev_usd"),
            F.min(usd).alias("min_usd"),
            F.max(usd).alias("max_usd"),
        )
    )


def symbol_summary(
    spark: SparkSession,
    summary: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Rounded window summary of every configured symbol, 'no_data' where missing."""
    mean, sd = F.col("avg_trade_usd"), F.col("stdev_usd")
    shaped = summary.select(
        "symbol",
        "window_size",
        F.round("volume_usd", 2).alias("volume_usd"),
        F.round(mean, 2).alias("avg_trade_usd"),
        F.round(sd, 2).alias("stdev_usd"),
        F.when(mean > 0, F.round(sd / mean, 4)).alias("volatility_cv"),
        F.round("min_usd", 2).alias("min_usd"),
        F.round("max_usd", 2).alias("max_usd"),
        (F.col("window_size") >= params.warmup_min_samples).alias("warmed_up"),
    )
    wanted = symbol_list(spark, params).select("symbol")
    return wanted.join(shaped, "symbol", "left").withColumn(
        "status", F.when(F.col("window_size").isNull(), F.lit("no_data"))
    )


def volatility(summary: DataFrame) -> DataFrame:
    mean, sd = F.col("avg_trade_usd"), F.col("stdev_usd")
    return summary.select(
        "symbol", F.when(mean > 0, F.round(sd / mean, 4)).alias("volatility_cv")
    )


def volume_share(summary: DataFrame) -> DataFrame:
    """Each symbol's part of the total volume; NULL when there is none."""
    volume = F.coalesce("volume_usd", F.lit(0.0))
    total = summary.agg(F.sum(volume)).scalar()
    return summary.select("symbol", volume.alias("v"), total.alias("total")).select(
        "symbol",
        F.when(F.col("total") > 0, F.round(F.col("v") / F.col("total"), 4)).alias(
            "volume_share"
        ),
    )
