"""Comparison of two symbols."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.trade import (
    SUMS,
    USD_SCALE,
    limb_sums,
    limbs,
    mean_from_sums,
    spread_from_sums,
    stdev_from_sums,
)
from tickloom.operators.carry import CarryStore
from tickloom.operators.enrich import ID_BLOCK_BITS
from tickloom.operators.stats import (
    Windows,
    symbol_summary,
    symbol_windows,
    window_summary,
    windows,
)
from tickloom.params import Params
from tickloom.session import settled

RECENT = 5  # trades that count as recent activity
MIN_FOR_CORRELATION = 5
MIN_FOR_RECENT = 10
DIVERGENCE_LIMIT = 2.0

SUMMARY_FIELDS = (
    "symbol",
    "status",
    "window_size",
    "volume_usd",
    "avg_trade_usd",
    "stdev_usd",
    "volatility_cv",
    "min_usd",
    "max_usd",
    "warmed_up",
)


# Ranges of time that a window is cut into to rank its trades: one task ranks the ticks of one.
RANK_RANGES = 64


def positions(members: DataFrame, params: Params = Params()) -> DataFrame:
    """Limbs of window members with their age rank per symbol, 1 for the newest.

    Ranks are added up on three levels: trades in later time ranges of the window, ticks later
    in the same range, and trades within the tick. A window has no more than ``RANK_RANGES``
    + 1 ranges, so the scan over a symbol's ranges is short whatever the number of trades, and no
    single group holds all trades or ticks of a symbol.
    """
    width = max(1, -(-params.window_us // RANK_RANGES))
    rows = members.select(
        "symbol",
        "t",
        F.expr(f"t - pmod(t, {width}) AS range"),
        F.shiftright("trade_id", ID_BLOCK_BITS).alias("uid"),
        "trade_id",
        *limbs(F.col("usd_value")),
    )
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    counts = rows.groupBy("symbol", "range", "t", "uid").agg(F.count(F.lit(1)).alias("cnt"))
    ranges = (
        rows.groupBy("symbol", "range")
        .agg(F.count(F.lit(1)).alias("inside"))
        .selectExpr(
            "symbol",
            "range",
            f"sum(inside) OVER (PARTITION BY symbol ORDER BY range DESC {upto}) - inside AS later",
        )
    )
    newest = f"PARTITION BY symbol, range ORDER BY t DESC, uid DESC {upto}"
    # At most RANK_RANGES + 1 rows per compared symbol.
    ticks = counts.join(F.broadcast(ranges), ["symbol", "range"]).selectExpr(
        "symbol", "t", "uid", f"later + sum(cnt) OVER ({newest}) - cnt AS newer"
    )
    rank = "row_number() OVER (PARTITION BY symbol, t, uid ORDER BY trade_id DESC)"
    return (
        rows.selectExpr("*", f"{rank} AS rank")
        .join(ticks, ["symbol", "t", "uid"])
        .selectExpr("symbol", "hi", "lo", "newer + rank AS pos")
    )


def aligned_pairs(members: DataFrame, pair: tuple[str, str], params: Params = Params()) -> DataFrame:
    """Window values of two symbols side by side, as limbs, matched by age rank.

    Both windows end at position 1. The pairing is one aggregate, not a self-join.
    """
    placed = positions(members.where(F.col("symbol").isin(*pair)), params)
    sides = [
        F.max(F.when(F.col("symbol") == s, F.col(limb))).alias(f"{side}_{limb}")
        for side, s in zip("xy", pair)
        for limb in ("hi", "lo")
    ]
    return placed.groupBy("pos").agg(*sides).where("x_hi IS NOT NULL AND y_hi IS NOT NULL")


_LIMBS = ("hi", "lo")


def _pair_sums() -> list[Column]:
    """Every sum over the pairs that the figures need, under a name of its own."""
    sums = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("pos") <= RECENT).alias("n_recent")]
    for side in "xy":
        hi, lo = (F.col(f"{side}_{limb}") for limb in _LIMBS)
        for name, which in (("all", F.lit(True)), ("old", F.col("pos") > RECENT), ("new", F.col("pos") <= RECENT)):
            for x, total in limb_sums(F.when(which, hi), F.when(which, lo)).items():
                sums.append(F.coalesce(total, F.lit(0.0)).alias(f"{side}_{name}_{x}"))
    for p in _LIMBS:
        for q in _LIMBS:
            product = F.sum(F.col(f"x_{p}") * F.col(f"y_{q}"))
            sums.append(F.coalesce(product, F.lit(0.0)).alias(f"xy_{p}{q}"))
    return sums


def _sums(side: str, name: str) -> dict[str, Column]:
    return {x: F.col(f"{side}_{name}_{x}") for x in SUMS}


def pair_figures(pairs: DataFrame) -> DataFrame:
    """Correlation, recent z of both symbols and their divergence, in one row.

    The correlation is NULL without spread. The recent z is the mean of the newest values
    against the mean and deviation of the older ones, 0 without spread.
    """
    n, n_old = F.col("n"), F.col("n") - F.col("n_recent")
    mixed = {(p, q): F.col(f"xy_{p}{q}") for p in _LIMBS for q in _LIMBS}
    sums = pairs.agg(*_pair_sums()).select(
        n.alias("pair_count"),
        spread_from_sums(n, mixed, _sums("x", "all"), _sums("y", "all")).alias("cov"),
        *[stdev_from_sums(n, _sums(s, "all")).alias(f"sd_{s}") for s in "xy"],
        *[stdev_from_sums(n_old, _sums(s, "old")).alias(f"old_sd_{s}") for s in "xy"],
        *[mean_from_sums(n_old, _sums(s, "old")).alias(f"old_{s}") for s in "xy"],
        *[mean_from_sums(F.col("n_recent"), _sums(s, "new")).alias(f"new_{s}") for s in "xy"],
    )
    raw = sums.selectExpr(
        "pair_count",
        f"cov / nullif(sd_x * sd_y, 0D) / {USD_SCALE}D / {USD_SCALE}D AS r",
        *[
            f"IF(old_sd_{s} = 0D, 0D, (new_{s} - old_{s}) / nullif(old_sd_{s}, 0D)) AS z{s}"
            for s in "xy"
        ],
    )
    enough = F.col("pair_count") >= MIN_FOR_RECENT
    apart = F.abs(F.col("zy") - F.col("zx"))
    return raw.select(
        "pair_count",
        F.when(F.col("pair_count") >= MIN_FOR_CORRELATION, F.round("r", 4)).alias(
            "rolling_correlation"
        ),
        F.when(enough, F.round("zx", 3)).alias("btc_recent_z"),
        F.when(enough, F.round("zy", 3)).alias("eth_recent_z"),
        F.when(enough, F.round(apart, 3)).alias("relative_divergence"),
        F.when(enough, apart > DIVERGENCE_LIMIT).alias("divergence_alert"),
    )


def _pair_params(params: Params, pair: tuple[str, str]) -> Params:
    return params.with_(symbol_partitions=((pair[0], 0), (pair[1], 1)))


def _side_by_side(summary: DataFrame, pair: tuple[str, str]) -> DataFrame:
    """One row with a struct per symbol and the two volume shares."""
    entry = F.struct(*SUMMARY_FIELDS)
    row = summary.agg(
        *[
            F.coalesce(
                F.first(F.when(F.col("symbol") == s, entry), ignorenulls=True),
                F.named_struct(
                    *[
                        part
                        for f in SUMMARY_FIELDS
                        for part in (
                            F.lit(f),
                            F.lit({"symbol": s, "status": "no_data"}.get(f)),
                        )
                    ]
                ),
            ).alias(side)
            for side, s in zip(("btc", "eth"), pair)
        ]
    )
    first, second = (F.coalesce(F.col(f"{side}.volume_usd"), F.lit(0.0)) for side in ("btc", "eth"))
    total = first + second
    return row.withColumn(
        "btc_volume_share", F.when(total > 0, F.round(first / total, 4))
    ).withColumn("eth_volume_share", F.when(total > 0, F.round(second / total, 4)))


def cross_asset_comparison(
    trades: DataFrame,
    params: Params = Params(),
    pair: tuple[str, str] | None = None,
    store: CarryStore | None = None,
) -> DataFrame:
    """Full comparison of two symbols from their trades, one row."""
    pair = pair or params.symbols[:2]
    chosen = _pair_params(params, pair)
    found = windows(trades, chosen, store)
    # Several parts of the plan use the members, which are as few as the window is short.
    found = Windows(found.ends, settled(found.members, "windows"))
    summary = symbol_windows(found, chosen).withColumn("status", F.lit(None).cast("string"))
    figures = pair_figures(aligned_pairs(found.members, pair, chosen))
    return (
        _side_by_side(summary, pair)
        .withColumn("f", figures.select(F.struct("*")).scalar())
        .select(
            F.lit("ok").alias("status"),
            F.lit(params.window_seconds).alias("window_seconds"),
            "btc",
            "eth",
            "f.rolling_correlation",
            "f.btc_recent_z",
            "f.eth_recent_z",
            "f.relative_divergence",
            "f.divergence_alert",
            "btc_volume_share",
            "eth_volume_share",
        )
    )


def comparison_fallback(
    spark: SparkSession,
    table: DataFrame,
    as_of: datetime | None = None,
    params: Params = Params(),
    pair: tuple[str, str] | None = None,
) -> DataFrame:
    """Comparison from the stored table alone, over one common window, one row."""
    pair = pair or params.symbols[:2]
    chosen = _pair_params(params, pair)
    rows = table.where(F.col("symbol").isin(*pair))
    summary = symbol_summary(spark, window_summary(rows, as_of, chosen), chosen)
    nothing = F.lit(None).cast("double")
    return _side_by_side(summary, pair).select(
        F.lit("ok").alias("status"),
        F.lit(params.window_seconds).alias("window_seconds"),
        F.lit("db_fallback").alias("source"),
        "btc",
        "eth",
        nothing.alias("rolling_correlation"),
        nothing.alias("btc_recent_z"),
        nothing.alias("eth_recent_z"),
        F.lit(False).alias("divergence_alert"),
        "btc_volume_share",
        "eth_volume_share",
    )


def comparison_ratios(comparison: DataFrame) -> DataFrame:
    """Bar lengths of both symbols, relative to the larger one, and the gauge position."""
    r = F.col("rolling_correlation")

    def percent(side, field, floor):
        values = [F.coalesce(F.col(f"{s}.{field}"), F.lit(0.0)) for s in ("btc", "eth")]
        own = values[0] if side == "btc" else values[1]
        return own / F.greatest(*values, F.lit(floor)) * 100

    return comparison.select(
        *[
            percent(side, field, floor).alias(f"{side}_{name}_pct")
            for side in ("btc", "eth")
            for field, name, floor in (
                ("volume_usd", "volume", 1.0),
                ("avg_trade_usd", "avg", 1.0),
                ("volatility_cv", "cv", 0.001),
            )
        ],
        F.coalesce((r + 1) / 2 * 100, F.lit(50.0)).alias("correlation_pct"),
    )


def flat(comparison: DataFrame) -> DataFrame:
    """Comparison with its two structs spread into prefixed columns."""
    columns = []
    for name in comparison.columns:
        if name in ("btc", "eth"):
            columns += [F.col(f"{name}.{f}").alias(f"{name}_{f}") for f in SUMMARY_FIELDS]
        else:
            columns.append(F.col(name))
    return comparison.select(*columns)
