"""Checks on raw and enriched trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.trade import normalize_symbol, usd_value
from tickloom.params import Params
from tickloom.schemas import CLASSES

TOLERANCE = 0.01


def with_normal_symbol(trades: DataFrame) -> DataFrame:
    return trades.withColumn("symbol", normalize_symbol(F.col("symbol")))


def trade_fault(
    symbol: str = "symbol",
    price: str = "price",
    quantity: str = "quantity",
    event_time: str = "event_time",
    trade_id: str = "trade_id",
) -> Column:
    """Why a raw trade is refused, NULL if it is fine."""
    missing = F.lit(False)
    for name in (symbol, price, quantity, event_time, trade_id):
        missing = missing | F.col(name).isNull()

    def not_positive(name):
        return ~(F.col(name) > 0) | F.isnan(F.col(name))

    # Either of them, or their product: no double holds the amount then.
    not_finite = F.col(price) * F.col(quantity) == F.lit(float("inf"))
    return (
        F.when(missing, F.lit("missing_field"))
        .when(not_positive(price), F.lit("price_not_positive"))
        .when(not_positive(quantity), F.lit("quantity_not_positive"))
        .when(not_finite, F.lit("not_finite"))
    )


def validate_trades(trades: DataFrame) -> DataFrame:
    """Raw trades with normal symbol and ``fault``; split them by the latter."""
    return with_normal_symbol(trades).withColumn("fault", trade_fault())


def good_trades(trades: DataFrame) -> DataFrame:
    return validate_trades(trades).where(F.col("fault").isNull()).drop("fault")


def bad_trades(trades: DataFrame) -> DataFrame:
    return validate_trades(trades).where(F.col("fault").isNotNull())


def _partition_of(params: Params) -> Column:
    """Topic partition of a symbol; the map is a handful of configured entries."""
    pairs = [F.lit(x) for pair in params.symbol_partitions for x in pair]
    return F.try_element_at(F.create_map(*pairs), F.col("symbol"))


def known_symbols(trades: DataFrame, params: Params = Params()) -> DataFrame:
    """Trades of the configured symbols, with their topic partition.

    The map is a constant of the plan, so this stays a filter on the scan.
    """
    known = trades.where(F.col("symbol").isin(*params.symbols))
    return known.withColumn("partition", _partition_of(params).cast("int"))


def unknown_symbols(trades: DataFrame, params: Params = Params()) -> DataFrame:
    """How many trades of which other symbols were left out."""
    return (
        trades.where(~F.col("symbol").isin(*params.symbols))
        .groupBy("symbol")
        .agg(F.count(F.lit(1)).alias("trade_count"))
    )


def enriched_fault() -> Column:
    """Why an enriched trade is inconsistent, NULL if it is fine."""
    off = F.abs(F.col("usd_value") - usd_value(F.col("price"), F.col("quantity")))
    return F.when(off > TOLERANCE, F.lit("usd_value_mismatch")).when(
        ~F.col("classification").isin(*CLASSES), F.lit("unknown_class")
    )


def check_enriched(enriched: DataFrame) -> DataFrame:
    return enriched.withColumn("fault", enriched_fault())
