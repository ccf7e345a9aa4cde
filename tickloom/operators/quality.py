"""Counters of the data flow, as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.params import Params


def ingest_counts(parsed: DataFrame, params: Params = Params()) -> DataFrame:
    """Messages received, published, ignored, refused and of unknown symbols."""
    ok = F.col("status") == "ok"
    known = F.col("symbol").isin(*params.symbols)
    return parsed.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(ok & known).alias("published"),
        F.count_if(ok & ~known).alias("unknown_symbol"),
        F.count_if(F.col("status") == "ignored").alias("ignored"),
        F.count_if(F.col("status") == "parse_error").alias("parse_errors"),
    )


def enrich_counts(enriched: DataFrame) -> DataFrame:
    """Trades enriched and scored, anomalies found, and the event-time rate."""
    span = (F.unix_micros(F.max("event_time")) - F.unix_micros(F.min("event_time"))) / 1e6
    return enriched.agg(
        F.count(F.lit(1)).alias("enriched"),
        F.count("z_score").alias("scored"),
        F.count_if("is_anomaly").alias("anomalies"),
        (F.count(F.lit(1)) / F.nullif(span, F.lit(0.0))).alias("rate_per_second"),
    )


def observed(parsed: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counting by status as they pass; batch only.

    On a stream use ``parsed.observe(name, ...)``: the counts then arrive with the
    progress events of the query.
    """
    watch = Observation(name)
    counts = [
        F.count_if(F.col("status") == s).alias(s) for s in ("ok", "ignored", "parse_error")
    ]
    return parsed.observe(watch, F.count(F.lit(1)).alias("received"), *counts), watch


def burst_windows(trades: DataFrame, params: Params = Params()) -> DataFrame:
    """Event-time windows in which trades came faster than the threshold.

    One row per window, so an alert cannot repeat within one. Works on streams with
    a watermark on ``event_time``.
    """
    width = params.burst_window_seconds
    counted = trades.groupBy(F.window("event_time", f"{width} seconds").alias("w")).agg(
        F.count(F.lit(1)).alias("trade_count")
    )
    rate = F.col("trade_count") / F.lit(width)
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "trade_count",
        rate.alias("rate_per_second"),
    ).where(rate > params.ingestion_rate_threshold)
