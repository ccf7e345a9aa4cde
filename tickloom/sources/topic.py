"""Trades on a keyed topic: encoding, decoding, and the connector options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.trade import normalize_symbol
from tickloom.operators.validate import known_symbols
from tickloom.params import Params
from tickloom.schemas import TOPIC
from tickloom.sources.wire import number_text

# Fixed format: a calendar date, optionally with a time, fraction and zone.
ISO_TIME = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2}(:\d{2})?)?)?$"
)
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"


def encode_topic(trades: DataFrame, params: Params = Params()) -> DataFrame:
    """Key, JSON value and partition of every trade of a known symbol."""
    micros = F.pmod(F.unix_micros("event_time"), F.lit(1_000_000))
    stamp = F.concat(
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros > 0, F.date_format("event_time", ".SSSSSS")).otherwise(F.lit("")),
        F.lit("+00:00"),
    )
    value = F.to_json(
        F.struct("symbol", "price", "quantity", stamp.alias("event_time"), "trade_id")
    )
    return known_symbols(trades, params).select(
        F.col("symbol").alias("key"), value.alias("value"), "partition"
    )


def decode_topic(messages: DataFrame) -> DataFrame:
    """Add ``status`` (ok, failed) and the trade fields; naive times are UTC."""
    keep = [c for c in messages.columns if c != "value"]
    text = F.col("value").cast("string")
    raw_fields = "symbol string, price string, quantity string, event_time string, trade_id string"
    body = F.from_json(text, raw_fields, {"mode": "PERMISSIVE"})
    # from_json turns any JSON value into text; the symbol must have been one.
    symbol_kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(text), "$.symbol", "variant")
    )
    rows = messages.select(*keep, text.alias("raw"), body.alias("b"), symbol_kind.alias("kind"))
    whole = F.regexp_replace(F.trim("b.trade_id"), r"\.0*$", "")
    rows = rows.select(
        *keep,
        "raw",
        "kind",
        normalize_symbol(F.col("b.symbol")).alias("symbol"),
        number_text(F.col("b.price")).alias("price"),
        number_text(F.col("b.quantity")).alias("quantity"),
        F.when(F.col("b.event_time").rlike(ISO_TIME), F.try_to_timestamp("b.event_time")).alias(
            "event_time"
        ),
        F.when(whole.rlike(r"^[+-]?\d+$"), whole.try_cast("bigint")).alias("trade_id"),
    )
    good = F.coalesce(
        (F.col("kind") == "STRING")
        & (F.col("price") > 0)
        & (F.col("quantity") > 0)
        & ~F.isnan("price")
        & ~F.isnan("quantity")
        & (F.col("price") * F.col("quantity") < float("inf"))
        & F.col("event_time").isNotNull()
        & F.col("trade_id").isNotNull(),
        F.lit(False),
    )
    rows = rows.withColumn("status", F.when(good, F.lit("ok")).otherwise(F.lit("failed")))
    fields = ("symbol", "price", "quantity", "event_time", "trade_id")
    return rows.select(
        *keep,
        "raw",
        "status",
        *[F.when(F.col("status") == "ok", F.col(c)).alias(c) for c in fields],
    )


def good_messages(decoded: DataFrame) -> DataFrame:
    """The trades, and with them ``offset`` where the messages have one."""
    fields = ("symbol", "price", "quantity", "event_time", "trade_id")
    more = [c for c in ("offset",) if c in decoded.columns]
    return decoded.where("status = 'ok'").select(*fields, *more)


def topic_trades(messages: DataFrame) -> DataFrame:
    return good_messages(decode_topic(messages)).drop("offset")


def read_topic_stream(
    spark: SparkSession,
    params: Params = Params(),
    bootstrap: str | None = None,
    path: str | None = None,
    max_per_batch: int | None = None,
) -> DataFrame:
    """The topic from its beginning, from a broker or from a folder of Parquet files.

    Positions are kept in the checkpoint of the query that reads the stream. From a broker, a
    batch starts when ``batch_flush_size`` messages wait or ``batch_flush_interval_ms`` have
    passed, whichever comes first; a folder gives what files there are.
    """
    if (bootstrap is None) == (path is None):
        raise ValueError("give either a broker address or a path")
    if path is not None:
        reader = spark.readStream.schema(TOPIC)
        if max_per_batch:
            reader = reader.option("maxFilesPerTrigger", max_per_batch)
        return reader.parquet(path)
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", params.topic)
        .option("startingOffsets", "earliest")
        .options(**flush_options(params))
    )
    if max_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
    return reader.load().selectExpr(
        "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "partition", "offset"
    )


def flush_options(params: Params) -> dict[str, str]:
    """Size-or-time admission of messages into a batch, for the broker's source."""
    return {
        "minOffsetsPerTrigger": str(params.batch_flush_size),
        "maxTriggerDelay": f"{params.batch_flush_interval_ms}ms",
    }


def publish_stream(
    trades: DataFrame,
    checkpoint: str,
    params: Params = Params(),
    bootstrap: str | None = None,
    path: str | None = None,
    trigger: dict | None = None,
):
    """Start publishing trades to a broker, or to a folder with one part per symbol."""
    if (bootstrap is None) == (path is None):
        raise ValueError("give either a broker address or a path")
    rows = encode_topic(trades, params)
    trigger = trigger or {"processingTime": f"{params.batch_flush_interval_ms} milliseconds"}
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)
    if path is not None:
        return writer.format("parquet").partitionBy("partition").start(path)
    return (
        writer.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", params.topic)
        .start()
    )
