"""Exchange messages: one JSON text per row, typed strictly.

The message format tells numbers from texts: price and quantity must be JSON
strings, ids and times whole numbers (quoted or not). ``from_json`` converts
silently between the two, so the fields are read as variants, which keep the type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.trade import normalize_symbol
from tickloom.schemas import WIRE

TRADE_EVENT = "aggTrade"

# Texts that the message format takes as true or false.
BOOLEAN_TEXTS = ("true", "false", "t", "f", "yes", "no", "y", "n", "on", "off", "1", "0")

PLAIN_NUMBER = r"^\d+(\.\d+)?$"
WHOLE_NUMBER = r"^\s*[+-]?\d+(\.0*)?\s*$"
DECIMAL_NUMBER = (
    r"^\s*[+-]?((\d+(_\d+)*)?\.?\d+(_\d+)*|\d+(_\d+)*\.)([eE][+-]?\d+)?\s*$"
)
SPECIAL_NUMBER = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"


def read_wire_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Messages from text files as they appear in a folder."""
    return spark.readStream.format("text").schema(WIRE).options(**options).load(path)


def read_wire(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WIRE).text(path)


def number_text(text: Column) -> Column:
    """A double from text, NULL if the text is no number."""
    loose = text.rlike(DECIMAL_NUMBER) | text.rlike(SPECIAL_NUMBER)
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double")).when(
        loose, F.regexp_replace(F.trim(text), "_", "").try_cast("double")
    )


def _whole(kind: Column, text: Column) -> Column:
    """A whole number, bare or quoted; NULL for anything else."""
    digits = F.when(
        kind.rlike("^(STRING|DECIMAL|DOUBLE|FLOAT)") & text.rlike(WHOLE_NUMBER),
        F.trim(F.regexp_replace(text, r"\.0*\s*$", "")).try_cast("bigint"),
    )
    return (
        F.when(kind == "BIGINT", text.try_cast("bigint"))
        .when(kind == "BOOLEAN", F.when(text == "true", 1).otherwise(0).cast("bigint"))
        .otherwise(digits)
    )


def _is_boolean(kind: Column, text: Column) -> Column:
    return (
        F.when(kind == "BOOLEAN", True)
        .when(kind == "STRING", F.lower(text).isin(*BOOLEAN_TEXTS))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), text.try_cast("double").isin(0.0, 1.0))
        .otherwise(False)
    )


# The message's fields; those in upper case get a name that differs in more than case.
FIELDS = {
    "stream": "$.stream",
    "e": "$.data.e",
    "sent": "$.data.E",
    "s": "$.data.s",
    "a": "$.data.a",
    "p": "$.data.p",
    "q": "$.data.q",
    "at": "$.data.T",
    "m": "$.data.m",
}
TEXT_FIELDS = ("stream", "e", "s", "p", "q")
LATEST_MS = 253_402_300_799_999


def parse_wire(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``status`` (ok, ignored, parse_error) and the trade fields of good rows.

    Ignored: anything without a stream name and any well-formed message of another
    event type. Other columns of the input stay. Each step is a projection of its
    own, so that no field is taken out of the document twice.
    """
    keep = [c for c in messages.columns if c != value]
    rows = messages.select(
        *keep, F.col(value).alias("raw"), F.try_parse_json(F.col(value)).alias("doc")
    )
    rows = rows.select(
        *keep,
        "raw",
        F.schema_of_variant("doc").alias("shape"),
        *[F.try_variant_get("doc", path, "variant").alias(n) for n, path in FIELDS.items()],
    )
    rows = rows.select(
        *keep,
        "raw",
        "shape",
        *[F.schema_of_variant(n).alias(f"{n}_kind") for n in FIELDS],
        *[F.try_variant_get(n, "$", "string").alias(f"{n}_text") for n in FIELDS],
    )

    def of(name):
        return F.col(f"{name}_kind"), F.col(f"{name}_text")

    rows = rows.select(
        *keep,
        "raw",
        "shape",
        F.col("stream_kind").isNull().alias("no_stream"),
        F.expr(" AND ".join(f"coalesce({n}_kind = 'STRING', false)" for n in TEXT_FIELDS)).alias("texts"),
        F.coalesce(_is_boolean(*of("m")), F.lit(False)).alias("flag"),
        F.col("e_text").alias("event"),
        F.col("s_text").alias("symbol_text"),
        number_text(F.col("p_text")).alias("price"),
        number_text(F.col("q_text")).alias("quantity"),
        *[_whole(*of(n)).alias(n) for n in ("sent", "a", "at")],
    )
    typed = F.expr("texts AND flag AND sent IS NOT NULL AND a IS NOT NULL AND at IS NOT NULL")
    positive = F.expr(
        "coalesce(price > 0 AND quantity > 0 AND NOT isnan(price) AND NOT isnan(quantity) "
        f"AND price * quantity < DOUBLE('Infinity') AND abs(at) <= {LATEST_MS}, false)"
    )
    bare = F.expr("shape RLIKE '^(ARRAY|STRING)' OR (startswith(shape, 'OBJECT') AND no_stream)")
    status = (
        F.when(F.col("shape").isNull(), F.lit("parse_error"))
        .when(bare, F.lit("ignored"))
        .when(~typed, F.lit("parse_error"))
        .when(F.col("event") != TRADE_EVENT, F.lit("ignored"))
        .when(positive, F.lit("ok"))
        .otherwise(F.lit("parse_error"))
    )
    rows = rows.select("*", status.alias("status"))
    good = F.col("status") == "ok"
    return rows.select(
        *keep,
        "raw",
        "status",
        F.when(good, normalize_symbol(F.col("symbol_text"))).alias("symbol"),
        F.when(good, F.col("price")).alias("price"),
        F.when(good, F.col("quantity")).alias("quantity"),
        F.when(good, F.timestamp_millis(F.col("at"))).alias("event_time"),
        F.when(good, F.col("a")).alias("trade_id"),
    )


def wire_trades(messages: DataFrame) -> DataFrame:
    """The trades among the messages."""
    return parse_wire(messages).where("status = 'ok'").select(
        "symbol", "price", "quantity", "event_time", "trade_id"
    )
