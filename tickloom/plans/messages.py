"""Messages derived from the given events, with faults of every kind mixed in."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans import tables as tb

# Faults by event id; the first that applies wins.
WIRE_FAULTS = (
    (97, "cut"),
    (89, "other_event"),
    (83, "no_stream"),
    (79, "negative_price"),
    (73, "text_quantity"),
    (71, "loose_symbol"),
    (67, "bare_price"),
)
TOPIC_FAULTS = ((59, "cut"), (53, "no_id"), (47, "zero_price"), (61, "naive_time"))


def _fault(faults):
    case = None
    for step, name in faults:
        hit = F.col("trade_id") % step == 0
        case = F.when(hit, F.lit(name)) if case is None else case.when(hit, F.lit(name))
    return case.otherwise(F.lit("none"))


def wire_messages(trades: DataFrame) -> DataFrame:
    """``event_id`` and the JSON text of one exchange message per trade."""
    rows = trades.withColumn("fault", _fault(WIRE_FAULTS))
    is_fault = {name: F.col("fault") == name for _, name in WIRE_FAULTS}
    at = F.unix_millis("event_time").cast("string")

    def quoted(text):
        return F.concat(F.lit('"'), text, F.lit('"'))

    price = F.col("price").cast("string")
    symbol = F.when(
        is_fault["loose_symbol"], F.concat(F.lit(" "), F.lower("symbol"), F.lit("\\t"))
    ).otherwise(F.col("symbol"))
    fields = [
        ("e", F.when(is_fault["other_event"], F.lit('"trade"')).otherwise(F.lit('"aggTrade"'))),
        ("E", at),
        ("s", quoted(symbol)),
        ("a", F.col("trade_id").cast("string")),
        (
            "p",
            F.when(is_fault["negative_price"], F.lit('"-1"'))
            .when(is_fault["bare_price"], price)
            .otherwise(quoted(price)),
        ),
        (
            "q",
            F.when(is_fault["text_quantity"], F.lit('"abc"')).otherwise(
                quoted(F.col("quantity").cast("string"))
            ),
        ),
        ("T", at),
        ("m", F.when(F.col("trade_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false"))),
    ]
    inner = F.concat_ws(
        ",", *[F.concat(F.lit(f'"{name}":'), value) for name, value in fields]
    )
    stream = F.when(is_fault["no_stream"], F.lit("")).otherwise(
        F.concat(F.lit('"stream":"'), F.lower("symbol"), F.lit('@aggTrade",'))
    )
    text = F.concat(F.lit("{"), stream, F.lit('"data":{'), inner, F.lit("}}"))
    text = F.when(is_fault["cut"], F.substring(text, 1, 40)).otherwise(text)
    return rows.select(F.col("trade_id").alias("event_id"), text.alias("value"))


def topic_messages(trades: DataFrame) -> DataFrame:
    """``event_id`` and a topic value per trade."""
    rows = trades.withColumn("fault", _fault(TOPIC_FAULTS))
    is_fault = {name: F.col("fault") == name for _, name in TOPIC_FAULTS}
    stamp = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.when(is_fault["naive_time"], F.lit("")).otherwise(F.lit("+00:00"))
    body = F.to_json(
        F.struct(
            "symbol",
            F.when(is_fault["zero_price"], F.lit(0.0)).otherwise(F.col("price")).alias("price"),
            "quantity",
            F.concat(stamp, zone).alias("event_time"),
            F.when(~is_fault["no_id"], F.col("trade_id")).alias("trade_id"),
        )
    )
    text = F.when(is_fault["cut"], F.substring(body, 1, 25)).otherwise(body)
    return rows.select(F.col("trade_id").alias("event_id"), text.alias("value"))


def wire(spark, sf_dir: str) -> DataFrame:
    return wire_messages(tb.trades(spark, sf_dir))


def topic(spark, sf_dir: str) -> DataFrame:
    return topic_messages(tb.trades(spark, sf_dir))
