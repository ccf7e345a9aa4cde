"""Row types that pass between the operators."""

from pyspark.sql import types as T

RAW_TRADE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("trade_id", T.LongType()),
    ]
)

WIRE = T.StructType([T.StructField("value", T.StringType())])

TOPIC = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

ENRICHED_TRADE = T.StructType(
    RAW_TRADE.fields
    + [
        T.StructField("usd_value", T.DoubleType()),
        T.StructField("classification", T.StringType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

# The stored table: the same row with its time column renamed, in fixed order.
TRADES_TABLE = T.StructType(
    [
        T.StructField("trade_id", T.LongType()),
        T.StructField("time", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("usd_value", T.DoubleType()),
        T.StructField("classification", T.StringType()),
        T.StructField("z_score", T.DoubleType()),
        T.StructField("is_anomaly", T.BooleanType()),
    ]
)

TABLE_COLUMNS = TRADES_TABLE.fieldNames()
TABLE_KEY = ("trade_id", "time")
CLASSES = ("Retail", "Pro", "Whale")
