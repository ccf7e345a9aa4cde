"""Rows as JSON records and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def rows_to_json(rows: DataFrame) -> DataFrame:
    """Every row as one JSON text; times in ISO form, decimals as plain numbers."""
    columns = [
        F.col(f.name).cast("double").alias(f.name)
        if f.dataType.typeName() == "decimal"
        else F.col(f.name)
        for f in rows.schema.fields
    ]
    options = {"timestampFormat": JSON_TIME, "ignoreNullFields": "false"}
    return rows.select(F.to_json(F.struct(*columns), options).alias("json"))


MOST_PUSHED = 10_000  # rows of one message


def push_envelope(feed: DataFrame, kind: str, most: int = MOST_PUSHED) -> DataFrame:
    """One message with all rows of a feed, newest first; none for an empty feed.

    The rows are gathered into one value. A feed of more than ``most`` rows is refused with an
    error, and no more than one row beyond that is ever gathered.
    """
    entry = F.struct(
        (-F.unix_micros("time")).alias("recency"),
        (-F.col("trade_id")).alias("tie"),
        F.struct(*feed.columns).alias("row"),
    )
    gathered = feed.limit(most + 1).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    too_many = F.raise_error(F.lit(f"more than {most} rows for one message"))
    rows = F.when(F.size("rows") > most, too_many).otherwise(F.col("rows"))
    gathered = gathered.where(F.size("rows") > 0).select(rows.alias("rows"))
    body = F.struct(F.lit(kind).alias("type"), F.col("rows.row").alias("data"))
    options = {"timestampFormat": JSON_TIME, "ignoreNullFields": "false"}
    return gathered.select(F.to_json(body, options).alias("message"))
