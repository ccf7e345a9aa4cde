"""Streaming queries built from the batch operators."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.enrich import table_row
from tickloom.operators.candles import PartVersions, candle_parts
from tickloom.operators.feeds import push_anomalies, push_trades
from tickloom.operators.output import push_envelope
from tickloom.operators.sink import append_new, new_rows_of_table
from tickloom.params import Params
from tickloom.schemas import TABLE_KEY
from tickloom.streaming.counters import Counters
from tickloom.streaming.enrich import Closed, enriched_batches


def once(writer, name: str | None = None) -> StreamingQuery:
    """Run a prepared writer over everything that is there, then stop."""
    if name:
        writer = writer.queryName(name)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def flush_trigger(params: Params) -> dict:
    return {"processingTime": f"{params.batch_flush_interval_ms} milliseconds"}


def table_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    key=TABLE_KEY,
    on_counts: Callable | None = None,
    order: Column | None = None,
):
    """Writer that appends the new table rows of every micro-batch.

    The source position of a batch is committed after the batch is stored; a batch
    that is run again finds its rows stored and adds none. ``order`` says which of several
    copies of a trade in one batch came first, such as the offset of the source.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        counts = append_new(batch.sparkSession, batch, path, key, order)
        if on_counts:
            on_counts(batch_id, counts)

    return (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )


def enriched_sink(
    trades: DataFrame,
    path: str,
    late_path: str,
    state_path: str,
    checkpoint: str,
    params: Params = Params(),
    delay: str = "10 seconds",
    order: Column | None = None,
    counters: Counters | None = None,
):
    """Writer of the main job: closed trades, enriched, to the table; late ones to a folder.

    Copies are dropped before they count in a window, and again against the table: a late
    trade that is stored already is a replay and goes nowhere. It starts a batch at most every
    ``batch_flush_interval_ms``; another trigger may be set on the writer. The folder of late rows
    carries the batch number and is replaced when the batch runs again. ``counters`` keep
    one row per batch; a batch that fails counts as an error and is tried again by the stream.
    """

    def store(closed: Closed) -> None:
        spark = closed.enriched.sparkSession
        late_rows = closed.late_rows
        if late_rows:
            late = new_rows_of_table(spark, closed.late, path).persist()
            try:
                late_rows = late.count()
                late.write.mode("overwrite").parquet(f"{late_path}/batch={closed.batch_id}")
            finally:
                late.unpersist()
        counts = append_new(spark, table_row(closed.enriched), path)
        if counters is not None:
            replays = closed.copies + closed.late_rows - late_rows
            counters.stored(closed.batch_id, closed.received, replays, late_rows, counts)

    sink = store if counters is None else counters.watching(store)
    writer = enriched_batches(trades, state_path, checkpoint, sink, params, delay, order)
    return writer.trigger(**flush_trigger(params))


def refused_sink(decoded: DataFrame, path: str, checkpoint: str, params: Params = Params()):
    """Writer of the messages of a topic that could not be decoded."""
    refused = decoded.where("status <> 'ok'").select("status", "raw")
    return (
        refused.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**flush_trigger(params))
    )


def split_sink(parsed: DataFrame, good_path: str, bad_path: str, checkpoint: str):
    """Writer that sends good rows one way and refused rows to a quarantine.

    The folder of a batch carries its number and is replaced when it runs again.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good = batch.where("status = 'ok'").drop("raw", "status")
            good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            bad = batch.where("status <> 'ok'").select("status", "raw")
            bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return parsed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)


def distinct_trades(trades: DataFrame, delay: str = "10 seconds", key=("trade_id", "event_time")):
    """Drop trades already seen within the watermark delay."""
    return trades.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(list(key))


def candle_sink(
    table_rows: DataFrame, path: str, checkpoint: str, params: Params = Params(),
):
    """Writer that keeps candles up to date from a stream of table rows that come once each.

    A micro-batch is summed up to parts of candles, which have a merge law (``merged_parts``). The
    parts of the days that it touches are merged with those stored and written anew, under the
    number of the batch; whatever the number of batches, a day holds one part per candle.
    ``PartVersions.candles`` reads them.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        fresh = candle_parts(batch, params).persist()
        try:
            # One row per day that the batch touches.
            days = [r["day"] for r in fresh.select("day").distinct().collect()]
            if days:
                PartVersions(batch.sparkSession, path).merge(fresh, days, batch_id)
        finally:
            fresh.unpersist()

    return (
        table_rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )


def push_sink(
    table: Callable[[], DataFrame],
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    as_of: Callable[[], datetime] | None = None,
    trade_seconds: float = 2,
    anomaly_seconds: float = 5,
):
    """Writer that emits the current push messages once per micro-batch of ``ticks``.

    The feeds are cut to their newest rows before they are put into a message.
    """

    def emit(batch: DataFrame, batch_id: int) -> None:
        now = as_of() if as_of else None
        rows = table()
        messages = push_envelope(push_trades(rows, now, trade_seconds), "trades").unionByName(
            push_envelope(push_anomalies(rows, now, anomaly_seconds), "anomalies")
        )
        messages.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(emit)
