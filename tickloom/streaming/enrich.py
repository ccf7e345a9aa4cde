"""Rolling enrichment on a stream, by the batch operator over what the watermark has closed.

A micro-batch puts its trades to those that still wait. The watermark is the latest event time
seen, less the delay: what lies up to it is closed, is enriched in event order by the batch operator
and goes to the sink, so any number of tasks share the work on one symbol. Later trades wait.
Trades behind what earlier batches closed come out as late and change nothing.

Between two batches three things are kept in the folder of an epoch: the trades that wait, with
a look-back of closed ones before them; what each symbol takes over from all older trades
(``operators.carry``); and the moment up to which time is closed. The number of an epoch is that of
its micro-batch. A batch reads the latest epoch before its own and replaces its own, so a batch that
runs again after a failure finds what it found before and gives the same rows: together with a
sink that stores a batch once, every trade counts exactly once.

Copies of a trade are dropped before they count: the first by ``order``, such as the offset,
stays, whether the copies come in one batch or in several.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.enrich import CARRY, carry_after, rolling_state, slices_of
from tickloom.params import MICROS, Params
from tickloom.schemas import ENRICHED_TRADE, RAW_TRADE
from tickloom.session import kept

# Trades of this symbol only move the watermark forward and never come out.
HEARTBEAT = "__HEARTBEAT__"
TRADE_KEY = ("trade_id", "event_time")
KEPT_EPOCHS = 2
HELD = T.StructType(
    [*RAW_TRADE.fields, T.StructField("place", T.LongType()), T.StructField("new", T.BooleanType())]
)


@dataclass(frozen=True)
class Closed:
    """What a micro-batch has closed: enriched trades, late ones, their numbers, and the trades with
    their rolling state."""

    batch_id: int
    enriched: DataFrame
    late: DataFrame
    received: int
    copies: int
    late_rows: int
    state: DataFrame


class EpochStore:
    """Epochs of one stream below a shared folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def epochs(self) -> list[int]:
        """The complete epochs in order; the mark is written last."""
        where, files = self._files(f"{self.path}/epoch=*/mark/_SUCCESS")
        found = files.globStatus(where) or []
        return sorted(int(f.getPath().getParent().getParent().getName()[6:]) for f in found)

    def before(self, batch_id: int) -> tuple[DataFrame | None, DataFrame | None, dict]:
        """Waiting trades, carry and mark of the latest epoch before a batch."""
        older = [e for e in self.epochs() if e < batch_id]
        if not older:
            return None, None, {"closed": None, "seen": None}
        folder = f"{self.path}/epoch={older[-1]}"
        mark = json.loads(self.spark.read.text(f"{folder}/mark").first()[0])
        carry = self.spark.read.schema(CARRY).parquet(f"{folder}/carry")
        return self.spark.read.schema(HELD).parquet(f"{folder}/held"), carry, mark

    def save(self, batch_id: int, held: DataFrame, carry: DataFrame, mark: dict) -> None:
        folder = f"{self.path}/epoch={batch_id}"
        # A mark left by an earlier try must not vouch for the new content.
        where, files = self._files(f"{folder}/mark")
        files.delete(where, True)
        held.write.mode("overwrite").parquet(f"{folder}/held")
        carry.coalesce(1).write.mode("overwrite").parquet(f"{folder}/carry")
        text = self.spark.createDataFrame([(json.dumps(mark),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{folder}/mark")
        for old in self.epochs()[:-KEPT_EPOCHS]:
            where, files = self._files(f"{self.path}/epoch={old}")
            files.delete(where, True)


def _micros(ts: str) -> Column:
    return F.unix_micros(ts)


def close_batch(
    store: EpochStore,
    batch: DataFrame,
    batch_id: int,
    sink: Callable[[Closed], None],
    params: Params = Params(),
    delay_us: int = 10 * MICROS,
    order: Column | None = None,
) -> None:
    """Take in one micro-batch: enrich what it closes, hand it to ``sink``, keep the rest."""
    fields = RAW_TRADE.fieldNames()
    place = F.lit(0).cast("bigint") if order is None else order.cast("bigint")
    arrived = batch.select(*fields, place.alias("place"), F.lit(True).alias("new")).persist()
    held, carry, mark = store.before(batch_id)
    closed = mark["closed"]
    try:
        seen = arrived.agg(
            F.max(_micros("event_time")).alias("latest"),
            F.count_if(F.col("symbol") != HEARTBEAT).alias("received"),
            F.count_if((F.col("symbol") != HEARTBEAT) & _behind(closed)).alias("late"),
        ).first()
        latest = max((x for x in (seen["latest"], mark["seen"]) if x is not None), default=None)
        upto = None if latest is None else latest - delay_us + 1
        if closed is not None and (upto is None or upto < closed):
            upto = closed
        trades = arrived.where(F.col("symbol") != HEARTBEAT)
        on_time = trades.where(~_behind(closed))
        everything = on_time if held is None else held.unionByName(on_time)
        known, slices = kept(_first_copies(everything)), None
        try:
            n_new = known.where("new").count()
            waiting = known.select(*fields)
            done = waiting if upto is None else waiting.where(_micros("event_time") < upto)
            nothing = upto is None or upto == closed
            store_carry = carry
            # A few rows a symbol, which the sink and the carry take both.
            slices = kept(slices_of(done, params, carry, closed))
            state = rolling_state(done, params, carry, closed, slices)
            if nothing:
                state = state.where(F.lit(False))
            enriched = state.select(*ENRICHED_TRADE.fieldNames())
            late = trades.where(_behind(closed)).select(*fields)
            counts = (int(seen["received"]), int(seen["received"] - seen["late"] - n_new), int(seen["late"]))
            sink(Closed(batch_id, enriched, late, *counts, state))
            if not nothing:
                store_carry = carry_after(done, params, carry, closed, slices)
                keep = _micros("event_time") >= upto - params.lookback_us
            else:
                keep = F.lit(True)
            if store_carry is None:
                store_carry = batch.sparkSession.createDataFrame([], CARRY)
            rest = known.where(keep).withColumn("new", F.lit(False))
            store.save(batch_id, rest, store_carry, {"closed": upto, "seen": latest})
        finally:
            if slices is not None:
                slices.unpersist()
            known.unpersist()
    finally:
        arrived.unpersist()


def _behind(closed: int | None) -> Column:
    return F.lit(False) if closed is None else F.unix_micros("event_time") < closed


def _first_copies(rows: DataFrame) -> DataFrame:
    """One row per trade: one that is held already, else the first by place, then by values.

    Rows without any place to compare all stay.
    """
    own = F.when(F.col("new"), F.col("place")).otherwise(F.lit(-(1 << 62)))
    rest = [F.col(c) for c in rows.columns if c not in (*TRADE_KEY, "new", "place")]
    in_order = Window.partitionBy(*TRADE_KEY).orderBy(own.asc_nulls_last(), "new", "place", *rest)
    numbered = rows.select(
        "*", F.row_number().over(in_order).alias("_copy"), F.first(own).over(in_order).alias("_first")
    )
    return numbered.where("_copy = 1 OR _first IS NULL").select(*rows.columns)


def seconds_of(delay: str) -> int:
    """Microseconds of a delay such as ``10 seconds`` or ``2 hours``."""
    number, unit = delay.split()
    units = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}
    return round(float(number) * units[unit.rstrip("s")] * MICROS)


def enriched_batches(
    trades: DataFrame,
    state_path: str,
    checkpoint: str,
    sink: Callable[[Closed], None],
    params: Params = Params(),
    delay: str = "10 seconds",
    order: Column | None = None,
):
    """Writer that enriches a stream of trades and hands ``sink`` what each micro-batch closes.

    ``sink`` is called again with the same rows when a batch is repeated after a failure. ``order``
    may use columns of the stream that are no part of a trade. For a bounded replay append one row
    of the ``HEARTBEAT`` symbol far ahead in time, otherwise the last trades keep waiting.
    """

    def close(batch: DataFrame, batch_id: int) -> None:
        store = EpochStore(batch.sparkSession, state_path)
        close_batch(store, batch, batch_id, sink, params, seconds_of(delay), order)

    return (
        trades.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(close)
    )


def to_folders(path: str, late_path: str | None = None) -> Callable[[Closed], None]:
    """A sink that writes a folder per batch, replaced when the batch runs again."""

    def write(closed: Closed) -> None:
        closed.enriched.write.mode("overwrite").parquet(f"{path}/batch={closed.batch_id}")
        if late_path is not None and closed.late_rows:
            closed.late.write.mode("overwrite").parquet(f"{late_path}/batch={closed.batch_id}")

    return write
