"""Segments between data gaps, put out by the stream as the gap behind them closes.

What a micro-batch has closed is summed up to parts of segments, one row per symbol and segment. A part
is merged with the open segment of its symbol that earlier batches left. Once a later segment
of the symbol has begun, nothing can be added: the segment goes out, exactly once. The last
one of each symbol stays open and is kept under the number of the batch, so a batch that runs again
after a failure finds what it found before and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.enrich import segments_of
from tickloom.session import kept
from tickloom.streaming.enrich import KEPT_EPOCHS, Closed

SEGMENT = (
    "symbol string, segment bigint, started_at timestamp, ended_at timestamp, "
    "trade_count bigint, kind string, resumed_at timestamp"
)


def merged_segments(parts: DataFrame) -> DataFrame:
    """One row per symbol and segment from parts whose times do not overlap."""
    return parts.groupBy("symbol", "segment").agg(
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
        F.sum("trade_count").alias("trade_count"),
        F.min_by("kind", "started_at").alias("kind"),
        F.min("resumed_at").alias("resumed_at"),
    )


class OpenSegments:
    """The open segments of a stream, one row per symbol, in a folder per micro-batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def batches(self) -> list[int]:
        where, files = self._files(f"{self.path}/batch=*/_SUCCESS")
        found = files.globStatus(where) or []
        return sorted(int(f.getPath().getParent().getName()[6:]) for f in found)

    def before(self, batch_id: int | None = None) -> DataFrame | None:
        """What the latest batch before one (default: the latest of all) left open."""
        older = [b for b in self.batches() if batch_id is None or b < batch_id]
        if not older:
            return None
        return self.spark.read.schema(SEGMENT).parquet(f"{self.path}/batch={older[-1]}")

    def save(self, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        for old in self.batches()[:-KEPT_EPOCHS]:
            where, files = self._files(f"{self.path}/batch={old}")
            files.delete(where, True)


def segment_sink(path: str, open_path: str) -> Callable[[Closed], None]:
    """A sink of ``enriched_batches`` that writes the segments which a batch has ended.

    The folder of a batch carries its number. ``OpenSegments(spark, open_path).before()`` has those
    that still go on.
    """

    def write(closed: Closed) -> None:
        spark = closed.state.sparkSession
        store = OpenSegments(spark, open_path)
        parts, left = segments_of(closed.state), store.before(closed.batch_id)
        if left is not None:
            parts = parts.unionByName(left)
        # One row per symbol and segment that the batch has touched.
        segments = kept(merged_segments(parts))
        try:
            last = segments.groupBy("symbol").agg(F.max("segment").alias("last"))
            marked = segments.join(last, "symbol")
            columns = segments.columns
            marked.where("segment < last").select(*columns).write.mode("overwrite").parquet(
                f"{path}/batch={closed.batch_id}"
            )
            store.save(closed.batch_id, marked.where("segment = last").select(*columns))
        finally:
            segments.unpersist()

    return write
