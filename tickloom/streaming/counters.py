"""Counters of running streams, kept as rows: one per batch, progress report or failure."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tickloom.operators.sink import SinkCounts

BATCHES = (
    "batch_id bigint, received bigint, replays bigint, late bigint, attempted bigint, "
    "inserted bigint, skipped bigint, error string"
)
PROGRESS = "query string, batch_id bigint, counter string, value bigint"


class Counters:
    """Counters of the sink: a folder per batch for what was stored, and one per failed try.

    A repeated batch replaces its row, so that totals do not count it twice; its failures stay.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.tries = 0

    def _put(self, folder: str, row: tuple) -> None:
        frame = self.spark.createDataFrame([row], BATCHES)
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def stored(
        self, batch_id: int, received: int, replays: int, late: int, counts: SinkCounts
    ) -> None:
        row = (batch_id, received, replays, late, counts.attempted, counts.inserted, counts.skipped, None)
        self._put(f"kind=batch-{batch_id}", row)

    def failed(self, batch_id: int, error: str) -> None:
        self.tries += 1
        name = f"kind=error-{self.spark.sparkContext.applicationId}-{id(self)}-{self.tries}"
        self._put(name, (batch_id, 0, 0, 0, 0, 0, 0, error))

    def watching(self, sink: Callable) -> Callable:
        """The sink, with a row for every time that it fails; the failure goes on."""

        def watched(closed) -> None:
            try:
                sink(closed)
            except Exception as error:
                self.failed(closed.batch_id, type(error).__name__)
                raise

        return watched

    def rows(self) -> DataFrame:
        return self.spark.read.schema(f"{BATCHES}, kind string").parquet(self.path).drop("kind")

    def totals(self) -> DataFrame:
        """Batches, errors and rows over all batches, in one row."""
        names = ("received", "replays", "late", "attempted", "inserted", "skipped")
        return self.rows().agg(
            F.count_if(F.col("error").isNull()).alias("batches"),
            F.count_if(F.col("error").isNotNull()).alias("errors"),
            *[F.sum(c).alias(c) for c in names],
        )


def observed(rows: DataFrame, name: str, **counters: Column) -> DataFrame:
    """The stream with counters that a ``ProgressLog`` picks up after every batch."""
    return rows.observe(name, *[c.cast("bigint").alias(n) for n, c in counters.items()])


def ingest_counters(decoded: DataFrame, name: str = "ingest") -> DataFrame:
    """Messages received and refused of a stream of decoded or parsed messages."""
    one = F.lit(1)
    return observed(
        decoded,
        name,
        received=F.count(one),
        published=F.count_if(F.col("status") == "ok"),
        refused=F.count_if(F.col("status") != "ok"),
    )


class ProgressLog(StreamingQueryListener):
    """Collects the observed counters of all streams of a session, and how they ended.

    A progress report has a few numbers; ``rows`` gives them as a table, ``save`` stores them.
    """

    def __init__(self) -> None:
        self.found: list[tuple] = []
        self._names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self._names[str(event.runId)] = event.name or ""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for metrics in progress.observedMetrics.values():
            for counter, value in metrics.asDict().items():
                self.found.append((progress.name or "", progress.batchId, counter, int(value)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        failed = int(event.exception is not None)
        self.found.append((self._names.get(str(event.runId), ""), -1, "failures", failed))

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.found, PROGRESS)

    def totals(self, spark: SparkSession) -> DataFrame:
        """Each counter of each stream over all its batches; a repeated batch counts once."""
        last = self.rows(spark).groupBy("query", "batch_id", "counter").agg(F.max("value").alias("value"))
        return last.groupBy("query", "counter").agg(F.sum("value").alias("value"))

    def save(self, spark: SparkSession, path: str) -> None:
        self.rows(spark).coalesce(1).write.mode("append").parquet(path)
