"""What symbols take over from all earlier trades, kept from one run to the next.

The rolling state of a symbol depends on all its past through a few figures only: the time of
its last trade, its numbers of gaps, whether the pause after the last gap is over, and how
many trades that pause has seen. A store keeps these figures as of certain moments, one row per
symbol and moment. A run reads the latest moment and the trades from a look-back before it on; nothing
older is scanned. Each moment is a folder of its own, complete once its mark is there, and writing it
again replaces it.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.enrich import CARRY, carry_after
from tickloom.params import Params

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def moment(us: int) -> datetime:
    return EPOCH + timedelta(microseconds=us)


class CarryStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def moments(self) -> list[int]:
        """The moments that are stored, in order."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/upto=*/_SUCCESS")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = files.globStatus(where) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    def latest(self) -> tuple[DataFrame | None, int | None]:
        """The carry of the latest moment and the moment in epoch micros, if there is one."""
        stored = self.moments()
        if not stored:
            return None, None
        folder = f"{self.path}/upto={stored[-1]}"
        return self.spark.read.schema(CARRY).parquet(folder), stored[-1]

    def save(self, carry: DataFrame, upto: int) -> None:
        carry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/upto={upto}")


def tail(trades: DataFrame, since: int | None, params: Params) -> DataFrame:
    """The trades that a run needs which goes on at ``since``; the bound reaches the scan."""
    if since is None:
        return trades
    return trades.where(F.col("event_time") >= F.lit(moment(since - params.lookback_us)))


def advance(store: CarryStore, trades: DataFrame, upto: datetime, params: Params = Params()) -> None:
    """Store the carry as of ``upto``; only trades since the moment before are read.

    All trades before ``upto`` must be there. Symbols without new trades keep theirs.
    """
    if upto.tzinfo is None:
        upto = upto.replace(tzinfo=timezone.utc)
    end = (upto - EPOCH) // timedelta(microseconds=1)
    carry, since = store.latest()
    if since is not None and since >= end:
        return
    rows = tail(trades, since, params).where(F.col("event_time") < F.lit(upto))
    store.save(carry_after(rows, params, carry, since), end)
