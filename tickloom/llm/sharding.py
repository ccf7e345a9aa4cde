"""Sharding by histogram sort: shards are key ranges of nearly equal bytes.

The key of a document is 39 bits of a hash of its text and 23 bits of a hash of its id and text,
so equal texts are neighbours, and yet a text that fills a third of the table can be cut.

1. Keys and sizes are written once; all further passes read 16 bytes per document.
2. Each round draws candidate boundaries from the keys that still lie around an unsettled
   splitter, counts the exact bytes and rows below each candidate over all partitions, and narrows
   the brackets, until every splitter meets the tolerance or its bracket has no key left. The
   driver holds the candidates and their counts: 64 per shard, and one per 200,000 documents.
3. Documents are exchanged once, by key range. Ranges far smaller than a shard are numbered by
   themselves, and the exact row counts say where each begins, so that slots have no gaps.

A splitter falls between groups of equal texts where one does within the tolerance; only a group
too large for that is cut.

Defined results for odd input: a NULL text counts as empty (1 byte); a NULL id hashes like any
value; documents that agree in id and text stay together; an empty table gives an empty result;
input columns named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.columns import carried, restored
from tickloom.llm.scratch import written

ID_BITS = 23
ADDED = ("size", "shard", "slot")


@dataclass(frozen=True)
class Shards:
    count: int = 16
    tolerance: float = 0.005  # of the mean shard
    group_tolerance: float = 0.02  # up to which equal texts are kept together
    probes: int = 64  # candidates per splitter and round
    range_rows: int = 200_000  # documents that are numbered together
    rounds: int = 40


def document_key():
    by_text = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), 25)
    by_id = F.shiftrightunsigned(F.xxhash64(F.lit(1), "doc_id", "text"), 64 - ID_BITS)
    return F.shiftleft(by_text, ID_BITS).bitwiseOR(by_id)


def byte_size():
    """UTF-8 bytes of the text, and one for the separator."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint")


def _histogram(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows of the documents whose key is below each probe."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(probes, b.column(0).to_numpy(), side="right")
            np.add.at(size, at, b.column(1).to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        at = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(size[at]), pa.array(rows[at])], ["at", "size", "n"]
        )

    found = (
        keys.select("_key", "size")
        .mapInArrow(count, "at bigint, size bigint, n bigint")
        .groupBy("at")
        .agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
        .collect()  # one row per candidate
    )
    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for r in found:
        size[r["at"]], rows[r["at"]] = r["size"], r["n"]
    return size.cumsum()[:-1], rows.cumsum()[:-1]


def _draw(keys: DataFrame, spans: list[tuple[int, int, float]], salt: int) -> np.ndarray:
    """Keys drawn at random from each span (from, before, rate), and the group starts."""
    hit = F.lit(False)
    for low, high, rate in spans:
        inside = (F.col("_key") >= low) & (F.col("_key") < high)
        drawn = F.pmod(F.xxhash64("_key", F.lit(salt)), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1
        hit = hit | (inside & drawn if rate < 1 else inside)
    drawn = np.array([r[0] for r in keys.where(hit).select("_key").distinct().collect()], np.int64)
    return np.unique(np.concatenate([drawn, drawn >> ID_BITS << ID_BITS]))


def find_splitters(keys: DataFrame, spec: Shards) -> tuple[list[int], np.ndarray]:
    """The first key of every shard but the first, and boundaries of small ranges."""
    total = keys.agg(F.sum("size").alias("size"), F.count("*").alias("n")).first()
    if not total["n"]:
        return [], np.zeros(0, np.int64)
    mean = total["size"] / spec.count
    goals = [mean * i for i in range(1, spec.count)]
    end = 1 << 62  # above every key
    # Of every probe so far: key, bytes below, rows below.
    known = np.array([[0, 0, 0], [end, total["size"], total["n"]]], np.int64)
    fine = max(spec.probes * spec.count, total["n"] // spec.range_rows)
    spans = [(0, end, min(1.0, fine / total["n"]))]
    ranges = None
    for turn in range(spec.rounds):
        probes = _draw(keys, spans, turn)
        if len(probes):
            size, rows = _histogram(keys, probes)
            known = np.unique(
                np.concatenate([known, np.stack([probes, size, rows], axis=1)]), axis=0
            )
        ranges = probes if ranges is None else ranges
        whole = [(low, high) for low, high, rate in spans if rate >= 1]
        spans = []
        for goal in goals:
            if np.abs(known[:, 1] - goal).min() <= spec.tolerance * mean:
                continue
            at = int(np.searchsorted(known[:, 1], goal, side="right"))
            low, high = known[at - 1], known[at]
            if any(a <= low[0] and high[0] <= b for a, b in whole):
                continue  # all keys there have been probed
            span = int(low[0]), int(high[0]), min(1.0, spec.probes / max(1, high[2] - low[2]))
            if span not in spans:
                spans.append(span)
        if not spans:
            break
    splitters = []
    starts = known[(known[:, 0] & ((1 << ID_BITS) - 1)) == 0]
    for goal in goals:
        off = np.abs(known[:, 1] - goal)
        group_off = np.abs(starts[:, 1] - goal)
        keep = group_off.min() <= max(off.min(), spec.group_tolerance * mean)
        splitters.append(int((starts if keep else known)[(group_off if keep else off).argmin(), 0]))
    return splitters, np.unique(np.concatenate([ranges, np.array(splitters, np.int64)]))


def shard_documents(docs: DataFrame, spec: Shards = Shards()) -> DataFrame:
    """The documents with ``size``, ``shard`` and their gapless ``slot`` within the shard."""
    spark = docs.sparkSession
    keys = written(docs.select(document_key().alias("_key"), byte_size().alias("size")), "keys")
    splitters, ranges = find_splitters(keys, spec)
    _, below = _histogram(keys, ranges) if len(ranges) else (None, np.zeros(0, np.int64))
    starts = np.concatenate([[0], below])  # rows before range i
    firsts = np.concatenate([[0], ranges])  # first key of range i
    shard_of = np.searchsorted(np.array(splitters, np.int64), firsts, side="right")
    shard_start = {int(s): int(starts[shard_of == s].min()) for s in np.unique(shard_of)}
    info = spark.createDataFrame(
        [
            (i, int(s), int(n) - shard_start[int(s)])
            for i, (s, n) in enumerate(zip(shard_of, starts))
        ],
        "_r int, shard int, _offset bigint",
    )

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ranges, key.to_numpy(), side="right").astype(np.int32))

    placed = docs.select(
        *carried(docs), "doc_id", byte_size().alias("size"), document_key().alias("_key")
    )
    placed = placed.select("*", range_of("_key").alias("_range"))
    nth = F.expr("row_number() OVER (PARTITION BY _range ORDER BY _key, doc_id, size) - 1")
    # One row per range; Spark broadcasts it if it is below the session's limit.
    return (
        placed.select("*", nth.alias("_nth"))
        .join(info, F.col("_range") == F.col("_r"))
        .select(
            *restored(docs, ADDED), "size", "shard", (F.col("_offset") + F.col("_nth")).alias("slot")
        )
    )


def write_shards(docs: DataFrame, path: str, spec: Shards = Shards()) -> None:
    """Write the documents, one folder per shard, in the order of their slots."""
    rows = shard_documents(docs, spec)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
