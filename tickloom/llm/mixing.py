"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Sizes are summed per source; targets are the weighted shares, cut at a multiple of the
   source's size, the excess shared again by weight.
2. The documents of a source form a stream in the order of a seeded hash, cut into blocks of
   about equal size. The few documents of more than 1/64 of their source are blocks of their own,
   so that no single one decides how near a source comes to its target.
3. The number of block draws of each source (more than one pass over the blocks where the target
   is above the size) is split among the output shards: a node of a binary tree holds the exact
   draws of all sources and deals them to its two halves by the multivariate hypergeometric law.
4. Every shard takes its own range of each source's draws, so draws are disjoint, and is shuffled
   by a hash of its own.

The driver holds one row per source, and the sizes of its large documents, fewer than 64. Everything per document stays in Spark; a source's stream is
summed in buckets of its hash range, so a source with most of the rows is spread like any other.

Defined results for odd input: a NULL source is one source, the last; a NULL or empty text has
size 0 and may be drawn without counting; equal rows are drawn one by one; an empty table gives
an empty result; input columns named like an added one are replaced. Equal (doc_id, text) rows
in great number share one hash bucket; distinct ids never do.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm import text as tx
from tickloom.llm.columns import carried, restored
from tickloom.llm.scratch import written

LARGE = 64  # a document above 1 / LARGE of its source is a block of its own


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)  # repeated over the sources in order
    share: float = 1.5  # of all sizes
    most: int = 2  # times a source's size, and passes over a document
    shards: int = 16
    blocks: int = 1024  # a source has this many at least, if it has as many words
    block_words: int = 1 << 20  # largest size of a block
    bucket_rows: int = 50_000  # documents of a source that are put in order together
    seed: int = 7


ADDED = ("size", "source_size", "target", "draws")


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """The target of each source, in order: weighted shares, none above its limit."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    limit = [float(mix.most * s) for s in sizes]
    out = [0.0] * len(sizes)
    open_, rest = set(range(len(sizes))), mix.share * sum(sizes)
    while open_:
        unit = rest / sum(weights[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if weights[i] * unit >= limit[i]]
        for i in over or sorted(open_):
            out[i] = limit[i] if over else weights[i] * unit
        if not over:
            break
        rest -= sum(limit[i] for i in over)
        open_ -= set(over)
    return out


def split_draws(draws: list[int], shards: int, seed: int) -> np.ndarray:
    """Draws per shard and source; columns add up to ``draws``, rows are as equal as can be."""
    rng = np.random.Generator(np.random.PCG64(seed))
    out = np.zeros((shards, len(draws)), dtype=np.int64)
    if not draws:
        return out
    total = sum(draws)
    room = np.full(shards, total // shards, dtype=np.int64)
    room[: total % shards] += 1

    def hypergeometric(here: np.ndarray, take: int) -> np.ndarray:
        # One source after the other; numpy's limits on population sizes call for the
        # normal law where counts are huge, which still keeps every total exact.
        taken, left = np.zeros_like(here), int(here.sum())
        for i, n in enumerate(map(int, here)):
            rest = left - n
            low, high = max(0, take - rest), min(n, take)
            if low < high:
                if left < 10**9:
                    k = int(rng.hypergeometric(n, rest, take))
                else:
                    p = take / left
                    spread = math.sqrt(n * p * (1 - p) * (rest / max(1, left - 1)))
                    k = round(rng.normal(n * p, spread))
                taken[i] = min(max(k, low), high)
            else:
                taken[i] = low
            take -= int(taken[i])
            left = rest
        return taken

    def node(lo: int, hi: int, here: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = here
            return
        mid = (lo + hi) // 2
        left = hypergeometric(here, int(room[lo:mid].sum()))
        node(lo, mid, left)
        node(mid, hi, here - left)

    node(0, shards, np.array(draws, dtype=np.int64))
    return out


def large_copies(sizes: list[int], ratio: float, most: int) -> list[int]:
    """Copies of a source's large documents, whose sizes come in hash order.

    All are taken as often as the ratio's whole part says; one more copy goes to those that,
    in turn, still fit into what the ratio asks for.
    """
    whole = min(int(ratio), most)
    left = (ratio - whole) * sum(sizes)
    copies = []
    for size in sizes:
        more = whole < most and size <= left
        left -= size * more
        copies.append(whole + more)
    return copies


def _sized(docs: DataFrame, mix: Mix) -> DataFrame:
    return docs.select(
        *carried(docs),
        F.col("source").cast("string").alias("source"),
        tx.word_count(F.col("text")).alias("size"),
        F.xxhash64(F.lit(mix.seed), F.col("doc_id"), F.col("text")).alias("_h"),
    )


_PLAN = T.StructType(
    [
        T.StructField("_source", T.StringType()),
        T.StructField("source_size", T.LongType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_n_blocks", T.LongType()),
        T.StructField("_ends", T.ArrayType(T.LongType())),  # draws up to and with each shard
        T.StructField("_large_draws", T.ArrayType(T.LongType())),  # up to and with each document
        T.StructField("_large_ends", T.ArrayType(T.LongType())),
    ]
)


def plan_mix(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Every document with ``size``, ``source_size``, ``target`` and ``draws``: the shards that
    take it, once for each time it is taken."""
    spark = docs.sparkSession
    narrow = written(
        _sized(docs, mix).select(F.col("source").alias("_source"), "size", "_h"),
        "sizes",
    )
    totals = narrow.groupBy(F.col("_source").alias("s")).agg(
        F.sum("size").alias("n"), F.count("*").alias("rows")
    )
    per_source = totals.withColumnRenamed("s", "_source").collect()  # one row per source
    order = sorted(per_source, key=lambda r: (r["_source"] is None, r["_source"] or ""))
    aims = targets([r["n"] for r in order], mix)
    most_rows = max([1, *(r["rows"] for r in order)])
    bits = max(6, math.ceil(math.log2(max(1, most_rows / mix.bucket_rows))))

    placed = _placed(narrow, totals, bits)
    large_sizes: dict[str | None, list[int]] = {}
    for r in placed.where("_large").select("_source", "_nth", "size").collect():
        large_sizes.setdefault(r["_source"], []).append((r["_nth"], r["size"]))

    plan, quotas, large_quotas = [], [], []
    for r, aim in zip(order, aims):
        n = r["n"]
        sizes = [s for _, s in sorted(large_sizes.get(r["_source"], []))]
        copies = large_copies(sizes, aim / n if n else 0.0, mix.most)
        small = n - sum(sizes)
        block = max(1, min(mix.block_words, small // mix.blocks))
        n_blocks = -(-small // block)
        # The small documents make up what the large ones leave of the target.
        want = aim - sum(c * s for c, s in zip(copies, sizes))
        want = min(max(0.0, want), float(mix.most * small))
        passes = int(want // small) if small else 0
        quotas.append(passes * n_blocks + round((want - passes * small) / block))
        large_quotas.append(sum(copies))
        ends = [int(x) for x in np.cumsum(copies)]
        plan.append([r["_source"], n, aim, block, n_blocks, None, ends, None])
    deal = split_draws(quotas + large_quotas, mix.shards, mix.seed).cumsum(axis=0)
    for i, p in enumerate(plan):
        p[5] = [int(x) for x in deal[:, i]]
        p[7] = [int(x) for x in deal[:, len(plan) + i]]
    info = spark.createDataFrame([tuple(p) for p in plan], _PLAN)

    # One row per source and bucket of its hash range.
    before = placed.groupBy("_source", "_bucket").agg(
        F.sum(F.when(~F.col("_large"), F.col("size")).otherwise(0)).alias("in_bucket")
    )
    before = before.selectExpr(
        "_source AS s",
        "_bucket AS b",
        "coalesce(sum(in_bucket) OVER (PARTITION BY _source ORDER BY _bucket ROWS BETWEEN "
        "UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _offset",
    )
    # One row per source, or one row per 50,000 documents of a source: small beside the
    # documents at any size. Spark broadcasts them if they are below its limit.
    rows = _sized(docs, mix).join(
        F.broadcast(info), F.col("source").eqNullSafe(F.col("_source"))
    )
    rows = _nth(_bucketed(rows, F.col("source_size"), bits))
    rows = rows.join(
        before, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_bucket") == F.col("b"))
    )
    start = F.col("_offset") + F.col("_before") + F.floor(F.col("size") / 2)
    block = F.least(F.floor(start / F.col("_block")), F.col("_n_blocks") - 1)
    shard_of = lambda ends, draw: F.size(F.filter(ends, lambda e: e <= draw))
    total = F.element_at("_ends", -1)
    small_draws = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.lit(mix.most)),
            lambda k: (F.col("_n_blocks") > 0) & (k * F.col("_n_blocks") + block < total),
        ),
        lambda k: shard_of(F.col("_ends"), k * F.col("_n_blocks") + block),
    )
    nth = F.col("_nth").cast("int")
    first = F.coalesce(F.get("_large_draws", nth - 1), F.lit(0))
    last = F.get("_large_draws", nth)
    large_draws = F.when(
        last > first,
        F.transform(F.sequence(first, last - 1), lambda j: shard_of(F.col("_large_ends"), j)),
    ).otherwise(F.array().cast("array<int>"))
    return rows.select(
        *restored(docs, ADDED),
        "size",
        "source_size",
        "target",
        F.when(F.col("_large"), large_draws).otherwise(small_draws).alias("draws"),
    )


def _bucketed(rows: DataFrame, source_size, bits: int) -> DataFrame:
    large = F.col("size") * LARGE > source_size
    bucket = F.shiftrightunsigned(F.col("_h"), 64 - bits)
    return rows.select(
        "*", large.alias("_large"), F.when(large, F.lit(-1)).otherwise(bucket).alias("_bucket")
    )


def _nth(rows: DataFrame) -> DataFrame:
    by = "PARTITION BY _source, _bucket ORDER BY _h, size"
    return rows.selectExpr(
        "*",
        f"CAST(row_number() OVER ({by}) - 1 AS BIGINT) AS _nth",
        f"coalesce(sum(size) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
        " AS _before",
    )


def _placed(narrow: DataFrame, totals: DataFrame, bits: int) -> DataFrame:
    rows = narrow.join(totals, F.col("_source").eqNullSafe(F.col("s"))).select(
        "_source", "size", "_h", "n"
    )
    return _nth(_bucketed(rows, F.col("n"), bits))


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix: documents, repeated as often as they are drawn, with ``shard`` and the
    ``shuffle_key`` by which a shard is to be ordered."""
    rows = docs.select(*carried(docs), "doc_id", "text", "source")
    taken = plan_mix(rows, mix).select("*", F.posexplode("draws").alias("copy", "shard"))
    key = F.xxhash64(F.lit(mix.seed + 1), "doc_id", "text", "copy")
    added = ("copy", "shard", "shuffle_key")
    return taken.select(*restored(docs, added), "copy", "shard", key.alias("shuffle_key"))


def write_mix(docs: DataFrame, path: str, mix: Mix = Mix()) -> None:
    """Write the mix, a folder per shard, each in the order of its own shuffle."""
    rows = mix_sources(docs, mix)
    (
        rows.repartitionByRange("shard", "shuffle_key")
        .sortWithinPartitions("shard", "shuffle_key")
        .drop("shuffle_key")
        .write.partitionBy("shard")
        .parquet(path)
    )
