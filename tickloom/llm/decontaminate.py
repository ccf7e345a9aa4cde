"""Benchmark decontamination: which documents contain a benchmark item.

An item is contained in a document if at least 75 of 100 of its distinct word shingles occur
there, in any place. Items are short and documents may be long, so similarity of whole sets says
nothing; containment is searched from the items' side:

1. Items are partitioned by size (powers of two of their shingle count). A size class fixes how
   many of an item's smallest hashes form its MinHash sketch: one more than the shingles that
   may be missing. A document that contains the item has at least one hash of the sketch, so no
   document is lost, and a document need only be probed for classes it is large enough for.
2. The hashes of every document's shingles probe the sketches. The sketches grow with the
   benchmark only; they are broadcast if their counted rows are few enough, else both sides are
   shuffled by hash.
3. Each (document, item) pair found is verified on the shingles themselves.

Defined results for odd input: texts are lower-cased (A-Z); a NULL text, or one without words,
contains nothing and is contained nowhere; an item of fewer than five words is one shingle, its
whole word sequence, and matches only a document that is just that; every pair of rows counts
for itself, whether or not ids repeat or are NULL; empty tables give no pairs; other columns
are carried by ``keep_clean`` and otherwise not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import text as tx
from tickloom.llm.columns import carried, restored
from tickloom.llm.scratch import written

CONTAINED = 75  # of 100 shingles
BROADCAST_ROWS = 2_000_000  # of 24 bytes


def _required(n):
    return F.ceil(n * CONTAINED / 100).cast("int")


def item_sketches(items: DataFrame) -> DataFrame:
    """The smallest shingle hashes of each item, with its size class.

    Columns ``hash``, ``item_id``, ``_i`` (hash of the item's text), ``size_class``, ``fewest``
    (the smallest number of shingles of a document that may contain an item of the class).
    """
    sized = items.select(
        "item_id",
        F.xxhash64("text").alias("_i"),
        F.array_sort(tx.shingle_hashes(F.col("text"))).alias("h"),
    ).where(F.size("h") > 0)
    size_class = F.floor(F.log2(F.size("h"))).cast("int")
    # The largest size of the class sets the length; a longer sketch loses nothing.
    largest = F.pow(F.lit(2), F.col("size_class") + 1).cast("int") - 1
    smallest = F.pow(F.lit(2), F.col("size_class")).cast("int")
    return (
        sized.withColumn("size_class", size_class)
        .withColumn("length", largest - _required(largest) + 1)
        .select(
            F.explode(F.slice("h", F.lit(1), F.least(F.col("length"), F.size("h")))).alias("hash"),
            "item_id",
            "_i",
            "size_class",
            _required(smallest).alias("fewest"),
        )
    )


def candidates(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs that share a hash of the item's sketch; distinct."""
    sketches = written(item_sketches(items), "sketches")
    if sketches.count() <= BROADCAST_ROWS:
        sketches = F.broadcast(sketches)
    probes = docs.select(
        "doc_id", F.xxhash64("text").alias("_t"), tx.shingle_hashes(F.col("text")).alias("h")
    ).select("doc_id", "_t", F.size("h").alias("n"), F.explode("h").alias("hash"))
    return (
        probes.join(sketches, "hash")
        .where(F.col("n") >= F.col("fewest"))
        .select("doc_id", "_t", "item_id", "_i")
        .distinct()
    )


def _pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = written(candidates(docs, items), "pairs").select(
        F.col("doc_id").alias("_doc"), F.col("_t").alias("_text"), "item_id", "_i"
    )
    wanted = items.select(
        F.col("item_id").alias("_item"),
        F.xxhash64("text").alias("_item_text"),
        tx.shingle_texts(F.col("text")).alias("_wanted"),
    )
    there = docs.select("doc_id", "text", F.xxhash64("text").alias("_t"))
    both = found.join(
        wanted, F.col("item_id").eqNullSafe(F.col("_item")) & (F.col("_i") == F.col("_item_text"))
    ).join(there, F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_text") == F.col("_t")))
    shared = F.size(F.array_intersect("_wanted", tx.shingle_texts(F.col("text"))))
    return both.select(
        "doc_id",
        "_t",
        "item_id",
        F.size("_wanted").cast("bigint").alias("n_item_shingles"),
        shared.cast("bigint").alias("n_shared"),
    ).where(F.col("n_shared") * 100 >= F.col("n_item_shingles") * CONTAINED)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it contains: ``doc_id``, ``item_id``, ``n_item_shingles``,
    ``n_shared``."""
    return _pairs(docs, items).select("doc_id", "item_id", "n_item_shingles", "n_shared")


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with the columns they came with."""
    bad = _pairs(docs, items).select(F.col("doc_id").alias("_doc"), F.col("_t").alias("_text"))
    bad = written(bad.distinct(), "contaminated")
    rows = docs.select(*carried(docs), "doc_id", F.xxhash64("text").alias("_t"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_t") == F.col("_text"))
    return rows.join(bad, same, "left_anti").select(*restored(docs))
