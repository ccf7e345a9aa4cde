"""N-gram Jaccard join: T-occurrence search with DivideSkip, and the components of its links.

Two documents are linked if 100 * |A & B| >= 75 * |A | B| for their sets of distinct 5-word
shingles. Equal sets are one node. Whatever a node x of n shingles is linked to must hold
T = ceil(0.75 n) of its shingles. That bound is used three times:

1. Counting. Half of all shingles, the same half everywhere, are counted over the corpus in
   buckets of hashes that are shipped as packed arrays. A node that has too few shingles that
   anybody else has can have no partner, and leaves. So do, by exact counts over all shingles of
   those that stayed, most documents that merely share a passage.
   A pair of n and m shingles needs an overlap of 3 (n + m) / 7, which must not exceed what
   either of them shares with anybody.
2. Merging. Of x's lists (shingle -> nodes that have it) the L longest are set aside, with
   L = T - OCCURRENCES, as long lists are many times as long as short ones and probing a partner
   is cheap; so a partner occurs OCCURRENCES times in the short lists. Within a list
   all members are first compared with one of them: the most typical one, then others, drawn anew
   each round while rounds find links. Verified links join nodes to components, so a family of
   any size needs comparisons in proportion to its size. What is left are pairs in different
   components: the short lists of x, in the smaller component, restricted to the other
   components, are merged by a heap of their heads, which counts occurrences. For each pair the
   lists are cut again by the overlap that its two sizes need.
3. Probing. For those that occur often enough, x's shingles, those of its long lists first, are
   looked up in the partner's sorted shingles by binary search, which gives the overlap.

No pair within a component is ever formed, and no link between different sets is lost: every pair
of nodes in different components that passes the bounds is verified.

Defined results for odd input: a NULL text, or one without words, has the empty set, which is
linked with nothing; a text of fewer than five words has its whole sequence as its one shingle;
equal rows are linked; rows with a NULL doc_id take part, and are the last to name a component
(NULL if all its ids are); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import text as tx
from tickloom.llm.columns import carried, restored
from tickloom.llm.components import components
from tickloom.llm.scratch import drop, written

LINKED = 75  # of 100
OCCURRENCES = 1  # in short lists, of a partner; L follows from it
BLOCK_TOKENS = 1_000_000  # shingles that one task packs together
BUCKET_BYTES = 16 << 20  # text per bucket of hashes
ROUNDS = 6  # at most, of comparison with one member of each list

_PACKED = "bucket int, block bigint, tokens binary, owners binary"
_SETS = "doc_id bigint, text_hash bigint, set_id bigint, n int, active boolean"


def _least_overlap(n):
    return F.ceil(n * LINKED / 100).cast("int")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``set_id``, ``shingles`` (sorted hashes) of every row."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.array_sort(tx.shingle_hashes(F.col("text"))).alias("shingles"),
    )
    return rows.select("doc_id", "text_hash", F.xxhash64("shingles").alias("set_id"), "shingles")


# ---- 1. Counting over the whole corpus ------------------------------------------------------


def _pack(buckets: int):
    """Blocks of documents as sorted shingle hashes per bucket, with the document of each."""

    def block_rows(block: int, rows: list) -> Iterator[dict]:
        doc_id, text_hash, set_id, n, tokens = zip(*rows)
        first = {}
        owner_of = np.array([first.setdefault(s, i) for i, s in enumerate(set_id)], np.int32)
        # Copies of a set within the block count once.
        mine = sorted(first.values())
        values = np.concatenate([tokens[i] for i in mine]).astype(np.uint64)
        owners = np.repeat(
            np.array(mine, np.uint16), np.array([len(tokens[i]) for i in mine], np.int64)
        )
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        # The upper bits of 63 give the bucket, the lower 32 tell hashes in a bucket apart. Two
        # that are taken for one only let a document stay that could have gone.
        bucket = ((values >> np.uint64(31)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in range(buckets):
            lo, hi = cuts[b], cuts[b + 1]
            if hi > lo:
                yield {
                    "bucket": b,
                    "block": block,
                    "tokens": low[lo:hi].tobytes(),
                    "owners": owners[lo:hi].tobytes(),
                }
        known = np.array([d is not None for d in doc_id])
        meta = [
            np.array([d or 0 for d in doc_id], np.int64),
            known.astype(np.int64),
            np.array(text_hash, np.int64),
            np.array(set_id, np.int64),
            np.array(n, np.int64),
            np.array([len(t) for t in tokens], np.int64),
            owner_of.astype(np.int64),
        ]
        yield {
            "bucket": block % buckets,
            "block": block,
            "tokens": None,
            "owners": np.stack(meta).tobytes(),
        }

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        schema = pa.schema(
            [("bucket", pa.int32()), ("block", pa.int64())]
            + [("tokens", pa.binary()), ("owners", pa.binary())]
        )
        rows, held = [], 0
        for batch in batches:
            lists = batch.column(4)
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            head = zip(*(batch.column(i).to_pylist() for i in range(4)))
            for i, (doc_id, text_hash, set_id, n) in enumerate(head):
                part = flat[ends[i] : ends[i + 1]].copy()
                rows.append((doc_id, text_hash, set_id, n, part))
                held += len(part)
                if held >= BLOCK_TOKENS or len(rows) >= 60_000:
                    yield pa.RecordBatch.from_pylist(list(block_rows(block, rows)), schema)
                    rows, held, block = [], 0, block + 1
        if rows:
            yield pa.RecordBatch.from_pylist(list(block_rows(block, rows)), schema)

    return pack


def _count_bucket(table: pa.Table) -> pa.Table:
    """Which documents of each block own a hash that another set in the bucket has too."""
    meta = [r for r in table.to_pylist() if r["tokens"] is None]
    packed = [r for r in table.to_pylist() if r["tokens"] is not None]
    rows = [{"block": r["block"], "shared": None, "meta": r["owners"]} for r in meta]
    if packed:
        tokens = [np.frombuffer(r["tokens"], np.uint32) for r in packed]
        sizes = np.array([len(t) for t in tokens])
        values = np.concatenate(tokens)
        order = np.argsort(values, kind="stable")
        values = values[order]
        same = values[1:] == values[:-1]
        twice = np.zeros(len(values), bool)
        twice[1:] |= same
        twice[:-1] |= same
        hit = np.zeros(len(values), bool)
        hit[order[twice]] = True
        for r, part in zip(packed, np.split(hit, sizes.cumsum()[:-1])):
            owners = np.frombuffer(r["owners"], np.uint16)[part]
            if len(owners):
                rows.append({"block": r["block"], "shared": owners.tobytes(), "meta": None})
    return pa.Table.from_pylist(
        rows,
        pa.schema([("block", pa.int64()), ("shared", pa.binary()), ("meta", pa.binary())]),
    )


def _judge_block(table: pa.Table) -> pa.Table:
    """The documents of a block, and whether enough of their shingles are shared."""
    rows = table.to_pylist()
    meta = next(r["meta"] for r in rows if r["meta"] is not None)
    doc_id, known, text_hash, set_id, n, sampled, owner = np.frombuffer(meta, np.int64).reshape(
        7, -1
    )
    shared = np.zeros(len(doc_id), np.int64)
    for r in rows:
        if r["shared"] is not None:
            owners = np.frombuffer(r["shared"], np.uint16)
            shared += np.bincount(owners, minlength=len(shared))
    missing = n - -(-n * LINKED // 100)  # shingles a partner may lack
    active = (n > 0) & (shared[owner] >= sampled - missing)
    return pa.table(
        {
            "doc_id": pa.array(doc_id, mask=known == 0),
            "text_hash": text_hash,
            "set_id": set_id,
            "n": n.astype(np.int32),
            "active": active,
        }
    )


def _sets(docs: DataFrame) -> DataFrame:
    """Every row's set, and whether the set may have a partner."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    # The hashes that are not negative: the same half of all shingles everywhere.
    halves = shingle_sets(docs).select(
        "doc_id",
        "text_hash",
        "set_id",
        F.size("shingles").alias("n"),
        F.filter("shingles", lambda h: h >= 0).alias("half"),
    )
    counted = (
        halves.mapInArrow(_pack(buckets), _PACKED)
        .groupBy("bucket")
        .applyInArrow(_count_bucket, "block bigint, shared binary, meta binary")
    )
    return written(counted.groupBy("block").applyInArrow(_judge_block, _SETS), "sets")


# ---- 2. and 3. Merging and probing ----------------------------------------------------------


def _nodes(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``set_id``, ``shingles`` of each set that may have a partner, once."""
    one = (
        sets.where("active")
        .groupBy(F.col("set_id").alias("_set"))
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("_row"))
        .select(F.col("_row.doc_id").alias("_doc"), F.col("_row.text_hash").alias("_text"))
        .distinct()
    )
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_doc")) & (
        F.xxhash64("text") == F.col("_text")
    )
    rows = docs.select("doc_id", "text").join(one, same, "left_semi")
    return shingle_sets(rows).select("set_id", "shingles").dropDuplicates(["set_id"])


def _lists(nodes: DataFrame) -> DataFrame:
    """Per node the shingles that others have too, rarest first, where they can suffice.

    Columns ``x``, ``n``, ``least`` (T), ``rest`` (shingles in its L longest lists), ``short``
    (shingles of the other lists).
    """
    single = nodes.select(F.explode("shingles").alias("token"), "set_id")
    often = single.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        single.join(often, "token")
        .groupBy("set_id")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("ts"))  # of one text
    )
    least = _least_overlap(F.size("shingles"))
    rows = (
        nodes.join(ordered, "set_id")
        .select(F.col("set_id").alias("x"), F.size("shingles").alias("n"), "ts", "shingles")
        .withColumn("least", _least_overlap(F.col("n")))
        .where(F.size("ts") >= F.col("least"))
    )
    rows = rows.withColumn("aside", F.greatest(F.col("least") - OCCURRENCES, F.lit(0)))
    tokens = F.transform("ts", lambda t: t["token"])
    kept = F.size("ts") - F.col("aside")
    return rows.select(
        "x",
        "n",
        "least",
        F.size("ts").alias("a"),
        F.slice(tokens, F.lit(1), kept).alias("short"),
        F.slice(tokens, kept + 1, F.col("aside")).alias("rest"),
        "shingles",
    )


def _verified(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (x, y) whose whole sets are linked."""
    side = lambda k: lists.select(F.col("x").alias(k), F.col("shingles").alias(f"s{k}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    shared = F.size(F.array_intersect("sx", "sy"))
    union = F.size("sx") + F.size("sy") - shared
    return both.where(shared * 100 >= union * LINKED).select("x", "y")


def _pair_least():
    """The overlap that sets of n and m shingles need."""
    return F.ceil((F.col("n") + F.col("m")) * LINKED / (100 + LINKED)).cast("int")


def _possible():
    """Whether sets of n and m shingles, of which others have a and a2, can be linked."""
    small, large = F.least("n", "m"), F.greatest("n", "m")
    return (small * 100 >= large * LINKED) & (_pair_least() <= F.least("a", "a2"))


def _merge(table: pa.Table) -> pa.Table:
    """Of one x: the partners that occur often enough in its short lists.

    The lists come sorted; a heap of their heads yields the members in order.
    """
    x = table.column("x")[0].as_py()
    lists = []
    for part in table.column("members"):
        fields = part.values
        lists.append(list(zip(fields.field("y").to_pylist(), fields.field("need").to_pylist())))
    out, now, count = [], None, 0
    for member in heapq.merge(*lists):
        count = count + 1 if member == now else 1
        now = member
        if count == member[1]:
            out.append(member[0])
    return pa.table({"x": pa.array([x] * len(out), pa.int64()), "y": pa.array(out, pa.int64())})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Look the shingles of x up in each partner's by binary search; keep the linked pairs."""
    for batch in batches:
        x, y, n, mine, theirs = (batch.column(i) for i in range(5))
        keep = []
        for i in range(batch.num_rows):
            own, other = mine[i].values.to_numpy(), theirs[i].values.to_numpy()
            at = np.minimum(np.searchsorted(other, own), len(other) - 1)
            shared = int((other[at] == own).sum())
            if shared * 100 >= (n[i].as_py() + len(other) - shared) * LINKED:
                keep.append(i)
        linked = [c.take(pa.array(keep, pa.int64())) for c in (x, y)]
        yield pa.RecordBatch.from_arrays(linked, ["x", "y"])


def links(lists: DataFrame) -> DataFrame:
    """Links that join every node to its component: pairs (a, b) of sets; not all pairs."""
    short = written(
        lists.select("x", "n", "a", F.posexplode("short").alias("place", "token")), "short"
    )
    edges: DataFrame | None = None
    labels: DataFrame | None = None

    def labelled(rows: DataFrame, key: str, name: str) -> DataFrame:
        if labels is None:
            return rows.withColumn(name, F.col(key))
        found = labels.select(F.col("node").alias(key), F.col("label").alias(name))
        return rows.join(found, key, "left").withColumn(name, F.coalesce(name, key))

    for turn in range(ROUNDS):
        # First the member with the fewest shingles that nobody else has.
        rank = F.xxhash64("x", F.lit(turn)) if turn else (F.col("n") - F.col("a")).cast("bigint")
        head = F.struct(
            rank.alias("r"), F.col("x").alias("y"), F.col("n").alias("m"), F.col("a").alias("a2")
        )
        heads = short.groupBy("token").agg(F.min(head).alias("h"))
        stars = short.join(heads.select("token", "h.y", "h.m", "h.a2"), "token")
        stars = stars.where((F.col("x") != F.col("y")) & _possible())
        # Of the members it met, x is compared with the one it met most often.
        pairs = (
            stars.groupBy("x", "y")
            .agg(F.count("*").alias("k"))
            .groupBy("x")
            .agg(F.max_by("y", "k").alias("y"))
        )
        pairs = labelled(labelled(pairs, "x", "lx"), "y", "ly").where("lx <> ly").select("x", "y")
        new = _verified(pairs, lists).select(F.col("x").alias("a"), F.col("y").alias("b"))
        new = written(new, "links")
        if edges is not None and new.isEmpty():
            break
        edges = new if edges is None else edges.union(new)
        labels = components(edges)

    # Pairs in different components. Behind the first OCCURRENCES common shingles, in the order by
    # frequency, both must have room for the rest of the overlap that the pair needs.
    sizes = labelled(lists.select("x"), "x", "label").groupBy("label").agg(F.count("*").alias("of"))
    members = written(labelled(short, "x", "label").join(sizes, "label"), "members")
    per_list = members.select("token", "label", "of").distinct()
    ends = per_list.groupBy("token").agg(
        F.max(F.struct("of", "label")).alias("top"), F.count("*").alias("k")
    )
    mixed = ends.where("k > 1").select("token", "top")
    members = members.join(mixed, "token")
    # The largest component in a list asks nothing: the others ask about it.
    asked = members.where(F.struct("of", "label") < F.col("top")).drop("top")
    other = members.select(
        "token",
        F.col("x").alias("y"),
        F.col("n").alias("m"),
        F.col("of").alias("of2"),
        F.col("label").alias("label2"),
        F.col("a").alias("a2"),
        F.col("place").alias("place2"),
    )
    met = asked.join(other, "token").where(
        _possible()
        & (F.struct("of", "label") < F.struct("of2", "label2"))
        & (F.col("place") <= F.col("a") - _pair_least() + OCCURRENCES - 1)
        & (F.col("place2") <= F.col("a2") - _pair_least() + OCCURRENCES - 1)
    )
    member = F.struct(F.col("y"), F.least(_pair_least(), F.lit(OCCURRENCES)).alias("need"))
    merged = (
        met.groupBy("x", "token")
        .agg(F.sort_array(F.collect_list(member)).alias("members"))
        .groupBy("x")
        .applyInArrow(_merge, "x bigint, y bigint")
    )
    probed = (
        merged.join(lists.select("x", "n", F.concat("rest", "short").alias("mine")), "x")
        .join(lists.select(F.col("x").alias("y"), F.col("shingles").alias("theirs")), "y")
        .select("x", "y", "n", "mine", "theirs")
        .mapInArrow(_probe, "x bigint, y bigint")
    )
    return written(edges.union(probed.select(F.col("x").alias("a"), F.col("y").alias("b"))), "links")


def _labelled_sets(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, ``text_hash``, ``n`` and the ``label`` of its component."""
    sets = _sets(docs)
    nodes = written(_nodes(docs, sets), "nodes")
    lists = written(_lists(nodes), "lists")
    drop(nodes)
    labels = components(links(lists))
    drop(lists)
    labels = labels.select(F.col("node").alias("set_id"), "label")
    rows = sets.join(labels, "set_id", "left")
    return rows.select("doc_id", "text_hash", "n", F.coalesce("label", "set_id").alias("label"))


def classes(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, ``n_shingles`` and ``component_id``."""
    rows = _labelled_sets(docs)
    # One row per component; the empty set is none.
    names = rows.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("name"))
    return rows.join(names, "label", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, with the columns it came with.

    The row with the smallest id stays, of several with that id one. Documents without words are
    linked with nothing, so all of them stay.
    """
    rows = written(_labelled_sets(docs), "labelled")
    first = F.min(F.struct(F.isnull("doc_id").alias("late"), "doc_id", "text_hash")).alias("r")
    kept = rows.where("n > 0").groupBy("label").agg(first).select("r.doc_id", "r.text_hash")
    kept = written(kept.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text")), "kept")
    texts = docs.select(*carried(docs), "doc_id", "text", F.xxhash64("text").alias("_t"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_t") == F.col("_text"))
    worded = F.coalesce(F.col("text").rlike(tx.WORD), F.lit(False))
    stay = texts.where(~worded).union(texts.where(worded).join(kept, same, "left_semi"))
    # Rows that agree in id and text are in one component; of these, too, one stays.
    again = (
        rows.where("n > 0")
        .groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_text"))
        .agg(F.count("*").alias("k"))
        .where("k > 1")
        .select("_doc", "_text")
    )
    again = written(again, "repeated")
    if not again.isEmpty():
        repeated = stay.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
        stay = stay.join(again, same, "left_anti").union(repeated)
    return stay.select(*restored(docs))
