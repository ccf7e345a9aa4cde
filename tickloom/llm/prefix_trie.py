"""The trie of conversation beginnings, from adaptive radix trees over turn ids.

A turn is told apart by its id: the first 16 bytes of the SHA-256 of role and text. The key of a
conversation is the ids of its turns, one after the other; texts stay where they are read. The keys
are put in order by one exchange into ranges of (key, conversation), sized by their bytes, so that
many equal keys fill several ranges. A task builds the radix tree of one range. Only depths that
are multiples of 16 bytes are nodes of the trie: a compressed path passes any number of them.

A node whose keys all lie in one range is complete there. The others are those on the path of the
last key of a range that the first key of the next one shares. Their figures are sums that ranges
can add up: a node that an earlier range has too is not counted again as a child or with its text,
and one without children counts as a leaf only in the last range that has it. These few rows are
added up by path, and the children of such nodes get the parent's number by a join on range and
depth. The conversations that end in such a node come as one list of numbers per range, in order,
and are hashed range after range by a task that holds one list at a time.

Defined results for odd input: rows without conv_id are in no conversation; turns of equal
number are taken in order of their ids; NULL role or text counts as empty; a conversation that
is left without turns is a member of the root only; an empty table has no nodes, not even a
root; other input columns are not read. The turn ids of one conversation (16 bytes each) must fit
into the memory of a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.columns import picked
from tickloom.llm.radix_tree import Node, RadixTree
from tickloom.llm.scratch import written

WIDTH = 16  # bytes of a turn id
RANGE_BYTES = 4 << 20  # keys and lengths in one tree
BASE_EVERY, MOST_SHARED = 100, 6


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes that stand for a role and a text."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    spelled = F.concat(F.octet_length(role), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(spelled, 256)), 1, WIDTH)


def conversation_keys(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, an array of (turn, id, size) in order."""
    rows = picked(turns, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    one = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        turn_id(F.col("role"), F.col("text")).alias("id"),
        F.coalesce(F.char_length("text"), F.lit(0)).alias("size"),
    )
    # NULL comes first in ascending arrays of structs.
    return rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(one)).alias("turns")
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with its first h turns taken from the first one of its hundred."""
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % BASE_EVERY
    own = conversations.select("conv_id", "turns", h.alias("h"), base.alias("base"))
    heads = conversations.where(F.col("conv_id") % BASE_EVERY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, MOST_SHARED - 1).alias("head")
    )
    # A base has at most 2 * BASE_EVERY - 1 conversations, whatever the table holds.
    return own.join(heads, "base", "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(turns, 1, 0)")),
            F.expr("slice(turns, h + 1, size(turns))"),
        ).alias("turns"),
    )


def _keys(conversations: DataFrame) -> DataFrame:
    hexed = F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")
    return conversations.select(
        F.unhex(hexed).alias("key"),
        F.transform("turns", lambda t: t["size"]).alias("sizes"),
        "conv_id",
    )


def prefix_nodes(turns: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The trie of the rebuilt conversations; see ``trie`` for its columns."""
    conversations = written(conversation_keys(turns), "conversations")
    return trie(rebuilt(conversations), range_bytes)


def trie(conversations: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per distinct beginning of ``turns``: ``turn_id`` (its last turn; NULL for the root),
    ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    spark = conversations.sparkSession
    keys = written(_keys(conversations), "keys")
    total = keys.agg(F.sum(F.length("key") + 4 * F.size("sizes") + 8)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))
    placed = written(
        keys.repartitionByRange(parts, "key", "conv_id").withColumn("part", F.spark_partition_id()),
        "ranges",
    )
    edges = placed.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    # One row per range.
    edges = written(
        edges.selectExpr(
            "part AS at",
            "lag(last) OVER (ORDER BY part) AS before",
            "lead(first) OVER (ORDER BY part) AS after",
        ),
        "edges",
    )
    found = written(
        placed.groupBy("part")
        .cogroup(edges.groupBy("at"))
        .applyInArrow(lambda rows, edge: _range_nodes(rows, edge), _NODES),
        "nodes",
    )
    whole = found.where("path IS NULL")
    merged = written(_merged(found.where("path IS NOT NULL")), "shared-nodes")
    # Where a shared node is in each range, to tell its number to its children there.
    places = found.where("path IS NOT NULL").select("part", "depth", "side", "path")
    known = written(
        places.join(merged.select("path", "conv_id"), "path").select(
            F.col("part"), F.col("depth").alias("up"), F.col("side").alias("up_side"),
            F.col("conv_id").alias("parent"),
        ),
        "shared-places",
    )
    columns = ["turn_id", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children"]
    columns += ["n_leaves", "saved_tokens", "ends_sha256"]
    inner = whole.where("up IS NULL").select(*columns)
    upper = (
        whole.where("up IS NOT NULL")
        .join(known, ["part", "up", "up_side"])
        .withColumn("parent_conv_id", F.col("parent"))
        .select(*columns)
    )
    top = merged.join(
        known.select("part", "up", "up_side", "parent"), ["part", "up", "up_side"], "left"
    ).withColumn("parent_conv_id", F.col("parent"))
    return inner.unionByName(upper).unionByName(top.select(*columns))


_NODES = (
    "part int, turn_id binary, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, path binary, side int, up bigint, up_side int, ends string"
)


def _turns_shared(a: bytes | None, b: bytes) -> int:
    """Turns that two keys have in common at their beginning; -1 without a key."""
    if a is None:
        return -1
    turns = 0
    while (turns + 1) * WIDTH <= min(len(a), len(b)) and (
        a[turns * WIDTH : (turns + 1) * WIDTH] == b[turns * WIDTH : (turns + 1) * WIDTH]
    ):
        turns += 1
    return turns


def _range_nodes(rows: pa.Table, edge: pa.Table) -> pa.Table:
    """The nodes of one range, complete or, with ``path``, as summands."""
    part = rows.column("part")[0].as_py()
    tree, sizes = RadixTree(), {}
    first = last = None
    for batch in rows.select(["key", "sizes", "conv_id"]).to_batches(max_chunksize=4096):
        for key, lengths, conv in zip(*(c.to_pylist() for c in batch.columns)):
            tree.add(key, conv)
            for i, size in enumerate(lengths):
                sizes[key[i * WIDTH : (i + 1) * WIDTH]] = size
            first = key if first is None or key < first else first
            last = key if last is None or key > last else last
    before, after = edge.column("before")[0].as_py(), edge.column("after")[0].as_py()
    nodes = _Nodes(tree, sizes, first, last, _turns_shared(before, first), _turns_shared(after, last))
    return nodes.table(part)


class _Nodes:
    """Figures of all nodes of a tree, worked out from its leaves upwards."""

    def __init__(self, tree, sizes, first, last, shared_first, shared_last) -> None:
        self.sizes, self.first, self.last = sizes, first, last
        self.shared_first, self.shared_last = shared_first, shared_last
        self.rows: list[dict] = []
        self._walk(tree)

    def _walk(self, tree: RadixTree) -> None:
        """After its children, each tree node: without recursion, as paths can be long."""
        # A task: node, depth in bytes above its prefix, whether its path so far is that of the
        # first and the last key, and the bytes since the last whole turn.
        todo = [(tree.root, 0, True, True, b"", False)]
        done: list[tuple] = []  # results of finished children, the latest ones last
        while todo:
            node, start, on_first, on_last, rest, ready = todo.pop()
            end = start + len(node.prefix)
            if not ready:
                on_first = on_first and self.first[start:end] == node.prefix
                on_last = on_last and self.last[start:end] == node.prefix
                todo.append((node, start, on_first, on_last, rest, True))
                tail = (rest + node.prefix)[-(end % WIDTH) :] if end % WIDTH else b""
                for child in tree.children(node):
                    todo.append((child, end, on_first, on_last, tail, False))
                continue
            count = len(tree.children(node))
            below = [done.pop() for _ in range(count)]
            done.append(self._emit(node, start, end, on_first, on_last, rest, below))

    def _emit(self, node: Node, start, end, on_first, on_last, rest, below) -> tuple:
        """Rows for the turn-aligned depths on a node's prefix, the deepest first.

        Returns what the nodes above need: members, smallest, text of members, text and number
        of nodes that are new here, leaves, and the rows that still wait for their parent.
        """
        ends = sorted(node.values)
        members = len(ends) + sum(b[0] for b in below)
        smallest = min([*ends[:1], *(b[1] for b in below)])
        read = sum(b[2] for b in below)
        own = sum(b[3] for b in below)
        fresh = sum(b[4] for b in below)
        leaves = sum(b[5] for b in below)
        waiting = [row for b in below for row in b[6]]
        lowest = end - end % WIDTH
        # The tree's root, without a prefix, is depth 0; others begin behind the node above.
        highest = start - start % WIDTH + WIDTH if node.prefix else 0
        spelled = rest + node.prefix
        offset = start - len(rest)
        for depth_bytes in range(lowest, highest - 1, -WIDTH):
            depth = depth_bytes // WIDTH
            from_first = on_first and depth <= self.shared_first
            from_last = on_last and depth <= self.shared_last
            here = ends if depth_bytes == end else []
            turn = None
            if depth:
                turn = spelled[depth_bytes - WIDTH - offset : depth_bytes - offset]
                read += members * self.sizes[turn]
                if not from_first:
                    own += self.sizes[turn]
            if not waiting and not from_last:
                leaves += 1
            row = {
                "turn_id": turn,
                "conv_id": smallest,
                "depth": depth,
                "parent_conv_id": None,
                "n_convs": members,
                "n_children": fresh,
                "n_leaves": leaves,
                "saved_tokens": read - own,
                "ends_sha256": None,
                "path": None,
                "side": None,
                "up": None,
                "up_side": None,
                "ends": None,
            }
            text = ",".join(map(str, here))
            shared = from_first or from_last
            side = 0 if from_first else 1
            if shared:
                row["path"], row["side"], row["ends"] = self.first[:depth_bytes], side, text
                if not from_first:
                    row["path"] = self.last[:depth_bytes]
            else:
                row["ends_sha256"] = hashlib.sha256(text.encode()).hexdigest()
            for other in waiting:
                if shared:
                    other["up"], other["up_side"] = depth, side
                else:
                    other["parent_conv_id"] = smallest
            self.rows.append(row)
            waiting, fresh = [row], 0 if from_first else 1
        return members, smallest, read, own, fresh, leaves, waiting

    def table(self, part: int) -> pa.Table:
        kinds = {"turn_id": pa.binary(), "path": pa.binary(), "side": pa.int32(), "up_side": pa.int32()}
        kinds |= {"ends_sha256": pa.string(), "ends": pa.string()}
        names = list(self.rows[0])
        columns = {"part": pa.array([part] * len(self.rows), pa.int32())}
        for name in names:
            columns[name] = pa.array([r[name] for r in self.rows], kinds.get(name, pa.int64()))
        return pa.table(columns)


def _merged(shared: DataFrame) -> DataFrame:
    """Nodes that several ranges have, from the summands of each."""
    sums = shared.groupBy("path").agg(
        F.first("turn_id").alias("turn_id"),
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        # The parent is on the same path: any range tells where it is.
        F.min(F.struct("part", "up", "up_side")).alias("place"),
    )
    lists = shared.select("path", "part", "ends").repartition("path")
    hashes = lists.sortWithinPartitions("path", "part").mapInArrow(
        _hashed, "hashed_path binary, ends_sha256 string"
    )
    return sums.join(hashes, F.col("path") == F.col("hashed_path")).select(
        "path", "turn_id", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256", "place.part", "place.up", "place.up_side",
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the comma-joined lists of each path, which come in order."""
    path, state, any_yet = None, hashlib.sha256(), False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([path], pa.binary()), pa.array([state.hexdigest()], pa.string())],
            ["hashed_path", "ends_sha256"],
        )

    for batch in batches:
        for i in range(batch.num_rows):
            key, ends = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
            if key != path:
                if path is not None:
                    yield row()
                path, state, any_yet = key, hashlib.sha256(), False
            if ends:
                state.update((("," if any_yet else "") + ends).encode())
                any_yet = True
    if path is not None:
        yield row()
