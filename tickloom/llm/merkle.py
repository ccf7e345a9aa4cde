"""A Merkle manifest of a table of documents, with versions of its tree after changes of leaves.

Each row is a leaf. The leaves of a language ascend by doc_id (NULL first, ties by their digest);
while there are several nodes, two consecutive ones become their parent, and the last one alone
where their number is odd. What remains is the subroot of the language. The subroots in order of
language (NULL first) likewise give the root. A digest is the lower-case hexadecimal SHA-256 of its
inputs, one after the other.

Texts are read once, for the leaves; everything after works on digests. Leaves get their positions
by a range exchange and lie in aligned blocks of 2^``BLOCK_BITS``; a task works on one block, the
roots of the blocks form the blocks of the next level, and so on up to the root, then back down with
the siblings of what lies above each block. No task holds more than a block, however many
leaves a language has, and a level has a 1/4096 of the rows of the one below.

A tree never changes (``Block``). A changed leaf makes a version that shares all nodes but the
ancestors of that leaf, which are copied: those within its block there, and the ones above along
the siblings that come down, so versions of one tree are spread over all blocks.

Defined results for odd input: a NULL in any column of a leaf counts as ``-``; a NULL doc_id is never
tampered with and comes first; repeated rows are leaves of their own, side by side; a table of
one row is its own root, with no siblings; an empty table gives no rows; other input columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.columns import picked
from tickloom.llm.ranks import ranked
from tickloom.llm.scratch import written

BLOCK_BITS = 12
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_LEFT, _RIGHT, _ALONE = b"L", b"R", b"-"
_STEP = 33  # bytes of a step: the side of the sibling and its digest


def _sized(value: Column) -> Column:
    """A value with its length in front, so that no two lists of values look alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row as 32 bytes."""
    parts = [_sized(c) for c in (doc_id, source, lang, n_chars, text)]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tampering(doc_id: Column) -> Column:
    """The agreed choice of rows to tamper with."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def _parent(left: bytes, right: bytes | None = None) -> bytes:
    text = left.hex() if right is None else left.hex() + right.hex()
    return hashlib.sha256(text.encode()).digest()


class Block:
    """The tree over some consecutive nodes, up to ``height`` levels above them."""

    def __init__(self, nodes: list[bytes], height: int) -> None:
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append(
                [_parent(*below[i : i + 2]) for i in range(0, len(below), 2)]
            )

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def path(self, i: int) -> bytes:
        """The steps from a node to the root: the side and the digest of each sibling."""
        steps = []
        for level in self.levels[:-1]:
            other = i ^ 1
            if other >= len(level):
                steps.append(_ALONE + bytes(32))
            else:
                steps.append((_LEFT if other < i else _RIGHT) + level[other])
            i >>= 1
        return b"".join(steps)


def siblings(path: bytes) -> list[bytes]:
    """The digests of all siblings on a path, from below."""
    steps = (path[i : i + _STEP] for i in range(0, len(path), _STEP))
    return [s[1:] for s in steps if s[:1] != _ALONE]


def copied(node: bytes, path: bytes) -> list[bytes]:
    """The ancestors that a version with this node has of its own, up to the root.

    All other nodes of the version are those of the tree that the path was taken from.
    """
    out = []
    for i in range(0, len(path), _STEP):
        side, sibling = path[i : i + 1], path[i + 1 : i + _STEP]
        if side == _LEFT:
            node = _parent(sibling, node)
        elif side == _RIGHT:
            node = _parent(node, sibling)
        else:
            node = _parent(node)
        out.append(node)
    return out


def _height(n: int, bits: int) -> int:
    """Levels of a block of a tree with ``n`` nodes: up to the root, or to the next blocks."""
    return min((n - 1).bit_length(), bits)


def _fold(nodes: DataFrame, bits: int) -> DataFrame:
    """The roots of all blocks of a level, as the nodes of the next."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        n = table.column("n")[0].as_py()
        block = Block(table.column("digest").to_pylist(), _height(n, bits))
        return pa.table(
            {
                "tree": table.column("tree").slice(0, 1),
                "pos": pa.array([table.column("pos")[0].as_py() >> bits], pa.int64()),
                "n": pa.array([(n + (1 << bits) - 1) >> bits], pa.int64()),
                "digest": pa.array([block.root], pa.binary()),
            }
        )

    grouped = nodes.groupBy("tree", F.shiftright("pos", bits))
    return grouped.applyInArrow(work, "tree binary, pos bigint, n bigint, digest binary")


def _paths(nodes: DataFrame, above: DataFrame | None, bits: int) -> DataFrame:
    """Per node of a level the path to the root of its tree; ``above`` has that of its block."""

    def work(table: pa.Table, upper: pa.Table | None = None) -> pa.Table:
        table = table.sort_by("pos")
        block = Block(
            table.column("digest").to_pylist(), _height(table.column("n")[0].as_py(), bits)
        )
        rest = upper.column("path")[0].as_py() if upper is not None else b""
        return pa.table(
            {
                "tree": table.column("tree"),
                "pos": table.column("pos"),
                "digest": table.column("digest"),
                "path": pa.array(
                    [block.path(i) + rest for i in range(table.num_rows)], pa.binary()
                ),
            }
        )

    kind = "tree binary, pos bigint, digest binary, path binary"
    grouped = nodes.groupBy("tree", F.shiftright("pos", bits))
    if above is None:
        return grouped.applyInArrow(lambda table: work(table), kind)
    upper = above.select("tree", "pos", "path")
    return grouped.cogroup(upper.groupBy("tree", "pos")).applyInArrow(
        lambda table, upper: work(table, upper), kind
    )


def _levels(nodes: DataFrame, bits: int, label: str) -> list[DataFrame]:
    """All levels of blocks of some trees, written; the last has one node per tree."""
    levels = [nodes]
    while (levels[-1].agg(F.max("n")).first()[0] or 0) > 1:
        levels.append(written(_fold(levels[-1], bits), label))
    return levels


def _leaves(docs: DataFrame) -> DataFrame:
    """Digests of the rows, and of the rows as tampered with."""
    rows = picked(docs, *LEAF_COLUMNS)
    as_given = [F.col(c) for c in LEAF_COLUMNS]
    changed = list(as_given)
    changed[3] = F.col("n_chars").cast("decimal(38,0)") + 1
    return rows.select(
        "doc_id",
        F.col("lang").cast("string").alias("lang"),
        F.col("lang").cast("string").cast("binary").alias("tree"),
        leaf_digest(*as_given).alias("digest"),
        F.when(tampering(F.col("doc_id")), leaf_digest(*changed)).alias("changed"),
    )


def manifest(docs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Per row: ``doc_id``, ``lang``, ``position`` in its language, ``leaf``, ``subroot``, ``root``,
    ``proof`` (digests of the siblings from the leaf to the root), ``tampered``,
    ``version`` (the ancestors that the version with the tampered leaf has copied; none where the
    leaf is untouched), ``folded_root`` (the root of that version, or worked out from the leaf
    as it is) and ``verified`` (whether that is ``root``)."""
    leaves = written(
        ranked(written(_leaves(docs), "leaves"), ["tree"], ["doc_id", "digest"], "leaves-sorted"),
        "leaves-placed",
    )
    levels = _levels(leaves.select("tree", "pos", "n", "digest"), bits, "merkle")
    # The subroots, one per language, are the leaves of the tree above.
    languages = ranked(
        levels[-1].select(F.lit(0).alias("all"), F.col("tree").alias("lang_tree"), "digest"),
        ["all"],
        ["lang_tree"],
        "subroots",
    )
    languages = written(
        languages.select(F.lit(b"").alias("tree"), "pos", "n", "digest", "lang_tree"), "subroots"
    )
    upper = _levels(languages.select("tree", "pos", "n", "digest"), bits, "merkle")
    paths = None
    for level in reversed(upper):
        paths = written(_paths(level, paths, bits), "paths")
    # Down into the languages: the path of a subroot goes on from each subroot.
    to_root = languages.select(
        F.col("lang_tree").alias("tree"), F.col("pos").alias("at"), F.col("digest").alias("subroot")
    ).join(paths.select(F.col("pos").alias("at"), F.col("path").alias("up")), "at")
    to_root = written(to_root.select("tree", "subroot", "up"), "subroot-paths")
    below = None
    for level in reversed(levels[1:]):
        below = written(_paths(level, below, bits), "paths")
    return _versions(leaves, below, to_root, bits)


_OUT = (
    "doc_id bigint, lang string, position bigint, leaf string, subroot string, root string, "
    "proof array<string>, tampered boolean, version array<string>, folded_root string"
)


def _versions(leaves: DataFrame, below: DataFrame | None, to_root: DataFrame, bits: int) -> DataFrame:
    """The manifest from the leaves, the paths of their blocks and those of their subroots."""
    blocks = leaves.groupBy("tree", F.shiftright("pos", bits).alias("block")).agg(
        F.lit(1).alias("one")
    )
    # One row per block: what lies above it.
    above = blocks.select("tree", "block")
    if below is None:
        above = above.withColumn("path", F.lit(b""))
    else:
        here = below.select(F.col("tree").alias("t"), F.col("pos").alias("p"), "path")
        above = above.join(
            here, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("p"))
        ).select("tree", "block", "path")
    ends = to_root.select(F.col("tree").alias("t"), "subroot", "up")
    above = written(
        above.join(ends, F.col("tree").eqNullSafe(F.col("t"))).select(
            "tree", "block", "path", "subroot", "up"
        ),
        "above",
    )

    def work(table: pa.Table, upper: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        digests = table.column("digest").to_pylist()
        block = Block(digests, _height(table.column("n")[0].as_py(), bits))
        middle, subroot, up = (upper.column(c)[0].as_py() for c in ("path", "subroot", "up"))
        root = (copied(subroot, up) or [subroot])[-1].hex()
        proofs, versions, folded = [], [], []
        changed = table.column("changed").to_pylist()
        for i, (digest, other) in enumerate(zip(digests, changed)):
            path = block.path(i) + middle + up
            leaf = digest if other is None else other
            ancestors = copied(leaf, path)
            proofs.append([s.hex() for s in siblings(path)])
            versions.append([] if other is None else [a.hex() for a in ancestors])
            folded.append((ancestors or [leaf])[-1].hex())
        count = table.num_rows
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "lang": table.column("lang"),
                "position": table.column("pos"),
                "leaf": pa.array([d.hex() for d in digests], pa.string()),
                "subroot": pa.array([subroot.hex()] * count, pa.string()),
                "root": pa.array([root] * count, pa.string()),
                "proof": pa.array(proofs, pa.list_(pa.string())),
                "tampered": pa.array([c is not None for c in changed], pa.bool_()),
                "version": pa.array(versions, pa.list_(pa.string())),
                "folded_root": pa.array(folded, pa.string()),
            }
        )

    rows = leaves.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "tree", "pos", "n", "digest", "changed"
    )
    done = (
        rows.groupBy("tree", F.shiftright("pos", bits))
        .cogroup(above.groupBy("tree", "block"))
        .applyInArrow(lambda table, upper: work(table, upper), _OUT)
    )
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))
