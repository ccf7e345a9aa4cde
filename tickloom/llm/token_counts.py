"""Token counts that follow edits without encoding whole texts again.

Each document keeps a segment tree. Its leaves are runs of pre-tokens of about 512 characters that
begin at a single space between two other characters: a place where a byte-level pre-tokenizer
always cuts, and which three characters alone decide. Inner nodes hold the sums of characters
and tokens below them.

An edit replaces a range of characters. The tree is descended by character sums to the leaves that
the range touches, and to the leaf before or behind where the range comes within a character of the
border, as that character takes part in the decision. Only the text of these leaves is cut anew
and encoded again. Where it gives no more leaves than before, the sums on the paths up change; where
it has grown by a leaf or more, the new leaves are put between the others and the sums above are added up
again, without any text.

Trees are rows of a table; edits are joined to them by document, so the work is spread like the
documents. A document is one row and one tree.

Defined results for odd input: a NULL or empty text has no leaf and no token; edits may touch,
insert at either end, or empty a text; where the range of an edit does not fit the text, overlaps
another's or has a NULL, and where an edit is NULL, all edits of the document are refused: it keeps its
text and counts, and ``n_refused`` is their number; a NULL replacement deletes; documents without edits
keep their counts; equal rows are counted one by one; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.encode import Encoder

LEAF_CHARS = 512
_CUT = re.compile(r"(?<=\S)(?= \S)")


def leaves_of(text: str) -> list[str]:
    """The text in pieces of LEAF_CHARS characters or more, cut where any pre-tokenizer cuts."""
    out, start = [], 0
    while len(text) - start > LEAF_CHARS:
        cut = _CUT.search(text, start + LEAF_CHARS)
        if cut is None or cut.start() >= len(text):
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    if start < len(text):
        out.append(text[start:])
    return out


class SegmentTree:
    """Sums of characters and tokens over the leaves, node i above nodes 2i and 2i + 1."""

    def __init__(self, chars: list[int], tokens: list[int]) -> None:
        self.n = len(chars)
        self.base = 1 << max(0, (self.n - 1)).bit_length()
        self.sums = np.zeros((2 * self.base, 2), np.int64)
        self.sums[self.base : self.base + self.n, 0] = chars
        self.sums[self.base : self.base + self.n, 1] = tokens
        level = self.base
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level].reshape(half, 2, 2).sum(axis=1)
            level = half

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins."""
        node, begin = 1, 0
        while node < self.base:
            node *= 2
            if place >= begin + self.sums[node, 0]:
                begin += int(self.sums[node, 0])
                node += 1
        return node - self.base, begin

    def update(self, leaf: int, chars: int, tokens: int) -> None:
        """Set one leaf and the sums above it."""
        node = self.base + leaf
        change = np.array([chars, tokens]) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def to_bytes(self) -> bytes:
        """The leaves; the inner sums follow from them."""
        return self.sums[self.base : self.base + self.n].tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "SegmentTree":
        leaves = np.frombuffer(data, np.int64).reshape(-1, 2)
        return cls(leaves[:, 0].tolist(), leaves[:, 1].tolist())


class Counted:
    """A text with its tree. Edited leaves are cut anew, so none grows with the edits."""

    def __init__(self, text: str, encoder: Encoder, tree: SegmentTree | None = None) -> None:
        self.encoder, self.encoded_chars = encoder, 0
        if tree is None:
            self.leaves = leaves_of(text)
            tree = SegmentTree([len(x) for x in self.leaves], self._counts(self.leaves))
        else:
            sizes = tree.sums[tree.base : tree.base + tree.n, 0]
            ends = sizes.cumsum().tolist()
            self.leaves = [text[e - s : e] for s, e in zip(sizes.tolist(), ends)]
        self.tree = tree

    def _counts(self, texts: list[str]) -> list[int]:
        self.encoded_chars += sum(map(len, texts))
        return [len(ids) // self.encoder.width for ids in self.encoder(texts)]

    def text(self) -> str:
        return "".join(self.leaves)

    def edit(self, start: int, end: int, replacement: str | None) -> None:
        """Replace the characters from start up to but without end."""
        if not 0 <= start <= end <= self.tree.chars:
            raise ValueError(f"no range {start} to {end} in a text of {self.tree.chars}")
        new = replacement or ""
        if not self.leaves:
            first, found, old = 0, leaves_of(new), 0
        else:
            last_char = max(0, self.tree.chars - 1)
            # A border is decided by the character before it, the space, and the one behind.
            first, begin = self.tree.find(min(max(0, start - 2), last_char))
            last, _ = self.tree.find(min(end + 1, last_char))
            joined = "".join(self.leaves[first : last + 1])
            # The region begins and ends at borders that stand.
            found = leaves_of(joined[: start - begin] + new + joined[end - begin :])
            old = last + 1 - first
        chars, tokens = [len(x) for x in found], self._counts(found)
        if len(found) > old:
            self._splice(first, old, found, chars, tokens)
            return
        for i in range(old):
            here = i < len(found)
            self.leaves[first + i] = found[i] if here else ""
            self.tree.update(first + i, *((chars[i], tokens[i]) if here else (0, 0)))

    def _splice(self, first: int, old: int, found: list[str], chars: list[int], tokens: list[int]) -> None:
        """Put leaves in the place of fewer ones; the empty ones of earlier edits go."""
        rows = self.tree.sums[self.tree.base : self.tree.base + self.tree.n].tolist()
        rows[first : first + old] = [list(x) for x in zip(chars, tokens)]
        self.leaves[first : first + old] = found
        kept = [i for i, leaf in enumerate(self.leaves) if leaf]
        self.leaves = [self.leaves[i] for i in kept]
        self.tree = SegmentTree([rows[i][0] for i in kept], [rows[i][1] for i in kept])


_TREES = "doc_id bigint, text string, n_tokens bigint, tree binary"


def count_tokens(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Every row's ``doc_id``, ``text``, ``n_tokens`` and ``tree``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_file)
        for batch in batches:
            trees = [Counted(t or "", encoder).tree for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([t.tokens for t in trees], pa.int64()),
                    pa.array([t.to_bytes() for t in trees], pa.binary()),
                ],
                ["doc_id", "text", "n_tokens", "tree"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(build, _TREES)


_EDITED = (
    "doc_id bigint, text string, n_tokens bigint, tree binary, tokens_before bigint, "
    "n_edits int, n_refused int, encoded_chars bigint"
)


def _fit(edits: list[dict | None], size: int) -> bool:
    """Whether all ranges are in a text of a size and none overlaps another."""
    if any(e is None or e["start"] is None or e["end"] is None for e in edits):
        return False
    ranges = sorted((e["start"], e["end"]) for e in edits)
    inside = all(0 <= start <= end <= size for start, end in ranges)
    return inside and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def apply_edits(counted: DataFrame, tokenizer_file: str) -> DataFrame:
    """Apply a column ``edits`` (array of start, end, replacement; character positions in the
    text as it is before all of them) to each row of ``count_tokens``.

    Adds ``tokens_before``, ``n_edits``, ``n_refused`` and ``encoded_chars``, the characters encoded
    again.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_file)
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text, edits = row["text"], row["edits"] or []
                done = Counted(text or "", encoder, SegmentTree.from_bytes(row["tree"]))
                n_refused = 0 if _fit(edits, done.tree.chars) else len(edits)
                edits = [] if n_refused else sorted(edits, key=lambda e: (e["start"], e["end"]))
                # From the back, so that the places of earlier ones hold.
                for e in reversed(edits):
                    done.edit(e["start"], e["end"], e["replacement"])
                kept = [leaf for leaf in range(len(done.leaves)) if done.leaves[leaf]]
                sums = done.tree.sums[done.tree.base : done.tree.base + done.tree.n][kept]
                out.append(
                    {
                        "doc_id": row["doc_id"],
                        "text": done.text() if edits else text,
                        "n_tokens": done.tree.tokens,
                        "tree": sums.tobytes(),
                        "tokens_before": row["n_tokens"],
                        "n_edits": len(edits),
                        "n_refused": n_refused,
                        "encoded_chars": done.encoded_chars,
                    }
                )
            schema = pa.schema(
                [("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64())]
                + [("tree", pa.binary()), ("tokens_before", pa.int64()), ("n_edits", pa.int32())]
                + [("n_refused", pa.int32()), ("encoded_chars", pa.int64())]
            )
            yield pa.RecordBatch.from_pylist(out, schema)

    rows = counted.select("doc_id", "text", "n_tokens", "tree", "edits")
    return rows.mapInArrow(change, _EDITED)


def masking_edits(text):
    """Edits that replace e-mail addresses and numbers of seven digits or more by a mark."""
    none = F.array().cast("array<struct<start:bigint,end:bigint,replacement:string>>")
    # A run of address characters is tried once, from its start or from the end of the match before
    # it: from any later character it ends in the same place.
    pattern = r"(?s)(?:\G|(?<![A-Za-z0-9._]))[A-Za-z0-9._]++@[A-Za-z0-9.]+|[0-9]{7,}"
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    between = F.split(F.coalesce(text, F.lit("")), pattern, -1)
    # Where a match begins: all that stands before it, matches and the text between them.
    place = F.aggregate(
        F.arrays_zip(found.alias("m"), F.slice(between, F.lit(1), F.size(found)).alias("b")),
        F.struct(
            F.lit(0).cast("bigint").alias("at"),
            none.alias("out"),
        ),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["b"]) + F.char_length(x["m"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.char_length(x["b"])).alias("start"),
                        (acc["at"] + F.char_length(x["b"]) + F.char_length(x["m"])).alias("end"),
                        F.lit("<masked>").alias("replacement"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    # Few texts have what any match needs; the others are not searched.
    return F.when(F.contains(text, F.lit("@")) | text.rlike("[0-9]{7}"), place).otherwise(none)
