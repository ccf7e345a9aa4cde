"""Suffix-array removal of byte strings that an earlier document has too.

A byte goes if it lies in a string of 50 bytes that also starts in a document with a smaller id;
strings are judged on the input. Sorting the suffixes at all positions would move 50 bytes or more
for every byte of text. Suffixes are therefore sampled by content first: of the 24-byte strings in
a window of 50 bytes the one with the smallest hash is its anchor. Equal windows have equal
anchors, in the same place, so a window can only have an equal where its anchor has one.

1. Anchors (one in 13 positions or so) are counted over the corpus in buckets of hashes, shipped
   as packed arrays. Windows whose anchor is in one document only are settled.
2. The remaining windows of one anchor are consecutive and travel as one segment of bytes. Sampled
   splitters range-partition segments by the leading bytes of their anchor. Within a block of
   documents equal segments collapse first, so a passage that everybody has arrives once per
   block. An anchor that very many documents have, each with other neighbours, travels as single
   windows, range-partitioned by their own leading bytes, so that no range has to hold all of it.
3. A task sorts the suffixes of its ranges by multikey quicksort, eight bytes at a time: each level
   splits groups that still agree, groups of one drop out, and a group whose members agree
   throughout is done. Equal anchors are never split between tasks or portions of a task, so no
   comparison is missed at a boundary. The smallest id in a group of equal suffixes keeps its
   bytes.
4. The removed stretches come back to their documents.

Later copies of a whole text lose every byte, whatever else there is; they are found by their
hashes beforehand and take no part, so the first copy need not be compared with them.

Defined results for odd input: a NULL or empty text has nothing to remove; a NULL doc_id is larger
than any other and none is smaller than itself; rows with equal ids do not affect each other; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.scratch import written

SPAN = 50  # bytes that must agree
ANCHOR = 24  # bytes of an anchor
PLACES = SPAN - ANCHOR + 1  # of an anchor in a window
BLOCK_BYTES = 2 << 20  # text that one task works on together
BUCKET_BYTES = 16 << 20  # text per bucket
HOT_DOCS = 5_000  # from here on an anchor's windows travel one by one
PORTION = 500_000  # suffixes that are sorted together
SAMPLE_DOCS = 2_000  # whose anchors give the splitters
NO_ID = (1 << 63) - 1  # stands for NULL, and is no id of a document

_BITS = 28  # of a position in a piece
PIECE = 1 << 27  # windows whose positions are told apart; longer blocks are taken in pieces
_LOW = np.uint64((1 << _BITS) - 1)


class Block:
    """The texts of a block, one after the other, and their runs of windows by anchor."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = sizes.cumsum()
        self.starts = self.ends - sizes
        self.data = b"".join(texts) + bytes(16)
        self.run_lo = self.run_hi = self.run_anchor = self.run_doc = np.zeros(0, np.int64)
        self.run_hash = self.hashes = np.zeros(0, np.uint64)
        total = int(sizes.sum())
        if total >= SPAN:
            self._find_runs(total)

    def _find_runs(self, total: int) -> None:
        n = total - ANCHOR + 1
        word = lambda k: np.ndarray((n,), "<u8", self.data, k, (1,))
        h = word(0) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(8, ANCHOR, 8):
            h ^= h >> np.uint64(29)
            h += word(k)
            h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        # Least of each PLACES neighbours: prefix and suffix minima of chunks of that length.
        m = n - PLACES + 1
        anchor = np.empty(m, np.int64)
        for start in range(0, m, PIECE):
            part = h[start : start + PIECE + PLACES - 1]
            size = len(part)
            padded = np.full(-(-size // PLACES) * PLACES, np.iinfo(np.uint64).max, np.uint64)
            padded[:size] = (part & ~_LOW) | np.arange(size, dtype=np.uint64)
            chunks = padded.reshape(-1, PLACES)
            ahead = np.minimum.accumulate(chunks, axis=1).ravel()
            back = np.minimum.accumulate(chunks[:, ::-1], axis=1)[:, ::-1].ravel()
            low = np.minimum(back[: size - PLACES + 1], ahead[PLACES - 1 : size]) & _LOW
            anchor[start : start + len(low)] = low.astype(np.int64) + start
        new = np.ones(m, bool)
        new[1:] = anchor[1:] != anchor[:-1]
        new[self.starts[self.starts < m]] = True
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], m) - 1
        doc = np.searchsorted(self.ends, lo, side="right")
        # Windows that reach into the next text are none.
        hi = np.minimum(hi, self.ends[doc] - SPAN)
        ok = hi >= lo
        self.run_lo, self.run_hi, self.run_doc = lo[ok], hi[ok], doc[ok]
        self.run_anchor = anchor[lo[ok]]
        self.run_hash, self.hashes = h[self.run_anchor] >> np.uint64(1), h


def _bucket_of(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(31)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], extra: int) -> Iterator[tuple[list, list[bytes]]]:
    """Rows in blocks of bounded text: (columns but the last as lists, texts)."""
    rows, texts, held = [], [], 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(extra)]
        for i, text in enumerate(batch.column(extra)):
            raw = text.as_buffer()
            data = raw.to_pybytes() if raw is not None else b""
            if held and (held + len(data) > BLOCK_BYTES or len(rows) >= 60_000):
                yield rows, texts
                rows, texts, held = [], [], 0
            rows.append(tuple(c[i] for c in columns))
            texts.append(data)
            held += len(data)
    if rows:
        yield rows, texts


def _pack(buckets: int):
    schema = pa.schema(
        [("bucket", pa.int32()), ("block", pa.int64()), ("tokens", pa.binary())]
        + [("owners", pa.binary())]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rows, texts in _blocks(batches, 2):
            block = Block(texts)
            # Each anchor once per document.
            order = np.lexsort((block.run_doc, block.run_hash))
            values, owners = block.run_hash[order], block.run_doc[order]
            first = np.ones(len(values), bool)
            first[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
            values, owners = values[first], owners[first].astype(np.uint16)
            bucket = _bucket_of(values, buckets)
            low = (values & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            out = [
                {
                    "bucket": b,
                    "block": number,
                    "tokens": low[cuts[b] : cuts[b + 1]].tobytes(),
                    "owners": owners[cuts[b] : cuts[b + 1]].tobytes(),
                }
                for b in range(buckets)
                if cuts[b + 1] > cuts[b]
            ]
            ids = np.array(rows, np.int64).tobytes()
            out.append({"bucket": number % buckets, "block": number, "tokens": None, "owners": ids})
            yield pa.RecordBatch.from_pylist(out, schema)
            number += 1

    return pack


_COUNTED = "block bigint, bucket int, tokens binary, owners binary, hot binary"


def _count_bucket(table: pa.Table) -> pa.Table:
    """The anchors of each block that two documents or more have, and which are hot."""
    rows = table.to_pylist()
    packed = [r for r in rows if r["tokens"] is not None]
    out = [{**r, "bucket": -1, "hot": None} for r in rows if r["tokens"] is None]
    if packed:
        tokens = [np.frombuffer(r["tokens"], np.uint32) for r in packed]
        values = np.concatenate(tokens)
        order = np.argsort(values, kind="stable")
        in_order = values[order]
        edge = np.flatnonzero(np.append(True, in_order[1:] != in_order[:-1]))
        count = np.zeros(len(values), np.int64)
        each = np.diff(np.append(edge, len(values)))
        count[order] = np.repeat(each, each)
        ends = np.cumsum([len(t) for t in tokens])
        for r, mine, low in zip(packed, np.split(count, ends[:-1]), tokens):
            keep = mine >= 2
            if keep.any():
                owners = np.frombuffer(r["owners"], np.uint16)[keep]
                out.append(
                    {
                        "block": r["block"],
                        "bucket": r["bucket"],
                        "tokens": low[keep].tobytes(),
                        "owners": owners.tobytes(),
                        "hot": (mine[keep] >= HOT_DOCS).astype(np.uint8).tobytes(),
                    }
                )
    schema = pa.schema(
        [("block", pa.int64()), ("bucket", pa.int32())]
        + [(c, pa.binary()) for c in ("tokens", "owners", "hot")]
    )
    return pa.Table.from_pylist([{k: r[k] for k in schema.names} for r in out], schema)


def _to_documents(table: pa.Table) -> pa.Table:
    """Of one block: the surviving anchors of each document, hot ones negated."""
    rows = table.to_pylist()
    ids = np.frombuffer(next(r["owners"] for r in rows if r["bucket"] < 0), np.int64).reshape(-1, 2)
    owners, keys = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
    for r in rows:
        if r["bucket"] >= 0:
            owners.append(np.frombuffer(r["owners"], np.uint16))
            low = np.frombuffer(r["tokens"], np.uint32).astype(np.int64)
            key = (np.int64(r["bucket"]) << 32 | low) + 1
            keys.append(np.where(np.frombuffer(r["hot"], np.uint8) > 0, -key, key))
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.argsort(owner, kind="stable")
    owner, key = owner[order], key[order]
    docs = np.unique(owner)
    cuts = np.append(np.searchsorted(owner, docs), len(owner))
    anchors = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(key))
    return pa.table({"_id": ids[docs, 0], "_text": ids[docs, 1], "anchors": anchors})


_CUT = "part int, anchor bigint, bytes binary, places binary, _id bigint, _text bigint"
_CUT_SCHEMA = pa.schema(
    [("part", pa.int32()), ("anchor", pa.int64()), ("bytes", pa.binary()), ("places", pa.binary())]
    + [("_id", pa.int64()), ("_text", pa.int64())]
)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive stretches of an array of bytes as binary values."""
    offsets = np.concatenate([[0], sizes.cumsum()]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges with these starts and sizes, one range after the other."""
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(starts - (sizes.cumsum() - sizes), sizes)


def _cut(buckets: int, splitters: np.ndarray):
    """Segments to compare, one for each content and document, and settled stretches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _blocks(batches, 3):
            order = sorted(range(len(rows)), key=lambda i: rows[i][:2])
            block = Block([texts[i] for i in order])
            ids = np.array([rows[i][0] for i in order], np.int64)
            text_hash = np.array([rows[i][1] for i in order], np.int64)
            # The surviving anchors of each document, as (document, key) in one order.
            anchors = [np.array(rows[i][2], np.int64) for i in order]
            owner = np.repeat(np.arange(len(rows)), [len(x) for x in anchors])
            known = np.concatenate(anchors)
            key = (_bucket_of(block.run_hash, buckets) << 32) + (
                block.run_hash & np.uint64(0xFFFFFFFF)
            ).astype(np.int64) + 1
            plain = np.isin(_joint(block.run_doc, key), _joint(owner[known > 0], known[known > 0]))
            hot = np.isin(_joint(block.run_doc, key), _joint(owner[known < 0], -known[known < 0]))
            lo, hi = block.run_lo[plain], block.run_hi[plain]
            windows = block.run_hi[hot] - block.run_lo[hot] + 1
            single = _ranges(block.run_lo[hot], windows)
            start = np.concatenate([lo, single])
            end = np.concatenate([hi, single]) + SPAN
            at = np.concatenate([block.run_anchor[plain], single])
            doc = np.concatenate([block.run_doc[plain], np.repeat(block.run_doc[hot], windows)])
            if not len(start):
                continue
            h = block.hashes
            # ANCHOR-byte strings that cover a segment tell its content.
            content = (end - start).astype(np.uint64)
            for place in (
                start,
                np.minimum(start + ANCHOR, end - ANCHOR),
                np.maximum(end - 2 * ANCHOR, start),
                end - ANCHOR,
            ):
                content = (content ^ h[place]) * np.uint64(0x9E3779B97F4A7C15)
                content ^= content >> np.uint64(31)
            group_key = np.where(
                np.arange(len(start)) < len(lo), h[at].view(np.int64), content.view(np.int64)
            )
            order = np.lexsort((start, doc, content, group_key))
            start, end, at, doc = start[order], end[order], at[order], doc[order]
            content, group_key = content[order], group_key[order]
            new = np.append(True, (content[1:] != content[:-1]) | (group_key[1:] != group_key[:-1]))
            first = np.flatnonzero(new)[new.cumsum() - 1]
            base = block.starts[doc]
            gone = ids[doc] > ids[doc[first]]
            # What an earlier document of the block has is settled.
            by_doc = np.flatnonzero(gone)
            by_doc = by_doc[np.argsort(doc[by_doc], kind="stable")]
            if len(by_doc):
                spans = np.stack([start[by_doc] - base[by_doc], end[by_doc] - base[by_doc]], axis=1)
                edge = np.flatnonzero(np.append(True, doc[by_doc][1:] != doc[by_doc][:-1]))
                sizes = np.diff(np.append(edge, len(by_doc)))
                own = doc[by_doc][edge]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((text_hash[own] % (len(splitters) + 1)).astype(np.int32)),
                        pa.array(np.zeros(len(own), np.int64)),
                        pa.nulls(len(own), pa.binary()),
                        _binary(spans.astype(np.int32), sizes * 8),
                        pa.array(ids[own]),
                        pa.array(text_hash[own]),
                    ],
                    schema=_CUT_SCHEMA,
                )
            stay = np.flatnonzero(~gone)
            edge = np.flatnonzero(
                np.append(True, (doc[stay][1:] != doc[stay][:-1]) | (first[stay][1:] != first[stay][:-1]))
            )
            head, count = stay[edge], np.diff(np.append(edge, len(stay)))
            places = (start[stay] - base[stay]).astype(np.int32)
            data = np.frombuffer(block.data, np.uint8)
            lead = np.ndarray((len(block.data) - 7,), ">u8", block.data, 0, (1,))[at[head]]
            parts = np.searchsorted(splitters, lead.astype(np.uint64), side="right").astype(np.int32)
            ends = count.cumsum()
            for i in range(0, len(head), 20_000):
                some = head[i : i + 20_000]
                sizes = end[some] - start[some]
                mine = places[ends[i] - count[i] : ends[min(i + 20_000, len(head)) - 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts[i : i + 20_000]),
                        pa.array(group_key[some]),
                        _binary(data[_ranges(start[some], sizes)], sizes),
                        _binary(mine, count[i : i + 20_000] * 4),
                        pa.array(ids[doc[some]]),
                        pa.array(text_hash[doc[some]]),
                    ],
                    schema=_CUT_SCHEMA,
                )

    return cut


def _joint(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A document's place in the block and a key as one number."""
    mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(32))) + doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def equal_suffixes(data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in groups that agree in their first SPAN bytes.

    Gives an order of the suffixes in which the members of each group of two or more stand
    together, and where in that order each group begins; suffixes without an equal are left out.
    """
    view = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))
    levels = [*range(0, SPAN - 7, 8), SPAN - 8]
    members, cuts, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    active, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    for depth, level in enumerate(levels):
        if not len(active):
            break
        key = view[at[active] + level].astype(np.uint64)
        order = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, group))
        active, group, key = active[order], group[order], key[order]
        edge = np.append(True, (group[1:] != group[:-1]) | (key[1:] != key[:-1]))
        group = edge.cumsum() - 1
        leader = active[edge]
        keep = np.bincount(group)[group] > 1
        active, group = active[keep], group[keep]
        # A group all of whose members agree with its first to the end needs no further level.
        same = np.ones(len(active), bool)
        for rest in levels[depth + 1 :]:
            same &= view[at[active] + rest] == view[at[leader[group]] + rest]
        settled = ~(np.bincount(group, ~same) > 0)[group]
        members.append(active[settled])
        cuts.append(np.unique(group[settled], return_index=True)[1] + n)
        n += len(members[-1])
        active, group = active[~settled], group[~settled]
    return np.concatenate(members), np.concatenate(cuts)


_SPANS = "_id bigint, _text bigint, begin int, finish int"
_SPANS_SCHEMA = pa.schema(
    [("_id", pa.int64()), ("_text", pa.int64()), ("begin", pa.int32()), ("finish", pa.int32())]
)


def _sort_portion(table: pa.Table) -> pa.RecordBatch | None:
    """Stretches that go, from segments all of whose equal anchors are here."""
    table = table.combine_chunks()
    content, places = table.column("bytes").chunk(0), table.column("places").chunk(0)
    ids = table.column("_id").to_numpy()
    texts = table.column("_text").to_numpy()
    offsets = np.frombuffer(content.buffers()[1], np.int32)[content.offset :][: len(content) + 1]
    base, sizes = offsets[:-1].astype(np.int64), np.diff(offsets).astype(np.int64)
    data = content.buffers()[2].to_pybytes() + bytes(8)
    windows = sizes - SPAN + 1
    row = np.repeat(np.arange(len(sizes)), windows)
    at = _ranges(base, windows)
    members, cuts = equal_suffixes(data, at)
    if not len(members):
        return None
    of = ids[row[members]]
    least = np.minimum.reduceat(of, cuts)
    gone = np.sort(members[of > np.repeat(least, np.diff(np.append(cuts, len(members))))])
    if not len(gone):
        return None
    new = np.append(True, (gone[1:] != gone[:-1] + 1) | (row[gone[1:]] != row[gone[:-1]]))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(gone)) - 1
    own = row[gone[first]]
    begin, finish = at[gone[first]] - base[own], at[gone[last]] - base[own] + SPAN
    place_ends = np.frombuffer(places.buffers()[1], np.int32)[places.offset :][: len(places) + 1] // 4
    all_places = np.frombuffer(places.buffers()[2], np.int32)
    times = np.diff(place_ends)[own]
    place = all_places[_ranges(place_ends[:-1][own].astype(np.int64), times.astype(np.int64))]
    arrays = [np.repeat(ids[own], times), np.repeat(texts[own], times)]
    arrays += [np.repeat(begin, times) + place, np.repeat(finish, times) + place]
    return _span_batch(*arrays)


def _span_batch(ids, texts, begin, finish) -> pa.RecordBatch:
    begin, finish = begin.astype(np.int32), finish.astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (ids, texts, begin, finish)], schema=_SPANS_SCHEMA
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort the suffixes of consecutive ranges; rows come in the order of their anchors."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        settled = batch.filter(pc.is_null(batch.column("bytes")))
        if settled.num_rows:
            spans = settled.column("places").to_pylist()
            times = np.array([len(x) // 8 for x in spans])
            flat = np.frombuffer(b"".join(spans), np.int32).reshape(-1, 2)
            ids, texts = (settled.column(c).to_numpy() for c in ("_id", "_text"))
            yield _span_batch(np.repeat(ids, times), np.repeat(texts, times), flat[:, 0], flat[:, 1])
        batch = batch.filter(pc.is_valid(batch.column("bytes")))
        while batch.num_rows:
            lengths = pc.binary_length(batch.column("bytes")).to_numpy().astype(np.int64)
            total = size + (lengths - SPAN + 1).cumsum()
            anchor = np.stack([batch.column(c).to_numpy() for c in ("part", "anchor")], axis=1)
            before = held[-1].slice(held[-1].num_rows - 1) if held else None
            last = (
                [before.column("part")[0].as_py(), before.column("anchor")[0].as_py()]
                if before
                else anchor[0]
            )
            new = (anchor != np.vstack([[last], anchor[:-1]])).any(axis=1)
            # The first change of anchor behind the row that fills the portion.
            cut = np.flatnonzero(new & (np.concatenate([[size], total[:-1]]) >= PORTION))
            if not len(cut):
                held.append(batch)
                size = int(total[-1])
                break
            if cut[0]:
                held.append(batch.slice(0, cut[0]))
            found = _sort_portion(pa.Table.from_batches(held))
            if found is not None:
                yield found
            held, size, batch = [], 0, batch.slice(cut[0])
    if held:
        found = _sort_portion(pa.Table.from_batches(held))
        if found is not None:
            yield found


def _keyed(docs: DataFrame) -> DataFrame:
    """Every row by its id and the hash of its text.

    All joins read these three columns, so that Spark shuffles the texts once.
    """
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_text"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"),
    ).repartition("_id", "_text")


def _later_copies(docs: DataFrame) -> DataFrame:
    """Rows whose whole text an earlier document has, by two hashes of 64 bits."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("_text"),
        F.xxhash64(F.lit(1), "text").alias("_again"),
    ).where(F.octet_length("text") >= SPAN)
    first = rows.groupBy("_text", "_again").agg(F.min("_id").alias("first"), F.count("*").alias("k"))
    rows = rows.join(first.where("k > 1"), ["_text", "_again"]).where("_id > first")
    return written(rows.select("_id", "_text").distinct(), "copies")


def _splitters(docs: DataFrame, parts: int, rows: int) -> np.ndarray:
    """Leading bytes that cut the anchors of a sample of documents into equal parts."""

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _blocks(batches, 0):
            block = Block(texts)
            step = max(1, len(block.run_anchor) // (64 * len(texts)))
            view = np.ndarray((len(block.data) - 7,), ">u8", block.data, 0, (1,))
            found = view[block.run_anchor[::step]].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["lead"])

    share = min(1.0, SAMPLE_DOCS / max(1, rows))
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data")
    sample = docs.select(data).sample(share, seed=1).mapInArrow(leads, "lead bigint")
    # At most some 64 numbers for each of about 2,000 documents.
    found = np.array([r[0] for r in sample.collect()], np.int64).view(np.uint64)
    found.sort()
    at = np.arange(1, parts) * len(found) // parts
    return np.unique(found[at]) if len(found) else np.zeros(0, np.uint64)


def _spans(docs: DataFrame, keyed: DataFrame, copies: DataFrame) -> DataFrame:
    """``_id``, ``_text``, ``begin``, ``finish`` of byte ranges that go, which may overlap; later
    copies of a whole text are left out."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).first()
    buckets = max(1, math.ceil((size["b"] or 0) / BUCKET_BYTES))
    splitters = _splitters(docs, buckets, size["n"])
    fresh = keyed.join(copies, ["_id", "_text"], "left_anti")
    survivors = (
        fresh.select("_id", "_text", "data")
        .mapInArrow(_pack(buckets), "bucket int, block bigint, tokens binary, owners binary")
        .groupBy("bucket")
        .applyInArrow(_count_bucket, _COUNTED)
        .groupBy("block")
        .applyInArrow(_to_documents, "_id bigint, _text bigint, anchors array<bigint>")
        .dropDuplicates(["_id", "_text"])
    )
    # Written, as the spans are: what was shuffled to find them goes from the disks.
    survivors = written(survivors, "anchors")
    parts = (
        fresh.join(survivors, ["_id", "_text"])
        .select("_id", "_text", "anchors", "data")
        .mapInArrow(_cut(buckets, splitters), _CUT)
    )
    spans = (
        parts.repartition(buckets, "part")
        .sortWithinPartitions("part", "anchor")
        .mapInArrow(_compare, _SPANS)
    )
    return written(spans, "spans")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        copies = batch.column(3).to_pylist()
        for data, spans, copy in zip(batch.column(1), batch.column(2), copies):
            raw = data.as_buffer().to_pybytes()
            if copy:
                out.append((len(raw), 1, b""))
                continue
            kept, n_spans, done = [], 0, 0
            if spans.is_valid:
                begin = spans.values.field("begin").to_numpy()
                order = np.argsort(begin, kind="stable")
                begin = begin[order]
                finish = np.maximum.accumulate(spans.values.field("finish").to_numpy()[order])
                at = np.flatnonzero(np.append(True, begin[1:] > finish[:-1]))
                ends = finish[np.append(at[1:], len(begin)) - 1]
                n_spans = len(at)
                for a, b in zip(begin[at].tolist(), ends.tolist()):
                    kept.append(raw[done:a])
                    done = b
            kept.append(raw[done:])
            out.append((len(raw), n_spans, b"".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for n, _, _ in out], pa.int64()),
                pa.array([n - len(k) for n, _, k in out], pa.int64()),
                pa.array([s for _, s, _ in out], pa.int64()),
                pa.array([k for _, _, k in out], pa.binary()),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def strip_repeats(docs: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the bytes that
    are left. What is left need not be valid UTF-8."""
    keyed, copies = _keyed(docs), _later_copies(docs)
    spans = _spans(docs, keyed, copies).groupBy("_id", "_text")
    spans = spans.agg(F.collect_list(F.struct("begin", "finish")).alias("spans"))
    return (
        keyed.join(spans, ["_id", "_text"], "left")
        .join(copies.withColumn("copy", F.lit(True)), ["_id", "_text"], "left")
        .select(F.when(F.col("_id") != NO_ID, F.col("_id")), "data", "spans", "copy")
        .mapInArrow(
            _strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
        )
    )
