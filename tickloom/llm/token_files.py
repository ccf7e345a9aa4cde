"""Token ids in binary files with Elias-Fano encoded document boundaries.

The documents are put in ascending order of their id (NULL first, ties by a hash of the text) by
one range exchange; each range becomes one pair of files in a shared folder:

* ``ids-NNNNNN.bin``: the ids of all its documents, one after the other, as little-endian unsigned
  16-bit integers (32-bit for vocabularies of over 65,536 entries), to be mapped into memory;
* ``ids-NNNNNN.idx``: the number of documents with a NULL id, the smallest id, and two Elias-Fano
  lists with the samples that select needs: where each document ends, and the ids of the
  documents less the smallest.

A file is written under another name and renamed when complete, and its content depends only on
the rows of its range, so a repeated task does no harm. The ranges and their totals come back as
rows, one per file pair.

Defined results for odd input: a NULL or empty text has the end id only; a NULL doc_id comes
first; documents with equal ids follow one another; an empty table gives no files; other input
columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.elias_fano import EliasFano
from tickloom.llm.encode import Encoder
from tickloom.llm.scratch import new_path, written

END_ID = 2
_HEAD = "<4sBQq"
_MARK = b"IDX1"
BATCH = 256  # texts that are encoded together
_FILES = "shard int, path string, place string, width int, n_docs bigint, n_ids bigint"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the name in it; a path without a scheme is a local one."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without is in the cluster's default file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def _put(path: str, parts: Iterator[bytes]) -> None:
    """Write a file as a whole or not at all."""
    files, name = _place(path)
    draft = f"{name}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
    files.move(draft, name)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID
) -> DataFrame:
    """Write all texts; one row per file pair, in the order of the ranges."""
    # Tasks go by the place, which is the same on every machine.
    place = _qualified(docs.sparkSession, path)
    files, name = _place(place)
    files.create_dir(name)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer_file)
        end = np.array([end_id], encoder.dtype).tobytes()
        shard = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        sizes: list[int] = []

        def contents() -> Iterator[bytes]:
            for batch in batches:
                for at in range(0, batch.num_rows, BATCH):
                    part = batch.slice(at, BATCH)
                    doc_ids.extend(part.column(0).to_pylist())
                    for ids in encoder(part.column(1).to_pylist()):
                        sizes.append(len(ids) // encoder.width + 1)
                        yield ids + end

        name = f"ids-{shard:06d}"
        target = f"{place}/{name}"
        _put(f"{target}.bin", contents())
        if doc_ids:
            known = [d for d in doc_ids if d is not None]
            first = known[0] if known else 0
            ends = np.cumsum(np.array(sizes, np.int64))
            index = [
                struct.pack(_HEAD, _MARK, encoder.width, len(doc_ids) - len(known), first),
                EliasFano.encode(ends).to_bytes(),
                EliasFano.encode(np.array(known, np.int64) - first).to_bytes(),
            ]
            _put(f"{target}.idx", iter(index))
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard,
                        "path": f"{path}/{name}",
                        "place": target,
                        "width": encoder.width,
                        "n_docs": len(doc_ids),
                        "n_ids": int(ends[-1]),
                    }
                ],
                schema=pa.schema(
                    [("shard", pa.int32()), ("path", pa.string()), ("place", pa.string())]
                    + [("width", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
                ),
            )

    order = [F.col("doc_id").cast("bigint"), F.xxhash64("text")]
    rows = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return written(rows.mapInArrow(write, _FILES), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it, those of earlier files included;
    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers.
    """
    # One row per file pair.
    base = "coalesce(sum(n_ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    based = files.selectExpr("shard", "place", f"{base} AS base")
    # A task per file pair; by a number, so that rows this small are not put together.
    based = based.repartition(max(1, files.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _digest(row["place"], row["base"])

    return based.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


class TokenFile:
    """One file pair, opened for reading; documents are found by their position."""

    def __init__(self, path: str) -> None:
        files, name = _place(path)
        with files.open_input_file(f"{name}.idx") as f:
            index = f.read()
        mark, width, self.nulls, self.first = struct.unpack_from(_HEAD, index, 0)
        if mark != _MARK:
            raise ValueError(f"{path}.idx is no index of token ids")
        self.dtype = np.dtype(f"<u{width}")
        self.ends, at = EliasFano.from_bytes(index, struct.calcsize(_HEAD))
        self.ids_of_docs, _ = EliasFano.from_bytes(index, at)
        self.data = files.open_input_file(f"{name}.bin")

    def __len__(self) -> int:
        return self.ends.n

    def start(self, i: int) -> int:
        """Number of ids before the i-th document."""
        return self.ends.select(i - 1) if i else 0

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.ids_of_docs.select(i - self.nulls) + self.first

    def documents(self, first: int, stop: int) -> list[np.ndarray]:
        """Ids of the documents from the first up to but without the last, by one read."""
        starts = [self.start(i) for i in range(first, stop + 1)]
        size = self.dtype.itemsize
        raw = self.data.read_at((starts[-1] - starts[0]) * size, starts[0] * size)
        ids = np.frombuffer(raw, self.dtype)
        return [ids[a - starts[0] : b - starts[0]] for a, b in zip(starts, starts[1:])]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by two selects and one read."""
        return self.documents(i, i + 1)[0]


def _digest(place: str, base: int) -> Iterator[pa.RecordBatch]:
    """The documents of a file, so many at a time; their places come from select alone."""
    file = TokenFile(place)
    for first in range(0, len(file), BATCH):
        stop = min(first + BATCH, len(file))
        found = file.documents(first, stop)
        sizes = np.array([len(ids) for ids in found], np.int64)
        starts = base + file.start(first) + sizes.cumsum() - sizes
        crcs = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([file.doc_id(i) for i in range(first, stop)], pa.int64()),
                pa.array(starts),
                pa.array(sizes),
                pa.array(crcs, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_digest(docs: DataFrame, tokenizer_file: str, path: str | None = None) -> DataFrame:
    """Write all texts to a folder (a new shared one by default) and read the files back."""
    spark: SparkSession = docs.sparkSession
    return read_token_files(
        write_token_files(docs, path or new_path(spark, "ids"), tokenizer_file)
    )
