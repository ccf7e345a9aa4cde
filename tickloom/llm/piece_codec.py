"""Token ids of whole texts with a SentencePiece model, and texts from token ids.

A SentencePiece model writes each space as a marker and puts one before the text. Where no piece of
the model has a marker behind another character, no piece and no merge crosses the place before
the first marker of a run, so the text falls into marked words that are segmented independently:
a run of markers and what follows up to the next marker. Each task keeps a table of the distinct
marked words that it has met: all words of a portion of texts that are not in it yet are
segmented together by the library, once, and the ids of a text are joined from the table by the
positions of its words. A text is never shuffled and no table leaves its task.

A word counts only if the library's normalization of it is the plain one (a marker in front, a
marker for each space). A text with any other word, and every text under a model with pieces
across markers, is encoded by the library as a whole. Decoding has nothing to segment: the
library gets the ids of each row.

Defined results for odd input: a NULL or empty text has no ids, and no ids decode to an empty text;
an id outside the vocabulary makes the decoded text NULL; a long text is cut into portions between
words; repeated rows are encoded like others; an empty table gives no rows; all input columns are
kept, except those that have the name of the result in any case.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.columns import carried, restored

MARK = "▁"
MOST_WORDS = 200_000  # entries of a task's table; it is emptied when full
PORTION = 1 << 18  # characters whose words are looked up together
ROWS = 128  # rows that go back to Spark together
_WORD_END = re.compile(r"(?<=[^ ]) ")

_loaded: dict[str, "PieceCodec"] = {}


class PieceCodec:
    """A model with the table of distinct marked words of this process."""

    def __init__(self, model_file: str, most_words: int = MOST_WORDS) -> None:
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model_file)
        self.size = self.library.get_piece_size()
        pieces = map(self.library.id_to_piece, range(self.size))
        self.separable = not any(MARK in piece.lstrip(MARK) for piece in pieces)
        self.most_words = most_words
        self.table: dict[str, bytes | None] = {}

    @classmethod
    def of(cls, model_file: str) -> "PieceCodec":
        """The codec of this process for a file."""
        if model_file not in _loaded:
            _loaded[model_file] = cls(model_file)
        return _loaded[model_file]

    def whole(self, text: str) -> bytes:
        """Ids of a text, encoded in one piece."""
        return array("i", self.library.encode(text)).tobytes()

    def _words(self, text: str) -> list[str]:
        """Marked words without their first marker, as the library would be given them."""
        if MARK in text:
            text = text.replace(MARK, " ")
        if "  " in text or text[0] == " ":
            return _WORD_END.split(text)
        return text.split(" ")

    def _learn(self, words: set[str]) -> None:
        """Segment the words that the table does not have."""
        if len(self.table) > self.most_words:
            self.table.clear()
        new = [w for w in words if w not in self.table]
        if "" in new:
            # A marker alone, which only ends a text: what it adds to another word.
            new.remove("")
            self.table[""] = self.whole("a ")[len(self.whole("a")) :]
        plain = [MARK + w.replace(" ", MARK) for w in new]
        for word, ids, seen, expected in zip(
            new, self.library.encode(new, num_threads=1), self.library.normalize(new), plain
        ):
            same = seen == expected
            self.table[word] = array("i", ids).tobytes() if same else None

    def _joined(self, portion: list[list[str]]) -> list[bytes | None]:
        """Ids of texts from their words by position; None where a word is not plain."""
        self._learn({word for words in portion for word in words})
        out: list[bytes | None] = []
        for words in portion:
            found = list(map(self.table.__getitem__, words))
            out.append(None if None in found else b"".join(found))
        return out

    def _long(self, text: str) -> bytes:
        """Ids of a text by portions that end where a word ends."""
        parts, at = [], 0
        while at < len(text):
            cut = _WORD_END.search(text.replace(MARK, " ") if MARK in text else text, at + PORTION)
            end = cut.start() if cut else len(text)
            # Only the first portion has the library's own marker in front; the others begin
            # behind the space that ended the one before, which stands for it.
            words = self._words(text[at:end]) if end > at else [""]
            found = self._joined([words])[0]
            if found is None:
                return self.whole(text)
            parts.append(found)
            at = end + 1
            if cut and at == len(text):
                parts.append(self._joined([[""]])[0])
        return b"".join(parts)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as 32-bit integers; none for NULL."""
        portion: list[list[str]] = []
        held: list[str] = []
        size = 0

        def flushed() -> Iterator[bytes]:
            for text, ids in zip(held, self._joined(portion)):
                yield self.whole(text) if ids is None else ids
            held.clear()
            portion.clear()

        for text in texts:
            text = text or ""
            if size + len(text) > PORTION:
                yield from flushed()
                size = 0
            if not self.separable:
                yield self.whole(text)
            elif len(text) > PORTION:
                yield self._long(text)
            else:
                held.append(text)
                portion.append(self._words(text) if text else [])
                size += len(text)
        yield from flushed()

    def decode(self, ids: list[int] | None) -> str | None:
        """The text of ids; None where an id is not in the vocabulary."""
        if not ids:
            return ""
        if min(ids) < 0 or max(ids) >= self.size:
            return None
        return self.library.decode(ids)


def _arrow_fields(docs: DataFrame, name: str, kind: str) -> str:
    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return f"{given}, {name} {kind}"


def _with_result(docs: DataFrame, source: str, kind: str, result: str, name: str, work) -> DataFrame:
    """``docs`` with one more column that ``work`` makes of the column ``source``."""
    at = docs.columns.index(source)
    rows = docs.toDF(*[f"_carried_{i}" for i in range(len(docs.columns))])
    rows = rows.withColumn(f"_carried_{at}", rows[f"_carried_{at}"].cast(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, work(part.column(at))], [*part.schema.names, "_result"]
                )

    out = rows.mapInArrow(run, _arrow_fields(rows, "_result", result))
    return out.select(*restored(docs, (name,)), out["_result"].alias(name))


def encode_documents(
    docs: DataFrame, model_file: str, text: str = "text", name: str = "ids"
) -> DataFrame:
    """All columns and ``ids``, the token ids of each text without begin and end ids."""

    def work(texts: pa.Array) -> pa.Array:
        found = list(PieceCodec.of(model_file).encode(texts.to_pylist()))
        ends = np.cumsum([0] + [len(ids) // 4 for ids in found])
        values = pa.array(np.frombuffer(b"".join(found), np.int32), pa.int32())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    return _with_result(docs, text, "string", "array<int>", name, work)


def decode_documents(
    encoded: DataFrame, model_file: str, ids: str = "ids", name: str = "decoded"
) -> DataFrame:
    """All columns and ``decoded``, the text of the token ids of each row."""

    def work(rows: pa.Array) -> pa.Array:
        codec = PieceCodec.of(model_file)
        return pa.array([codec.decode(row) for row in rows.to_pylist()], pa.string())

    return _with_result(encoded, ids, "array<int>", "string", name, work)
