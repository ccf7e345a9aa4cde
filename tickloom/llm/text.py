"""Words and word shingles of whole texts, as Spark expressions.

A word is a maximal run of characters other than the six ASCII white-space characters. No
expression here uses Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """The words of a text in order; no words for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE + "+")
    # Only the first and the last part can be empty.
    return F.array_remove(parts, "")


def fold(text: Column) -> Column:
    """The text with A-Z in lower case and every other character as it is."""
    # lower() agrees where there are only ASCII capitals, and is far cheaper than translate().
    other = text.rlike(r"[^\x00-\x7F]")
    return F.when(other, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def word_count(text: Column) -> Column:
    """Number of words as BIGINT; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def bound(value: Column, body) -> Column:
    """``body(value)``, with the value worked out once for a row however often it is used."""
    return F.transform(F.array(value), body)[0]


def _window_hashes(ws: Column, size: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.size(ws) - size),
        lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(size)]),
    )


def shingle_sequence(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """64-bit hashes of all word shingles in order, repeats included; none for shorter texts."""
    return bound(
        words(fold(text)),
        lambda ws: F.when(F.size(ws) >= size, _window_hashes(ws, size)).otherwise(
            F.array().cast("array<bigint>")
        ),
    )


def shingle_hashes(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Distinct 64-bit hashes of the word shingles of a text.

    A text of fewer words than ``size``, but one at least, has its word sequence as its one
    shingle; a text without words, or NULL, has none.
    """
    from_words = lambda ws: F.when(
        F.size(ws) >= size, F.array_distinct(_window_hashes(ws, size))
    ).when(F.size(ws) > 0, F.array(F.xxhash64(ws))).otherwise(F.array().cast("array<bigint>"))
    return bound(words(fold(text)), from_words)


def shingle_texts(text: Column, size: int = SHINGLE_WORDS) -> Column:
    """Distinct word shingles of a text as strings, by the rules of ``shingle_hashes``."""
    from_words = lambda ws: F.when(
        F.size(ws) >= size,
        F.array_distinct(
            F.transform(
                F.sequence(F.lit(0), F.size(ws) - size),
                lambda i: F.concat_ws(" ", F.slice(ws, i + 1, F.lit(size))),
            )
        ),
    ).when(F.size(ws) > 0, F.array(F.concat_ws(" ", ws))).otherwise(F.array().cast("array<string>"))
    return bound(words(fold(text)), from_words)
