"""Quality rules: a table of thresholds, compiled into one projection.

Every rule compares two counts of a text, so no rule depends on rounding. The counts are worked
out in one pass over a row from its words and lines, by built-in functions only.

Defined results for odd input: a NULL or empty text, and one of white space only, has all counts
0 and fails; a NULL in any other column is carried along; repeated rows are judged one by one;
an empty table gives an empty result; columns of the input that have the name of a count are
replaced by it in ``measure`` and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import text as tx
from tickloom.llm.columns import carried, restored

REPEAT_WINDOW = 5

# Frequent function words of the four languages, in lower case.
STOP_WORDS = tuple(
    """
    the of and to in is that for with on be this as are was by an at from or it not have
    le la les de des du et un une que en est pour dans qui sur par au avec pas
    der die das und den von zu mit ist ein eine dem des auf für im nicht als
    el los las y del se por con para una su lo como más
    """.split()
)


@dataclass(frozen=True)
class Rule:
    """A text of ``from_words`` words or more passes if low * of <= 100 * count <= high * of."""

    count: str
    of: str
    low: int = 0
    high: int | None = None
    from_words: int = 0

    def passes(self) -> Column:
        scaled, of = F.col(self.count) * 100, F.col(self.of)
        ok = scaled >= self.low * of
        if self.high is not None:
            ok = ok & (scaled <= self.high * of)
        return (F.col("n_words") < self.from_words) | ok


# Limits in hundredths.
RULES = (
    Rule("word_chars", "n_words", low=200, high=1500),  # mean length of a word
    Rule("n_symbols", "n_words", high=10),
    Rule("n_letter_words", "n_words", low=60),
    Rule("n_stop_words", "n_words", low=2, from_words=40),
    Rule("n_dup_lines", "n_lines", high=70),
)
BASE_WORDS = 10
BASE_REPEATS = Rule("n_repeat_words", "n_words", high=20)

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_stop_words",
    "n_letter_words",
)


def _windows(ws: Column, of) -> Column:
    last = F.size(ws) - REPEAT_WINDOW
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), of)).otherwise(F.array())


def _covered(positions: Column) -> Column:
    """Words covered by windows at these ascending positions."""
    steps = F.transform(
        positions,
        lambda p, i: F.least(
            F.coalesce(F.get(positions, i + 1) - p, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)
        ),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def _repeat_words(ws: Column) -> Column:
    """Words in windows that occur twice or more.

    Hashes tell most texts free of repeats; only where two agree are the windows themselves
    sorted, so equal hashes of different windows do no harm.
    """
    hashes = _windows(
        ws, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(REPEAT_WINDOW)])
    )
    # Two different texts of a window never join to the same string: words hold no space.
    placed = F.array_sort(
        _windows(
            ws,
            lambda i: F.struct(
                F.concat_ws(" ", F.slice(ws, i + 1, F.lit(REPEAT_WINDOW))).alias("w"),
                i.alias("p"),
            ),
        )
    )

    def repeated(sorted_windows: Column) -> Column:
        same = lambda a, b: F.coalesce(a["w"] == b["w"], F.lit(False))
        twice = F.filter(
            sorted_windows,
            lambda x, i: same(x, F.get(sorted_windows, i - 1))
            | same(x, F.get(sorted_windows, i + 1)),
        )
        return tx.bound(F.array_sort(F.transform(twice, lambda x: x["p"])), _covered)

    return tx.bound(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            tx.bound(placed, repeated)
        ),
    )


def _counts(content: Column) -> Column:
    """All counts of a text as one struct."""
    stop = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))])
    lines = F.filter(F.split(content, "\n"), lambda line: line.rlike(tx.WORD))
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    without = F.regexp_replace(content, "[#*$%&|<>]", "")
    return tx.bound(
        tx.words(content),
        lambda ws: F.struct(
            count(F.size(ws)).alias("n_words"),
            count(
                F.aggregate(ws, F.lit(0), lambda total, w: total + F.char_length(w))
            ).alias("word_chars"),
            count(F.char_length(content) - F.char_length(without)).alias("n_symbols"),
            count(tx.bound(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))).alias(
                "n_dup_lines"
            ),
            count(_repeat_words(ws)).alias("n_repeat_words"),
            count(F.size(lines)).alias("n_lines"),
            count(F.size(F.filter(ws, lambda w: F.array_contains(stop, w)))).alias("n_stop_words"),
            count(F.size(F.filter(ws, lambda w: w.rlike(r"\p{L}")))).alias("n_letter_words"),
        ),
    )


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents with the counts of their texts, ``base_failed`` and ``kept``."""
    counts = _counts(F.coalesce(F.col("text"), F.lit(""))).alias("_counts")
    counted = docs.select(*carried(docs), counts).select("*", "_counts.*")
    failed = (F.col("n_words") < BASE_WORDS) | ~BASE_REPEATS.passes()
    verdict = ~failed
    for rule in rules:
        verdict = verdict & rule.passes()
    added = [*COUNTS, "base_failed", "kept"]
    return counted.select(
        *restored(docs, added), *COUNTS, failed.alias("base_failed"), verdict.alias("kept")
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass all rules, with the columns they came with."""
    rows = docs.select(*carried(docs), F.col("text").alias("text"))
    good = measure(rows, rules).where("kept")
    return good.select(*restored(docs))
