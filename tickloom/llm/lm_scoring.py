"""Scoring by a weighted backoff automaton over smoothed n-grams.

The model is a bigram model with a Dirichlet prior: with c(h w) for a pair, c(h) for a history and
the smoothed unigram p(w),

    p(w | h) = (c(h w) + MU * p(w)) / (c(h) + MU),      p(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)).

As an automaton: a state for every word, one for the start of a text and one for the empty
history. A seen pair is an arc out of the state of its first word, with log10 p(w | h) as its
weight; every state has a failure arc to the empty history, with log10 (MU / (c(h) + MU)); there
every word has an arc. Reading a text from left to right carries the state and adds up weights.

The automaton of a large corpus fits into no one machine, so each block of documents gets the part
that its texts can reach:

1. Documents are dealt to blocks by a hash. A block sends its distinct words and pairs, with their
   number in training documents, to buckets of hashes, as packed arrays.
2. A bucket adds up the counts over all blocks and sends back to each block the totals of what it
   sent, in the same order. A word or pair that a third of all texts use arrives once per block.
3. A block builds its part of the automaton and traverses all its texts in step.

Words are told apart by 64 bits of a hash, pairs by 40 bits within their bucket.

Defined results for odd input: a NULL or empty text is the end token alone; a NULL doc_id counts as
the empty text in the choice of training documents (its remainder is 0, so it is held out); equal
rows are scored one by one; without training documents N and V are 0; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import text as tx
from tickloom.llm.scratch import written

MU = 20.0
ADDED = 0.1  # to each count of a word
FOLDS = 10  # of which one is held out
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 8 << 20

END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0x0FEDCBA987654321)
_LOW = np.uint64((1 << 40) - 1)


def held_out(doc_id):
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text) % FOLDS == 0


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """Word hashes of each text, by block; the text itself is what is shuffled."""
    dealt = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text"),
    ).repartition(blocks, "block")
    hashes = F.transform(tx.words(tx.fold(F.col("text"))), lambda w: F.xxhash64(w))
    return dealt.select(
        "block", "doc_id", held_out(F.col("doc_id")).alias("held_out"), hashes.alias("words")
    )


class Tokens:
    """The texts of a block as one row of tokens, and its distinct words and pairs."""

    def __init__(self, table: pa.Table) -> None:
        table = table.combine_chunks()
        lists = table.column("words").combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = lists.chunk(0)
        self.doc_id = table.column("doc_id")
        self.held_out = np.array(table.column("held_out").to_pylist(), bool)
        ends = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.to_numpy()[ends[0] : ends[-1]].view(np.uint64)
        sizes = np.diff(ends)
        self.sizes = sizes + 1
        self.starts = self.sizes.cumsum() - self.sizes
        total = int(self.sizes.sum())
        last = np.zeros(total, bool)
        last[self.starts + sizes] = True
        tokens = np.full(total, END, np.uint64)
        tokens[~last] = flat
        self.words, ids = np.unique(tokens, return_inverse=True)
        self.ids = ids.astype(np.int64)
        # The history of each token; the start of a text is numbered behind all words.
        before = np.empty(total, np.int64)
        before[1:] = self.ids[:-1]
        before[self.starts] = len(self.words)
        self.keys, self.pair_of = np.unique(
            before * len(self.words) + self.ids, return_inverse=True
        )
        names = np.append(self.words, START)
        first, second = names[self.keys // len(self.words)], self.words[self.keys % len(self.words)]
        h = (first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        h = (h + second) * np.uint64(0xBF58476D1CE4E5B9)
        self.pairs = h ^ (h >> np.uint64(29))
        self.training = np.repeat(~self.held_out, self.sizes)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each word and each pair is in training documents."""
        ids, pairs = self.ids[self.training], self.pair_of[self.training]
        return (
            np.bincount(ids, minlength=len(self.words)),
            np.bincount(pairs, minlength=len(self.pairs)),
        )


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


_SENT = "bucket int, block int, words binary, word_counts binary, low binary, high binary, pair_counts binary"
_SENT_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int32())]
    + [(c, pa.binary()) for c in ("words", "word_counts", "low", "high", "pair_counts")]
)


def _small(counts: np.ndarray) -> bytes:
    """Counts in one byte each where they fit, else in eight; the first byte tells."""
    fits = not len(counts) or counts.max() < 256
    return (b"\1" + counts.astype(np.uint8).tobytes()) if fits else (
        b"\x08" + counts.astype("<i8").tobytes()
    )


def _counts(data: bytes) -> np.ndarray:
    kind = np.uint8 if data[:1] == b"\1" else np.dtype("<i8")
    return np.frombuffer(data, kind, offset=1).astype(np.int64)


def _send(buckets: int):
    def send(table: pa.Table) -> pa.Table:
        tokens = Tokens(table)
        of_words, of_pairs = tokens.counts()
        order = np.argsort(tokens.pairs, kind="stable")
        pairs, of_pairs = tokens.pairs[order], of_pairs[order]
        cut_words = np.searchsorted(_bucket_of(tokens.words, buckets), np.arange(buckets + 1))
        cut_pairs = np.searchsorted(_bucket_of(pairs, buckets), np.arange(buckets + 1))
        block = table.column("block")[0].as_py()
        rows = []
        for b in range(buckets):
            w = slice(cut_words[b], cut_words[b + 1])
            p = slice(cut_pairs[b], cut_pairs[b + 1])
            low = pairs[p] & _LOW
            rows.append(
                {
                    "bucket": b,
                    "block": block,
                    "words": tokens.words[w].tobytes(),
                    "word_counts": _small(of_words[w]),
                    "low": (low & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                    "high": (low >> np.uint64(32)).astype(np.uint8).tobytes(),
                    "pair_counts": _small(of_pairs[p]),
                }
            )
        return pa.Table.from_pylist(rows, _SENT_SCHEMA)

    return send


_TOTALS = "bucket int, block int, word_counts binary, pair_counts binary, n bigint, v bigint"
_TOTALS_SCHEMA = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int32()), ("word_counts", pa.binary())]
    + [("pair_counts", pa.binary()), ("n", pa.int64()), ("v", pa.int64())]
)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list, np.ndarray]:
    """Totals for each list of keys, and of every distinct key."""
    flat = np.concatenate(keys)
    distinct, place = np.unique(flat, return_inverse=True)
    totals = np.zeros(len(distinct), np.int64)
    np.add.at(totals, place, np.concatenate(counts))
    ends = np.cumsum([len(k) for k in keys])[:-1]
    return np.split(totals[place], ends), totals


def _total(table: pa.Table) -> pa.Table:
    """Add up one bucket; the first row also says how many tokens and distinct words it has."""
    rows = table.to_pylist()
    words, all_words = _summed(
        [np.frombuffer(r["words"], np.uint64) for r in rows],
        [_counts(r["word_counts"]) for r in rows],
    )
    pair_keys = [
        np.frombuffer(r["low"], np.uint32).astype(np.uint64)
        | np.frombuffer(r["high"], np.uint8).astype(np.uint64) << np.uint64(32)
        for r in rows
    ]
    pairs, _ = _summed(pair_keys, [_counts(r["pair_counts"]) for r in rows])
    out = [
        {
            "bucket": r["bucket"],
            "block": r["block"],
            "word_counts": _small(w),
            "pair_counts": _small(p),
            "n": int(all_words.sum()) if i == 0 else 0,
            "v": int((all_words > 0).sum()) if i == 0 else 0,
        }
        for i, (r, w, p) in enumerate(zip(rows, words, pairs))
    ]
    return pa.Table.from_pylist(out, _TOTALS_SCHEMA)


class Automaton:
    """The part of the automaton that the texts of a block can reach.

    State w is the history of that one word; one more state is the start of a text; the last is
    the empty history.
    """

    def __init__(self, tokens: Tokens, of_words, of_pairs, n: int, v: int, n_docs: int) -> None:
        size = len(tokens.words)
        probability = (of_words + ADDED) / (n + ADDED * (v + 1))
        self.size, self.start = size, size
        self.unigram = np.log10(probability)
        history = np.append(of_words, n_docs)
        self.failure = np.log10(MU / (history + MU))
        seen = of_pairs > 0
        self.arcs = tokens.keys[seen]  # state * size + word, in order
        state, word = self.arcs // size, self.arcs % size
        self.weights = np.log10(
            (of_pairs[seen] + MU * probability[word]) / (history[state] + MU)
        )

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word in each of several states: the states after it, and the weights."""
        key = state * self.size + word
        at = np.searchsorted(self.arcs, key)
        at[at == len(self.arcs)] = 0
        weight = self.failure[state] + self.unigram[word]
        if len(self.arcs):
            there = self.arcs[at] == key
            weight[there] = self.weights[at[there]]
        return word, weight

    def traverse(self, tokens: Tokens) -> np.ndarray:
        """Log probabilities of all texts, read from left to right in step."""
        order = np.argsort(-tokens.sizes, kind="stable")
        starts, sizes = tokens.starts[order], tokens.sizes[order]
        total = np.zeros(len(order))
        state = np.full(len(order), self.start, np.int64)
        for place in range(int(sizes.max(initial=0))):
            n = int(np.searchsorted(-sizes, -place, side="left"))  # texts that go on
            state[:n], weight = self.step(state[:n], tokens.ids[starts[:n] + place])
            total[:n] += weight
        out = np.empty(len(order))
        out[order] = total
        return out


_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _score(n: int, v: int, n_docs: int):
    def score(docs: pa.Table, totals: pa.Table) -> pa.Table:
        tokens = Tokens(docs)
        rows = sorted(totals.to_pylist(), key=lambda r: r["bucket"])
        of_words = np.concatenate([_counts(r["word_counts"]) for r in rows])
        order = np.argsort(tokens.pairs, kind="stable")
        of_pairs = np.empty(len(order), np.int64)
        of_pairs[order] = np.concatenate([_counts(r["pair_counts"]) for r in rows])
        automaton = Automaton(tokens, of_words, of_pairs, n, v, n_docs)
        base = np.add.reduceat(automaton.unigram[tokens.ids], tokens.starts)
        known = np.add.reduceat((of_words > 0)[tokens.ids].astype(np.int64), tokens.starts)
        return pa.table(
            {
                "doc_id": tokens.doc_id,
                "held_out": tokens.held_out,
                "n_tokens": tokens.sizes,
                "n_known": known,
                "train_tokens": np.full(len(known), n, np.int64),
                "base_score": base,
                "score": automaton.traverse(tokens),
            }
        )

    return score


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and score all of them."""
    size = docs.agg(
        F.sum(F.octet_length("text")).alias("b"),
        F.count_if(~held_out(F.col("doc_id"))).alias("n"),
    ).first()
    blocks = max(1, math.ceil((size["b"] or 0) / BLOCK_BYTES))
    buckets = max(1, math.ceil((size["b"] or 0) / BUCKET_BYTES))
    dealt = _dealt(docs, blocks)
    totals = written(
        dealt.groupBy("block")
        .applyInArrow(_send(buckets), _SENT)
        .groupBy("bucket")
        .applyInArrow(_total, _TOTALS),
        "counts",
    )
    whole = totals.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return (
        dealt.groupBy("block")
        .cogroup(totals.groupBy("block"))
        .applyInArrow(_score(whole["n"] or 0, whole["v"] or 0, size["n"]), _SCORES)
    )
