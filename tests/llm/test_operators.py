"""The training-data operators against brute force, on a table with every odd case."""

import collections
import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tickloom.llm.queries")

from tickloom.llm import (  # noqa: E402
    decontaminate,
    encode,
    jaccard_join,
    lm_scoring,
    mixing,
    quality,
    sharding,
    sql,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
)
from tickloom.llm import shingles as by_arrays  # noqa: E402
from tickloom.llm import text as text_module  # noqa: E402
from tickloom.llm.elias_fano import EliasFano  # noqa: E402
from tickloom.llm.encode import Encoder  # noqa: E402
from tickloom.llm.queries import tokenizer_file  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for columns of their own.
CLASHING = "size bigint, shard string, kept int, n_words string, label int, `a.b` int, hash int, s int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    ws = words((text or "").translate(LOWER))
    if not ws:
        return frozenset()
    if len(ws) < 5:
        return frozenset([tuple(ws)])
    return frozenset(tuple(ws[i : i + 5]) for i in range(len(ws) - 4))


def prose(rng, n):
    return " ".join(rng.choice(("the", "of", "and", "to")) if rng.random() < 0.3 else
                    "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
                    for _ in range(n))


def odd_rows():
    rng = random.Random(3)
    base = prose(rng, 90)
    passage = prose(rng, 70)
    near = base.split()
    near[40] = "changed"
    very_long = prose(rng, 6000)
    texts = [
        None, "", " \n\t ", "one", "one two three", "ONE two Three", base, base, base.upper(),
        " ".join(near), base + " tail of it", prose(rng, 60) + " " + passage + "\n" + prose(rng, 40),
        prose(rng, 30) + " " + passage, passage, very_long, very_long + " end",
        "word " * 300, "a\n" * 50 + "b", "x" * 3000, "été Éclat naïve 日本語 " * 12,
        "<|endoftext|> literal  double  space end ", "#### $$$ |||| <<>> ###", base + "\r\n" + base,
        prose(rng, 12), prose(rng, 50),
    ]
    rows = [
        (i, t, rng.choice(("en", None)), rng.choice(("a", "b", "", None)), None if i % 3 else 5)
        for i, t in enumerate(texts)
    ]
    rows += [rows[6], rows[6], (None, base, None, None, None), (None, passage, "x", "b", 1)]
    rows += [(6, passage, "x", "a", 1), (rows[9][0], None, None, "b", None), (None, None, None, None, None)]
    rows += [(1000 + i, prose(rng, rng.randrange(20, 120)), "en", "ab"[i % 2], i) for i in range(40)]
    return rows


ROWS = odd_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(spark):
    extra = (1, "x", 2, "y", 3, 4, 5, 6)
    return spark.createDataFrame([r + extra for r in ROWS], f"{SCHEMA}, {CLASHING}")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(0, ROWS[13][1]), (1, None), (2, ""), (3, "one two"), (4, "One two three"), (None, ROWS[13][1]),
            (5, " ".join(ROWS[6][1].split()[:30])), (5, " ".join(ROWS[6][1].split()[:30])), (6, "not there at all, is it")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def in_duck(tables, query):
    db = duckdb.connect()
    for name, (schema, rows) in tables.items():
        kinds = schema.replace("string", "varchar")
        db.execute(f"CREATE TABLE {name} ({kinds})")
        db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    return db.execute(query).fetchall()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def documents_sql():
    return {"documents": (SCHEMA, ROWS)}


# ---- quality ---------------------------------------------------------------------------------

QUALITY = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_quality_equals_sql(docs):
    got = quality.measure(docs).select(*QUALITY).collect()
    want = in_duck(documents_sql(), f"SELECT {', '.join(QUALITY)} FROM ({sql.quality_sql()})")
    assert ordered(got) == ordered(want)


def test_repeat_words_equal_a_plain_count(docs):
    def count(text):
        ws = words(text)
        grams = [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
        often = collections.Counter(grams)
        return len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)})

    got = quality.measure(docs).select("doc_id", "n_repeat_words").collect()
    assert ordered(got) == ordered((r[0], count(r[1])) for r in ROWS)


def test_quality_is_one_projection_without_python(docs):
    plan = quality.measure(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_quality_carries_and_replaces_columns(clashing, empty):
    out = quality.measure(clashing)
    assert out.columns.count("n_words") == 1 and "a.b" in out.columns
    kept = quality.keep_good(clashing)
    assert kept.columns == clashing.columns and {r["n_words"] for r in kept.collect()} == {"y"}
    assert quality.measure(empty).count() == 0


# ---- decontamination ---------------------------------------------------------------------------


def item_rows(items):
    return [tuple(r) for r in items.collect()]


def contained(rows, benchmark):
    out = []
    for doc_id, text, *_ in rows:
        mine = shingles(text)
        for item_id, item in benchmark:
            want = shingles(item)
            if want and 100 * len(want & mine) >= 75 * len(want):
                out.append((doc_id, item_id, len(want), len(want & mine)))
    return out


def test_contaminated_equals_brute_force_and_sql(docs, items):
    got = ordered(decontaminate.contaminated(docs, items).collect())
    assert got == ordered(contained(ROWS, item_rows(items))) and got
    tables = documents_sql() | {"benchmark": ("item_id bigint, text string", item_rows(items))}
    query = f"SELECT doc_id, item_id, n_item_shingles, n_shared FROM ({sql.contaminated_sql()})"
    assert got == ordered(in_duck(tables, query))


def test_keep_clean(docs, clashing, empty, items):
    bad = {(d, t) for d, t, *_ in ROWS if contained([(d, t)], item_rows(items))}
    want = [r for r in ROWS if (r[0], r[1]) not in bad]
    assert ordered(decontaminate.keep_clean(docs, items).collect()) == ordered(want)
    out = decontaminate.keep_clean(clashing, items)
    assert out.columns == clashing.columns and out.count() == len(want)
    assert decontaminate.keep_clean(empty, items).count() == 0
    assert decontaminate.keep_clean(docs, items.where("false")).count() == len(ROWS)


def test_sketches_shuffle_where_they_are_too_many(docs, items, monkeypatch):
    want = ordered(decontaminate.contaminated(docs, items).collect())
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert ordered(decontaminate.contaminated(docs, items).collect()) == want


# ---- Jaccard join --------------------------------------------------------------------------------


def components(rows):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


def named_components(rows):
    sets, label = components(rows)
    ids = collections.defaultdict(list)
    for i, r in enumerate(rows):
        ids[label[i]].append(r[0])
    name = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(r[0], len(sets[i]), name[label[i]]) for i, r in enumerate(rows)]


def test_classes_equal_brute_force_and_sql(docs):
    got = ordered(jaccard_join.classes(docs).collect())
    assert got == ordered(named_components(ROWS))
    query = f"SELECT doc_id, n_shingles, component_id FROM ({sql.classes_sql()})"
    assert got == ordered(in_duck(documents_sql(), query))


def test_families_whose_links_are_chains(spark):
    """Members far from each other are linked only through others; some are just not linked."""
    rng = random.Random(11)
    rows, n = [], 0
    for family in range(12):
        ws = prose(rng, 60 + 10 * family).split()
        for _ in range(15):
            rows.append((n, " ".join(ws), None, None, None))
            n += 1
            ws = list(ws)
            for _ in range(rng.randrange(1, 4)):
                ws[rng.randrange(len(ws))] = f"w{rng.randrange(10**6)}"
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = ordered(jaccard_join.classes(frame).collect())
    want = ordered(named_components(rows))
    assert got == want and len({r[2] for r in want}) < len(rows)


def test_divide_skip_with_fewer_long_lists(docs, monkeypatch):
    want = ordered(jaccard_join.classes(docs).collect())
    monkeypatch.setattr(jaccard_join, "OCCURRENCES", 4)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
    assert ordered(jaccard_join.classes(docs).collect()) == want


def test_keep_one(docs, clashing, empty):
    sets, label = components(ROWS)
    best = {}
    for i, r in enumerate(ROWS):
        if sets[i]:
            best.setdefault(label[i], []).append(r[0])
    kept = jaccard_join.keep_one(docs).collect()
    with_words = [r for r in kept if shingles(r["text"])]
    smallest = [min((x for x in v if x is not None), default=None) for v in best.values()]
    assert sorted(map(repr, (r["doc_id"] for r in with_words))) == sorted(map(repr, smallest))
    assert len(kept) - len(with_words) == sum(not s for s in sets)
    assert jaccard_join.keep_one(clashing).columns == clashing.columns
    assert jaccard_join.keep_one(empty).count() == 0
    assert jaccard_join.classes(empty).count() == 0


# ---- suffixes --------------------------------------------------------------------------------------


def stripped(rows):
    first = {}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        rank = math.inf if doc_id is None else doc_id
        for p in range(len(data) - 49):
            key = data[p : p + 50]
            first[key] = min(first.get(key, math.inf), rank)
    out = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        rank = math.inf if doc_id is None else doc_id
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < rank:
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [5_000, 3])
def test_strip_repeats_equals_brute_force(docs, empty, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_DOCS", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "PORTION", 500)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 30_000)
    got = suffix_dedup.strip_repeats(docs)
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    assert ordered(got) == ordered(stripped(ROWS))
    assert suffix_dedup.strip_repeats(empty).count() == 0


def test_strip_repeats_leaves_no_shuffle_of_the_search_behind(docs):
    plan = suffix_dedup.strip_repeats(docs)._jdf.queryExecution().toString()
    # Anchors and segments were shuffled by plans of their own, whose files are gone.
    assert "FlatMapGroupsInArrow" not in plan and "_compare" not in plan


def test_multikey_quicksort_groups():
    rng = random.Random(2)
    data = bytes(rng.choice(b"ab") for _ in range(40)) * 6 + bytes(rng.choice(b"ab") for _ in range(300))
    at = np.arange(len(data) - 50)
    members, cuts = suffix_dedup.equal_suffixes(data, at)
    got = {frozenset(g.tolist()) for g in np.split(members, cuts[1:])} if len(members) else set()
    want = collections.defaultdict(set)
    for p in at.tolist():
        want[data[p : p + 50]].add(p)
    assert got == {frozenset(g) for g in want.values() if len(g) > 1}


# ---- passages ------------------------------------------------------------------------------------------


def test_repeated_passages_are_found_and_others_left(docs, empty):
    got = substring_dedup.repeated_passages(docs).collect()
    # Whichever of the documents with the passage is named as its source.
    assert {7, 8, 9, 10, 11, 12, 13, 15, 22, None} <= {r["doc_id"] for r in got}
    for r in got:
        assert r["end_word"] - r["start_word"] >= 50 and r["similarity"] >= 0.75
    touched = {r["doc_id"] for r in got} - {None}
    assert not touched & {r[0] for r in ROWS if r[0] is not None and r[0] >= 1000}
    assert not touched & {0, 1, 2, 3, 4, 5, 23, 24}
    assert substring_dedup.repeated_passages(empty).count() == 0


def test_compact_windows_are_the_wide_nodes_of_the_tree():
    rng = np.random.default_rng(4)
    values = rng.integers(1, 60, 400).astype(np.uint64) << np.uint64(30)
    breaks = np.array([0, 90, 91, 260, 399])
    got = {tuple(w) for w in substring_dedup.compact_windows(values, breaks).tolist()}
    flat = values.astype(int).tolist()
    for b in breaks:
        flat[b] = 0
    want = set()
    for c, v in enumerate(flat):
        if v:
            lo, hi = c, c
            while lo > 0 and flat[lo - 1] > v:
                lo -= 1
            while hi < len(flat) - 1 and flat[hi + 1] >= v:
                hi += 1
            if hi - lo + 1 >= substring_dedup.LEAST:
                want.add((lo, c, hi))
    assert got == want and got


def longest_stretches(b, a):
    """Stretches of b that begin and end with tokens of their partner in a, none within another."""
    least, found = substring_dedup.LEAST, []
    for i in range(len(b) - least + 1):
        for j in range(len(b), i + least - 1, -1):
            if any(x <= i and j <= y for x, y in found):
                break
            part = set(b[i:j])
            if not similar_part(part, b[i], b[j - 1], a, least):
                continue
            found.append((i, j))
            break
    return found


def similar_part(part, first, last, a, least):
    for u in range(len(a) - least + 1):
        shared, theirs = 0, set()
        for v in range(u, len(a)):
            if a[v] not in theirs:
                theirs.add(a[v])
                shared += a[v] in part
            if v + 1 - u >= least and {first, last} <= theirs and a[u] in part and a[v] in part:
                if shared * 4 >= 3 * (len(part) + len(theirs) - shared):
                    return True
    return False


def stretches(b, a):
    b, a = (substring_dedup.Text(np.array(x, np.uint64)) for x in (b, a))
    return [p[:2] for p in substring_dedup.passages(b, a)]


def test_stretches_equal_brute_force(monkeypatch):
    monkeypatch.setattr(substring_dedup, "_overlaps", lambda b, a: [(0, len(b.tokens))])
    rng = random.Random(8)
    fresh = lambda n: [rng.getrandbits(60) for _ in range(n)]
    for n in range(12):
        same = fresh(rng.randrange(46, 66))
        cut, other = rng.randrange(len(same)), same[:]
        if n % 4 == 0:
            other[cut:cut] = fresh(rng.randrange(12, 26))
        elif n % 4 == 1:
            other[cut : cut + 9] = fresh(rng.randrange(9))
        elif n % 4 == 2:
            other = same[cut:] + fresh(4) + same[:cut]
        else:
            other[cut:cut] = same[: rng.randrange(20)]
        a, b = fresh(9) + same + fresh(7), fresh(8) + other + fresh(11)
        if n % 2:
            a, b = b, a
        assert stretches(b, a) == longest_stretches(b, a)


def test_an_insertion_in_either_document_keeps_the_passage():
    rng = np.random.default_rng(5)
    same = rng.integers(1, 1 << 60, 90).tolist()
    longer = same[:41] + rng.integers(1, 1 << 60, 16).tolist() + same[45:86]
    assert stretches(longer, same[:86]) and stretches(same[:86], longer)


def test_parts_of_a_passage_in_other_documents_hide_no_holder(spark):
    rng, rows, holders = random.Random(9), [], []
    for case in range(40):
        passage = prose(rng, 60).split()
        parts = [passage[:40], passage[20:]]
        for kind in (*parts, passage, *parts, passage):
            if kind is passage:
                holders.append((case, len(rows)))
            text = prose(rng, 40).split() + kind + prose(rng, 40).split()
            rows.append((len(rows), " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r["source_id"], r["doc_id"]) for r in substring_dedup.repeated_passages(docs).collect()}
    pairs = {(a, b) for (case, a), (other, b) in zip(holders[::2], holders[1::2])}
    assert pairs <= got


def test_windows_are_made_once_a_text_and_only_where_a_passage_may_be(monkeypatch):
    built = []

    class Seen(substring_dedup.Text):
        def __init__(self, tokens):
            built.append(len(tokens))
            super().__init__(tokens)

    monkeypatch.setattr(substring_dedup, "Text", Seen)
    rng = random.Random(14)
    fresh = lambda n: [rng.getrandbits(60) for _ in range(n)]
    same = fresh(80)
    x, y, z = fresh(30) + same + fresh(40), fresh(10) + same + fresh(50), fresh(7) + same
    pairs = [(x, y), (z, y), (x, z), (x, x), (x, fresh(70) + same[:30]), (fresh(20), x), (y, z)]
    keys = pa.array(range(len(pairs)), pa.int64())
    columns = [keys, keys, keys, *[pa.array([p[k] for p in pairs], pa.list_(pa.int64())) for k in (0, 1)]]
    batch = pa.RecordBatch.from_arrays(columns, ["b", "b_text", "a", "mine", "theirs"])
    (got,) = substring_dedup._verify(iter([batch]))
    found = {r["b"]: (r["start_word"], r["end_word"], r["source_start"]) for r in got.to_pylist()}
    assert found == {0: (30, 114, 10), 1: (7, 91, 10), 2: (30, 114, 7), 3: (0, 154, 0), 6: (10, 94, 7)}
    assert sorted(built) == sorted(map(len, (x, y, z)))


def test_open_signatures_equal_the_plain_rule():
    rng = np.random.default_rng(15)
    for n in (100, 300, 900):
        text = substring_dedup.Text(rng.integers(1, 1 << 63, n).astype(np.uint64))
        sigs = [w[3] for f in text.windows for w in f]
        shared = {h: bool(rng.random() < 0.5) for h in sigs if rng.random() < 0.6}
        covered = np.repeat(rng.random(n // 50) < 0.5, 50)
        want, active = set(), []
        for w in sorted((lo, hi, c, h) for f in text.windows for lo, c, hi, h in f if h in shared):
            active = [x for x in active if x[1] >= w[0] + substring_dedup.LEAST - 1] + [w]
            if len({x[3] & 7 for x in active}) >= substring_dedup.FEWEST and any(shared[x[3]] for x in active):
                want.update(x[3] for x in active if not all(covered[y[2]] for y in active))
        assert substring_dedup.open_signatures(text, shared, covered) == want
        assert substring_dedup.open_signatures(text, {}, covered) == set()


def sent_windows(texts, limit, monkeypatch):
    """What a bucket gets of some lists of tokens, and what it gives for them."""
    monkeypatch.setattr(substring_dedup, "_ROWS_OUT", limit)
    keys = pa.array(range(len(texts)), pa.int64())
    columns = [keys, keys, pa.array(texts, pa.list_(pa.int64()))]
    sent = list(substring_dedup._send(1)(iter([pa.RecordBatch.from_arrays(columns, ["i", "t", "x"])])))
    tracemalloc.start()
    out = list(substring_dedup._pair_up(iter(sent)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return sum(len(s.as_py()) // 8 for batch in sent for s in batch.column("sigs")), out, peak


def test_a_bucket_is_paired_up_in_little_memory_and_given_in_small_parts(monkeypatch):
    rng = random.Random(21)
    stock = [[rng.getrandbits(60) for _ in range(60)] for _ in range(200)]
    texts = [[t for _ in range(8) for t in rng.choice(stock)] for _ in range(600)]
    n, out, peak = sent_windows(texts, 700, monkeypatch)
    assert len(out) > 10 and max(b.num_rows for b in out) <= 700
    assert peak < 600 * n


def test_pairs_and_shared_windows_of_a_bucket_equal_brute_force(monkeypatch):
    rng = random.Random(22)
    stock = [[rng.getrandbits(60) for _ in range(60)] for _ in range(12)]
    texts = [[t for _ in range(rng.randrange(1, 5)) for t in rng.choice(stock)] for _ in range(30)]
    _, out, _ = sent_windows(texts, 50, monkeypatch)
    rows = [r for b in out for r in b.to_pylist()]
    windows = collections.defaultdict(set)
    for d, tokens in enumerate(texts):
        for f in substring_dedup.Text(np.array(tokens, np.uint64)).windows:
            for lo, c, hi, h in f:
                windows[h].add((d, lo, c, hi))
    pairs, shared = collections.Counter(), set()
    for h, some in windows.items():
        docs = sorted({w[0] for w in some})
        for i in range(1, len(docs)):
            for a in (docs[0], docs[i - 1]):
                pairs[docs[i], a] |= 1 << (h & 7)
        if len(docs) > 1:
            shared |= {(h, *w, len(docs) > 3) for w in some}
    assert {(r["b"], r["a"]): r["functions"] for r in rows if r["a"] is not None} == pairs
    lone = [r for r in rows if r["a"] is None]
    crowded = substring_dedup._CROWDED
    got = [(r["sig"] % (1 << 64), r["b"], r["lo"], r["c"], r["hi"], r["functions"] == crowded) for r in lone]
    assert len(got) == len(shared) and set(got) == shared
    # Documents that go on from batch to batch come out whole.
    lone.sort(key=lambda r: (r["b"], r["b_text"], r["sig"]))
    names = ["b", "b_text", "sig", "lo", "c", "hi"]
    columns = [pa.array([r[k] for r in lone], pa.int64() if i < 3 else pa.int32()) for i, k in enumerate(names)]
    columns.append(pa.array([r["functions"] == crowded for r in lone]))
    batch = pa.RecordBatch.from_arrays(columns, [*names, "crowded"])
    parts = [batch.slice(i, 17) for i in range(0, len(lone), 17)]
    packed = [r for b in substring_dedup._by_document(iter(parts)) for r in b.to_pylist()]
    assert [r["b"] for r in packed] == sorted({r["b"] for r in lone})
    for r in packed:
        mine = [x for x in lone if x["b"] == r["b"]]
        assert np.frombuffer(r["sigs"], np.int64).tolist() == [x["sig"] for x in mine]
        assert np.frombuffer(r["spans"], np.int32).tolist() == [v for x in mine for v in (x["lo"], x["hi"])]
        assert np.frombuffer(r["middles"], np.int32).tolist() == [x["c"] for x in mine]
        assert list(r["crowded"]) == [x["functions"] == crowded for x in mine]
        assert r["hot"] == any(r["crowded"])


def test_pairs_agree_whatever_the_order_of_their_signatures():
    rng = np.random.default_rng(24)
    same = rng.integers(1, 1 << 63, 200).astype(np.uint64)
    b, a = (substring_dedup.Text(np.append(same, rng.integers(1, 1 << 63, 90).astype(np.uint64))) for _ in "ba")
    order = np.argsort(a.sigs.view(np.int64))  # negative numbers first, as Spark sorts them
    spans = np.ascontiguousarray(b.rows[:, ::2].astype(np.int32))
    row = [[1], [2], [3], [4], [b.sigs.tobytes()], [spans.tobytes()], [a.sigs[order].tobytes()]]
    names = ["b", "b_text", "a", "a_text", "b_sigs", "b_spans", "a_sigs"]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in row], names)
    (got,) = substring_dedup._agree(iter([batch]))
    (r,) = got.to_pylist()
    assert list(zip(r["begins"], r["ends"])) == substring_dedup._overlaps(b, a) != []


def test_shingles_in_python_are_those_of_spark(spark):
    rng, texts = random.Random(23), ["", "a b c d", " A  b\tc\x0bd e\x0cF\u00a0g\u2003h \u0130 \u00c4 z "]
    texts += [" ".join(rng.choice(["x", "Y", "y", "zz", "\u00e9", "\u00c9"]) for _ in range(90)) for _ in range(5)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for t, (want,) in zip(texts, rows.select(text_module.shingle_sequence(F.col("text"))).collect()):
        got = substring_dedup._tokens(t.encode()).tolist()
        first = lambda xs: [xs.index(x) for x in xs]
        assert first(got) == first(want)


def test_shingles_by_arrays_are_those_of_spark(spark, monkeypatch):
    rng, sizes = random.Random(31), [1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 31, 32, 33, 64, 65, 100]
    word = lambda: "".join(rng.choice("abXYZ\u00e9\u65e5.") for _ in range(rng.choice(sizes)))
    texts = ["", "  ", "a b c d", "x " * 7, *(" ".join(word() for _ in range(rng.randrange(50))) for _ in range(40))]
    texts = [t + rng.choice(["", " ", "\t\n"]) for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    want = dict(rows.select("id", text_module.shingle_sequence(F.col("text"))).collect())
    keys = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([keys, keys, pa.array(texts)], ["id", "key", "text"])
    for size in (1 << 20, 700, 1):
        monkeypatch.setattr(by_arrays, "CHUNK_BYTES", size)
        parts = by_arrays.with_shingles(iter([batch.slice(0, 9), batch.slice(9)]))
        assert {r["id"]: r["tokens"] for b in parts for r in b.to_pylist()} == want


def test_buckets_of_signatures_are_of_even_size():
    rng = np.random.default_rng(33)
    tokens = pa.array([rng.integers(-(1 << 63), 1 << 63, 40_000).tolist()], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), tokens], ["i", "t", "x"])
    (sent,) = substring_dedup._send(20)(iter([batch]))
    sizes = [len(s.as_py()) // 8 for s in sent.column("sigs")]
    assert len(sizes) == 20 and max(sizes) < 2 * min(sizes)


def test_open_signatures_meet_earlier_holders_as_by_brute_force(monkeypatch):
    rng, fewest = random.Random(34), substring_dedup.FEWEST
    monkeypatch.setattr(substring_dedup, "_ROWS_OUT", 5)
    docs = [(rng.randrange(30), rng.getrandbits(62)) for _ in range(60)]
    sigs = [rng.getrandbits(60) - (1 << 59) for _ in range(40)]
    opened = {(d, s) for d in docs for s in rng.sample(sigs, rng.randrange(20))}
    holders = {(d, s) for d in docs[:40] for s in rng.sample(sigs, rng.randrange(20))}
    met = {(b, a): rng.randrange(1, 256) for b in docs for a in docs if a < b and rng.random() < 0.1}

    def table(rows, names):
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)], names)

    packed = []
    for rows, earlier in ((opened, False), (holders, True)):
        batch = table([(*d, s) for d, s in sorted(rows)], ["x", "text", "sig"])
        packed += substring_dedup._by_bucket(3, earlier)(iter([batch]))
    by_bucket = collections.defaultdict(list)
    for batch in packed:
        for i, bucket in enumerate(batch.column("bucket").to_pylist()):
            by_bucket[bucket].append(batch.slice(i, 1))
    parts = collections.defaultdict(list)
    rows = [x for some in by_bucket.values() for b in substring_dedup._meet(2)(iter(some)) for x in b.to_pylist()]
    known = table([(*b, *a, f) for (b, a), f in met.items()], ["b", "b_text", "a", "a_text", "functions"])
    rows += substring_dedup._met(known, 2).to_pylist()
    for r in rows:
        parts[r["part"]].append({n: r.get(n) for n in substring_dedup._ASKED_SCHEMA.names})
    got = [
        tuple(x.values())
        for some in parts.values()
        for b in substring_dedup._count(iter([pa.RecordBatch.from_pylist(some, substring_dedup._ASKED_SCHEMA)]))
        for x in b.to_pylist()
    ]
    want = set()
    for b in docs:
        for a in docs:
            now = {s & 7 for d, s in opened if d == b and (a, s) in holders}
            before = {f for f in range(8) if met.get((b, a), 0) >> f & 1}
            if a < b and now and len(now | before) >= fewest > len(before):
                want.add((*b, *a))
    assert len(got) == len(want) and set(got) == want and want


def test_stretches_of_repeated_lines_are_not_tried_again(monkeypatch):
    asked, call = [], substring_dedup._Bounds.__call__
    monkeypatch.setattr(substring_dedup._Bounds, "__call__", lambda *x: asked.append(1) or call(*x))
    rng = random.Random(35)
    line = [rng.getrandbits(60) for _ in range(70)]
    text, other = line * 12, line[:25] + [rng.getrandbits(60) for _ in range(30)] + line[30:] * 2
    b, a = (substring_dedup.Text(np.array(x, np.uint64)) for x in (text, other))
    substring_dedup.passages(b, a, [(0, len(text))])
    assert len(asked) < 10


def test_places_beyond_the_bits_of_a_piece(monkeypatch):
    rng = np.random.default_rng(6)
    tokens = rng.integers(1, 1 << 63, 2_000).astype(np.uint64)
    data = bytes(rng.integers(97, 123, 3_000).astype(np.uint8))
    whole, block = substring_dedup.Text(tokens).windows, suffix_dedup.Block([data, data[:500]])
    monkeypatch.setattr(substring_dedup, "_PLACE", np.uint64(255))
    monkeypatch.setattr(substring_dedup, "PIECE", 150, raising=False)
    monkeypatch.setattr(suffix_dedup, "_LOW", np.uint64(255))
    monkeypatch.setattr(suffix_dedup, "PIECE", 200, raising=False)
    assert substring_dedup.Text(tokens).windows == whole
    cut = suffix_dedup.Block([data, data[:500]])
    assert (cut.run_anchor == block.run_anchor).all() and (cut.run_lo == block.run_lo).all()


# ---- language model --------------------------------------------------------------------------------------


def test_scores_equal_brute_force(docs, empty):
    out = lm_scoring.score_documents(docs).collect()
    tokens = [words((r[1] or "").translate(LOWER)) + [None] for r in ROWS]
    held = [zlib.crc32(str(r[0]).encode() if r[0] is not None else b"") % 10 == 0 for r in ROWS]
    c, pairs, n_docs = collections.Counter(), collections.Counter(), 0
    for ws, out_ in zip(tokens, held):
        if not out_:
            c.update(ws)
            pairs.update(zip(["<start>"] + ws[:-1], ws))
            n_docs += 1
    n, v, mu = sum(c.values()), len(c), lm_scoring.MU
    p = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    want = []
    for r, ws, out_ in zip(ROWS, tokens, held):
        base = sum(math.log10(p(w)) for w in ws)
        score = sum(
            math.log10((pairs[h, w] + mu * p(w)) / ((n_docs if h == "<start>" else c[h]) + mu))
            for h, w in zip(["<start>"] + ws[:-1], ws)
        )
        want.append((r[0], out_, len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6), round(score, 6)))
    got = [tuple(r)[:5] + (round(r["base_score"], 6), round(r["score"], 6)) for r in out]
    assert ordered(got) == ordered(want)
    assert lm_scoring.score_documents(empty).count() == 0


def test_probabilities_of_a_state_add_up_to_one():
    rng = np.random.default_rng(1)
    v = 30
    c = rng.integers(0, 5, v)
    n = int(c.sum())
    p = (c + 0.1) / (n + 0.1 * (v + 1))
    pairs = rng.integers(0, 3, v)
    history = pairs.sum()
    mu = lm_scoring.MU
    unseen = 0.1 / (n + 0.1 * (v + 1))
    assert math.isclose(((pairs + mu * p) / (history + mu)).sum() + mu * unseen / (history + mu), 1.0)


def test_the_bigram_model_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = lm_scoring.score_documents(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


# ---- token counts and files ----------------------------------------------------------------------------------


def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file()).encode(text or "", add_special_tokens=False).ids


def test_token_files_round_trip(docs, empty, tmp_path):
    from tokenizers import Tokenizer

    path = str(tmp_path / "ids")
    files = token_files.write_token_files(docs, path, tokenizer_file())
    out = token_files.read_token_files(files).orderBy("start").collect()
    tok = Tokenizer.from_file(tokenizer_file())
    want = collections.Counter()
    for doc_id, text, *_ in ROWS:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [token_files.END_ID]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == want
    starts = [r["start"] for r in out]
    assert starts == list(np.cumsum([0] + [r["n_tokens"] for r in out])[:-1])
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in out]
    assert order == sorted(order)
    first = files.orderBy("shard").first()
    file = token_files.TokenFile(first["path"])
    got = np.concatenate([file.document(i) for i in range(len(file))])
    assert len(got) == first["n_ids"] and (got == np.fromfile(first["path"] + ".bin", file.dtype)).all()
    starts = np.cumsum([0] + [len(file.document(i)) for i in range(len(file))])
    assert [file.start(i) for i in range(len(file) + 1)] == starts.tolist()
    assert token_files.token_digest(empty, tokenizer_file()).count() == 0


def test_digest_selects_and_never_decodes_the_boundaries(spark, docs, tmp_path, monkeypatch):
    files = token_files.write_token_files(docs, str(tmp_path / "ids"), tokenizer_file()).collect()
    assert all(f["place"].startswith("file:") for f in files)
    monkeypatch.setattr(EliasFano, "values", None)
    monkeypatch.setattr(token_files, "BATCH", 7)
    rows = [r for f in files for b in token_files._digest(f["place"], 0) for r in b.to_pylist()]
    assert len(rows) == len(ROWS)
    want = collections.Counter((r[0], len(plain_ids(r[1])) + 1) for r in ROWS)
    assert collections.Counter((r["doc_id"], r["n_tokens"]) for r in rows) == want


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (1, 10**9), (1000, 3), (1000, 10**6), (700, 1)])
def test_elias_fano(n, most):
    values = np.cumsum(np.random.default_rng(n).integers(0, most, n))
    code, end = EliasFano.from_bytes(data := b"xy" + EliasFano.encode(values).to_bytes(), 2)
    assert end == len(data) and (code.values() == values.astype(np.uint64)).all()
    assert [code.select(i) for i in range(n)] == values.tolist()
    if n == 1000:
        limit = int(values[-1]) + 1
        assert (len(data) - 27) * 8 <= n * (3 + max(0, math.log2(limit / n))) + 64
    with pytest.raises(IndexError):
        code.select(n)


def test_token_counts_follow_edits(spark, docs, empty):
    edits = "array<struct<start:bigint,end:bigint,replacement:string>>"
    counted = token_counts.count_tokens(docs, tokenizer_file())
    assert ordered((r["doc_id"], r["n_tokens"]) for r in counted.collect()) == ordered(
        (r[0], len(plain_ids(r[1]))) for r in ROWS
    )
    change = F.expr(
        "CASE WHEN text IS NULL THEN NULL WHEN char_length(text) < 20 THEN "
        f"CAST(array(struct(0L, CAST(char_length(text) AS BIGINT), 'new text')) AS {edits}) ELSE "
        "CAST(array(struct(3L, 5L, NULL), struct(10L, 10L, ' put in'), struct(CAST(char_length(text) "
        f"AS BIGINT), CAST(char_length(text) AS BIGINT), ' at the end')) AS {edits}) END"
    )
    done = token_counts.apply_edits(counted.withColumn("edits", change), tokenizer_file()).collect()
    for r in done:
        assert r["n_tokens"] == len(plain_ids(r["text"]))
    long_ones = [r for r in done if r["text"] and len(r["text"]) > 20_000]
    assert long_ones and all(r["encoded_chars"] < 4_000 for r in long_ones)
    want = [None if t is None else "new text" if len(t) < 20 else t[:3] + t[5:10] + " put in" + t[10:] + " at the end"
            for _, t, *_ in ROWS]
    assert ordered((r["doc_id"], r["text"]) for r in done) == ordered((r[0], w) for r, w in zip(ROWS, want))
    assert token_counts.count_tokens(empty, tokenizer_file()).count() == 0


def test_edits_at_one_place_leave_leaves_short():
    encoder = Encoder(tokenizer_file())
    text = " ".join(f"word{i} and more." for i in range(400))
    done = token_counts.Counted(text, encoder)
    n_leaves, before = len(done.leaves), text
    for i in range(30):
        put = f" inserted {i}" + " some words" * 80
        done.edit(1_000, 1_000, put)
        before = before[:1_000] + put + before[1_000:]
    assert done.text() == before and len(done.leaves) > n_leaves + 20
    assert max(map(len, done.leaves)) < 2 * token_counts.LEAF_CHARS
    done.encoded_chars = 0
    done.edit(1_500, 1_501, "x")
    before = before[:1_500] + "x" + before[1_501:]
    assert done.encoded_chars < 4 * token_counts.LEAF_CHARS
    # Most of the text goes, then all of it, and new text comes.
    for start, end, put in [(40, len(before) - 30, ""), (0, 70, None), (0, 0, before)]:
        done.edit(start, end, put)
        assert done.tree.tokens == len(plain_ids(done.text())) and done.tree.chars == len(done.text())
    assert done.text() == before


def test_edits_that_do_not_fit_are_refused(spark):
    row = "doc_id bigint, text string, edits array<struct<start:bigint,end:bigint,replacement:string>>"
    edits = [[(0, 99, "x")], [(-1, 2, "x")], [(3, 2, "x")], [(0, 3, "x"), (2, 4, "y")], [(None, 2, "x")],
             [None], [(0, 1, "x"), (0, 50, "y")], [(0, 1, "I")], [], None]
    rows = spark.createDataFrame([(i, "a text of words", e) for i, e in enumerate(edits)], row)
    counted = token_counts.count_tokens(rows, tokenizer_file()).join(rows.select("doc_id", "edits"), "doc_id")
    for r in token_counts.apply_edits(counted, tokenizer_file()).collect():
        refused = len(edits[r["doc_id"]] or []) if r["doc_id"] < 7 else 0
        assert r["n_refused"] == refused and r["n_edits"] == (1 if r["doc_id"] == 7 else 0)
        assert r["text"] == ("I text of words" if r["doc_id"] == 7 else "a text of words")
        assert r["n_tokens"] == len(plain_ids(r["text"]))


def test_words_of_a_batch_are_encoded_as_by_the_library(monkeypatch):
    draw = random.Random(5)
    letters = " \n\tabé1.'s,x日"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(14))) for _ in range(3_000)]
    texts += [None, "", "<|endoftext|> a", " a b", "a  b", "a b ", "don't stop", "ÿ ÿÿ x", "or so, no. A1 B' c- é» x\n y"]
    for most in (10**6, 50):
        monkeypatch.setattr(encode, "MOST_WORDS", most)
        monkeypatch.setattr(encode, "MOST_PIECES", most)
        encoder = Encoder(tokenizer_file())
        got = [ids for at in range(0, len(texts), 100) for ids in encoder(texts[at : at + 100])]
        assert got == [encoder.whole(t or "") for t in texts]
        # Without a border between pieces, each goes to the model by itself.
        encoder = Encoder(tokenizer_file())
        encoder.border_id = None
        assert encoder(texts) == got


def test_masking_edits_cut_what_the_pattern_finds(spark):
    texts = ["mail a.b@c.org or 12345678 now", "1234567", "", None, "é 日本 7654321x@y.z end"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    got = rows.select("text", token_counts.masking_edits(F.col("text")).alias("e")).collect()
    for r in got:
        found = re.finditer(r"[A-Za-z0-9._]+@[A-Za-z0-9.]+|[0-9]{7,}", r["text"] or "")
        assert [(e["start"], e["end"]) for e in r["e"]] == [m.span() for m in found]


def test_masking_edits_take_long_words_in_one_pass(spark):
    rng, pattern = random.Random(12), re.compile(r"[A-Za-z0-9._]+@[A-Za-z0-9.]+|[0-9]{7,}")
    texts = ["a@b_c@d", "a@b@c", "1234567_x@y", "x1234567b", "a@1234567_1234567@b", "_@.", "@", "12345678_"]
    texts += ["".join(rng.choice("a1._@ 1111111") for _ in range(rng.randrange(60))) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in rows.select("text", token_counts.masking_edits(F.col("text")).alias("e")).collect():
        assert [(e["start"], e["end"]) for e in r["e"]] == [m.span() for m in pattern.finditer(r["text"])]
    # From each character of a word to its end, these would be some 10 ** 11 steps.
    texts = ["a" * 400_000 + end for end in ("", " b@c", " 1234567")]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    began = time.monotonic()
    got = rows.select(F.size(token_counts.masking_edits(F.col("text"))).alias("n")).collect()
    assert sorted(r["n"] for r in got) == [0, 1, 1] and time.monotonic() - began < 30


# ---- sharding and mixing ---------------------------------------------------------------------------------------


def test_shards_have_nearly_equal_bytes_and_gapless_slots(spark, clashing, empty):
    rng = random.Random(8)
    rows = [(i, "copy " * 40 if i % 3 == 0 else prose(rng, rng.randrange(1, 60))) for i in range(6000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    out = sharding.shard_documents(frame).toPandas()
    size = out.groupby("shard")["size"].sum()
    assert len(size) == 16 and size.max() <= 1.03 * size.mean() and size.min() >= 0.97 * size.mean()
    for _, part in out.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    # Only the text that fills a third of the table is cut.
    split = out.groupby("text")["shard"].nunique()
    assert set(split[split > 1].index) == {"copy " * 40}
    assert len(out) == len(rows)
    again = sharding.shard_documents(frame.repartition(3)).toPandas()
    assert sorted(zip(out.doc_id, out.shard, out.slot)) == sorted(zip(again.doc_id, again.shard, again.slot))
    odd = sharding.shard_documents(clashing)
    assert "a.b" in odd.columns and odd.columns.count("size") == 1 and odd.count() == len(ROWS)
    assert sharding.shard_documents(empty).count() == 0


def test_targets_share_the_excess():
    assert mixing.targets([], mixing.Mix()) == []
    assert mixing.targets([0, 0], mixing.Mix()) == [0.0, 0.0]
    sizes = [10, 1000, 1000, 50]
    got = mixing.targets(sizes, mixing.Mix())
    assert math.isclose(sum(got), 1.5 * sum(sizes)) and all(t <= 2 * s + 1e-9 for t, s in zip(got, sizes))
    assert got[0] == 20 and got[3] == 100 and math.isclose(got[1] / got[2], 2) == (got[1] < 2000)


def test_splitting_tree_keeps_every_quota():
    draws = [1000, 0, 7, 350]
    deal = mixing.split_draws(draws, 16, 3)
    assert deal.sum(axis=0).tolist() == draws and (deal >= 0).all()
    rows = deal.sum(axis=1)
    assert rows.max() - rows.min() <= 1
    assert (deal == mixing.split_draws(draws, 16, 3)).all()
    mean = np.mean([mixing.split_draws(draws, 16, s)[:, 0] for s in range(200)], axis=0)
    assert np.allclose(mean, 1000 / 16, rtol=0.05)


def test_mix_comes_near_its_targets(spark, docs, clashing, empty):
    rng = random.Random(9)
    rows = [(i, prose(rng, 1500 if i % 97 == 0 else rng.randrange(5, 90)), "hot" if i % 3 else f"s{i % 7}") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)
    plan = mixing.plan_mix(frame).withColumn("taken", F.size("draws") * F.col("size"))
    assert plan.where("taken > 2 * size").count() == 0
    for r in plan.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect():
        assert abs(r["t"] - r["g"]) <= 0.02 * r["g"]
    again = mixing.plan_mix(frame.repartition(3)).select("doc_id", "draws").collect()
    assert ordered(again) == ordered(plan.select("doc_id", "draws").collect())
    copies = mixing.mix_sources(frame)
    assert copies.count() == plan.agg(F.sum(F.size("draws"))).first()[0]
    odd = mixing.plan_mix(clashing)
    assert odd.columns.count("size") == 1 and odd.count() == len(ROWS)
    assert {r[0] for r in odd.where("text is null").select("size").collect()} == {0}
    assert mixing.mix_sources(clashing).columns[: len(clashing.columns) - 1][:2] == ["doc_id", "text"]
    assert mixing.plan_mix(empty).count() == 0
