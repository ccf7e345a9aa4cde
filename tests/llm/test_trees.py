"""SentencePiece ids, the Merkle manifest and the prefix trie against the library and plain models."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tickloom.llm.queries")

from tickloom.llm import merkle, piece_codec, prefix_trie  # noqa: E402
from tickloom.llm.queries import QUERIES, piece_model  # noqa: E402
from tickloom.llm.radix_tree import FullNode, IndexedNode, RadixTree, SmallNode  # noqa: E402

SOME = ["a", "the", "ing", " ", "  ", "   ", "▁", "\n", "\t", "\x00", "é", "字", "😀", " ", "<s>",
        "</s>", "<0x0A>", "12", "ﬁ", "\r\n", "̈", "​", "﻿", "�", " "]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda row: tuple((x is not None, x) for x in row))


def odd_texts(seed, count, most=30):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(SOME) for _ in range(rng.randint(0, most))) for _ in range(count)]
    return [None, "", " ", "▁", "x", " x", "x ", *texts]


@pytest.mark.parametrize("portion", [5, 40, 1 << 20])
def test_ids_are_those_of_the_library(portion, monkeypatch):
    monkeypatch.setattr(piece_codec, "PORTION", portion)
    codec = piece_codec.PieceCodec(piece_model(), most_words=200)
    texts = odd_texts(portion, 4000)
    found = [np.frombuffer(ids, np.int32).tolist() for ids in codec.encode(texts)]
    assert codec.separable
    assert found == codec.library.encode([t or "" for t in texts])


def test_distinct_words_are_segmented_once():
    codec = piece_codec.PieceCodec(piece_model())
    asked, library = [], codec.library

    class Counted:
        normalize = library.normalize

        @staticmethod
        def encode(texts, **options):
            asked.extend(texts if isinstance(texts, list) else [])
            return library.encode(texts, **options)

    codec.library = Counted
    list(codec.encode(["one two one two three"] * 50))
    list(codec.encode(["three two one"]))
    assert sorted(asked) == ["one", "three", "two"]


def test_words_that_normalization_changes_go_whole():
    codec = piece_codec.PieceCodec(piece_model())

    class Changing:
        encode = codec.library.encode

        @staticmethod
        def normalize(words):
            return [w.upper() for w in words]

    codec.library = Changing
    text = "a few words"
    assert np.frombuffer(next(codec.encode([text])), np.int32).tolist() == Changing.encode(text)


def test_texts_survive_encoding_and_decoding(spark):
    texts = odd_texts(1, 300)
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string")
    docs = docs.select("*", F.lit(1).alias("Text"))
    coded = piece_codec.encode_documents(docs, piece_model())
    assert coded.columns == ["doc_id", "text", "Text", "ids"]
    back = piece_codec.decode_documents(coded, piece_model())
    library = piece_codec.PieceCodec(piece_model()).library
    position = {c: i for i, c in enumerate(back.columns)}
    for row in back.collect():
        ids = library.encode(row[position["text"]] or "")
        assert row[position["ids"]] == ids
        assert row[position["decoded"]] == library.decode(ids)
    assert piece_codec.encode_documents(docs.limit(0), piece_model()).count() == 0


def test_ids_outside_the_vocabulary_have_no_text(spark):
    coded = spark.createDataFrame(
        [(1, [5, 99999999]), (2, None), (3, []), (4, [-1])], "doc_id long, ids array<int>"
    )
    found = piece_codec.decode_documents(coded, piece_model())
    assert in_order(found.select("doc_id", "decoded").collect()) == [(1, None), (2, ""), (3, ""), (4, None)]


# -- Merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    doc_id, source, lang, n_chars, text = row
    values = (doc_id, source, lang, None if n_chars is None else n_chars + add, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def steps_of(levels, i):
    for level in levels[:-1]:
        other = i ^ 1
        yield (None, "") if other >= len(level) else ("LR"[other > i], level[other])
        i >>= 1


def plain_manifest(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = levels_of([leaf_of(r) for r in by_lang[lang]])
    top = levels_of([trees[lang][-1][0] for lang in langs])
    for k, lang in enumerate(langs):
        for i, row in enumerate(by_lang[lang]):
            steps = [*steps_of(trees[lang], i), *steps_of(top, k)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf_of(row, int(hit))
            for side, other in steps:
                node = digest(other, node) if side == "L" else digest(node, other)
            root = top[-1][0]
            proof = digest(*[other for _, other in steps])
            yield row[0], leaf_of(row), trees[lang][-1][0], root, proof, node, node == root


def found_manifest(docs, bits):
    found = merkle.manifest(docs, bits)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256), "folded_root", "verified"
    ).collect()


KIND = "doc_id long, source string, lang string, n_chars long, text string"


def leaf_rows(count, seed=3):
    rng = random.Random(seed)
    langs = ["en"] * 12 + ["de", None, "", "zü", "fr"]
    return [
        (rng.choice([None, -7, 2**63 - 1, *range(150)]), rng.choice(["a", "b", None]), rng.choice(langs),
         rng.choice([None, 0, 5, 2**63 - 1]), rng.choice([None, "", "x", "ü" * 9, "long " * 5000]))
        for _ in range(count)
    ]


@pytest.mark.parametrize("count,bits", [(250, 2), (250, 5), (250, 12), (1, 2), (2, 1), (5, 1), (0, 2)])
def test_manifest_equals_a_plain_tree(spark, count, bits):
    rows = leaf_rows(count)
    docs = spark.createDataFrame(rows, KIND)
    docs = docs.select("*", F.lit("x").alias("DOC_ID"), F.lit(1).alias("pos"))
    assert in_order(found_manifest(docs, bits)) == in_order(plain_manifest(rows))


def test_versions_share_what_they_did_not_copy(spark):
    rows = [(i, "s", "en" if i % 5 else "de", i, f"text {i}") for i in range(200)]
    found = merkle.manifest(spark.createDataFrame(rows, KIND), 3).collect()
    tampered = [r for r in found if r["tampered"]]
    assert tampered and all(r["version"] == [] for r in found if not r["tampered"])
    for row in tampered:
        assert row["version"][-1] == row["folded_root"] != row["root"] and not row["verified"]
        # One copy a level: of all nodes of its version, only the ancestors are its own.
        size = 160 if row["lang"] == "en" else 40
        assert len(row["version"]) == (size - 1).bit_length() + 1
        assert not {*row["version"]} & {x for r in found for x in (r["leaf"], *r["proof"], r["root"])}


# -- Prefix trie


def turn_key(turn, role, text):
    spelled = f"{len(role.encode())}:{role}{text}".encode()
    return turn is not None, turn or 0, hashlib.sha256(spelled).digest()[:16]


def plain_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(ts, key=lambda t: turn_key(*t))] for c, ts in convs.items()}
    nodes, ends = {}, {}
    for conv, own in convs.items():
        h = zlib.crc32(str(conv).encode()) % 6
        whole = convs.get(conv - int(math.fmod(conv, 100)), [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            nodes.setdefault(tuple(whole[:d]), []).append(conv)
        ends.setdefault(tuple(whole), []).append(conv)
    children, leaves, saved = {}, {}, {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[b] for b in below) or 1
        own = (len(nodes[path]) - 1) * len(path[-1][1]) if path else 0
        saved[path] = sum(saved[b] for b in below) + own
    for path, members in nodes.items():
        listed = ",".join(map(str, sorted(ends.get(path, []))))
        yield (min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
               len(children.get(path, [])), leaves[path], saved[path],
               hashlib.sha256(listed.encode()).hexdigest())


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def random_turns(count, ids, seed):
    rng = random.Random(seed)
    texts = [None, "", "x", "yy", "zzz ü", "😀", "long " * 300]
    return [(rng.choice(ids), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "a", None]), rng.choice(texts))
            for _ in range(count)]


def copies():
    """A third of all conversations alike, more with the same first turns, one very long."""
    alike = [(c, t, "u", f"t{t}") for c in range(300) for t in range(3)]
    begun = [(c, t, "u", f"t{t}" if t < 4 else str(c % 7)) for c in range(300, 600) for t in range(7)]
    return [*alike, *begun, *[(900, t, "u", f"t{t}") for t in range(700)]]


@pytest.mark.parametrize(
    "rows,size",
    [
        (random_turns(500, [None, -5, -100, 305, *range(60), *range(100, 160)], 1), 100),
        (random_turns(1500, [*range(500)], 2), 1000),
        (copies(), 500),
        (copies(), 1 << 22),
        ([(7, 1, "u", "x")], 100),
        ([], 100),
    ],
)
def test_trie_equals_a_plain_model(spark, rows, size):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.select("*", F.lit(1).alias("TEXT"), F.lit("x").alias("depth"))
    found = prefix_trie.prefix_nodes(turns, size).select(*NODE).collect()
    assert in_order(found) == in_order(plain_trie(rows))


def test_nodes_grow_and_paths_are_compressed():
    rng = random.Random(1)
    keys = {bytes(rng.randrange(256) for _ in range(rng.choice([0, 1, 2, 6]))) for _ in range(3000)}
    tree = RadixTree()
    for key in sorted(keys, key=hash):
        tree.add(key, key)
    seen, kinds, todo = [], set(), [(tree.root, b"")]
    while todo:
        node, path = todo.pop()
        path += node.prefix
        seen += node.values
        assert all(value == path for value in node.values)
        below = tree.children(node)
        assert [c.prefix[0] for c in below] == sorted({c.prefix[0] for c in below})
        # Nothing but the root may have one child and no key of its own.
        assert node is tree.root or node.values or len(below) > 1
        kinds.add((type(node.children), getattr(node.children, "most", None)))
        todo += [(child, path) for child in below]
    assert sorted(seen) == sorted(keys)
    assert {(SmallNode, 4), (SmallNode, 16), (FullNode, None)} <= kinds
    small = SmallNode(4)
    for letter in range(256):
        small = small.put(255 - letter, letter)
        kind = SmallNode if letter < 16 else IndexedNode if letter < 48 else FullNode
        assert type(small) is kind and small.get(255 - letter) == letter
    assert [b for b, _ in small.items()] == list(range(256))


@pytest.mark.parametrize("name,table", [("op12_merkle_manifest", "documents"), ("op13_prefix_trie", "conversations")])
def test_queries_equal_their_sql(spark, name, table):
    import duckdb

    from tickloom.llm.sql import ORACLES

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = QUERIES[name](spark, folder)
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLES[name]})").fetchall()
    assert in_order(found.collect()) == in_order(wanted)


def test_sentencepiece_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    library = piece_codec.PieceCodec(piece_model()).library
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = []
    for row in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(row["text"] or "")
        wanted.append((row["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert in_order(QUERIES["op11_sentencepiece"](spark, folder).collect()) == in_order(wanted)
