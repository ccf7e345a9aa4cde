"""The pipeline over a small folder, against a plain model of its deciding stages."""

import collections

import pytest

pytest.importorskip("tickloom.llm.queries")

import corpus_pipeline as pipeline  # noqa: E402
from test_operators import (  # noqa: E402
    QUALITY,
    ROWS,
    SCHEMA,
    components,
    contained,
    in_duck,
    plain_ids,
    words,
)
from tickloom.llm import mixing, sql  # noqa: E402

ITEMS = [(0, ROWS[13][1]), (1, None), (2, "one two")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    # Rows that agree in every column are one row here: which of them stays cannot be told.
    spark.createDataFrame(ROWS, SCHEMA).distinct().write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    return path


def kept_by_model():
    rows = list(dict.fromkeys(ROWS))
    query = f"SELECT {', '.join(QUALITY)}, text FROM ({sql.quality_sql()})"
    good = {(r[0], r[-1]) for r in in_duck({"documents": (SCHEMA, rows)}, query) if r[7]}
    rows = [r for r in rows if (r[0], r[1]) in good]
    _, label = components(rows)
    first = collections.defaultdict(list)
    for row, mark in zip(rows, label):
        first[mark].append(row)
    rank = lambda r: (r[0] is None, r[0] or 0)
    rows = [min(group, key=rank) for group in first.values()]
    return [r for r in rows if not contained([r], ITEMS)]


def test_stages_decide_as_the_model(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
    want = kept_by_model()
    assert sorted(map(repr, (r["doc_id"] for r in docs.collect()))) == sorted(
        map(repr, (r[0] for r in want))
    )
    assert 0 < len(want) < len(ROWS)


def test_run_writes_every_copy_of_the_mix(spark, folder):
    out = pipeline.run(spark, folder).orderBy("start").collect()
    want = {r[0]: r for r in kept_by_model()}
    assert {r["doc_id"] for r in out} <= set(want)
    copies = collections.Counter(r["doc_id"] for r in out)
    assert max(copies.values()) <= 2
    sources = sorted({r[3] for r in want.values()}, key=lambda s: (s is None, s or ""))
    sizes = {s: [len(words(r[1])) for r in want.values() if r[3] == s] for s in sources}
    targets = mixing.targets([sum(sizes[s]) for s in sources], mixing.Mix())
    for source, target in zip(sources, targets):
        taken = sum(len(words(want[d][1])) * k for d, k in copies.items() if want[d][3] == source)
        assert abs(taken - target) <= max(sizes[source])  # documents are whole
    start = 0
    for r in out:
        assert r["start"] == start and r["n_tokens"] == len(plain_ids(want[r["doc_id"]][1])) + 1
        start += r["n_tokens"]


def test_stages_take_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name


def test_stages_are_those_that_the_readme_names():
    assert [name for name, _ in pipeline.STAGES] == [
        "quality rules",
        "n-gram Jaccard join",
        "benchmark decontamination",
        "mixing sources to target weights",
        "token-ID / binary output",
    ]
    assert pipeline.ORACLE_SQL is None
