"""Streams against batch on the same trades, with late rows and restarts."""

import random
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tickloom.operators import enrich as ope
from tickloom.operators.candles import PartVersions, candles
from tickloom.operators.enrich import enrich, gap_segments, table_row
from tickloom.params import Params
from tickloom.plans import stream_queries as sq
from tickloom.plans import tables as tb
from tickloom.schemas import RAW_TRADE, TRADES_TABLE
from tickloom.streaming import enrich as se
from tickloom.streaming import jobs
from tickloom.streaming.segments import OpenSegments, segment_sink

from model import EPOCH, make_trades

PARAMS = Params(warmup_min_samples=10, data_gap_reset_seconds=5)


def heartbeat(rows):
    end = max(r[3] for r in rows) + timedelta(days=1)
    return (se.HEARTBEAT, 1.0, 1.0, end, -1)


def put(spark, path, n, rows):
    spark.createDataFrame(rows, RAW_TRADE).coalesce(1).write.parquet(f"{path}/part={n}")


def stream(spark, path, one_file_per_batch=True):
    reader = spark.readStream.schema(RAW_TRADE)
    if one_file_per_batch:
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{path}/part=*")


def run(rows, out, checkpoint):
    writer = rows.writeStream.format("parquet").option("path", out)
    return jobs.once(writer.option("checkpointLocation", checkpoint))


def key(r):
    z = None if r.z_score is None else round(r.z_score, 9)
    return (r.trade_id, r.symbol, r.usd_value, r.classification, z, r.is_anomaly)


def enriched(spark, trades, out, state, checkpoint, order=None):
    sink = se.to_folders(out, f"{out}-late")
    jobs.once(se.enriched_batches(trades, state, checkpoint, sink, PARAMS, "10 seconds", order))
    return spark.read.parquet(out)


def batch(spark, rows):
    return sorted(key(r) for r in enrich(spark.createDataFrame(rows, RAW_TRADE), PARAMS).collect())


def test_enriched_stream_equals_batch_across_a_restart(spark, tmp_path):
    rows = make_trades(7, 800)
    # Arrival differs from event order by less than the delay.
    rng = random.Random(1)
    arrival = sorted(rows, key=lambda r: r[3] + timedelta(seconds=rng.uniform(0, 8)))
    src, *places = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    put(spark, src, 0, arrival[:300])
    put(spark, src, 1, arrival[300:500])
    between = enriched(spark, stream(spark, src), *places).count()
    assert 0 < between < 500
    put(spark, src, 2, arrival[500:])
    put(spark, src, 3, [heartbeat(rows)])
    got = enriched(spark, stream(spark, src), *places)
    assert sorted(key(r) for r in got.collect()) == batch(spark, rows)


def test_segments_come_out_once_when_the_next_gap_ends_them(spark, tmp_path):
    rows = make_trades(13, 600)
    src, out, left, state, cp = (str(tmp_path / n) for n in ("src", "out", "open", "state", "cp"))
    want = gap_segments(spark.createDataFrame(rows, RAW_TRADE), PARAMS)
    names, last = want.columns, {}
    whole = {tuple(r) for r in want.collect()}
    for r in whole:
        last[r[0]] = max(last.get(r[0], 0), r[1])
    sink, fail = segment_sink(out, left), []

    def failing(closed):
        sink(closed)
        if fail:
            raise RuntimeError(fail.pop())

    def go():
        jobs.once(se.enriched_batches(stream(spark, src), state, cp, failing, PARAMS, "10 seconds"))
        return [tuple(r) for r in spark.read.parquet(out).select(*names).collect()]

    rows = sorted(rows, key=lambda r: r[3])
    put(spark, src, 0, rows[:250])
    early = go()
    assert early and set(early) < whole
    put(spark, src, 1, rows[250:400])
    # The batch fails after it has written; it comes again and finds what it found before.
    fail.append("after the write")
    with pytest.raises(StreamingQueryException):
        go()
    put(spark, src, 2, rows[400:])
    put(spark, src, 3, [heartbeat(rows)])
    done = go()
    still = [tuple(r) for r in OpenSegments(spark, left).before().select(*names).collect()]
    assert len(done) == len(set(done)) and set(done) | set(still) == whole
    assert sorted((r[0], r[1]) for r in still) == sorted(last.items())


def test_rows_behind_the_watermark_come_out_as_late(spark, tmp_path):
    rows = make_trades(8, 300)
    src, *places = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    put(spark, src, 0, rows)
    enriched(spark, stream(spark, src), *places)
    late = [("AAA", 1.0, 1.0, EPOCH - timedelta(hours=1), 9001), ("NEW", 1.0, 1.0, EPOCH, 9002)]
    put(spark, src, 1, late)
    put(spark, src, 2, [heartbeat(rows)])
    got = enriched(spark, stream(spark, src), *places)
    assert {r.trade_id for r in spark.read.parquet(f"{places[0]}-late").collect()} == {9001, 9002}
    assert sorted(key(r) for r in got.collect()) == batch(spark, rows)


def test_replays_of_a_stream_count_once_and_the_first_offset_stays(spark, tmp_path):
    rows = sorted(make_trades(13, 300), key=lambda r: r[3])
    src, *places = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    numbered = [(*r, i) for i, r in enumerate(rows)]
    copies = [(r[0], r[1] + 5.0, *r[2:5], 1000 + r[5]) for r in numbered]
    end = (*heartbeat(rows), 9999)
    schema = T.StructType([*RAW_TRADE.fields, T.StructField("offset", T.LongType())])
    # A copy within its batch and ahead of the first, others in a later batch.
    for n, part in enumerate((copies[:50] + numbered[:200], numbered[200:] + copies[190:], [end])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{src}/part={n}")
    trades = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/part=*")
    got = enriched(spark, trades, *places, order=F.col("offset"))
    assert sorted(key(r) for r in got.collect()) == batch(spark, rows)


def test_a_batch_that_fails_comes_again_with_the_same_rows(spark, tmp_path):
    rows = sorted(make_trades(14, 200), key=lambda r: r[3])
    src, out, state, cp = (str(tmp_path / n) for n in ("src", "out", "state", "cp"))
    put(spark, src, 0, rows[:120])
    put(spark, src, 1, rows[120:] + [heartbeat(rows)])
    write, failed = se.to_folders(out), []

    def sink(closed):
        write(closed)
        if closed.batch_id == 1 and not failed:
            failed.append(closed.batch_id)
            raise RuntimeError("lost after the rows were written")

    def job():
        return se.enriched_batches(stream(spark, src), state, cp, sink, PARAMS, "10 seconds")

    with pytest.raises(StreamingQueryException):
        jobs.once(job())
    jobs.once(job())
    assert failed == [1]
    assert sorted(key(r) for r in spark.read.parquet(out).collect()) == batch(spark, rows)


def test_table_sink_survives_a_lost_checkpoint(spark, tmp_path):
    rows = table_row(enrich(spark.createDataFrame(make_trades(9, 300), RAW_TRADE), PARAMS))
    src, path = str(tmp_path / "src"), str(tmp_path / "table")
    rows.write.parquet(f"{src}/part=0")
    counts = []
    for n in range(2):
        source = spark.readStream.schema(TRADES_TABLE).parquet(f"{src}/part=*")
        jobs.once(jobs.table_sink(
            source, path, str(tmp_path / f"cp{n}"), on_counts=lambda i, c: counts.append(c)
        ))
    assert [(c.attempted, c.inserted) for c in counts] == [(300, 300), (300, 0)]
    assert spark.read.parquet(path).count() == 300


def test_candles_of_several_batches_are_those_of_one(spark, tmp_path):
    rows = table_row(enrich(spark.createDataFrame(make_trades(10, 600), RAW_TRADE), PARAMS))
    rows = rows.orderBy("time")
    src, path, cp = (str(tmp_path / n) for n in ("src", "parts", "cp"))
    kept = rows.collect()
    for n in range(3):
        spark.createDataFrame(kept[n::3], TRADES_TABLE).coalesce(1).write.parquet(f"{src}/part={n}")
    source = (
        spark.readStream.schema(TRADES_TABLE).option("maxFilesPerTrigger", 1).parquet(f"{src}/part=*")
    )
    jobs.once(jobs.candle_sink(source, path, cp, PARAMS))

    def shape(df):
        return sorted(
            (r.bucket, r.symbol, r.open, r.high, r.low, r.close, r.trade_count, r.anomaly_count,
             round(r.usd_volume, 4))
            for r in df.collect()
        )

    assert shape(PartVersions(spark, path).candles()) == shape(candles(rows, PARAMS))


def test_duplicates_within_the_delay_come_out_once(spark, tmp_path):
    rows = make_trades(11, 200)
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    put(spark, src, 0, rows + rows[:50])
    put(spark, src, 1, rows[-20:])
    run(jobs.distinct_trades(stream(spark, src)), out, cp)
    got = spark.read.parquet(out)
    assert got.count() == 200 and got.select("trade_id").distinct().count() == 200


def test_quarantine_keeps_the_raw_text(spark, tmp_path):
    from tickloom.sources.wire import parse_wire, read_wire_stream

    src, good, bad, cp = (str(tmp_path / n) for n in ("src", "good", "bad", "cp"))
    spark.createDataFrame([("{broken",), ('{"a": 1}',)], "value string").write.text(src)
    jobs.once(jobs.split_sink(parse_wire(read_wire_stream(spark, src)), good, bad, cp))
    got = {(r.status, r.raw) for r in spark.read.parquet(bad).collect()}
    assert got == {("parse_error", "{broken"), ("ignored", '{"a": 1}')}
    assert spark.read.parquet(good).count() == 0


def test_topic_folder_round_trip(spark, tmp_path):
    from tickloom.sources import topic as tp

    params = Params(symbol_partitions=(("AAA", 0), ("BBB", 1)))
    rows = make_trades(12, 100)
    src, topic, out = (str(tmp_path / n) for n in ("src", "topic", "out"))
    put(spark, src, 0, rows)
    tp.publish_stream(
        stream(spark, src), str(tmp_path / "cp1"), params, path=topic, trigger={"availableNow": True}
    ).awaitTermination()
    back = tp.topic_trades(tp.read_topic_stream(spark, params, path=topic))
    run(back, out, str(tmp_path / "cp2"))
    sent = spark.createDataFrame(rows, RAW_TRADE)
    assert spark.read.parquet(out).select(*sent.columns).exceptAll(sent).count() == 0
    assert spark.read.parquet(out).count() == 100
    with pytest.raises(ValueError):
        tp.read_topic_stream(spark)


def events_folder(spark, path, n=6_000, files=4):
    """Events of 30 days in several files, as large tables have them."""
    rng = random.Random(5)
    rows = [
        (i, EPOCH.replace(tzinfo=None, year=2024, month=1, day=1, hour=0, minute=0, second=0, microsecond=0)
         + timedelta(seconds=rng.randrange(30 * 86_400), microseconds=i), rng.choice(["view", "purchase", "click"]),
         float(rng.randrange(1, 500)))
        for i in range(n)
    ]
    spark.createDataFrame(rows, sq.EVENTS).repartition(files).write.parquet(f"{path}/events.parquet")
    return str(path)


def data_files(path):
    return sorted(Path(path.removeprefix("file:")).glob("*.parquet"))


def test_arrivals_are_written_and_read_by_several_tasks(spark, tmp_path, monkeypatch):
    made = {}
    monkeypatch.setattr(sq, "fresh_path", lambda s, label: made.setdefault(label, f"{tmp_path}/{label}"))
    folder = events_folder(spark, tmp_path / "tables")
    expected = gap_segments(tb.trades(spark, folder), tb.SCALED)
    got = sq.stream_segments(spark, folder)
    key = lambda r: (r.symbol, r.segment)
    assert sorted(got.collect(), key=key) == sorted(expected.select(*got.columns).collect(), key=key)
    assert all(len(data_files(f"{made['arrivals']}/part={n}")) > 1 for n in range(3))


def test_a_topic_partition_has_several_files_in_order_of_offsets(spark, tmp_path, monkeypatch):
    made = {}
    monkeypatch.setattr(sq, "fresh_path", lambda s, label: made.setdefault(label, f"{tmp_path}/{label}"))
    folder = events_folder(spark, tmp_path / "tables")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # the tables are small
    try:
        sq.stream_pipeline(spark, folder).count()
    finally:
        spark.conf.unset(coalesce)
    for n in range(2):
        files = data_files(f"{made['topic']}/part={n}")
        assert len(files) > len(tb.PAIR)
        ranges = []
        for f in files:
            places = [tuple(r) for r in spark.read.parquet(str(f)).select("partition", "offset").collect()]
            assert places == sorted(places)
            ranges += [(places[0], places[-1])] if places else []
        ranges.sort()
        assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_what_a_batch_keeps_has_no_more_partitions_than_its_rows_need(spark, tmp_path):
    rows = make_trades(11, 300)
    put(spark, f"{tmp_path}/in", 0, [*rows, heartbeat(rows)])
    kept = []

    def sink(closed):
        closed.enriched.count()
        infos = spark.sparkContext._jsc.sc().getRDDStorageInfo()
        kept.extend(info.numPartitions() for info in infos)

    trades = stream(spark, f"{tmp_path}/in")
    jobs.once(se.enriched_batches(trades, f"{tmp_path}/state", f"{tmp_path}/check", sink, PARAMS))
    assert kept and max(kept) < int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_batch_works_out_its_slices_once(spark, tmp_path, monkeypatch):
    rows = make_trades(12, 300)
    put(spark, f"{tmp_path}/in", 0, [*rows, heartbeat(rows)])
    calls = []
    whole = ope.slice_carry
    monkeypatch.setattr(ope, "slice_carry", lambda *a, **k: calls.append(1) or whole(*a, **k))
    got = enriched(spark, stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/s", f"{tmp_path}/c")
    assert len(calls) == 1
    assert sorted(map(key, got.collect())) == batch(spark, rows)


def test_first_copies_take_one_shuffle_and_keep_the_held_row(spark):
    at = EPOCH + timedelta(seconds=5)
    rows = [
        ("A", 1.0, 1.0, at, 1, 7, True),
        ("A", 2.0, 1.0, at, 1, 3, True),  # the first by place
        ("A", 3.0, 1.0, at, 2, 9, False),  # held already
        ("A", 4.0, 1.0, at, 2, 1, True),
        ("A", 6.0, 1.0, at, 3, 4, True),
        ("A", 5.0, 1.0, at, 3, 4, True),  # the first by values
        ("A", 8.0, 1.0, at, None, 4, True),
        ("A", 7.0, 1.0, at, None, None, True),
        ("A", 1.0, 1.0, at, 4, None, True),  # without any place both stay
        ("A", 2.0, 1.0, at, 4, None, True),
    ]
    got = se._first_copies(spark.createDataFrame(rows, se.HELD))
    assert sorted(r.price for r in got.collect()) == [1.0, 2.0, 2.0, 3.0, 5.0, 8.0]
    plan = got._jdf.queryExecution().sparkPlan().toString()
    executed = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and executed.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1
