"""Stored table, candles, feeds and statistics on hand-made rows."""

import json

import pytest
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickloom.operators import candles as cd
from tickloom.operators import feeds as fd
from tickloom.operators import output, sink
from tickloom.operators import stats as st
from tickloom.operators.enrich import enrich, table_row
from tickloom.params import Params
from tickloom.schemas import RAW_TRADE, TRADES_TABLE
from tickloom.sources.table import read_trades, scan_recent, write_trades

from model import make_trades

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def row(i, seconds, symbol="AAA", price=10.0, anomaly=False, z=None, cls="Pro"):
    return (i, T0 + timedelta(seconds=seconds), symbol, price, 1.0, price, cls, z, anomaly)


def table(spark, rows):
    return spark.createDataFrame(rows, TRADES_TABLE)


def ids(df):
    return [r.trade_id for r in df.collect()]


def test_sink_keeps_the_first_row_and_ignores_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    first = table(spark, [row(1, 0, price=1.0), row(2, 90_000, price=2.0)])
    assert sink.append_new(spark, first, path) == sink.SinkCounts(2, 2)
    again = table(spark, [row(1, 0, price=9.0), row(3, 5), row(3, 5), row(1, 1)])
    assert sink.append_new(spark, again, path) == sink.SinkCounts(4, 2)
    assert sink.append_new(spark, again, path).skipped == 4
    assert sink.append_new(spark, first.limit(0), path) == sink.SinkCounts(0, 0)
    got = read_trades(spark, path)
    assert got.count() == 4
    assert {r.price for r in got.where("trade_id = 1 AND second(time) = 0").collect()} == {1.0}


def test_sink_first_by_arrival(spark):
    rows = [(1, T0, "late", 2), (1, T0, "early", 1)]
    df = spark.createDataFrame(rows, "trade_id long, time timestamp, what string, offset int")
    kept = sink.keep_first(df, order=F.col("offset")).collect()
    assert [r.what for r in kept] == ["early"]


def test_wider_key(spark):
    df = table(spark, [row(1, 0, "AAA"), row(1, 0, "BBB")])
    assert sink.keep_first(df).count() == 1
    assert sink.keep_first(df, key=("trade_id", "time", "symbol")).count() == 2


def test_scan_is_strict_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    write_trades(table(spark, [row(1, 0), row(2, 60), row(3, 200_000)]), path)
    stored = read_trades(spark, path)
    got = scan_recent(stored, T0 + timedelta(seconds=360), 300)
    assert ids(got) == [3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time" in plan and "PartitionFilters: [isnotnull(day" in plan


def test_candles_open_close_ties_and_nulls(spark):
    rows = [
        row(2, 10, price=5.0),
        row(1, 10, price=4.0),
        row(3, 59.999, price=6.0, anomaly=True, z=4.0),
        row(4, 60, price=7.0),
    ]
    got = {r.bucket.second + 60 * r.bucket.minute: r for r in cd.candles(table(spark, rows)).collect()}
    assert len(got) == 2
    first = got[0]
    assert (first.open, first.high, first.low, first.close) == (4.0, 6.0, 4.0, 6.0)
    assert (first.volume, first.usd_volume, first.trade_count, first.anomaly_count) == (3.0, 15.0, 3, 1)
    assert first.avg_z_score == 4.0 and got[60].avg_z_score is None


def test_refresh_takes_whole_buckets_and_leaves_older_ones(spark, tmp_path):
    path = str(tmp_path / "c")
    start = [row(i, 60 * i + 5, price=float(i + 1)) for i in range(400)]
    now = T0 + timedelta(seconds=60 * 400 + 30)
    cd.refresh_candles(spark, table(spark, start[:300]), path, now - timedelta(hours=2))
    late = [row(1000, 60 * 200 + 1, price=99.0), row(1001, 60 * 390 + 1, price=98.0)]
    cd.refresh_candles(spark, table(spark, start + late), path, now)
    minute = (F.unix_timestamp("bucket") - int(T0.timestamp())) / 60
    got = {
        r.m: r.open
        for r in cd.read_candles(spark, path).select(minute.cast("int").alias("m"), "open").collect()
    }
    # At minute 280.5 the whole buckets 161 to 278, at minute 400.5 those from 281 to 398.
    assert sorted(got) == [*range(161, 279), *range(281, 399)]
    assert got[390] == 98.0 and got[200] == 201.0


def test_live_stats_ranges(spark):
    as_of = T0 + timedelta(seconds=300)
    rows = [
        row(0, 0, price=100.0),  # exactly five minutes ago: outside
        row(1, 1, price=1.0, anomaly=True),
        row(2, 240, price=2.0),  # exactly one minute ago: only in the long range
        row(3, 241, price=3.0),
        row(4, 241, price=4.0),
        row(5, 100, "BBB", price=8.0),
    ]
    got = {r.symbol: r for r in st.live_stats(table(spark, rows), as_of).collect()}
    a = got["AAA"]
    assert (a.trades_1m, a.trades_5m, a.vol_1m, a.vol_5m, a.anomalies_5m) == (2, 4, 7.0, 10.0, 1)
    assert (a.price_high_1m, a.price_low_1m, a.latest_price) == (4.0, 3.0, 4.0)
    b = got["BBB"]
    assert (b.trades_1m, b.vol_1m, b.price_high_1m) == (0, None, None)
    totals = {r.symbol: r for r in st.stats_totals(st.live_stats(table(spark, rows), as_of)).collect()}
    assert totals["TOTAL"].vol_5m == 18.0 and totals["BBB"].vol_1m == 0.0


def test_feeds(spark):
    as_of = T0 + timedelta(seconds=300)
    rows = [row(i, i, "AAA" if i % 3 else "BBB", anomaly=i % 10 == 0) for i in range(300)]
    df = table(spark, rows)
    assert ids(fd.live_trades(df, 4, "aaa", as_of)) == [299, 298, 296, 295]
    assert ids(fd.live_trades(df, 4, None, as_of)) == [299, 298, 297, 294]
    assert ids(fd.anomaly_feed(df, 2, as_of=as_of)) == [290, 280]
    assert ids(fd.push_trades(df, as_of, 5)) == [299, 298, 297, 296]
    assert ids(fd.push_anomalies(df, as_of, 25)) == [290, 280]
    assert len(ids(fd.recent_anomalies(df, as_of))) == 30
    tabs = {r.tab: (r.row_count, r.anomaly_count) for r in fd.feed_tabs(df, ("AA", "BB")).collect()}
    assert tabs == {"ALL": (300, 30), "AA": (200, 20), "BB": (100, 10)}
    assert fd.feed_tab(df, "BBB").count() == 100


def test_merge_feed_prefers_new_rows(spark):
    old = table(spark, [row(1, 10, price=1.0), row(2, 20, price=1.0), row(3, 30, price=1.0)])
    new = table(spark, [row(2, 20, price=2.0), row(4, 5, price=2.0)])
    got = fd.merge_feed(new, old, cap=3).collect()
    assert [(r.trade_id, r.price) for r in got] == [(2, 2.0), (4, 2.0), (3, 1.0)]


def test_normalized_series(spark):
    df = spark.createDataFrame(
        [("A", 1, 5.0), ("A", 2, 10.0), ("A", 3, 7.5), ("B", 1, 3.0)],
        "symbol string, bucket int, close double",
    )
    got = {(r.symbol, r.bucket): (r.x, r.y) for r in fd.normalized_series(df).collect()}
    assert got == {("A", 1): (0.0, 54.0), ("A", 2): (50.0, 0.0), ("A", 3): (100.0, 27.0), ("B", 1): (0.0, 54.0)}


def test_json_rows_and_envelope(spark):
    df = table(spark, [row(1, 1.5), row(2, 2)])
    first = json.loads(output.rows_to_json(df.where("trade_id = 1")).first().json)
    assert first["time"] == "2024-03-01T00:00:01.500000Z" and first["z_score"] is None
    body = json.loads(output.push_envelope(df, "trades").first().message)
    assert body["type"] == "trades" and [r["trade_id"] for r in body["data"]] == [2, 1]
    assert output.push_envelope(df.limit(0), "trades").count() == 0


def test_default_settings_end_to_end(spark):
    """With one-minute windows, on dense trades."""
    params = Params(symbol_partitions=(("AAA", 0), ("BBB", 1), ("NONE", 2)))
    trades = spark.createDataFrame(make_trades(5, 1500), RAW_TRADE)
    stored = table_row(enrich(trades, params))
    assert stored.where("z_score IS NOT NULL").count() > 200
    windows = {r.symbol: r for r in st.window_stats(spark, trades, params).collect()}
    assert windows["NONE"].status == "no_data" and windows["AAA"].status is None
    assert cd.candles(stored).agg(F.sum("trade_count")).first()[0] == 1500


def test_days_do_not_depend_on_the_zone(spark, tmp_path):
    """Written under one zone; read, appended and refreshed under another."""
    from datetime import datetime, timedelta, timezone

    from pyspark.sql import functions as F

    from tickloom.operators.candles import read_candles, refresh_candles
    from tickloom.operators.sink import append_new
    from tickloom.params import Params
    from tickloom.schemas import TABLE_COLUMNS, TRADES_TABLE
    from tickloom.sources.table import read_trades, scan_recent

    start = datetime(2024, 3, 1, 22, 30, tzinfo=timezone.utc)
    rows = [
        {
            "trade_id": i,
            "time": start + timedelta(minutes=3 * i),
            "symbol": "AAA",
            "price": 1.0 + i,
            "quantity": 1.0,
            "usd_value": 1.0 + i,
            "classification": "Retail",
            "z_score": None,
            "is_anomaly": False,
        }
        for i in range(60)
    ]
    frame = spark.createDataFrame([tuple(r[c] for c in TABLE_COLUMNS) for r in rows], TRADES_TABLE)
    path, candle_path = str(tmp_path / "trades"), str(tmp_path / "candles")
    last = rows[-1]["time"]
    seen = []
    try:
        for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            counts = append_new(spark, frame, path, order=F.col("trade_id"))
            table = read_trades(spark, path)
            recent = scan_recent(table, last, 10_000).count()
            refresh_candles(spark, table, candle_path, last, Params(candle_seconds=3600))
            candles = read_candles(spark, candle_path).select(F.unix_micros("bucket"), "close", "day")
            seen.append((recent, sorted(tuple(r) for r in candles.collect())))
            assert (counts.inserted, counts.skipped) == ((60, 0) if zone == "UTC" else (0, 60))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen[0] == seen[1] == seen[2] and seen[0][0] == 56


def test_bounds_are_enforced(spark):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    rows = spark.range(5).selectExpr("id AS trade_id", "timestamp_seconds(id) AS time", "1.0D AS close")
    assert output.push_envelope(rows, "trades", 5).count() == 1
    with pytest.raises(PySparkException):
        output.push_envelope(rows, "trades", 4).collect()
    chart = rows.select(F.lit("A").alias("symbol"), F.col("time").alias("bucket"), "close")
    assert fd.normalized_series(chart, 5).count() == 5
    with pytest.raises(PySparkException):
        fd.normalized_series(chart, 4).collect()
