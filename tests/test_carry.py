"""What is kept between runs: the carry of each symbol, and the files of the table."""

from datetime import timedelta

from pyspark.sql import functions as F

from tickloom.operators.carry import CarryStore, advance, tail
from tickloom.operators.enrich import enrich, table_row
from tickloom.operators.sink import append_new, compact_days
from tickloom.operators.stats import window_stats
from tickloom.params import Params
from tickloom.schemas import RAW_TRADE
from tickloom.sources.table import read_trades

from model import EPOCH, make_trades

PARAMS = Params(warmup_min_samples=10, data_gap_reset_seconds=5)


def figures(df):
    return sorted((r.trade_id, r.z_score and round(r.z_score, 9), r.is_anomaly) for r in df.collect())


def test_a_resumed_run_gives_what_a_whole_run_gives(spark, tmp_path):
    rows = spark.createDataFrame(make_trades(21, 600), RAW_TRADE)
    store = CarryStore(spark, str(tmp_path / "carry"))
    assert store.latest() == (None, None)
    for minutes in (2, 5, 3):  # an earlier moment changes nothing
        advance(store, rows, EPOCH + timedelta(minutes=minutes), PARAMS)
    assert len(store.moments()) == 2
    carry, since = store.latest()
    whole = enrich(rows, PARAMS).where(F.unix_micros("event_time") >= since)
    found = figures(enrich(tail(rows, since, PARAMS), PARAMS, carry, since))
    assert found and found == figures(whole)


def test_with_a_carry_only_the_end_of_the_table_is_scanned(spark, tmp_path):
    path = str(tmp_path / "trades")
    spark.createDataFrame(make_trades(22, 400), RAW_TRADE).write.parquet(path)
    rows = spark.read.parquet(path)
    store = CarryStore(spark, str(tmp_path / "carry"))
    advance(store, rows, EPOCH + timedelta(minutes=4), PARAMS)
    carry, since = store.latest()
    plan = enrich(tail(rows, since, PARAMS), PARAMS, carry, since)._jdf.queryExecution().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "price" in line]
    assert scans and all("GreaterThanOrEqual(event_time" in line for line in scans)


def test_window_snapshots_agree_with_and_without_a_carry(spark, tmp_path):
    params = Params(
        warmup_min_samples=10, data_gap_reset_seconds=5, symbol_partitions=(("AAA", 0), ("BBB", 1))
    )
    rows = spark.createDataFrame(make_trades(23, 500), RAW_TRADE)
    store = CarryStore(spark, str(tmp_path / "carry"))
    advance(store, rows, EPOCH + timedelta(minutes=3), params)
    alone = window_stats(spark, rows, params)
    stored = window_stats(spark, rows, params, store=store)
    assert sorted(map(str, alone.collect())) == sorted(map(str, stored.collect())) != []


def test_days_with_many_small_files_are_put_together(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = table_row(enrich(spark.createDataFrame(make_trades(24, 90), RAW_TRADE), PARAMS)).collect()
    late = [(r.trade_id + 1000, r.time + timedelta(days=1), *r[2:]) for r in rows[:5]]
    schema = "trade_id bigint, time timestamp, symbol string, price double, quantity double, "
    schema += "usd_value double, classification string, z_score double, is_anomaly boolean"
    for n in range(9):
        append_new(spark, spark.createDataFrame(rows[n::9], schema), path)
    append_new(spark, spark.createDataFrame(late, schema), path)
    before = sorted(map(str, read_trades(spark, path).collect()))
    files = read_trades(spark, path).select("day", F.col("_metadata.file_path").alias("f")).distinct()
    assert files.count() >= 10
    assert compact_days(spark, path, PARAMS) == 1
    files = read_trades(spark, path).select("day", F.col("_metadata.file_path").alias("f")).distinct()
    assert files.count() == 2
    assert sorted(map(str, read_trades(spark, path).collect())) == before
    assert compact_days(spark, path, PARAMS) == 0
