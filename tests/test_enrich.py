import random
from datetime import timedelta

import pytest

from tickloom.operators.enrich import distinct_trades, enrich, enrich_once, rolling_state
from tickloom.params import Params
from tickloom.schemas import RAW_TRADE

from model import EPOCH, make_trades, run_model

SETTINGS = [
    Params(),
    Params(slice_factor=1),
    Params(warmup_min_samples=10, data_gap_reset_seconds=3, stale_purge_seconds=20),
    Params(
        window_seconds=20,
        warmup_min_samples=12,
        data_gap_reset_seconds=15,
        stale_purge_seconds=9,
        slice_factor=2,
    ),
]


@pytest.mark.parametrize("i", range(len(SETTINGS)))
@pytest.mark.parametrize("seed,step", [(1, 1250), (2, 2500)])
def test_matches_row_by_row_model(spark, i, seed, step):
    params = SETTINGS[i]
    rows = make_trades(seed, 2000, mean_step_ms=step)
    expected = run_model(rows, params)
    df = spark.createDataFrame(rows, RAW_TRADE)
    got = rolling_state(df, params).collect()
    assert len(got) == len(rows)
    for r in got:
        n, z, anomaly, paused = expected[r.trade_id]
        assert r.n == n
        assert (r.z_score is None) == (z is None), r
        if z is not None:
            assert r.z_score == pytest.approx(z, rel=1e-9, abs=1e-9)
        assert r.is_anomaly == anomaly
        assert (r.pause_seg > 0 and not r.pause_over) == paused, r


def test_crowded_moments_and_id_blocks(spark):
    """Many trades at few moments, their ids in several blocks."""
    params = Params(warmup_min_samples=5)
    rng = random.Random(3)
    rows = [
        ("AAA", rng.randint(1, 900) / 100, 1.0, EPOCH + timedelta(seconds=i // 40 * 7), i * 300_000)
        for i in range(600)
    ]
    expected = run_model(rows, params)
    df = spark.createDataFrame(rows, RAW_TRADE)
    got = rolling_state(df, params).collect()
    assert len(got) == len(rows)
    for r in got:
        n, z, anomaly, paused = expected[r.trade_id]
        assert r.n == n and r.is_anomaly == anomaly
        assert (r.z_score is None) == (z is None)
        assert z is None or r.z_score == pytest.approx(z, rel=1e-9, abs=1e-9)
        assert (r.pause_seg > 0 and not r.pause_over) == paused


def test_replays_count_once(spark):
    rows = make_trades(4, 300)
    df = spark.createDataFrame(rows, RAW_TRADE)
    twice = df.unionByName(df.where("trade_id % 3 = 0"))
    params = Params(warmup_min_samples=5)

    def shape(result):
        return sorted((r.trade_id, r.z_score is None, round(r.z_score or 0.0, 9)) for r in result.collect())

    assert shape(enrich_once(twice, params)) == shape(enrich(df, params))
    assert enrich_once(twice, params, dedup_before_enrich=False).count() == 400


def test_large_amounts_do_not_stop_the_job(spark):
    """Many amounts of 1e10 in one slice, and some beyond any sum."""
    rows = [("AAA", 1e10 + i, 1.0, EPOCH + timedelta(milliseconds=10 * i), i) for i in range(1200)]
    params = Params()
    expected = run_model(rows, params)
    got = rolling_state(spark.createDataFrame(rows, RAW_TRADE), params).collect()
    for r in got:
        n, z, anomaly, _ = expected[r.trade_id]
        assert r.n == n and r.is_anomaly == anomaly
        assert z is None or r.z_score == pytest.approx(z, rel=1e-6, abs=1e-6)
    odd = [("AAA", p, 1.0, EPOCH + timedelta(seconds=60 + i), 2000 + i) for i, p in enumerate((1e16, float("inf"), 1e300))]
    assert enrich(spark.createDataFrame(rows + odd, RAW_TRADE), params).count() == 1203


def test_nothing_runs_before_an_action(spark):
    df = spark.createDataFrame(make_trades(1, 50), RAW_TRADE)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "no job")
    enrich_once(df, Params())
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("other", "")


def test_the_first_arrival_stays(spark):
    rows = [("AAA", 9.0, 1.0, EPOCH, 1, 0), ("AAA", 5.0, 1.0, EPOCH, 1, 1)]
    df = spark.createDataFrame(rows, RAW_TRADE.simpleString()[7:-1].replace(":", " ") + ", offset long")
    from pyspark.sql import functions as F

    kept = distinct_trades(df, order=F.col("offset")).collect()
    assert [r.price for r in kept] == [9.0]
