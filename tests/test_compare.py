"""Window figures and the comparison against plain Python on the same trades."""

import statistics
from datetime import timedelta

import pytest

from tickloom.operators import compare as cp
from tickloom.operators import stats as st
from tickloom.operators.enrich import enrich, table_row
from tickloom.params import Params
from tickloom.schemas import RAW_TRADE

from model import EPOCH, make_trades, run_model

PAIR = ("AAA", "BBB")


def params(**changes):
    return Params(symbol_partitions=(("AAA", 0), ("BBB", 1)), **changes)


def windows(rows, p):
    """Window values per symbol after its last trade, oldest first."""
    out = {}
    for s in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == s), key=lambda r: (r[3], r[4]))
        kept = []
        for r in mine:
            if kept and r[3] - kept[-1][0] > timedelta(seconds=p.stale_purge_seconds):
                kept = []
            kept = [e for e in kept if r[3] - e[0] <= timedelta(seconds=p.window_seconds)]
            kept.append((r[3], round(r[1] * r[2], 4)))
        out[s] = [v for _, v in kept]
    return out


@pytest.mark.parametrize("p", [params(), params(stale_purge_seconds=12, data_gap_reset_seconds=4)])
def test_comparison_matches_plain_python(spark, p):
    rows = make_trades(21, 1200)
    trades = spark.createDataFrame(rows, RAW_TRADE)
    got = cp.cross_asset_comparison(trades, p, PAIR).first()
    w = windows(rows, p)
    for side, s in (("btc", "AAA"), ("eth", "BBB")):
        row, vals = got[side], w[s]
        mean, sd = statistics.mean(vals), statistics.pstdev(vals)
        assert row.symbol == s and row.window_size == len(vals)
        assert row.volume_usd == pytest.approx(sum(vals), abs=0.01)
        assert row.avg_trade_usd == pytest.approx(mean, abs=0.01)
        assert row.stdev_usd == pytest.approx(sd, abs=0.01)
        assert row.volatility_cv == pytest.approx(sd / mean, abs=1e-4)
        assert (row.min_usd, row.max_usd) == (round(min(vals), 2), round(max(vals), 2))
    n = min(len(w["AAA"]), len(w["BBB"]))
    assert n >= 10
    a, b = w["AAA"][-n:], w["BBB"][-n:]
    assert got.rolling_correlation == pytest.approx(statistics.correlation(a, b), abs=1e-4)

    def recent(v):
        return (statistics.mean(v[-5:]) - statistics.mean(v[:-5])) / statistics.pstdev(v[:-5])

    assert got.btc_recent_z == pytest.approx(recent(a), abs=1e-3)
    assert got.eth_recent_z == pytest.approx(recent(b), abs=1e-3)
    apart = abs(recent(b) - recent(a))
    assert got.relative_divergence == pytest.approx(apart, abs=1e-3)
    assert got.divergence_alert == (apart > 2.0)
    total = got.btc.volume_usd + got.eth.volume_usd
    assert got.btc_volume_share == pytest.approx(got.btc.volume_usd / total, abs=1e-4)


def few(n_a, n_b, value=lambda i: 10.0 + i):
    rows = [("AAA", value(i), 1.0, EPOCH + timedelta(seconds=i), i) for i in range(n_a)]
    return rows + [("BBB", value(i * i), 1.0, EPOCH + timedelta(seconds=i), 100 + i) for i in range(n_b)]


def test_few_trades_give_no_figures(spark):
    def figures(rows):
        df = spark.createDataFrame(rows, RAW_TRADE)
        return cp.cross_asset_comparison(df, params(), PAIR).first()

    four, seven, ten = figures(few(4, 9)), figures(few(7, 9)), figures(few(10, 12))
    assert four.rolling_correlation is None and four.btc_recent_z is None
    assert seven.rolling_correlation is not None and seven.divergence_alert is None
    assert ten.btc_recent_z is not None and ten.divergence_alert is not None
    flat = figures(few(12, 12, value=lambda i: 5.0))
    assert flat.rolling_correlation is None and flat.btc_recent_z == 0.0
    alone = figures(few(12, 0))
    assert alone.eth.status == "no_data" and alone.eth.symbol == "BBB"
    assert alone.btc_volume_share == 1.0 and alone.eth_volume_share == 0.0
    nobody = figures([("CCC", 1.0, 1.0, EPOCH, 1)])
    assert nobody.btc.status == "no_data" and nobody.btc_volume_share is None


def test_fallback_uses_one_common_time(spark):
    p = params()
    rows = few(40, 40)
    table = table_row(enrich(spark.createDataFrame(rows, RAW_TRADE), p))
    got = cp.comparison_fallback(spark, table, EPOCH + timedelta(seconds=69), p, PAIR).first()
    assert got.source == "db_fallback" and got.divergence_alert is False
    assert got.btc.window_size == 30 and got.btc.warmed_up is True
    later = cp.comparison_fallback(spark, table, EPOCH + timedelta(seconds=70), p, PAIR).first()
    assert later.btc.window_size == 29 and later.btc.warmed_up is False
    ratios = cp.comparison_ratios(cp.cross_asset_comparison(
        spark.createDataFrame(rows, RAW_TRADE), p, PAIR)).first()
    assert ratios.eth_volume_pct == 100.0 and 0 < ratios.btc_volume_pct < 100
    assert 0 <= ratios.correlation_pct <= 100


def test_window_state_counts_the_last_trade(spark):
    p = params()
    rows = make_trades(22, 900)
    model = run_model(rows, p)
    w = windows(rows, p)
    got = {r.symbol: r for r in st.window_stats(spark, spark.createDataFrame(rows, RAW_TRADE), p).collect()}
    for s in PAIR:
        last = max((r for r in rows if r[0] == s), key=lambda r: (r[3], r[4]))
        n, _, _, paused = model[last[4]]
        assert got[s].window_size == n + 1 == len(w[s])
        if not paused:
            assert got[s].in_gap_pause is False and got[s].warmed_up == (n + 1 >= 30)


def test_window_state_in_a_pause(spark):
    p = params(warmup_min_samples=5)
    rows = [("AAA", 1.0, 1.0, EPOCH + timedelta(seconds=t), i) for i, t in enumerate([0, 1, 2, 3, 4, 5, 6, 20, 21])]
    df = spark.createDataFrame(rows, RAW_TRADE)
    row = st.window_stats(spark, df, p, "aaa").first()
    assert row.in_gap_pause is True and row.warmed_up is False and row.window_size == 9
    more = rows + [("AAA", 1.0, 1.0, EPOCH + timedelta(seconds=22 + i), 50 + i) for i in range(3)]
    row = st.window_stats(spark, spark.createDataFrame(more, RAW_TRADE), p, "AAA").first()
    assert row.in_gap_pause is False and row.warmed_up is True
