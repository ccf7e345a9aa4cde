import pytest
from pyspark.sql import functions as F

from tickloom.functions import labels as lb
from tickloom.functions import trade as fx
from tickloom.functions.timing import time_bucket
from tickloom.operators import candles as cd
from tickloom.operators import feeds as fd
from tickloom.params import Params


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "usd,expected",
    [(499.9999, "Retail"), (500.0, "Pro"), (50_000.0, "Pro"), (50_000.0001, "Whale")],
)
def test_size_class_limits(spark, usd, expected):
    assert one(spark, fx.size_class(F.lit(usd), Params())) == expected


def test_z_floor_and_strict_limit(spark):
    assert one(spark, fx.regularized_z(F.lit(110.0), F.lit(100.0), F.lit(0.0))) == 10.0
    assert one(spark, fx.regularized_z(F.lit(11e3), F.lit(1e4), F.lit(0.0))) == 100.0
    assert one(spark, fx.anomaly_flag(F.lit(3.0), Params())) is False
    assert one(spark, fx.anomaly_flag(F.lit(-3.0001), Params())) is True
    assert one(spark, fx.anomaly_flag(F.lit(None).cast("double"), Params())) is False


def limb_table(spark, units):
    df = spark.createDataFrame([(float(u),) for u in units], "u double")
    return df.select(*fx.limbs(F.col("u") / fx.USD_SCALE))


def test_sums_of_everyday_amounts_are_exact(spark):
    units = [10**9 + 7, 123_456_789, 1, 9 * 10**11 + 3, 0] * 300
    sums = fx.limb_sums(F.col("hi"), F.col("lo"))
    row = limb_table(spark, units).agg(*[c.alias(n) for n, c in sums.items()]).first()
    split = int(fx.SPLIT)
    assert int(row.hi) * split + int(row.lo) == sum(units)
    squares = int(row.hihi) * split**2 + 2 * split * int(row.hilo) + int(row.lolo)
    assert squares == sum(u * u for u in units)


@pytest.mark.parametrize(
    "values", [[5, 5, 5], [10**13, 10**13 + 2], [1, 2, 3, 10**15], [7], [2**20 - 1, 2**20, 2**20 + 1]]
)
def test_deviation_does_not_cancel(spark, values):
    from fractions import Fraction

    sums = fx.limb_sums(F.col("hi"), F.col("lo"))
    got = limb_table(spark, values).agg(fx.stdev_from_sums(F.count("hi"), sums)).first()[0]
    mean = Fraction(sum(values), len(values))
    want = float(sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5 / fx.USD_SCALE
    assert got == pytest.approx(want, rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("usd", [1e12, 8e14, 1e16, 1e30, 1e150, 1.7e308])
def test_amounts_of_any_size_are_added_up(spark, usd):
    df = spark.createDataFrame([(usd,), (usd / 2,), (0.5,)], "usd double").select(*fx.limbs(F.col("usd")))
    sums = fx.limb_sums(F.col("hi"), F.col("lo"))
    n = F.count("hi")
    row = df.agg(n.alias("n"), fx.mean_from_sums(n, sums).alias("m"), fx.stdev_from_sums(n, sums).alias("s")).first()
    values = [usd, usd / 2, 0.5]
    mean = sum(v / 3 for v in values)
    assert row.n == 3 and row.m == (pytest.approx(mean, rel=1e-14) if usd < 1e300 else float("inf"))
    if usd <= 1e150:
        want = mean * (sum((v / mean - 1) ** 2 for v in values) / 3) ** 0.5
        assert row.s == pytest.approx(want, rel=1e-14)
    else:
        assert row.s == float("inf")


def test_amounts_that_are_not_finite_have_no_limbs(spark):
    for usd in (float("inf"), float("nan"), None):
        row = spark.range(1).select(*fx.limbs(F.lit(usd).cast("double"))).first()
        assert row.hi is None and row.lo is None


@pytest.mark.parametrize(
    "value,expected",
    [
        (None, "—"),
        (float("nan"), "—"),
        (12.4, "$12"),
        (999.0, "$999"),
        (1250.0, "$1.3K"),
        (2_340_000.0, "$2.34M"),
        (5e9, "$5.00B"),
    ],
)
def test_fmt_usd(spark, value, expected):
    assert one(spark, lb.fmt_usd(F.lit(value).cast("double"))) == expected


def test_other_labels(spark):
    assert one(spark, lb.fmt_price(F.lit(1234567.891))) == "$1,234,567.89"
    assert one(spark, lb.fmt_z(F.lit(-0.456))) == "-0.46"
    assert one(spark, lb.fmt_z(F.lit(2.0))) == "+2.00"
    assert one(spark, lb.fmt_percent(F.lit(0.1234))) == "12.3%"
    assert one(spark, lb.fmt_count(F.lit(12345))) == "12,345"
    assert one(spark, lb.fmt_cv(F.lit(0.12345))) == "0.123"
    assert one(spark, lb.base_asset(F.lit("BTCUSDT"))) == "BTC"
    assert one(spark, lb.base_asset(F.lit("USDTUSDT"))) == "USDT"
    assert one(spark, lb.base_asset(F.lit("DOGE"))) == "DOGE"
    assert one(spark, lb.asset_family(F.lit("SOLUSDT"))) == "eth"
    at = F.lit("2024-01-01 01:02:03.987654").cast("timestamp")
    assert one(spark, lb.fmt_time(at)) == "01:02:03"
    assert one(spark, lb.fmt_time_centis(at)) == "01:02:03.98"
    none = F.lit(None).cast("double")
    text = lb.describe_trade(F.lit("BTCUSDT"), F.lit(1234.5), F.lit("Pro"), none, F.lit(False))
    assert one(spark, text) == "[BTCUSDT] $1,234.50 (Pro) z=warming"
    text = lb.describe_trade(F.lit("B"), F.lit(1.0), F.lit("Pro"), F.lit(-4.236), F.lit(True))
    assert one(spark, text) == "[B] $1.00 (Pro) z=-4.24 🚨ANOMALY"


def test_symbol_white_space(spark):
    assert one(spark, fx.normalize_symbol(F.lit("\t btc usdt\n"))) == "BTC USDT"


def test_buckets_before_the_epoch(spark):
    at = F.lit("1969-12-31 23:59:30").cast("timestamp")
    assert one(spark, F.unix_micros(time_bucket(60, at))) == -60_000_000


def test_limits_are_checked(spark):
    empty = spark.createDataFrame([], "time timestamp, symbol string")
    with pytest.raises(ValueError):
        fd.live_trades(empty, limit=201)
    with pytest.raises(ValueError):
        fd.anomaly_feed(empty, limit=101)
    with pytest.raises(ValueError):
        fd.anomaly_feed(empty, minutes=1441)
    with pytest.raises(ValueError):
        cd.ohlcv(empty, "A", minutes=-1)


def test_params_from_environment():
    env = {"WINDOW_SECONDS": "30", "Z_SCORE_THRESHOLD": "2.5", "KAFKA_TOPIC_RAW": "t", "OTHER": "x"}
    p = Params.from_env(env)
    assert (p.window_seconds, p.z_score_threshold, p.topic) == (30, 2.5, "t")
    with pytest.raises(ValueError):
        Params(window_seconds=0)
