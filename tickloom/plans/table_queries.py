"""Queries on the stored table: candles, statistics, feeds."""

from pyspark.sql import functions as F

from tickloom.functions.timing import time_bucket
from tickloom.operators import candles as cd
from tickloom.operators import feeds as fd
from tickloom.operators import output
from tickloom.operators import stats as st
from tickloom.plans import tables as tb
from tickloom.plans.registry import query
from tickloom.plans.sql import TRADES, after, bucket, candle_columns, rolling
from tickloom.plans.tables import LONG_SECONDS, PAIR, SCALED, SHORT_SECONDS
from tickloom.session import fresh_path
from tickloom.sources.table import scan_recent

ONE = PAIR[0]
TABLE = "trade_id, time, symbol, price, quantity, usd_value, classification, round(z_score, 6) AS z_score, is_anomaly"
ALARM = "trade_id, time, symbol, price, usd_value, classification, round(z_score, 6) AS z_score"


def _table(spark, sf_dir):
    table = tb.stored_trades(spark, sf_dir)
    return table, tb.latest(tb.trades(spark, sf_dir))


def _rounded(df, **digits):
    for name, places in digits.items():
        df = df.withColumn(name, F.round(name, places))
    return df


def _z(df):
    return _rounded(df, z_score=6)


def _candle(df):
    return _rounded(df, usd_volume=2, avg_z_score=6)


# --- scans and candles -----------------------------------------------------------


@query("scan_recent", f"WITH {rolling()} SELECT {TABLE} FROM enriched WHERE {after(LONG_SECONDS)}")
def recent(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(scan_recent(table, as_of, LONG_SECONDS))


@query(
    "rows_to_json",
    f"""WITH {TRADES}
SELECT trade_id, symbol, price, usd_value,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS time FROM priced""",
)
def rows_to_json(spark, sf_dir):
    """Table rows as JSON texts, read back field by field."""
    text = output.rows_to_json(tb.stored_trades(spark, sf_dir).drop("day"))
    body = F.from_json(
        "json", "trade_id long, symbol string, price double, usd_value double, time string"
    )
    return text.select(body.alias("b")).select("b.*")


@query(
    "candles_1m",
    f"""WITH {rolling()}
SELECT {bucket()} AS bucket, symbol, {candle_columns()} FROM enriched GROUP BY 1, 2""",
)
def candles_1m(spark, sf_dir):
    return _candle(cd.candles(tb.stored_trades(spark, sf_dir), SCALED))


@query(
    "ohlcv",
    f"""WITH {rolling()}
SELECT {bucket()} AS bucket, {candle_columns()} FROM enriched
WHERE symbol = '{ONE}' AND {after(240 * SCALED.candle_seconds)} GROUP BY 1""",
)
def ohlcv(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _candle(cd.ohlcv(table, ONE.lower(), 240, as_of, SCALED))


@query(
    "time_bucket",
    f"""WITH {TRADES}
SELECT {bucket('event_time')} AS bucket, count(*) AS trade_count FROM trades GROUP BY 1""",
)
def buckets(spark, sf_dir):
    width = SCALED.candle_seconds
    return (
        tb.trades(spark, sf_dir)
        .groupBy(time_bucket(width, F.col("event_time")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("trade_count"))
    )


_HOUR = SCALED.candle_seconds * 1_000_000


@query(
    "refresh_candles",
    f"""WITH {rolling()}, span AS (
  SELECT (epoch_us(as_of) - 119 * {_HOUR} - 1) // {_HOUR} * {_HOUR} AS first,
         (epoch_us(as_of) - {_HOUR}) // {_HOUR} * {_HOUR} AS past FROM present)
SELECT {bucket()} AS bucket, symbol, {candle_columns()} FROM enriched, span
WHERE epoch_us(time) >= first AND epoch_us(time) < past GROUP BY 1, 2""",
)
def refresh(spark, sf_dir):
    """Candle table after two refreshes at the same time; the second changes nothing."""
    table, as_of = _table(spark, sf_dir)
    path = fresh_path(spark, "candles")
    for _ in range(2):
        cd.refresh_candles(spark, table, path, as_of, SCALED)
    return _candle(cd.read_candles(spark, path).select(*cd.CANDLE_COLUMNS))


_SERIES = f"""series AS (
  SELECT {bucket()} AS bucket, symbol, arg_max(price, (time, trade_id)) AS close,
         round(sum(usd_value), 2) AS vol, count(*) FILTER (WHERE is_anomaly) AS anom
  FROM enriched WHERE {after(1440 * SCALED.candle_seconds)} GROUP BY 1, 2)"""


def _series(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    rows = cd.scan_after(table, as_of, 1440 * SCALED.candle_seconds)
    return cd.candle_series(cd.candles(rows, SCALED))


@query(
    "candle_series",
    f"""WITH {rolling()}, {_SERIES}
SELECT strftime(bucket, '%H:%M:%S') AS t, bucket, symbol, close, vol, anom FROM series""",
)
def candle_series(spark, sf_dir):
    return _rounded(_series(spark, sf_dir), vol=2)


@query(
    "normalized_series",
    f"""WITH {rolling()}, {_SERIES}
SELECT symbol, bucket,
       round(CASE WHEN count(*) OVER s = 1 THEN 0.0
             ELSE (row_number() OVER (PARTITION BY symbol ORDER BY bucket) - 1)
                  / (count(*) OVER s - 1) * 100 END, 6) AS x,
       round(54 - (close - min(close) OVER s)
             / CASE WHEN max(close) OVER s = min(close) OVER s THEN 1.0
                    ELSE max(close) OVER s - min(close) OVER s END * 54, 6) AS y
FROM series WINDOW s AS (PARTITION BY symbol)""",
)
def normalized(spark, sf_dir):
    return _rounded(fd.normalized_series(_series(spark, sf_dir)), x=6, y=6)


# --- statistics ------------------------------------------------------------------

LIVE = f"""live AS (
  SELECT symbol, count(*) FILTER (WHERE {after(SHORT_SECONDS)}) AS trades_1m,
         count(*) AS trades_5m,
         sum(usd_value) FILTER (WHERE {after(SHORT_SECONDS)}) AS vol_1m,
         sum(usd_value) AS vol_5m, count(*) FILTER (WHERE is_anomaly) AS anomalies_5m,
         max(time) AS last_trade,
         max(price) FILTER (WHERE {after(SHORT_SECONDS)}) AS price_high_1m,
         min(price) FILTER (WHERE {after(SHORT_SECONDS)}) AS price_low_1m,
         arg_max(price, (time, trade_id)) AS latest_price
  FROM enriched WHERE {after(LONG_SECONDS)} GROUP BY symbol)"""

LIVE_COLUMNS = """symbol, trades_1m, trades_5m, round(vol_1m, 2) AS vol_1m,
  round(vol_5m, 2) AS vol_5m, anomalies_5m, last_trade, price_high_1m, price_low_1m, latest_price"""


def _live(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return st.live_stats(table, as_of, SHORT_SECONDS, LONG_SECONDS), as_of


@query("live_stats", f"WITH {rolling()}, {LIVE} SELECT {LIVE_COLUMNS} FROM live")
def live_stats(spark, sf_dir):
    return _rounded(_live(spark, sf_dir)[0], vol_1m=2, vol_5m=2)


@query(
    "stats_totals",
    f"""WITH {rolling()}, {LIVE}
SELECT coalesce(symbol, 'TOTAL') AS symbol, CAST(coalesce(sum(trades_1m), 0) AS BIGINT) AS trades_1m,
       round(coalesce(sum(vol_1m), 0), 2) AS vol_1m, round(coalesce(sum(vol_5m), 0), 2) AS vol_5m,
       CAST(coalesce(sum(anomalies_5m), 0) AS BIGINT) AS anomalies_5m
FROM live GROUP BY ROLLUP (symbol)""",
)
def stats_totals(spark, sf_dir):
    return _rounded(st.stats_totals(_live(spark, sf_dir)[0]), vol_1m=2, vol_5m=2)


# Window content of each symbol as of its own last trade.
WINDOW = f"""last AS (
  SELECT symbol, max(t) AS last_t, arg_max(purge_seg, (t, trade_id)) AS purge_seg,
         arg_max(pause_seg > 0 AND NOT pause_over, (t, trade_id)) AS paused,
         arg_max(n_since_gap, (t, trade_id)) + 1 AS since_gap,
         max(event_time) AS last_event
  FROM state GROUP BY symbol
), members AS (
  SELECT s.*, l.paused, l.since_gap, l.last_event FROM state s JOIN last l USING (symbol)
  WHERE s.purge_seg = l.purge_seg AND s.t >= l.last_t - {SCALED.window_us}
), windows AS (
  SELECT symbol, count(*) AS window_size, bool_or(paused AND since_gap < {SCALED.warmup_min_samples})
           AS in_gap_pause,
         count(*) >= {SCALED.warmup_min_samples} AND
           NOT bool_or(paused AND since_gap < {SCALED.warmup_min_samples}) AS warmed_up,
         max(last_event) AS last_event, sum(q) AS sx,
         CAST(sum(q) AS DOUBLE) / count(*) / 10000 AS mu,
         sqrt(CAST(count(*) * sum(q * q) - sum(q) * sum(q) AS DOUBLE)) / count(*) / 10000 AS sd,
         min(usd_value) AS lo, max(usd_value) AS hi
  FROM members GROUP BY symbol)"""

CONFIGURED = "(SELECT unnest([{}]) AS symbol) c".format(
    ", ".join(f"'{s}'" for s in (*PAIR, "DOGEUSDT"))
)
# One configured symbol has no trades at all.
WITH_MISSING = SCALED.with_(symbol_partitions=((PAIR[0], 0), (PAIR[1], 1), ("DOGEUSDT", 2)))


@query(
    "window_stats",
    f"""WITH {rolling()}, {WINDOW}
SELECT c.symbol, CASE WHEN window_size IS NULL THEN 'no_data' END AS status, window_size, warmed_up,
       in_gap_pause, last_event, round(mu, 2) AS mean_usd, round(sd, 2) AS stdev_usd,
       round(lo, 2) AS min_usd, round(hi, 2) AS max_usd
FROM {CONFIGURED} LEFT JOIN windows USING (symbol)""",
)
def window_stats(spark, sf_dir):
    return st.window_stats(
        spark, tb.trades(spark, sf_dir), WITH_MISSING, store=tb.stored_carry(spark, sf_dir)
    )


@query(
    "zwindow_ready",
    f"""WITH {rolling()}, {WINDOW}
SELECT CASE WHEN bool_and(coalesce(warmed_up, false)) THEN 'LIVE' ELSE 'WARM' END AS z_window,
       count(*) FILTER (WHERE warmed_up) AS warmed_symbols, count(*) AS symbol_count
FROM {CONFIGURED} LEFT JOIN windows USING (symbol)""",
)
def zwindow_ready(spark, sf_dir):
    return st.zwindow_ready(st.window_stats(
        spark, tb.trades(spark, sf_dir), WITH_MISSING, store=tb.stored_carry(spark, sf_dir)
    ))


@query(
    "stats_with_windows",
    f"""WITH {rolling()}, {LIVE}, {WINDOW}
SELECT {LIVE_COLUMNS}, window_size, warmed_up, in_gap_pause, last_event, round(mu, 2) AS mean_usd,
       round(sd, 2) AS stdev_usd, (SELECT as_of FROM present) AS as_of
FROM live LEFT JOIN (SELECT * FROM windows WHERE symbol IN {PAIR}) w USING (symbol)""",
)
def stats_with_windows(spark, sf_dir):
    live, as_of = _live(spark, sf_dir)
    store = tb.stored_carry(spark, sf_dir)
    windows = st.window_stats(spark, tb.trades(spark, sf_dir), SCALED, store=store)
    return _rounded(
        st.stats_with_windows(spark, live, windows, as_of), vol_1m=2, vol_5m=2
    )


SUMMARY = f"""summary AS (
  SELECT symbol, count(*) AS window_size, sum(usd_value) AS volume_usd, avg(usd_value) AS avg_trade_usd,
         stddev_pop(usd_value) AS stdev_usd, min(usd_value) AS min_usd, max(usd_value) AS max_usd
  FROM enriched WHERE {after(SCALED.window_seconds)} GROUP BY symbol)"""


def _summary(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return st.window_summary(table, as_of, SCALED)


@query(
    "window_summary",
    f"""WITH {rolling()}, {SUMMARY}
SELECT symbol, window_size, round(volume_usd, 2) AS volume_usd, round(avg_trade_usd, 4) AS avg_trade_usd,
       round(stdev_usd, 4) AS stdev_usd, min_usd, max_usd FROM summary""",
)
def window_summary(spark, sf_dir):
    return _rounded(_summary(spark, sf_dir), volume_usd=2, avg_trade_usd=4, stdev_usd=4)


@query(
    "volatility_cv",
    f"""WITH {rolling()}, {SUMMARY}
SELECT symbol, CASE WHEN avg_trade_usd > 0 THEN round(stdev_usd / avg_trade_usd, 4) END
         AS volatility_cv FROM summary""",
)
def volatility_cv(spark, sf_dir):
    return st.volatility(_summary(spark, sf_dir))


@query(
    "volume_share",
    f"""WITH {rolling()}, {SUMMARY}
SELECT symbol, round(volume_usd / sum(volume_usd) OVER (), 4) AS volume_share FROM summary""",
)
def volume_share(spark, sf_dir):
    return st.volume_share(_summary(spark, sf_dir))


@query(
    "symbol_summary",
    f"""WITH {rolling()}, {SUMMARY}
SELECT c.symbol, window_size, round(volume_usd, 2) AS volume_usd, round(avg_trade_usd, 2) AS avg_trade_usd,
       round(stdev_usd, 2) AS stdev_usd,
       CASE WHEN avg_trade_usd > 0 THEN round(stdev_usd / avg_trade_usd, 4) END AS volatility_cv,
       round(min_usd, 2) AS min_usd, round(max_usd, 2) AS max_usd,
       window_size >= {SCALED.warmup_min_samples} AS warmed_up,
       CASE WHEN window_size IS NULL THEN 'no_data' END AS status
FROM {CONFIGURED} LEFT JOIN summary USING (symbol)""",
)
def symbol_summary(spark, sf_dir):
    return st.symbol_summary(spark, _summary(spark, sf_dir), WITH_MISSING)


# --- feeds -----------------------------------------------------------------------


def top_per_symbol(seconds: float, count: int) -> str:
    return f"""SELECT {TABLE} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC, trade_id DESC) AS rn
  FROM enriched WHERE {after(seconds)}) WHERE rn <= {count}"""


@query(
    "live_trades_symbol",
    f"""WITH {rolling()}
SELECT {TABLE} FROM enriched WHERE symbol = '{ONE}' AND {after(LONG_SECONDS)}
ORDER BY time DESC, trade_id DESC LIMIT 50""",
)
def live_trades_symbol(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(fd.live_trades(table, 50, ONE.lower(), as_of, LONG_SECONDS))


@query("live_trades_per_symbol", f"WITH {rolling()} {top_per_symbol(LONG_SECONDS, 25)}")
def live_trades_per_symbol(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(fd.live_trades(table, 50, None, as_of, LONG_SECONDS))


@query(
    "push_trades", f"WITH {rolling()} {top_per_symbol(tb.PUSH_TRADES_SECONDS, 20)}"
)
def push_trades(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(fd.push_trades(table, as_of, tb.PUSH_TRADES_SECONDS))


@query(
    "anomaly_feed",
    f"""WITH {rolling()}
SELECT {ALARM}, is_anomaly FROM enriched WHERE is_anomaly AND {after(240 * 3600)}
ORDER BY time DESC, trade_id DESC LIMIT 20""",
)
def anomaly_feed(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(fd.anomaly_feed(table, 20, None, 240, as_of, minute_seconds=3600))


@query(
    "push_anomalies",
    f"""WITH {rolling()}
SELECT {ALARM} FROM enriched WHERE is_anomaly AND {after(tb.PUSH_ANOMALIES_SECONDS)}
ORDER BY time DESC, trade_id DESC LIMIT 10""",
)
def push_anomalies(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(fd.push_anomalies(table, as_of, tb.PUSH_ANOMALIES_SECONDS))


@query(
    "recent_anomalies",
    f"WITH {rolling()} SELECT {ALARM} FROM enriched WHERE is_anomaly AND {after(LONG_SECONDS)}",
)
def recent_anomalies(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    return _z(fd.recent_anomalies(table, as_of, LONG_SECONDS))


@query(
    "merge_feed",
    f"""WITH {rolling()}, incoming AS ({top_per_symbol(SHORT_SECONDS, 20)}),
previous AS ({top_per_symbol(LONG_SECONDS, 25)}), shown AS (
  SELECT *, 0 AS k FROM incoming UNION ALL SELECT *, 1 AS k FROM previous
), firsts AS (
  SELECT *, row_number() OVER (PARTITION BY trade_id ORDER BY k) AS rn FROM shown)
SELECT trade_id, time, symbol, price, quantity, usd_value, classification, z_score, is_anomaly
FROM firsts WHERE rn = 1 ORDER BY k, time DESC, trade_id DESC LIMIT 100""",
)
def merge_feed(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    incoming = fd.push_trades(table, as_of, SHORT_SECONDS)
    previous = fd.live_trades(table, 50, None, as_of, LONG_SECONDS)
    return _z(fd.merge_feed(incoming, previous))


@query(
    "feed_tabs",
    f"""WITH {rolling()}, feed AS ({top_per_symbol(LONG_SECONDS, 25)}), tabs AS (
  SELECT 'ALL' AS tab, * FROM feed
  UNION ALL SELECT 'PUR', * FROM feed WHERE symbol LIKE 'PUR%'
  UNION ALL SELECT 'VIE', * FROM feed WHERE symbol LIKE 'VIE%'
  UNION ALL SELECT 'WHALE', * FROM feed WHERE classification = 'Whale')
SELECT tab, count(*) AS row_count, count(*) FILTER (WHERE is_anomaly) AS anomaly_count
FROM tabs GROUP BY tab""",
)
def feed_tabs(spark, sf_dir):
    table, as_of = _table(spark, sf_dir)
    feed = fd.live_trades(table, 50, None, as_of, LONG_SECONDS)
    return fd.feed_tabs(feed, ("PUR", "VIE"))


@query(
    "push_envelope",
    f"""WITH {rolling()}, feed AS (
  SELECT * FROM enriched WHERE is_anomaly AND {after(LONG_SECONDS)}
  ORDER BY time DESC, trade_id DESC LIMIT 10)
SELECT 'anomalies' AS type, CAST(count(*) AS INTEGER) AS row_count,
       arg_max(trade_id, (time, trade_id)) AS newest_id, arg_min(trade_id, (time, trade_id)) AS oldest_id
FROM feed HAVING count(*) > 0""",
)
def push_envelope(spark, sf_dir):
    """One push message, read back: its type, size, first and last row."""
    table, as_of = _table(spark, sf_dir)
    feed = fd.push_anomalies(table, as_of, LONG_SECONDS)
    message = F.from_json("message", "type string, data array<struct<trade_id: long>>")
    return (
        output.push_envelope(feed, "anomalies")
        .select(message.alias("m"))
        .select(
            "m.type",
            F.size("m.data").alias("row_count"),
            F.element_at("m.data.trade_id", 1).alias("newest_id"),
            F.element_at("m.data.trade_id", -1).alias("oldest_id"),
        )
    )
