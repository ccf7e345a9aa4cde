"""Common parts of the SQL counterparts, in DuckDB's dialect.

They use plain windows over whole symbols: no time slices, no state carried over.
"""

from tickloom.params import Params
from tickloom.plans.tables import SCALED

TRADES = """
trades AS (
  SELECT event_id AS trade_id, ts AS event_time, upper(event_type) AS symbol,
         value AS price, CAST(10 * (1 + event_id % 100) AS DOUBLE) AS quantity
  FROM events WHERE value > 0
), priced AS (
  SELECT *, round(price * quantity, 4) AS usd_value,
         CASE WHEN round(price * quantity, 4) < 500 THEN 'Retail'
              WHEN round(price * quantity, 4) <= 50000 THEN 'Pro' ELSE 'Whale' END
           AS classification
  FROM trades
)"""


def rolling(p: Params = SCALED) -> str:
    """CTEs up to ``state``: every trade with the rolling state just before it."""
    older = f"RANGE BETWEEN UNBOUNDED PRECEDING AND {p.window_us + 1} PRECEDING"
    prior = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    return f"""{TRADES}, stepped AS (
  SELECT *, epoch_us(event_time) AS t, CAST(round(usd_value * 10000) AS HUGEINT) AS q,
         epoch_us(event_time) - lag(epoch_us(event_time)) OVER
           (PARTITION BY symbol ORDER BY event_time, trade_id) AS gap_us
  FROM priced
), segmented AS (
  SELECT *, coalesce(gap_us > {p.purge_us}, false) AS is_purge,
         coalesce(gap_us > {p.pause_us}, false) AS is_pause,
         CAST(sum(CASE WHEN gap_us > {p.purge_us} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS purge_seg,
         CAST(sum(CASE WHEN gap_us > {p.pause_us} THEN 1 ELSE 0 END) OVER w AS BIGINT) AS pause_seg
  FROM stepped WINDOW w AS (PARTITION BY symbol ORDER BY t, trade_id)
), framed AS (
  SELECT *,
         count(*) OVER a - count(*) OVER b AS n,
         coalesce(sum(q) OVER a, 0) - coalesce(sum(q) OVER b, 0) AS sx,
         coalesce(sum(q * q) OVER a, 0) - coalesce(sum(q * q) OVER b, 0) AS sxx,
         count(*) OVER c - count(*) OVER d AS n_since_gap
  FROM segmented
  WINDOW a AS (PARTITION BY symbol, purge_seg ORDER BY t, trade_id {prior}),
         b AS (PARTITION BY symbol, purge_seg ORDER BY t {older}),
         c AS (PARTITION BY symbol, pause_seg ORDER BY t, trade_id {prior}),
         d AS (PARTITION BY symbol, pause_seg ORDER BY t {older})
), warmed AS (
  SELECT *,
         max(CASE WHEN n_since_gap >= {p.warmup_min_samples} THEN 1 ELSE 0 END) OVER
           (PARTITION BY symbol, pause_seg ORDER BY t, trade_id) = 1 AS pause_over,
         CAST(sx AS DOUBLE) / nullif(n, 0) / 10000 AS mean,
         sqrt(CAST(n * sxx - sx * sx AS DOUBLE)) / nullif(n, 0) / 10000 AS stdev
  FROM framed
), scored AS (
  SELECT *, n >= {p.warmup_min_samples} AND (pause_seg = 0 OR pause_over) AS warm FROM warmed
), state AS (
  SELECT *, CASE WHEN warm AND n >= 2
              THEN (usd_value - mean) / greatest(stdev, abs(mean) * 0.001, 1.0) END AS z
  FROM scored
), enriched AS (
  SELECT trade_id, event_time, event_time AS time, symbol, price, quantity, usd_value,
         classification, z AS z_score,
         coalesce(abs(z) > {p.z_score_threshold}, false) AS is_anomaly
  FROM state
), present AS (SELECT max(event_time) AS as_of FROM trades)"""


def after(seconds: float, column: str = "time") -> str:
    return f"{column} > (SELECT as_of FROM present) - INTERVAL '{seconds} seconds'"


def bucket(column: str = "time", p: Params = SCALED) -> str:
    width = p.candle_seconds * 1_000_000
    return f"make_timestamp(epoch_us({column}) - epoch_us({column}) % {width})"


def candle_columns(p: Params = SCALED) -> str:
    return """
  arg_min(price, (time, trade_id)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, (time, trade_id)) AS close, sum(quantity) AS volume,
  round(sum(usd_value), 2) AS usd_volume, count(*) AS trade_count,
  count(*) FILTER (WHERE is_anomaly) AS anomaly_count, round(avg(z_score), 6) AS avg_z_score"""
