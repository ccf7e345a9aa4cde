"""Queries on the enrichment itself."""

from datetime import timedelta

from pyspark.sql import functions as F

from tickloom.operators import enrich as op
from tickloom.functions import trade as fx
from tickloom.operators.carry import CarryStore, advance, tail
from tickloom.operators.validate import check_enriched
from tickloom.operators.quality import enrich_counts
from tickloom.plans import tables as tb
from tickloom.plans.registry import query
from tickloom.plans.sql import TRADES, rolling
from tickloom.plans.tables import SCALED
from tickloom.session import fresh_path


def _state(spark, sf_dir):
    return op.rolling_state(tb.trades(spark, sf_dir), SCALED)


def _z(df):
    return df.withColumn("z_score", F.round("z_score", 6))


ENRICHED_SQL = f"""WITH {rolling()}
SELECT symbol, price, quantity, event_time, trade_id, usd_value, classification,
       round(z_score, 6) AS z_score, is_anomaly FROM enriched"""


@query("enrich_trades", ENRICHED_SQL)
def enrich_trades(spark, sf_dir):
    return _z(op.enrich(tb.trades(spark, sf_dir), SCALED))


RESUME = timedelta(days=12)  # before the latest trade


@query(
    "enrich_resumed",
    f"""{ENRICHED_SQL}
WHERE event_time >= (SELECT as_of FROM present) - INTERVAL '{RESUME.days} days'""",
)
def enrich_resumed(spark, sf_dir):
    """The last days only, from what the symbols take over from all trades before them."""
    rows = tb.trades(spark, sf_dir)
    start = tb.latest(rows) - RESUME
    store = CarryStore(spark, fresh_path(spark, "resumed-carry"))
    advance(store, rows, start, SCALED)
    carry, since = store.latest()
    return _z(op.enrich(tail(rows, since, SCALED), SCALED, carry, since))


@query(
    "stored_carry",
    f"""WITH {rolling()}
SELECT symbol, epoch_us(max(event_time)) AS last_t, max(pause_seg) AS stops, max(purge_seg) AS cuts,
       arg_max(pause_over, (t, trade_id)) AS over, arg_max(n_since_gap, (t, trade_id)) + 1 AS n_after
FROM state WHERE event_time < (SELECT as_of FROM present) - INTERVAL '2 days' GROUP BY symbol""",
)
def stored_carry(spark, sf_dir):
    """What every symbol takes over two days before the end, kept in two steps."""
    return tb.stored_carry(spark, sf_dir).latest()[0]


@query("enrich_replayed", ENRICHED_SQL)
def enrich_replayed(spark, sf_dir):
    """All trades sent twice; replays are dropped before they count in the windows."""
    rows = tb.trades(spark, sf_dir)
    return _z(op.enrich_once(rows.unionByName(rows), SCALED))


@query("usd_value", f"WITH {TRADES} SELECT trade_id, usd_value FROM priced")
def usd_value(spark, sf_dir):
    return tb.trades(spark, sf_dir).select(
        "trade_id", fx.usd_value(F.col("price"), F.col("quantity")).alias("usd_value")
    )


@query("classify", f"WITH {TRADES} SELECT trade_id, usd_value, classification FROM priced")
def classify(spark, sf_dir):
    return op.with_usd(tb.trades(spark, sf_dir), SCALED).select(
        "trade_id", "usd_value", "classification"
    )


@query(
    "check_enriched",
    f"""WITH {rolling()}, seen AS (
  SELECT *, CASE WHEN trade_id % 13 = 0 THEN usd_value + 0.02
                 WHEN trade_id % 11 = 0 THEN usd_value + 0.005 ELSE usd_value END AS stored,
         CASE WHEN trade_id % 17 = 0 THEN 'Shark' ELSE classification END AS class
  FROM enriched)
SELECT trade_id, CASE WHEN abs(stored - round(price * quantity, 4)) > 0.01 THEN 'usd_value_mismatch'
                      WHEN class NOT IN ('Retail', 'Pro', 'Whale') THEN 'unknown_class' END AS fault
FROM seen""",
)
def check(spark, sf_dir):
    """Consistency check of all enriched trades, some of them spoilt on purpose."""
    i = F.col("trade_id")
    usd = F.when(i % 13 == 0, F.col("usd_value") + 0.02).when(
        i % 11 == 0, F.col("usd_value") + 0.005
    )
    rows = op.enrich(tb.trades(spark, sf_dir), SCALED)
    rows = rows.withColumn("usd_value", usd.otherwise(F.col("usd_value"))).withColumn(
        "classification", F.when(i % 17 == 0, F.lit("Shark")).otherwise(F.col("classification"))
    )
    return check_enriched(rows).select("trade_id", "fault")


@query(
    "data_gaps",
    f"""WITH {rolling()}
SELECT trade_id, symbol, event_time, gap_us / 1000000.0 AS gap_seconds,
       CASE WHEN is_purge THEN 'purge' ELSE 'pause' END AS kind
FROM state WHERE is_pause""",
)
def data_gaps(spark, sf_dir):
    return op.data_gaps(tb.trades(spark, sf_dir), SCALED)


@query(
    "gap_segments",
    f"""WITH {rolling()}
SELECT symbol, pause_seg AS segment, min(event_time) AS started_at, max(event_time) AS ended_at,
       count(*) AS trade_count,
       arg_min(CASE WHEN is_purge THEN 'purge' WHEN is_pause THEN 'pause' ELSE 'first' END,
               (t, trade_id)) AS kind,
       min(event_time) FILTER (WHERE pause_over) AS resumed_at
FROM state GROUP BY symbol, pause_seg""",
)
def gap_segments(spark, sf_dir):
    return op.gap_segments(tb.trades(spark, sf_dir), SCALED)


@query(
    "rolling_window_stats",
    f"""WITH {rolling()}
SELECT trade_id, n, n_since_gap, round(mean, 6) AS mean, round(stdev, 6) AS stdev FROM state""",
)
def rolling_window_stats(spark, sf_dir):
    return _state(spark, sf_dir).select(
        "trade_id",
        "n",
        "n_since_gap",
        F.round("mean", 6).alias("mean"),
        F.round("stdev", 6).alias("stdev"),
    )


@query(
    "warmup_state",
    f"WITH {rolling()} SELECT trade_id, purge_seg, pause_seg, pause_over, warm FROM state",
)
def warmup_state(spark, sf_dir):
    return _state(spark, sf_dir).select(
        "trade_id", "purge_seg", "pause_seg", "pause_over", "warm"
    )


@query(
    "rolling_zscore",
    f"WITH {rolling()} SELECT trade_id, symbol, round(z_score, 6) AS z_score FROM enriched",
)
def rolling_zscore(spark, sf_dir):
    return _z(_state(spark, sf_dir)).select("trade_id", "symbol", "z_score")


@query(
    "anomaly_flag",
    f"WITH {rolling()} SELECT trade_id, is_anomaly FROM enriched",
)
def anomaly_flag(spark, sf_dir):
    return _state(spark, sf_dir).select("trade_id", "is_anomaly")


@query(
    "enrich_quality",
    f"""WITH {rolling()}
SELECT count(*) AS enriched, count(z_score) AS scored,
       count(*) FILTER (WHERE is_anomaly) AS anomalies,
       round(count(*) / ((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6), 9)
         AS rate_per_second
FROM enriched""",
)
def enrich_quality(spark, sf_dir):
    return enrich_counts(op.enrich(tb.trades(spark, sf_dir), SCALED)).withColumn(
        "rate_per_second", F.round("rate_per_second", 9)
    )
