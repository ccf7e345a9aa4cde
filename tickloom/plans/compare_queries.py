"""Queries that compare two symbols, and the display labels."""

from pyspark.sql import functions as F

from tickloom.functions import labels as lb
from tickloom.operators import compare as cp
from tickloom.operators.stats import windows
from tickloom.plans import tables as tb
from tickloom.plans.registry import query
from tickloom.plans.sql import rolling
from tickloom.plans.table_queries import SUMMARY, WINDOW
from tickloom.plans.tables import PAIR, SCALED

A, B = PAIR

# Both windows side by side by age rank, and the figures over the pairs.
FIGURES = f"""placed AS (
  SELECT symbol, q, row_number() OVER (PARTITION BY symbol ORDER BY t DESC, trade_id DESC) AS pos
  FROM members WHERE symbol IN ('{A}', '{B}')
), pairs AS (
  SELECT a.pos, CAST(a.q AS DOUBLE) / 10000 AS x, CAST(b.q AS DOUBLE) / 10000 AS y
  FROM placed a JOIN placed b ON a.pos = b.pos AND a.symbol = '{A}' AND b.symbol = '{B}'
), middle AS (SELECT avg(x) AS mx, avg(y) AS my, count(*) AS n FROM pairs
), raw AS (
  SELECT max(n) AS n, sum((x - mx) * (y - my)) /
           nullif(sqrt(sum((x - mx) * (x - mx))) * sqrt(sum((y - my) * (y - my))), 0) AS r,
         (avg(x) FILTER (WHERE pos <= 5) - avg(x) FILTER (WHERE pos > 5)) /
           nullif(stddev_pop(x) FILTER (WHERE pos > 5), 0) AS zx,
         (avg(y) FILTER (WHERE pos <= 5) - avg(y) FILTER (WHERE pos > 5)) /
           nullif(stddev_pop(y) FILTER (WHERE pos > 5), 0) AS zy
  FROM pairs, middle
), figures AS (
  SELECT n AS pair_count, CASE WHEN n >= 5 THEN round(r, 4) END AS rolling_correlation,
         CASE WHEN n >= 10 THEN round(zx, 3) END AS btc_recent_z,
         CASE WHEN n >= 10 THEN round(zy, 3) END AS eth_recent_z,
         CASE WHEN n >= 10 THEN round(abs(zy - zx), 3) END AS relative_divergence,
         CASE WHEN n >= 10 THEN abs(zy - zx) > 2.0 END AS divergence_alert
  FROM raw)"""


def side(source: str, symbol: str, prefix: str) -> str:
    """One symbol's summary columns from one-row subqueries."""
    columns = "window_size volume_usd avg_trade_usd stdev_usd volatility_cv min_usd max_usd warmed_up"
    parts = [f"'{symbol}' AS {prefix}_symbol", f"CAST(NULL AS VARCHAR) AS {prefix}_status"]
    parts += [
        f"(SELECT {c} FROM {source} WHERE symbol = '{symbol}') AS {prefix}_{c}"
        for c in columns.split()
    ]
    return ", ".join(parts)


def shares(source: str) -> str:
    total = f"(SELECT sum(volume_usd) FROM {source} WHERE symbol IN {PAIR})"
    return ", ".join(
        f"round((SELECT volume_usd FROM {source} WHERE symbol = '{s}') / {total}, 4) AS {p}_volume_share"
        for s, p in zip(PAIR, ("btc", "eth"))
    )


FULL = f"""shaped AS (
  SELECT symbol, window_size, round(CAST(sx AS DOUBLE) / 10000, 2) AS volume_usd,
         round(mu, 2) AS avg_trade_usd, round(sd, 2) AS stdev_usd,
         CASE WHEN mu > 0 THEN round(sd / mu, 4) END AS volatility_cv,
         round(lo, 2) AS min_usd, round(hi, 2) AS max_usd, warmed_up FROM windows)"""

FALLBACK = f"""shaped AS (
  SELECT symbol, window_size, round(volume_usd, 2) AS volume_usd,
         round(avg_trade_usd, 2) AS avg_trade_usd, round(stdev_usd, 2) AS stdev_usd,
         CASE WHEN avg_trade_usd > 0 THEN round(stdev_usd / avg_trade_usd, 4) END AS volatility_cv,
         round(min_usd, 2) AS min_usd, round(max_usd, 2) AS max_usd,
         window_size >= {SCALED.warmup_min_samples} AS warmed_up FROM summary)"""


def _figures(spark, sf_dir):
    found = windows(tb.trades(spark, sf_dir), SCALED, tb.stored_carry(spark, sf_dir))
    return cp.pair_figures(cp.aligned_pairs(found.members, PAIR, SCALED))


@query(
    "pair_correlation",
    f"WITH {rolling()}, {WINDOW}, {FIGURES} SELECT pair_count, rolling_correlation FROM figures",
)
def pair_correlation(spark, sf_dir):
    return _figures(spark, sf_dir).select("pair_count", "rolling_correlation")


@query(
    "recent_vs_window_z",
    f"WITH {rolling()}, {WINDOW}, {FIGURES} SELECT btc_recent_z, eth_recent_z FROM figures",
)
def recent_vs_window_z(spark, sf_dir):
    return _figures(spark, sf_dir).select("btc_recent_z", "eth_recent_z")


@query(
    "relative_divergence",
    f"""WITH {rolling()}, {WINDOW}, {FIGURES}
SELECT relative_divergence, divergence_alert FROM figures""",
)
def relative_divergence(spark, sf_dir):
    return _figures(spark, sf_dir).select("relative_divergence", "divergence_alert")


def _full(spark, sf_dir):
    store = tb.stored_carry(spark, sf_dir)
    return cp.cross_asset_comparison(tb.trades(spark, sf_dir), SCALED, PAIR, store)


@query(
    "cross_asset_comparison",
    f"""WITH {rolling()}, {WINDOW}, {FIGURES}, {FULL}
SELECT 'ok' AS status, {SCALED.window_seconds} AS window_seconds, {side('shaped', A, 'btc')},
       {side('shaped', B, 'eth')}, rolling_correlation, btc_recent_z, eth_recent_z,
       relative_divergence, divergence_alert, {shares('shaped')}
FROM figures""",
)
def cross_asset_comparison(spark, sf_dir):
    return cp.flat(_full(spark, sf_dir))


@query(
    "comparison_fallback",
    f"""WITH {rolling()}, {SUMMARY}, {FALLBACK}
SELECT 'ok' AS status, {SCALED.window_seconds} AS window_seconds, 'db_fallback' AS source,
       {side('shaped', A, 'btc')}, {side('shaped', B, 'eth')},
       CAST(NULL AS DOUBLE) AS rolling_correlation, CAST(NULL AS DOUBLE) AS btc_recent_z,
       CAST(NULL AS DOUBLE) AS eth_recent_z, false AS divergence_alert, {shares('shaped')}""",
)
def comparison_fallback(spark, sf_dir):
    as_of = tb.latest(tb.trades(spark, sf_dir))
    table = tb.stored_trades(spark, sf_dir)
    return cp.flat(cp.comparison_fallback(spark, table, as_of, SCALED, PAIR))


def _ratio(prefix: str, symbol: str) -> str:
    parts = []
    for column, name, floor in (
        ("volume_usd", "volume", 1),
        ("avg_trade_usd", "avg", 1),
        ("volatility_cv", "cv", 0.001),
    ):
        own = f"(SELECT {column} FROM shaped WHERE symbol = '{symbol}')"
        top = f"(SELECT max({column}) FROM shaped WHERE symbol IN {PAIR})"
        parts.append(f"round({own} / greatest({top}, {floor}) * 100, 6) AS {prefix}_{name}_pct")
    return ", ".join(parts)


@query(
    "comparison_ratios",
    f"""WITH {rolling()}, {WINDOW}, {FIGURES}, {FULL}
SELECT {_ratio('btc', A)}, {_ratio('eth', B)},
       round(coalesce((rolling_correlation + 1) / 2 * 100, 50.0), 6) AS correlation_pct FROM figures""",
)
def comparison_ratios(spark, sf_dir):
    rows = cp.comparison_ratios(_full(spark, sf_dir))
    return rows.select(*[F.round(c, 6).alias(c) for c in rows.columns])


# --- labels ----------------------------------------------------------------------


def fixed(value: str, digits: int) -> str:
    return f"CAST(CAST(round(CAST({value} AS DECIMAL(34,12)), {digits}) AS DECIMAL(34,{digits})) AS VARCHAR)"


def grouped(value: str, digits: int) -> str:
    spec = "{:,." + str(digits) + "f}"
    return f"format('{spec}', CAST(round(CAST({value} AS DECIMAL(34,12)), {digits}) AS DOUBLE))"


def _enriched(spark, sf_dir):
    return tb.stored_trades(spark, sf_dir)


@query(
    "fmt_usd",
    f"""WITH {rolling()}, amounts AS (
  SELECT trade_id, usd_value AS v FROM enriched UNION ALL
  SELECT trade_id, usd_value * 1000 FROM enriched UNION ALL
  SELECT trade_id, usd_value * 1000000 FROM enriched)
SELECT trade_id, round(v, 2) AS amount, '$' || CASE WHEN v >= 1e9 THEN {fixed('v / 1e9', 2)} || 'B'
  WHEN v >= 1e6 THEN {fixed('v / 1e6', 2)} || 'M' WHEN v >= 1e3 THEN {fixed('v / 1e3', 1)} || 'K'
  ELSE {fixed('v', 0)} END AS label
FROM amounts""",
)
def fmt_usd(spark, sf_dir):
    """Every trade's amount, in units and as thousands and millions of it."""
    scales = F.explode(F.array(*[F.lit(float(k)) for k in (1, 1000, 1_000_000)]))
    rows = _enriched(spark, sf_dir).select("trade_id", "usd_value", scales.alias("k"))
    rows = rows.select("trade_id", (F.col("usd_value") * F.col("k")).alias("v"))
    return rows.select(
        "trade_id", F.round("v", 2).alias("amount"), lb.fmt_usd(F.col("v")).alias("label")
    )


@query(
    "fmt_labels",
    f"""WITH {rolling()}
SELECT trade_id, '$' || {grouped('price', 2)} AS price_text,
       coalesce(CASE WHEN z_score >= 0 THEN '+' ELSE '-' END || {fixed('abs(z_score)', 2)}, '—') AS z_text,
       coalesce({fixed('z_score * 100', 1)} || '%', '—') AS percent_text,
       {grouped('trade_id', 0)} AS count_text, coalesce({fixed('z_score', 3)}, '—') AS cv_text
FROM enriched""",
)
def fmt_labels(spark, sf_dir):
    z = F.col("z_score")
    return _enriched(spark, sf_dir).select(
        "trade_id",
        lb.fmt_price(F.col("price")).alias("price_text"),
        lb.fmt_z(z).alias("z_text"),
        lb.fmt_percent(z).alias("percent_text"),
        lb.fmt_count(F.col("trade_id")).alias("count_text"),
        lb.fmt_cv(z).alias("cv_text"),
    )


@query(
    "fmt_time",
    f"""WITH {rolling()}
SELECT trade_id, strftime(time, '%H:%M:%S') AS time_text,
       strftime(time, '%H:%M:%S.') || substr(strftime(time, '%f'), 1, 2) AS centis_text FROM enriched""",
)
def fmt_time(spark, sf_dir):
    return _enriched(spark, sf_dir).select(
        "trade_id",
        lb.fmt_time(F.col("time")).alias("time_text"),
        lb.fmt_time_centis(F.col("time")).alias("centis_text"),
    )


@query(
    "asset_labels",
    f"""WITH {rolling()}, named AS (
  SELECT *, symbol || 'USDT' || CASE WHEN is_anomaly THEN 'USDT' ELSE '' END AS pair_symbol FROM enriched)
SELECT trade_id, pair_symbol, regexp_replace(pair_symbol, 'USDT', '') AS asset,
       CASE WHEN symbol LIKE 'PUR%' THEN 'pur' ELSE 'vie' END AS family,
       CASE classification WHEN 'Whale' THEN 'W' WHEN 'Pro' THEN 'PRO' ELSE 'RET' END AS class_code
FROM named""",
)
def asset_labels(spark, sf_dir):
    """Labels of every trade, its symbol quoted once or (anomalies) twice."""
    again = F.when(F.col("is_anomaly"), F.lit("USDT")).otherwise(F.lit(""))
    pair = F.concat("symbol", F.lit("USDT"), again)
    return _enriched(spark, sf_dir).select(
        "trade_id",
        pair.alias("pair_symbol"),
        lb.base_asset(pair).alias("asset"),
        lb.asset_family(F.col("symbol"), "PUR", "VIE").alias("family"),
        lb.class_code(F.col("classification")).alias("class_code"),
    )


@query(
    "z_severity",
    f"""WITH {rolling()}
SELECT trade_id, round(least(abs(z_score) / 5 * 100, 100.0), 6) AS bar_percent,
       CASE WHEN abs(z_score) > 3 THEN 'red' WHEN z_score IS NOT NULL THEN 'neutral' END AS bar_color
FROM enriched""",
)
def z_severity(spark, sf_dir):
    z = F.col("z_score")
    return _enriched(spark, sf_dir).select(
        "trade_id",
        F.round(lb.z_bar_percent(z), 6).alias("bar_percent"),
        lb.z_bar_color(z).alias("bar_color"),
    )


@query(
    "severity_buckets",
    f"""WITH {rolling()}
SELECT trade_id,
  CASE WHEN abs(coalesce(z_score, 0)) > 2 THEN 'red' WHEN abs(coalesce(z_score, 0)) > 1 THEN 'amber'
       ELSE 'neutral' END AS recent_color,
  CASE WHEN z_score IS NULL THEN 'dim' WHEN z_score > 0.7 THEN 'green' WHEN z_score < -0.3 THEN 'red'
       ELSE 'amber' END AS correlation_color
FROM enriched""",
)
def severity_buckets(spark, sf_dir):
    z = F.col("z_score")
    return _enriched(spark, sf_dir).select(
        "trade_id",
        lb.recent_z_color(z).alias("recent_color"),
        lb.correlation_color(z).alias("correlation_color"),
    )


@query(
    "describe_trade",
    f"""WITH {rolling()}
SELECT trade_id, '[' || symbol || '] $' || {grouped('usd_value', 2)} || ' (' || classification || ') z='
  || coalesce(CASE WHEN z_score < 0 THEN '-' ELSE '' END || {fixed('abs(z_score)', 2)}, 'warming')
  || CASE WHEN is_anomaly THEN ' 🚨ANOMALY' ELSE '' END AS label
FROM enriched""",
)
def describe_trade(spark, sf_dir):
    names = ("symbol", "usd_value", "classification", "z_score", "is_anomaly")
    return _enriched(spark, sf_dir).select(
        "trade_id", lb.describe_trade(*[F.col(n) for n in names]).alias("label")
    )
