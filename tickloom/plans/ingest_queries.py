"""Queries on message parsing, validation and writing."""

from pyspark.sql import functions as F

from tickloom.functions.trade import normalize_symbol as normal
from tickloom.operators import validate as va
from tickloom.operators.quality import burst_windows as bursts
from tickloom.operators.quality import ingest_counts
from tickloom.operators.sink import append_new
from tickloom.plans import messages as ms
from tickloom.plans import tables as tb
from tickloom.plans.registry import query
from tickloom.plans.sql import TRADES, rolling
from tickloom.plans.tables import PAIR, SCALED
from tickloom.session import fresh_path
from tickloom.sources import topic as tp
from tickloom.sources.table import read_trades
from tickloom.sources.wire import parse_wire as parse

PARSED = f"""{TRADES}, faults AS (
  SELECT *, CASE WHEN trade_id % 97 = 0 THEN 'cut' WHEN trade_id % 89 = 0 THEN 'other_event'
    WHEN trade_id % 83 = 0 THEN 'no_stream' WHEN trade_id % 79 = 0 THEN 'negative_price'
    WHEN trade_id % 73 = 0 THEN 'text_quantity' WHEN trade_id % 71 = 0 THEN 'loose_symbol'
    WHEN trade_id % 67 = 0 THEN 'bare_price' ELSE 'none' END AS fault
  FROM trades
), parsed AS (
  SELECT *, CASE WHEN fault IN ('other_event', 'no_stream') THEN 'ignored'
    WHEN fault IN ('none', 'loose_symbol') THEN 'ok' ELSE 'parse_error' END AS status FROM faults)"""


@query(
    "parse_wire",
    f"""WITH {PARSED}
SELECT trade_id AS event_id, status,
       CASE WHEN status = 'ok' THEN symbol END AS symbol,
       CASE WHEN status = 'ok' THEN price END AS price,
       CASE WHEN status = 'ok' THEN quantity END AS quantity,
       CASE WHEN status = 'ok' THEN make_timestamp(epoch_us(event_time) // 1000 * 1000) END AS event_time,
       CASE WHEN status = 'ok' THEN trade_id END AS trade_id
FROM parsed""",
)
def parse_wire(spark, sf_dir):
    return parse(ms.wire(spark, sf_dir)).drop("raw")


@query(
    "ingest_quality",
    f"""WITH {PARSED}
SELECT count(*) AS received, count(*) FILTER (WHERE status = 'ok' AND symbol IN {PAIR}) AS published,
       count(*) FILTER (WHERE status = 'ok' AND symbol NOT IN {PAIR}) AS unknown_symbol,
       count(*) FILTER (WHERE status = 'ignored') AS ignored,
       count(*) FILTER (WHERE status = 'parse_error') AS parse_errors
FROM parsed""",
)
def ingest_quality(spark, sf_dir):
    return ingest_counts(parse(ms.wire(spark, sf_dir)), SCALED)


@query(
    "normalize_symbol",
    """SELECT event_id, upper(event_type) AS symbol FROM events""",
)
def normalize_symbol(spark, sf_dir):
    """Symbols of all events, wrapped in white space of several kinds."""
    pads = F.element_at(F.array(*[F.lit(p) for p in ("", " ", "\t", "\n  ")]), F.col("k"))
    rows = tb.events(spark, sf_dir).withColumn("k", (F.col("event_id") % 4 + 1).cast("int"))
    return rows.select(
        "event_id", normal(F.concat(pads, F.col("event_type"), pads)).alias("symbol")
    )


@query(
    "validate_trades",
    """SELECT event_id AS trade_id, upper(event_type) AS symbol,
  CASE WHEN event_id % 19 = 0 THEN 'missing_field' WHEN NOT value > 0 OR event_id % 23 = 0
       THEN 'price_not_positive' WHEN event_id % 29 = 0 THEN 'quantity_not_positive' END AS fault
FROM events""",
)
def validate_trades(spark, sf_dir):
    """All events as raw trades, including those without a price, some more spoilt."""
    i = F.col("event_id")
    rows = tb.events(spark, sf_dir).select(
        F.lower("event_type").alias("symbol"),
        F.when(i % 23 == 0, F.lit(-1.0)).otherwise(F.col("value")).alias("price"),
        F.when(i % 29 == 0, F.lit(float("nan"))).otherwise(F.lit(1.0)).alias("quantity"),
        F.when(i % 19 != 0, F.col("ts").cast("timestamp")).alias("event_time"),
        i.alias("trade_id"),
    )
    return va.validate_trades(rows).select("trade_id", "symbol", "fault")


@query(
    "known_symbols",
    f"""WITH {TRADES}
SELECT trade_id, symbol, CASE symbol WHEN '{PAIR[0]}' THEN 0 ELSE 1 END AS partition
FROM trades WHERE symbol IN {PAIR}""",
)
def known_symbols(spark, sf_dir):
    return va.known_symbols(tb.trades(spark, sf_dir), SCALED).select(
        "trade_id", "symbol", "partition"
    )


@query(
    "unknown_symbols",
    f"""WITH {TRADES}
SELECT symbol, count(*) AS trade_count FROM trades WHERE symbol NOT IN {PAIR} GROUP BY symbol""",
)
def unknown_symbols(spark, sf_dir):
    return va.unknown_symbols(tb.trades(spark, sf_dir), SCALED)


@query(
    "publish_trades",
    f"""WITH {TRADES}
SELECT symbol AS key, CASE symbol WHEN '{PAIR[0]}' THEN 0 ELSE 1 END AS partition, symbol, price, quantity,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S') ||
         CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END
         || '+00:00' AS event_time, trade_id
FROM trades WHERE symbol IN {PAIR}""",
)
def publish_trades(spark, sf_dir):
    """Topic messages of the known symbols, their values read back."""
    body = F.from_json(
        "value", "symbol string, price double, quantity double, event_time string, trade_id long"
    )
    rows = tp.encode_topic(tb.trades(spark, sf_dir), SCALED)
    return rows.select("key", "partition", body.alias("b")).select("key", "partition", "b.*")


DECODED = f"""{TRADES}, decoded AS (
  SELECT *, CASE WHEN trade_id % 59 = 0 OR trade_id % 53 = 0 OR trade_id % 47 = 0
                 THEN 'failed' ELSE 'ok' END AS status FROM trades)"""


@query(
    "decode_topic",
    f"""WITH {DECODED}
SELECT trade_id AS event_id, status, CASE WHEN status = 'ok' THEN symbol END AS symbol,
       CASE WHEN status = 'ok' THEN price END AS price,
       CASE WHEN status = 'ok' THEN quantity END AS quantity,
       CASE WHEN status = 'ok' THEN event_time END AS event_time,
       CASE WHEN status = 'ok' THEN trade_id END AS trade_id
FROM decoded""",
)
def decode_topic(spark, sf_dir):
    return tp.decode_topic(ms.topic(spark, sf_dir)).drop("raw")


@query(
    "burst_windows",
    f"""WITH {TRADES}, counted AS (
  SELECT time_bucket(INTERVAL '{SCALED.burst_window_seconds} seconds', event_time) AS window_start,
         count(*) AS trade_count FROM trades GROUP BY 1)
SELECT window_start, window_start + INTERVAL '{SCALED.burst_window_seconds} seconds' AS window_end,
       trade_count, round(trade_count / {SCALED.burst_window_seconds}.0, 9) AS rate_per_second
FROM counted WHERE trade_count / {SCALED.burst_window_seconds}.0 > {SCALED.ingestion_rate_threshold!r}""",
)
def burst_windows(spark, sf_dir):
    return bursts(tb.trades(spark, sf_dir), SCALED).withColumn(
        "rate_per_second", F.round("rate_per_second", 9)
    )


MIDDLE = "2024-01-16 00:00:00"


def _replay(spark, sf_dir):
    """First half of the table, then all of it again at a doubled quantity."""
    rows = tb.stored_trades(spark, sf_dir).drop("day")
    early = rows.where(F.col("time") < F.lit(MIDDLE).cast("timestamp"))
    return early, rows.withColumn("quantity", F.col("quantity") * 2)


@query(
    "sink_upsert",
    f"""WITH {rolling()}
SELECT trade_id, time, symbol, price,
       CASE WHEN time < TIMESTAMP '{MIDDLE}' THEN quantity ELSE quantity * 2 END AS quantity,
       usd_value, classification, round(z_score, 6) AS z_score, is_anomaly FROM enriched""",
)
def sink_upsert(spark, sf_dir):
    """The table after both writes: the first row of each key stays."""
    path = fresh_path(spark, "sink")
    for batch in _replay(spark, sf_dir):
        append_new(spark, batch, path)
    return read_trades(spark, path).drop("day").withColumn("z_score", F.round("z_score", 6))


@query(
    "sink_counts",
    f"""WITH {rolling()}, early AS (SELECT count(*) AS n FROM enriched WHERE time < TIMESTAMP '{MIDDLE}'),
whole AS (SELECT count(*) AS n FROM enriched)
SELECT 1 AS write_no, early.n AS attempted, early.n AS inserted, CAST(0 AS BIGINT) AS skipped FROM early
UNION ALL SELECT 2, whole.n, whole.n - early.n, early.n FROM early, whole""",
)
def sink_counts(spark, sf_dir):
    path = fresh_path(spark, "sink")
    rows = []
    for number, batch in enumerate(_replay(spark, sf_dir), 1):
        counts = append_new(spark, batch, path)
        rows.append((number, counts.attempted, counts.inserted, counts.skipped))
    return spark.createDataFrame(
        rows, "write_no int, attempted long, inserted long, skipped long"
    )
