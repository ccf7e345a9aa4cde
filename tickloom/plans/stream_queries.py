"""Queries that run the streaming jobs over the given tables to their end.

The driver calls them like any other query, so they stop when all input is read.
Results are written to the shared folder and read back.
"""

import time
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.candles import PartVersions
from tickloom.operators.quality import burst_windows
from tickloom.operators.sink import compact_days
from tickloom.plans import messages as ms
from tickloom.plans import table_queries  # noqa: F401  (its SQL is shared)
from tickloom.plans import tables as tb
from tickloom.plans.enrich_queries import ENRICHED_SQL
from tickloom.plans.ingest_queries import PARSED
from tickloom.plans.registry import ORACLES, query
from tickloom.plans.sql import TRADES, after, rolling
from tickloom.plans.tables import SCALED
from tickloom.params import MICROS
from tickloom.schemas import ENRICHED_TRADE, RAW_TRADE, TABLE_COLUMNS, TOPIC, TRADES_TABLE
from tickloom.session import fresh_path
from tickloom.sources import topic as tp
from tickloom.sources.wire import parse_wire, read_wire_stream
from tickloom.streaming import enrich as se
from tickloom.streaming import jobs
from tickloom.streaming.counters import Counters, ProgressLog, ingest_counters
from tickloom.streaming.segments import OpenSegments, segment_sink

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def trade_stream(spark, sf_dir):
    """The events file read as a stream."""
    rows = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")
    return tb.as_trades(rows)


def _run_to_table(spark, rows, label):
    """Write a stream to Parquet until its input ends; read the result."""
    path = fresh_path(spark, label)
    writer = rows.writeStream.format("parquet").option("path", path)
    jobs.once(writer.option("checkpointLocation", fresh_path(spark, f"{label}-checkpoint")))
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "scan_wire",
    f"WITH {PARSED} SELECT status, count(*) AS message_count FROM parsed GROUP BY status",
)
def scan_wire(spark, sf_dir):
    """Messages written as text, read as a stream, and counted by outcome."""
    path = fresh_path(spark, "wire")
    ms.wire(spark, sf_dir).select("value").write.text(path)
    parsed = parse_wire(read_wire_stream(spark, path)).select("status")
    seen = _run_to_table(spark, parsed, "parsed")
    return seen.groupBy("status").agg(F.count(F.lit(1)).alias("message_count"))


@query("stream_scan_trades", f"WITH {TRADES} SELECT * FROM trades WHERE symbol IN {tb.PAIR}")
def stream_scan_trades(spark, sf_dir):
    """Trades published to a topic folder, consumed from its beginning."""
    path = fresh_path(spark, "topic")
    tp.encode_topic(tb.trades(spark, sf_dir), SCALED).withColumn(
        "offset", F.lit(None).cast("long")
    ).write.parquet(path)
    rows = tp.topic_trades(tp.read_topic_stream(spark, SCALED, path=path))
    return _run_to_table(spark, rows, "consumed")


@query(
    "quarantine",
    f"""WITH {PARSED}
SELECT CASE WHEN status = 'ok' THEN 'good' ELSE 'bad' END AS destination, status, count(*) AS row_count
FROM parsed GROUP BY 1, 2""",
)
def quarantine(spark, sf_dir):
    """Where the messages went: good rows on, refused ones into quarantine."""
    source, good, bad = (fresh_path(spark, n) for n in ("wire", "good", "bad"))
    ms.wire(spark, sf_dir).select("value").write.text(source)
    parsed = parse_wire(read_wire_stream(spark, source))
    jobs.once(jobs.split_sink(parsed, good, bad, fresh_path(spark, "split-checkpoint")))
    kept = spark.read.parquet(good).select(F.lit("good").alias("destination"), F.lit("ok").alias("status"))
    refused = spark.read.parquet(bad).select(F.lit("bad").alias("destination"), "status")
    return kept.unionByName(refused).groupBy("destination", "status").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _enriched(spark, runs, label, params=SCALED, delay="0 seconds"):
    """Run the stream of trades to its end, once for each of ``runs``; the enriched rows."""
    path, late = fresh_path(spark, label), fresh_path(spark, f"{label}-late")
    state, checkpoint = fresh_path(spark, "epochs"), fresh_path(spark, "checkpoint")
    sink = se.to_folders(path, late)
    for rows in runs:
        jobs.once(se.enriched_batches(rows, state, checkpoint, sink, params, delay))
    return spark.read.parquet(path)


@query("stream_enrich", ENRICHED_SQL)
def stream_enrich(spark, sf_dir):
    """Same result as in batch; the events are in order, so no delay is needed."""
    return _enriched(spark, [trade_stream(spark, sf_dir)], "enriched").select(
        *ENRICHED_TRADE.fieldNames()
    ).withColumn("z_score", F.round("z_score", 6))


def _arrivals(spark, sf_dir):
    """A stream of three micro-batches whose trades arrive up to an hour out of order.

    Gives the stream anew as each of them has come in, and at last with the heartbeat; a run takes
    all files that are new, so a micro-batch may have any number of them.
    """
    rows = tb.trades(spark, sf_dir)
    now = tb.latest(rows)
    hour = 3_600 * MICROS
    # When a trade arrives: up to an hour after it happened.
    arrival = F.unix_micros("event_time") + F.pmod(F.xxhash64("trade_id"), F.lit(hour))
    end = F.unix_micros(F.lit(now))
    third = F.lit(10 * 24) * hour
    part = F.least(F.greatest(F.floor((arrival - (end - 3 * third)) / third), F.lit(0)), F.lit(2))
    source = fresh_path(spark, "arrivals")
    placed = rows.withColumn("part", part.cast("int"))
    for n in range(3):
        placed.where(F.col("part") == n).drop("part").write.parquet(f"{source}/part={n}")
        yield _parts(spark, source, rows.schema)
    beat = spark.createDataFrame([(se.HEARTBEAT, 1.0, 1.0, now + timedelta(days=1), -1)], RAW_TRADE)
    beat.coalesce(1).write.parquet(f"{source}/part=3")
    yield _parts(spark, source, rows.schema)


@query("stream_enrich_shuffled", ENRICHED_SQL)
def stream_enrich_shuffled(spark, sf_dir):
    """Same result as in batch, from trades that are out of order."""
    found = _enriched(spark, _arrivals(spark, sf_dir), "shuffled", delay="1 hour")
    return found.select(*ENRICHED_TRADE.fieldNames()).withColumn("z_score", F.round("z_score", 6))


@query("stream_segments", ORACLES["gap_segments"])
def stream_segments(spark, sf_dir):
    """Segments put out as they close, and those that are open at the end."""
    path, left, state, checkpoint = (
        fresh_path(spark, n) for n in ("segments", "open-segments", "epochs", "checkpoint")
    )
    sink = segment_sink(path, left)
    for rows in _arrivals(spark, sf_dir):
        jobs.once(se.enriched_batches(rows, state, checkpoint, sink, SCALED, "1 hour"))
    closed, still = spark.read.parquet(path).drop("batch"), OpenSegments(spark, left).before()
    return closed.unionByName(still)


@query("stream_candles", ORACLES["candles_1m"])
def stream_candles(spark, sf_dir):
    """Candles kept up to date over the stored table read as a stream."""
    folder = tb.stored_path(spark, sf_dir)
    schema = T.StructType(TRADES_TABLE.fields + [T.StructField("day", T.DateType())])
    rows = spark.readStream.schema(schema).parquet(folder).select(*TABLE_COLUMNS)
    path = fresh_path(spark, "candle-parts")
    jobs.once(jobs.candle_sink(rows, path, fresh_path(spark, "candle-checkpoint"), SCALED))
    return (
        PartVersions(spark, path).candles()
        .withColumn("usd_volume", F.round("usd_volume", 2))
        .withColumn("avg_z_score", F.round("avg_z_score", 6))
    )


@query("stream_dedup", f"WITH {TRADES} SELECT trade_id, symbol, event_time FROM trades")
def stream_dedup(spark, sf_dir):
    """Every trade sent twice; each comes out once."""
    twice = trade_stream(spark, sf_dir).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = jobs.distinct_trades(twice.drop("copy"), "10 seconds")
    return _run_to_table(spark, rows.select("trade_id", "symbol", "event_time"), "distinct")


MIDDLE = "2024-01-16 00:00:00"


@query("stream_late_rows", f"WITH {TRADES} SELECT * FROM trades WHERE event_time < TIMESTAMP '{MIDDLE}'")
def stream_late_rows(spark, sf_dir):
    """Trades behind the watermark when the older half arrives after the newer half."""
    rows = tb.trades(spark, sf_dir)
    middle = F.lit(MIDDLE).cast("timestamp")
    source, late = fresh_path(spark, "halves"), fresh_path(spark, "late")
    state, checkpoint = fresh_path(spark, "epochs"), fresh_path(spark, "late-checkpoint")
    sink = se.to_folders(fresh_path(spark, "on-time"), late)
    halves = (F.col("event_time") >= middle, F.col("event_time") < middle)
    for n, half in enumerate(halves, 1):
        rows.where(half).write.parquet(f"{source}/part={n}")
        stream = _parts(spark, source, rows.schema)
        jobs.once(se.enriched_batches(stream, state, checkpoint, sink, SCALED, "0 seconds"))
    return spark.read.parquet(late).select(*rows.columns)


def _parts(spark, source, schema):
    return spark.readStream.schema(schema).parquet(f"{source}/part=*")


@query("stream_bursts", ORACLES["burst_windows"])
def stream_bursts(spark, sf_dir):
    """Burst windows found on the stream."""
    rows = trade_stream(spark, sf_dir).withWatermark("event_time", "1 second")
    path = fresh_path(spark, "bursts")

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = burst_windows(rows, SCALED).writeStream.outputMode("update").foreachBatch(store)
    jobs.once(writer.option("checkpointLocation", fresh_path(spark, "burst-checkpoint")))
    found = spark.read.parquet(path)
    return found.groupBy("window_start", "window_end").agg(
        F.max("trade_count").alias("trade_count"),
        F.round(F.max("rate_per_second"), 9).alias("rate_per_second"),
    )


@query(
    "stream_push",
    f"""WITH {rolling()}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY time DESC, trade_id DESC) AS rn
  FROM enriched WHERE {after(tb.LONG_SECONDS)}), alarms AS (
  SELECT trade_id FROM enriched WHERE is_anomaly AND {after(tb.LONG_SECONDS)}
  ORDER BY time DESC, trade_id DESC LIMIT 10)
SELECT 'trades' AS type, trade_id FROM ranked WHERE rn <= 20
UNION ALL SELECT 'anomalies', trade_id FROM alarms""",
)
def stream_push(spark, sf_dir):
    """Push messages emitted once per micro-batch, read back as counts."""
    table = tb.stored_trades(spark, sf_dir)
    as_of = tb.latest(tb.trades(spark, sf_dir))
    path = fresh_path(spark, "push")
    writer = jobs.push_sink(
        lambda: table,
        trade_stream(spark, sf_dir),
        path,
        fresh_path(spark, "push-checkpoint"),
        lambda: as_of,
        tb.LONG_SECONDS,
        tb.LONG_SECONDS,
    )
    jobs.once(writer)
    message = F.from_json("message", "type string, data array<struct<trade_id: long>>").alias("m")
    return (
        spark.read.schema("message string").json(path)
        .select(message)
        .select("m.type", F.explode("m.data.trade_id").alias("trade_id"))
    )


LATE_ID = -7


@query(
    "stream_pipeline",
    f"""SELECT 'stored' AS destination, trade_id, z_score FROM ({ENRICHED_SQL}) WHERE symbol IN {tb.PAIR}
UNION ALL SELECT 'refused', NULL, NULL UNION ALL SELECT 'late', {LATE_ID}, NULL""",
)
def stream_pipeline(spark, sf_dir):
    """The main job from a topic to the table: decode, set refused messages aside, enrich, store.

    It runs twice, as after a restart. The topic has files by partition and offset; in both runs every
    seventh trade comes again with another price and a later offset, in the second one also trades
    of the first, and one that nobody has seen before and that comes too late.
    """
    return _pipeline(spark, sf_dir)[0]


def _pipeline(spark, sf_dir, fail_once=False):
    topic, table, late, refused, state, counts = (
        fresh_path(spark, n) for n in ("topic", "stored", "late", "refused", "epochs", "counters")
    )
    main, aside = fresh_path(spark, "main-checkpoint"), fresh_path(spark, "refused-checkpoint")
    rows = tb.trades(spark, sf_dir).where(F.col("symbol").isin(*tb.PAIR))
    middle = F.lit(MIDDLE).cast("timestamp")
    halves = (rows.where(F.col("event_time") < middle), rows.where(F.col("event_time") >= middle))

    def again(some):
        return some.withColumn("price", F.col("price") + 1)

    def sent(some, offset):
        keyed = tp.encode_topic(some, SCALED)
        place = F.get_json_object("value", "$.trade_id").cast("long") * 2 + offset
        return keyed.withColumn("offset", place)

    stray = halves[0].limit(1).withColumn("trade_id", F.lit(LATE_ID).cast("long"))
    bad = sent(halves[1].limit(1), 0).withColumn("value", F.lit('{"symbol": 1}'))
    seventh = F.col("trade_id") % 7 == 0
    parts = (
        sent(halves[0], 0).unionByName(sent(again(halves[0].where(seventh)), 1)),
        sent(halves[1], 0)
        .unionByName(sent(again(halves[1].where(seventh)), 1))
        .unionByName(sent(again(halves[0].where(F.col("trade_id") % 5 == 0)), 1))
        .unionByName(sent(stray, 0))
        .unionByName(bad),
    )
    counters, log = Counters(spark, counts), ProgressLog()
    spark.streams.addListener(log)
    try:
        for n, part in enumerate(parts):
            # A file has a range of offsets of the topic's partitions, and its rows in their order.
            ordered = part.repartitionByRange("partition", "offset")
            ordered.sortWithinPartitions("partition", "offset").write.parquet(f"{topic}/part={n}")
            _run_pipeline(
                spark, topic, (table, late, state, main), (refused, aside), counters, fail_once and n == 0
            )
        if fail_once:
            _wait_for(log)
    finally:
        spark.streams.removeListener(log)
    stored = spark.read.parquet(table).select(
        F.lit("stored").alias("destination"), "trade_id", F.round("z_score", 6).alias("z_score")
    )
    nothing = F.lit(None).cast("double").alias("z_score")
    behind = spark.read.parquet(late).select(F.lit("late").alias("destination"), "trade_id", nothing)
    others = spark.read.parquet(refused).select(
        F.lit("refused").alias("destination"), F.lit(None).cast("long").alias("trade_id"), nothing
    )
    return stored.unionByName(behind).unionByName(others), counters, log


def _run_pipeline(spark, topic, main, side, counters, fail_first):
    table, late, state, checkpoint = main
    refused, aside = side
    source = spark.readStream.schema(TOPIC).parquet(f"{topic}/part=*")
    decoded = ingest_counters(tp.decode_topic(source))
    jobs.once(jobs.refused_sink(decoded, refused, aside, SCALED), "refused")
    trades = tp.good_messages(decoded)

    def writer(where):
        return jobs.enriched_sink(
            trades, where, late, state, checkpoint, SCALED, "0 seconds", F.col("offset"), counters
        )

    if fail_first:
        try:
            # A table below a file cannot be written: the batch fails and comes again.
            spark.range(1).select(F.lit("x")).coalesce(1).write.text(f"{table}-blocked")
            files = spark.read.text(f"{table}-blocked").select("_metadata.file_path").first()[0]
            jobs.once(writer(f"{files}/table"), "main")
        except StreamingQueryException:
            pass
    jobs.once(writer(table), "main")


def _wait_for(log, seconds=20):
    """Listeners hear of the end of a stream a moment after it."""
    for _ in range(seconds * 10):
        if sum(name == "failures" for _, _, name, _ in log.found) >= 5:
            return
        time.sleep(0.1)


@query(
    "stream_counters",
    f"""WITH {TRADES}, sent AS (SELECT * FROM trades WHERE symbol IN {tb.PAIR}),
numbers AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE trade_id % 7 = 0) AS again,
         count(*) FILTER (WHERE trade_id % 5 = 0 AND event_time < TIMESTAMP '{MIDDLE}') AS old FROM sent)
SELECT unnest(['batches', 'errors', 'received', 'replays', 'late', 'inserted', 'skipped', 'ingest_received',
               'ingest_published', 'ingest_refused', 'failures']) AS counter,
       unnest([2, 1, n + again + old + 1, again + old, 1, n, 0, n + again + old + 2, n + again + old + 1, 1, 1])::BIGINT
         AS value
FROM numbers""",
)
def stream_counters(spark, sf_dir):
    """Counters of the same job when the first batch fails once: sink, ingest and listener."""
    _, counters, log = _pipeline(spark, sf_dir, fail_once=True)
    totals = counters.totals()
    sink = ("batches", "errors", "received", "replays", "late", "inserted", "skipped")
    stack = ", ".join(f"'{c}', {c}" for c in sink)
    rows = totals.selectExpr(f"stack({len(sink)}, {stack}) AS (counter, value)")
    seen = log.totals(spark)
    ingest = seen.where("query = 'refused' AND counter IN ('received', 'published', 'refused')").select(
        F.concat(F.lit("ingest_"), F.col("counter")).alias("counter"), "value"
    )
    failures = seen.where("counter = 'failures'").groupBy("counter").agg(F.max("value").alias("value"))
    return rows.unionByName(ingest).unionByName(failures)


@query("stream_sink", f"WITH {TRADES} SELECT trade_id, symbol, event_time AS time FROM trades")
def stream_sink(spark, sf_dir):
    """Enriched stream stored through the idempotent sink, then the same run again; compacted."""
    path = fresh_path(spark, "sunk")
    for _ in range(2):
        late, state, checkpoint = (fresh_path(spark, n) for n in ("late", "epochs", "sink-checkpoint"))
        rows = trade_stream(spark, sf_dir)
        jobs.once(jobs.enriched_sink(rows, path, late, state, checkpoint, SCALED, "0 seconds"))
    compact_days(spark, path, SCALED, smallest=2)
    return spark.read.parquet(path).select("trade_id", "symbol", "time")
