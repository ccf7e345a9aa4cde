"""Per-symbol rolling enrichment of trades in batch.

The rolling statistics of a trade look only at earlier trades of its symbol, no
further back than the window, and the purge rule looks back no further than the
purge gap. A symbol is therefore cut into time slices that are worked on
separately; each slice also gets a copy of what comes just before it (its
lead-in). Two facts reach further back: the running numbers of the gaps and
whether the pause after the latest gap is already over. They travel in a small
table with one row per symbol and slice (``slice_carry``), which can also be kept
from one run to the next (``operators.carry``).

All running frames start at the first row of a group, which Spark evaluates in one
pass; a frame with a moving lower bound would be re-aggregated for every row. Counts are
differences of two such frames. Sums are not: time is cut into blocks as long as the window, and the
content of a window is the end of one block and the beginning of the next, each
added up from the side where it is cut. Nothing is subtracted, so an amount that
has left the window leaves no trace, whatever its size.

A slice may hold any number of trades, but its length in time is fixed. Trades of one symbol at one
time are therefore summed up first, before any shuffle: the slices work on those sums, of which
a slice has no more than ticks of the clock, and every trade adds what came before it within its
own tick.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import trade as fx
from tickloom.params import MICROS, Params
from tickloom.schemas import ENRICHED_TRADE, TABLE_COLUMNS


def with_usd(trades: DataFrame, params: Params) -> DataFrame:
    usd = fx.usd_value(F.col("price"), F.col("quantity"))
    return trades.select("*", usd.alias("usd_value")).select(
        "*", fx.size_class(F.col("usd_value"), params).alias("classification")
    )


# Trades at one time are told apart by blocks of this many bits of their id, so that
# not even a single moment has to fit into one group.
ID_BLOCK_BITS = 20

# What a symbol takes over from everything before a moment: its last trade, how many gaps of both
# kinds it has had, whether the pause after the latest one is over, and how many trades since
# that gap its window holds after the last trade.
CARRY = "symbol string, last_t bigint, stops bigint, cuts bigint, over boolean, n_after bigint"
_FIRST_SLICE = -(1 << 62)  # before any slice of the trades: where a given carry stands


def _slice_start(params: Params) -> str:
    return f"t - pmod(t, {params.slice_us})"


def _usd_limbs() -> list[Column]:
    return fx.limbs(fx.usd_value(F.col("price"), F.col("quantity")))


def _ticked(trades: DataFrame) -> DataFrame:
    rows = trades.select("*", F.unix_micros("event_time").alias("t"))
    return rows.withColumn("uid", F.shiftright("trade_id", ID_BLOCK_BITS))


def _tick_counts(rows: DataFrame) -> DataFrame:
    """Number of trades per symbol, time and id block; combines before the shuffle."""
    return rows.groupBy("symbol", "t", "uid").agg(F.count(F.lit(1)).alias("cnt"))


def _tick_sums(rows: DataFrame) -> DataFrame:
    """The same with the sums of the amounts."""
    sums = fx.limb_sums(F.col("hi"), F.col("lo"))
    return (
        rows.select("symbol", "t", "uid", *_usd_limbs())
        .groupBy("symbol", "t", "uid")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            *[F.coalesce(c, F.lit(0.0)).alias(x) for x, c in sums.items()],
        )
    )


def _sliced(ticks: DataFrame, params: Params, since: int | None) -> DataFrame:
    """Bring a symbol's time slices together, each with its lead-in.

    Trades before ``since`` are lead-in only.
    """
    width, lead, home = params.slice_us, params.lookback_us, _slice_start(params)
    targets = f"IF(pmod(t, {width}) >= {width - lead}, array({home}, {home} + {width}), array({home}))"
    own = f"slice = {home}" + ("" if since is None else f" AND t >= {since}")
    # A fixed number of tasks: the work on a slice is far more than its size suggests.
    tasks = int(ticks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        ticks.select("*", F.explode(F.expr(targets)).alias("slice"))
        .repartition(tasks, "symbol", "slice")
        .select("*", F.expr(own).alias("own"))
    )


_SLICE = "PARTITION BY symbol, slice ORDER BY t, uid"
_PRIOR = f"OVER ({_SLICE} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
_SO_FAR = f"OVER ({_SLICE} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _expired(params: Params) -> str:
    return (
        "OVER (PARTITION BY symbol, slice ORDER BY t "
        f"RANGE BETWEEN UNBOUNDED PRECEDING AND {params.window_us + 1} PRECEDING)"
    )


def _counted(rows: DataFrame, params: Params) -> DataFrame:
    """Gaps and counts, as far as a slice and its lead-in determine them by themselves.

    A row stands for ``cnt`` trades at one time. The results hold for the first.
    """
    rows = rows.selectExpr(
        "*",
        f"lag(t) OVER ({_SLICE}) AS local_prev_t",
        f"coalesce(sum(cnt) {_PRIOR}, 0L) AS idx",
        f"coalesce(sum(cnt) {_expired(params)}, 0L) AS old_n",
    )
    rows = rows.selectExpr(
        "*",
        f"coalesce(t - local_prev_t > {params.purge_us}, false) AS cut",
        f"coalesce(t - local_prev_t > {params.pause_us}, false) AS stop",
    )
    # What has left the window: expired rows, or all rows before the last purge. A
    # purge gap longer than the window leaves nothing that is not expired already.
    purge_matters = params.purge_us < params.window_us
    rows = rows.selectExpr(
        "*",
        f"max(IF(stop, idx, NULL)) {_SO_FAR} AS stop_idx",
        f"sum(IF(own AND stop, 1L, 0L)) {_SO_FAR} AS own_stops",
        f"sum(IF(own AND cut, 1L, 0L)) {_SO_FAR} AS own_cuts",
        *(
            [
                f"coalesce(max(IF(cut, idx, NULL)) {_SO_FAR}, 0L) AS cut_idx",
                f"sum(IF(cut, 1L, 0L)) {_SO_FAR} AS seg",
            ]
            if purge_matters
            else ["0L AS cut_idx", "0L AS seg"]
        ),
    )
    rows = rows.selectExpr(
        "*",
        "idx - greatest(old_n, cut_idx) AS n",
        "idx - greatest(old_n, coalesce(stop_idx, 0L)) AS n_since_gap",
    )
    # The pause ends within a row if the last of its trades sees enough others.
    rows = rows.selectExpr(
        "*", f"n_since_gap + cnt - 1 >= {params.warmup_min_samples} AS ends_pause"
    )
    return rows.selectExpr(
        "*",
        f"coalesce(max(IF(ends_pause, idx, NULL)) {_PRIOR} >= coalesce(stop_idx, 0L), false)"
        " AS over_earlier",
    )


def _summed(rows: DataFrame, params: Params) -> DataFrame:
    """Sums of the window content before each row.

    A block is as long as the window and ends early at a purge. What a window has of the
    block before its own is what follows the last row that has expired there, or all of it.
    """
    width, sums = params.window_us, fx.SUMS
    rows = rows.selectExpr("*", f"t - pmod(t, {width}) AS block")
    part = "PARTITION BY symbol, slice, block, seg ORDER BY"
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    rows = rows.selectExpr(
        "*", *[f"coalesce(sum({x}) OVER ({part} t DESC, uid DESC {before}), 0D) AS rest_{x}" for x in sums]
    )
    rows = rows.selectExpr(
        "*",
        *[f"coalesce(sum({x}) OVER ({part} t, uid {before}), 0D) AS head_{x}" for x in sums],
    )
    whole = ", ".join(f"'{x}', head_{x} + {x}" for x in sums)
    rest = ", ".join(f"'{x}', rest_{x}" for x in sums)
    place = "'block', block, 'seg', seg"
    # The last row of a block is the one behind which nothing of it follows.
    ends = f"coalesce(lead(block) OVER ({_SLICE}) <> block OR lead(seg) OVER ({_SLICE}) <> seg, true)"
    rows = rows.selectExpr("*", f"IF({ends}, named_struct({place}, {whole}), NULL) AS full")
    rows = rows.selectExpr(
        "*",
        f"last(full, true) {_PRIOR} AS prev",
        f"last(named_struct({place}, {rest})) {_expired(params)} AS gone",
    )
    here = f"{{0}}.block = block - {width} AND {{0}}.seg = seg"
    return rows.selectExpr(
        "*",
        *[
            f"head_{x} + CASE WHEN {here.format('gone')} THEN gone.{x} "
            f"WHEN {here.format('prev')} THEN prev.{x} ELSE 0D END AS s_{x}"
            for x in sums
        ],
    )


def slice_carry(
    rows: DataFrame, carry: DataFrame | None = None
) -> DataFrame:
    """One row per symbol and slice: what it takes over from earlier ones, and what it leaves.

    ``rows`` are counted ticks. ``carry`` has what the symbols take over from all trades before these.
    """
    per_slice = (
        rows.where("own")
        .groupBy("symbol", "slice")
        .agg(
            F.expr("max(t) AS last_t"),
            F.expr("bool_or(local_prev_t IS NULL) AS fresh"),
            F.expr("max(own_stops) AS stops"),
            F.expr("max(own_cuts) AS cuts"),
            F.expr("max_by(over_earlier OR ends_pause, idx) AS over_at_end"),
            F.expr("max_by(n_since_gap + cnt, idx) AS n_after"),
        )
    )
    if carry is not None:
        given = carry.selectExpr(
            "symbol", f"{_FIRST_SLICE} AS slice", "last_t", "false AS fresh", "stops", "cuts",
            "over AS over_at_end", "n_after",
        )
        per_slice = per_slice.unionByName(given)
    # Bounded by the time range over the slice width, whatever the number of trades.
    in_order = "PARTITION BY symbol ORDER BY slice"
    upto = "ROWS BETWEEN UNBOUNDED PRECEDING AND"
    per_slice = per_slice.selectExpr("*", f"lag(last_t) OVER ({in_order}) AS prev_last_t")
    # A slice that starts without any row in its lead-in starts after a purge gap.
    per_slice = per_slice.selectExpr(
        "*", "IF(fresh AND prev_last_t IS NOT NULL, 1L, 0L) AS late_start"
    )
    per_slice = per_slice.selectExpr(
        "*",
        f"sum(stops + late_start) OVER ({in_order} {upto} CURRENT ROW) AS stops_after",
        f"sum(cuts + late_start) OVER ({in_order} {upto} CURRENT ROW) AS cuts_after",
    )
    # Within one pause segment the pause, once over, stays over.
    same_gap = f"PARTITION BY symbol, stops_after ORDER BY slice {upto} CURRENT ROW"
    per_slice = per_slice.selectExpr("*", f"max(over_at_end) OVER ({same_gap}) AS over_after")
    return per_slice.selectExpr(
        "symbol",
        "slice",
        "last_t",
        "late_start",
        "prev_last_t",
        "stops_after",
        "cuts_after",
        "over_after",
        "n_after",
        "stops_after - stops - late_start AS stops_before",
        "cuts_after - cuts - late_start AS cuts_before",
        f"coalesce(lag(over_after) OVER ({in_order}) AND late_start = 0, false) AS over_before",
    )


def slices_of(
    trades: DataFrame,
    params: Params = Params(),
    carry: DataFrame | None = None,
    since: int | None = None,
) -> DataFrame:
    """``slice_carry`` of trades. Only symbol, time and id are read."""
    ticks = _tick_counts(_ticked(trades.select("symbol", "event_time", "trade_id")))
    return slice_carry(_counted(_sliced(ticks, params, since), params), carry)


def carry_after(
    trades: DataFrame,
    params: Params = Params(),
    carry: DataFrame | None = None,
    since: int | None = None,
    slices: DataFrame | None = None,
) -> DataFrame:
    """What every symbol takes over from these trades, as ``CARRY``.

    With ``carry`` and ``since`` (epoch micros), the trades need to begin only a look-back before
    ``since``; ``carry`` has the rest. ``slices`` are those of the same trades where they are known.
    """
    slices = slices_of(trades, params, carry, since) if slices is None else slices
    kept = ("last_t", "stops_after", "cuts_after", "over_after", "n_after")
    return (
        slices.groupBy("symbol")
        .agg(*[F.max_by(c, "slice").alias(c) for c in kept])
        .selectExpr(
            "symbol", "last_t", "stops_after AS stops", "cuts_after AS cuts", "over_after AS over", "n_after"
        )
    )


def _trade_state(
    trades: DataFrame,
    params: Params,
    carry: DataFrame | None,
    since: int | None,
    slices: DataFrame | None = None,
) -> DataFrame:
    """State per trade by way of the sums per tick."""
    rows = _ticked(trades)
    slices = slices_of(trades, params, carry, since) if slices is None else slices
    ticks = _counted(_sliced(_tick_sums(rows), params, since), params)
    state = _summed(ticks, params).where("own").join(
        slices.drop("last_t", "stops_after", "cuts_after", "over_after", "n_after"),
        ["symbol", "slice"],
    )
    first_here = "local_prev_t IS NULL AND prev_last_t IS NOT NULL"
    state = state.selectExpr(
        "symbol",
        "t",
        "uid",
        "t - coalesce(local_prev_t, prev_last_t) AS gap_us",
        f"cut OR ({first_here}) AS is_purge",
        f"stop OR ({first_here}) AS is_pause",
        "cuts_before + late_start + own_cuts AS purge_seg",
        "stops_before + late_start + own_stops AS pause_seg",
        "n",
        "n_since_gap",
        *[f"s_{x}" for x in fx.SUMS],
        "over_earlier OR (stop_idx IS NULL AND over_before) AS over_earlier",
    )
    tick = "PARTITION BY symbol, t, uid ORDER BY trade_id"
    before = f"OVER ({tick} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    own = rows if since is None else rows.where(F.col("t") >= since)
    # The limbs are computed behind the shuffle by tick, which join and window share.
    parts = {"hi": "hi", "lo": "lo", "hihi": "hi * hi", "hilo": "hi * lo", "lolo": "lo * lo"}
    tasks = int(trades.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = own.repartition(tasks, "symbol", "t", "uid").select("*", *_usd_limbs()).selectExpr(
        *trades.columns,
        "t",
        "uid",
        f"CAST(row_number() OVER ({tick}) - 1 AS BIGINT) AS rank",
        *[f"coalesce(sum({part}) {before}, 0D) AS tick_{x}" for x, part in parts.items()],
    )
    # As large as the trades: never to be broadcast, whatever the estimate says.
    return placed.join(state.hint("merge"), ["symbol", "t", "uid"]).selectExpr(
        *trades.columns,
        "t",
        "IF(rank = 0, gap_us, 0L) AS gap_us",
        "rank = 0 AND is_purge AS is_purge",
        "rank = 0 AND is_pause AS is_pause",
        "purge_seg",
        "pause_seg",
        "n + rank AS n",
        "n_since_gap + rank AS n_since_gap",
        *[f"s_{x} + tick_{x} AS s_{x}" for x in fx.SUMS],
        "over_earlier",
    )


def rolling_state(
    trades: DataFrame,
    params: Params = Params(),
    carry: DataFrame | None = None,
    since: int | None = None,
    slices: DataFrame | None = None,
) -> DataFrame:
    """Trades with the rolling state that held just before each of them.

    Adds the enriched columns and ``t`` (epoch micros), ``gap_us``, ``is_purge``,
    ``is_pause``, ``purge_seg``, ``pause_seg``, ``n``, ``n_since_gap``, ``mean``,
    ``stdev``, ``pause_over`` and ``warm``. Nothing runs until an action.

    With ``since`` (epoch micros), only trades from then on come out; the trades need to begin
    a look-back before it, and ``carry`` has what the symbols take over from all earlier ones.
    ``slices`` (``slices_of``) may be given where the caller keeps them for ``carry_after`` as well.
    """
    state = _trade_state(trades, params, carry, since, slices)
    need = params.warmup_min_samples
    state = with_usd(fx.with_moments(state), params).select(
        "*",
        F.expr(f"over_earlier OR n_since_gap >= {need}").alias("pause_over"),
        F.expr(f"n >= {need} AND (over_earlier OR n_since_gap >= {need})").alias("warm"),
    )
    z = F.when(
        F.col("warm") & (F.col("n") >= 2),
        fx.regularized_z(F.col("usd_value"), F.col("mean"), F.col("stdev")),
    )
    state = state.select("*", z.alias("z_score"))
    return state.select("*", fx.anomaly_flag(F.col("z_score"), params).alias("is_anomaly"))


def enrich(
    trades: DataFrame,
    params: Params = Params(),
    carry: DataFrame | None = None,
    since: int | None = None,
) -> DataFrame:
    """Trades with USD value, size class, rolling z-score and anomaly flag."""
    return rolling_state(trades, params, carry, since).select(*ENRICHED_TRADE.fieldNames())


def distinct_trades(
    trades: DataFrame,
    key: tuple[str, ...] = ("trade_id", "event_time"),
    order: Column | None = None,
) -> DataFrame:
    """One trade per key, for input with replays; copies combine before the shuffle.

    ``order`` says which of several copies came first, such as the offset of the source;
    without it, copies that differ are taken by their values.
    """
    rest = [c for c in trades.columns if c not in key]
    row = F.struct(*rest)
    first = (F.min(row) if order is None else F.min_by(row, order)).alias("first")
    return trades.groupBy(*key).agg(first).select(*key, "first.*").select(*trades.columns)


def enrich_once(
    trades: DataFrame, params: Params = Params(), dedup_before_enrich: bool = True
) -> DataFrame:
    """Enrichment of raw input; replayed trades do not count twice in the windows."""
    return enrich(distinct_trades(trades) if dedup_before_enrich else trades, params)


def table_row(enriched: DataFrame) -> DataFrame:
    """Column names and order of the stored table."""
    return enriched.withColumnRenamed("event_time", "time").select(*TABLE_COLUMNS)


def data_gaps(trades: DataFrame, params: Params = Params()) -> DataFrame:
    """The trades that end a data gap, with the gap's length and effect."""
    return (
        rolling_state(trades, params)
        .where("is_pause")
        .select(
            "trade_id",
            "symbol",
            "event_time",
            (F.col("gap_us") / MICROS).alias("gap_seconds"),
            F.when(F.col("is_purge"), F.lit("purge")).otherwise(F.lit("pause")).alias("kind"),
        )
    )


def segments_of(state: DataFrame) -> DataFrame:
    """Stretches between gaps that the rows of ``rolling_state`` make up."""
    kind = (
        F.when(F.col("is_purge"), F.lit("purge"))
        .when(F.col("is_pause"), F.lit("pause"))
        .otherwise(F.lit("first"))
    )
    return state.groupBy("symbol", F.col("pause_seg").alias("segment")).agg(
        F.min("event_time").alias("started_at"),
        F.max("event_time").alias("ended_at"),
        F.count(F.lit(1)).alias("trade_count"),
        F.min_by(kind, F.struct("t", "trade_id")).alias("kind"),
        F.min(F.when(F.col("pause_over"), F.col("event_time"))).alias("resumed_at"),
    )


def gap_segments(trades: DataFrame, params: Params = Params()) -> DataFrame:
    """Stretches between gaps: extent, what started them, when scoring resumed."""
    return segments_of(rolling_state(trades, params))
