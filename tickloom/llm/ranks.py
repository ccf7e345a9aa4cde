"""Positions of rows within sorted groups, without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.scratch import written


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``rows`` with ``pos``, their position in their group from 0, and ``n``, the group's size.

    The rows are put in order by one range exchange, which also splits a group that holds most of
    them, and written with their place in their range. What came before a range is added up over
    one row per range and group. Equal rows get different positions in any order.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(
        sorted_rows.withColumn("_range", F.spark_partition_id()).withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        label,
    )
    parts = placed.groupBy("_range", *group).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    same = ", ".join(f"`{g}`" for g in group)
    parts = parts.selectExpr(
        "*",
        f"sum(_rows) OVER (PARTITION BY {same}) AS n",
        f"coalesce(sum(_rows) OVER (PARTITION BY {same} ORDER BY _range "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS _before",
    )
    joined = placed.alias("a").join(
        parts.alias("b"),
        [F.col("a._range") == F.col("b._range")]
        + [F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in group],
    )
    return joined.select(
        *[F.col(f"a.{c}") for c in rows.columns],
        (F.col("b._before") + F.col("a._place") - F.col("b._first")).alias("pos"),
        F.col("b.n"),
    )
