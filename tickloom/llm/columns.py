"""Input columns that are carried through an operator, whatever they are called."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of this very name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def picked(docs: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, whatever others differ from them in case only."""
    at = [docs.columns.index(name) for name in names]
    numbered = docs.toDF(*[f"_carried_{i}" for i in range(len(docs.columns))])
    return numbered.select(*[F.col(f"_carried_{i}").alias(n) for i, n in zip(at, names)])


def carried(docs: DataFrame) -> list[Column]:
    """All columns under names that no operator uses."""
    return [named(c).alias(f"_carried_{i}") for i, c in enumerate(docs.columns)]


def restored(docs: DataFrame, without: Iterable[str] = ()) -> list[Column]:
    """The carried columns under their own names, but those that an operator replaces."""
    replaced = {name.lower() for name in without}
    return [
        F.col(f"_carried_{i}").alias(c)
        for i, c in enumerate(docs.columns)
        if c.lower() not in replaced
    ]
