"""Registered queries, each with its SQL counterpart where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.plans.tables import plain_times
from tickloom.session import utc

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(build(utc(spark), sf_dir))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
