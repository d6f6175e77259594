"""The query catalogue: a Spark function and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from starloom.session import apply_runtime_conf

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_runtime_conf(spark), sf_dir)

        QUERIES[name] = wraps(fn)(run)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
