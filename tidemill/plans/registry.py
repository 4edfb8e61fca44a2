"""Registry of the queries and their SQL equivalents."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import prepare
from tidemill.sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register `fn(spark, tables)` under a name, with SQL that gives the same rows."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), Tables(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return register
