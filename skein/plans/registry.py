"""Where queries are registered. It imports no module of queries, so each of those can be imported first, as Python workers do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) that returns a Frame or DataFrame."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = f(spark, sf_dir)
            return out if isinstance(out, DataFrame) else out.df

        run.__name__ = f.__name__
        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
