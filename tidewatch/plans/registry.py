"""Registry of runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.plans.views_sql import with_views
from tidewatch.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, extra: dict[str, str] | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is its twin, if SQL can say it."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain_times(fn(prepare(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, extra)
        return fn

    return add


def plain_times(df: DataFrame) -> DataFrame:
    """Zone-free times, as the SQL twins produce them."""
    zoned = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df


def at_micros(us: Column | str) -> Column:
    us = F.col(us) if isinstance(us, str) else us
    return F.timestamp_micros(us).cast("timestamp_ntz")


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib

    for module in MODULES:
        importlib.import_module(f"tidewatch.plans.{module}")


MODULES = ["report_queries", "log_queries", "metric_queries", "series_queries", "alert_queries", "agent_queries", "model_queries", "stream_queries"]
