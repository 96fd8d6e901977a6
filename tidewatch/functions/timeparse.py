"""Event-time parsing, truncation and time-range predicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIX_SECONDS = r"^[+-]?\d+(\.\d+)?$"


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 or Unix seconds (whole or fractional) to TIMESTAMP, else NULL."""
    c = (F.col(text) if isinstance(text, str) else text).cast("string")
    seconds = F.when(c.rlike(UNIX_SECONDS), c.try_cast("double"))
    unix = F.timestamp_micros(F.round(seconds * 1_000_000).try_cast("long"))
    iso = F.when(~c.rlike(UNIX_SECONDS), c.try_cast("timestamp"))
    return F.coalesce(iso, unix)


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def truncated(df: DataFrame, unit: str, name: str = "ts") -> Column:
    """``date_trunc`` that keeps the column's own timestamp type."""
    return F.date_trunc(unit, name).cast(type_of(df, name))


def bucketed(df: DataFrame, width: str, name: str = "ts") -> Column:
    """Start of the tumbling bucket the time falls in."""
    return F.window(name, width)["start"]


def time_literal(df: DataFrame, name: str, value: str | dt.datetime) -> Column:
    return F.lit(str(value)).cast(type_of(df, name))


def time_range(
    df: DataFrame,
    start: str | dt.datetime | None = None,
    end: str | dt.datetime | None = None,
    name: str = "ts",
    partition: str = "log_date",
) -> DataFrame:
    """Inclusive time filter. Bounds are typed like the column, so the predicate
    reaches the scan; a date-partitioned table is pruned as well."""
    if start is not None:
        df = df.where(F.col(name) >= time_literal(df, name, start))
    if end is not None:
        df = df.where(F.col(name) <= time_literal(df, name, end))
    if partition in df.columns:
        if start is not None:
            df = df.where(F.col(partition) >= F.lit(str(start)).cast("timestamp").cast("date"))
        if end is not None:
            df = df.where(F.col(partition) <= F.lit(str(end)).cast("timestamp").cast("date"))
    return df
