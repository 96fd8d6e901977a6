"""Log search and health bands."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.timeparse import time_literal, time_range


def search_logs(
    logs: DataFrame,
    *,
    service: str | None = None,
    level: str | list[str] | None = None,
    event: str | None = None,
    status: str | None = None,
    request_id: str | None = None,
    error_type: str | None = None,
    min_latency_ms: float | None = None,
    start=None,
    end=None,
    now: str | dt.datetime | None = None,
    within: str | None = None,
) -> DataFrame:
    """Rows that match all given predicates.

    ``within`` is an interval such as ``"1 hour"`` before ``now``; ``now``
    defaults to the wall clock. Every predicate is a plain column comparison and
    can be pushed to the scan.
    """
    equal = {"service": service, "event": event, "status": status, "request_id": request_id, "error_type": error_type}
    for name, wanted in equal.items():
        if wanted is not None:
            logs = logs.where(F.col(name) == wanted)
    if level is not None:
        logs = logs.where(F.col("level").isin([level] if isinstance(level, str) else level))
    if min_latency_ms is not None:
        logs = logs.where(F.col("latency_ms") > min_latency_ms)
    if within is not None:
        until = F.current_timestamp() if now is None else time_literal(logs, "ts", now)
        logs = logs.where(F.col("ts") > until - F.expr(f"INTERVAL {within}"))
    return time_range(logs, start, end)


# Fixed values: (metric, healthy below, critical above). Values between are a
# warning; session success is healthy above and critical below.
HEALTH_BANDS = [
    ("error_rate_pct", 1.0, 5.0),
    ("p99_latency_s", 3.0, 10.0),
    ("rate_limit_per_s", 0.0, 0.5),
    ("queue_depth", 5.0, 50.0),
    ("context_window_pct", 70.0, 85.0),
    ("token_rate_x_baseline", 2.0, 10.0),
    ("session_success_pct", 95.0, 85.0),
    ("agent_loops_per_min", 0.0, 0.1),
    ("tool_failure_pct", 2.0, 10.0),
]


# Metrics whose healthy band includes its bound: "0", "0 to 5", "normal".
CLOSED_BANDS = {"rate_limit_per_s", "queue_depth", "agent_loops_per_min"}


def band(metric: Column | str, value: Column | str) -> Column:
    """Healthy / Warning / Critical for a (metric, value) pair."""
    m = F.col(metric) if isinstance(metric, str) else metric
    v = F.col(value) if isinstance(value, str) else value
    out = None
    for name, healthy, critical in HEALTH_BANDS:
        if healthy > critical:
            level = F.when(v > healthy, "Healthy").when(v < critical, "Critical")
        elif name in CLOSED_BANDS:
            level = F.when(v <= healthy, "Healthy").when(v > critical, "Critical")
        else:
            level = F.when(v < healthy, "Healthy").when(v > critical, "Critical")
        level = F.when(v.isNotNull(), level.otherwise("Warning"))
        out = F.when(m == name, level) if out is None else out.when(m == name, level)
    return out


def health_bands(values: DataFrame) -> DataFrame:
    """Add ``band`` to rows of ``metric, value``."""
    return values.withColumn("band", band("metric", "value"))
