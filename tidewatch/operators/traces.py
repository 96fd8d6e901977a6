"""Span analytics: search, roll-up, parent-child time, log drill-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scan import HOUR, merged_intervals
from tidewatch.functions.skew import salted_join

SPAN_KEY = ["trace_id", "span_id"]


def search_traces(
    spans: DataFrame, service: str | None = None, status: str | None = None, min_duration_ms: float | None = None, n: int | None = None
) -> DataFrame:
    """Spans by service, status and duration, slowest first."""
    if service is not None:
        spans = spans.where(F.col("service") == service)
    if status is not None:
        spans = spans.where(F.col("status") == status)
    if min_duration_ms is not None:
        spans = spans.where(F.col("duration_ms") >= min_duration_ms)
    ordered = spans.orderBy(F.desc("duration_ms"), *SPAN_KEY)
    return ordered if n is None else ordered.limit(n)


def rollup(spans: DataFrame) -> DataFrame:
    """One row per trace: root, counts, slowest and first failed step."""
    root = F.col("parent_span_id").isNull()
    failed = F.col("status") == "ERROR"
    step = ~root
    return spans.groupBy("trace_id").agg(
        F.max(F.when(root, F.col("name"))).alias("root"),
        F.max(F.when(root, F.col("duration_ms"))).alias("duration_ms"),
        F.count(F.lit(1)).alias("spans"),
        F.count_if(failed).alias("error_spans"),
        F.max_by("span_id", F.when(step, F.struct("duration_ms", "span_id"))).alias("slowest_span"),
        F.min_by("span_id", F.when(step & failed, F.struct("start_us", "span_id"))).alias("first_failed_span"),
    )


def _end_us(start: str = "start_us") -> Column:
    return F.col(start) + F.round(F.col("duration_ms") * 1000).cast("long")


def self_time(spans: DataFrame, block_us: int = HOUR) -> DataFrame:
    """Duration in which no child runs: ``child_ms`` (sum), ``covered_ms`` (union) and ``self_ms``.

    Children that overlap count once. The child intervals of a parent are merged
    to disjoint stretches first (inside time blocks, then across them), so a
    parent with very many children is no single task; the stretches are cut to
    the parent's own time and summed. A span whose parent is not there is a
    child of none.
    """
    parent = ["trace_id", "parent_span_id"]
    steps = spans.where(F.col("parent_span_id").isNotNull()).withColumn("_end", _end_us())
    sums = steps.groupBy(*parent).agg(F.sum("duration_ms").alias("child_ms"), F.count(F.lit(1)).alias("children"))
    stretches = merged_intervals(steps.select(*parent, "start_us", "_end"), parent, "start_us", "_end", block_us)
    own = spans.select("trace_id", F.col("span_id").alias("parent_span_id"), F.col("start_us").alias("_from"), _end_us().alias("_to"))
    met = salted_join(stretches, own, parent, ["start_us"], "inner")
    part = F.greatest(F.least("_end", "_to") - F.greatest("start_us", "_from"), F.lit(0))
    covered = met.groupBy(*parent).agg((F.sum(part) / 1000).alias("covered_ms"))
    both = sums.join(covered, parent, "left").withColumnRenamed("parent_span_id", "span_id")
    none = F.lit(0.0)
    return spans.join(both, SPAN_KEY, "left").withColumns(
        {
            "child_ms": F.coalesce("child_ms", none),
            "children": F.coalesce("children", F.lit(0)),
            "covered_ms": F.coalesce("covered_ms", none),
            "self_ms": F.greatest(F.col("duration_ms") - F.coalesce("covered_ms", none), none),
        }
    )


def share_of_parent(spans: DataFrame) -> DataFrame:
    """Duration of a span relative to its parent; a parent with very many
    children is salted."""
    parents = spans.select("trace_id", F.col("span_id").alias("parent_span_id"), F.col("duration_ms").alias("parent_ms"))
    steps = spans.where(F.col("parent_span_id").isNotNull())
    joined = salted_join(steps, parents, ["trace_id", "parent_span_id"], ["span_id"], "inner")
    return joined.withColumn("share", F.col("duration_ms") / F.nullif(F.col("parent_ms"), F.lit(0.0)))


def trace_logs(spans: DataFrame, logs: DataFrame) -> DataFrame:
    """Log lines of the requests a trace made. Spans without a request are left
    out before the join, so that they do not meet in one task."""
    made = spans.where(F.col("request_id").isNotNull()).select(*SPAN_KEY, "request_id", F.col("status").alias("span_status"))
    return made.join(logs.where(F.col("request_id").isNotNull()), "request_id")
