"""Post-mortem reports over the log tables.

All reports take an optional inclusive time range. Percentiles are exact unless
``approx`` is set. ``digits`` rounds averages and percentiles for display.
Orders end in a total order, so a limit always keeps the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.quantiles import percentiles_of_counts, value_counts
from tidewatch.functions.timeparse import bucketed, time_range, truncated

# Level names and list prices in USD per million tokens.
ALERTING_LEVELS = ["ERROR", "WARNING", "CRITICAL"]
FAILURE_LEVELS = ["ERROR", "CRITICAL"]
INPUT_PRICE = 0.05
OUTPUT_PRICE = 0.08
SEQUENCE_SEPARATOR = " → "
# A report of more sessions than this is joined by a shuffle.
BROADCAST_SESSIONS = 10_000


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part.cast("double") / whole.cast("double")


def _rounded(df: DataFrame, names: list[str], digits: int | None) -> DataFrame:
    return df if digits is None else df.withColumns({n: F.round(n, digits) for n in names})


def _levels(rows: DataFrame, keys: list[str], value: str, probs: dict[str, float], counted: dict[str, Column], approx: bool) -> DataFrame:
    """Per group the counts ``counted``, ``_min``, ``_max`` and ``_avg`` of the value, and its percentiles.

    The rows are read once: exact percentiles and all else come from the written
    counts of the distinct values, approximate ones from a sketch beside the rest.
    """
    if approx:
        sketch = F.percentile_approx(value, [float(p) for p in probs.values()], 10000).alias("_p")
        own = [F.min(value).alias("_min"), F.max(value).alias("_max"), F.avg(value).alias("_avg")]
        out = rows.groupBy(*keys).agg(*[c.alias(n) for n, c in counted.items()], *own, sketch)
        return out.select("*", *[F.col("_p")[i].alias(n) for i, n in enumerate(probs)]).drop("_p")
    counts = value_counts(rows, keys, value, counted)
    plain = rows.schema[value].dataType
    known = F.sum(F.when(F.col("_v").isNotNull(), F.col("_n")))
    totals = counts.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in counted],
        F.min("_v").cast(plain).alias("_min"),
        F.max("_v").cast(plain).alias("_max"),
        (F.sum(F.col("_v") * F.col("_n")) / known).alias("_avg"),
    )
    return totals.join(percentiles_of_counts(counts, keys, probs), keys, "left")


def error_rate(logs: DataFrame, start=None, end=None, bucket="15 minutes", approx=False, digits=6) -> DataFrame:
    """Requests, errors, error share and latency per time bucket and service."""
    rows = time_range(logs, start, end).select(
        bucketed(logs, bucket).alias("time_bucket"), "service", "level", "latency_ms"
    )
    keys = ["time_bucket", "service"]
    counted = {"total_requests": F.count(F.lit(1)), "errors": F.count_if(F.col("level") == "ERROR")}
    out = _levels(rows, keys, "latency_ms", {"p99_latency_ms": 0.99}, counted, approx).select(
        *keys,
        *counted,
        percent(F.col("errors"), F.col("total_requests")).alias("error_rate_pct"),
        F.col("_avg").alias("avg_latency_ms"),
        "p99_latency_ms",
    )
    out = _rounded(out, ["error_rate_pct", "avg_latency_ms", "p99_latency_ms"], digits)
    return out.orderBy(F.desc("time_bucket"), F.desc("error_rate_pct"), "service")


def top_errors(logs: DataFrame, start=None, end=None, n=20) -> DataFrame:
    """Most frequent errors with first and last sighting; whole elapsed minutes."""
    found = (
        time_range(logs, start, end)
        .where(F.col("level").isin(FAILURE_LEVELS))
        .groupBy("error_type", "error")
        .agg(F.count(F.lit(1)).alias("occurrences"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))
        .withColumn("duration_minutes", F.timestamp_diff("MINUTE", F.col("first_seen"), F.col("last_seen")))
    )
    return found.orderBy(F.desc("occurrences"), "error_type", "error").limit(n)


def rate_limits(logs: DataFrame, start=None, end=None, n=60) -> DataFrame:
    """Rate-limit hits per minute and model, the latest ``n`` rows."""
    return (
        time_range(logs, start, end)
        .where(F.col("event") == "llm_rate_limited")
        .groupBy(truncated(logs, "minute").alias("minute"), "model")
        .agg(F.count(F.lit(1)).alias("rate_limit_events"))
        .withColumn("rate_limits_per_second", F.round(F.col("rate_limit_events") / F.lit(60.0), 3))
        .orderBy(F.desc("minute"), "model")
        .limit(n)
    )


def token_cost(logs: DataFrame, start=None, end=None, input_price=INPUT_PRICE, output_price=OUTPUT_PRICE, digits=6) -> DataFrame:
    """Tokens, estimated cost and output/input ratio per day and model."""
    million = 1.0e6
    ratio = F.col("output_tokens").cast("double") / F.nullif(F.col("input_tokens"), F.lit(0).cast("long"))
    out = (
        time_range(logs, start, end)
        .where(F.col("event") == "llm_inference_success")
        .groupBy(F.to_date("ts").alias("log_date"), "model")
        .agg(
            F.sum("input_tokens").alias("total_input_tokens"),
            F.sum("output_tokens").alias("total_output_tokens"),
            F.sum(F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
            F.count(F.lit(1)).alias("request_count"),
            F.avg(ratio).alias("output_input_ratio"),
        )
        .withColumn(
            "estimated_cost_usd",
            F.col("total_input_tokens") / million * input_price + F.col("total_output_tokens") / million * output_price,
        )
    )
    return _rounded(out, ["estimated_cost_usd", "output_input_ratio"], digits).orderBy(
        F.desc("log_date"), F.desc("estimated_cost_usd"), "model"
    )


def agent_loops(logs: DataFrame, start=None, end=None, min_steps=8, n=50) -> DataFrame:
    """Sessions that took many steps, with their tool calls in order.

    Counts are reduced to the ``n`` reported sessions before any tool list is
    built, so lists exist for reported sessions only. The kept side has at most
    ``n`` rows and is broadcast up to ``BROADCAST_SESSIONS`` of them; beyond, the
    join shuffles.
    """
    wanted = time_range(logs, start, end).where(F.col("event").isin("agent_session_completed", "agent_tool_call"))
    order = [F.desc("steps_taken"), F.desc("total_duration_ms"), F.asc("session_id")]
    kept = (
        wanted.groupBy("session_id")
        .agg(
            F.max("agent_name").alias("agent_name"),
            F.max("steps_taken").alias("steps_taken"),
            F.min("ts").alias("session_start"),
            F.max("ts").alias("session_end"),
            F.max("duration_ms").alias("total_duration_ms"),
            F.max("status").alias("status"),
        )
        .where(F.col("steps_taken") >= min_steps)
        .orderBy(*order)
        .limit(n)
    )
    calls = wanted.where(F.col("tool_name").isNotNull()).select("session_id", "step", "tool_name")
    ids = kept.select("session_id")
    lists = (
        calls.join(F.broadcast(ids) if n <= BROADCAST_SESSIONS else ids, "session_id", "left_semi")
        .groupBy("session_id")
        .agg(F.array_sort(F.collect_list(F.struct("step", "tool_name"))).alias("calls"))
        .select("session_id", F.array_join(F.col("calls.tool_name"), SEQUENCE_SEPARATOR).alias("tool_call_sequence"))
    )
    return kept.join(lists, "session_id", "left").orderBy(*order)


def low_confidence(logs: DataFrame, start=None, end=None, threshold=0.6, digits=6) -> DataFrame:
    """Uncertain predictions per hour and model version."""
    low = F.count_if(F.col("confidence") < threshold)
    out = (
        time_range(logs, start, end)
        .where(F.col("event") == "ml_inference_success")
        .groupBy(truncated(logs, "hour").alias("hour"), "model_version")
        .agg(
            F.count(F.lit(1)).alias("total_predictions"),
            low.alias("low_confidence_count"),
            percent(low, F.count(F.lit(1))).alias("low_conf_pct"),
            F.avg("confidence").alias("avg_confidence"),
            F.avg("fraud_probability").alias("avg_fraud_prob"),
            F.count_if(F.col("is_fraud")).alias("fraud_count"),
        )
    )
    return _rounded(out, ["low_conf_pct", "avg_confidence", "avg_fraud_prob"], digits).orderBy(F.desc("hour"), "model_version")


def latency_percentiles(logs: DataFrame, start=None, end=None, approx=False, digits=6) -> DataFrame:
    """Latency tail per service and model of successful calls."""
    keys = ["service", "model"]
    rows = time_range(logs, start, end).where(F.col("event") == "llm_inference_success").select(*keys, "latency_ms")
    probs = {"p50_ms": 0.5, "p90_ms": 0.9, "p99_ms": 0.99, "p999_ms": 0.999}
    out = _levels(rows, keys, "latency_ms", probs, {"requests": F.count(F.lit(1))}, approx)
    out = out.withColumnsRenamed({"_min": "min_ms", "_max": "max_ms", "_avg": "avg_ms"})
    names = [*probs, "min_ms", "max_ms", "avg_ms"]
    return _rounded(out, names, digits).select(*keys, "requests", *names).orderBy(F.desc("p99_ms"), *keys)


def consumer_lag(offsets: DataFrame, start=None, end=None, partition="partition", digits=6) -> DataFrame:
    """Lag level and growth per minute and topic partition."""
    keys = ["consumer_group", "topic", partition]
    out = (
        time_range(offsets, start, end)
        .groupBy(truncated(offsets, "minute").alias("minute"), *keys)
        .agg(
            F.max("lag").alias("max_lag"),
            F.avg("lag").alias("avg_lag"),
            (F.max("lag") - F.min("lag")).alias("lag_delta"),
        )
    )
    return _rounded(out, ["avg_lag"], digits).orderBy(F.desc("minute"), F.desc("max_lag"), *keys)


def context_saturation(logs: DataFrame, start=None, end=None, threshold=0.85, digits=6) -> DataFrame:
    """How close prompts come to the context limit, per model."""
    near = F.count_if(F.col("ctx_utilization") > threshold)
    out = (
        time_range(logs, start, end)
        .where(F.col("event") == "llm_inference_success")
        .groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            near.alias("near_limit_count"),
            F.avg("ctx_utilization").alias("avg_ctx_utilization"),
            F.max("ctx_utilization").alias("max_ctx_utilization"),
            percent(near, F.count(F.lit(1))).alias("pct_near_limit"),
            F.avg(F.col("input_tokens") + F.col("output_tokens")).alias("avg_total_tokens"),
        )
    )
    names = ["avg_ctx_utilization", "max_ctx_utilization", "pct_near_limit", "avg_total_tokens"]
    return _rounded(out, names, digits).orderBy(F.desc("pct_near_limit"), "model")


def incident_timeline(genai: DataFrame, agent: DataFrame, ml: DataFrame, start=None, end=None, n=500) -> DataFrame:
    """Warnings and errors of all services in time order, the first ``n``.

    The sources are padded to one schema by the union; level and time filters
    are pushed into each branch.
    """
    text = lambda: F.lit(None).cast("string")
    head = ["ts", "service", "level", "event"]
    parts = [
        genai.select(*head, F.col("request_id").alias("entity_id"), F.coalesce("error", "error_type").alias("error_info"), "latency_ms", "model"),
        agent.select(*head, F.col("session_id").alias("entity_id"), F.col("error").alias("error_info"), F.col("duration_ms").alias("latency_ms"), text().alias("model")),
        ml.select(*head, F.col("transaction_id").alias("entity_id"), F.col("error").alias("error_info"), "latency_ms", text().alias("model")),
    ]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return (
        time_range(rows.where(F.col("level").isin(ALERTING_LEVELS)), start, end)
        .orderBy("ts", "service", "event", "entity_id")
        .limit(n)
    )
