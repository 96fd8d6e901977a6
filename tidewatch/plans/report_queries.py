"""Registered post-mortem reports. The ranges span the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.timeparse import time_range
from tidewatch.operators import reports
from tidewatch.plans import views
from tidewatch.plans.registry import query

START, END = "2024-01-01 00:00:00", "2024-12-31 00:00:00"
RANGE = f"ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}'"
SINCE = f"ts >= TIMESTAMP '{START}'"


@query(
    "error_rate",
    f"""SELECT time_bucket(INTERVAL '15 minutes', ts) AS time_bucket, service, count(*) AS total_requests,
  CAST(count(*) FILTER (WHERE level = 'ERROR') AS BIGINT) AS errors,
  round(100.0::DOUBLE * count(*) FILTER (WHERE level = 'ERROR') / count(*), 6) AS error_rate_pct,
  round(avg(latency_ms), 6) AS avg_latency_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM genai_logs WHERE {RANGE} GROUP BY 1, 2 ORDER BY 1 DESC, 5 DESC, 2""",
)
def error_rate(spark, sf_dir):
    return reports.error_rate(views.genai_logs(spark, sf_dir), START, END)


@query(
    "top_errors",
    f"""SELECT error_type, error, count(*) AS occurrences, min(ts) AS first_seen, max(ts) AS last_seen,
  date_sub('minute', min(ts), max(ts)) AS duration_minutes
FROM genai_logs WHERE level IN ('ERROR', 'CRITICAL') AND {RANGE}
GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
)
def top_errors(spark, sf_dir):
    return reports.top_errors(views.genai_logs(spark, sf_dir), START, END)


@query(
    "rate_limits",
    f"""SELECT date_trunc('minute', ts) AS minute, model, count(*) AS rate_limit_events,
  round(count(*) / 60.0::DOUBLE, 3) AS rate_limits_per_second
FROM genai_logs WHERE event = 'llm_rate_limited' AND {SINCE} GROUP BY 1, 2 ORDER BY 1 DESC, 2 LIMIT 60""",
)
def rate_limits(spark, sf_dir):
    return reports.rate_limits(views.genai_logs(spark, sf_dir), START)


@query(
    "token_cost",
    f"""SELECT CAST(ts AS DATE) AS log_date, model, CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens,
  CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens, CAST(sum(input_tokens + output_tokens) AS BIGINT) AS total_tokens,
  count(*) AS request_count,
  round(avg(CAST(output_tokens AS DOUBLE) / nullif(input_tokens, 0)), 6) AS output_input_ratio,
  round(CAST(sum(input_tokens) AS DOUBLE) / 1e6 * 0.05::DOUBLE + CAST(sum(output_tokens) AS DOUBLE) / 1e6 * 0.08::DOUBLE, 6) AS estimated_cost_usd
FROM genai_logs WHERE event = 'llm_inference_success' AND {SINCE} GROUP BY 1, 2 ORDER BY 1 DESC, 8 DESC, 2""",
)
def token_cost(spark, sf_dir):
    return reports.token_cost(views.genai_logs(spark, sf_dir), START)


@query(
    "agent_loops",
    f"""SELECT session_id, max(agent_name) AS agent_name, max(steps_taken) AS steps_taken, min(ts) AS session_start,
  max(ts) AS session_end, max(duration_ms) AS total_duration_ms, max(status) AS status,
  string_agg(tool_name, ' → ' ORDER BY step) AS tool_call_sequence
FROM agent_logs WHERE event IN ('agent_session_completed', 'agent_tool_call') AND {SINCE}
GROUP BY session_id HAVING max(steps_taken) >= 8
ORDER BY steps_taken DESC, total_duration_ms DESC, session_id LIMIT 50""",
)
def agent_loops(spark, sf_dir):
    return reports.agent_loops(views.agent_logs(spark, sf_dir), START)


@query(
    "low_confidence",
    f"""SELECT date_trunc('hour', ts) AS hour, model_version, count(*) AS total_predictions,
  count(*) FILTER (WHERE confidence < 0.6) AS low_confidence_count,
  round(100.0::DOUBLE * count(*) FILTER (WHERE confidence < 0.6) / count(*), 6) AS low_conf_pct,
  round(avg(confidence), 6) AS avg_confidence, round(avg(fraud_probability), 6) AS avg_fraud_prob,
  count(*) FILTER (WHERE is_fraud) AS fraud_count
FROM ml_logs WHERE event = 'ml_inference_success' AND {SINCE} GROUP BY 1, 2 ORDER BY 1 DESC, 2""",
)
def low_confidence(spark, sf_dir):
    return reports.low_confidence(views.ml_logs(spark, sf_dir), START)


@query(
    "latency_percentiles",
    f"""SELECT service, model, count(*) AS requests, round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms,
  round(quantile_cont(latency_ms, 0.9), 6) AS p90_ms, round(quantile_cont(latency_ms, 0.99), 6) AS p99_ms,
  round(quantile_cont(latency_ms, 0.999), 6) AS p999_ms, round(min(latency_ms), 6) AS min_ms,
  round(max(latency_ms), 6) AS max_ms, round(avg(latency_ms), 6) AS avg_ms
FROM genai_logs WHERE event = 'llm_inference_success' AND {RANGE} GROUP BY 1, 2 ORDER BY p99_ms DESC, 1, 2""",
)
def latency_percentiles(spark, sf_dir):
    return reports.latency_percentiles(views.genai_logs(spark, sf_dir), START, END)


APPROX = ["p50", "p90", "p99", "p999"]
ACCURACY = 10_000


@query(
    "latency_percentiles_approx",
    f"""SELECT service, model, count(*) AS requests, {", ".join(f"TRUE AS {p}_near" for p in APPROX)}
FROM genai_logs WHERE event = 'llm_inference_success' AND {RANGE} GROUP BY 1, 2""",
)
def latency_percentiles_approx(spark, sf_dir):
    """Sketch form: whether the rank of each percentile is within the sketch's error of the wanted one."""
    logs = views.genai_logs(spark, sf_dir)
    found = reports.latency_percentiles(logs, START, END, approx=True, digits=None)
    rows = time_range(logs, START, END).where(F.col("event") == "llm_inference_success").select("service", "model", "latency_ms")
    counts = []
    for p in APPROX:
        counts += [F.count_if(F.col("latency_ms") < F.col(f"{p}_ms")).alias(f"{p}_low"), F.count_if(F.col("latency_ms") <= F.col(f"{p}_ms")).alias(f"{p}_high")]
    ranks = rows.join(found, ["service", "model"]).groupBy("service", "model", "requests").agg(*counts)
    # One row of the group is the finest step a rank can have.
    slack = F.lit(1.0 / ACCURACY) + 1 / F.col("requests")
    near = [
        ((F.col(f"{p}_low") / F.col("requests") <= float("0." + p[1:]) + slack) & (F.col(f"{p}_high") / F.col("requests") >= float("0." + p[1:]) - slack)).alias(f"{p}_near")
        for p in APPROX
    ]
    return ranks.select("service", "model", "requests", *near)


@query(
    "consumer_lag",
    f"""SELECT date_trunc('minute', ts) AS minute, consumer_group, topic, part AS "partition", max(lag) AS max_lag,
  round(avg(lag), 6) AS avg_lag, max(lag) - min(lag) AS lag_delta
FROM kafka_consumer_offsets WHERE {RANGE} GROUP BY 1, 2, 3, 4 ORDER BY 1 DESC, 5 DESC, 2, 3, 4""",
)
def consumer_lag(spark, sf_dir):
    offsets = views.kafka_consumer_offsets(spark, sf_dir).withColumnRenamed("part", "partition")
    return reports.consumer_lag(offsets, START, END)


@query(
    "context_saturation",
    f"""SELECT model, count(*) AS requests, count(*) FILTER (WHERE ctx_utilization > 0.85) AS near_limit_count,
  round(avg(ctx_utilization), 6) AS avg_ctx_utilization, round(max(ctx_utilization), 6) AS max_ctx_utilization,
  round(100.0::DOUBLE * count(*) FILTER (WHERE ctx_utilization > 0.85) / count(*), 6) AS pct_near_limit,
  round(avg(input_tokens + output_tokens), 6) AS avg_total_tokens
FROM genai_logs WHERE event = 'llm_inference_success' AND {SINCE} GROUP BY model ORDER BY pct_near_limit DESC, model""",
)
def context_saturation(spark, sf_dir):
    return reports.context_saturation(views.genai_logs(spark, sf_dir), START)


@query(
    "incident_timeline",
    f"""SELECT ts, service, level, event, entity_id, error_info, latency_ms, model FROM (
  SELECT ts, service, level, event, request_id AS entity_id, coalesce(error, error_type) AS error_info, latency_ms, model FROM genai_logs
  UNION ALL SELECT ts, service, level, event, session_id, error, duration_ms, NULL FROM agent_logs
  UNION ALL SELECT ts, service, level, event, transaction_id, error, latency_ms, NULL FROM ml_logs) u
WHERE level IN ('ERROR', 'WARNING', 'CRITICAL') AND {RANGE} ORDER BY ts, service, event, entity_id LIMIT 500""",
)
def incident_timeline(spark, sf_dir):
    return reports.incident_timeline(
        views.genai_logs(spark, sf_dir), views.agent_logs(spark, sf_dir), views.ml_logs(spark, sf_dir), START, END
    )
