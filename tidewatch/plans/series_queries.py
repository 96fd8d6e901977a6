"""Registered time-series queries. Ranges are hours: the samples are hourly."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.labels import labels_of, render
from tidewatch.functions.scan import HOUR
from tidewatch.operators import timeseries as ts
from tidewatch.operators.features import FEATURE_NAMES
from tidewatch.plans import views
from tidewatch.plans.metric_queries import LABEL_SQL
from tidewatch.plans.registry import query
from tidewatch.plans.samples import SPLIT, derive_samples

# The deviation is a quotient; both engines agree on it to nine digits, and equal values must stay equal.
EXACT_SQL = {n: f"round(CAST({n} AS DOUBLE), 9)" if n == "amount_deviation" else f"CAST({n} AS DOUBLE)" for n in FEATURE_NAMES}
KEYS = ["model", "status"]
RANGE, STEP = 6 * HOUR, HOUR // 2

SERIES = {
    "growths": """
SELECT model, status, us, value, coalesce(CASE WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE CASE WHEN lag(value) OVER w IS NULL THEN 0 ELSE value END END, 0) AS growth
FROM metric_samples WINDOW w AS (PARTITION BY model, status ORDER BY us)""",
    "grid": f"""
SELECT model, status, unnest(range(CAST(ceil(min(us) / {STEP}) AS BIGINT) * {STEP}, max(us) + {RANGE} + 1, {STEP})) AS t FROM growths GROUP BY 1, 2""",
    "windows": f"""
SELECT g.model, g.status, g.t, min(s.us) AS first_us, max(s.us) AS last_us, arg_min(s.value, s.us) AS first_value,
  arg_max(s.value, s.us) AS last_value, count(*) AS samples, sum(s.growth) - arg_min(s.growth, s.us) AS increase
FROM grid g JOIN growths s ON g.model = s.model AND g.status = s.status AND s.us BETWEEN g.t - {RANGE} AND g.t GROUP BY 1, 2, 3""",
}


@query("increase", "SELECT model, status, t AS eval_us, round(increase, 6) AS value FROM windows WHERE samples >= 2", SERIES)
def increase(spark, sf_dir):
    grown = ts.increase(views.metric_samples(spark, sf_dir), KEYS, RANGE, STEP)
    return grown.withColumn("value", F.round("value", 6))


@query("rate", f"SELECT model, status, t AS eval_us, round(increase / {RANGE / 1e6}, 9) AS value FROM windows WHERE samples >= 2", SERIES)
def rate(spark, sf_dir):
    return ts.rate(views.metric_samples(spark, sf_dir), KEYS, RANGE, STEP).withColumn("value", F.round("value", 9))


@query(
    "rate_extrapolated",
    f"""WITH e AS (SELECT *, CAST(last_us - first_us AS DOUBLE) AS covered, CAST(last_us - first_us AS DOUBLE) / (samples - 1) AS dist,
  CAST(first_us - (t - {RANGE}) AS DOUBLE) AS gap_a, CAST(t - last_us AS DOUBLE) AS gap_b FROM windows WHERE samples >= 2),
f AS (SELECT *, CASE WHEN increase > 0 AND first_value >= 0 AND covered * (first_value / increase) < gap_a THEN covered * (first_value / increase) ELSE gap_a END AS gap_z FROM e)
SELECT model, status, t AS eval_us, round(increase * ((covered + CASE WHEN gap_z < dist * 1.1::DOUBLE THEN gap_z ELSE dist / 2 END
  + CASE WHEN gap_b < dist * 1.1::DOUBLE THEN gap_b ELSE dist / 2 END) / covered) / {RANGE / 1e6}, 9) AS value FROM f""",
    SERIES,
)
def rate_extrapolated(spark, sf_dir):
    out = ts.rate(views.metric_samples(spark, sf_dir), KEYS, RANGE, STEP, extrapolate=True)
    return out.withColumn("value", F.round("value", 9))


@query(
    "instant_vector",
    "SELECT model, status, t AS eval_us, last_us AS sample_us, last_value AS value FROM windows",
    SERIES,
)
def instant_vector(spark, sf_dir):
    return ts.instant_vector(views.metric_samples(spark, sf_dir), KEYS, STEP, RANGE)


@query(
    "error_ratio",
    f"""SELECT model, t AS eval_us, round(sum(increase / {RANGE / 1e6}) FILTER (WHERE status = 'error') / sum(increase / {RANGE / 1e6}), 6) AS value
FROM windows WHERE samples >= 2 GROUP BY 1, 2 HAVING sum(increase) FILTER (WHERE status = 'error') IS NOT NULL AND sum(increase) <> 0""",
    SERIES,
)
def error_ratio(spark, sf_dir):
    rates = ts.rate(views.metric_samples(spark, sf_dir), KEYS, RANGE, STEP)
    ratio = ts.ratio_of(rates, F.col("status") == "error", ["model"])
    return ratio.where(~F.isnan("value")).withColumn("value", F.round("value", 6))


@query(
    "vector_matching",
    """WITH r AS (SELECT model, status, t, increase FROM windows WHERE samples >= 2)
SELECT a.model, a.t AS eval_us, round(100 * (1 - a.increase / b.total), 6) AS value
FROM r a JOIN (SELECT model, t, sum(increase) AS total FROM r GROUP BY 1, 2) b ON a.model = b.model AND a.t = b.t
WHERE a.status = 'success' AND b.total <> 0""",
    SERIES,
)
def vector_matching(spark, sf_dir):
    """``(1 - a / b) * 100`` of two vectors with equal labels."""
    grown = ts.increase(views.metric_samples(spark, sf_dir), KEYS, RANGE, STEP)
    part = grown.where(F.col("status") == "success").drop("status")
    total = ts.sum_by(grown, ["model"]).where(F.col("value") != 0)
    return ts.combine(part, total, ["model"], F.round(F.lit(100.0) * (F.lit(1.0) - F.col("l") / F.col("r")), 6))


@query(
    "average_rate",
    f"SELECT status, t AS eval_us, round(avg(increase / {RANGE / 1e6}), 9) AS value FROM windows WHERE samples >= 2 GROUP BY 1, 2",
    SERIES,
)
def average_rate(spark, sf_dir):
    rates = ts.rate(views.metric_samples(spark, sf_dir), KEYS, RANGE, STEP)
    return ts.avg_by(rates, ["status"]).withColumn("value", F.round("value", 9))


@query(
    "gauge_age",
    "SELECT model, status, t AS eval_us, round(t / 1e6 - last_us / 1e6, 6) AS value FROM windows",
    SERIES,
)
def gauge_age(spark, sf_dir):
    """Seconds since the last scrape, as the age of a gauge of Unix seconds."""
    stamps = views.metric_samples(spark, sf_dir).withColumn("value", F.col("us") / 1e6)
    return ts.age(ts.instant_vector(stamps, KEYS, STEP, RANGE)).drop("sample_us").withColumn("value", F.round("value", 6))


def _sample_sql() -> dict[str, str]:
    from tidewatch.operators.metrics import BOUNDS

    call = "'model=' || model || ',service=' || service"
    agent = "'agent_name=' || agent_name || ',service=agentic-pipeline"
    model = "'model_name=fraud-detector,model_version=' || model_version || ',service=' || service"
    ok, scored = "event = 'llm_inference_success'", "event = 'ml_inference_success'"
    status = f"CASE event WHEN 'llm_inference_success' THEN 'success' WHEN 'llm_rate_limited' THEN 'rate_limited' ELSE 'error' END"
    rows = [
        ("genai_requests_total", f"{call} || ',status=' || {status}", "us", "1", "genai_logs"),
        ("genai_tokens_total", f"{call} || ',type=input'", "us", "input_tokens", f"genai_logs WHERE {ok}"),
        ("genai_tokens_total", f"{call} || ',type=output'", "us", "output_tokens", f"genai_logs WHERE {ok}"),
        ("genai_rate_limit_hits_total", call, "us", "1", "genai_logs WHERE event = 'llm_rate_limited'"),
        ("agent_sessions_total", f"{agent},status=' || status", "end_us", "1", "agent_sessions"),
        ("agent_steps_total", f"{agent}'", "us", "1", "agent_steps"),
        ("agent_hallucinations_detected_total", f"{agent}'", "us", "1", "agent_steps WHERE event_type = 'signup' AND k >= 90"),
        ("agent_queue_depth", "'service=agentic-pipeline'", "start_us", "1", "agent_sessions"),
        ("agent_queue_depth", "'service=agentic-pipeline'", "end_us", "-1", "agent_sessions"),
        ("agent_tool_calls_total", f"{agent},status=' || tool_status || ',tool_name=' || tool_name", "us", "1", "agent_steps WHERE tool_name IS NOT NULL"),
        ("agent_max_steps_reached_total", f"{agent}'", "end_us", "1", "agent_sessions WHERE status = 'max_steps_reached'"),
        ("ml_inference_requests_total", f"{model} || ',status=' || CASE event WHEN 'ml_inference_success' THEN 'success' ELSE 'error' END", "us", "1", "ml_logs"),
    ]
    histograms = [
        ("genai_request_duration_seconds", call, "us", "latency_ms / 1000", f"genai_logs WHERE {ok}"),
        ("agent_session_duration_seconds", f"{agent}'", "end_us", "duration_ms / 1000", "agent_sessions"),
        ("ml_inference_duration_seconds", model, "us", "latency_ms / 1000", f"ml_logs WHERE {scored}"),
        ("ml_prediction_confidence", model, "us", "confidence", f"ml_logs WHERE {scored}"),
    ]
    parts = [f"SELECT '{n}' AS metric, {s} AS series, NULL::DOUBLE AS le, {u} AS us, CAST({v} AS BIGINT) AS n FROM {f}" for n, s, u, v, f in rows]
    for n, s, u, v, f in histograms:
        edges = ", ".join([f"({float(b)}::DOUBLE)" for b in BOUNDS[n]] + ["('inf'::DOUBLE)"])
        parts.append(
            f"SELECT '{n}_bucket', s, b.le, us, CASE WHEN v <= b.le THEN 1 ELSE 0 END FROM (SELECT {s} AS s, {u} AS us, {v} AS v FROM {f}) x, (VALUES {edges}) b(le)"
        )
    offsets = "'consumergroup=' || consumer_group || ',partition=' || CAST(part AS VARCHAR) || ',topic=' || topic"
    gauges = [
        ("genai_context_window_utilization", call, "ctx_utilization", "(us, request_id)", f"genai_logs WHERE {ok}"),
        ("kafka_consumergroup_lag", offsets, "lag", "(us, log_end_offset)", "kafka_consumer_offsets"),
        ("kafka_topic_partition_current_offset", "'partition=' || CAST(part AS VARCHAR) || ',topic=' || topic", "log_end_offset", "(us, log_end_offset)", "kafka_consumer_offsets"),
        ("ml_last_training_completed_timestamp", "'model_name=fraud-detector,service=' || service", "floor(us / 86400000000) * 86400", "(us, transaction_id)", "ml_logs"),
    ]
    gauge_sql = [
        f"SELECT '{n}' AS metric, {s} AS series, NULL::DOUBLE AS le, (CAST(floor(us / {HOUR}) AS BIGINT) + 1) * {HOUR} AS us, CAST(arg_max({v}, {o}) AS DOUBLE) AS value FROM {f} GROUP BY ALL"
        for n, s, v, o, f in gauges
    ]
    scrape = f"(CAST(floor(us / {HOUR}) AS BIGINT) + 1) * {HOUR}"
    feature = "'feature_name=' || feature || ',model_name=fraud-detector,service=ml-pipeline'"
    values = " UNION ALL ".join(f"SELECT '{n}' AS feature, us, ts, {c} AS v FROM ml_features WHERE {n} IS NOT NULL" for n, c in EXACT_SQL.items())
    gap = lambda n: f"event_id % {views.NULLED[n]} = 0 OR " if n in views.NULLED else ""
    missing = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, {scrape} AS us, count(*) FILTER (WHERE {gap(n)}{n} IS NULL OR isnan(CAST({n} AS DOUBLE))) / count(*) AS value FROM ml_features GROUP BY 2" for n in EXACT_SQL
    )
    levels = [
        f"SELECT 'ml_data_drift_score', {feature}, NULL::DOUBLE, us, value FROM drift_scores",
        f"SELECT 'ml_feature_missing_rate', {feature}, NULL::DOUBLE, us, CAST(value AS DOUBLE) FROM ({missing}) x",
        f"SELECT 'ml_model_accuracy', 'model_name=fraud-detector,model_version=' || model_version || ',service=ml-pipeline', NULL::DOUBLE, {scrape}, arg_max(hit, (us, transaction_id)) FROM rolled GROUP BY ALL",
    ]
    return {
        "drift_values": values,
        "drift_reference": f"""
SELECT feature, v, n, sum(n) OVER (PARTITION BY feature ORDER BY v) AS upto FROM (SELECT feature, v, count(*) AS n FROM drift_values WHERE ts < TIMESTAMP '{SPLIT}' GROUP BY 1, 2) x""",
        "drift_current": f"""
SELECT *, sum(n) OVER (PARTITION BY feature, us ORDER BY v) AS upto, sum(n) OVER (PARTITION BY feature, us) AS total
FROM (SELECT feature, {scrape} AS us, v, count(*) AS n FROM drift_values WHERE ts >= TIMESTAMP '{SPLIT}' GROUP BY ALL) x""",
        "drift_met": """
SELECT c.feature, c.us, c.n, c.upto, c.total, coalesce(r.upto, 0) AS ref_upto, CASE WHEN r.v = c.v THEN r.n ELSE 0 END AS ref_n, w.total AS ref_total
FROM drift_current c ASOF LEFT JOIN drift_reference r ON c.feature = r.feature AND c.v >= r.v JOIN (SELECT feature, sum(n) AS total FROM drift_reference GROUP BY 1) w ON c.feature = w.feature""",
        "drift_scores": """
SELECT feature, us, max(greatest(abs(ref_upto / ref_total - upto / total), abs((ref_upto - ref_n) / ref_total - (upto - n) / total))) AS value FROM drift_met GROUP BY 1, 2""",
        "rolled": f"""
SELECT model_version, transaction_id, us, avg(hit) OVER (PARTITION BY model_version ORDER BY us, transaction_id ROWS 99 PRECEDING) AS hit
FROM (SELECT p.model_version, p.transaction_id, p.us, CASE WHEN p.is_fraud = ({LABEL_SQL.replace('is_international', 'f.is_international')}) THEN 1 ELSE 0 END AS hit FROM ml_logs p JOIN ml_features f ON p.transaction_id = f.transaction_id) x""",
        "growth_rows": "\nUNION ALL ".join(parts),
        "growth_hours": f"SELECT metric, series, le, (CAST(floor(us / {HOUR}) AS BIGINT) + 1) * {HOUR} AS us, sum(n) AS growth FROM growth_rows GROUP BY ALL",
        "growth_grid": f"SELECT metric, series, le, unnest(range(min(us), (SELECT CAST(floor((max(us) + {HOUR}) / {HOUR}) AS BIGINT) * {HOUR} FROM ev) + 1, {HOUR})) AS us FROM growth_hours GROUP BY 1, 2, 3",
        "telemetry": f"""
SELECT g.metric, g.series, g.le, g.us, CAST(sum(coalesce(h.growth, 0)) OVER (PARTITION BY g.metric, g.series, g.le ORDER BY g.us) AS DOUBLE) AS value
FROM growth_grid g LEFT JOIN growth_hours h ON g.metric = h.metric AND g.series = h.series AND g.le IS NOT DISTINCT FROM h.le AND g.us = h.us
UNION ALL {' UNION ALL '.join(gauge_sql + levels)}""",
    }


TELEMETRY = _sample_sql()


@query("telemetry_samples", "SELECT metric, series, CASE WHEN isinf(le) THEN '+Inf' ELSE CAST(le AS VARCHAR) END AS le, us, value FROM telemetry", TELEMETRY)
def telemetry_samples(spark, sf_dir):
    """All metrics as hourly scrapes."""
    le = F.when(F.col("le") == float("inf"), "+Inf").otherwise(F.col("le").cast("string"))
    return derive_samples(spark, sf_dir).select("metric", render(labels_of("series")).alias("series"), le.alias("le"), "us", "value")


QUANTILES = {
    **TELEMETRY,
    "bucket_growths": """
SELECT series, le, us, value - coalesce(lag(value) OVER (PARTITION BY series, le ORDER BY us), value) AS growth
FROM telemetry WHERE metric = 'genai_request_duration_seconds_bucket'""",
    "bucket_grid": f"SELECT series, le, unnest(range(min(us), max(us) + {RANGE} + 1, {HOUR})) AS t FROM bucket_growths GROUP BY 1, 2",
    "bucket_rates": f"""
SELECT g.series, g.le, g.t, (sum(s.growth) - arg_min(s.growth, s.us)) / {RANGE / 1e6} AS n
FROM bucket_grid g JOIN bucket_growths s ON g.series = s.series AND g.le = s.le AND s.us BETWEEN g.t - {RANGE} AND g.t GROUP BY 1, 2, 3 HAVING count(*) >= 2""",
    "bucket_edges": """
SELECT *, max(n) OVER (PARTITION BY series, t) AS total, lag(n, 1, 0) OVER w AS before, lag(le) OVER w AS edge FROM bucket_rates WINDOW w AS (PARTITION BY series, t ORDER BY le)""",
}


def _quantile_sql(q: float) -> str:
    return f"""SELECT series, eval_us, round(v, 6) AS value FROM (
  SELECT series, t AS eval_us, CASE WHEN isinf(le) THEN edge ELSE coalesce(edge, 0) + (le - coalesce(edge, 0)) * (({q}::DOUBLE * total - before) / (n - before)) END AS v
  FROM bucket_edges WHERE total > 0 AND n >= {q}::DOUBLE * total QUALIFY row_number() OVER (PARTITION BY series, t ORDER BY le) = 1) x"""


def _latency_quantile(spark, sf_dir, q):
    samples = _metric(spark, sf_dir, "genai_request_duration_seconds_bucket")
    rates = ts.rate(samples, ["series", "le"], RANGE, HOUR)
    out = ts.histogram_quantile(q, rates, ["series", "eval_us"]).where(~F.isnan("value"))
    return out.select(render(labels_of("series")).alias("series"), "eval_us", F.round("value", 6).alias("value"))


@query("histogram_quantile", _quantile_sql(0.99), QUANTILES)
def histogram_quantile(spark, sf_dir):
    return _latency_quantile(spark, sf_dir, 0.99)


@query("dashboard_latency_p50", _quantile_sql(0.5), QUANTILES)
def dashboard_latency_p50(spark, sf_dir):
    return _latency_quantile(spark, sf_dir, 0.5)


def _window_sql(metric: str, window: int) -> dict[str, str]:
    return {
        **TELEMETRY,
        "d_growths": f"SELECT series, us, value, value - coalesce(lag(value) OVER (PARTITION BY series ORDER BY us), value) AS growth FROM telemetry WHERE metric = '{metric}'",
        "d_grid": f"SELECT series, unnest(range(min(us), max(us) + {window} + 1, {HOUR})) AS t FROM d_growths GROUP BY 1",
        "d_windows": f"""SELECT g.series, g.t AS eval_us, sum(s.growth) - arg_min(s.growth, s.us) AS increase
FROM d_grid g JOIN d_growths s ON g.series = s.series AND s.us BETWEEN g.t - {window} AND g.t GROUP BY 1, 2 HAVING count(*) >= 2""",
    }


def _metric(spark, sf_dir, *names):
    return derive_samples(spark, sf_dir, names)


def _label(name: str):
    return F.try_element_at(labels_of("series"), F.lit(name))


@query(
    "dashboard_request_rate",
    f"SELECT series, eval_us, round(increase / {RANGE / 1e6}, 9) AS value FROM d_windows",
    _window_sql("genai_requests_total", RANGE),
)
def dashboard_request_rate(spark, sf_dir):
    rates = ts.rate(_metric(spark, sf_dir, "genai_requests_total"), ["series"], RANGE, HOUR)
    return rates.select(render(labels_of("series")).alias("series"), "eval_us", F.round("value", 9).alias("value"))


@query(
    "dashboard_token_rate",
    f"SELECT regexp_extract(series, 'type=([a-z]+)', 1) AS type, eval_us, round(sum(increase) / {RANGE / 1e6}, 9) AS value FROM d_windows GROUP BY 1, 2",
    _window_sql("genai_tokens_total", RANGE),
)
def dashboard_token_rate(spark, sf_dir):
    grown = ts.increase(_metric(spark, sf_dir, "genai_tokens_total"), ["series"], RANGE, HOUR)
    total = ts.sum_by(grown.withColumn("type", _label("type")), ["type"])
    return total.withColumn("value", F.round(F.col("value") / (RANGE / 1e6), 9))


@query(
    "dashboard_session_success",
    """SELECT regexp_extract(series, 'agent_name=([a-z-]+)', 1) AS agent_name, eval_us,
  round(100 * sum(increase) FILTER (WHERE series LIKE '%status=completed%') / sum(increase), 6) AS value
FROM d_windows GROUP BY 1, 2 HAVING sum(increase) <> 0 AND count(*) FILTER (WHERE series LIKE '%status=completed%') > 0""",
    _window_sql("agent_sessions_total", RANGE),
)
def dashboard_session_success(spark, sf_dir):
    """Completed sessions in percent of all, per agent."""
    grown = ts.increase(_metric(spark, sf_dir, "agent_sessions_total"), ["series"], RANGE, HOUR)
    named = grown.withColumns({"agent_name": _label("agent_name"), "status": _label("status")})
    ratio = ts.ratio_of(named, F.col("status") == "completed", ["agent_name"]).where(~F.isnan("value"))
    return ratio.withColumn("value", F.round(F.col("value") * 100, 6))


@query(
    "dashboard_tool_failure",
    """SELECT regexp_extract(series, 'agent_name=([a-z-]+)', 1) AS agent_name, regexp_extract(series, 'tool_name=([a-z_]+)', 1) AS tool_name, eval_us,
  round(100 * sum(increase) FILTER (WHERE series LIKE '%status=error%') / sum(increase), 6) AS value
FROM d_windows GROUP BY 1, 2, 3 HAVING sum(increase) <> 0 AND count(*) FILTER (WHERE series LIKE '%status=error%') > 0""",
    _window_sql("agent_tool_calls_total", RANGE),
)
def dashboard_tool_failure(spark, sf_dir):
    grown = ts.increase(_metric(spark, sf_dir, "agent_tool_calls_total"), ["series"], RANGE, HOUR)
    named = grown.withColumns({n: _label(n) for n in ("agent_name", "tool_name", "status")})
    ratio = ts.ratio_of(named, F.col("status") == "error", ["agent_name", "tool_name"]).where(~F.isnan("value"))
    return ratio.withColumn("value", F.round(F.col("value") * 100, 6))


STEPS = {
    **_window_sql("agent_steps_total", RANGE),
    "q_growths": "SELECT series, us, value, value - coalesce(lag(value) OVER (PARTITION BY series ORDER BY us), value) AS growth FROM telemetry WHERE metric = 'agent_sessions_total'",
    "q_grid": f"SELECT series, unnest(range(min(us), max(us) + {RANGE} + 1, {HOUR})) AS t FROM q_growths GROUP BY 1",
    "q_windows": f"""SELECT g.series, g.t AS eval_us, sum(s.growth) - arg_min(s.growth, s.us) AS increase
FROM q_grid g JOIN q_growths s ON g.series = s.series AND s.us BETWEEN g.t - {RANGE} AND g.t GROUP BY 1, 2 HAVING count(*) >= 2""",
}


@query(
    "dashboard_average_steps",
    """SELECT a.agent_name, a.eval_us, round(a.v / b.v, 6) AS value FROM
  (SELECT regexp_extract(series, 'agent_name=([a-z-]+)', 1) AS agent_name, eval_us, sum(increase) AS v FROM d_windows GROUP BY 1, 2) a JOIN
  (SELECT regexp_extract(series, 'agent_name=([a-z-]+)', 1) AS agent_name, eval_us, sum(increase) AS v FROM q_windows GROUP BY 1, 2) b
  ON a.agent_name = b.agent_name AND a.eval_us = b.eval_us WHERE b.v <> 0""",
    STEPS,
)
def dashboard_average_steps(spark, sf_dir):
    """Steps per session; both counters are first summed to the agent."""

    def per_agent(name):
        grown = ts.increase(_metric(spark, sf_dir, name), ["series"], RANGE, HOUR)
        return ts.sum_by(grown.withColumn("agent_name", _label("agent_name")), ["agent_name"])

    sessions = per_agent("agent_sessions_total").where(F.col("value") != 0)
    return ts.combine(per_agent("agent_steps_total"), sessions, ["agent_name"], F.round(F.col("l") / F.col("r"), 6))
