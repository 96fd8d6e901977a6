"""Registered metric derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.skew import salted_join
from tidewatch.operators import metrics as m
from tidewatch.operators.features import FEATURE_NAMES, missing_rates
from tidewatch.plans import views
from tidewatch.plans.registry import query



def request_status() -> Column:
    event = F.col("event")
    return F.when(event == "llm_inference_success", "success").when(event == "llm_rate_limited", "rate_limited").otherwise("error")


STATUS_SQL = "CASE event WHEN 'llm_inference_success' THEN 'success' WHEN 'llm_rate_limited' THEN 'rate_limited' ELSE 'error' END"
SUCCESS = "event = 'llm_inference_success'"


def le_text(le: Column | str = "le") -> Column:
    c = F.col(le) if isinstance(le, str) else le
    return F.when(c == float("inf"), "+Inf").otherwise(c.cast("string"))


def histogram_sql(source: str, by: str, value: str, metric: str) -> str:
    edges = ", ".join(f"({i}, {float(b)}::DOUBLE)" for i, b in enumerate(m.BOUNDS[metric]))
    return f"""SELECT {by}, CASE WHEN isinf(b.le) THEN '+Inf' ELSE CAST(b.le AS VARCHAR) END AS le,
  count(*) FILTER (WHERE v <= b.le) AS bucket, count(*) AS "count", round(sum(v), 4) AS "sum"
FROM (SELECT {by}, {value} AS v FROM {source}) s, (VALUES {edges}, (99, 'inf'::DOUBLE)) b(i, le) WHERE v IS NOT NULL GROUP BY ALL"""


def _histogram(df: DataFrame, by: list[str], metric: str) -> DataFrame:
    out = m.histogram(df, by, "v", m.BOUNDS[metric])
    return out.withColumns({"le": le_text(), "sum": F.round("sum", 4)})


@query("metric_requests", f"SELECT service, model, {STATUS_SQL} AS status, count(*) AS value FROM genai_logs GROUP BY 1, 2, 3")
def metric_requests(spark, sf_dir):
    return m.counter(views.genai_logs(spark, sf_dir).withColumn("status", request_status()), ["service", "model", "status"])


@query(
    "metric_request_duration",
    histogram_sql("genai_logs WHERE event = 'llm_inference_success'", "service, model", "latency_ms / 1000", "genai_request_duration_seconds"),
)
def metric_request_duration(spark, sf_dir):
    logs = views.genai_logs(spark, sf_dir).where(SUCCESS).withColumn("v", F.col("latency_ms") / 1000)
    return _histogram(logs, ["service", "model"], "genai_request_duration_seconds")


@query(
    "metric_tokens",
    """SELECT service, model, type, value FROM (
  SELECT service, model, 'input' AS type, CAST(sum(input_tokens) AS BIGINT) AS value FROM genai_logs GROUP BY 1, 2
  UNION ALL SELECT service, model, 'output', CAST(sum(output_tokens) AS BIGINT) FROM genai_logs GROUP BY 1, 2) t WHERE value IS NOT NULL""",
)
def metric_tokens(spark, sf_dir):
    return m.token_counts(views.genai_logs(spark, sf_dir))


@query("metric_rate_limit_hits", "SELECT service, model, count(*) AS value FROM genai_logs WHERE event = 'llm_rate_limited' GROUP BY 1, 2")
def metric_rate_limit_hits(spark, sf_dir):
    return m.counter(views.genai_logs(spark, sf_dir).where(F.col("event") == "llm_rate_limited"), ["service", "model"])


WORDS_SQL = r"len(list_filter(string_split_regex(text, '[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda w: w <> ''))"


@query(
    "metric_context_utilization",
    f"""WITH words AS (SELECT conv_id, turn, role, {WORDS_SQL} AS n FROM conversations),
preamble AS (SELECT conv_id, sum(n) AS n FROM words WHERE role = 'system' GROUP BY 1)
SELECT w.conv_id, w.turn, CASE w.conv_id % 3 WHEN 0 THEN 'gemma2-9b-it' WHEN 1 THEN 'llama-3.3-70b-versatile' ELSE 'other' END AS model,
  CAST(w.n + coalesce(p.n, 0) AS BIGINT) AS estimated_tokens,
  round(least((w.n + coalesce(p.n, 0)) / (CASE w.conv_id % 3 WHEN 1 THEN 131072 ELSE 8192 END)::DOUBLE, 1.0), 9) AS ctx_utilization
FROM words w LEFT JOIN preamble p ON w.conv_id = p.conv_id WHERE w.role = 'user'""",
)
def metric_context_utilization(spark, sf_dir):
    """Prompt plus system-prompt words over the context size of the model."""
    words = views.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", m.word_count("text").alias("n"))
    preamble = words.where(F.col("role") == "system").groupBy("conv_id").agg(F.sum("n").alias("system_words"))
    prompts = words.where(F.col("role") == "user").drop("role")
    which = F.col("conv_id") % 3
    model = F.when(which == 0, "gemma2-9b-it").when(which == 1, "llama-3.3-70b-versatile").otherwise("other")
    joined = salted_join(prompts, preamble, ["conv_id"], ["turn"])
    tokens = F.col("n") + F.coalesce("system_words", F.lit(0))
    return joined.select(
        "conv_id", "turn", model.alias("model"), tokens.alias("estimated_tokens"), F.round(m.context_utilization(tokens, model), 9).alias("ctx_utilization")
    )


@query(
    "metric_context_gauge",
    "SELECT service, model, arg_max(ctx_utilization, (us, request_id)) AS value FROM genai_logs WHERE event = 'llm_inference_success' GROUP BY 1, 2",
)
def metric_context_gauge(spark, sf_dir):
    return m.latest(views.genai_logs(spark, sf_dir).where(SUCCESS), ["service", "model"], "ctx_utilization", ["us", "request_id"])


def _queue_sql(source: str) -> str:
    return f"""WITH work AS ({source}),
moves AS (SELECT service, id, start_us AS us, 1 AS delta FROM work UNION ALL SELECT service, id, end_us, -1 FROM work),
depths AS (SELECT service, id, us, delta, sum(delta) OVER (PARTITION BY service ORDER BY us, delta, id ROWS UNBOUNDED PRECEDING) AS depth FROM moves)
SELECT service, CAST(floor(us / 3600000000) AS BIGINT) AS hour, CAST(max(depth) AS BIGINT) AS max_depth,
  CAST(arg_max(depth, (us, delta, id)) AS BIGINT) AS last_depth FROM depths GROUP BY 1, 2"""


def _hourly_depth(work: DataFrame) -> DataFrame:
    depths = m.queue_depth(work, ["service"], "start_us", "end_us", ["id"])
    return depths.groupBy("service", F.floor(F.col("us") / 3_600_000_000).cast("long").alias("hour")).agg(
        F.max("depth").alias("max_depth"), F.max_by("depth", F.struct("us", "delta", "id")).alias("last_depth")
    )


@query(
    "metric_queue_depth",
    _queue_sql("SELECT service, request_id AS id, us - CAST(floor(latency_ms * 1000) AS BIGINT) AS start_us, us AS end_us FROM genai_logs"),
)
def metric_queue_depth(spark, sf_dir):
    """Pending requests; a request starts its latency before its log line."""
    work = views.genai_logs(spark, sf_dir).select(
        "service",
        F.col("request_id").alias("id"),
        (F.col("us") - F.floor(F.col("latency_ms") * 1000).cast("long")).alias("start_us"),
        F.col("us").alias("end_us"),
    )
    return _hourly_depth(work)


@query("metric_agent_queue_depth", _queue_sql("SELECT 'agentic-pipeline' AS service, session_id AS id, start_us, end_us FROM agent_sessions"))
def metric_agent_queue_depth(spark, sf_dir):
    work = views.agent_sessions(spark, sf_dir).select(
        F.lit("agentic-pipeline").alias("service"), F.col("session_id").alias("id"), "start_us", "end_us"
    )
    return _hourly_depth(work)


@query("metric_agent_sessions", "SELECT agent_name, status, count(*) AS value FROM agent_sessions GROUP BY 1, 2")
def metric_agent_sessions(spark, sf_dir):
    return m.counter(views.agent_sessions(spark, sf_dir), ["agent_name", "status"])


@query("metric_session_duration", histogram_sql("agent_sessions", "agent_name", "duration_ms / 1000", "agent_session_duration_seconds"))
def metric_session_duration(spark, sf_dir):
    sessions = views.agent_sessions(spark, sf_dir).withColumn("v", F.col("duration_ms") / 1000)
    return _histogram(sessions, ["agent_name"], "agent_session_duration_seconds")


@query("metric_agent_steps", "SELECT agent_name, count(*) AS value FROM agent_steps GROUP BY 1")
def metric_agent_steps(spark, sf_dir):
    return m.counter(views.agent_events(spark, sf_dir), ["agent_name"])


@query("metric_step_duration", histogram_sql("agent_steps", "agent_name", "value / 10", "agent_step_duration_seconds"))
def metric_step_duration(spark, sf_dir):
    steps = views.agent_events(spark, sf_dir).withColumn("v", F.col("value") / 10)
    return _histogram(steps, ["agent_name"], "agent_step_duration_seconds")


@query(
    "metric_tool_calls",
    "SELECT agent_name, tool_name, tool_status AS status, count(*) AS value FROM agent_steps WHERE tool_name IS NOT NULL GROUP BY 1, 2, 3",
)
def metric_tool_calls(spark, sf_dir):
    calls = views.agent_events(spark, sf_dir).where(F.col("tool_name").isNotNull())
    return m.counter(calls.withColumnRenamed("tool_status", "status"), ["agent_name", "tool_name", "status"])


@query("metric_max_steps_reached", "SELECT agent_name, count(*) AS value FROM agent_sessions WHERE status = 'max_steps_reached' GROUP BY 1")
def metric_max_steps_reached(spark, sf_dir):
    return m.counter(views.agent_sessions(spark, sf_dir).where(F.col("status") == "max_steps_reached"), ["agent_name"])


@query(
    "metric_hallucinations",
    "SELECT agent_name, count(*) AS value FROM agent_steps WHERE event_type = 'signup' AND k >= 90 GROUP BY 1",
)
def metric_hallucinations(spark, sf_dir):
    """Counts a caller-supplied guardrail flag on final answers."""
    flagged = (F.col("event_type") == "signup") & (F.col("k") >= 90)
    return m.counter(views.agent_events(spark, sf_dir).where(flagged), ["agent_name"])


@query(
    "metric_ml_requests",
    """SELECT service, 'fraud-detector' AS model_name, model_version, CASE event WHEN 'ml_inference_success' THEN 'success' ELSE 'error' END AS status,
  count(*) AS value FROM ml_logs GROUP BY ALL""",
)
def metric_ml_requests(spark, sf_dir):
    logs = views.ml_logs(spark, sf_dir).withColumns({"model_name": F.lit(m.MODEL_NAME), "status": F.when(F.col("event") == "ml_inference_success", "success").otherwise("error")})
    return m.counter(logs, ["service", "model_name", "model_version", "status"])


@query(
    "metric_ml_duration",
    histogram_sql("ml_logs WHERE event = 'ml_inference_success'", "service, model_version", "latency_ms / 1000", "ml_inference_duration_seconds"),
)
def metric_ml_duration(spark, sf_dir):
    logs = views.ml_logs(spark, sf_dir).where(F.col("event") == "ml_inference_success").withColumn("v", F.col("latency_ms") / 1000)
    return _histogram(logs, ["service", "model_version"], "ml_inference_duration_seconds")


@query(
    "metric_ml_confidence",
    histogram_sql("ml_logs WHERE event = 'ml_inference_success'", "service, model_version", "confidence", "ml_prediction_confidence"),
)
def metric_ml_confidence(spark, sf_dir):
    logs = views.ml_logs(spark, sf_dir).where(F.col("event") == "ml_inference_success").withColumn("v", F.col("confidence"))
    return _histogram(logs, ["service", "model_version"], "ml_prediction_confidence")


LABEL_SQL = """(CASE WHEN transaction_amount > 500 THEN 4 ELSE 0 END + CASE WHEN is_international THEN 3 ELSE 0 END
  + CASE WHEN user_age_days < 90 THEN 2 ELSE 0 END + CASE WHEN tx_count_24h > 10 THEN 1 ELSE 0 END) > 4"""


@query(
    "metric_model_accuracy",
    f"""WITH scored AS (SELECT p.model_version, p.transaction_id, p.us, CASE WHEN p.is_fraud = ({LABEL_SQL}) THEN 1 ELSE 0 END AS hit
  FROM ml_logs p JOIN ml_features f ON p.transaction_id = f.transaction_id)
SELECT model_version, transaction_id, round(avg(hit) OVER (PARTITION BY model_version ORDER BY us, transaction_id ROWS 99 PRECEDING), 6) AS rolling_accuracy
FROM scored""".replace("is_international", "f.is_international"),
)
def metric_model_accuracy(spark, sf_dir):
    """Accuracy over the last 100 predictions of the model version."""
    scored = views.scored_rows(spark, sf_dir)
    rolled = m.rolling_accuracy(scored, ["model_version"], "us", ["transaction_id"], F.col("is_fraud") == F.col("label"), 100)
    return rolled.select("model_version", "transaction_id", F.round("rolling_accuracy", 6).alias("rolling_accuracy"))


def _missing_sql(name: str) -> str:
    gap = f"event_id % {views.NULLED[name]} = 0 OR " if name in views.NULLED else ""
    absent = f"count(*) FILTER (WHERE {gap}{name} IS NULL OR isnan(CAST({name} AS DOUBLE)))"
    return f"SELECT CAST(ts AS DATE) AS log_date, '{name}' AS feature_name, count(*) AS \"rows\", {absent} AS missing, round({absent} / count(*), 9) AS missing_rate FROM ml_features GROUP BY 1"


@query("metric_feature_missing_rate", "\nUNION ALL ".join(_missing_sql(f) for f in FEATURE_NAMES))
def metric_feature_missing_rate(spark, sf_dir):
    """Share of absent values per day, for all nine features."""
    rows = views.with_gaps(views.ml_features(spark, sf_dir)).withColumn("log_date", F.to_date("ts"))
    return missing_rates(rows, list(FEATURE_NAMES), ["log_date"]).withColumn("missing_rate", F.round("missing_rate", 9))


@query(
    "metric_last_training",
    "SELECT service, model_version, CAST(floor(max(us) / 1000000) AS BIGINT) AS value FROM ml_logs GROUP BY 1, 2",
)
def metric_last_training(spark, sf_dir):
    logs = views.ml_logs(spark, sf_dir)
    return logs.groupBy("service", "model_version").agg(F.floor(F.max("us") / 1_000_000).cast("long").alias("value"))


def topic() -> Column:
    kind = F.col("event_type")
    return F.when(kind.isin("click", "view"), "genai-events").when(kind == "purchase", "agent-events").otherwise("pipeline-logs")


TOPIC_SQL = "CASE WHEN event_type IN ('click', 'view') THEN 'genai-events' WHEN event_type = 'purchase' THEN 'agent-events' ELSE 'pipeline-logs' END"


@query(
    "metric_messages_processed",
    f"SELECT {TOPIC_SQL} AS topic, CASE event_type WHEN 'error' THEN 'error' ELSE 'success' END AS status, count(*) AS value FROM ev GROUP BY 1, 2",
)
def metric_messages_processed(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "error").otherwise("success")
    return m.counter(views.ev(spark, sf_dir).withColumns({"topic": topic(), "status": status}), ["topic", "status"])


@query(
    "metric_message_duration",
    histogram_sql(f"(SELECT {TOPIC_SQL} AS topic, value FROM ev) e", "topic", "value / 10", "kafka_message_processing_duration_seconds"),
)
def metric_message_duration(spark, sf_dir):
    rows = views.ev(spark, sf_dir).select(topic().alias("topic"), (F.col("value") / 10).alias("v"))
    return _histogram(rows, ["topic"], "kafka_message_processing_duration_seconds")
