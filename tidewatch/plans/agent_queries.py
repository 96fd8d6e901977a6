"""Registered trajectory and trace queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from tidewatch.operators import agents, traces
from tidewatch.operators.metrics import word_count
from tidewatch.plans import views
from tidewatch.plans.metric_queries import WORDS_SQL
from tidewatch.plans.registry import query


@query("session_summary", "SELECT session_id, agent_name, steps_taken, start_us, end_us, duration_ms, status FROM agent_sessions")
def session_summary(spark, sf_dir):
    failed = F.count_if(F.col("event_type") == "error") >= 4
    return agents.session_summary(views.agent_events(spark, sf_dir), failed=failed)


@query(
    "step_trace",
    """SELECT session_id, CAST(floor((step - 1) / 1000) AS BIGINT) AS part, string_agg(step || ':' || coalesce(tool_name, 'answer'), ' ' ORDER BY step) AS trace FROM agent_steps GROUP BY 1, 2""",
)
def step_trace(spark, sf_dir):
    """Ordered nested traces, shown as text."""
    nested = agents.step_trace(views.agent_steps(spark, sf_dir))
    shown = F.transform("step_trace", lambda s: F.concat(s["step"].cast("string"), F.lit(":"), F.coalesce(s["tool_name"], F.lit("answer"))))
    return nested.select("session_id", "part", F.array_join(shown, " ").alias("trace"))


def _calls(spark, sf_dir) -> DataFrame:
    """Tool calls with their argument text; some of it is not JSON, some tools
    are not registered."""
    k = F.col("k")
    steps = views.agent_steps(spark, sf_dir).where(F.col("tool_name").isNotNull())
    text = F.when(k % 10 == 9, F.concat(F.lit('{"query": '), k.cast("string"))).otherwise(
        F.concat(F.lit('{"query": "q'), (k % 4).cast("string"), F.lit('", "limit": 3}'))
    )
    return steps.withColumns(
        {
            "tool_name": F.when(k == 13, "unknown_tool").otherwise(F.col("tool_name")),
            "tool_args": text,
            "tool_success": F.col("event_type") != "error",
        }
    )


CALLS = {
    "calls": """
SELECT session_id, agent_name, step, k, event_type, CASE WHEN k = 13 THEN 'unknown_tool' ELSE tool_name END AS tool_name,
  CASE WHEN k % 10 = 9 THEN '' ELSE 'q' || (k % 4) END AS first_argument FROM agent_steps WHERE tool_name IS NOT NULL"""
}


@query(
    "tool_outcomes",
    """SELECT session_id, step, tool_name, CASE WHEN tool_name = 'unknown_tool' THEN 'not_found' WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS tool_status FROM calls""",
    CALLS,
)
def tool_outcomes(spark, sf_dir):
    return agents.tool_outcomes(_calls(spark, sf_dir)).select("session_id", "step", "tool_name", "tool_status")


@query(
    "tool_arguments",
    "SELECT session_id, step, first_argument, CASE WHEN first_argument = '' THEN 0 ELSE 2 END AS arguments FROM calls",
    CALLS,
)
def tool_arguments(spark, sf_dir):
    parsed = agents.parse_arguments(_calls(spark, sf_dir))
    return parsed.select("session_id", "step", "first_argument", F.size("tool_input").alias("arguments"))


@query(
    "repeated_calls",
    """SELECT session_id, tool_name, first_argument, count(*) AS calls, min(step) AS first_step, max(step) AS last_step FROM calls GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    CALLS,
)
def repeated_calls(spark, sf_dir):
    """Loop suspects: the same call again in one session."""
    return agents.repeated_calls(agents.parse_arguments(_calls(spark, sf_dir)))


@query(
    "consecutive_repeats",
    """SELECT session_id, step, tool_name, first_argument FROM calls QUALIFY lag((tool_name, first_argument)) OVER (PARTITION BY session_id ORDER BY step) = (tool_name, first_argument)""",
    CALLS,
)
def consecutive_repeats(spark, sf_dir):
    parsed = agents.parse_arguments(_calls(spark, sf_dir))
    block = F.floor(F.col("step") / 1000).cast("long")
    return agents.consecutive_repeats(parsed, block).select("session_id", "step", "tool_name", "first_argument")


@query(
    "turn_previews",
    """SELECT conv_id, turn, substring(text, 1, 100) AS task_preview, substring(text, 1, 200) AS reasoning_preview, substring(text, 1, 300) AS result_preview FROM conversations""",
)
def turn_previews(spark, sf_dir):
    turns = views.table(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id",
        "turn",
        agents.preview("text", agents.TASK_PREVIEW).alias("task_preview"),
        agents.preview("text", agents.REASONING_PREVIEW).alias("reasoning_preview"),
        agents.preview("text", agents.RESULT_PREVIEW).alias("result_preview"),
    )


@query("token_estimate", f"SELECT doc_id, CAST({WORDS_SQL} AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, sf_dir):
    """Whitespace words of whole texts."""
    return views.table(spark, sf_dir, "documents").select("doc_id", word_count("text").cast("long").alias("tokens"))


@query(
    "context_growth",
    f"""SELECT conv_id, turn, role, tokens, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS context_tokens
FROM (SELECT conv_id, turn, role, CAST({WORDS_SQL} AS BIGINT) AS tokens FROM conversations) t""",
)
def context_growth(spark, sf_dir):
    """Size of the history that each turn sends."""
    return agents.context_growth(views.table(spark, sf_dir, "conversations")).drop("text")


SPAN_COLUMNS = "trace_id, span_id, name, start_us, duration_ms, status"


@query(
    "trace_search",
    f"SELECT {SPAN_COLUMNS} FROM spans WHERE service = 'agentic-pipeline' AND status = 'ERROR' AND duration_ms >= 5000 ORDER BY duration_ms DESC, trace_id, span_id",
)
def trace_search(spark, sf_dir):
    found = traces.search_traces(views.spans(spark, sf_dir), "agentic-pipeline", "ERROR", 5000)
    return found.select(*SPAN_COLUMNS.split(", "))


@query("slowest_traces", f"SELECT {SPAN_COLUMNS} FROM spans WHERE parent_span_id IS NULL ORDER BY duration_ms DESC, trace_id, span_id LIMIT 20")
def slowest_traces(spark, sf_dir):
    roots = views.spans(spark, sf_dir).where(F.col("parent_span_id").isNull())
    return traces.search_traces(roots, n=20).select(*SPAN_COLUMNS.split(", "))


@query(
    "trace_rollup",
    """SELECT trace_id, max(name) FILTER (WHERE parent_span_id IS NULL) AS root, max(duration_ms) FILTER (WHERE parent_span_id IS NULL) AS duration_ms,
  count(*) AS spans, count(*) FILTER (WHERE status = 'ERROR') AS error_spans,
  arg_max(span_id, (duration_ms, span_id)) FILTER (WHERE parent_span_id IS NOT NULL) AS slowest_span,
  arg_min(span_id, (start_us, span_id)) FILTER (WHERE parent_span_id IS NOT NULL AND status = 'ERROR') AS first_failed_span
FROM spans GROUP BY 1""",
)
def trace_rollup(spark, sf_dir):
    return traces.rollup(views.spans(spark, sf_dir))


SELF_TIME = {
    "timed": "SELECT *, start_us + CAST(round(duration_ms * 1000) AS BIGINT) AS end_us FROM spans",
    "children": """
SELECT c.trace_id, c.parent_span_id, greatest(c.start_us, p.start_us) AS f, least(c.end_us, p.end_us) AS t
FROM timed c JOIN timed p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id WHERE least(c.end_us, p.end_us) > greatest(c.start_us, p.start_us)""",
    "uncovered": """
SELECT *, max(t) OVER (PARTITION BY trace_id, parent_span_id ORDER BY f, t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM children""",
    "covered": """
SELECT trace_id, parent_span_id, sum(greatest(t - greatest(f, coalesce(seen, f)), 0)) / 1000 AS covered_ms FROM uncovered GROUP BY 1, 2""",
}


@query(
    "span_self_time",
    """SELECT p.trace_id, p.span_id, p.duration_ms, round(coalesce(c.child_ms, 0), 6) AS child_ms, coalesce(c.children, 0) AS children,
  round(coalesce(u.covered_ms, 0), 6) AS covered_ms, round(greatest(p.duration_ms - coalesce(u.covered_ms, 0), 0), 6) AS self_ms
FROM spans p LEFT JOIN (SELECT trace_id, parent_span_id, sum(duration_ms) AS child_ms, count(*) AS children FROM spans GROUP BY 1, 2) c
  ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id
LEFT JOIN covered u ON u.trace_id = p.trace_id AND u.parent_span_id = p.span_id""",
    SELF_TIME,
)
def span_self_time(spark, sf_dir):
    """Time of a span in which none of its children runs."""
    timed = traces.self_time(views.spans(spark, sf_dir))
    rounded = [F.round(c, 6).alias(c) for c in ("child_ms", "covered_ms", "self_ms")]
    return timed.select("trace_id", "span_id", "duration_ms", "children", *rounded)


@query(
    "span_share_of_parent",
    """SELECT c.trace_id, c.span_id, round(c.duration_ms / nullif(p.duration_ms, 0), 9) AS share FROM spans c JOIN spans p ON c.trace_id = p.trace_id AND c.parent_span_id = p.span_id""",
)
def span_share_of_parent(spark, sf_dir):
    shares = traces.share_of_parent(views.spans(spark, sf_dir))
    return shares.select("trace_id", "span_id", F.round("share", 9).alias("share"))


@query(
    "trace_logs",
    """SELECT s.trace_id, s.span_id, s.request_id, s.status AS span_status, l.level, l.event, l.error FROM spans s JOIN genai_logs l ON s.request_id = l.request_id""",
)
def trace_logs(spark, sf_dir):
    """From a trace to the log lines of its requests."""
    joined = traces.trace_logs(views.spans(spark, sf_dir), views.genai_logs(spark, sf_dir))
    return joined.select("trace_id", "span_id", "request_id", "span_status", "level", "event", "error")
