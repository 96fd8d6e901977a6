"""The derived tables as portable SQL, used as common table expressions by the
SQL twins of the registered queries."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {
    "ev": """
SELECT event_id, ts, epoch_us(ts) AS us, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_iso,
  user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM events""",
    "genai_logs": """
SELECT ts_iso AS timestamp, ts, us, 'genai-pipeline' AS service,
  CASE WHEN event_type <> 'error' THEN 'INFO' WHEN k % 2 = 0 THEN 'WARNING'
       WHEN k % 10 = 9 THEN 'CRITICAL' ELSE 'ERROR' END AS level,
  CASE WHEN event_type <> 'error' THEN 'llm_inference_success'
       WHEN k % 2 = 0 THEN 'llm_rate_limited' ELSE 'llm_api_error' END AS event,
  concat('req-', CAST(event_id AS VARCHAR)) AS request_id,
  CASE k % 3 WHEN 0 THEN 'gemma2-9b-it' WHEN 1 THEN 'llama-3.3-70b-versatile'
       ELSE 'llama-3.1-8b-instant' END AS model,
  CASE WHEN event_type <> 'error' THEN CAST(k * 10 AS BIGINT) END AS input_tokens,
  CASE WHEN event_type <> 'error' THEN CAST(user_id % 400 + 1 AS BIGINT) END AS output_tokens,
  value * 100 AS latency_ms,
  CASE WHEN event_type <> 'error' THEN CASE WHEN k % 7 = 0 THEN 'length' ELSE 'stop' END END AS finish_reason,
  CASE WHEN event_type <> 'error' THEN CAST(k AS DOUBLE) / 100 END AS ctx_utilization,
  CASE WHEN event_type = 'error' AND k % 2 = 1
       THEN CASE WHEN k % 4 = 1 THEN 'APITimeoutError' ELSE 'APIConnectionError' END END AS error_type,
  CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'rate limit reached'
       WHEN k % 4 = 1 THEN concat('request timed out, code ', CAST(k AS VARCHAR))
       ELSE concat('connection reset, code ', CAST(k AS VARCHAR)) END END AS error,
  'production' AS environment
FROM ev""",
    "agent_steps": """
SELECT session_id, agent_name, event_id, ts, us, ts_iso, event_type, k, value,
  CAST(row_number() OVER (PARTITION BY session_id ORDER BY us, event_id) AS INT) AS step,
  CASE event_type WHEN 'click' THEN 'web_search' WHEN 'error' THEN 'web_search'
       WHEN 'view' THEN 'calculator' WHEN 'purchase' THEN 'get_current_metrics' END AS tool_name,
  CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN 'error'
       WHEN k = 13 THEN 'not_found' ELSE 'success' END AS tool_status
FROM (SELECT *, concat('session-', CAST(user_id AS VARCHAR), '-',
               CAST(CAST(floor((day(ts) - 1) / 4) AS INT) AS VARCHAR)) AS session_id,
             CASE WHEN user_id % 2 = 0 THEN 'research-agent' ELSE 'analysis-agent' END AS agent_name
      FROM ev) s""",
    "agent_sessions": """
SELECT session_id, max(agent_name) AS agent_name, max(step) AS steps_taken,
  min(us) AS start_us, max(us) AS end_us,
  CAST(max(us) - min(us) AS DOUBLE) / 1000 AS duration_ms,
  CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) >= 4 THEN 'failed'
       WHEN max(step) >= 10 THEN 'max_steps_reached' ELSE 'completed' END AS status,
  max(ts_iso) AS end_iso, max(ts) AS end_ts
FROM agent_steps GROUP BY session_id""",
    "agent_logs": """
SELECT ts_iso AS timestamp, ts, us, 'agentic-pipeline' AS service,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  CASE WHEN event_type = 'signup' THEN 'agent_final_answer'
       WHEN event_type = 'error' THEN 'agent_tool_error' ELSE 'agent_tool_call' END AS event,
  session_id, CAST(NULL AS VARCHAR) AS agent_name, step, tool_name,
  CAST(NULL AS INT) AS steps_taken, CAST(NULL AS DOUBLE) AS duration_ms,
  CAST(NULL AS VARCHAR) AS status,
  CASE WHEN event_type = 'error' THEN 'Search service timeout' END AS error,
  'production' AS environment
FROM agent_steps
UNION ALL
SELECT end_iso, end_ts, end_us, 'agentic-pipeline',
  CASE WHEN status = 'failed' THEN 'ERROR' WHEN status = 'max_steps_reached' THEN 'WARNING' ELSE 'INFO' END,
  'agent_session_completed', session_id, agent_name, NULL, NULL, steps_taken,
  duration_ms, status, NULL, 'production'
FROM agent_sessions""",
    "ml_logs": """
SELECT ts_iso AS timestamp, ts, us, 'ml-pipeline' AS service,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  CASE WHEN event_type = 'error' THEN 'ml_inference_error' ELSE 'ml_inference_success' END AS event,
  concat('tx-', CAST(event_id AS VARCHAR)) AS transaction_id,
  k > 50 AS is_fraud, CAST(k AS DOUBLE) / 100 AS fraud_probability,
  CASE WHEN k >= 50 THEN CAST(k AS DOUBLE) / 100 ELSE CAST(100 - k AS DOUBLE) / 100 END AS confidence,
  value AS latency_ms,
  CASE WHEN user_id % 2 = 0 THEN 'v2.1.0' ELSE 'v2.0.0' END AS model_version,
  CASE WHEN event_type = 'error' THEN 'inference error' END AS error
FROM ev""",
    "ml_features": """
SELECT event_id, user_id, ts, us, concat('tx-', CAST(event_id AS VARCHAR)) AS transaction_id,
  value * 10 AS transaction_amount, CAST(hour(ts) AS INT) AS hour_of_day,
  CAST((CAST(floor(us / 86400000000) AS BIGINT) + 3) % 7 AS INT) AS day_of_week,
  k % 20 AS merchant_category, CAST(user_id * 7 % 3650 AS INT) AS user_age_days,
  CAST(count(*) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS INT) AS tx_count_24h,
  (value - avg(value) OVER (PARTITION BY user_id)) / stddev_samp(value) OVER (PARTITION BY user_id) AS amount_deviation,
  k < 15 AS is_international, CAST(100 - k AS DOUBLE) / 100 AS device_trust_score
FROM ev""",
    "kafka_consumer_offsets": """
SELECT ts_iso AS timestamp, ts, us, 'logstash_consumer' AS consumer_group, topic, part,
  end_off - CAST(k * 200 AS BIGINT) AS current_offset, end_off AS log_end_offset,
  CAST(k * 200 AS BIGINT) AS lag
FROM (SELECT *, 100000 + row_number() OVER (PARTITION BY topic, part ORDER BY us, event_id) AS end_off
      FROM (SELECT *, CASE WHEN event_type IN ('click', 'view') THEN 'genai-events'
                           WHEN event_type = 'purchase' THEN 'agent-events' ELSE 'pipeline-logs' END AS topic,
                   CAST(user_id % 3 AS INT) AS part FROM ev) a) b""",
    "metric_samples": """
SELECT 'genai_requests_total' AS metric, 'genai-pipeline' AS service, model, status, epoch, hr_us AS us,
  CAST(sum(n) OVER (PARTITION BY model, status, epoch ORDER BY hr_us
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value
FROM (SELECT model,
        CASE event WHEN 'llm_inference_success' THEN 'success'
                   WHEN 'llm_rate_limited' THEN 'rate_limited' ELSE 'error' END AS status,
        CAST(floor((day(ts) - 1) / 5) AS INT) AS epoch,
        (CAST(floor(us / 3600000000) AS BIGINT) + 1) * 3600000000 AS hr_us, count(*) AS n
      FROM genai_logs GROUP BY 1, 2, 3, 4) g""",
    "spans": """
SELECT session_id AS trace_id, concat(session_id, '/', CAST(step AS VARCHAR)) AS span_id,
  concat(session_id, '/0') AS parent_span_id, 'agentic-pipeline' AS service,
  concat('agent_step_', CAST(step AS VARCHAR)) AS name, us AS start_us, value * 100 AS duration_ms,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'OK' END AS status, tool_name,
  concat('req-', CAST(event_id AS VARCHAR)) AS request_id
FROM agent_steps
UNION ALL
SELECT session_id, concat(session_id, '/0'), NULL, 'agentic-pipeline', 'agent_session',
  start_us, duration_ms, CASE WHEN status = 'failed' THEN 'ERROR' ELSE 'OK' END, NULL, NULL
FROM agent_sessions""",
}



def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the views it uses (and the views these use)."""
    extra = extra or {}
    known = {**VIEWS, **extra}
    order: list[str] = []

    def visit(text: str, seen: tuple[str, ...] = ()) -> None:
        for name, body in known.items():
            if name not in order and name not in seen and re.search(rf"\b{name}\b", text):
                visit(body, (*seen, name))
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{n} AS ({known[n].strip()})" for n in order)
    body = sql.strip()
    if re.match(r"(?i)with\b", body):
        return f"WITH {ctes},\n{body[4:].strip()}"
    return f"WITH {ctes}\n{body}"
