"""Declared schemas of the log tables, events, samples and spans."""

from __future__ import annotations

# Column names and types of the external tables, in their order.
GENAI_LOGS = (
    "timestamp STRING, service STRING, level STRING, event STRING, request_id STRING, model STRING, "
    "input_tokens BIGINT, output_tokens BIGINT, latency_ms DOUBLE, finish_reason STRING, ctx_utilization DOUBLE, "
    "error_type STRING, error STRING, environment STRING"
)
AGENT_LOGS = (
    "timestamp STRING, service STRING, level STRING, event STRING, session_id STRING, agent_name STRING, step INT, "
    "tool_name STRING, steps_taken INT, duration_ms DOUBLE, status STRING, error STRING, environment STRING"
)
ML_LOGS = (
    "timestamp STRING, service STRING, level STRING, event STRING, transaction_id STRING, is_fraud BOOLEAN, "
    "fraud_probability DOUBLE, confidence DOUBLE, latency_ms DOUBLE, model_version STRING, error STRING"
)
ML_PARTITIONS = ["year", "month", "day"]
KAFKA_CONSUMER_OFFSETS = (
    "timestamp STRING, consumer_group STRING, topic STRING, partition INT, current_offset BIGINT, "
    "log_end_offset BIGINT, lag BIGINT"
)
LOG_SCHEMAS = {
    "genai_logs": GENAI_LOGS,
    "agent_logs": AGENT_LOGS,
    "ml_logs": ML_LOGS,
    "kafka_consumer_offsets": KAFKA_CONSUMER_OFFSETS,
}
TOPICS = ["pipeline-logs", "genai-events", "ml-events", "agent-events"]
# All fields that any of the topics may carry; absent ones read as NULL.
STREAM_EVENT = (
    "event_type STRING, request_id STRING, model STRING, input_tokens BIGINT, output_tokens BIGINT, latency_ms DOUBLE, "
    "session_id STRING, agent_name STRING, steps_taken INT, duration_ms DOUBLE, status STRING, timestamp STRING, "
    "service STRING, level STRING, event STRING, pipeline_type STRING, error_type STRING, error STRING, environment STRING, "
    "agent_steps INT, prediction_confidence DOUBLE, confidence DOUBLE, transaction_id STRING, client_ip STRING"
)
METRIC_SAMPLES = "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, le DOUBLE, value DOUBLE"
SPANS = (
    "trace_id STRING, span_id STRING, parent_span_id STRING, service STRING, name STRING, start_ts TIMESTAMP, "
    "duration_ms DOUBLE, status STRING, attributes MAP<STRING,STRING>"
)
STEP_TRACE = (
    "ARRAY<STRUCT<step: INT, reasoning: STRING, tool_name: STRING, tool_input: MAP<STRING,STRING>, "
    "tool_result: STRING, duration_ms: DOUBLE>>"
)
