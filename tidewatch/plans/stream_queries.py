"""Registered streaming queries.

Each runs a file stream over the events to its end and reads back the table the
stream wrote. Open windows are withheld by the watermark, in the SQL twins too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scan import HOUR, MICROS
from tidewatch.plans import views
from tidewatch.plans.registry import query
from tidewatch.session import fresh_path
from tidewatch.streaming import jobs, states

DONE = "(SELECT max(ts) - INTERVAL 10 MINUTE FROM ev)"


def events(spark, sf_dir) -> DataFrame:
    """The events file as a stream, with a zoned event time."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    raw = jobs.event_stream(spark, sf_dir, schema, glob="events.parquet")
    return views.derive_ev(raw).withColumn("ts", F.col("ts").cast("timestamp"))


def _finished(spark, stream: DataFrame, name: str) -> DataFrame:
    path = fresh_path(spark, name)
    jobs.run_now(stream, f"{path}/table", f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/table").drop("batch")


@query(
    "stream_live_counts",
    f"""SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, service, count(*) AS requests,
  count(*) FILTER (WHERE level IN ('ERROR', 'CRITICAL')) AS errors, count(*) FILTER (WHERE event = 'llm_rate_limited') AS rate_limited,
  CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens
FROM genai_logs GROUP BY 1, 2, 3 HAVING date_trunc('hour', max(ts)) + INTERVAL 1 HOUR <= {DONE}""",
)
def stream_live_counts(spark, sf_dir):
    logs = views.derive_genai_logs(events(spark, sf_dir))
    return _finished(spark, jobs.live_counts(logs, "1 hour"), "live-counts")


@query(
    "stream_sliding_rates",
    f"""SELECT w AS eval_ts, event_type, count(*) AS n, round(count(*) / 21600.0::DOUBLE, 9) AS value FROM (
  SELECT event_type, date_trunc('hour', ts) + unnest([1, 2, 3, 4, 5, 6]) * INTERVAL 1 HOUR AS w FROM ev) x
WHERE w <= {DONE} GROUP BY 1, 2""",
)
def stream_sliding_rates(spark, sf_dir):
    rates = jobs.sliding_rates(events(spark, sf_dir), ["event_type"], "6 hours", "1 hour", 21600.0)
    return _finished(spark, rates, "sliding-rates").withColumn("value", F.round("value", 9))


@query(
    "stream_gap_sessions",
    f"""WITH s AS (SELECT concat('user-', user_id) AS session_id, CASE WHEN user_id % 2 = 0 THEN 'research-agent' ELSE 'analysis-agent' END AS agent_name, event_type, ts FROM ev),
o AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM s WINDOW w AS (PARTITION BY session_id ORDER BY ts)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY ts) AS i FROM o)
SELECT session_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS closed_at, max(agent_name) AS agent_name, count(*) AS steps_taken,
  count(*) FILTER (WHERE event_type = 'error') AS errors FROM n GROUP BY session_id, i HAVING max(ts) + INTERVAL 6 HOUR <= {DONE}""",
)
def stream_gap_sessions(spark, sf_dir):
    """Sessions that only a quiet gap closes."""
    steps = events(spark, sf_dir).withColumns(
        {
            "session_id": F.concat(F.lit("user-"), F.col("user_id").cast("string")),
            "agent_name": F.when(F.col("user_id") % 2 == 0, "research-agent").otherwise("analysis-agent"),
        }
    )
    return _finished(spark, jobs.agent_sessions(steps, "6 hours"), "gap-sessions")


SESSION_GAP = 6 * HOUR


@query(
    "stream_agent_sessions",
    f"""WITH mark AS (SELECT epoch_us(max(ts)) // 1000 * 1000 - {600 * MICROS} AS passed FROM ev),
s AS (SELECT concat('user-', user_id) AS session_id, CASE WHEN user_id % 2 = 0 THEN 'research-agent' ELSE 'analysis-agent' END AS agent_name, event_type, us, event_id,
  event_type = 'signup' AND k >= 50 AS completes FROM ev, mark WHERE us < passed),
o AS (SELECT *, CASE WHEN us - lag(us) OVER w <= {SESSION_GAP} AND NOT lag(completes) OVER w THEN 0 ELSE 1 END AS opens FROM s WINDOW w AS (PARTITION BY session_id ORDER BY us, event_id)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY session_id ORDER BY us, event_id) AS i FROM o),
c AS (SELECT session_id, min(us) AS session_start_us, bool_or(completes) AS ended, max(us) AS last_us, max(agent_name) AS agent_name, count(*) FILTER (WHERE NOT completes) AS steps_taken,
  count(*) FILTER (WHERE event_type = 'error') AS errors FROM n GROUP BY session_id, i)
SELECT session_id, session_start_us, CASE WHEN ended THEN last_us ELSE last_us + {SESSION_GAP} END AS closed_us, CASE WHEN ended THEN 'completed' ELSE 'gap' END AS ended_by,
  agent_name, steps_taken, errors FROM c, mark WHERE ended OR last_us + {SESSION_GAP} < passed OR EXISTS (SELECT 1 FROM c AS d WHERE d.session_id = c.session_id AND d.session_start_us > c.last_us)""",
)
def stream_agent_sessions(spark, sf_dir):
    """Sessions closed by their completion event or, without one, by a quiet gap."""
    kind = F.col("event_type")
    steps = events(spark, sf_dir).select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("session_id"),
        F.when(F.col("user_id") % 2 == 0, "research-agent").otherwise("analysis-agent").alias("agent_name"),
        "us", F.col("event_id").alias("row_id"), (kind == "error").alias("failed"), ((kind == "signup") & (F.col("k") >= 50)).alias("completes"), "ts",
    )
    return _finished(spark, states.closed_sessions(steps.withWatermark("ts", jobs.LATENESS), SESSION_GAP), "sessions")


@query("stream_deduplicated", "SELECT event_id, event_type, value FROM ev")
def stream_deduplicated(spark, sf_dir):
    """Every event delivered twice, kept once."""
    twice = events(spark, sf_dir).unionByName(events(spark, sf_dir))
    once = jobs.deduplicated(twice, ["event_id"]).select("event_id", "event_type", "value")
    return _finished(spark, once, "deduplicated")


@query(
    "stream_index",
    """SELECT 'logs' AS target, CAST(ts AS DATE) AS log_date, count(*) AS documents FROM genai_logs GROUP BY 2
UNION ALL SELECT 'errors', CAST(ts AS DATE), count(*) FROM genai_logs WHERE level IN ('ERROR', 'CRITICAL') GROUP BY 2""",
)
def stream_index(spark, sf_dir):
    """Continuous enrichment into the daily log and error tables."""
    logs = views.derive_genai_logs(events(spark, sf_dir)).drop("ts", "us")
    root = fresh_path(spark, "index")
    jobs.index_logs(logs, root, f"{root}/checkpoint", availableNow=True).awaitTermination()
    counts = [
        jobs.read_index(spark, root, name, "event STRING")
        .groupBy(F.lit(name).alias("target"), "log_date").agg(F.count(F.lit(1)).alias("documents"))
        for name in ("logs", "errors")
    ]
    return counts[0].unionByName(counts[1])


FLUSH_EVERY = 120 * HOUR


@query(
    "stream_export_flushes",
    f"""WITH mark AS (SELECT epoch_us(max(ts)) // 1000 * 1000 - {600 * MICROS} AS passed FROM ev),
r AS (SELECT event_type AS source, user_id % 2 AS shard, us // {FLUSH_EVERY} AS tick, us, event_id,
  (row_number() OVER (PARTITION BY event_type, user_id % 2, us // {FLUSH_EVERY} ORDER BY us, event_id) - 1) // {jobs.FLUSH_FILES} AS part FROM ev, mark WHERE us < passed),
c AS (SELECT source, shard, tick, part, count(*) AS n, min(us) AS first_us, max(us) AS last_us,
  string_agg(concat('{{"event_id":', event_id, '}}'), chr(10) ORDER BY us, event_id) AS body FROM r GROUP BY 1, 2, 3, 4)
SELECT source, shard, tick, part, CASE WHEN n = {jobs.FLUSH_FILES} THEN 'size' ELSE 'time' END AS reason,
  CASE WHEN n = {jobs.FLUSH_FILES} THEN last_us ELSE (tick + 1) * {FLUSH_EVERY} END AS flushed_us, n, first_us, last_us, body
FROM c, mark WHERE n = {jobs.FLUSH_FILES} OR (tick + 1) * {FLUSH_EVERY} <= passed""",
)
def stream_export_flushes(spark, sf_dir):
    """Export buffers flushed by their size, or by time."""
    lines = events(spark, sf_dir).select(
        F.col("event_type").alias("source"), (F.col("user_id") % 2).cast("long").alias("shard"), "us", F.col("event_id").alias("row_id"),
        F.to_json(F.struct("event_id")).alias("line"), "ts",
    )
    root = fresh_path(spark, "flushes")
    jobs.flush_lines(lines, root, f"{root}/checkpoint", jobs.FLUSH_FILES, FLUSH_EVERY, availableNow=True).awaitTermination()
    return jobs.read_flushes(spark, root)


HOLD = 2 * HOUR


@query(
    "stream_alert_states",
    f"""WITH every_e AS (SELECT event_type AS alertname, (CAST(floor(us / {HOUR}) AS BIGINT) + 1) * {HOUR} AS eval_us, avg(value) > 40 AS hit FROM ev GROUP BY 1, 2),
mark AS (SELECT max(eval_us) - {600 * MICROS} AS passed FROM every_e), e AS (SELECT every_e.* FROM every_e, mark WHERE eval_us < passed),
seen AS (SELECT alertname, max(eval_us) AS last_us FROM e GROUP BY 1),
o AS (SELECT *, CASE WHEN eval_us - lag(eval_us) OVER w <= {HOUR} THEN 0 ELSE 1 END AS opens FROM e WHERE hit WINDOW w AS (PARTITION BY alertname ORDER BY eval_us)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY alertname ORDER BY eval_us) AS i FROM o),
r AS (SELECT alertname, min(eval_us) AS a, max(eval_us) AS z FROM n GROUP BY alertname, i)
SELECT alertname, 'pending' AS state, a AS at_us, a AS active_us FROM r
UNION ALL SELECT alertname, 'firing', a + {HOLD}, a FROM r WHERE z - a >= {HOLD}
UNION ALL SELECT alertname, 'resolved', z + {HOUR}, a FROM r JOIN seen USING (alertname) WHERE z - a >= {HOLD}
  AND (z < last_us OR z + {HOUR} < (SELECT passed FROM mark))""",
)
def stream_alert_states(spark, sf_dir):
    """The pending, firing and resolved states of hourly conditions."""
    hourly = views.ev(spark, sf_dir).groupBy(
        F.col("event_type").alias("alertname"), ((F.floor(F.col("us") / HOUR) + 1) * HOUR).alias("eval_us")
    ).agg((F.avg("value") > 40).alias("active"), F.avg("value").alias("value"))
    evaluations = hourly.select(
        "alertname", F.lit("all").alias("series"), "eval_us", "active", "value", F.lit(HOUR).alias("every_us"), F.lit(HOLD).alias("hold_us"),
        F.timestamp_micros("eval_us").alias("eval_ts"),
    )
    path = fresh_path(spark, "evaluations")
    evaluations.write.parquet(path)
    stream = jobs.event_stream(spark, path, evaluations.schema).withWatermark("eval_ts", jobs.LATENESS)
    done = _finished(spark, states.alert_transitions(stream), "alert-states")
    return done.select("alertname", "state", "at_us", "active_us")
