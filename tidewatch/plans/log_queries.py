"""Registered enrichment, search, relabelling and log-scan queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.labels import render
from tidewatch.functions.scan import DAY
from tidewatch.operators import enrich as en
from tidewatch.operators import relabel, search
from tidewatch.plans import views
from tidewatch.plans.registry import query
from tidewatch.session import fresh_path
from tidewatch.sources import logs as scans


def service_logs(spark, sf_dir) -> DataFrame:
    """All three log sources in one wide table."""
    out = views.genai_logs(spark, sf_dir)
    for other in (views.agent_logs(spark, sf_dir), views.ml_logs(spark, sf_dir)):
        out = out.unionByName(other, allowMissingColumns=True)
    return out


WIDE = {
    "service_logs": """
SELECT timestamp, ts, service, level, event, request_id AS entity, model, latency_ms AS duration, NULL::INT AS steps, NULL::DOUBLE AS confidence FROM genai_logs
UNION ALL SELECT timestamp, ts, service, level, event, session_id, NULL, duration_ms, steps_taken, NULL FROM agent_logs
UNION ALL SELECT timestamp, ts, service, level, event, transaction_id, NULL, latency_ms, NULL, confidence FROM ml_logs""",
    "enriched": """
SELECT *, service = 'genai-pipeline' AND coalesce(duration > 5000, false) AS slow,
  service = 'genai-pipeline' AND event = 'llm_rate_limited' AS limited,
  service = 'agentic-pipeline' AND coalesce(steps > 20, false) AS looping,
  service = 'ml-pipeline' AND coalesce(confidence < 0.6, false) AS unsure,
  level IN ('ERROR', 'CRITICAL') AS is_error
FROM service_logs""",
}


@query(
    "enriched_logs",
    """SELECT entity, event, ts AS event_time, concat_ws(',', CASE service WHEN 'genai-pipeline' THEN 'genai,llm' WHEN 'agentic-pipeline' THEN 'agentic,llm' ELSE 'ml,inference' END,
  CASE WHEN slow THEN 'slow_llm_call' END, CASE WHEN limited THEN 'rate_limited' END,
  CASE WHEN looping THEN 'agent_loop_suspected' END, CASE WHEN unsure THEN 'low_confidence' END) AS tags,
  CASE WHEN service = 'genai-pipeline' THEN model END AS llm_model,
  CASE WHEN slow THEN 'high_latency' WHEN looping THEN 'too_many_steps' WHEN unsure THEN 'low_model_confidence' END AS anomaly,
  is_error, 'production' AS environment, 'ai-pipelines' AS cluster FROM enriched""",
    WIDE,
)
def enriched_logs(spark, sf_dir):
    return en.enrich(service_logs(spark, sf_dir)).select(
        F.coalesce("request_id", "session_id", "transaction_id").alias("entity"),
        "event",
        "event_time",
        F.array_join("tags", ",").alias("tags"),
        "llm_model",
        "anomaly",
        "is_error",
        "environment",
        "cluster",
    )


@query(
    "enriched_counts",
    """SELECT service, tag, count(*) AS events FROM (
  SELECT service, unnest(string_split(concat_ws(',', CASE service WHEN 'genai-pipeline' THEN 'genai,llm' WHEN 'agentic-pipeline' THEN 'agentic,llm' ELSE 'ml,inference' END,
    CASE WHEN slow THEN 'slow_llm_call' END, CASE WHEN limited THEN 'rate_limited' END,
    CASE WHEN looping THEN 'agent_loop_suspected' END, CASE WHEN unsure THEN 'low_confidence' END), ',')) AS tag FROM enriched) t
GROUP BY 1, 2""",
    WIDE,
)
def enriched_counts(spark, sf_dir):
    tagged = en.enrich(service_logs(spark, sf_dir)).select("service", F.explode("tags").alias("tag"))
    return tagged.groupBy("service", "tag").agg(F.count(F.lit(1)).alias("events"))


@query(
    "anomaly_counts",
    """SELECT CAST(ts AS DATE) AS log_date, service, CASE WHEN slow THEN 'high_latency' WHEN looping THEN 'too_many_steps' ELSE 'low_model_confidence' END AS anomaly,
  count(*) AS events FROM enriched WHERE slow OR looping OR unsure GROUP BY 1, 2, 3""",
    WIDE,
)
def anomaly_counts(spark, sf_dir):
    found = en.enrich(service_logs(spark, sf_dir)).where(F.col("anomaly").isNotNull())
    return found.groupBy(F.to_date("event_time").alias("log_date"), "service", "anomaly").agg(F.count(F.lit(1)).alias("events"))


@query(
    "index_routing",
    """SELECT 'index' AS kind, "index", count(*) AS documents FROM (
  SELECT 'pipeline-logs-' || strftime(ts, '%Y.%m.%d') AS "index" FROM enriched
  UNION ALL SELECT 'pipeline-errors-' || strftime(ts, '%Y.%m.%d') FROM enriched WHERE is_error) i GROUP BY 2""",
    WIDE,
)
def index_routing(spark, sf_dir):
    routed = en.route_to_indices(en.enrich(service_logs(spark, sf_dir)))
    return routed.groupBy(F.lit("index").alias("kind"), "index").agg(F.count(F.lit(1)).alias("documents"))


IP_SQL = {
    "hits": """
SELECT event_id, concat_ws('.', '10', CAST(user_id * 37 % 256 AS VARCHAR), CAST(k AS VARCHAR), CAST(user_id % 256 AS VARCHAR)) AS client_ip,
  10 * 16777216 + (user_id * 37 % 256) * 65536 + k * 256 + user_id % 256 AS ip FROM ev""",
    "ranges": """
SELECT n_name AS country, r_name AS continent, 10 * 16777216 + n_nationkey * 10 * 65536 AS start_ip,
  10 * 16777216 + (n_nationkey + 1) * 10 * 65536 - 1 AS end_ip FROM nation JOIN region ON n_regionkey = r_regionkey""",
}


@query(
    "ip_regions",
    """SELECT event_id, client_ip, country, continent FROM hits LEFT JOIN ranges ON ip BETWEEN start_ip AND end_ip""",
    IP_SQL,
)
def ip_regions(spark, sf_dir):
    user = F.col("user_id")
    hits = views.ev(spark, sf_dir).select(
        "event_id",
        F.concat_ws(".", F.lit("10"), (user * 37 % 256).cast("string"), F.col("k").cast("string"), (user % 256).cast("string")).alias("client_ip"),
    )
    nation, region = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region")
    base = F.lit(10 * 16777216) + F.col("n_nationkey") * 10 * 65536
    ranges = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        base.alias("start_ip"), (base + 10 * 65536 - 1).alias("end_ip"), F.col("n_name").alias("country"), F.col("r_name").alias("continent")
    )
    return en.locate_ips(hits, ranges).select("event_id", "client_ip", "geoip.country", "geoip.continent")


# Third group of a v6 address or second octet of a v4 address, and the networks as stretches of them.
NETWORK_SQL = {
    "mixed_hits": """
SELECT event_id, CASE user_id % 3 WHEN 1 THEN concat('2001:DB8:', to_hex(user_id * 37 % 65536), '::', to_hex(k + 1))
    ELSE concat(CASE user_id % 3 WHEN 2 THEN '::ffff:' ELSE '' END, '10.', user_id * 37 % 256, '.', k, '.', user_id % 256) END AS client_ip,
  CASE user_id % 3 WHEN 1 THEN 6 ELSE 4 END AS family, CASE user_id % 3 WHEN 1 THEN user_id * 37 % 65536 ELSE user_id * 37 % 256 END AS place FROM ev""",
    "networks": """
SELECT 6 AS family, 37 AS bits, n_nationkey * 2048 AS low, n_nationkey * 2048 + 2047 AS high, n_name AS area FROM nation
UNION ALL SELECT 6, 42, n_nationkey * 2048, n_nationkey * 2048 + 63, n_name || ' inner' FROM nation
UNION ALL SELECT 4, 13, n_nationkey * 8, n_nationkey * 8 + 7, n_name FROM nation UNION ALL SELECT 4, 16, n_nationkey * 8, n_nationkey * 8, n_name || ' inner' FROM nation
UNION ALL SELECT 4, 8, 0, 255, r_name FROM region WHERE r_regionkey = 0""",
}


@query(
    "ip_networks",
    """SELECT event_id, any_value(client_ip) AS client_ip, arg_max(area, bits) AS area FROM mixed_hits h
LEFT JOIN networks n ON h.family = n.family AND place BETWEEN low AND high GROUP BY event_id""",
    NETWORK_SQL,
)
def ip_networks(spark, sf_dir):
    """Longest match of v4, v6 and mapped addresses in nested networks."""
    user, text = F.col("user_id"), lambda c: c.cast("string")
    dotted = F.concat_ws(".", F.lit("10"), text(user * 37 % 256), text(F.col("k")), text(user % 256))
    v6 = F.concat(F.lit("2001:DB8:"), F.hex(user * 37 % 65536), F.lit("::"), F.hex(F.col("k") + 1))
    address = F.when(user % 3 == 1, v6).when(user % 3 == 2, F.concat(F.lit("::ffff:"), dotted)).otherwise(dotted)
    nation, region = views.table(spark, sf_dir, "nation"), views.table(spark, sf_dir, "region")
    n, name = F.col("n_nationkey"), F.col("n_name")
    third, second = F.hex(n * 2048), text(n * 8)
    net = lambda head, place, tail, area: F.struct(F.concat(F.lit(head), place, F.lit(tail)).alias("network"), area.alias("area"))
    inner = F.concat(name, F.lit(" inner"))
    nets = nation.select(F.inline(F.array(
        net("2001:db8:", third, "::/37", name), net("2001:db8:", third, "::/42", inner), net("10.", second, ".0.0/13", name), net("10.", second, ".0.0/16", inner),
    ))).unionByName(region.where("r_regionkey = 0").select(F.lit("10.0.0.0/8").alias("network"), F.col("r_name").alias("area")))
    hits = views.ev(spark, sf_dir).select("event_id", address.alias("client_ip"))
    return en.locate_networks(hits, nets).select("event_id", "client_ip", "geoip.area")


def _search(name, where, view="genai_logs", source=None, **predicates):
    columns = {
        "genai_logs": ["ts", "service", "level", "event", "request_id", "latency_ms", "error"],
        "agent_logs": ["ts", "service", "level", "event", "session_id", "steps_taken", "status"],
    }[view]

    @query(f"log_search_{name}", f"SELECT {', '.join(columns)} FROM {view} WHERE {where}")
    def run(spark, sf_dir):
        return search.search_logs(getattr(views, view)(spark, sf_dir), **predicates).select(*columns)

    return run


_search("errors", "level = 'ERROR'", level="ERROR")
_search("service_errors", "service = 'genai-pipeline' AND level = 'ERROR'", service="genai-pipeline", level="ERROR")
_search("rate_limited", "event = 'llm_rate_limited'", event="llm_rate_limited")
_search("slow", "latency_ms > 5000", min_latency_ms=5000)
_search("looped", "status = 'max_steps_reached'", view="agent_logs", status="max_steps_reached")
_search("request", "request_id = 'req-100'", request_id="req-100")
_search(
    "recent_errors",
    "level = 'ERROR' AND ts > TIMESTAMP '2024-01-15 15:00:00' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '2024-01-15 15:00:00'",
    level="ERROR",
    now="2024-01-15 15:00:00",
    within="1 hour",
    end="2024-01-15 15:00:00",
)


def _band_sql() -> str:
    cases = []
    for name, healthy, critical in search.HEALTH_BANDS:
        if healthy > critical:
            good, bad = f"value > {healthy}", f"value < {critical}"
        else:
            good, bad = f"value {'<=' if name in search.CLOSED_BANDS else '<'} {healthy}", f"value > {critical}"
        cases.append(f"WHEN '{name}' THEN CASE WHEN {good} THEN 'Healthy' WHEN {bad} THEN 'Critical' ELSE 'Warning' END")
    return "CASE metric " + "\n  ".join(cases) + " END"


BASELINE_DAYS = 7
HEALTH = {
    "calls": """
SELECT CAST(ts AS DATE) AS log_date, model AS scope, 100.0::DOUBLE * count(*) FILTER (WHERE level IN ('ERROR', 'CRITICAL')) / count(*) AS error_rate_pct,
  quantile_cont(latency_ms, 0.99) / 1000 AS p99_latency_s, count(*) FILTER (WHERE event = 'llm_rate_limited') / 86400.0::DOUBLE AS rate_limit_per_s,
  100.0::DOUBLE * max(ctx_utilization) AS context_window_pct FROM genai_logs GROUP BY 1, 2""",
    "moves": """
SELECT service, request_id AS id, us - CAST(floor(latency_ms * 1000) AS BIGINT) AS us, 1 AS delta FROM genai_logs UNION ALL SELECT service, request_id, us, -1 FROM genai_logs""",
    "depths": "SELECT service, us, sum(delta) OVER (PARTITION BY service ORDER BY us, delta, id ROWS UNBOUNDED PRECEDING) AS depth FROM moves",
    "hourly": """
SELECT model, CAST(floor(us / 86400000000) AS BIGINT) AS day, hour(ts) AS slot, CAST(sum(output_tokens) AS DOUBLE) AS tokens FROM genai_logs
WHERE event = 'llm_inference_success' GROUP BY ALL""",
    "compared": f"""
SELECT model, day, tokens / median(tokens) OVER (PARTITION BY model, slot ORDER BY day RANGE BETWEEN {BASELINE_DAYS} PRECEDING AND 1 PRECEDING) AS times FROM hourly""",
    "bands": """
SELECT log_date, scope, 'error_rate_pct' AS metric, error_rate_pct AS value FROM calls
UNION ALL SELECT log_date, scope, 'p99_latency_s', p99_latency_s FROM calls
UNION ALL SELECT log_date, scope, 'rate_limit_per_s', rate_limit_per_s FROM calls
UNION ALL SELECT log_date, scope, 'context_window_pct', context_window_pct FROM calls
UNION ALL SELECT CAST(make_timestamp(us) AS DATE), service, 'queue_depth', CAST(max(depth) AS DOUBLE) FROM depths GROUP BY 1, 2
UNION ALL SELECT CAST(make_timestamp(day * 86400000000) AS DATE), model, 'token_rate_x_baseline', max(times) FROM compared GROUP BY 1, 2
UNION ALL SELECT CAST(end_ts AS DATE), agent_name, 'session_success_pct', 100.0::DOUBLE * count(*) FILTER (WHERE status = 'completed') / count(*) FROM agent_sessions GROUP BY 1, 2
UNION ALL SELECT CAST(end_ts AS DATE), agent_name, 'agent_loops_per_min', count(*) FILTER (WHERE status = 'max_steps_reached') / 1440.0::DOUBLE FROM agent_sessions GROUP BY 1, 2
UNION ALL SELECT CAST(ts AS DATE), tool_name, 'tool_failure_pct', 100.0::DOUBLE * count(*) FILTER (WHERE tool_status = 'error') / count(*) FROM agent_steps WHERE tool_name IS NOT NULL GROUP BY 1, 2""",
}


@query("health_bands", f"SELECT log_date, scope, metric, round(value, 6) AS value, {_band_sql()} AS band FROM bands WHERE value IS NOT NULL", HEALTH)
def health_bands(spark, sf_dir):
    """All nine health values per day and model, service, agent or tool, with their bands."""
    from tidewatch.functions.quantiles import exact_percentiles
    from tidewatch.operators.metrics import queue_depth
    from tidewatch.operators.timeseries import seasonal_baseline

    n = F.count(F.lit(1))
    share = lambda condition: F.lit(100.0) * F.count_if(condition) / n
    logs = views.genai_logs(spark, sf_dir).withColumn("log_date", F.to_date("ts"))
    keys = ["log_date", "scope"]
    calls = logs.withColumn("scope", F.col("model"))
    wide = calls.groupBy(*keys).agg(
        share(F.col("level").isin("ERROR", "CRITICAL")).alias("error_rate_pct"),
        (F.count_if(F.col("event") == "llm_rate_limited") / F.lit(86400.0)).alias("rate_limit_per_s"),
        (F.lit(100.0) * F.max("ctx_utilization")).alias("context_window_pct"),
    )
    tail = exact_percentiles(calls, keys, "latency_ms", {"p99": 0.99}).withColumn("p99_latency_s", F.col("p99") / 1000).drop("p99")
    long = lambda df, *names: df.unpivot(keys, list(names), "metric", "value")
    parts = [long(wide, "error_rate_pct", "rate_limit_per_s", "context_window_pct"), long(tail, "p99_latency_s")]
    work = logs.select("service", "request_id", (F.col("us") - F.floor(F.col("latency_ms") * 1000).cast("long")).alias("start_us"), F.col("us").alias("end_us"))
    depths = queue_depth(work, ["service"], "start_us", "end_us", ["request_id"])
    day_of = lambda us: F.timestamp_micros(us).cast("date")
    parts.append(long(depths.groupBy(day_of(F.col("us")).alias("log_date"), F.col("service").alias("scope")).agg(F.max("depth").cast("double").alias("queue_depth")), "queue_depth"))
    hours = logs.where(F.col("event") == "llm_inference_success").groupBy("model", F.floor(F.col("us") / DAY).alias("day"), F.hour("ts").alias("slot"))
    rated = seasonal_baseline(hours.agg(F.sum("output_tokens").cast("double").alias("tokens")), ["model"], "day", "slot", "tokens", BASELINE_DAYS)
    times = rated.withColumn("times", F.col("tokens") / F.nullif(F.col("baseline"), F.lit(0.0)))
    spread = times.groupBy(day_of(F.col("day") * DAY).alias("log_date"), F.col("model").alias("scope")).agg(F.max("times").alias("token_rate_x_baseline"))
    parts.append(long(spread, "token_rate_x_baseline"))
    sessions = views.agent_sessions(spark, sf_dir).groupBy(F.to_date("end_ts").alias("log_date"), F.col("agent_name").alias("scope")).agg(
        share(F.col("status") == "completed").alias("session_success_pct"),
        (F.count_if(F.col("status") == "max_steps_reached") / F.lit(1440.0)).alias("agent_loops_per_min"),
    )
    parts.append(long(sessions, "session_success_pct", "agent_loops_per_min"))
    tools = views.agent_events(spark, sf_dir).where(F.col("tool_name").isNotNull()).groupBy(F.to_date("ts").alias("log_date"), F.col("tool_name").alias("scope"))
    parts.append(long(tools.agg(share(F.col("tool_status") == "error").alias("tool_failure_pct")), "tool_failure_pct"))
    values = reduce(DataFrame.unionByName, parts).where(F.col("value").isNotNull())
    return search.health_bands(values).withColumn("value", F.round("value", 6))


@query(
    "scrape_relabel",
    """SELECT event_id, concat_ws(',', CASE WHEN event_type = 'click' THEN NULL ELSE 'instance=host-' || (user_id % 7) END,
  'job=' || CASE WHEN event_type = 'view' THEN 'genai-pipeline' ELSE 'ml-pipeline' END,
  'pipeline_type=' || CASE WHEN event_type = 'view' THEN 'genai' ELSE 'ml' END,
  'service=' || CASE WHEN event_type = 'view' THEN 'genai-pipeline' ELSE 'ml-pipeline' END) AS labels
FROM ev WHERE k % 2 = 0""",
)
def scrape_relabel(spark, sf_dir):
    """Address to instance label, constant job labels, metrics kept by name."""
    host = F.concat(F.lit("host-"), (F.col("user_id") % 7).cast("string"))
    job = F.when(F.col("event_type") == "view", "genai-pipeline").otherwise("ml-pipeline")
    samples = views.ev(spark, sf_dir).select(
        "event_id",
        F.when(F.col("k") % 2 == 0, "kafka_brokers").otherwise("not_kafka_brokers").alias("metric"),
        F.when(F.col("event_type") == "click", host).otherwise(F.concat(host, F.lit(":9100"))).alias("address"),
        job.alias("job"),
        F.create_map(F.lit("job"), job).alias("labels"),
    )
    kept = relabel.keep_metrics(samples)
    return relabel.constant_labels(relabel.instance_from_address(kept)).select("event_id", render("labels").alias("labels"))


@query(
    "resource_attributes",
    """SELECT span_id, concat_ws(',', 'deployment.environment=production', CASE WHEN tool_name IS NOT NULL THEN 'tool.name=' || tool_name END) AS attributes FROM spans""",
)
def resource_attributes(spark, sf_dir):
    tool = F.col("tool_name")
    stale = F.create_map(F.lit("deployment.environment"), F.lit("staging"))
    spans = views.spans(spark, sf_dir).select(
        "span_id", F.when(tool.isNotNull(), F.map_concat(stale, F.create_map(F.lit("tool.name"), tool))).alias("attributes")
    )
    return relabel.resource_attributes(spans).select("span_id", render("attributes").alias("attributes"))


def _as_lines(logs: DataFrame) -> DataFrame:
    return logs.select(F.to_json(F.struct(*[c for c in logs.columns if c not in ("ts", "us")])).alias("value"))


GENAI_COLUMNS = (
    "timestamp, service, level, event, request_id, model, input_tokens, output_tokens, latency_ms, finish_reason, "
    "ctx_utilization, error_type, error, environment"
)


@query("scan_json_lines", f"SELECT {GENAI_COLUMNS}, ts FROM genai_logs")
def scan_json_lines(spark, sf_dir):
    """Whole JSON log lines, parsed with the declared schema, levels and times normalised."""
    lower = views.genai_logs(spark, sf_dir).withColumn("level", F.lower("level"))
    good, _ = scans.split_malformed(_as_lines(lower), "genai_logs")
    return scans.normalise(good).drop("us")


@query("scan_json_paths", f"SELECT {GENAI_COLUMNS} FROM genai_logs")
def scan_json_paths(spark, sf_dir):
    """The same lines read as text, each field by JSON path with a safe cast."""
    return scans.project_paths(_as_lines(views.genai_logs(spark, sf_dir)), "genai_logs")


@query(
    "scan_malformed",
    "SELECT concat('{\"timestamp\": ', request_id) AS line, count(*) AS lines FROM genai_logs WHERE level = 'CRITICAL' GROUP BY 1",
)
def scan_malformed(spark, sf_dir):
    """Broken lines end in the reject table, the rest is parsed."""
    logs = views.genai_logs(spark, sf_dir)
    good = _as_lines(logs.where(F.col("level") != "CRITICAL"))
    broken = logs.where(F.col("level") == "CRITICAL").select(F.concat(F.lit('{"timestamp": '), F.col("request_id")).alias("value"))
    _, rejects = scans.split_malformed(good.unionByName(broken), "genai_logs")
    return rejects.groupBy("line").agg(F.count(F.lit(1)).alias("lines"))


FILE_COUNTS = """SELECT 'kept' AS part, log_date, service, count(*) AS lines, CAST(sum(CASE WHEN n % 13 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS latencies,
  CAST(sum(CASE WHEN n % 13 = 0 THEN 0 ELSE round(latency_ms * 1000) END) AS BIGINT) AS latency_us FROM numbered WHERE n % 17 <> 0 GROUP BY 2, 3
UNION ALL SELECT 'rejected', NULL, NULL, count(*), NULL, NULL FROM numbered WHERE n % 17 = 0"""
FILE_SQL = "WITH numbered AS (SELECT *, CAST(ts AS DATE) AS log_date, CAST(substr(transaction_id, 4) AS BIGINT) AS n FROM ml_logs) " + FILE_COUNTS


def _damaged(rows: DataFrame) -> DataFrame:
    """JSON lines with an unknown key; every 13th has a text for a number and every 17th is cut off."""
    n = F.substring("transaction_id", 4, 20).cast("long")
    names = [c for c in rows.columns if c not in ("ts", "us", "latency_ms")]
    latency = F.when(n % 13 == 0, F.lit("n/a")).otherwise(F.col("latency_ms").cast("string"))
    line = F.to_json(F.struct(*names, latency.alias("latency_ms"), F.lit(1).alias("unheard_of")))
    cut = F.when(n % 17 == 0, F.expr("substring(_line, 1, length(_line) - 5)")).otherwise(F.col("_line"))
    day = F.date_format("ts", "yyyy"), F.date_format("ts", "MM"), F.date_format("ts", "dd")
    return rows.select(line.alias("_line"), n.alias("_n"), *[d.alias(p) for d, p in zip(day, ("year", "month", "day"))], "transaction_id").select(
        cut.alias("value"), "year", "month", "day"
    )


@query("scan_files_partitioned", FILE_SQL)
def scan_files_partitioned(spark, sf_dir):
    """Partitioned log files with damaged lines, written and scanned; rejects are counted."""
    root = fresh_path(spark, "ml-log-files")
    _damaged(views.ml_logs(spark, sf_dir)).write.partitionBy("year", "month", "day").text(root)
    kept = scans.scan_ml_logs(spark, root)
    counts = kept.groupBy(F.lit("kept").alias("part"), "log_date", "service").agg(
        F.count(F.lit(1)).alias("lines"), F.count("latency_ms").alias("latencies"),
        F.sum(F.coalesce(F.round(F.col("latency_ms") * 1000), F.lit(0.0))).cast("long").alias("latency_us"),
    )
    none = F.lit(None)
    rejects = scans.scan_rejects(spark, root, "ml_logs", recursive=True).agg(F.count(F.lit(1)).alias("lines"))
    lost = rejects.select(
        F.lit("rejected").alias("part"), none.cast("date").alias("log_date"), none.cast("string").alias("service"), "lines",
        none.cast("long").alias("latencies"), none.cast("long").alias("latency_us"),
    )
    return counts.unionByName(lost)


@query(
    "container_logs",
    """SELECT ts, CASE WHEN event_type = 'error' THEN 'stderr' ELSE 'stdout' END AS stream,
  concat('svc_', event_type, '_c0ffee', CAST(user_id AS VARCHAR)) AS container_name, concat('c0ffee', CAST(user_id AS VARCHAR)) AS container_id,
  event_type AS output FROM ev""",
)
def container_logs(spark, sf_dir):
    tag = F.concat(F.lit("svc_"), F.col("event_type"), F.lit("_c0ffee"), F.col("user_id").cast("string"))
    lines = views.ev(spark, sf_dir).select(
        F.to_json(
            F.struct(
                F.col("event_type").alias("log"),
                F.when(F.col("event_type") == "error", "stderr").otherwise("stdout").alias("stream"),
                F.concat(F.col("ts_iso"), F.lit("Z")).alias("time"),
                F.to_json(F.struct(tag.alias("tag"))).alias("attrs"),
            )
        ).alias("value")
    )
    return scans.parse_container_lines(lines).drop("tag")


@query(
    "topic_messages",
    """SELECT 'genai-events' AS topic, CAST(user_id % 3 AS INT) AS "partition", event_id AS "offset", 'inference_completed' AS event_type,
  concat('req-', CAST(event_id AS VARCHAR)) AS request_id, round(value * 100, 2) AS latency_ms,
  to_timestamp(us // 1000000) AT TIME ZONE 'UTC' AS event_time FROM ev""",
)
def topic_messages(spark, sf_dir):
    """Broker messages with metadata; epoch-second times."""
    messages = views.ev(spark, sf_dir).select(
        F.lit("genai-events").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(
            F.struct(
                F.lit("inference_completed").alias("event_type"),
                F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
                F.round(F.col("value") * 100, 2).alias("latency_ms"),
                F.floor(F.col("us") / 1000000).alias("timestamp"),
            )
        ).alias("value"),
    )
    parsed = en.enrich(scans.parse_messages(messages))
    return parsed.select("metadata.topic", "metadata.partition", "metadata.offset", "event_type", "request_id", "latency_ms", "event_time")
