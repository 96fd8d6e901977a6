"""Registered alerting queries.

Samples are hourly, so the shipped rules run with all durations times sixty.
Inhibition, grouping and incident queries that the shipped rules would leave
nearly empty run on alerts made from every event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.labels import labels_of, render
from tidewatch.functions.scan import DAY, HOUR, MICROS, MINUTE
from tidewatch.operators import alerts as al
from tidewatch.operators import notify
from tidewatch.plans import views
from tidewatch.plans.alert_rules import RULES
from tidewatch.plans.registry import query
from tidewatch.plans.samples import sample_table, stored
from tidewatch.plans.series_queries import TELEMETRY

FACTOR = 60
SLOWED = [r.slowed(FACTOR) for r in RULES]
LOOKBACK = 5 * MINUTE * FACTOR


def _evaluations(spark, sf_dir) -> DataFrame:
    return al.evaluate_rules(sample_table(spark, sf_dir), SLOWED, LOOKBACK)


def _alerts(spark, sf_dir) -> DataFrame:
    return al.alert_rows(_evaluations(spark, sf_dir), SLOWED, block_us=10 * DAY)


def alert_table(spark, sf_dir) -> DataFrame:
    """Alert rows as a stored table."""
    return stored(spark, "alerts", sf_dir, lambda: _alerts(spark, sf_dir).drop("labels"), "state")


def _rules_sql() -> str:
    rows = []
    for r in SLOWED:
        if r.shape in ("average_rate", "gauge_ratio"):
            continue  # host metrics are not derivable from the tables
        matcher = ",".join(f"{k}={v}" for k, v in r.where.items())
        rows.append(
            f"('{r.name}', '{r.shape}', '{r.metric}', '{matcher}', {r.window * MICROS}, {r.every * MICROS}, {r.q}::DOUBLE, {r.scale}::DOUBLE, "
            f"'{r.op}', {r.threshold}::DOUBLE, {r.hold * MICROS}, '{r.severity}', '{r.team}', {repr(r.pipeline) if r.pipeline else 'NULL'})"
        )
    return (
        "SELECT * FROM (VALUES " + ", ".join(rows) + ") v(alertname, shape, metric, matcher, window_us, every_us, q, scale, op, threshold, hold_us, severity, team, pipeline)"
    )


EVALUATIONS = {
    **TELEMETRY,
    "alert_rules": _rules_sql(),
    "rule_samples": f"""
SELECT r.*, s.series, s.le, s.us, s.value, CASE WHEN r.shape IN ('gauge', 'age') THEN {LOOKBACK} ELSE r.window_us END AS reach
FROM telemetry s JOIN alert_rules r ON s.metric = r.metric WHERE r.matcher = '' OR s.series LIKE '%' || r.matcher || '%'""",
    "rule_growths": """
SELECT *, CASE WHEN lag(value) OVER w IS NULL THEN 0 WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE value END AS growth
FROM rule_samples WINDOW w AS (PARTITION BY alertname, series, le ORDER BY us)""",
    "rule_grid": """
SELECT alertname, series, le, reach, unnest(range(CAST(ceil(min(us) / any_value(every_us)) AS BIGINT) * any_value(every_us), max(us) + reach + 1, any_value(every_us))) AS t
FROM rule_growths GROUP BY 1, 2, 3, 4""",
    "rule_windows": """
SELECT g.alertname, g.series, g.le, g.t, any_value(s.shape) AS shape, any_value(s.window_us) AS window_us, any_value(s.q) AS q,
  count(*) AS n, sum(s.growth) - arg_min(s.growth, s.us) AS increase, arg_max(s.value, s.us) AS latest
FROM rule_grid g JOIN rule_growths s ON g.alertname = s.alertname AND g.series = s.series AND g.le IS NOT DISTINCT FROM s.le AND s.us BETWEEN g.t - g.reach AND g.t
GROUP BY 1, 2, 3, 4""",
    "rule_rates": "SELECT *, increase / (window_us / 1e6) AS v FROM rule_windows WHERE n >= 2",
    "rule_edges": """
SELECT *, max(v) OVER (PARTITION BY alertname, series, t) AS total, lag(v, 1, 0) OVER w AS before, lag(le) OVER w AS edge
FROM rule_rates WHERE shape = 'quantile' WINDOW w AS (PARTITION BY alertname, series, t ORDER BY le)""",
    "rule_values": """
SELECT alertname, series, t, v AS value FROM rule_rates WHERE shape = 'rate'
UNION ALL SELECT alertname, series, t, latest FROM rule_windows WHERE shape = 'gauge'
UNION ALL SELECT alertname, series, t, t / 1e6 - latest FROM rule_windows WHERE shape = 'age'
UNION ALL SELECT alertname, regexp_replace(series, ',status=[^,]*', ''), t, sum(v) FILTER (WHERE series LIKE '%status=error%') / sum(v) FROM rule_rates
  WHERE shape = 'ratio_of_rates' GROUP BY 1, 2, 3 HAVING sum(v) <> 0 AND count(*) FILTER (WHERE series LIKE '%status=error%') > 0
UNION ALL SELECT alertname, series, t, CASE WHEN isinf(le) THEN edge ELSE coalesce(edge, 0) + (le - coalesce(edge, 0)) * ((q * total - before) / (v - before)) END
  FROM rule_edges WHERE total > 0 AND v >= q * total QUALIFY row_number() OVER (PARTITION BY alertname, series, t ORDER BY le) = 1""",
    "true_evaluations": """
SELECT v.alertname, v.series, v.t AS eval_us, r.every_us, v.value * r.scale AS value FROM rule_values v JOIN alert_rules r ON v.alertname = r.alertname
WHERE CASE r.op WHEN '>' THEN v.value * r.scale > r.threshold WHEN '<' THEN v.value * r.scale < r.threshold ELSE v.value * r.scale = r.threshold END""",
}
ALERTS = {
    **EVALUATIONS,
    "alert_runs": """
SELECT alertname, series, every_us, min(eval_us) AS start_us, max(eval_us) AS end_us, arg_max(value, eval_us) AS value FROM (
  SELECT *, sum(opens) OVER (PARTITION BY alertname, series ORDER BY eval_us) AS run FROM (
    SELECT *, CASE WHEN eval_us - lag(eval_us) OVER (PARTITION BY alertname, series ORDER BY eval_us) <= every_us THEN 0 ELSE 1 END AS opens FROM true_evaluations) a) b
GROUP BY alertname, series, every_us, run""",
    "rule_alerts": """
SELECT a.alertname, a.series, r.severity, r.team, r.pipeline, nullif(regexp_extract(a.series, 'service=([^,]*)', 1), '') AS service,
  a.start_us AS active_us, CASE WHEN a.start_us + CAST(ceil(r.hold_us / a.every_us) AS BIGINT) * a.every_us <= a.end_us THEN a.start_us + CAST(ceil(r.hold_us / a.every_us) AS BIGINT) * a.every_us END AS firing_us,
  a.end_us + a.every_us AS resolved_us, a.value, CASE WHEN a.start_us + CAST(ceil(r.hold_us / a.every_us) AS BIGINT) * a.every_us <= a.end_us THEN 'firing' ELSE 'pending' END AS state
FROM alert_runs a JOIN alert_rules r ON a.alertname = r.alertname""",
}


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("series", render(labels_of("series")))


@query("rule_evaluations", "SELECT alertname, series, eval_us, round(value, 6) AS value FROM true_evaluations", EVALUATIONS)
def rule_evaluations(spark, sf_dir):
    """Every true evaluation of every rule."""
    return _named(_evaluations(spark, sf_dir)).select("alertname", "series", "eval_us", F.round("value", 6).alias("value"))


ALERT_COLUMNS = ["alertname", "series", "severity", "team", "pipeline", "service", "active_us", "firing_us", "resolved_us", "state"]


@query("alerts_firing", f"SELECT {', '.join(ALERT_COLUMNS)}, round(value, 6) AS value FROM rule_alerts", ALERTS)
def alerts_firing(spark, sf_dir):
    """Alert rows with the pending and firing times."""
    return _named(_alerts(spark, sf_dir)).select(*ALERT_COLUMNS, F.round("value", 6).alias("value"))


RECEIVER_SQL = """CASE WHEN severity = 'critical' AND team = 'ai-platform' THEN 'pagerduty-ai-platform'
  WHEN severity = 'critical' AND team = 'platform' THEN 'pagerduty-platform' WHEN team = 'ml-ops' THEN 'slack-ml-ops'
  WHEN team = 'data-engineering' THEN 'slack-data-eng' ELSE 'slack-default' END"""


@query("alerts_routed", f"SELECT alertname, {RECEIVER_SQL} AS receiver, count(*) AS alerts FROM rule_alerts WHERE state = 'firing' GROUP BY 1, 2", ALERTS)
def alerts_routed(spark, sf_dir):
    firing = alert_table(spark, sf_dir).where(F.col("state") == "firing")
    return notify.route(firing).groupBy("alertname", "receiver").agg(F.count(F.lit(1)).alias("alerts"))


def _scaled_sql(v: str) -> str:
    """Four significant digits with a prefix for thousands or thousandths."""
    steps = [("1e6", "M"), ("1e3", "k"), ("1", ""), ("1e-3", "m"), ("1e-6", "u"), ("1e-9", "n")]
    return f"CASE WHEN {v} = 0 THEN '0' " + " ".join(f"WHEN abs({v}) >= {size}::DOUBLE THEN printf('%.4g', {v} / {size}::DOUBLE) || '{unit}'" for size, unit in steps) + " END"


VALUE_SQL = {
    "plain": "regexp_replace(CAST(value AS VARCHAR), '[.]0$', '')",
    "percentage": "printf('%.4g%%', value * 100)",
    "humanize": _scaled_sql("value"),
    "duration": f"""CASE WHEN abs(value) >= 60 THEN concat(CASE WHEN value >= 86400 THEN CAST(floor(value / 86400) AS BIGINT) || 'd ' ELSE '' END,
  CASE WHEN value >= 3600 THEN CAST(floor(value / 3600) AS BIGINT) % 24 || 'h ' ELSE '' END, CAST(floor(value / 60) AS BIGINT) % 60 || 'm ', CAST(floor(value) AS BIGINT) % 60 || 's')
  WHEN value = 0 THEN '0s' WHEN abs(value) >= 1 THEN printf('%.4gs', value) ELSE ({_scaled_sql("value")}) || 's' END""",
}


def _text_sql(field: str) -> str:
    """The text of every rule, from the same templates that the rules carry."""
    cases = []
    for rule in RULES:
        parts = []
        for kind, text in al.template_parts(getattr(rule, field)):
            quoted = text.replace("'", "''")
            if kind == "literal":
                parts.append("'" + quoted.replace("\n", "' || chr(10) || '") + "'")
            elif kind == "label":
                parts.append(f"coalesce(regexp_extract(series, '(?:^|,){text}=([^,]*)', 1), '')")
            else:
                parts.append(f"({VALUE_SQL[text]})")
        cases.append(f"WHEN '{rule.name}' THEN {' || '.join(parts)}")
    return "CASE alertname " + "\n  ".join(cases) + " END"


@query(
    "alert_texts",
    f"SELECT alertname, series, active_us, state, {_text_sql('summary')} AS summary, {_text_sql('description')} AS description FROM rule_alerts",
    ALERTS,
)
def alert_texts(spark, sf_dir):
    """Rendered texts of every alert of every rule."""
    return _named(alert_table(spark, sf_dir)).select("alertname", "series", "active_us", "state", "summary", "description")


SPIKES = {
    **ALERTS,
    "spike_values": f"""
SELECT metric, series, us AS end_us, CASE WHEN value >= before THEN value - before ELSE value END / 3600 AS value FROM (
  SELECT *, lag(value) OVER w AS before, lag(us) OVER w AS before_us FROM telemetry
  WHERE (le IS NULL OR isinf(le)) AND regexp_matches(metric, '({"|".join(notify.COUNTER_ENDINGS)})$') WINDOW w AS (PARTITION BY metric, series ORDER BY us)) c WHERE before_us = us - {HOUR}
UNION ALL SELECT metric, series, CAST(ceil(us / {HOUR}) AS BIGINT) * {HOUR}, max(value) FROM telemetry
WHERE (le IS NULL OR isinf(le)) AND NOT regexp_matches(metric, '({"|".join(notify.COUNTER_ENDINGS)})$') GROUP BY 1, 2, 3""",
    "spike_medians": f"SELECT metric, series, end_us // {HOUR} % 24 AS slot, median(value) AS mid FROM spike_values GROUP BY 1, 2, 3",
    "spike_far": f"""
SELECT v.*, m.slot, m.mid, abs(v.value - m.mid) AS far FROM spike_values v JOIN spike_medians m ON v.metric = m.metric AND v.series = m.series AND v.end_us // {HOUR} % 24 = m.slot""",
    "spike_scales": "SELECT metric, series, slot, median(far) AS middle, avg(far) AS mean FROM spike_far GROUP BY 1, 2, 3",
    "spikes": f"""
SELECT * FROM (SELECT f.metric, f.series, f.end_us, f.value, round((f.value - f.mid) / CASE WHEN s.middle > abs(f.mid) * 1e-9 THEN s.middle * {notify.MEDIAN_SCALE}::DOUBLE
  WHEN s.mean > abs(f.mid) * 1e-9 THEN s.mean * {notify.MEAN_SCALE}::DOUBLE END, 6) AS score
FROM spike_far f JOIN spike_scales s ON f.metric = s.metric AND f.series = s.series AND f.slot = s.slot) x WHERE score >= {notify.SPIKE_SCORE}""",
}


@query(
    "alert_metric_spikes",
    f"""SELECT a.alertname, a.series, a.active_us, s.metric, max(s.score) AS score, round(arg_max(s.value, (s.score, s.value)), 6) AS peak
FROM rule_alerts a JOIN spikes s ON s.end_us BETWEEN CAST(ceil((a.active_us - {15 * MINUTE}) / {HOUR}) AS BIGINT) * {HOUR} AND CAST(ceil(a.resolved_us / {HOUR}) AS BIGINT) * {HOUR}
WHERE a.firing_us IS NOT NULL AND len(list_filter(string_split(a.series, ','), lambda x: len(list_filter(string_split(s.series, ','), lambda y: split_part(y, '=', 1) = split_part(x, '=', 1) AND y <> x)) > 0)) = 0
GROUP BY 1, 2, 3, 4""",
    SPIKES,
)
def alert_metric_spikes(spark, sf_dir):
    """Metrics that spiked while an alert was on, by series that carry the alert's labels."""
    out = _named(notify.spiking_metrics(alert_table(spark, sf_dir), sample_table(spark, sf_dir)))
    return out.select("alertname", "series", "active_us", "metric", F.round("score", 6).alias("score"), F.round("peak", 6).alias("peak"))


def event_alerts(spark, sf_dir) -> DataFrame:
    """One firing alert per event, with some labels absent."""
    kind, k, user = F.col("event_type"), F.col("k"), F.col("user_id")
    name = (
        F.when(kind == "error", "ServiceDown").when(kind == "click", "GenAIHighErrorRate").when(kind == "view", "GenAIHighLatency")
        .when(kind == "purchase", "MLInferenceLatencyHigh").otherwise("KafkaConsumerLagHigh")
    )
    team = F.when(kind == "error", "platform").when(kind.isin("click", "view"), "ai-platform").when(kind == "purchase", "ml-ops").otherwise("data-engineering")
    pick = lambda c: F.concat(F.lit("svc-"), c.cast("string"))
    start = F.col("us")
    length = (F.floor(F.col("value") / 2) + 1).cast("long") * MINUTE
    return views.ev(spark, sf_dir).select(
        name.alias("alertname"),
        F.concat(F.lit("event="), F.col("event_id").cast("string")).alias("series"),
        F.when(k % 3 == 0, "critical").otherwise("warning").alias("severity"),
        team.alias("team"),
        F.when(user % 7 != 0, pick(user % 7)).alias("service"),
        F.when(k % 5 != 0, F.concat(F.lit("pipe-"), (k % 2).cast("string"))).alias("pipeline"),
        start.alias("active_us"),
        (start + MINUTE).alias("firing_us"),
        (start + MINUTE + length).alias("resolved_us"),
        F.concat(F.lit("summary "), (k % 4).cast("string")).alias("summary"),
        F.concat(F.lit("about "), kind).alias("description"),
        F.when(k % 4 == 0, "https://runbooks.example/page").alias("runbook_url"),
    )


def _rest_sql(name: str, rows: str, target: str, source: str, equal: list[str]) -> dict[str, str]:
    """What a rule leaves of ``rows``: a piece begins with its alert or with the end of a source, where no
    source fires, and lasts until the next source begins."""
    same = " AND ".join(f"x.{k} IS NOT DISTINCT FROM t.{k}" for k in equal)
    others = "alertname, series, severity, team, service, pipeline, active_us, summary, description, runbook_url"
    return {
        f"{name}_sources": f"SELECT {', '.join(equal)}, firing_us AS f, resolved_us AS r FROM event_alerts WHERE {source}",
        f"{name}_begins": f"""
SELECT t.*, t.firing_us AS f0 FROM {rows} t WHERE {target}
UNION SELECT t.*, x.r FROM {rows} t JOIN {name}_sources x ON {same} WHERE {target} AND x.r > t.firing_us AND x.r < t.resolved_us""",
        f"{name}_free": f"""
SELECT t.* FROM {name}_begins t ANTI JOIN {name}_sources x ON {same} AND x.f <= t.f0 AND x.r > t.f0""",
        f"{name}_pieces": f"""
SELECT {", ".join("t." + c for c in others.split(", "))}, t.f0 AS firing_us, least(t.resolved_us, coalesce(min(x.f), t.resolved_us)) AS resolved_us
FROM {name}_free t LEFT JOIN {name}_sources x ON {same} AND x.f > t.f0 AND x.f < t.resolved_us
GROUP BY {", ".join("t." + c for c in others.split(", "))}, t.f0, t.resolved_us""",
        f"{name}_left": f"""
SELECT {others}, firing_us, resolved_us FROM {rows} WHERE NOT ({target}) UNION ALL SELECT {others}, firing_us, resolved_us FROM {name}_pieces""",
    }


EVENT_ALERTS = {
    "event_alerts": f"""
SELECT CASE event_type WHEN 'error' THEN 'ServiceDown' WHEN 'click' THEN 'GenAIHighErrorRate' WHEN 'view' THEN 'GenAIHighLatency' WHEN 'purchase' THEN 'MLInferenceLatencyHigh' ELSE 'KafkaConsumerLagHigh' END AS alertname,
  'event=' || event_id AS series, CASE WHEN k % 3 = 0 THEN 'critical' ELSE 'warning' END AS severity,
  CASE event_type WHEN 'error' THEN 'platform' WHEN 'click' THEN 'ai-platform' WHEN 'view' THEN 'ai-platform' WHEN 'purchase' THEN 'ml-ops' ELSE 'data-engineering' END AS team,
  CASE WHEN user_id % 7 <> 0 THEN 'svc-' || (user_id % 7) END AS service, CASE WHEN k % 5 <> 0 THEN 'pipe-' || (k % 2) END AS pipeline,
  us AS active_us, us + {MINUTE} AS firing_us, us + {MINUTE} + (CAST(floor(value / 2) AS BIGINT) + 1) * {MINUTE} AS resolved_us,
  'summary ' || (k % 4) AS summary, 'about ' || event_type AS description, CASE WHEN k % 4 = 0 THEN 'https://runbooks.example/page' END AS runbook_url
FROM ev""",
    **_rest_sql("first", "event_alerts", "severity = 'warning'", "severity = 'critical'", ["alertname", "service", "pipeline"]),
    **_rest_sql("second", "first_left", "regexp_full_match(alertname, '.*ErrorRate|.*Latency')", "alertname = 'ServiceDown'", ["service"]),
}


@query("alerts_inhibited", "SELECT alertname, series, severity, service, pipeline, firing_us, resolved_us FROM second_left", EVENT_ALERTS)
def alerts_inhibited(spark, sf_dir):
    """Times of alerts left after inhibition."""
    left = notify.inhibit(event_alerts(spark, sf_dir))
    return left.select("alertname", "series", "severity", "service", "pipeline", "firing_us", "resolved_us")


GROUPS = {
    **EVENT_ALERTS,
    "routed": f"""
SELECT *, {RECEIVER_SQL} AS receiver, CASE WHEN severity = 'critical' AND team IN ('ai-platform', 'platform') THEN 10 ELSE 30 END AS group_wait, 300 AS group_interval,
  CASE WHEN severity = 'critical' AND team IN ('ai-platform', 'platform') THEN 3600 WHEN team = 'ml-ops' THEN 28800 WHEN team = 'data-engineering' THEN 14400
    WHEN severity = 'warning' THEN 28800 ELSE 14400 END AS repeat_interval FROM event_alerts""",
    "lived": """
SELECT *, CAST(sum(opens) OVER (PARTITION BY receiver, alertname, pipeline, service ORDER BY firing_us, series) AS BIGINT) AS life FROM (
  SELECT *, CASE WHEN max(resolved_us) OVER (PARTITION BY receiver, alertname, pipeline, service ORDER BY firing_us, series ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= firing_us THEN 0 ELSE 1 END AS opens FROM routed) r""",
    "lives": """
SELECT receiver, alertname, pipeline, service, life, count(*) AS alerts, min(firing_us) AS began_us, max(resolved_us) AS ended_us, max(group_interval) AS group_interval,
  max(repeat_interval) AS repeat_interval, max(group_wait) AS group_wait, CASE WHEN min(summary) = max(summary) THEN min(summary) END AS common_summary FROM lived GROUP BY 1, 2, 3, 4, 5""",
    "known": "SELECT *, began_us + group_wait * 1000000 AS first_us FROM lives WHERE began_us + group_wait * 1000000 < ended_us",
    "news": """
SELECT DISTINCT k.receiver, k.alertname, k.pipeline, k.service, k.life, k.ended_us, k.repeat_interval,
  k.first_us + CAST(ceil(greatest(l.firing_us - k.first_us, 0) / (k.group_interval * 1000000)) AS BIGINT) * k.group_interval * 1000000 AS sent_us
FROM lived l JOIN known k ON l.receiver = k.receiver AND l.alertname = k.alertname AND l.pipeline IS NOT DISTINCT FROM k.pipeline AND l.service IS NOT DISTINCT FROM k.service AND l.life = k.life""",
    "spaced": """
SELECT *, coalesce(lead(sent_us) OVER (PARTITION BY receiver, alertname, pipeline, service, life ORDER BY sent_us), ended_us) AS stop_us FROM news WHERE sent_us < ended_us""",
}


def _lived(spark, sf_dir) -> DataFrame:
    return notify.with_life(notify.route(event_alerts(spark, sf_dir)))


@query(
    "alert_groups",
    """SELECT receiver, alertname, pipeline, service, life, alerts, began_us, ended_us,
  concat('[', CASE receiver WHEN 'slack-ml-ops' THEN 'ML-OPS ' WHEN 'slack-data-eng' THEN 'DATA-ENG ' ELSE '' END, 'FIRING] ', coalesce(common_summary, '')) AS title FROM lives""",
    GROUPS,
)
def alert_groups(spark, sf_dir):
    """Group lives with the chat title."""
    groups = notify.chat_titles(notify.group_alerts(_lived(spark, sf_dir)))
    return groups.select("receiver", *notify.GROUP_BY, "life", "alerts", "began_us", "ended_us", "title")


@query(
    "alert_blocks",
    """SELECT receiver, alertname, series, life, row_number() OVER (PARTITION BY receiver, alertname, pipeline, service, life ORDER BY firing_us, series) AS position,
  CASE WHEN receiver = 'slack-default' THEN concat('*Alert:* ', summary, chr(10), '*Severity:* `', severity, '`', chr(10), '*Pipeline:* `', coalesce(pipeline, ''), '`', chr(10), '*Description:* ', description, chr(10),
    CASE WHEN runbook_url IS NOT NULL THEN concat('*Runbook:* ', runbook_url, chr(10)) ELSE '' END)
  ELSE concat('*Alert:* ', summary, chr(10), '*Description:* ', description, chr(10)) END AS text FROM lived""",
    GROUPS,
)
def alert_blocks(spark, sf_dir):
    """Rendered text block of every alert with its place in the message."""
    blocks = notify.chat_blocks(_lived(spark, sf_dir))
    return blocks.select("receiver", "alertname", "series", "life", "position", "text")


NOTICES_SQL = """SELECT receiver, alertname, pipeline, service, life, at_us AS sent_us, CASE WHEN at_us = sent_us THEN 'news' ELSE 'repeat' END AS reason, 'firing' AS status
FROM (SELECT *, unnest(range(sent_us, stop_us, repeat_interval::BIGINT * 1000000)) AS at_us FROM spaced) x
UNION ALL SELECT receiver, alertname, pipeline, service, life, first_us + CAST(ceil((ended_us - first_us) / (group_interval * 1000000)) AS BIGINT) * group_interval * 1000000, 'end', 'resolved'
FROM known"""


@query("notifications", NOTICES_SQL, GROUPS)
def notifications(spark, sf_dir):
    """Times at which each group life is notified, repeated and closed."""
    return notify.notifications(_lived(spark, sf_dir))


# The same from what inhibition leaves of the alerts.
UNMUTED = {**GROUPS, "routed": GROUPS["routed"].replace("FROM event_alerts", "FROM second_left")}


def _unmuted(spark, sf_dir) -> DataFrame:
    return notify.with_life(notify.route(notify.inhibit(event_alerts(spark, sf_dir))))


@query("notifications_inhibited", NOTICES_SQL, UNMUTED)
def notifications_inhibited(spark, sf_dir):
    """Notices of the alerts that no other alert mutes: inhibition, routes, groups and timers in one job."""
    return notify.notifications(_unmuted(spark, sf_dir))


@query(
    "page_payloads",
    """SELECT n.receiver, n.alertname, n.pipeline, n.service, n.life, n.sent_us, CASE WHEN n.status = 'firing' THEN 'trigger' ELSE 'resolve' END AS action,
  sha256(concat_ws(',', n.receiver, 'alertname=' || n.alertname, 'pipeline=' || n.pipeline, 'service=' || n.service)) AS dedup_key,
  CASE WHEN n.receiver = 'pagerduty-platform' THEN 'critical' ELSE coalesce(c.severity, '') END AS severity, coalesce(c.summary, '') AS description,
  CASE WHEN n.receiver = 'pagerduty-ai-platform' THEN coalesce(n.pipeline, '') END AS detail_pipeline,
  CASE WHEN n.receiver = 'pagerduty-ai-platform' THEN coalesce(c.description, '') END AS detail_description,
  CASE WHEN n.receiver = 'pagerduty-ai-platform' THEN coalesce(c.runbook_url, '') END AS detail_runbook
FROM notices n JOIN common_values c ON n.receiver = c.receiver AND n.alertname = c.alertname AND n.pipeline IS NOT DISTINCT FROM c.pipeline
  AND n.service IS NOT DISTINCT FROM c.service AND n.life = c.life WHERE n.receiver LIKE 'pagerduty-%'""",
    {
        **UNMUTED,
        "notices": NOTICES_SQL,
        "common_values": "SELECT receiver, alertname, pipeline, service, life, "
        + ", ".join(f"CASE WHEN min({c}) = max({c}) AND count({c}) = count(*) THEN min({c}) END AS {c}" for c in ("severity", "summary", "description", "runbook_url"))
        + " FROM lived GROUP BY 1, 2, 3, 4, 5",
    },
)
def page_payloads(spark, sf_dir):
    """The page of every notice to a paging receiver, from the alerts that inhibition leaves."""
    lived = _unmuted(spark, sf_dir)
    pages = notify.page_payloads(notify.notifications(lived), notify.group_alerts(lived))
    detail = [F.try_element_at("details", F.lit(name)).alias(f"detail_{name}") for name in ("pipeline", "description", "runbook")]
    return pages.select("receiver", *notify.GROUP_BY, "life", "sent_us", "action", "dedup_key", "severity", "description", *detail)


INCIDENT_GAP = 10 * MINUTE


@query(
    "incidents",
    f"""WITH tagged AS (SELECT *, CAST(sum(opens) OVER (ORDER BY active_us) AS BIGINT) AS incident FROM (
  SELECT *, CASE WHEN active_us - lag(active_us) OVER (ORDER BY active_us) <= {INCIDENT_GAP} THEN 0 ELSE 1 END AS opens FROM
    (SELECT active_us, min((alertname, series)) AS head, count(*) AS n FROM event_alerts GROUP BY 1) a) b)
SELECT incident, min(active_us) AS began_us, max(active_us) AS last_start_us, arg_min(head, active_us)[1] AS first_alert, arg_min(head, active_us)[2] AS first_series, CAST(sum(n) AS BIGINT) AS alerts
FROM tagged GROUP BY 1""",
    EVENT_ALERTS,
)
def incidents(spark, sf_dir):
    """Which alert came first when several services alert together."""
    return notify.incidents(event_alerts(spark, sf_dir), INCIDENT_GAP)
