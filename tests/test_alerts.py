"""Time-series algebra, rules, texts, inhibition, routing and timers."""

import json
import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewatch.functions.formatting import humanize, humanize_duration, humanize_percentage, plain
from tidewatch.functions.labels import series_key
from tidewatch.functions.scan import HOUR
from tidewatch.operators import alerts as al
from tidewatch.operators import notify
from tidewatch.operators import timeseries as ts
from tidewatch.plans.alert_rules import RULES

S = 1_000_000


def counter(spark, values, every=10):
    return spark.createDataFrame([("a", i * every * S, float(v)) for i, v in enumerate(values)], "k STRING, us BIGINT, value DOUBLE")


def test_increase_counts_resets(spark):
    got = ts.increase(counter(spark, [1, 5, 9, 2, 4]), ["k"], 40 * S, 40 * S)
    assert (40 * S, 12.0) in rows(got, "eval_us", "value")


@pytest.mark.parametrize("window,step", [(30, 10), (70, 15), (300, 7)])
def test_range_vector_against_brute_force(spark, window, step):
    values = [(i * i * 7) % 23 for i in range(300)]
    df = counter(spark, values)
    got = ts.range_vector(df, ["k"], window * S, step * S)
    want = []
    points = [(i * 10, v) for i, v in enumerate(values)]
    for t in range(0, points[-1][0] + window + 1, step):
        inside = [(u, v) for u, v in points if t - window <= u <= t]
        if inside:
            grown = sum(b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in zip(inside, inside[1:]))
            want.append((t * S, inside[0][0] * S, inside[-1][0] * S, len(inside), float(grown)))
    assert rows(got, "eval_us", "first_us", "last_us", "samples", "increase") == want


def test_instant_vector_lookback(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 95 * S, 2.0)], "k STRING, us BIGINT, value DOUBLE")
    got = ts.instant_vector(df, ["k"], 10 * S, 30 * S)
    assert rows(got, "eval_us", "value") == [(t * S, 1.0) for t in (0, 10, 20, 30)] + [(t * S, 2.0) for t in (100, 110, 120)]


def test_extrapolation_reaches_the_edges(spark):
    df = counter(spark, [100, 110, 120, 130, 140, 150, 160], 10)
    got = dict(rows(ts.increase(df, ["k"], 60 * S, 5 * S, extrapolate=True), "eval_us", "value"))
    # Samples at 10..60 cover 50 s of [5, 65]; both edges are half a sample away.
    assert got[65 * S] == pytest.approx(60.0)


def buckets(spark, data):
    return spark.createDataFrame([("g", float(le), float(v)) for le, v in data], "g STRING, le DOUBLE, value DOUBLE")


@pytest.mark.parametrize(
    "data,q,want",
    [
        ([(1, 0), (2, 10), (math.inf, 10)], 0.5, 1.5),
        ([(1, 0), (2, 0), (math.inf, 10)], 0.5, 2.0),
        ([(1, 5), (2, 10)], 0.5, math.nan),
        ([(1, 0), (2, 0), (math.inf, 0)], 0.5, math.nan),
        ([(1, 4), (2, 10), (math.inf, 10)], 0.2, 0.5),
        ([(-1, 4), (2, 10), (math.inf, 10)], 0.2, -1.0),
        ([(math.inf, 4)], 0.2, math.nan),
    ],
)
def test_histogram_quantile(spark, data, q, want):
    got = ts.histogram_quantile(q, buckets(spark, data), ["g"]).first().value
    assert got == pytest.approx(want, nan_ok=True)


def test_quantile_is_monotone(spark):
    df = buckets(spark, [(0.1, 3), (0.5, 3), (1, 9), (5, 20), (math.inf, 22)])
    got = [ts.histogram_quantile(q, df, ["g"]).first().value for q in (0.01, 0.1, 0.3, 0.5, 0.9, 0.99)]
    assert got == sorted(got)


def test_number_formats(spark):
    data = [0.0, 0.05, 12.345678, 999.96, 1234.56, 1.5e6, 0.00042, 123456789.0, 59.5, 75.0, 3725.0, 93784.0, 51.0]
    df = spark.createDataFrame([(v,) for v in data], "v DOUBLE")
    v = F.col("v")
    got = {r.v: r for r in df.select("v", humanize(v).alias("h"), humanize_percentage(v).alias("p"), humanize_duration(v).alias("d"), plain(v).alias("x")).collect()}
    assert [got[x].h for x in (0.0, 12.345678, 1234.56, 1.5e6, 0.00042)] == ["0", "12.35", "1.235k", "1.5M", "420u"]
    assert [got[x].p for x in (0.05, 12.345678)] == ["5%", "1235%"]
    assert [got[x].d for x in (0.0, 0.05, 59.5, 75.0, 3725.0, 93784.0)] == ["0s", "50ms", "59.5s", "1m 15s", "1h 2m 5s", "1d 2h 3m 4s"]
    assert [got[x].x for x in (51.0, 0.05, 123456789.0, 0.00042)] == ["51", "0.05", "123456789", "0.00042"]


def samples(spark, *series):
    """(metric, labels, le, [(seconds, value)...])"""
    data = [(m, labels, le, t * S, float(v)) for m, labels, le, points in series for t, v in points]
    df = spark.createDataFrame(data, "metric STRING, labels MAP<STRING,STRING>, le DOUBLE, us BIGINT, value DOUBLE")
    from tidewatch.functions.labels import series_key

    return df.select("metric", series_key("labels").alias("series"), "le", "us", "value")


def steady(rate, until, every=15):
    return [(t, rate * t) for t in range(0, until, every)]


def alerts_of(spark, *series):
    evaluations = al.evaluate_rules(samples(spark, *series))
    return al.alert_rows(evaluations, runbook_root="https://runbooks.example")


def fired(df):
    return {r.alertname for r in df.where("state = 'firing'").collect()}


def test_hold_restarts_after_a_gap(spark):
    truth = [True, True, False, True, True, True]
    evaluations = spark.createDataFrame(
        [("KafkaConsumerLagHigh", '[{"key":"topic","value":"t"}]', i * 30 * S, 30 * S, 1.0) for i, x in enumerate(truth) if x],
        "alertname STRING, series STRING, eval_us BIGINT, every_us BIGINT, value DOUBLE",
    )
    rule = [r for r in RULES if r.name == "KafkaConsumerLagHigh"][0]
    from dataclasses import replace

    got = al.alert_rows(evaluations, [replace(rule, hold=60)])
    assert rows(got, "active_us", "firing_us", "resolved_us", "state") == [
        (0, None, 60 * S, "pending"),
        (90 * S, 150 * S, 180 * S, "firing"),
    ]


def test_host_rules(spark):
    host = {"instance": "h1"}
    cpu = [("node_cpu_seconds_total", {**host, "mode": "idle", "cpu": c}, None, steady(0.1, 1200)) for c in ("0", "1")]
    level = lambda v: [(t, v) for t in range(0, 1200, 15)]
    df = alerts_of(
        spark,
        *cpu,
        ("node_cpu_seconds_total", {**host, "mode": "user", "cpu": "0"}, None, steady(0.9, 1200)),
        ("node_memory_MemAvailable_bytes", host, None, level(10)),
        ("node_memory_MemTotal_bytes", host, None, level(100)),
        ("node_filesystem_avail_bytes", {**host, "mountpoint": "/"}, None, level(10)),
        ("node_filesystem_size_bytes", {**host, "mountpoint": "/"}, None, level(100)),
        ("node_filesystem_avail_bytes", {**host, "mountpoint": "/data"}, None, level(1)),
        ("node_filesystem_size_bytes", {**host, "mountpoint": "/data"}, None, level(100)),
        ("up", {"job": "genai-pipeline", "instance": "h1"}, None, level(0)),
        ("elasticsearch_cluster_health_status", {"color": "red"}, None, level(1)),
        ("elasticsearch_cluster_health_status", {"color": "green"}, None, level(1)),
    )
    got = {r.alertname: r for r in df.where("state = 'firing'").collect()}
    assert set(got) == {"HighCPUUsage", "HighMemoryUsage", "DiskSpaceLow", "ServiceDown", "ElasticsearchClusterRed"}
    assert got["HighCPUUsage"].summary == "CPU usage above 85% on h1"
    assert 85 < got["HighCPUUsage"].value <= 100
    assert got["HighMemoryUsage"].description == "Memory: 90% used. Risk of OOM kills for ML models."
    assert got["ServiceDown"].summary == "Service genai-pipeline is DOWN"
    assert df.where("alertname = 'DiskSpaceLow' AND state = 'firing'").count() == 1


def test_scenarios(spark):
    call = {"service": "genai-pipeline", "model": "m"}
    until = 2400
    df = alerts_of(
        spark,
        # rate-limit storm with failing calls
        ("genai_requests_total", {**call, "status": "success"}, None, steady(8, until)),
        ("genai_requests_total", {**call, "status": "error"}, None, steady(2, until)),
        ("genai_rate_limit_hits_total", call, None, steady(1, until)),
        # slow calls: half of them take 30 to 60 seconds
        ("genai_request_duration_seconds_bucket", call, 10.0, steady(1, until)),
        ("genai_request_duration_seconds_bucket", call, 30.0, steady(1, until)),
        ("genai_request_duration_seconds_bucket", call, 60.0, steady(2, until)),
        ("genai_request_duration_seconds_bucket", call, math.inf, steady(2, until)),
        # agent loop, drift, lag, dead topic, stale model
        ("agent_max_steps_reached_total", {"agent_name": "x"}, None, steady(0.2, until)),
        ("ml_data_drift_score", {"model_name": "f", "feature_name": "a"}, None, [(t, 0.31) for t in range(0, until, 15)]),
        ("kafka_consumergroup_lag", {"consumergroup": "g", "topic": "t", "partition": "0"}, None, [(t, 10001) for t in range(0, until, 15)]),
        ("kafka_topic_partition_current_offset", {"topic": "t", "partition": "0"}, None, [(t, 5) for t in range(0, until, 15)]),
        ("ml_last_training_completed_timestamp", {"model_name": "f"}, None, [(t, -90000) for t in range(0, until, 15)]),
    )
    assert fired(df) == {
        "GenAIHighErrorRate", "GenAIRateLimitHigh", "GenAIHighLatency", "AgentMaxStepsReached", "MLDataDriftDetected",
        "KafkaConsumerLagHigh", "KafkaTopicNoMessages", "MLTrainingPipelineStalled",
    }
    got = {r.alertname: r for r in df.where("state = 'firing'").collect()}
    assert got["GenAIHighErrorRate"].value == pytest.approx(0.2)
    assert got["GenAIHighErrorRate"].runbook_url == "https://runbooks.example/genai-high-error-rate"
    assert got["GenAIHighErrorRate"].firing_us - got["GenAIHighErrorRate"].active_us == 120 * S
    assert got["GenAIHighLatency"].description.startswith("P99 latency is 59.4s.\n")
    assert got["MLDataDriftDetected"].description.startswith("Drift score: 0.31 (threshold: 0.3).\nFeature: a.\n")
    assert got["KafkaConsumerLagHigh"].description.startswith("Consumer lag: 10k messages.\nTopic: t, Partition: 0.\n")
    routed = notify.route(df.where("state = 'firing'"))
    assert routed.count() == len(got) and routed.where("receiver IS NULL").count() == 0
    receivers = dict(rows(routed, "alertname", "receiver"))
    assert receivers["GenAIHighErrorRate"] == "pagerduty-ai-platform" and receivers["KafkaTopicNoMessages"] == "slack-data-eng"
    out = al.outgoing(df).where("alertname = 'GenAIHighErrorRate'").first()
    assert out.labels["cluster"] == "ai-pipelines" and out.labels["severity"] == "critical" and out.labels["model"] == "m"


def test_every_rule_has_one_receiver(spark):
    df = spark.createDataFrame([(r.name, r.severity, r.team) for r in RULES], "alertname STRING, severity STRING, team STRING")
    got = dict(rows(notify.route(df), "alertname", "receiver"))
    assert len(RULES) == 26 == len(got)
    assert got["DiskSpaceLow"] == "pagerduty-platform" and got["HighCPUUsage"] == "slack-default"
    assert got["MLModelAccuracyDrop"] == "slack-ml-ops" and got["MLHighFeatureMissingRate"] == "slack-data-eng"


ALERT = "alertname STRING, series STRING, severity STRING, team STRING, service STRING, pipeline STRING, firing_us BIGINT, resolved_us BIGINT"


def test_inhibition_label_equality(spark):
    def alert(name, severity, service, pipeline, a, b):
        return (name, f"{name}{severity}{service}{a}", severity, "t", service, pipeline, a, b)

    data = [
        alert("X", "critical", None, "p", 10, 20),
        alert("X", "warning", None, "p", 15, 30),  # absent on both sides: muted until 20
        alert("X", "warning", "s", "p", 15, 30),  # absent on one side: kept
        alert("X", "warning", None, "p", 20, 30),  # source is over: kept
        alert("X", "warning", None, "p", 1, 10),  # over before the source: kept
        alert("ServiceDown", "critical", "s", None, 0, 100),
        alert("AnErrorRate", "warning", "s", "q", 5, 6),  # pattern: muted
        alert("AnErrorRateHigh", "warning", "s", "q", 5, 6),  # pattern is anchored: kept
    ]
    for block in (3, 10**9):
        left = notify.inhibit(spark.createDataFrame(data, ALERT), block_us=block)
        gone = {r[1] for r in data} - {r.series for r in left.collect()}
        assert gone == {data[6][1]}
        assert rows(left.where(F.col("series") == data[1][1]), "firing_us", "resolved_us") == [(20, 30)]


def test_short_overlap_mutes_only_its_time(spark):
    day = 24 * 3600 * S
    data = [
        ("X", "target", "warning", "t", "s", "p", 0, day),
        ("X", "source", "critical", "t", "s", "p", 3600 * S, 3660 * S),
        ("X", "source2", "critical", "t", "s", "p", 3650 * S, 3700 * S),
        ("X", "late", "warning", "t", "s", "p", 3600 * S, 3690 * S),  # muted throughout
    ]
    for block in (60 * S, 10**15):
        left = notify.inhibit(spark.createDataFrame(data, ALERT), block_us=block)
        assert rows(left.where("series = 'target'"), "firing_us", "resolved_us") == [(0, 3600 * S), (3700 * S, day)]
        assert left.where("series = 'late'").isEmpty() and left.where("severity = 'critical'").count() == 2


def test_muted_alert_still_mutes_and_both_sides_do_not(spark):
    chain = [
        notify.Inhibition({"alertname": "A"}, ["service"], target={"alertname": "B"}),
        notify.Inhibition({"alertname": "B"}, ["service"], target={"alertname": "C"}),
        notify.Inhibition({"severity": "critical"}, ["service"], target_pattern={"alertname": "D|E"}),
    ]
    data = [(n, n.lower(), sev, "t", "s", "p", 0, 10) for n, sev in (("A", "x"), ("B", "x"), ("C", "x"), ("D", "critical"), ("E", "warning"))]
    left = notify.inhibit(spark.createDataFrame(data, ALERT), chain)
    assert sorted(r.alertname for r in left.collect()) == ["A", "D"]


def test_notification_times(spark):
    m = 60 * S
    base = ("slack-ml-ops", "A", "p", "s", 30, 300, 600)
    data = [
        (*base, "a1", 0, 21 * m),
        (*base, "a2", 2 * m, 3 * m),  # news at the first flush after it: 30 s + 5 min
        (*base, "a3", 60 * m, 60 * m + 10 * S),  # over before the first notice
    ]
    df = spark.createDataFrame(
        data,
        "receiver STRING, alertname STRING, pipeline STRING, service STRING, group_wait INT, group_interval INT, repeat_interval INT, "
        "series STRING, firing_us BIGINT, resolved_us BIGINT",
    )
    for block in (m, 10**12):
        got = notify.notifications(notify.with_life(df, block_us=block))
        assert rows(got, "sent_us", "reason", "status") == [
            (30 * S, "news", "firing"),
            (330 * S, "news", "firing"),
            (930 * S, "repeat", "firing"),
            (30 * S + 5 * 300 * S, "end", "resolved"),
        ]


def test_pages_of_a_group(spark):
    base = ("A", "p", "s", 10, 300, 3600)
    life = [
        ("pagerduty-ai-platform", *base, "a1", 0, 60 * S, "critical", "sum", "one", "url"),
        ("pagerduty-ai-platform", *base, "a2", 1 * S, 60 * S, "critical", "sum", "two", None),
        ("pagerduty-platform", "B", None, None, 10, 300, 3600, "b", 0, 60 * S, "warning", None, "d", "u"),
        ("slack-default", *base, "c", 0, 60 * S, "warning", "sum", "d", "u"),
    ]
    lived = notify.with_life(spark.createDataFrame(
        life,
        "receiver STRING, alertname STRING, pipeline STRING, service STRING, group_wait INT, group_interval INT, repeat_interval INT, series STRING, "
        "firing_us BIGINT, resolved_us BIGINT, severity STRING, summary STRING, description STRING, runbook_url STRING",
    ))
    got = notify.page_payloads(notify.notifications(lived), notify.group_alerts(lived)).orderBy("receiver", "sent_us").collect()
    assert [(r.receiver, r.action, r.sent_us, r.severity, r.description, r.details) for r in got] == [
        ("pagerduty-ai-platform", "trigger", 10 * S, "critical", "sum", {"pipeline": "p", "description": "", "runbook": ""}),
        ("pagerduty-ai-platform", "resolve", 310 * S, "critical", "sum", {"pipeline": "p", "description": "", "runbook": ""}),
        ("pagerduty-platform", "trigger", 10 * S, "critical", "", {}),
        ("pagerduty-platform", "resolve", 310 * S, "critical", "", {}),
    ]
    assert len({r.dedup_key for r in got}) == 2


def test_spikes_are_robust_and_keep_to_the_labels(spark):
    hour, days = 3600 * S, 12
    key = lambda **labels: json.dumps([{"key": k, "value": v} for k, v in sorted(labels.items())], separators=(",", ":"))
    a, b = key(model="m", service="a"), key(service="b")
    total, data = 0.0, []
    for t in range(24 * days):
        total += 100.0 + t // 24 % 3
        data += [("grows_total", a, None, t * hour, total), ("depth", a, None, t * hour, 5.0 + t // 24 % 3 + 500.0 * (t == 200))]
        data += [("depth", b, None, t * hour, 5.0 + t // 24 % 3 + 500.0 * (t == 200)), ("still", a, None, t * hour, 7.0)]
        data += [("rare", key(), None, t * hour, 9.0 * (t == 200))]
    samples = spark.createDataFrame(data, "metric STRING, series STRING, le DOUBLE, us BIGINT, value DOUBLE")
    at = 200 * hour - 5 * 60 * S
    alerts = spark.createDataFrame(
        [("X", key(service="a"), at, at, at + 60 * S), ("Y", key(model="other", service="a"), at, at, at + 60 * S), ("Z", key(), at, at, at + 60 * S),
         ("P", key(service="a"), at, None, at + 60 * S), ("Q", key(service="a"), 0, 100, 3 * hour)],
        "alertname STRING, series STRING, active_us BIGINT, firing_us BIGINT, resolved_us BIGINT",
    )
    got = {(r.alertname, r.metric): r.peak for r in notify.spiking_metrics(alerts, samples).collect()}
    # A growing counter and a constant are no spikes; another model's series does not explain Y.
    assert {k for k in got} == {("X", "depth"), ("X", "rare"), ("Y", "rare"), ("Z", "depth"), ("Z", "rare")}
    assert got["X", "depth"] == 505.0 + 200 // 24 % 3 and got["X", "rare"] == 9.0
    assert notify.spiking_metrics(alerts.limit(0), samples).count() == 0


def test_rendered_texts(spark):
    df = spark.createDataFrame(
        [("slack-default", "sum", "warning", None, "desc", "url"), ("slack-ml-ops", "sum", "warning", "p", "desc", None)],
        "receiver STRING, summary STRING, severity STRING, pipeline STRING, description STRING, runbook_url STRING",
    )
    got = [r.t for r in df.select(notify.render_alert(F.col("receiver")).alias("t")).collect()]
    assert got[0] == "*Alert:* sum\n*Severity:* `warning`\n*Pipeline:* ``\n*Description:* desc\n*Runbook:* url\n"
    assert got[1] == "*Alert:* sum\n*Description:* desc\n"
    title = df.select(notify.title(F.lit("resolved"), F.col("summary"), F.col("receiver")).alias("t"))
    assert [r.t for r in title.collect()] == ["[RESOLVED] sum", "[ML-OPS RESOLVED] sum"]


def test_replaced_inputs_are_read_again(spark, tmp_path):
    from tidewatch.plans.samples import stored

    source = tmp_path / "in"
    source.mkdir()
    (source / "a").write_text("1")
    made = []

    def table(value):
        made.append(value)
        return spark.createDataFrame([(value, "x")], "v INT, by STRING")

    read = lambda value: [r.v for r in stored(spark, "memo", str(source), lambda: table(value), "by").collect()]
    assert read(1) == [1] and read(2) == [1] and made == [1]
    (source / "a").write_text("12")
    assert read(3) == [3] and made == [1, 3]


def test_every_derivable_rule_is_evaluated(spark):
    """The five metrics that are evaluated at scrape instants have samples, and their rules give alerts with texts."""
    from tidewatch.plans import registry

    registry.load_all()
    sf = "/root/testdata/sf0.001"
    seen = {r[0] for r in registry.QUERIES["telemetry_samples"](spark, sf).select("metric").distinct().collect()}
    metrics = {"agent_queue_depth", "agent_hallucinations_detected_total", "ml_data_drift_score", "ml_model_accuracy", "ml_feature_missing_rate"}
    assert metrics <= seen
    texts = registry.QUERIES["alert_texts"](spark, sf).collect()
    fired = {r.alertname for r in texts}
    assert {"MLDataDriftDetected", "MLModelAccuracyDrop", "MLHighFeatureMissingRate"} <= fired
    assert all(r.summary and r.description and "$" not in r.summary + r.description for r in texts)
    assert any("Feature: device_trust_score" in r.description for r in texts if r.alertname == "MLDataDriftDetected")


def test_queue_depth_and_hallucination_rules_fire(spark):
    """The tables stay below these thresholds; samples of the same metrics above them fire."""
    samples = [("agent_queue_depth", "service=agentic-pipeline", None, h * HOUR, 60.0) for h in range(1, 9)]
    samples += [("agent_hallucinations_detected_total", "agent_name=a,service=agentic-pipeline", None, h * HOUR, h * 4000.0) for h in range(1, 30)]
    df = spark.createDataFrame(samples, "metric string, series string, le double, us long, value double")
    df = df.withColumn("series", series_key(F.transform_values(F.str_to_map("series", F.lit(","), F.lit("=")), lambda _, v: v)))
    rules = [r.slowed(60) for r in RULES]
    got = al.alert_rows(al.evaluate_rules(df, rules, 300 * 60 * S), rules).where("state = 'firing'").collect()
    assert {r.alertname for r in got} == {"AgentQueueDepthGrowing", "AgentHallucinationSpike"}
    assert {r.description for r in got if r.alertname == "AgentQueueDepthGrowing"} == {"Queue depth: 60 pending tasks.\nConsider scaling up agent workers.\n"}


def test_health_query_has_all_bands(spark):
    from tidewatch.operators.search import HEALTH_BANDS
    from tidewatch.plans import registry

    registry.load_all()
    rows_ = registry.QUERIES["health_bands"](spark, "/root/testdata/sf0.01").collect()
    assert {r.metric for r in rows_} == {name for name, _, _ in HEALTH_BANDS} and all(r.band in ("Healthy", "Warning", "Critical") for r in rows_)


def test_seasonal_baseline_is_the_median_of_earlier_days(spark):
    data = [("m", d, h, float(v)) for d, h, v in [(0, 1, 10), (1, 1, 12), (2, 1, 1000), (3, 1, 11), (3, 2, 5), (12, 1, 7), (13, 1, 8)]]
    df = spark.createDataFrame(data, "model string, day long, slot int, value double")
    got = {(r.day, r.slot): r.baseline for r in ts.seasonal_baseline(df, ["model"], "day", "slot", "value", 7).collect()}
    assert got == {(0, 1): None, (1, 1): 10.0, (2, 1): 11.0, (3, 1): 12.0, (3, 2): None, (12, 1): None, (13, 1): 7.0}
