"""Scans, malformed input, enrichment, search and relabelling."""

import datetime as dt
import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewatch.functions.labels import labels_of, render, series_key
from tidewatch.functions.timeparse import parse_event_time, time_range
from tidewatch.operators import enrich as en
from tidewatch.operators import relabel, search
from tidewatch.sources import logs as scans
from tidewatch.sources.schemas import LOG_SCHEMAS

LINES = [
    '{"timestamp":"2025-01-01T00:00:00Z","level":"error","service":"genai-pipeline","input_tokens":7}',
    "{bad",
    "",
    '{"timestamp":"2025-01-01T00:01:00Z","level":"INFO","unheard_of":1}',
    '{"timestamp":"2025-01-01T00:02:00Z","input_tokens":"x"}',
]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.json").write_text("\n".join(LINES))
    (tmp_path / "sub" / "b.json").write_text(LINES[0])
    return str(tmp_path)


def test_tolerant_scan_skips_malformed_lines(spark, folder):
    df = scans.scan_ndjson(spark, folder, "genai_logs", recursive=True)
    assert df.columns == [f.name for f in scans.struct_of(LOG_SCHEMAS["genai_logs"])]
    times = [r[0] for r in rows(df, "timestamp")]
    assert times.count("2025-01-01T00:00:00Z") == 2 and "2025-01-01T00:01:00Z" in times


def test_strict_scan_fails(spark, folder):
    with pytest.raises(Exception):
        scans.scan_ndjson(spark, f"{folder}/a.json", "kafka_consumer_offsets", tolerant=False).collect()


def test_split_keeps_rejects(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value STRING")
    good, bad = scans.split_malformed(lines, "genai_logs")
    assert [r[0] for r in rows(bad)] == [LINES[1]]
    assert good.count() == 3 and "unheard_of" not in good.columns
    assert rows(good.where("timestamp = '2025-01-01T00:02:00Z'"), "input_tokens") == [(None,)]


def test_every_projection_counts_alike(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"service":"s","step":1}\n{"service":"t","step":"bad"}\n{"service":"u","st\n[]\nnull\n')
    df = scans.scan_ndjson(spark, str(tmp_path), "agent_logs")
    assert rows(df, "service", "step") == [("s", 1), ("t", None)]
    assert df.count() == len(df.collect()) == df.select("service").count() == df.select("step").count() == 2
    rejects = scans.scan_rejects(spark, str(tmp_path), "agent_logs").collect()
    assert sorted(r.line for r in rejects) == ["[]", "null", '{"service":"u","st'] and all(r.file.endswith("a.json") for r in rejects)


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value STRING")
    good, _ = scans.split_malformed(lines, "genai_logs")
    plan = good.where("level = 'INFO'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_json_paths_cast_safely(spark, folder):
    df = scans.scan_lines(spark, folder, "genai_logs")
    got = rows(df.where("timestamp = '2025-01-01T00:02:00Z'"), "timestamp", "input_tokens")
    assert got == [("2025-01-01T00:02:00Z", None)]


def test_partitioned_scan_prunes(spark, tmp_path):
    for day in ("01", "02", "03"):
        p = tmp_path / "year=2025" / "month=01" / f"day={day}"
        p.mkdir(parents=True)
        (p / "x.json").write_text(json.dumps({"timestamp": f"2025-01-{day}T10:00:00Z", "transaction_id": day, "is_fraud": True}))
    df = scans.normalise(scans.scan_ml_logs(spark, str(tmp_path)))
    assert dict(df.dtypes)["day"] == "string"
    picked = time_range(df, "2025-01-02 00:00:00", "2025-01-02 23:00:00")
    assert rows(picked, "transaction_id") == [("02",)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_tables_and_views(spark, tmp_path):
    for table in LOG_SCHEMAS:
        p = tmp_path / table / ("year=2025/month=01/day=01" if table == "ml_logs" else ".")
        p.mkdir(parents=True, exist_ok=True)
        (p / "x.json").write_text('{"timestamp":"2025-01-01T00:00:00Z","level":"warning"}')
    scans.register_tables(spark, str(tmp_path), "probe_db")
    assert spark.table("probe_db.ml_logs").count() == 1
    scans.register_views(spark, str(tmp_path))
    assert spark.sql("SELECT level FROM genai_logs").first()[0] == "WARNING"


def test_event_times(spark):
    texts = ["2025-01-01T00:00:00Z", "2025-01-01T02:00:00+02:00", "1735689600.5", "garbage"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select(F.unix_micros(parse_event_time("t")).alias("us"))
    assert [r.us for r in df.collect()] == [1735689600_000000, 1735689600_000000, 1735689600_500000, None]


def test_container_lines(spark):
    inner = json.dumps({"tag": "a_b_c0ffee"})
    data = [
        json.dumps({"log": "hello", "stream": "stdout", "time": "2025-01-01T00:00:00.123456789Z", "attrs": inner}),
        json.dumps({"log": "bye", "stream": "stderr", "time": "nonsense", "attrs": {"tag": "none"}}),
    ]
    df = scans.parse_container_lines(spark.createDataFrame([(x,) for x in data], "value STRING"))
    got = {r.output: r for r in df.collect()}
    assert (got["hello"].container_name, got["hello"].container_id, got["hello"].stream) == ("a_b_c0ffee", "c0ffee", "stdout")
    assert got["hello"].ts == dt.datetime(2025, 1, 1, 0, 0, 0, 123456)
    assert (got["bye"].ts, got["bye"].container_name) == (None, None)


def enriched(spark, **fields):
    schema = ", ".join(f"{k} {'DOUBLE' if isinstance(v, float) else 'INT' if isinstance(v, int) else 'STRING'}" for k, v in fields.items())
    return en.enrich(spark.createDataFrame([tuple(fields.values())], schema)).first()


def test_enrichment_rules(spark):
    slow = enriched(spark, service="genai-pipeline", latency_ms=5000.1, level="critical", model="m", environment="staging")
    assert slow.tags == ["genai", "llm", "slow_llm_call"] and slow.anomaly == "high_latency"
    assert slow.is_error and slow.level == "CRITICAL" and slow.environment == "staging" and slow.llm_model == "m"
    assert enriched(spark, service="genai-pipeline", duration_ms=5000.0).anomaly is None
    assert enriched(spark, pipeline_type="genai", error_type="rate_limit_error").tags == ["genai", "llm", "rate_limited"]
    stuck = enriched(spark, service="agentic-pipeline", agent_steps=21)
    assert stuck.tags == ["agentic", "llm", "agent_loop_suspected"] and stuck.anomaly == "too_many_steps"
    assert enriched(spark, service="ml-pipeline", prediction_confidence=0.59).anomaly == "low_model_confidence"
    other = enriched(spark, service="else", level="ERROR")
    assert other.tags == [] and other.environment == "production" and other.cluster == "ai-pipelines"


def test_routing_includes_critical(spark):
    df = spark.createDataFrame(
        [("2025-01-01T00:00:00Z", "CRITICAL"), ("2025-01-01T00:00:00Z", "INFO")], "timestamp STRING, level STRING"
    )
    got = [r[0] for r in rows(en.route_to_indices(en.enrich(df)), "index")]
    assert got == ["pipeline-errors-2025.01.01", "pipeline-logs-2025.01.01", "pipeline-logs-2025.01.01"]


def test_ip_ranges(spark):
    hits = spark.createDataFrame(
        [(1, "10.0.255.255"), (2, "10.1.0.0"), (3, "10.9.9.9"), (4, "not an ip"), (5, None), (6, "10.1.300.1")], "event_id INT, client_ip STRING"
    )
    n = lambda a, b, c, d: ((a * 256 + b) * 256 + c) * 256 + d
    ranges = spark.createDataFrame(
        [(n(10, 0, 200, 0), n(10, 2, 10, 0), "X"), (n(10, 2, 10, 1), n(10, 3, 0, 0), "Y")], "start_ip BIGINT, end_ip BIGINT, region STRING"
    )
    got = en.locate_ips(hits, ranges).select("event_id", "geoip.region")
    assert rows(got) == [(1, "X"), (2, "X"), (3, None), (4, None), (5, None), (6, None)]


def test_address_keys_against_the_standard_library(spark):
    texts = ["::", "::1", "1::", "2001:DB8::ff00:42:8329", "2001:db8:0:0:1:0:0:1", "::ffff:10.1.2.3", "64:ff9b::192.0.2.33", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8",
             "1:2:3:4:5:6:1.2.3.4", "10.0.0.1", "255.255.255.255", "1:2:3", "1::2::3", ":::", "12345::", "g::", "::ffff:10.1.2.300", "::1.2.3", "1:2:3:4:5:6:7:8:9",
             "1:2:3:4:5:6:7:8::", ":1:2:3:4:5:6:7", "10.0.0", "10.0.0.256", "", "not an ip", None, "1.2.3.4::", "::1.2.3.4:5"]

    def want(text):
        try:
            a = ipaddress.ip_address(text)
        except ValueError:
            return None
        return f"{int(a) if a.version == 6 else int(a) + 0xFFFF00000000:032x}"

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, ip STRING").select("i", "ip", en.address_key("ip").alias("key"))
    assert {r.ip: r.key for r in df.collect()} == {t: want(t) for t in texts}


def test_longest_network(spark):
    rng = random.Random(3)
    nets = [("::/0", "all"), ("10.0.0.0/8", "ten"), ("10.1.0.0/17", "half"), ("10.1.2.3", "one"), ("2001:db8::/32", "doc"), ("2001:db8:8000::/33", "upper"),
            ("2001:db8:ffff::1/47", "host bits"), ("10.0.0.0/8", "zen"), ("10.0.0.0/33", "bad"), ("bad/8", "bad"), ("10.0.0.0/8/8", "bad"), (None, "bad")]
    ips = [f"10.{rng.choice([0, 1])}.{rng.choice([2, 127, 128])}.{rng.choice([3, 4])}" for _ in range(40)]
    ips += [f"2001:db8:{rng.choice([0, 0x7fff, 0x8000, 0xfffe, 0xffff]):x}::{rng.randrange(9)}" for _ in range(40)] + ["::ffff:10.1.2.3", "9.9.9.9", "x", None]

    def want(text):
        try:
            a = ipaddress.ip_address(text)
        except ValueError:
            return None
        held = []
        for net, area in nets[:8]:
            n = ipaddress.ip_network(net, strict=False)
            wide = int(n.network_address) + (0xFFFF00000000 if n.version == 4 else 0)
            bits = n.prefixlen + (96 if n.version == 4 else 0)
            own = int(a) + (0xFFFF00000000 if a.version == 4 else 0)
            if own >> (128 - bits) == wide >> (128 - bits):
                held.append((-bits, area))
        return min(held)[1] if held else None

    hits = spark.createDataFrame(list(enumerate(ips)), "event_id INT, client_ip STRING")
    networks = spark.createDataFrame(nets, "network STRING, area STRING")
    got = {r.event_id: r.area for r in en.locate_networks(hits, networks).select("event_id", "geoip.area").collect()}
    assert got == {i: want(t) for i, t in enumerate(ips)}
    none = en.locate_networks(hits, networks.limit(0))
    assert none.count() == len(ips) and none.where("geoip IS NOT NULL").count() == 0


def test_search_window(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, h), "ERROR") for h in range(4)], "ts TIMESTAMP, level STRING")
    assert search.search_logs(df, level="ERROR", now="2025-01-01 03:00:00", within="1 hour").count() == 1


def test_health_bands(spark):
    data = [("error_rate_pct", 0.5), ("error_rate_pct", 5.0), ("error_rate_pct", 5.1), ("queue_depth", 5.0), ("queue_depth", 51.0),
            ("session_success_pct", 96.0), ("session_success_pct", 90.0), ("session_success_pct", 80.0), ("rate_limit_per_s", 0.0)]
    df = search.health_bands(spark.createDataFrame(data, "metric STRING, value DOUBLE"))
    assert [r.band for r in df.collect()] == ["Healthy", "Warning", "Critical", "Healthy", "Critical", "Healthy", "Warning", "Critical", "Healthy"]


def test_labels(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1"}, "host:9100", "ml-pipeline")], "labels MAP<STRING,STRING>, address STRING, job STRING")
    out = relabel.constant_labels(relabel.instance_from_address(df)).select(render("labels").alias("l"), series_key("labels").alias("s"))
    row = out.select("l", render(labels_of("s")).alias("again")).first()
    assert row.l == row.again == "a=1,b=2,instance=host,pipeline_type=ml,service=ml-pipeline"
    kept = df.select(render(relabel.keep_missing(F.col("labels"), {"a": "9", "c": "3"})).alias("l")).first()
    assert kept.l == "a=1,b=2,c=3"


def test_sample_and_span_scans(spark, tmp_path):
    t = dt.datetime(2025, 1, 1)
    spark.createDataFrame([(t, "up", {"job": "x"}, None, 0.0)], "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, le DOUBLE, value DOUBLE").write.parquet(f"{tmp_path}/s")
    got = scans.scan_samples(spark, f"{tmp_path}/s").first()
    assert got.series == '[{"key":"job","value":"x"}]' and got.us == 1735689600_000000
    span = {"trace_id": "t", "span_id": "a", "start_ts": "2025-01-01T00:00:00Z", "duration_ms": 5.0, "attributes": {"request.id": "req-1"}}
    (tmp_path / "sp").mkdir()
    (tmp_path / "sp" / "x.json").write_text(json.dumps(span))
    row = scans.scan_spans(spark, f"{tmp_path}/sp", "json").first()
    assert (row.request_id, row.start_us, row.tool_name) == ("req-1", 1735689600_000000, None)
