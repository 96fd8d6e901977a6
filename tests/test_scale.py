"""Hot keys, hot instants and close values: bounded rows per task and the same results."""

import datetime as dt
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewatch.functions.quantiles import exact_percentiles
from tidewatch.functions.scan import HOUR, MICROS, Running, merged_intervals, running, split_blocks, time_block, value_bin
from tidewatch.operators import metrics, notify, reports, traces
from tidewatch.operators.drift import ks_drift, ks_windows
from tidewatch.plans import samples, views


def largest_block(df):
    return df.groupBy("_key", "_block").count().agg(F.max("count")).first()[0]


def test_a_hot_instant_is_cut_at_edges_from_the_data(spark):
    """One service, all rows inside one second, half of them at one microsecond."""
    n, limit = 60_000, 4_000
    at = F.when(F.col("id") % 2 == 0, 500).otherwise(F.col("id") % 1000).cast("long")
    df = spark.range(n).select(F.lit("hot").alias("service"), at.alias("us"), "id").union(spark.range(50).select(F.lit(None), F.col("id") * HOUR, F.col("id") + n))
    placed = split_blocks(df, ["service"], ["us", "id"], time_block("us", HOUR), limit)
    assert placed.count() == n + 50 and largest_block(placed) <= limit
    got = running(df, ["service"], ["us", "id"], time_block("us", HOUR), {"i": Running("sum", F.lit(1).cast("long")), "last": Running("last", F.col("id"), inclusive=False)}, limit)
    data = sorted((r.us, r.id) for r in df.where("service = 'hot'").collect())
    want = {k: (i + 1, data[i - 1][1] if i else None) for i, (_, k) in enumerate(data)}
    assert {r.id: (r.i, r["last"]) for r in got.where("service = 'hot'").collect()} == want
    assert {r.i for r in got.where("service IS NULL").collect()} == set(range(1, 51))


def test_queue_depth_and_accuracy_of_a_hot_second(spark):
    rng = random.Random(1)
    work = [("s", i, rng.randrange(MICROS), 0) for i in range(3000)]
    work = [(s, i, a, a + rng.randrange(1, MICROS)) for s, i, a, _ in work]
    df = spark.createDataFrame(work, "service string, id long, start_us long, end_us long")
    moves = sorted([(a, 1, i) for _, i, a, _ in work] + [(b, -1, i) for _, i, _, b in work], key=lambda m: (m[0], m[1], m[2]))
    depth, want = 0, []
    for us, delta, i in moves:
        depth += delta
        want.append((us, delta, i, depth))
    got = metrics.queue_depth(df, ["service"], "start_us", "end_us", ["id"], limit=300)
    assert rows(got, "us", "delta", "id", "depth") == sorted(want)
    hits = [rng.random() < 0.6 for _ in work]
    scored = spark.createDataFrame([("m", i, 7, h) for (_, i, _, _), h in zip(work, hits)], "model string, id long, us long, hit boolean")
    rolled = metrics.rolling_accuracy(scored, ["model"], "us", ["id"], F.col("hit"), 100, limit=300)
    for i, share in rows(rolled, "id", "rolling_accuracy"):
        window = hits[max(0, i - 99) : i + 1]
        assert share == pytest.approx(sum(window) / len(window))


def test_percentiles_of_close_values_spread_over_tasks(spark):
    """All values share one bin."""
    n, limit = 200_000, 10_000
    df = spark.range(n).select((F.col("id") % 2).alias("g"), (1 + F.pmod(F.col("id") * 7919, F.lit(n)) * 1e-12).alias("v"))
    assert df.select(value_bin("v")).distinct().count() == 1
    placed = split_blocks(df, ["g"], ["v"], value_bin("v"), limit)
    assert placed.select("_block").distinct().count() >= 20 and largest_block(placed) <= limit
    probs = {"p0": 0.0, "p37": 0.37, "p99": 0.99, "p100": 1.0}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs, limit).collect()}
    for g in (0, 1):
        values = np.sort([1 + (i * 7919 % n) * 1e-12 for i in range(g, n, 2)])
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), abs=1e-15)


def test_drift_of_close_values(spark):
    rng = np.random.default_rng(0)
    a, b = 1 + rng.random(4000) * 1e-9, 1 + rng.random(4000) * 1.2e-9
    df = spark.createDataFrame([("f", float(v), False) for v in a] + [("f", float(v), True) for v in b], "feature string, value double, cur boolean")
    places = np.sort(np.concatenate((a, b)))
    want = np.abs(np.searchsorted(np.sort(a), places, "right") / 4000 - np.searchsorted(np.sort(b), places, "right") / 4000).max()
    assert ks_drift(df, F.col("cur"), limit=500).first().drift_score == pytest.approx(want)
    counted = df.groupBy("feature", "value", "cur").agg(F.count(F.lit(1)).alias("n"))
    assert ks_drift(counted, F.col("cur"), rows=F.col("n"), limit=500).first().drift_score == pytest.approx(want)
    day = df.where("cur").withColumn("day", F.lit(1))
    assert ks_windows(df.where("NOT cur"), day, "day", ["feature"], limit=500).first().drift_score == pytest.approx(want)


def test_drift_queries_read_the_counts_alone(spark):
    from tidewatch.plans import registry

    registry.load_all()
    for name, most in (("ks_drift", 2), ("ks_drift_daily", 2)):
        plan = registry.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") <= most, name


def test_merged_intervals(spark):
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), s, s + rng.randrange(0, 40)) for s in (rng.randrange(1000) for _ in range(300))]
    want = []
    for key in ("a", "b", None):
        stretch = None
        for s, e in sorted((s, e) for k, s, e in data if k == key):
            if stretch and s <= stretch[1]:
                stretch[1] = max(stretch[1], e)
            else:
                stretch = [s, e]
                want.append((key, stretch))
    df = spark.createDataFrame(data, "k string, s long, e long")
    for block in (7, 100, 10**6):
        assert rows(merged_intervals(df, ["k"], "s", "e", block)) == sorted(((k, *x) for k, x in want), key=lambda r: (r[0] is None, str(type(r[0])), r[0] or 0, r[1]))


def test_self_time_of_overlapping_children(spark):
    rng = random.Random(8)
    spans = [("t", "root", None, 0, 100.0), ("t", "x", "root", 0, 80.0), ("t", "y", "root", 10_000, 80.0), ("t", "lost", "nowhere", 0, 5.0)]
    for i in range(40):
        spans.append((f"r{i % 3}", f"s{i}", None if i < 3 else f"s{rng.randrange(3) * 3 % 3 + i % 3}", rng.randrange(50_000), float(rng.randrange(1, 60))))
    df = spark.createDataFrame(spans, "trace_id string, span_id string, parent_span_id string, start_us long, duration_ms double")
    for block in (9_000, HOUR):
        got = {(r.trace_id, r.span_id): r for r in traces.self_time(df, block).collect()}
        assert len(got) == len(spans) and got["t", "root"].self_ms == 10.0 and got["t", "root"].child_ms == 160.0
        for trace, span, _, start, length in spans:
            taken = set()
            for t, _, parent, s, d in spans:
                if (t, parent) == (trace, span):
                    taken |= set(range(max(s, start), min(s + int(d * 1000), start + int(length * 1000))))
            assert got[trace, span].covered_ms == pytest.approx(len(taken) / 1000)
            assert got[trace, span].self_ms == pytest.approx(length - len(taken) / 1000)


ALERT = "alertname string, severity string, team string, service string, pipeline string, firing_us long, resolved_us long"


def test_inhibition_scans_do_not_grow_with_the_rules(spark, tmp_path):
    spark.createDataFrame([("a", "critical", "t", "s", "p", 0, 9)], ALERT).write.parquet(f"{tmp_path}/alerts")
    alerts = spark.read.parquet(f"{tmp_path}/alerts")
    rules = [notify.Inhibition({"severity": "critical"}, ["service"], target={"team": f"t{i}"}) for i in range(4)]
    scans = {n: len(re.findall(r"Relation \[", notify.inhibit(alerts, rules[:n])._jdf.queryExecution().optimizedPlan().toString())) for n in (1, 2, 4)}
    assert set(scans.values()) == {2}


def test_inhibition_against_brute_force_keeps_repeated_alerts(spark):
    rng = random.Random(11)
    rules = [
        notify.Inhibition({"severity": "critical"}, ["service"], target={"severity": "warning"}),
        notify.Inhibition({"team": "a"}, ["service", "pipeline"], target_pattern={"alertname": "x.*"}),
        notify.Inhibition({"alertname": "y"}, [], target={"alertname": "y", "team": "b"}),
    ]
    pick = lambda *v: rng.choice(v)
    data = []
    for _ in range(70):
        a = rng.randrange(100)
        data.append((pick("x1", "x2", "y"), pick("critical", "warning"), pick("a", "b"), pick("s", "t", None), pick("p", None), a, a + rng.randrange(1, 30)))
    data += data[:15] + [("z", "warning", "b", "s", "p", None, 5)]
    names = ALERT.replace(" string", "").replace(" long", "").split(", ")

    def on(alert, rule, side):
        d = dict(zip(names, alert))
        if side == "source":
            return all(d[k] == v for k, v in rule.source.items())
        return all(d[k] == v for k, v in rule.target.items()) and all(re.fullmatch(p, d[k] or "") for k, p in rule.target_pattern.items())

    want = []
    firing = [d for d in data if d[5] is not None]
    for alert in firing:
        free = set(range(alert[5], alert[6]))
        for rule in rules:
            if on(alert, rule, "target"):
                for other in firing:
                    same = all(dict(zip(names, alert))[k] == dict(zip(names, other))[k] for k in rule.equal)
                    if same and on(other, rule, "source") and not (on(alert, rule, "source") and on(other, rule, "target")):
                        free -= set(range(other[5], other[6]))
        for t in sorted(free):
            if t - 1 not in free:
                end = t
                while end in free:
                    end += 1
                want.append((*alert[:5], t, end))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    for block in (8, 10**9):
        got = [tuple(r) for r in notify.inhibit(spark.createDataFrame(data, ALERT), rules, block).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)


def test_reports_read_the_logs_once(spark, tmp_path):
    schema = "ts TIMESTAMP, service STRING, model STRING, event STRING, level STRING, latency_ms INT"
    at = dt.datetime(2025, 1, 1, 10)
    values = [1, 2, 2, 7, None]
    data = [(at, "s", "m", "llm_inference_success", "ERROR" if v == 7 else "INFO", v) for v in values] + [(at, "t", "m", "llm_inference_success", "INFO", None)]
    path = str(tmp_path / "raw-logs")
    spark.createDataFrame(data, schema).write.parquet(path)
    logs = spark.read.parquet(path)
    rates = reports.error_rate(logs)
    tail = reports.latency_percentiles(logs)
    # What follows the counts of values reads those alone.
    assert not [f for df in (rates, tail) for f in df.inputFiles() if "raw-logs" in f]
    assert [tuple(r)[1:] for r in rates.collect()] == [("s", 5, 1, 20.0, 3.0, 6.85), ("t", 1, 0, 0.0, None, None)]
    s, t = sorted(tail.collect())
    assert (s.requests, s.p50_ms, s.min_ms, s.max_ms, s.avg_ms) == (5, 2.0, 1, 7, 3.0)
    assert (t.requests, t.p50_ms, t.min_ms, t.avg_ms) == (1, None, None, None)
    quick = reports.latency_percentiles(logs, approx=True)
    assert [(r.requests, r.min_ms, r.avg_ms) for r in sorted(quick.collect())] == [(5, 1, 3.0), (1, None, None)]


def test_agent_loops_beyond_the_broadcast_bound(spark, monkeypatch):
    schema = "ts TIMESTAMP, event STRING, session_id STRING, agent_name STRING, steps_taken INT, duration_ms INT, status STRING, step INT, tool_name STRING"
    at = dt.datetime(2025, 1, 1)
    data = [(at, "agent_session_completed", s, "a", 9, 5, "ok", None, None) for s in ("x", "y")]
    data += [(at, "agent_tool_call", "x", "a", None, None, None, i, f"t{i}") for i in (2, 1)]
    logs = spark.createDataFrame(data, schema)
    near = reports.agent_loops(logs).collect()
    monkeypatch.setattr(reports, "BROADCAST_SESSIONS", 0)
    assert reports.agent_loops(logs).collect() == near
    assert [(r.session_id, r.tool_call_sequence) for r in near] == [("x", "t1 → t2"), ("y", None)]


def test_samples_share_the_engineered_rows(spark, monkeypatch):
    """The rows that cost most are made once for all metrics, not once for each that reads them."""
    made = {"trailing_count": 0, "agent_sessions": 0}
    for name in made:
        plain = getattr(views, name)

        def counted(*args, plain=plain, name=name, **kwargs):
            made[name] += 1
            return plain(*args, **kwargs)

        monkeypatch.setattr(views, name, counted)
    monkeypatch.setattr(samples, "_WRITTEN", {})
    found = samples.derive_samples(spark, "/root/testdata/sf0.001")
    assert made == {"trailing_count": 1, "agent_sessions": 1}
    assert {"agent_queue_depth", "ml_model_accuracy", "ml_data_drift_score", "ml_feature_missing_rate"} <= {r[0] for r in found.select("metric").distinct().collect()}


def test_windows_of_few_values_are_one_block_each(spark, monkeypatch):
    """The totals of a window scan are as many as the windows, not as the values; a window above the limit is cut."""
    from bisect import bisect_right

    from tidewatch.operators import drift

    totals, scan = [], drift.running
    monkeypatch.setattr(
        drift, "running", lambda df, keys, order, block, *a: totals.append((keys, df.select(*keys, block.alias("b")).distinct().count())) or scan(df, keys, order, block, *a)
    )
    ref = [float(i * 7 % 900 + 1) for i in range(400)]
    cur = [(w, float((i * 37 + w * 11) % 1000 + 1)) for w in range(3) for i in range(300)]
    reference = spark.createDataFrame([("f", v) for v in ref], "feature string, value double")
    current = spark.createDataFrame([("f", w, v) for w, v in cur], "feature string, w long, value double")
    for limit in (1000, 40):
        got = {r.w: r.drift_score for r in drift.ks_windows(reference, current, "w", ["feature"], limit=limit).collect()}
        for w in range(3):
            mine, base = sorted(v for x, v in cur if x == w), sorted(ref)
            share = lambda values, at: bisect_right(values, at) / len(values)
            assert abs(got[w] - max(abs(share(mine, v) - share(base, v)) for v in [*mine, *base])) < 1e-12
    assert [n for keys, n in totals if "w" in keys] == [3, 3]
