"""Streams: state across batches, exports, rejects, scoring, drift."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewatch.operators.drift import ks_drift, ks_windows, long_values
from tidewatch.operators.features import FEATURE_NAMES, fraud_label, missing_rates
from tidewatch.operators.scoring import accuracy, score, train
from tidewatch.sources import logs as scans
from tidewatch.sources.schemas import STREAM_EVENT
from tidewatch.streaming import jobs, states

S = 1_000_000
MIN = 60 * S


def write_batches(spark, folder, schema, batches):
    """One file per batch, in a known order."""
    for i, data in enumerate(batches):
        path = f"{folder}/in"
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
        newest = max((os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")), key=os.path.getmtime)
        stamp = time.time() - 1000 + i * 10
        os.utime(newest, (stamp, stamp))
    return f"{folder}/in"


def run(spark, folder, stream, name="out"):
    jobs.run_now(stream, f"{folder}/{name}", f"{folder}/ck-{name}")
    return spark.read.schema(stream.schema).parquet(f"{folder}/{name}")


def test_alert_states_cross_batches(spark, tmp_path):
    schema = "alertname STRING, series STRING, eval_us BIGINT, active BOOLEAN, value DOUBLE, every_us BIGINT, hold_us BIGINT, eval_ts TIMESTAMP"

    def evaluation(minute, active, series="s"):
        return ("A", series, minute * MIN, active, float(minute), MIN, 2 * MIN, dt.datetime.fromtimestamp(minute * 60))

    batches = [
        [evaluation(1, True), evaluation(2, True)],
        [evaluation(3, True), evaluation(4, False)],
        [evaluation(5, True), evaluation(6, False), evaluation(5, True, "quiet"), evaluation(6, True, "quiet"), evaluation(7, True, "quiet")],
        [evaluation(100, False, "clock")],
        [evaluation(101, False, "clock")],
    ]
    path = write_batches(spark, str(tmp_path), schema, batches)
    stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withWatermark("eval_ts", "1 minute")
    got = run(spark, str(tmp_path), states.alert_transitions(stream))
    assert rows(got.where("series = 's'"), "at_us", "state", "active_us") == [
        (1 * MIN, "pending", 1 * MIN),
        (3 * MIN, "firing", 1 * MIN),
        (4 * MIN, "resolved", 1 * MIN),
        (5 * MIN, "pending", 5 * MIN),
    ]
    assert rows(got.where("series = 'quiet'"), "at_us", "state") == [(5 * MIN, "pending"), (7 * MIN, "firing"), (8 * MIN, "resolved")]


def test_evaluations_out_of_order_fire_once(spark, tmp_path):
    schema = "alertname STRING, series STRING, eval_us BIGINT, active BOOLEAN, value DOUBLE, every_us BIGINT, hold_us BIGINT, eval_ts TIMESTAMP"

    def at(second, series="s"):
        return ("A", series, second * S, True, 1.0, 60 * S, 180 * S, dt.datetime.fromtimestamp(second, dt.timezone.utc).replace(tzinfo=None))

    for n, cuts in enumerate(([[1000, 1060, 1180], [1120, 1240]], [[1000, 1060, 1120, 1180, 1240]])):
        root = tmp_path / str(n)
        root.mkdir()
        path = write_batches(spark, str(root), schema, [*[[at(s) for s in cut] for cut in cuts], [at(9000, "clock")], [at(9100, "clock")]])
        stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withWatermark("eval_ts", "10 minutes")
        got = run(spark, str(root), states.alert_transitions(stream))
        assert rows(got.where("series = 's'"), "at_us", "state") == [(1000 * S, "pending"), (1180 * S, "firing"), (1300 * S, "resolved")]


def test_notification_timers(spark, tmp_path):
    schema = (
        "receiver STRING, group_key STRING, state STRING, at_us BIGINT, group_wait INT, group_interval INT, repeat_interval INT, at_ts TIMESTAMP"
    )

    def change(second, state, key="g"):
        return ("slack-ml-ops", key, state, second * S, 30, 300, 600, dt.datetime.fromtimestamp(second))

    batches = [
        [change(1000, "firing"), change(1120, "firing")],
        [change(1180, "resolved")],
        [change(2000, "firing", "clock")],
        [change(2260, "resolved")],
        [change(9000, "firing", "clock")],
        [change(9001, "firing", "clock")],
    ]
    path = write_batches(spark, str(tmp_path), schema, batches)
    stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withWatermark("at_ts", "1 second")
    got = run(spark, str(tmp_path), states.notification_timers(stream))
    assert rows(got.where("group_key = 'g'"), "sent_us", "reason", "status") == [
        (1030 * S, "news", "firing"),
        (1330 * S, "news", "firing"),
        (1930 * S, "repeat", "firing"),
        (2530 * S, "end", "resolved"),
    ]


def test_transitions_out_of_order_give_the_same_notices(spark, tmp_path):
    schema = (
        "receiver STRING, group_key STRING, state STRING, at_us BIGINT, group_wait INT, group_interval INT, repeat_interval INT, at_ts TIMESTAMP"
    )

    def change(second, state, key="g"):
        at = dt.datetime.fromtimestamp(second, dt.timezone.utc).replace(tzinfo=None)
        return ("slack-ml-ops", key, state, second * S, 30, 300, 600, at)

    fire, over, clock = change(1000, "firing"), change(1200, "resolved"), change(9000, "firing", "clock")
    more = [change(1100, "firing"), change(1150, "resolved"), change(1400, "resolved")]
    last = [[clock], [change(9100, "firing", "clock")]]
    for n, (cuts, ends) in enumerate([
        ([[over], [fire]], [(1030, "news"), (1330, "end")]),
        ([[fire, over]], [(1030, "news"), (1330, "end")]),
        ([[over], [fire]] + [[change(900, "resolved")]], [(1030, "news"), (1330, "end")]),
        ([[fire], [more[1], more[2]], [more[0]]], [(1030, "news"), (1330, "news"), (1630, "end")]),
        ([[fire, *more]], [(1030, "news"), (1330, "news"), (1630, "end")]),
    ]):
        root = tmp_path / str(n)
        root.mkdir()
        path = write_batches(spark, str(root), schema, [*cuts, *last])
        stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withWatermark("at_ts", "10 minutes")
        got = run(spark, str(root), states.notification_timers(stream))
        assert rows(got.where("group_key = 'g'"), "sent_us", "reason") == [(at * S, reason) for at, reason in ends], n


def test_duplicates_across_batches(spark, tmp_path):
    schema = "request_id STRING, ts TIMESTAMP"
    t = dt.datetime(2025, 1, 1)
    path = write_batches(spark, str(tmp_path), schema, [[("a", t), ("a", t)], [("a", t), ("b", t)]])
    stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
    assert rows(run(spark, str(tmp_path), jobs.deduplicated(stream, ["request_id"])), "request_id") == [("a",), ("b",)]


def test_index_splits_errors_and_rejects(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    first = [
        {"timestamp": "2025-01-01T10:00:00Z", "service": "genai-pipeline", "level": "error"},
        {"timestamp": 1735725600.5, "service": "ml-pipeline", "level": "INFO", "confidence": 0.1},
        {"timestamp": "never", "service": "x", "level": "INFO"},
    ]
    second = [
        {"timestamp": "2025-01-01T09:00:00Z", "service": "x", "level": "INFO"},
        {"timestamp": "2025-01-01T10:05:00Z", "service": "x", "level": "CRITICAL"},
    ]
    for i, batch in enumerate((first, second)):
        (folder / f"{i}.json").write_text("\n".join(map(json.dumps, batch)))
        os.utime(folder / f"{i}.json", (time.time() - 100 + i * 10,) * 2)
    stream = scans.read_pushed_lines(spark, str(folder), max_files=1)
    root = str(tmp_path / "index")
    jobs.index_logs(stream, root, f"{root}/ck", availableNow=True).awaitTermination()
    read = lambda name, cols: spark.read.schema(cols).json(f"{root}/{name}")
    assert rows(read("logs", "service STRING"), "service") == [("genai-pipeline",), ("ml-pipeline",), ("x",)]
    assert rows(read("errors", "service STRING"), "service") == [("genai-pipeline",), ("x",)]
    assert rows(read("rejects", "reject_reason STRING"), "reject_reason") == [("late",), ("no time",)]


def index_rows(spark, hours, **changes):
    """Log rows of day 1 at the given hours; an hour of None has no time."""
    stamp = lambda h: None if h is None else f"2025-01-{1 + h // 24:02d}T{h % 24:02d}:00:00Z"
    lines = [json.dumps({"timestamp": stamp(h), "service": f"s{h}", "level": changes.get("level", "INFO")}) for h in hours]
    return spark.read.schema(STREAM_EVENT).json(spark.sparkContext.parallelize(lines)).withColumn("type", F.lit("pipeline_log"))


def test_index_folders_ledger_and_repeated_batches(spark, tmp_path):
    root = str(tmp_path / "index")
    write = jobs.index_batch(root)
    batches = [index_rows(spark, [10, 30], level="ERROR"), index_rows(spark, [None]), index_rows(spark, [11, 31])]
    for i, batch in enumerate(batches):
        write(batch, i)
    write(batches[2], 2)  # a repeated batch replaces its own folders
    schema = "service STRING"
    assert rows(jobs.read_index(spark, root, "logs", schema), "service", "batch") == [("s10", 0), ("s30", 0), ("s31", 2)]
    assert rows(jobs.read_index(spark, root, "errors", schema), "service") == [("s10",), ("s30",)]
    # Batch 1 has no time of its own: the ledger carries the newest one on, and hour 11 is late in batch 2.
    assert rows(spark.read.schema("reject_reason STRING").json(f"{root}/rejects"), "reject_reason") == [("late",), ("no time",)]
    entry = lambda i: spark.read.schema("newest TIMESTAMP").json(f"{root}/progress/batch={i}").collect()
    assert [len(entry(i)) for i in range(3)] == [1, 1, 1] and entry(0) == entry(1) < entry(2)
    # The last entry alone is read, and a day is one folder.
    assert sorted(f for f in os.listdir(f"{root}/logs") if not f.startswith((".", "_"))) == ["log_date=2025-01-01", "log_date=2025-01-02"]
    day = jobs.read_index(spark, root, "logs", schema, "2025-01-02")
    assert rows(day, "service", "batch") == [("s30", 0), ("s31", 2)]
    assert all("log_date=2025-01-02" in f for f in day.inputFiles())


def test_index_writes_few_files_of_many_tasks(spark, tmp_path):
    root = str(tmp_path / "index")
    jobs.index_batch(root)(index_rows(spark, [h % 20 for h in range(200)]).repartition(8), 0)
    files = os.listdir(f"{root}/logs/log_date=2025-01-01/batch=0")
    assert len([f for f in files if f.endswith(".json")]) == 1


def flushes(lines, size, every):
    """Brute force: a buffer per key, emptied when full and at every tick."""
    out, held = [], {}
    for key, us, i, text in sorted((r[0], r[1], r[2], r[3]) for r in lines if r[3] is not None):
        tick = us // every
        h = held.setdefault(key, {"tick": tick, "rows": [], "part": 0})
        if h["tick"] != tick:
            if h["rows"]:
                out.append((key, h["tick"], h["part"], "time", (h["tick"] + 1) * every, "\n".join(h["rows"])))
            h.update(tick=tick, rows=[], part=0)
        h["rows"].append(text)
        if len(h["rows"]) == size:
            out.append((key, tick, h["part"], "size", us, "\n".join(h["rows"])))
            h.update(rows=[], part=h["part"] + 1)
    return sorted(out + [(k, h["tick"], h["part"], "time", (h["tick"] + 1) * every, "\n".join(h["rows"])) for k, h in held.items() if h["rows"]])


def test_flush_by_size_or_time(spark, tmp_path):
    schema = "source STRING, shard BIGINT, us BIGINT, row_id BIGINT, line STRING, ts TIMESTAMP"

    def row(source, second, i, line=""):
        return (source, 0, second * S, i, f"{source}{i}" if line == "" else line, dt.datetime.fromtimestamp(second))

    whole = [row("a", 1200 + i % 50, i) for i in range(230)]  # two full buffers before the tick, 30 lines at it
    whole += [row("a", 1260, 900), row("a", 1319, 901), row("b", 1201, 1), row("b", 1500, 2), row("b", 1501, 3, None), row("c", 1210, 5), row("c", 1210, 4)]
    whole += [row("full", 1200, i) for i in range(100)]  # a full buffer leaves nothing for the tick
    want = flushes([(r[0], r[2], r[3], r[4]) for r in whole], 100, MIN)
    assert [(w[0], w[3]) for w in want] == [("a", "size"), ("a", "size"), ("a", "time"), ("a", "time"), ("b", "time"), ("b", "time"), ("c", "time"), ("full", "size")]
    end = [[row("clock", 90_000, 1)], [row("clock", 90_001, 2)]]
    for n, batches in enumerate(([whole], [whole[::-2], whole[-2::-2]])):
        root = tmp_path / str(n)
        root.mkdir()
        path = write_batches(spark, str(root), schema, [*batches, *end])
        stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withWatermark("ts", "10 minutes")
        got = run(spark, str(root), states.buffered_flushes(stream, 100, MIN)).where("source <> 'clock'")
        assert rows(got, "source", "tick", "part", "reason", "flushed_us", "body") == want
        if not n:
            out = str(root / "export")
            for _ in range(2):  # a repeated batch replaces its own folders
                jobs.export_batch(out)(got, 0)
            assert spark.read.text(out).count() == len([r for r in whole if r[4] is not None])
            assert os.path.isdir(f"{out}/year=1970/month=01/day=01")
    with pytest.raises(ValueError):
        states.buffered_flushes(stream, 0, MIN)


def test_flush_tables_hold_no_key_whole(spark, tmp_path):
    """The same buffers as the brute force, however the lines are cut into batches, and no keyed Python state."""
    schema = "source STRING, shard BIGINT, us BIGINT, row_id BIGINT, line STRING, ts TIMESTAMP"

    def row(source, second, i, line=""):
        return (source, 0, second * S, i, f"{source}{i}" if line == "" else line, dt.datetime.fromtimestamp(second))

    whole = [row("a", 1200 + i % 50, i) for i in range(230)] + [row("a", 1260, 900), row("a", 1319, 901), row("b", 1500, 2), row("b", 1501, 3, None)]
    whole += [row("full", 1200, i) for i in range(100)] + [row(None, 1210, 5), row(None, 1210, 4)]
    # Open buffers and counted parts pass from batch to batch: of the last tick a half is ready, then the rest.
    split = [row("late", 3600 + i // 10, i) for i in range(590)]
    end = [[row("clock", 90_000, 1)], [row("clock", 90_001, 2)]]
    want = flushes([("" if r[0] is None else r[0], r[2], r[3], r[4]) for r in whole + split], 100, MIN)
    step = [[row("clock", 3600 + 600 + s, s)] for s in (7, 25, 26)]
    for n, batches in enumerate(([whole + split], [whole[::-2], whole[-2::-2] + split, *step])):
        root = tmp_path / str(n)
        root.mkdir()
        path = write_batches(spark, str(root), schema, [*batches, *end])
        stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
        jobs.flush_lines(stream, f"{root}/out", f"{root}/ck", 100, MIN, availableNow=True).awaitTermination()
        got = jobs.read_flushes(spark, f"{root}/out").where("source IS NULL OR source <> 'clock'").withColumn("source", F.coalesce("source", F.lit("")))
        assert rows(got, "source", "tick", "part", "reason", "flushed_us", "body") == want
    with pytest.raises(ValueError):
        jobs.flush_batch("x", 0, MIN)


def test_export_partitions_by_day(spark, tmp_path):
    schema = "ts TIMESTAMP, event STRING"
    path = write_batches(spark, str(tmp_path), schema, [[(dt.datetime(2025, 1, 1), "a"), (dt.datetime(2025, 1, 2), "b")]])
    stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema)
    out = str(tmp_path / "out")
    jobs.export_ndjson(stream, out, f"{out}-ck").trigger(availableNow=True).start().awaitTermination()
    assert os.path.isdir(f"{out}/year=2025/month=01/day=02")
    assert spark.read.json(out).count() == 2


def test_system_tail_and_messages(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "syslog.log").write_text("one\ntwo\n")
    got = run(spark, str(tmp_path), scans.tail_system_logs(spark, str(folder)))
    assert [(r[0], r[1].endswith("syslog.log"), r[2]) for r in rows(got)] == [("varlogs", True, "one"), ("varlogs", True, "two")]
    value = jobs.as_messages(spark.createDataFrame([("a", 1)], "event_type STRING, steps_taken INT")).first().value
    assert json.loads(value) == {"event_type": "a", "steps_taken": 1}
    assert "client_ip" in STREAM_EVENT


def features(spark, n, shift=0.0):
    df = spark.range(n).select(
        F.concat(F.lit("tx-"), F.col("id").cast("string")).alias("transaction_id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double") + shift).alias("transaction_amount"),
        F.pmod(F.col("id"), F.lit(24)).cast("int").alias("hour_of_day"),
        F.pmod(F.col("id"), F.lit(7)).cast("int").alias("day_of_week"),
        F.pmod(F.col("id"), F.lit(20)).cast("int").alias("merchant_category"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3650)).cast("int").alias("user_age_days"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(14)).cast("int").alias("tx_count_24h"),
        F.lit(0.5).alias("amount_deviation"),
        (F.pmod(F.col("id"), F.lit(3)) == 0).alias("is_international"),
        F.lit(0.8).alias("device_trust_score"),
        F.lit(dt.datetime(2025, 1, 1)).cast("timestamp").alias("ts"),
    )
    return df


def test_scoring_batch_equals_stream(spark, tmp_path):
    rows_in = features(spark, 600)
    labelled = rows_in.withColumn("label", fraud_label())
    model = train(labelled, trees=5)
    assert accuracy(model, labelled) > 0.8
    batch = score(model, rows_in)
    path = str(tmp_path / "in")
    rows_in.write.parquet(path)
    stream = jobs.score_stream(model, jobs.event_stream(spark, path, rows_in.schema))
    columns = ["transaction_id", "is_fraud", "fraud_probability", "confidence", "features_used"]
    assert rows(run(spark, str(tmp_path), stream), *columns) == rows(batch, *columns)
    assert all(r.confidence >= 0.5 for r in batch.collect())


def test_streaming_drift(spark, tmp_path):
    features(spark, 500).write.parquet(str(tmp_path / "reference"))
    current = features(spark, 300, shift=500.0)
    current.write.parquet(str(tmp_path / "in"))
    stream = jobs.event_stream(spark, str(tmp_path / "in"), current.schema)
    body = jobs.drift_batch(str(tmp_path / "reference"), str(tmp_path / "out"))
    stream.writeStream.foreachBatch(body).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = dict(rows(spark.read.parquet(str(tmp_path / "out")), "feature", "drift_score"))
    assert set(got) == set(FEATURE_NAMES)
    assert got["transaction_amount"] > 0.4 and got["hour_of_day"] < 0.1 and got["amount_deviation"] == 0.0


def test_drift_of_a_day_in_several_batches(spark, tmp_path):
    features(spark, 500).write.parquet(str(tmp_path / "reference"))
    day = features(spark, 300, shift=200.0)
    other = day.limit(50).withColumn("ts", F.lit(dt.datetime(2025, 1, 2)).cast("timestamp"))
    low, high = F.col("transaction_amount") < 700, F.col("transaction_amount") >= 700
    write = jobs.drift_batch(str(tmp_path / "reference"), str(tmp_path / "out"))
    for i, part in enumerate((day.where(low), day.where(high).unionByName(other))):
        write(part, i)
    write(day.where(high).unionByName(other), 1)  # a repeated batch counts once
    got = spark.read.parquet(str(tmp_path / "out"))
    whole = day.unionByName(other).withColumn("log_date", F.to_date("ts"))
    want = ks_windows(long_values(features(spark, 500), FEATURE_NAMES), long_values(whole, FEATURE_NAMES, ["log_date"]), "log_date", ["feature"])
    columns = ["log_date", "feature", "reference_rows", "current_rows", "drift_score"]
    assert rows(got, *columns) == rows(want, *columns)
    assert got.where("feature = 'transaction_amount'").count() == 2


def ks(a, b):
    points = sorted(set(a) | set(b))
    share = lambda xs, p: sum(x <= p for x in xs) / len(xs)
    return max(abs(share(a, p) - share(b, p)) for p in points)


def test_ks_properties(spark):
    a, b = [1.0, 2.0, 2.0, 5.0, -3.0], [2.0, 2.5, 9.0]
    df = spark.createDataFrame([("f", x, False) for x in a] + [("f", x, True) for x in b], "feature STRING, value DOUBLE, cur BOOLEAN")
    assert ks_drift(df, F.col("cur")).first().drift_score == pytest.approx(ks(a, b))
    same = df.where("NOT cur").unionByName(df.where("NOT cur").withColumn("cur", F.lit(True)))
    assert ks_drift(same, F.col("cur")).first().drift_score == 0
    days = spark.createDataFrame([(1, x) for x in b] + [(2, x) for x in [0.0, 7.0]] + [(3, 1.0)], "day INT, value DOUBLE")
    got = ks_windows(df.where("NOT cur").select("value"), days, "day")
    assert dict(rows(got, "day", "drift_score")) == {
        1: pytest.approx(ks(a, b)), 2: pytest.approx(ks(a, [0.0, 7.0])), 3: pytest.approx(ks(a, [1.0]))
    }
    lone = spark.createDataFrame([("f", 1.0, False), ("f", 3.0, False), ("f", 2.0, True), ("g", 1.0, True)], "feature STRING, value DOUBLE, cur BOOLEAN")
    assert rows(ks_drift(lone, F.col("cur"))) == [("f", 2, 1, 0.5), ("g", 0, 1, None)]


def test_missing_rates_count_nan_and_null(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), None), (None, 2), (2.0, 3)], "a DOUBLE, b INT")
    assert rows(missing_rates(df, ["a", "b"]), "feature_name", "missing", "missing_rate") == [("a", 2, 0.5), ("b", 1, 0.25)]
    assert long_values(df, ["a", "b"]).count() == 5


def test_sessions_end_by_event_or_gap(spark, tmp_path):
    schema = "session_id STRING, us BIGINT, row_id BIGINT, agent_name STRING, failed BOOLEAN, completes BOOLEAN, ts TIMESTAMP"

    def row(second, i=0, key="s", failed=False, completes=False, agent="a"):
        return (key, second * S, i, agent, failed, completes, dt.datetime.fromtimestamp(second))

    whole = [
        row(1000), row(1010, failed=True), row(1020, completes=True),  # closed by its event
        row(1030), row(1040), row(1200),  # a new one in the same key; a gap closes it, and then the last
        row(1000, key="alone", completes=True),
        row(1005, 1, key="tie"), row(1005, 2, key="tie", completes=True), row(1005, 3, key="tie", agent="b"),
    ]
    want = [
        ("alone", 1000 * S, 1000 * S, "completed", "a", 0, 0),
        ("s", 1000 * S, 1020 * S, "completed", "a", 2, 1),
        ("s", 1030 * S, 1140 * S, "gap", "a", 2, 0),
        ("s", 1200 * S, 1300 * S, "gap", "a", 1, 0),
        ("tie", 1005 * S, 1005 * S, "completed", "a", 1, 0),
        ("tie", 1005 * S, 1105 * S, "gap", "b", 1, 0),
    ]
    end = [[row(90_000, key="clock")], [row(90_001, key="clock")]]
    for n, batches in enumerate(([whole], [whole[::-2], whole[-2::-2]])):
        root = tmp_path / str(n)
        root.mkdir()
        path = write_batches(spark, str(root), schema, [*batches, *end])
        stream = jobs.event_stream(spark, path, spark.read.parquet(path).schema, max_files=1).withWatermark("ts", "10 minutes")
        got = run(spark, str(root), states.closed_sessions(stream, 100 * S))
        assert rows(got.where("session_id <> 'clock'").drop("batch")) == want
