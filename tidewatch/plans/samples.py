"""Scraped samples of every metric, derived from the log tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.scan import DAY, HOUR, time_block
from tidewatch.operators import drift
from tidewatch.operators import metrics as m
from tidewatch.operators.features import FEATURE_NAMES, missing_rates
from tidewatch.plans import views
from tidewatch.session import fresh_path

EVERY = HOUR
# Rows before this time are the reference of the drift scores.
SPLIT = "2024-01-16 00:00:00"


def _growth(spark: SparkSession, sf_dir: str, every: int, wanted: set[str]) -> list[DataFrame]:
    """Counter growth, one pass per log table."""
    c, lit = F.col, F.lit
    one = lambda condition=None: lit(1) if condition is None else F.when(condition, 1)
    call = {"service": c("service"), "model": c("model")}
    agent = {"service": lit("agentic-pipeline"), "agent_name": c("agent_name")}
    model = {"service": c("service"), "model_name": lit(m.MODEL_NAME), "model_version": c("model_version")}
    event = c("event")
    ok, limited, scored = event == "llm_inference_success", event == "llm_rate_limited", event == "ml_inference_success"
    status = F.when(ok, "success").when(limited, "rate_limited").otherwise("error")
    same = lambda *names: {n: c(n) for n in names}
    tables = [
        ("genai_logs", "us", same("service", "model", "event"), [
            m.Count("genai_requests_total", {**call, "status": status}, one()),
            m.Count("genai_tokens_total", {**call, "type": lit("input")}, F.when(ok, c("input_tokens"))),
            m.Count("genai_tokens_total", {**call, "type": lit("output")}, F.when(ok, c("output_tokens"))),
            m.Count("genai_rate_limit_hits_total", call, one(limited)),
            m.Spread("genai_request_duration_seconds", call, F.when(ok, c("latency_ms") / 1000)),
        ]),
        ("agent_sessions", "end_us", same("agent_name", "status"), [
            m.Count("agent_sessions_total", {**agent, "status": c("status")}, one()),
            m.Count("agent_max_steps_reached_total", agent, one(c("status") == "max_steps_reached")),
            m.Spread("agent_session_duration_seconds", agent, c("duration_ms") / 1000),
        ]),
        ("agent_events", "us", same("agent_name", "tool_name", "tool_status"), [
            m.Count("agent_steps_total", agent, one()),
            m.Count("agent_hallucinations_detected_total", agent, one((c("event_type") == "signup") & (c("k") >= 90))),
            m.Count("agent_tool_calls_total", {**agent, "tool_name": c("tool_name"), "status": c("tool_status")}, one(c("tool_name").isNotNull())),
        ]),
        ("ml_logs", "us", same("service", "model_version", "event"), [
            m.Count("ml_inference_requests_total", {**model, "status": F.when(scored, "success").otherwise("error")}, one()),
            m.Spread("ml_inference_duration_seconds", model, F.when(scored, c("latency_ms") / 1000)),
            m.Spread("ml_prediction_confidence", model, F.when(scored, c("confidence"))),
        ]),
    ]
    queue = {"service": lit("agentic-pipeline")}
    out = []
    if not wanted or "agent_queue_depth" in wanted:
        # Depth at a scrape is what began before it less what ended: a running total of two counters.
        ends = F.array(F.struct(c("start_us").alias("us"), lit(1).alias("n")), F.struct(c("end_us").alias("us"), lit(-1).alias("n")))
        moves = session_rows(spark, sf_dir).select(F.inline(ends))
        out.append(m.increments(moves, {}, "us", every, [m.Count("agent_queue_depth", queue, c("n"))]))
    for name, us, dims, specs in tables:
        kept = [s for s in specs if s.metric in wanted or f"{s.metric}_bucket" in wanted or not wanted]
        if kept:
            rows = session_rows(spark, sf_dir) if name == "agent_sessions" else getattr(views, name)(spark, sf_dir)
            out.append(m.increments(rows, dims, us, every, kept))
    return out


def _levels(spark: SparkSession, sf_dir: str, every: int, wanted: set[str]) -> list[DataFrame]:
    """Gauges."""
    c = F.col
    part = {"consumergroup": c("consumer_group"), "topic": c("topic"), "partition": c("part").cast("string")}
    topic = {k: part[k] for k in ("topic", "partition")}
    call = {"service": c("service"), "model": c("model")}
    model = {"service": c("service"), "model_name": F.lit(m.MODEL_NAME)}
    trained = F.floor(c("us") / DAY) * 86_400
    ok = "event = 'llm_inference_success'"
    gauges = [
        ("genai_context_window_utilization", "genai_logs", ok, call, c("ctx_utilization"), ["us", "request_id"]),
        ("kafka_consumergroup_lag", "kafka_consumer_offsets", "true", part, c("lag"), ["us", "log_end_offset"]),
        ("kafka_topic_partition_current_offset", "kafka_consumer_offsets", "true", topic, c("log_end_offset"), ["us", "log_end_offset"]),
        ("ml_last_training_completed_timestamp", "ml_logs", "true", model, trained, ["us", "transaction_id"]),
    ]
    return [
        m.gauge_samples(getattr(views, table)(spark, sf_dir).where(rows), metric, labels, "us", every, value, order)
        for metric, table, rows, labels, value, order in gauges
        if metric in wanted or not wanted
    ]


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The engineered features as a stored table: counts, missing rates and true labels read the same rows."""
    return stored(spark, "features", sf_dir, lambda: views.ml_features(spark, sf_dir))


def session_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The agent sessions as a stored table: they are put together once for their counters and the queue depth."""
    return stored(spark, "sessions", sf_dir, lambda: views.agent_sessions(spark, sf_dir).select("agent_name", "status", "start_us", "end_us", "duration_ms"))


def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(feature, scrape_us, late, value, n): every feature value counted per scrape interval, as a stored table.

    The feature rows are engineered once; the drift samples and both drift queries read their counts.
    """

    def build():
        # Both engines agree on the deviation to nine digits, and equal values must stay equal.
        rows = feature_rows(spark, sf_dir).withColumn("amount_deviation", F.round("amount_deviation", 9))
        late = (F.col("ts") >= F.lit(SPLIT).cast("timestamp_ntz")).alias("late")
        scrape = ((time_block("us", EVERY) + 1) * EVERY).alias("scrape_us")
        values = drift.long_values(rows.select("*", scrape, late), FEATURE_NAMES, ["scrape_us", "late"])
        return values.groupBy("feature", "scrape_us", "late", "value").agg(F.count(F.lit(1)).alias("n"))

    return stored(spark, "feature-counts", sf_dir, build, "feature")


def _model_levels(spark: SparkSession, sf_dir: str, wanted: set[str]) -> list[DataFrame]:
    """Gauges of the model: drift against the reference half, rolling accuracy and missing rates at each scrape."""
    service, name = F.lit("ml-pipeline"), F.lit(m.MODEL_NAME)
    feature = {"service": service, "model_name": name, "feature_name": F.col("feature_name")}

    def sample(rows: DataFrame, metric: str, labels: dict, value: str) -> DataFrame:
        series = m.series_of(labels).alias("series")
        return rows.select(F.lit(metric).alias("metric"), series, F.lit(None).cast("double").alias("le"), "us", F.col(value).cast("double").alias("value"))

    out = []
    if not wanted or "ml_data_drift_score" in wanted:
        counts, n = feature_counts(spark, sf_dir), F.col("n")
        current = counts.where("late").withColumnRenamed("scrape_us", "us")
        scores = drift.ks_windows(counts.where("NOT late"), current, "us", ["feature"], n, n).withColumnRenamed("feature", "feature_name")
        out.append(sample(scores, "ml_data_drift_score", feature, "drift_score"))
    if not wanted or "ml_model_accuracy" in wanted:
        # A single metric needs the day's count alone of the features; all of them share the stored rows.
        scored = views.scored_rows(spark, sf_dir, None if wanted else feature_rows(spark, sf_dir))
        rolled = m.rolling_accuracy(scored, ["model_version"], "us", ["transaction_id"], F.col("is_fraud") == F.col("label"), 100)
        model = {"service": service, "model_name": name, "model_version": F.col("model_version")}
        out.append(m.gauge_samples(rolled, "ml_model_accuracy", model, "us", EVERY, F.col("rolling_accuracy"), ["us", "transaction_id"]))
    if not wanted or "ml_feature_missing_rate" in wanted:
        rows = views.with_gaps(feature_rows(spark, sf_dir)).withColumn("us", (time_block("us", EVERY) + 1) * EVERY)
        out.append(sample(missing_rates(rows, list(FEATURE_NAMES), ["us"]), "ml_feature_missing_rate", feature, "missing_rate"))
    return out


def derive_samples(spark: SparkSession, sf_dir: str, only: Iterable[str] = (), every: int = EVERY) -> DataFrame:
    """``metric, series, le, us, value``; all derivable metrics, or ``only`` some."""
    wanted = set(only)
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    growth, levels = _growth(spark, sf_dir, every, wanted), _levels(spark, sf_dir, every, wanted) + _model_levels(spark, sf_dir, wanted)
    out = []
    if growth:
        horizon = views.ev(spark, sf_dir).agg(F.max("us") + every).scalar()
        out.append(m.accumulate(union(growth), every, horizon))
    if levels:
        out.append(union(levels))
    return union(out)


_WRITTEN: dict[tuple, str] = {}


def _identity(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder: replaced inputs give another identity."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def stored(spark: SparkSession, name: str, source: str, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
    """A derived table in the shared folder, written once per application and state of its inputs.

    Later stages read it selectively, and the loss of an executor does not
    bring its lineage back. The rebalance gives a part few files and splits a
    large one; a table without parts is written as its tasks come.
    """
    key = (spark.sparkContext.applicationId, name, source, _identity(spark, source))
    if key in _WRITTEN:
        try:
            return spark.read.parquet(_WRITTEN[key])
        except AnalysisException:
            pass  # the folder was cleaned up
    path = fresh_path(spark, name)
    rows = build()
    if by is None:
        rows.write.parquet(path)
    else:
        rows.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(path)
    _WRITTEN[key] = path
    return spark.read.parquet(path)


def sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All samples as a table with one folder per metric, as a scraper keeps them."""
    return stored(spark, "samples", sf_dir, lambda: derive_samples(spark, sf_dir), "metric")
