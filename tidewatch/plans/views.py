"""Log, metric and span tables derived from the ``events`` table.

They have the schemas of the log sources (see ``sources.schemas``) plus ``ts``
and ``us``, and stand in for them where only the star-schema tables exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.scan import DAY, HOUR, running_number, time_block
from tidewatch.operators.features import amount_deviation, fraud_label, trailing_count
from tidewatch.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str = "ts") -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_ev(table(spark, sf_dir, "events"))


def derive_ev(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "ts",
        micros().alias("us"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts_iso"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def genai_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_genai_logs(ev(spark, sf_dir))


def derive_genai_logs(e: DataFrame) -> DataFrame:
    k = F.col("k")
    failed = F.col("event_type") == "error"
    limited = failed & (k % 2 == 0)
    broken = failed & (k % 2 == 1)
    return e.select(
        F.col("ts_iso").alias("timestamp"),
        "ts",
        "us",
        F.lit("genai-pipeline").alias("service"),
        F.when(~failed, "INFO").when(limited, "WARNING").when(k % 10 == 9, "CRITICAL").otherwise("ERROR").alias("level"),
        F.when(~failed, "llm_inference_success").when(limited, "llm_rate_limited").otherwise("llm_api_error").alias("event"),
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.when(k % 3 == 0, "gemma2-9b-it").when(k % 3 == 1, "llama-3.3-70b-versatile").otherwise("llama-3.1-8b-instant").alias("model"),
        F.when(~failed, (k * 10).cast("long")).alias("input_tokens"),
        F.when(~failed, (F.col("user_id") % 400 + 1).cast("long")).alias("output_tokens"),
        (F.col("value") * 100).alias("latency_ms"),
        F.when(~failed, F.when(k % 7 == 0, "length").otherwise("stop")).alias("finish_reason"),
        F.when(~failed, k.cast("double") / 100).alias("ctx_utilization"),
        F.when(broken, F.when(k % 4 == 1, "APITimeoutError").otherwise("APIConnectionError")).alias("error_type"),
        F.when(
            failed,
            F.when(limited, "rate limit reached")
            .when(k % 4 == 1, F.concat(F.lit("request timed out, code "), k.cast("string")))
            .otherwise(F.concat(F.lit("connection reset, code "), k.cast("string"))),
        ).alias("error"),
        F.lit("production").alias("environment"),
    )


def agent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent steps before they are numbered."""
    kind, k = F.col("event_type"), F.col("k")
    return ev(spark, sf_dir).withColumns(
        {
            "session_id": F.concat(
                F.lit("session-"),
                F.col("user_id").cast("string"),
                F.lit("-"),
                F.floor((F.dayofmonth("ts") - 1) / 4).cast("int").cast("string"),
            ),
            "agent_name": F.when(F.col("user_id") % 2 == 0, "research-agent").otherwise("analysis-agent"),
            "tool_name": F.when(kind.isin("click", "error"), "web_search")
            .when(kind == "view", "calculator")
            .when(kind == "purchase", "get_current_metrics"),
            "tool_status": F.when(kind == "signup", F.lit(None))
            .when(kind == "error", "error")
            .when(k == 13, "not_found")
            .otherwise("success"),
        }
    )


def agent_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = agent_events(spark, sf_dir)
    numbered = running_number(keyed, ["session_id"], ["us", "event_id"], time_block("us", HOUR), "step")
    return numbered.withColumn("step", F.col("step").cast("int")).drop("user_id")


def agent_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session roll-up; the step count is a row count, so no ordering is needed."""
    kind = F.col("event_type")
    failures = F.count_if(kind == "error")
    return agent_events(spark, sf_dir).groupBy("session_id").agg(
        F.max("agent_name").alias("agent_name"),
        F.count(F.lit(1)).cast("int").alias("steps_taken"),
        F.min("us").alias("start_us"),
        F.max("us").alias("end_us"),
        ((F.max("us") - F.min("us")).cast("double") / 1000).alias("duration_ms"),
        F.when(failures >= 4, "failed").when(F.count(F.lit(1)) >= 10, "max_steps_reached").otherwise("completed").alias("status"),
        F.max("ts_iso").alias("end_iso"),
        F.max("ts").alias("end_ts"),
    )


def agent_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, status = F.col("event_type"), F.col("status")
    calls = agent_steps(spark, sf_dir).select(
        F.col("ts_iso").alias("timestamp"),
        "ts",
        "us",
        F.lit("agentic-pipeline").alias("service"),
        F.when(kind == "error", "ERROR").otherwise("INFO").alias("level"),
        F.when(kind == "signup", "agent_final_answer").when(kind == "error", "agent_tool_error").otherwise("agent_tool_call").alias("event"),
        "session_id",
        F.lit(None).cast("string").alias("agent_name"),
        "step",
        "tool_name",
        F.lit(None).cast("int").alias("steps_taken"),
        F.lit(None).cast("double").alias("duration_ms"),
        F.lit(None).cast("string").alias("status"),
        F.when(kind == "error", "Search service timeout").alias("error"),
        F.lit("production").alias("environment"),
    )
    ends = agent_sessions(spark, sf_dir).select(
        F.col("end_iso").alias("timestamp"),
        F.col("end_ts").alias("ts"),
        F.col("end_us").alias("us"),
        F.lit("agentic-pipeline").alias("service"),
        F.when(status == "failed", "ERROR").when(status == "max_steps_reached", "WARNING").otherwise("INFO").alias("level"),
        F.lit("agent_session_completed").alias("event"),
        "session_id",
        "agent_name",
        "steps_taken",
        "duration_ms",
        "status",
        F.lit("production").alias("environment"),
    )
    return calls.unionByName(ends, allowMissingColumns=True)


def ml_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    failed = F.col("event_type") == "error"
    return ev(spark, sf_dir).select(
        F.col("ts_iso").alias("timestamp"),
        "ts",
        "us",
        F.lit("ml-pipeline").alias("service"),
        F.when(failed, "ERROR").otherwise("INFO").alias("level"),
        F.when(failed, "ml_inference_error").otherwise("ml_inference_success").alias("event"),
        F.concat(F.lit("tx-"), F.col("event_id").cast("string")).alias("transaction_id"),
        (k > 50).alias("is_fraud"),
        (k.cast("double") / 100).alias("fraud_probability"),
        F.when(k >= 50, k.cast("double") / 100).otherwise((100 - k).cast("double") / 100).alias("confidence"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("user_id") % 2 == 0, "v2.1.0").otherwise("v2.0.0").alias("model_version"),
        F.when(failed, "inference error").alias("error"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions before the per-user features are engineered."""
    k = F.col("k")
    return ev(spark, sf_dir).select(
        "event_id",
        "user_id",
        "ts",
        "us",
        F.concat(F.lit("tx-"), F.col("event_id").cast("string")).alias("transaction_id"),
        (F.col("value") * 10).alias("transaction_amount"),
        "value",
        (k % 20).alias("merchant_category"),
        (F.col("user_id") * 7 % 3650).cast("int").alias("user_age_days"),
        (k < 15).alias("is_international"),
        ((100 - k).cast("double") / 100).alias("device_trust_score"),
    )


def ml_features(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    """All nine features; ``exact`` sums the means in time order where the last bit shows."""
    base = transactions(spark, sf_dir).withColumns(
        {
            "hour_of_day": F.hour("ts").cast("int"),
            "day_of_week": F.pmod(time_block("us", DAY) + 3, F.lit(7)).cast("int"),
        }
    )
    counted = trailing_count(base, "user_id", "us", ["event_id"], DAY, "tx_count_24h")
    order = ["us", "event_id"] if exact else []
    amounts = base.select("user_id", "value", "us", "event_id")
    return amount_deviation(counted, "user_id", "value", ["event_id"], "amount_deviation", amounts, order).withColumn(
        "tx_count_24h", F.col("tx_count_24h").cast("int")
    ).drop("value")


def scored_rows(spark: SparkSession, sf_dir: str, features: DataFrame | None = None) -> DataFrame:
    """Predictions with their true label: the label needs the day's count alone of the engineered features.

    ``features`` are feature rows that are there already.
    """
    counted = features
    if counted is None:
        counted = trailing_count(transactions(spark, sf_dir), "user_id", "us", ["event_id"], DAY, "tx_count_24h")
    truth = counted.select("transaction_id", fraud_label().alias("label"))
    return ml_logs(spark, sf_dir).select("model_version", "transaction_id", "us", "is_fraud").join(truth, "transaction_id")


NULLED = {"transaction_amount": 7, "merchant_category": 11, "device_trust_score": 5}


def with_gaps(features: DataFrame) -> DataFrame:
    """Feature rows with absent values at known places."""
    return features.withColumns({n: F.when(F.col("event_id") % d != 0, F.col(n)) for n, d in NULLED.items()})


def kafka_consumer_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    keyed = ev(spark, sf_dir).select(
        "ts_iso",
        "ts",
        "us",
        "event_id",
        "k",
        F.when(kind.isin("click", "view"), "genai-events").when(kind == "purchase", "agent-events").otherwise("pipeline-logs").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("part"),
    )
    numbered = running_number(keyed, ["topic", "part"], ["us", "event_id"], time_block("us", HOUR), "n")
    lag = (F.col("k") * 200).cast("long")
    end = F.lit(100000) + F.col("n")
    return numbered.select(
        F.col("ts_iso").alias("timestamp"),
        "ts",
        "us",
        F.lit("logstash_consumer").alias("consumer_group"),
        "topic",
        "part",
        (end - lag).alias("current_offset"),
        end.alias("log_end_offset"),
        lag.alias("lag"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly scrape of a request counter that restarts every five days.

    The window runs over hourly counts: at most 120 rows per partition.
    """
    event = F.col("event")
    hourly = genai_logs(spark, sf_dir).groupBy(
        "model",
        F.when(event == "llm_inference_success", "success").when(event == "llm_rate_limited", "rate_limited").otherwise("error").alias("status"),
        F.floor((F.dayofmonth("ts") - 1) / 5).cast("int").alias("epoch"),
        ((time_block("us", HOUR) + 1) * HOUR).alias("us"),
    ).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("model", "status", "epoch").orderBy("us").rowsBetween(Window.unboundedPreceding, 0)
    return hourly.select(
        F.lit("genai_requests_total").alias("metric"),
        F.lit("genai-pipeline").alias("service"),
        "model",
        "status",
        "epoch",
        "us",
        F.sum("n").over(upto).cast("double").alias("value"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = agent_steps(spark, sf_dir).select(
        F.col("session_id").alias("trace_id"),
        F.concat_ws("/", "session_id", F.col("step").cast("string")).alias("span_id"),
        F.concat(F.col("session_id"), F.lit("/0")).alias("parent_span_id"),
        F.lit("agentic-pipeline").alias("service"),
        F.concat(F.lit("agent_step_"), F.col("step").cast("string")).alias("name"),
        F.col("us").alias("start_us"),
        (F.col("value") * 100).alias("duration_ms"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("OK").alias("status"),
        "tool_name",
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
    )
    roots = agent_sessions(spark, sf_dir).select(
        F.col("session_id").alias("trace_id"),
        F.concat(F.col("session_id"), F.lit("/0")).alias("span_id"),
        F.lit(None).cast("string").alias("parent_span_id"),
        F.lit("agentic-pipeline").alias("service"),
        F.lit("agent_session").alias("name"),
        "start_us",
        "duration_ms",
        F.when(F.col("status") == "failed", "ERROR").otherwise("OK").alias("status"),
    )
    return steps.unionByName(roots, allowMissingColumns=True)
