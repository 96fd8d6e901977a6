"""Structured Streaming jobs built from the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidewatch.functions.scan import HOUR, MINUTE, running_number, time_block
from tidewatch.operators.drift import ks_windows, long_values
from tidewatch.operators.enrich import enrich
from tidewatch.operators.features import FEATURE_NAMES
from tidewatch.operators.scoring import score

# Export flush settings and the default lateness.
FLUSH_SECONDS = 60
FLUSH_FILES = 100
LATENESS = "10 minutes"


def event_stream(
    spark: SparkSession, folder: str, schema, fmt: str = "parquet", glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """File stream; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def deduplicated(stream: DataFrame, keys: list[str], time: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Drop redelivered rows that arrive within the watermark."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


def live_counts(logs: DataFrame, width: str = "1 minute", slide: str | None = None, time: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Requests, errors, rate-limit hits and tokens per window and service."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        logs.withWatermark(time, lateness)
        .groupBy(window.alias("w"), "service")
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("level").isin("ERROR", "CRITICAL")).alias("errors"),
            F.count_if(F.col("event") == "llm_rate_limited").alias("rate_limited"),
            F.sum("input_tokens").alias("input_tokens"),
            F.sum("output_tokens").alias("output_tokens"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "service", "requests", "errors", "rate_limited", "input_tokens", "output_tokens")
    )


def sliding_rates(events: DataFrame, by: list[str], width: str = "5 minutes", slide: str = "30 seconds", seconds: float = 300.0, time: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Events per second over a sliding window, per label set."""
    counted = (
        events.withWatermark(time, lateness)
        .groupBy(F.window(time, width, slide).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(F.col("w.end").alias("eval_ts"), *by, "n", (F.col("n") / F.lit(seconds)).alias("value"))


def agent_sessions(steps: DataFrame, gap: str = "30 minutes", time: str = "ts", lateness: str = LATENESS) -> DataFrame:
    """Sessions put together by key; a quiet gap closes one without an end event."""
    return (
        steps.withWatermark(time, lateness)
        .groupBy("session_id", F.session_window(time, gap).alias("w"))
        .agg(
            F.max("agent_name").alias("agent_name"),
            F.count(F.lit(1)).alias("steps_taken"),
            F.count_if(F.col("event_type") == "error").alias("errors"),
        )
        .select("session_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("closed_at"), "agent_name", "steps_taken", "errors")
    )


def export_ndjson(logs: DataFrame, path: str, checkpoint: str, time: str = "ts", seconds: int = FLUSH_SECONDS) -> DataStreamWriter:
    """Continuous NDJSON export below ``year=/month=/day=``; the sink's log makes
    it exactly-once. Not started yet."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = logs.withColumns({name: F.date_format(time, pattern) for name, pattern in parts.items()})
    return (
        dated.writeStream.format("json")
        .partitionBy(*parts)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
    )


def export_batch(path: str, time: str = "flushed_us") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: the bodies of flushes (``states.buffered_flushes``) as NDJSON files
    below ``year=/month=/day=`` of the flush; a repeated batch replaces its own folders."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}

    def write(batch: DataFrame, batch_id: int) -> None:
        at = F.timestamp_micros(F.col(time))
        dated = batch.select(F.col("body").alias("value"), *[F.date_format(at, p).alias(n) for n, p in parts.items()], F.lit(batch_id).alias("batch"))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "batch").text(path)

    return write


FLUSH_KEY = ["source", "shard"]
FLUSH_LINES = "source STRING, shard BIGINT, us BIGINT, row_id BIGINT, line STRING"
FLUSH_PARTS = "source STRING, shard BIGINT, tick BIGINT, parts BIGINT"
FLUSH_BUFFERS = (
    "source STRING, shard BIGINT, tick BIGINT, part BIGINT, reason STRING, flushed_us BIGINT, n BIGINT, first_us BIGINT, last_us BIGINT, "
    "body STRING, held ARRAY<STRUCT<us: BIGINT, row_id: BIGINT, line: STRING>>"
)


def flush_batch(root: str, size: int, every_us: int, late_us: int = 10 * MINUTE, time: str = "ts") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: the buffers of ``states.buffered_flushes`` for batches of any size.

    The keyed form holds all that a key brings in one batch in a Python process.
    Here the lines that the watermark (the newest time less ``late_us``) has
    passed are numbered per key and tick by the scan that no hot key binds to one
    task, and put together by buffer, so that a group has at most ``size`` lines.
    What waits, the lines of open buffers and the parts counted in open ticks go
    from batch to batch as tables; a repeated batch replaces its own. Rows older
    than the watermark of earlier batches are late and left out.
    """
    if size < 1 or every_us < 1:
        raise ValueError("size and every_us are at least 1")
    in_tick = [*FLUSH_KEY, "tick"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        at = lambda name, n: f"{root}/{name}/batch={n}"
        read = lambda name, schema: spark.read.schema(schema).parquet(at(name, batch_id - 1))
        before = spark.read.schema("passed_us BIGINT").json(at("progress", batch_id - 1)).first()[0] if batch_id else None
        fresh = batch.select(*FLUSH_KEY, "us", "row_id", "line", time)
        if before is not None:
            fresh = fresh.where(F.col("us") >= before)
        fresh.write.mode("overwrite").parquet(at("arrived", batch_id))
        arrived = spark.read.schema(f"{FLUSH_LINES}, {time} TIMESTAMP").parquet(at("arrived", batch_id))
        newest = arrived.agg(F.max(F.unix_millis(time)) * 1000).first()[0]
        passed = max((p for p in (before, None if newest is None else newest - late_us) if p is not None), default=0)
        rows = arrived.drop(time).where(F.col("line").isNotNull())
        parts = spark.createDataFrame([], FLUSH_PARTS)
        if batch_id:
            held = read("buffers", FLUSH_BUFFERS).where(F.col("reason").isNull()).select(*FLUSH_KEY, F.inline("held"))
            rows = rows.unionByName(read("waiting", FLUSH_LINES)).unionByName(held)
            parts = read("parts", FLUSH_PARTS)
        rows.where(F.col("us") >= passed).write.mode("overwrite").parquet(at("waiting", batch_id))
        ready = rows.where(F.col("us") < passed).withColumn("tick", F.floor(F.col("us") / F.lit(every_us)).cast("long"))
        numbered = running_number(ready, in_tick, ["us", "row_id", "line"], time_block("us", HOUR), "_i")
        placed = numbered.withColumn("_own", F.floor((F.col("_i") - 1) / size)).drop("_i")
        buffers = placed.groupBy(*in_tick, "_own").agg(
            F.count(F.lit(1)).alias("n"), F.min("us").alias("first_us"), F.max("us").alias("last_us"),
            F.array_sort(F.collect_list(F.struct("us", "row_id", "line"))).alias("held"),
        )
        ends = (F.col("tick") + 1) * every_us
        reason = F.when(F.col("n") == size, "size").when(ends <= passed, "time")
        same = [buffers[k].eqNullSafe(parts[k]) for k in in_tick]
        joined = buffers.join(parts, same, "left").select(*[buffers[c] for c in buffers.columns], F.coalesce(parts["parts"], F.lit(0)).alias("_done"))
        done = joined.withColumns({"reason": reason, "part": (F.col("_own") + F.col("_done")).cast("long")}).select(
            *in_tick, "part", "reason", F.when(F.col("reason") == "size", F.col("last_us")).when(F.col("reason") == "time", ends).alias("flushed_us"),
            "n", "first_us", "last_us", F.when(F.col("reason").isNotNull(), F.array_join(F.col("held.line"), "\n")).alias("body"),
            F.when(F.col("reason").isNull(), F.col("held")).alias("held"),
        )
        done.write.mode("overwrite").parquet(at("buffers", batch_id))
        own = spark.read.schema(FLUSH_BUFFERS).parquet(at("buffers", batch_id)).where(F.col("reason").isNotNull())
        counted = own.select(*in_tick, (F.col("part") + 1).alias("parts")).unionByName(parts).where(ends > passed)
        counted.groupBy(*in_tick).agg(F.max("parts").alias("parts")).write.mode("overwrite").parquet(at("parts", batch_id))
        # Last of all: a batch that failed before has no entry and runs again.
        spark.createDataFrame([(passed,)], "passed_us BIGINT").write.mode("overwrite").json(at("progress", batch_id))

    return write


def read_flushes(spark: SparkSession, root: str) -> DataFrame:
    """The buffers that ``flush_batch`` has flushed below ``root``."""
    return spark.read.schema(FLUSH_BUFFERS).parquet(f"{root}/buffers").where(F.col("reason").isNotNull()).drop("held", "batch")


def flush_lines(lines: DataFrame, root: str, checkpoint: str, size: int, every_us: int, **trigger) -> StreamingQuery:
    """Export buffers below ``root``, flushed by size or time."""
    return (
        lines.writeStream.foreachBatch(flush_batch(root, size, every_us))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{FLUSH_SECONDS} seconds"}))
        .start()
    )


def publish(events: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """JSON values to a topic (needs the Kafka connector jar)."""
    return (
        as_messages(events)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )


def as_messages(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct("*")).alias("value"))


def index_batch(root: str, late_after: str = LATENESS, time: str = "event_time") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: daily logs, daily errors and a reject table.

    The batch is kept once and written three times. Folders are by day first and by
    batch below it, so that the read of a day lists that day alone; a batch replaces
    its own folders, so a repeated one leaves no duplicates. The rows of a day are put
    together before they are written, in files of the advisory partition size: many
    tasks leave no small files, and a day of many rows is still cut. Rejects are rows
    without a readable time and rows older than the lateness behind the newest time of
    earlier batches, which the ledger carries from batch to batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = enrich(batch).withColumns({"log_date": F.to_date(time), "batch": F.lit(batch_id).cast("long")}).persist()
        try:
            newest = _newest_before(spark, f"{root}/progress", batch_id)
            reason = F.when(F.col(time).isNull(), "no time")
            if newest is not None:
                reason = reason.when(F.col(time) < F.lit(newest) - F.expr(f"INTERVAL {late_after}"), "late")
            judged = kept.withColumn("reject_reason", reason)
            good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
            errors = good.where(F.col("is_error"))
            for name, rows in (("logs", good), ("errors", errors)):
                writer = rows.hint("rebalance", "log_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                writer.partitionBy("log_date", "batch").json(f"{root}/{name}")
            judged.where(F.col("reject_reason").isNotNull()).drop("batch").write.mode("overwrite").json(f"{root}/rejects/batch={batch_id}")
            # Last of all: a batch that failed before has no entry and runs again.
            known = F.greatest(F.max(time), F.lit(newest).cast("timestamp"))
            good.agg(known.alias("newest")).write.mode("overwrite").json(f"{root}/progress/batch={batch_id}")
        finally:
            kept.unpersist()

    return write


def _newest_before(spark: SparkSession, path: str, batch_id: int):
    """Newest event time of all earlier batches: the entry of the last one, whatever their number."""
    if batch_id == 0:
        return None
    return spark.read.schema("newest TIMESTAMP").json(f"{path}/batch={batch_id - 1}").agg(F.max("newest")).first()[0]


def read_index(spark: SparkSession, root: str, name: str, schema: str, day: str | None = None) -> DataFrame:
    """The rows of an index table (``logs`` or ``errors``) with their ``log_date`` and ``batch``; of one ``day``, only its folder is listed."""
    reader = spark.read.schema(f"{schema}, log_date DATE, batch BIGINT").option("basePath", f"{root}/{name}")
    return reader.json(f"{root}/{name}/log_date={day}" if day else f"{root}/{name}")


def index_logs(events: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Continuous enrichment with the dual sink."""
    return (
        events.writeStream.foreachBatch(index_batch(root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": f"{FLUSH_SECONDS} seconds"}))
        .start()
    )


def score_stream(model: PipelineModel, transactions: DataFrame) -> DataFrame:
    """Scores of a stream of feature rows."""
    return score(model, transactions)


DAY_COUNTS = "batch BIGINT, log_date DATE, feature STRING, value DOUBLE, n BIGINT"


def drift_batch(
    reference_path: str, out: str, features: list[str] = FEATURE_NAMES, time: str = "ts", counts: str | None = None
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: drift of each day against the stored reference, for every feature.

    The value counts of a batch go to its own folder below ``counts`` (by default
    ``out`` with ``-counts`` appended). The days it touches are then scored from the
    counts of all batches so far, and their folders below ``out`` replaced: a day
    has one score over all its rows, however they were cut into batches.
    """
    counted = counts or f"{out}-counts"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        current = long_values(batch.withColumn("log_date", F.to_date(time)), features, ["log_date"])
        own = current.groupBy("log_date", "feature", "value").agg(F.count(F.lit(1)).alias("n"))
        own.write.mode("overwrite").partitionBy("log_date").parquet(f"{counted}/batch={batch_id}")
        seen = spark.read.schema(DAY_COUNTS).parquet(counted)
        days = [r[0] for r in seen.where(F.col("batch") == batch_id).select("log_date").distinct().collect()]
        if not days:
            return
        touched = F.col("log_date").isin([d for d in days if d is not None])
        touched = touched | F.col("log_date").isNull() if None in days else touched
        known = seen.where((F.col("batch") <= batch_id) & touched)
        reference = long_values(spark.read.parquet(reference_path), features)
        scores = ks_windows(reference, known, "log_date", ["feature"], F.col("n"))
        scores.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("log_date").parquet(out)

    return write


def append_batch(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: rows as they are (for example notifications); a
    repeated batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def run_now(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available into a table and stop."""
    query = (
        stream.writeStream.foreachBatch(append_batch(path))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
