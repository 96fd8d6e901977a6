"""Log scans: typed NDJSON, raw lines with JSON paths, partitions, containers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.labels import series_key
from tidewatch.functions.timeparse import parse_event_time
from tidewatch.sources.schemas import LOG_SCHEMAS, METRIC_SAMPLES, ML_PARTITIONS, SPANS, STREAM_EVENT

CORRUPT = "_corrupt"


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def normalise(logs: DataFrame) -> DataFrame:
    """Upper-case levels, parse the time text once."""
    out = logs.withColumn("ts", parse_event_time("timestamp")).withColumn("us", F.unix_micros("ts"))
    return out.withColumn("level", F.upper("level")) if "level" in logs.columns else out


def _parsed(lines: DataFrame, table: str, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, ``_line``, ``_row`` (all fields as text) and ``_bad`` of every line that is not blank.

    The parser sits in a generator, so each line is parsed once, however many
    fields or filters read the result, and no projection changes what is bad.
    """
    fields = struct_of(LOG_SCHEMAS[table])
    texts = ", ".join(f"`{f.name}` STRING" for f in fields) + f", {CORRUPT} STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    row = F.from_json(text, texts, options)
    out = lines.where(F.trim(text) != "").select(*keep, F.col(text).alias("_line"), F.inline(F.array(F.struct(row.alias("_row")))))
    return out.withColumn("_bad", F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull())


def _typed(parsed: DataFrame, table: str, keep: Sequence[str] = ()) -> DataFrame:
    """Declared types; a field that cannot be cast is NULL and its row stays."""
    columns = []
    for f in struct_of(LOG_SCHEMAS[table]):
        kind, value = f.dataType.simpleString(), F.col(f"_row.{f.name}")
        columns.append((value if kind == "string" else value.try_cast(kind)).alias(f.name))
    return parsed.where(~F.col("_bad")).select(*columns, *keep)


def _text_lines(spark: SparkSession, path: str | list[str], recursive: bool, extra: str) -> DataFrame:
    reader = spark.read.schema("value STRING" + (f", {extra}" if extra else ""))
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.text(path)


def scan_ndjson(
    spark: SparkSession, path: str | list[str], table: str, *, tolerant: bool = True, recursive: bool = False, extra: str = ""
) -> DataFrame:
    """Newline-delimited JSON with the declared schema of ``table``.

    Unknown keys are dropped. When ``tolerant``, a field of another type is NULL
    and a line that is no JSON object is left to ``scan_rejects``; otherwise
    both fail the job. ``recursive`` walks sub-folders (this turns partition
    discovery off); a glob in ``path`` works as usual. ``extra`` declares
    partition columns.
    """
    if tolerant:
        names = [f.name for f in struct_of(extra)] if extra else []
        return _typed(_parsed(_text_lines(spark, path, recursive, extra), table, "value", names), table, names)
    ddl = LOG_SCHEMAS[table] + (f", {extra}" if extra else "")
    reader = spark.read.schema(ddl).option("mode", "FAILFAST")
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.json(path)


def scan_rejects(spark: SparkSession, path: str | list[str], table: str, *, recursive: bool = False) -> DataFrame:
    """The lines that ``scan_ndjson`` leaves out, with their file: (line, file)."""
    lines = _text_lines(spark, path, recursive, "").select("value", F.col("_metadata.file_path").alias("file"))
    return _parsed(lines, table, "value", ["file"]).where("_bad").select(F.col("_line").alias("line"), "file")


def scan_ml_logs(spark: SparkSession, path: str) -> DataFrame:
    """Scoring logs below ``year=/month=/day=`` folders, as strings.

    ``log_date`` is built from the folder names only, so a filter on it prunes
    folders (``time_range`` adds that filter).
    """
    days = ", ".join(f"{p} STRING" for p in ML_PARTITIONS)
    logs = scan_ndjson(spark, path, "ml_logs", extra=days)
    return logs.withColumn("log_date", F.concat_ws("-", *ML_PARTITIONS).cast("date"))


def split_malformed(lines: DataFrame, table: str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Raw lines to (typed rows, rejected lines); works on streams too. Only a
    line that is no JSON object is rejected."""
    parsed = _parsed(lines, table, text)
    return _typed(parsed, table), parsed.where("_bad").select(F.col("_line").alias("line"))


def project_paths(lines: DataFrame, table: str, text: str = "value") -> DataFrame:
    """Raw lines to typed columns by JSON path; a failed cast gives NULL."""
    columns: list[Column] = []
    for field in struct_of(LOG_SCHEMAS[table]):
        found = F.get_json_object(text, f"$.{field.name}")
        kind = field.dataType.simpleString()
        columns.append((found if kind == "string" else found.try_cast(kind)).alias(field.name))
    return lines.select(*columns)


def scan_lines(spark: SparkSession, path: str, table: str, *, recursive: bool = True) -> DataFrame:
    """The raw-line form of ``scan_ndjson``: text scan and JSON paths."""
    reader = spark.read.option("recursiveFileLookup", True) if recursive else spark.read
    return project_paths(reader.text(path), table)


def register_tables(spark: SparkSession, root: str, database: str = "telemetry") -> None:
    """Database with one external table per log source below ``root``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, ddl in LOG_SCHEMAS.items():
        quoted = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in struct_of(ddl))
        parts = ""
        if table == "ml_logs":
            quoted += "".join(f", `{p}` string" for p in ML_PARTITIONS)
            parts = f" PARTITIONED BY ({', '.join(ML_PARTITIONS)})"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({quoted}) USING json "
            f"OPTIONS (mode 'PERMISSIVE'){parts} LOCATION '{root}/{table}'"
        )
        if parts:
            spark.catalog.recoverPartitions(f"{database}.{table}")


def register_views(spark: SparkSession, root: str) -> None:
    """Session views over the same folders, times parsed and levels normalised."""
    for table in LOG_SCHEMAS:
        scan = scan_ml_logs(spark, f"{root}/{table}") if table == "ml_logs" else scan_ndjson(spark, f"{root}/{table}", table)
        normalise(scan).createOrReplaceTempView(table)


# The name-and-id pattern of a container tag.
CONTAINER_TAG = r"((?:[^_]+_){2}([a-z0-9]+))"
SYSTEM_JOB = "varlogs"


def parse_container_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Docker JSON lines: outer JSON, tag from the inner JSON, container name and
    id by pattern, time, labels and the log text."""
    outer = F.from_json(text, "log STRING, stream STRING, time STRING, attrs STRING")
    parsed = lines.withColumn("_o", outer)
    tag = F.get_json_object("_o.attrs", "$.tag")
    capture = lambda i: F.nullif(F.regexp_extract(tag, CONTAINER_TAG, i), F.lit(""))
    return parsed.select(
        F.col("_o.time").try_cast("timestamp").alias("ts"),
        F.col("_o.stream").alias("stream"),
        tag.alias("tag"),
        capture(1).alias("container_name"),
        capture(2).alias("container_id"),
        F.col("_o.log").alias("output"),
    )


def tail_system_logs(spark: SparkSession, path: str) -> DataFrame:
    """Streaming tail of text logs with the job label and the file of origin."""
    return (
        spark.readStream.format("text")
        .load(path)
        .select(F.lit(SYSTEM_JOB).alias("job"), F.col("_metadata.file_path").alias("filename"), F.col("value").alias("line"))
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Broker messages (``topic, partition, offset, timestamp, value``) to events.

    The broker's own fields stay in the struct ``metadata``.
    """
    body = F.from_json(F.col("value").cast("string"), STREAM_EVENT)
    meta = F.struct(
        F.col("topic"), F.col("partition"), F.col("offset"), F.col("timestamp").alias("timestamp")
    )
    return messages.select(meta.alias("metadata"), F.lit("kafka_event").alias("type"), body.alias("_e")).select(
        "metadata", "type", "_e.*"
    )


def read_topics(
    spark: SparkSession, servers: str, topics: list[str], group: str = "logstash_consumer", start: str = "latest", max_offsets: int | None = None
) -> DataFrame:
    """Streaming source over several topics (needs the Kafka connector jar); ``start`` names the first offsets, ``max_offsets`` bounds a micro-batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("groupIdPrefix", group)
        .option("startingOffsets", start)
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return parse_messages(reader.load())


def read_pushed_lines(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """JSON lines dropped into a folder, typed as log events."""
    reader = spark.readStream.schema(STREAM_EVENT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder).withColumn("type", F.lit("pipeline_log"))


def scan_samples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored metric samples in the form the rules read: series text and micros."""
    raw = spark.read.schema(METRIC_SAMPLES).format(fmt).load(path)
    return raw.select("metric", series_key("labels").alias("series"), "le", F.unix_micros("ts").alias("us"), "value")


def scan_spans(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored spans with micros and the attributes that joins use as columns."""
    raw = spark.read.schema(SPANS).format(fmt).load(path)
    attribute = lambda name: F.try_element_at("attributes", F.lit(name))
    return raw.withColumns(
        {
            "start_us": F.unix_micros("start_ts"),
            "request_id": attribute("request.id"),
            "session_id": attribute("session.id"),
            "tool_name": attribute("tool.name"),
        }
    )
