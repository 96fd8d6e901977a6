"""Relabelling of samples, alerts and spans. Labels are ``MAP<STRING,STRING>``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Scrape jobs with their constant labels, and the external labels.
SCRAPE_LABELS = {
    "genai-pipeline": {"service": "genai-pipeline", "pipeline_type": "genai"},
    "agentic-pipeline": {"service": "agentic-pipeline", "pipeline_type": "agentic"},
    "ml-pipeline": {"service": "ml-pipeline", "pipeline_type": "ml"},
}
EXTERNAL_LABELS = {"environment": "production", "cluster": "ai-pipelines"}
INSTANCE_PATTERN = r"^(?:([^:]+):.*)$"
KAFKA_METRICS = r"kafka_.*"
RESOURCE_ATTRIBUTES = {"deployment.environment": "production"}


def label_map(values: Mapping[str, str]) -> Column:
    flat = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*flat) if flat else F.create_map().cast("map<string,string>")


def upsert(labels: Column, extra: Mapping[str, str] | Column) -> Column:
    """Set labels; new values win over old ones."""
    more = label_map(extra) if isinstance(extra, Mapping) else extra
    kept = F.map_filter(labels, lambda k, _: ~F.array_contains(F.map_keys(more), k))
    return F.map_concat(kept, more)


def keep_missing(labels: Column, extra: Mapping[str, str]) -> Column:
    """Add labels that are not there yet; present ones win (external labels)."""
    return upsert(label_map(extra), labels)


def instance_from_address(df: DataFrame, address: str = "address", labels: str = "labels") -> DataFrame:
    """``instance`` label from the host part; no label when the pattern fails."""
    host = F.regexp_extract(address, INSTANCE_PATTERN, 1)
    return df.withColumn(
        labels, F.when(host != "", upsert(F.col(labels), F.create_map(F.lit("instance"), host))).otherwise(F.col(labels))
    )


def constant_labels(df: DataFrame, job: str = "job", labels: str = "labels") -> DataFrame:
    out = F.col(labels)
    for name, extra in SCRAPE_LABELS.items():
        out = F.when(F.col(job) == name, upsert(F.col(labels), extra)).otherwise(out)
    return df.withColumn(labels, out)


def keep_metrics(df: DataFrame, pattern: str = KAFKA_METRICS, metric: str = "metric") -> DataFrame:
    """Keep samples whose whole name matches."""
    return df.where(F.col(metric).rlike(f"^(?:{pattern})$"))


def resource_attributes(spans: DataFrame, extra: Mapping[str, str] = RESOURCE_ATTRIBUTES, name: str = "attributes") -> DataFrame:
    return spans.withColumn(name, upsert(F.coalesce(F.col(name), label_map({})), extra))
