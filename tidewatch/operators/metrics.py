"""Metrics derived from logs: counters, histograms, gauges, and their scrapes.

Plain forms give the value over all rows. ``scrape_*`` forms give the value at
every scrape instant as long-form samples ``us, metric, labels, le, value``;
rows are first counted per label set and scrape interval (map-side combined),
so running totals see one row per interval and not the log rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.labels import series_key
from tidewatch.functions.scan import BLOCK_ROWS, HOUR, Running, running, time_block

# Histogram bounds per metric.
BOUNDS: dict[str, list[float]] = {
    "genai_request_duration_seconds": [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0],
    "agent_session_duration_seconds": [1, 5, 15, 30, 60, 120, 300, 600],
    "agent_step_duration_seconds": [0.1, 0.5, 1.0, 3.0, 10.0, 30.0],
    "ml_inference_duration_seconds": [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0],
    "ml_prediction_confidence": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0],
    "kafka_message_processing_duration_seconds": [0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 30.0],
}
# Context sizes in tokens; other models count as the default.
CONTEXT_TOKENS = {
    "llama-3.1-8b-instant": 131072,
    "llama-3.3-70b-versatile": 131072,
    "llama-3.1-70b-versatile": 131072,
    "gemma2-9b-it": 8192,
}
DEFAULT_CONTEXT = 8192
MODEL_NAME = "fraud-detector"
# All characters a whitespace split drops.
WHITESPACE = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def counter(df: DataFrame, by: Sequence[str], amount: str | Column | None = None) -> DataFrame:
    total = F.count(F.lit(1)) if amount is None else F.sum(amount)
    return df.groupBy(*by).agg(total.alias("value"))


def histogram(df: DataFrame, by: Sequence[str], value: str, bounds: Sequence[float]) -> DataFrame:
    """Cumulative buckets (``le`` up to +Inf) with the sum and count of the group.

    One aggregation with a conditional count per bound; rows are not multiplied.
    """
    edges = [*map(float, bounds), float("inf")]
    seen = df.where(F.col(value).isNotNull())
    wide = seen.groupBy(*by).agg(
        F.sum(value).alias("sum"),
        F.count(F.lit(1)).alias("count"),
        *[F.count_if(F.col(value) <= e).alias(f"_b{i}") for i, e in enumerate(edges)],
    )
    cells = F.array(*[F.struct(F.lit(e).alias("le"), F.col(f"_b{i}").alias("bucket")) for i, e in enumerate(edges)])
    return wide.select(*by, "sum", "count", F.inline(cells))


def latest(df: DataFrame, by: Sequence[str], value: str | Column, order: Sequence[str]) -> DataFrame:
    """Gauge: the value of the last row per label set."""
    c = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*by).agg(F.max_by(c, F.struct(*order)).alias("value"))


def token_counts(logs: DataFrame, by: Sequence[str] = ("service", "model")) -> DataFrame:
    """Token counter with a ``type`` label."""
    wide = logs.groupBy(*by).agg(F.sum("input_tokens").alias("input"), F.sum("output_tokens").alias("output"))
    return wide.unpivot(list(by), ["input", "output"], "type", "value").where(F.col("value").isNotNull())


def word_count(text: Column | str) -> Column:
    """Words between whitespace: the token estimate of a text.

    Only the first and the last piece of a split can be empty.
    """
    c = F.col(text) if isinstance(text, str) else text
    pieces = F.split(F.coalesce(c, F.lit("")), WHITESPACE)
    empty = lambda at: (F.element_at(pieces, at) == "").cast("int")
    return F.greatest(F.size(pieces) - empty(1) - empty(-1), F.lit(0))


def context_size(model: Column | str, sizes: Mapping[str, int] = CONTEXT_TOKENS, default: int = DEFAULT_CONTEXT) -> Column:
    """Context tokens of a model from a fixed, four-entry table."""
    m = F.col(model) if isinstance(model, str) else model
    table = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    return F.coalesce(F.try_element_at(table, m), F.lit(default))


def context_utilization(tokens: Column, model: Column | str) -> Column:
    return F.least(tokens / context_size(model), F.lit(1.0))


def queue_depth(
    intervals: DataFrame, by: Sequence[str], start_us: str, end_us: str, row_id: Sequence[str], block_us: int = HOUR,
    limit: int = BLOCK_ROWS,
) -> DataFrame:
    """Open work after each start (+1) and end (-1): ``by, us, delta, depth``.

    An end at the same instant as a start is counted first. ``limit`` bounds the
    moves that one task scans, also those of one service within one instant.
    """
    moves = F.array(
        F.struct(F.col(start_us).alias("us"), F.lit(1).alias("delta")),
        F.struct(F.col(end_us).alias("us"), F.lit(-1).alias("delta")),
    )
    points = intervals.select(*by, *row_id, F.explode(moves).alias("m")).select(*by, *row_id, "m.us", "m.delta")
    depth = {"depth": Running("sum", F.col("delta").cast("long"))}
    return running(points, by, ["us", "delta", *row_id], time_block("us", block_us), depth, limit)


def rolling_accuracy(
    df: DataFrame,
    by: Sequence[str],
    us: str,
    row_id: Sequence[str],
    correct: Column,
    n: int = 100,
    block_us: int = HOUR,
    block_rows: int = 100_000,
    limit: int = BLOCK_ROWS,
) -> DataFrame:
    """Share of correct results among the last ``n`` rows of the group.

    Rows are numbered with the hot-key-safe scan and cut into equal blocks of
    rows; a block also receives the last ``n`` rows before it.
    """
    size = max(block_rows, n)
    order = [us, *row_id]
    scanned = running(
        df.withColumn("_hit", correct.cast("long")),
        by,
        order,
        time_block(us, block_us),
        {"_i": Running("sum", F.lit(1).cast("long")), "_hits": Running("sum", F.col("_hit"))},
        limit,
    )
    home = F.floor(F.col("_i") / size)
    placed = scanned.withColumn("_home", home).withColumn(
        "_part", F.explode(F.sequence(home, F.floor((F.col("_i") + n) / size)))
    )
    w = Window.partitionBy(*by, "_part").orderBy("_i")
    before = F.coalesce(F.lag("_hits", n).over(w), F.lit(0))
    return (
        placed.withColumn("rolling_accuracy", (F.col("_hits") - before) / F.least(F.col("_i"), F.lit(n)))
        .where(F.col("_home") == F.col("_part"))
        .select(*df.columns, "rolling_accuracy")
    )


@dataclass(frozen=True)
class Count:
    """A counter: ``amount`` is added per row (NULL adds nothing)."""

    metric: str
    labels: Mapping[str, Column]
    amount: Column


@dataclass(frozen=True)
class Spread:
    """A histogram: ``value`` is observed per row (NULL is not observed)."""

    metric: str
    labels: Mapping[str, Column]
    value: Column


def _series(labels: Mapping[str, Column]) -> Column:
    return series_key(F.create_map(*[x for name, c in labels.items() for x in (F.lit(name), c)]))


series_of = _series


def _scrape_time(us: str, every: int) -> Column:
    """The scrape that first sees a row."""
    return ((time_block(us, every) + 1) * F.lit(every)).alias("us")


def increments(
    df: DataFrame, dims: Mapping[str, Column], us: str, every: int, metrics: Sequence[Count | Spread]
) -> DataFrame:
    """Growth per series and scrape interval of all metrics of one log table.

    The logs are read once and combined to ``dims`` and interval, map-side
    first; the metrics are then taken from that small table. ``labels`` are
    expressions over the names in ``dims``.
    """
    sums, cells = [], []
    for i, spec in enumerate(metrics):
        series = _series(spec.labels)
        cell = lambda le, growth, name, text: F.struct(
            F.lit(name).alias("metric"), text.alias("series"), F.lit(le).cast("double").alias("le"), growth.cast("double").alias("growth")
        )
        if isinstance(spec, Count):
            sums.append(F.sum(spec.amount).alias(f"_c{i}"))
            cells.append(F.when(F.col(f"_c{i}").isNotNull(), cell(None, F.col(f"_c{i}"), spec.metric, series)))
            continue
        edges = [*map(float, BOUNDS[spec.metric]), float("inf")]
        sums += [F.count_if(spec.value <= e).alias(f"_s{i}_{k}") for k, e in enumerate(edges)]
        seen = F.col(f"_s{i}_{len(edges) - 1}") > 0
        cells += [F.when(seen, cell(e, F.col(f"_s{i}_{k}"), f"{spec.metric}_bucket", series)) for k, e in enumerate(edges)]
    wide = df.groupBy(*[c.alias(n) for n, c in dims.items()], _scrape_time(us, every)).agg(*sums)
    long = wide.select("us", F.inline(F.array_compact(F.array(*cells))))
    return long.groupBy("metric", "series", "le", "us").agg(F.sum("growth").alias("growth"))


def accumulate(growth: DataFrame, every: int, until: Column | None = None) -> DataFrame:
    """Increments of any number of counters to scraped samples.

    A counter keeps its value while nothing happens, so quiet scrapes repeat it
    up to the next change, and up to ``until`` after the last one. The window
    sees one row per series and scrape interval, however many log rows there
    were, so its partitions are bounded by the covered time.
    """
    w = Window.partitionBy("metric", "series", "le").orderBy("us")
    end = F.lit(None).cast("long") if until is None else F.floor(until / every) * every
    stop = F.greatest(F.coalesce(F.col("_next") - every, end, F.col("us")), F.col("us"))
    total = growth.withColumns(
        {"value": F.sum("growth").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_next": F.lead("us").over(w)}
    )
    return total.select(
        "metric", "series", "le", F.explode(F.sequence(F.col("us"), stop, F.lit(every).cast("long"))).alias("us"), "value"
    )


def gauge_samples(
    df: DataFrame, metric: str, labels: Mapping[str, Column], us: str, every: int, value: Column, order: Sequence[str]
) -> DataFrame:
    """Last value of each interval; a quiet interval has no sample."""
    names = [f"_label_{n}" for n in labels]
    at = _scrape_time(us, every)
    last = df.groupBy(*[c.alias(n) for n, c in zip(names, labels.values())], at).agg(
        F.max_by(value, F.struct(*order)).cast("double").alias("value")
    )
    series = _series({label: F.col(n) for label, n in zip(labels, names)})
    return last.select(F.lit(metric).alias("metric"), series.alias("series"), F.lit(None).cast("double").alias("le"), "us", "value")
