"""Time-series algebra on samples: range and instant vectors on an evaluation grid.

Samples are rows of key columns, ``us`` (micros, unique per series) and
``value``. A series is cut into time blocks; a block also receives the samples
that reach into it through the look-back, so every window function runs inside
``(series, block)`` and no series is bound to one task. Each sample emits the
grid points for which it is the first or the last sample of the window; a grid
is never joined with the series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOOKBACK_US = 300 * 1_000_000
# Blocks are this many look-backs long: one sample in that many is copied.
BLOCKS = 12


def _long(value: int | Column) -> Column:
    return value.cast("long") if isinstance(value, Column) else F.lit(value).cast("long")


def _grid(low: Column, high: Column, step: Column) -> Column:
    """Multiples of ``step`` in ``[low, high]``."""
    first = F.ceil(low / step) * step
    last = F.floor(high / step) * step
    return F.when(first <= last, F.sequence(first.cast("long"), last.cast("long"), step)).otherwise(F.array().cast("array<bigint>"))


def _placed(samples: DataFrame, keys: Sequence[str], window: Column) -> tuple[DataFrame, Window]:
    width = window * BLOCKS
    placed = samples.withColumn(
        "_part", F.explode(F.sequence(F.floor(F.col("us") / width), F.floor((F.col("us") + window) / width)))
    ).withColumns({"_low": F.col("_part") * width, "_high": (F.col("_part") + 1) * width - 1})
    return placed, Window.partitionBy(*keys, "_part").orderBy("us")


def _clip(points: DataFrame, start: int | None, end: int | None) -> DataFrame:
    if start is not None:
        points = points.where(F.col("eval_us") >= start)
    if end is not None:
        points = points.where(F.col("eval_us") <= end)
    return points


def instant_vector(
    samples: DataFrame,
    keys: Sequence[str],
    step: int | Column,
    lookback: int | Column = LOOKBACK_US,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Latest sample not older than ``lookback`` at each grid point."""
    step, lookback = _long(step), _long(lookback)
    placed, w = _placed(samples, keys, lookback)
    until = F.least(F.col("us") + lookback, F.col("_high"), F.coalesce(F.lead("us").over(w) - 1, F.col("_high")))
    points = placed.withColumn("_until", until).select(
        *keys, F.explode(_grid(F.greatest("us", "_low"), F.col("_until"), step)).alias("eval_us"), F.col("us").alias("sample_us"), "value"
    )
    return _clip(points, start, end)


def range_vector(
    samples: DataFrame,
    keys: Sequence[str],
    window: int | Column,
    step: int | Column,
    carry: Sequence[str] = (),
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """First and last sample, sample count and counter increase per window.

    The window ``[t - window, t]`` is closed. ``increase`` counts a fall of the
    counter as a restart from zero. ``carry`` names columns that the keys
    determine.
    """
    window, step = _long(window), _long(step)
    placed, w = _placed(samples, keys, window)
    previous = F.lag("value").over(w)
    growth = F.when(previous.isNull(), 0.0).when(F.col("value") >= previous, F.col("value") - previous).otherwise(F.col("value"))
    known = placed.withColumns(
        {"_growth": growth, "_prev": F.lag("us").over(w), "_next": F.lead("us").over(w), "_rank": F.row_number().over(w)}
    ).withColumn("_upto", F.sum("_growth").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    as_last = _grid(
        F.greatest("us", "_low"), F.least(F.col("us") + window, F.col("_high"), F.coalesce(F.col("_next") - 1, F.col("_high"))), step
    )
    as_first = _grid(
        F.greatest(F.col("us"), F.col("_low"), F.coalesce(F.col("_prev") + window + 1, F.col("_low"))),
        F.least(F.col("us") + window, F.col("_high")),
        step,
    )
    mark = lambda role: lambda t: F.struct(t.alias("eval_us"), F.lit(role).alias("role"))
    ends = known.select(
        *keys,
        *carry,
        F.struct("us", "value", "_upto", "_rank").alias("s"),
        F.explode(F.concat(F.transform(as_first, mark("first")), F.transform(as_last, mark("last")))).alias("p"),
    )
    points = ends.groupBy(*keys, F.col("p.eval_us").alias("eval_us")).agg(
        F.max(F.when(F.col("p.role") == "first", F.col("s"))).alias("a"),
        F.max(F.when(F.col("p.role") == "last", F.col("s"))).alias("b"),
        *[F.first(c).alias(c) for c in carry],
    )
    out = points.select(
        *keys,
        *carry,
        "eval_us",
        F.col("a.us").alias("first_us"),
        F.col("b.us").alias("last_us"),
        F.col("a.value").alias("first_value"),
        F.col("b.value").alias("last_value"),
        (F.col("b._rank") - F.col("a._rank") + 1).alias("samples"),
        (F.col("b._upto") - F.col("a._upto")).alias("increase"),
    )
    return _clip(out, start, end)


def extrapolated(window: int | Column) -> Column:
    """``increase`` stretched to the window edges.

    A gap to an edge is filled when it is below 1.1 mean sample distances, else
    by half a distance, and never to before the counter's zero.
    """
    window = _long(window)
    covered = (F.col("last_us") - F.col("first_us")).cast("double")
    distance = covered / F.nullif(F.col("samples") - 1, F.lit(0).cast("long"))
    to_start = (F.col("first_us") - (F.col("eval_us") - window)).cast("double")
    to_end = (F.col("eval_us") - F.col("last_us")).cast("double")
    to_zero = F.when(
        (F.col("increase") > 0) & (F.col("first_value") >= 0), covered * (F.col("first_value") / F.nullif(F.col("increase"), F.lit(0.0)))
    )
    to_start = F.least(to_start, to_zero)  # least ignores NULL
    reach = lambda gap: F.when(gap < distance * 1.1, gap).otherwise(distance / 2)
    return F.col("increase") * ((covered + reach(to_start) + reach(to_end)) / F.nullif(covered, F.lit(0.0)))


def increase(samples: DataFrame, keys: Sequence[str], window: int, step: int, extrapolate: bool = False, **range_args) -> DataFrame:
    """Counter increase per window; needs two samples in the window."""
    vector = range_vector(samples, keys, window, step, **range_args).where(F.col("samples") >= 2)
    value = extrapolated(window) if extrapolate else F.col("increase")
    return vector.select(*keys, "eval_us", value.alias("value"))


def rate(samples: DataFrame, keys: Sequence[str], window: int, step: int, extrapolate: bool = False, **range_args) -> DataFrame:
    """Per-second increase over the window."""
    grown = increase(samples, keys, window, step, extrapolate, **range_args)
    return grown.withColumn("value", F.col("value") / F.lit(window / 1e6))


def histogram_quantile(q: float | Column, buckets: DataFrame, keys: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Quantile from cumulative buckets (``le``, ``value``) per key group.

    A group has one row per bound. Without a +Inf bucket, with fewer than two
    buckets or with no observations the result is NaN; a rank in the +Inf bucket
    gives the highest finite bound.
    """
    q = q if isinstance(q, Column) else F.lit(float(q))
    w = Window.partitionBy(*keys).orderBy("le")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    nan = F.lit(float("nan"))
    ordered = buckets.withColumn("_n", F.max("value").over(upto)).withColumns(
        {
            "_before": F.coalesce(F.lag("_n").over(w), F.lit(0.0)),
            "_edge": F.lag("le").over(w),
            "_total": F.max("_n").over(whole),
            "_top": F.max("le").over(whole),
            "_bounds": F.count(F.lit(1)).over(whole),
            "_last": F.lead("le").over(w).isNull(),
        }
    )
    rank = q * F.col("_total")
    bottom = F.coalesce(F.col("_edge"), F.lit(0.0))
    inside = bottom + (F.col("le") - bottom) * ((rank - F.col("_before")) / F.nullif(F.col("_n") - F.col("_before"), F.lit(0.0)))
    value = (
        F.when((F.col("_top") != float("inf")) | (F.col("_bounds") < 2) | (F.col("_total") == 0), nan)
        .when(q < 0, F.lit(float("-inf")))
        .when(q > 1, F.lit(float("inf")))
        .when(F.col("_last"), F.col("_edge"))
        .when(F.col("_edge").isNull() & (F.col("le") <= 0), F.col("le"))
        .otherwise(inside)
    )
    # The wanted bucket is the first whose count reaches the rank.
    reached = ((F.col("_n") >= rank) | F.col("_last")).cast("int")
    return (
        ordered.withColumns({"quantile": value, "_reached": reached})
        .withColumn("_first", F.sum("_reached").over(upto))
        .where((F.col("_reached") == 1) & (F.col("_first") == 1))
        .select(*keys, *carry, F.col("quantile").alias("value"))
    )


def combine(left: DataFrame, right: DataFrame, on: Sequence[str], result: Column, how: str = "inner") -> DataFrame:
    """Vector matching: one-to-one on equal labels and evaluation time.

    ``result`` is written in ``l`` and ``r``, the two values.
    """
    joined = left.withColumnRenamed("value", "l").join(right.select(*on, "eval_us", F.col("value").alias("r")), [*on, "eval_us"], how)
    return joined.withColumn("value", result).drop("l", "r")


def sum_by(vector: DataFrame, by: Sequence[str]) -> DataFrame:
    return vector.groupBy(*by, "eval_us").agg(F.sum("value").alias("value"))


def avg_by(vector: DataFrame, by: Sequence[str]) -> DataFrame:
    return vector.groupBy(*by, "eval_us").agg(F.avg("value").alias("value"))


def ratio_of(vector: DataFrame, part: Column, by: Sequence[str]) -> DataFrame:
    """Share of the series matched by ``part`` in all series with the same ``by``
    labels. One aggregation instead of a join; groups without a matching series
    give no row, as an inner match would."""
    return (
        vector.groupBy(*by, "eval_us")
        .agg(F.sum(F.when(part, F.col("value"))).alias("_part"), F.sum("value").alias("_all"))
        .where(F.col("_part").isNotNull())
        .select(*by, "eval_us", F.when(F.col("_all") != 0, F.col("_part") / F.col("_all")).otherwise(F.lit(float("nan"))).alias("value"))
    )


def age(vector: DataFrame) -> DataFrame:
    """Seconds between the evaluation time and a gauge that holds Unix seconds."""
    return vector.withColumn("value", F.col("eval_us") / 1e6 - F.col("value"))


def seasonal_baseline(
    df: DataFrame, by: Sequence[str], day: str, slot: str, value: str, days: int = 7, name: str = "baseline"
) -> DataFrame:
    """Add the median of ``value`` at the same ``slot`` of the ``days`` days before.

    ``day`` is a day number, one row per group, day and slot. A day without a
    row counts as absent; without any earlier day the baseline is NULL. The
    median does not follow a single spike, as a mean would. A window holds at
    most ``days`` rows, and its partitions one row a day.
    """
    before = Window.partitionBy(*by, slot).orderBy(day).rangeBetween(-days, -1)
    held = F.array_sort(F.collect_list(F.col(value).cast("double")).over(before))
    n = F.size("_held")
    at = lambda i: F.try_element_at("_held", i.cast("int") + 1)
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    return df.withColumn("_held", held).withColumn(name, F.when(n > 0, middle)).drop("_held")
