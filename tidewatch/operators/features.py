"""Feature engineering for transaction scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.scan import DAY, Running, running, time_block
from tidewatch.functions.skew import salted_join

# The nine model inputs in training order.
FEATURE_NAMES = [
    "transaction_amount",
    "hour_of_day",
    "day_of_week",
    "merchant_category",
    "user_age_days",
    "tx_count_24h",
    "amount_deviation",
    "is_international",
    "device_trust_score",
]


def trailing_count(
    df: DataFrame, key: str, us: str, row_id: Sequence[str], span_us: int, name: str, block_us: int = DAY
) -> DataFrame:
    """Rows of the same key in ``[us - span, us]``, the row and its ties included.

    Count up to ``us`` minus count before ``us - span``. Both are points of one
    running count, so each row is joined by a probe row at the lower edge; a
    range frame would rescan the span for every row and keep a key in one task.
    Blocks shorter than a key's usual gap hold one point each: their totals are
    then as many as the points.
    """
    probe = F.struct(
        (F.col(us) - span_us).alias("at"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("one"), F.lit(-1).alias("sign")
    )
    # The upper edge is read after all rows at the same instant.
    row = F.struct(F.col(us).alias("at"), F.lit(1).alias("rank"), F.lit(1).cast("long").alias("one"), F.lit(0).alias("sign"))
    upper = F.struct(F.col(us).alias("at"), F.lit(2).alias("rank"), F.lit(0).cast("long").alias("one"), F.lit(1).alias("sign"))
    points = df.select(key, *row_id, F.explode(F.array(probe, row, upper)).alias("p")).select(key, *row_id, "p.*")
    scanned = running(
        points, [key], ["at", "rank", *row_id], time_block("at", block_us), {"_upto": Running("sum", F.col("one"))}
    )
    counts = (
        scanned.where(F.col("sign") != 0)
        .groupBy(*row_id)
        .agg(F.sum(F.col("_upto") * F.col("sign")).cast("long").alias(name))
    )
    return df.join(counts, list(row_id), "left")


def amount_deviation(
    df: DataFrame, key: str, amount: str, spread: Sequence[str], name: str, source: DataFrame | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Distance from the key's mean in sample standard deviations.

    The statistics are combined map-side and joined back with a salt on hot
    keys only. ``source`` has the same keys and amounts as ``df`` at less cost.
    Combined sums depend on how the rows are dealt: an amount that equals the
    mean may end a rounding error above or below it. With ``order`` such
    distances are taken from the mean summed in that order, whatever the
    partitions; only the keys that have one are read again.
    """
    source = df if source is None else source
    noise = F.avg(F.abs(amount)) * F.count(amount) * F.lit(2.0**-52)
    stats = source.groupBy(key).agg(F.avg(amount).alias("_mean"), F.stddev_samp(amount).alias("_std"), noise.alias("_noise"))
    if order:
        close = (F.abs(F.col(amount) - F.col("_mean")) <= F.col("_noise")) & (F.col("_std") > 0)
        tied = salted_join(source.select(key, amount, *spread), stats, [key], spread, counted=source).where(close).select(key).distinct()
        upto = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        summed = source.join(tied, key, "left_semi").withColumn("_upto", F.sum(amount).over(upto))
        ordered = summed.groupBy(key).agg((F.max_by("_upto", F.struct(*order)) / F.count(amount)).alias("_ordered"))
        stats = stats.join(ordered, key, "left")
    joined = salted_join(df, stats, [key], spread, counted=source)
    std = F.nullif(F.col("_std"), F.lit(0.0))
    mean = F.coalesce("_ordered", "_mean") if order else F.col("_mean")
    return joined.withColumn(name, (F.col(amount) - mean) / std).drop("_mean", "_std", "_noise", "_ordered")


def fraud_label(
    amount: Column | str = "transaction_amount",
    international: Column | str = "is_international",
    age: Column | str = "user_age_days",
    recent: Column | str = "tx_count_24h",
) -> Column:
    """Weighted label rule; the training noise term is left out."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    # Thresholds and weights of the label rule, in tenths so that
    # the comparison is exact.
    weights = [
        (col(amount) > 500, 4),
        (col(international).cast("boolean"), 3),
        (col(age) < 90, 2),
        (col(recent) > 10, 1),
    ]
    score = sum((F.when(hit, weight).otherwise(0) for hit, weight in weights), F.lit(0))
    return score > 4


def missing_rates(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Share of null or NaN values per feature (long form), optionally per group."""
    types = dict(df.dtypes)

    def bad(name: str) -> Column:
        null = F.col(name).isNull()
        return null | F.isnan(name) if types[name] in ("double", "float") else null

    wide = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(bad(f)).alias(f) for f in features]
    )
    return wide.unpivot([*by, "rows"], list(features), "feature_name", "missing").withColumn(
        "missing_rate", F.col("missing") / F.col("rows")
    )
