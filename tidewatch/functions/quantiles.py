"""Exact interpolated percentiles without a per-group buffer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.scan import BLOCK_ROWS, split_blocks, value_bin
from tidewatch.session import written


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], limit: int = BLOCK_ROWS
) -> DataFrame:
    """One row per group with the percentiles named in ``probs``.

    The built-in exact ``percentile`` keeps every distinct value of a group in
    one buffer. Here values are first counted (map-side combined) and the counts
    written. Bins of the value range are counted per group; a bin with more than
    ``limit`` distinct values, however close they lie, is cut at sampled order
    statistics. Only blocks that hold a wanted rank are ordered.
    """
    return percentiles_of_counts(value_counts(df.where(F.col(value).cast("double").isNotNull()), keys, value), keys, probs, limit)


def value_counts(df: DataFrame, keys: Sequence[str], value: str, more: Mapping[str, Column] | None = None) -> DataFrame:
    """A written table with one row per group and distinct value, null included: the value as double in
    ``_v``, its rows in ``_n``, and the aggregates ``more``. Whatever adds up can be read from it without
    another pass over ``df``."""
    extra = [c.alias(n) for n, c in (more or {}).items()]
    counts = df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"), *extra)
    return written(counts, "value-counts")


def percentiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Mapping[str, float], limit: int = BLOCK_ROWS) -> DataFrame:
    """``exact_percentiles`` of the values that ``value_counts`` has counted; nulls do not count."""
    names = list(probs)
    counts = counts.where(F.col("_v").isNotNull())
    counts = split_blocks(counts, keys, ["_v"], F.coalesce(value_bin("_v"), F.lit(0).cast("long")), limit).select("_key", "_block", "_v", "_n")
    group = Window.partitionBy("_key")
    before = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # Rank of p among n values is p * (n - 1), between its floor and its ceiling.
    ranks = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.lit(side).alias("side"),
                getattr(F, side)(F.lit(float(probs[n])) * (F.col("_total") - 1)).cast("long").alias("rank"),
            )
            for i, n in enumerate(names)
            for side in ("floor", "ceil")
        ]
    )
    wanted = lambda low, high: F.filter(ranks, lambda r: (r["rank"] >= low) & (r["rank"] < high))
    blocks = (
        counts.groupBy("_key", "_block")
        .agg(F.sum("_n").alias("_block_n"))
        .withColumns({"_before": F.coalesce(F.sum("_block_n").over(before), F.lit(0)), "_total": F.sum("_block_n").over(group)})
        .withColumn("_ranks", wanted(F.col("_before"), F.col("_before") + F.col("_block_n")))
        .where(F.size("_ranks") > 0)
        .select("_key", "_block", "_before", "_total", "_ranks")
    )
    inside = Window.partitionBy("_key", "_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    held = lambda r: (r["rank"] >= F.col("_upto") - F.col("_n")) & (r["rank"] < F.col("_upto"))
    hits = (
        counts.join(blocks, ["_key", "_block"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))
        .withColumn("_rank", F.explode(F.filter("_ranks", held)))
    )
    picks = []
    for i, n in enumerate(names):
        is_low = (F.col("_rank.i") == i) & (F.col("_rank.side") == "floor")
        is_high = (F.col("_rank.i") == i) & (F.col("_rank.side") == "ceil")
        low = F.max(F.when(is_low, F.col("_v")))
        high = F.max(F.when(is_high, F.col("_v")))
        position = F.lit(float(probs[n])) * (F.max("_total") - 1)
        picks.append((low + (high - low) * (position - F.floor(position))).alias(n))
    out = hits.groupBy("_key").agg(*picks)
    return out.select(*[F.col(f"_key.{k}").alias(k) for k in keys], *names)
