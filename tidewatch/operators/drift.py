"""Two-sample Kolmogorov-Smirnov statistic per feature, exact and distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scan import BLOCK_ROWS, Running, running, value_bin
from tidewatch.session import written


def long_values(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``feature, value``; NULL and NaN are dropped."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return df.select(*keep, F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))


def _share(part: Column | str, whole: str) -> Column:
    return F.try_divide(F.col(part) if isinstance(part, str) else part, F.col(whole))


def ks_drift(
    values: DataFrame, is_current: Column, by: Sequence[str] = ("feature",), rows: Column | None = None, limit: int = BLOCK_ROWS
) -> DataFrame:
    """Largest distance of the distributions of reference and current rows.

    Equal values are counted first and the counts written; they are scanned in
    value order, in value bins, and a bin with more than ``limit`` values is cut
    at edges taken from the data, so a feature with very many distinct values,
    however close, is spread over many tasks. ``rows`` is how many rows a row of
    ``values`` stands for. Every group is returned with its row counts; the
    score of one that lacks a side is NULL.
    """
    n = F.lit(1) if rows is None else rows
    side = lambda part: F.sum(F.when(part, n).otherwise(0)).cast("long")
    counts = written(values.groupBy(*by, "value").agg(side(~is_current).alias("_ref"), side(is_current).alias("_cur")), "drift-counts")
    upto = running(
        counts,
        list(by),
        ["value"],
        value_bin("value"),
        {
            "_ref_upto": Running("sum", F.col("_ref")),
            "_cur_upto": Running("sum", F.col("_cur")),
            "reference_rows": Running("total", F.col("_ref")),
            "current_rows": Running("total", F.col("_cur")),
        },
        limit,
    )
    distance = F.abs(_share("_ref_upto", "reference_rows") - _share("_cur_upto", "current_rows"))
    return upto.groupBy(*by, "reference_rows", "current_rows").agg(F.max(distance).alias("drift_score"))


def ks_windows(
    reference: DataFrame, current: DataFrame, window: str, by: Sequence[str] = (), rows: Column | None = None,
    reference_rows: Column | None = None, limit: int = BLOCK_ROWS,
) -> DataFrame:
    """Drift of every window of ``current`` against one common reference.

    The distance peaks at a current value or right before one, so the reference
    is ranked once, at the values that occur, and not repeated per window.
    Without reference rows the score is NULL. ``rows`` is how many rows a row of
    ``current`` stands for, where equal values are already counted, and
    ``reference_rows`` the same of ``reference``. Both sides are counted and the
    counts written, so that no use counts again; ``limit`` is as in ``ks_drift``.
    """
    keys = list(by) or ["_all"]
    whole = (lambda df: df) if by else (lambda df: df.withColumn("_all", F.lit(0)))
    clean = F.col("value").isNotNull() & ~F.isnan("value")
    total = lambda n: (F.count(F.lit(1)) if n is None else F.sum(n)).cast("long")
    ref = whole(reference).where(clean).groupBy(*keys, "value").agg(total(reference_rows).alias("_ref"))
    cur = written(whole(current).where(clean).groupBy(*keys, window, "value").agg(total(rows).alias("_cur")), "drift-current")
    places = cur.select(*keys, "value", F.lit(0).cast("long").alias("_ref")).unionByName(ref)
    places = written(places.groupBy(*keys, "value").agg(F.sum("_ref").alias("_ref")), "drift-places")
    ranked = running(
        places, keys, ["value"], value_bin("value"),
        {"_ref_upto": Running("sum", F.col("_ref")), "reference_rows": Running("total", F.col("_ref"))}, limit,
    )
    met = written(cur.join(ranked, [*keys, "value"]), "drift-met")
    # A window is one block, as bins would hold a value or two each; ``limit`` cuts a large one.
    upto = running(
        met, [*keys, window], ["value"], F.lit(0).cast("long"),
        {"_cur_upto": Running("sum", F.col("_cur")), "current_rows": Running("total", F.col("_cur"))}, limit,
    )
    at = F.abs(_share("_ref_upto", "reference_rows") - _share("_cur_upto", "current_rows"))
    before = F.abs(_share(F.col("_ref_upto") - F.col("_ref"), "reference_rows") - _share(F.col("_cur_upto") - F.col("_cur"), "current_rows"))
    return upto.groupBy(*by, window, "reference_rows", "current_rows").agg(F.max(F.greatest(at, before)).alias("drift_score"))
