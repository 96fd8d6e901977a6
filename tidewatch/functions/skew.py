"""Joins that survive a hot key on the fact side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of all rows. At most 1 / HOT_SHARE keys can be
# above it, which bounds the broadcast list of hot keys, and a salted piece of a
# hot key holds about this share of the rows.
HOT_SHARE = 1.0e-4
NULL_SALTS = 10_000


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    residual: Column | None = None,
    share: float = HOT_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join ``facts`` with ``dim``; only hot keys are salted.

    ``spread`` names fact columns that tell the rows of one key apart; the salt
    is a hash of them and so is the same when a lost task is run again. The keys
    are counted in ``counted``, which has as many rows of each as ``facts``.
    """
    counts = (facts if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    limit = counts.agg((F.sum("_n") * share).alias("limit")).scalar()
    hot = (
        counts.withColumn("_limit", limit)
        .where(F.col("_n") > F.col("_limit"))
        .select(*keys, F.ceil(F.col("_n") / F.greatest(F.col("_limit"), F.lit(1.0))).cast("int").alias("_salts"))
    )
    one = F.lit(1).cast("int")
    salts = F.coalesce(F.col("_salts"), one)
    # A row with a NULL key matches nothing; any salt spreads such rows.
    absent = F.lit(False)
    for k in keys:
        absent = absent | F.col(k).isNull()
    pieces = F.when(absent, F.lit(NULL_SALTS)).otherwise(salts).cast("long")
    fact_side = facts.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), pieces).cast("int")
    ).drop("_salts")
    dim_side = dim.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("int"), salts - one))
    ).drop("_salts")
    if residual is None:
        return fact_side.join(dim_side, [*keys, "_salt"], how).drop("_salt")
    f, d = fact_side.alias("f"), dim_side.alias("d")
    on = residual & (F.col("f._salt") == F.col("d._salt"))
    for k in keys:
        on = on & (F.col(f"f.{k}") == F.col(f"d.{k}"))
    dim_cols = [c for c in dim.columns if c not in keys]
    return f.join(d, on, how).select(
        *[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"d.{c}") for c in dim_cols]
    )
