"""Running values over ordered data that survive a hot key and a hot instant.

A plain ``sum().over(partitionBy(key).orderBy(time))`` sends a whole key to one
task. Here each key is cut into blocks (a time slice or a value bin). Rows are
scanned inside ``(key, block)``; block totals are aggregated map-side and
scanned per key; the carry of earlier blocks is joined back. The second scan
sees one row per block, so its size depends on the covered span and not on the
number of rows. A block with too many rows is cut again at edges taken from the
data (``split_blocks``).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import written

MICROS = 1_000_000
MINUTE = 60 * MICROS
HOUR = 60 * MINUTE
DAY = 24 * HOUR
# Rows of a key that one task may scan.
BLOCK_ROWS = 1_000_000
# Lists of crowded blocks are broadcast up to this length.
BROADCAST_BLOCKS = 100_000


@dataclass(frozen=True)
class Running:
    """One running value: ``fold`` is ``sum``, ``max``, ``last`` (last non-null
    value so far), ``next`` (value of the following row) or ``total`` (sum of the
    whole key, at every row)."""

    fold: str
    expr: Column
    inclusive: bool = True


def time_block(us: Column | str, width: int) -> Column:
    us = F.col(us) if isinstance(us, str) else us
    return F.floor(us / F.lit(width)).cast("long")


def value_bin(value: Column | str, per_e: int = 1024) -> Column:
    """Monotone bin of a double: ``per_e`` bins for each factor e, both signs.

    The number of bins is bounded by the exponent range of a double.
    """
    v = F.col(value) if isinstance(value, str) else value
    v = v.cast("double")
    shift = 750 * per_e  # ln of the smallest double is about -745
    size = F.floor(F.least(F.ln(F.abs(v)), F.lit(740.0)) * per_e).cast("long") + F.lit(shift)
    return F.when(v == 0, F.lit(0).cast("long")).when(v > 0, size).otherwise(-size)


def _key_of(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("g"))


def split_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, limit: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_key`` and ``_block``: the blocks of ``block``, those of more than ``limit`` rows cut into parts.

    Rows are counted per key and block. The rows of crowded blocks alone are then
    range-partitioned by key and the whole ``order``: Spark samples the order
    statistics and cuts wherever the rows are, inside one instant too, as long
    as ``order`` tells rows apart. The parts are written, so that every later
    use sees the same edges. ``_block`` orders by block, then by part.
    """
    on = ["_key", "_coarse"]
    base = df.withColumns({"_key": _key_of(keys), "_coarse": block})
    crowded = base.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    found = crowded.agg(F.count(F.lit(1)).alias("blocks"), F.sum("_n").alias("rows")).first()
    whole = F.struct("_coarse", F.lit(-1).alias("_part"))
    if not found["blocks"]:
        return base.withColumn("_block", whole).drop("_coarse")
    listed = written(crowded.select(*on), "crowded")
    side = F.broadcast(listed) if found["blocks"] <= BROADCAST_BLOCKS else listed
    # Half of the limit leaves room for the error of the sampled edges.
    parts = math.ceil(2 * found["rows"] / limit)
    cut = base.join(side, on, "left_semi").repartitionByRange(parts, "_key", *order).withColumn("_part", F.spark_partition_id())
    cut = written(cut, "blocks").withColumn("_block", F.struct("_coarse", "_part")).drop("_part")
    return base.join(side, on, "left_anti").withColumn("_block", whole).unionByName(cut).drop("_coarse")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    block: Column,
    values: Mapping[str, Running],
    limit: int | None = None,
) -> DataFrame:
    """Add the running columns ``values`` per ``keys`` in the order ``order``.

    ``block`` must be monotone in ``order[0]``. Null keys form a group. With
    ``limit`` no block holds many more rows than that, however close they lie;
    the rows are then counted before the plan is made.
    """
    names = list(values)
    placed = df.withColumns({"_key": _key_of(keys), "_block": block}) if limit is None else split_blocks(df, keys, order, block, limit)
    base = placed.withColumns({f"_v{i}": values[n].expr for i, n in enumerate(names)})
    rows = Window.partitionBy("_key", "_block").orderBy(*order)
    first = Window.unboundedPreceding
    local, totals, carries, combined = {}, [], {}, {}
    by_block = Window.partitionBy("_key").orderBy("_block").rowsBetween(first, -1)
    for i, name in enumerate(names):
        spec = values[name]
        frame = rows.rowsBetween(first, 0 if spec.inclusive else -1)
        v = F.col(f"_v{i}")
        if spec.fold == "last":
            local[f"_l{i}"] = F.last(v, ignorenulls=True).over(frame)
            position = F.when(v.isNotNull(), F.struct(*[F.col(o) for o in order]))
            totals.append(F.max_by(v, position).alias(f"_t{i}"))
            carries[f"_c{i}"] = F.last(f"_t{i}", ignorenulls=True).over(by_block)
            combined[name] = F.coalesce(f"_l{i}", f"_c{i}")
        elif spec.fold == "next":
            local[f"_l{i}"] = F.lead(v).over(rows)
            totals.append(F.min_by(v, F.struct(*[F.col(o) for o in order])).alias(f"_t{i}"))
            carries[f"_c{i}"] = F.lead(f"_t{i}").over(Window.partitionBy("_key").orderBy("_block"))
            combined[name] = F.coalesce(f"_l{i}", f"_c{i}")
        elif spec.fold == "total":
            totals.append(F.sum(v).alias(f"_t{i}"))
            carries[f"_c{i}"] = F.sum(f"_t{i}").over(Window.partitionBy("_key"))
            combined[name] = F.col(f"_c{i}")
        elif spec.fold == "max":
            local[f"_l{i}"] = F.max(v).over(frame)
            totals.append(F.max(v).alias(f"_t{i}"))
            carries[f"_c{i}"] = F.max(f"_t{i}").over(by_block)
            combined[name] = F.greatest(f"_l{i}", f"_c{i}")
        elif spec.fold == "sum":
            local[f"_l{i}"] = F.sum(v).over(frame)
            totals.append(F.sum(v).alias(f"_t{i}"))
            carries[f"_c{i}"] = F.sum(f"_t{i}").over(by_block)
            zero = F.lit(0)
            combined[name] = F.coalesce(f"_l{i}", zero) + F.coalesce(f"_c{i}", zero)
        else:
            raise ValueError(f"unknown fold {spec.fold}")
    carry = (
        base.groupBy("_key", "_block")
        .agg(*totals)
        .withColumns(carries)
        .select("_key", "_block", *carries)
    )
    joined = base.withColumns(local).join(carry, ["_key", "_block"], "left")
    return joined.withColumns(combined).select(*df.columns, *names)


def running_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str
) -> DataFrame:
    """``row_number`` per key, hot-key safe."""
    return running(df, keys, order, block, {name: Running("sum", F.lit(1).cast("long"))})


def islands(df: DataFrame, keys: Sequence[str], us: str, gap: Column, block_width: int, carry: Sequence[str]) -> DataFrame:
    """Merge points at most ``gap`` micros apart into islands, per key.

    Islands are first built inside time blocks and then stitched, so the second
    pass sees islands, not points. ``carry`` columns keep the value at the last
    point as ``last_<name>`` and at the first one as ``first_<name>``.
    """
    key = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("g"))
    base = df.withColumns({"_key": key, "_gap": gap, "_block": time_block(us, block_width)})
    w = Window.partitionBy("_key", "_block").orderBy(us)
    start = F.when(F.col(us) - F.lag(us).over(w) <= F.col("_gap"), 0).otherwise(1)
    local = base.withColumn("_start", start).withColumn("_island", F.sum("_start").over(w))
    parts = local.groupBy("_key", "_block", "_island").agg(
        F.min(us).alias("start_us"),
        F.max(us).alias("end_us"),
        F.count(F.lit(1)).alias("points"),
        F.max("_gap").alias("_gap"),
        *[F.min_by(c, us).alias(f"first_{c}") for c in carry],
        *[F.max_by(c, us).alias(f"last_{c}") for c in carry],
    )
    k = Window.partitionBy("_key").orderBy("start_us")
    joins = F.when(F.col("start_us") - F.lag("end_us").over(k) <= F.col("_gap"), 0).otherwise(1)
    merged = (
        parts.withColumn("_start", joins)
        .withColumn("_island", F.sum("_start").over(k))
        .groupBy("_key", "_island")
        .agg(
            F.min("start_us").alias("start_us"),
            F.max("end_us").alias("end_us"),
            F.sum("points").alias("points"),
            *[F.min_by(f"first_{c}", "start_us").alias(f"first_{c}") for c in carry],
            *[F.max_by(f"last_{c}", "end_us").alias(f"last_{c}") for c in carry],
        )
    )
    return merged.select(*[F.col(f"_key.{k}").alias(k) for k in keys], *[c for c in merged.columns if not c.startswith("_")])


def merged_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, block_width: int) -> DataFrame:
    """The union of the intervals of each key as disjoint stretches ``keys, start, end``; touching ones join.

    Intervals are merged inside blocks of their start with a running maximum of
    the ends, then the merged ones across blocks.
    """
    first = Window.unboundedPreceding
    base = df.select(_key_of(keys).alias("_key"), start, end, time_block(start, block_width).alias("_block"))

    def merged(rows: DataFrame, within: list[str]) -> DataFrame:
        w = Window.partitionBy(*within).orderBy(start, end)
        opens = F.when(F.max(end).over(w.rowsBetween(first, -1)) >= F.col(start), 0).otherwise(1)
        tagged = rows.withColumn("_opens", opens).withColumn("_n", F.sum("_opens").over(w.rowsBetween(first, 0)))
        return tagged.groupBy(*within, "_n").agg(F.min(start).alias(start), F.max(end).alias(end))

    whole = merged(merged(base, ["_key", "_block"]), ["_key"])
    return whole.select(*[F.col(f"_key.{k}").alias(k) for k in keys], start, end)


def overlapping(
    df: DataFrame, keys: Sequence[str], start: str, end: str, tie: Sequence[str], block_width: int, name: str
) -> DataFrame:
    """Number the groups of overlapping intervals of each key.

    Intervals are first merged inside time blocks; the second pass orders the
    merged ones, which are disjoint inside a block, and the number is joined
    back.
    """
    first = Window.unboundedPreceding
    base = df.withColumns({"_key": F.struct(*[F.col(k) for k in keys]), "_block": time_block(start, block_width)})
    w = Window.partitionBy("_key", "_block").orderBy(start, *tie)
    opens = F.when(F.max(end).over(w.rowsBetween(first, -1)) >= F.col(start), 0).otherwise(1)
    local = base.withColumn("_opens", opens).withColumn("_part", F.sum("_opens").over(w.rowsBetween(first, 0)))
    parts = local.groupBy("_key", "_block", "_part").agg(F.min(start).alias("_start"), F.max(end).alias("_end"))
    k = Window.partitionBy("_key").orderBy("_start", "_block", "_part")
    merged = F.when(F.max("_end").over(k.rowsBetween(first, -1)) >= F.col("_start"), 0).otherwise(1)
    numbered = parts.withColumn("_opens", merged).withColumn(name, F.sum("_opens").over(k.rowsBetween(first, 0)))
    return local.join(numbered.select("_key", "_block", "_part", name), ["_key", "_block", "_part"]).select(*df.columns, name)
