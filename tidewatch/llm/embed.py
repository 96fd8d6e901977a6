"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

A codebook of unit centroids, fitted on a bounded sample, cuts the sphere into
cells. A vector lives in the cell of its nearest centroid and visits every cell
that could hold a vector within the similarity: one whose bisecting plane with
the home cell lies within the angle. Two vectors that are similar enough
therefore always meet, each as a visitor in the other's home, and a neighbour is
met exactly once, in its own home: counts need no pairs and no de-duplication.

A cell of any size is cut into blocks of at most about ``BLOCK`` residents and
visitors; a task multiplies one block of each. Out of a product come, per
visitor, the number of its neighbours and one link to the smallest component
found inside the block, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ready, stored
from tidewatch.llm.graph import components

SIMILARITY = 0.98
BLOCK = 1024
# The codebook has one centroid per so many vectors of the largest label, within these bounds.
PER_CELL = 1024
MAX_CELLS = 1024
# Vectors the codebook is fitted on; its quality changes the work and never the links.
SAMPLE = 20_000
ROUNDS = 12
NEAR = 1e-9


def fit_codebook(vectors: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors by spherical k-means; deterministic, at most ``cells``."""
    if not len(vectors) or cells < 2:
        return np.zeros((0, vectors.shape[1] if vectors.ndim == 2 else 0))
    centres = [vectors[0]]
    near = vectors @ centres[0]
    for _ in range(min(cells, len(vectors)) - 1):
        far = int(np.argmin(near))
        centres.append(vectors[far])
        near = np.maximum(near, vectors @ vectors[far])
    centres = np.array(centres)
    for _ in range(rounds):
        home = np.argmax(vectors @ centres.T, axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, home, vectors)
        norm = np.linalg.norm(total, axis=1)
        centres = np.where(norm[:, None] > 0, total / np.where(norm > 0, norm, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, unit): vectors that can link, scaled to length 1 in double precision."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0))
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    top = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("top", top).where("top > 0")
    # Scaled by the largest component first, so that the squares neither overflow nor vanish.
    scaled = rows.withColumn("v", F.transform("v", lambda x: x / F.col("top")))
    norm = scaled.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))
    return norm.select("vec_id", "label", F.size("v").alias("dim"), F.transform("v", lambda x: x / F.col("norm")).alias("unit"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def visited(units: np.ndarray, book: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(home of each unit vector, mask of the cells it visits)."""
    near = units @ book.T
    home = np.argmax(near, axis=1)
    span = np.linalg.norm(book[:, None, :] - book[None, :, :], axis=2)
    sine = math.sqrt(max(0.0, 1 - similarity * similarity))
    mask = near[np.arange(len(units)), home][:, None] - near <= sine * span[home] + NEAR
    return home, mask


def placed(units: DataFrame, book: np.ndarray, dim: int, similarity: float) -> DataFrame:
    """(vec_id, label, dim, unit, home, visits); vectors of another length than the codebook's share cell 0."""

    def place(batches):
        for batch in batches:
            n = batch.num_rows
            home, visits = np.zeros(n, np.int32), [[0]] * n
            rows = np.flatnonzero(batch.column("dim").to_numpy() == dim) if len(book) else np.zeros(0, np.int64)
            if len(rows):
                at, mask = visited(matrix(batch.column("unit").take(pa.array(rows)), dim), book, similarity)
                home[rows] = at
                for r, m in zip(rows.tolist(), mask):
                    visits[r] = np.flatnonzero(m).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home, pa.int32()), pa.array(visits, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "home", "visits"],
            )

    schema = f"vec_id long, label {units.schema['label'].dataType.simpleString()}, dim int, unit array<double>, home int, visits array<int>"
    return units.mapInArrow(place, schema)


def block_links(table: pa.Table, similarity: float) -> pa.Table:
    """Of one block: each visitor's number of neighbours and a link to its component inside the block."""
    dim = table.column("dim")[0].as_py()
    guest = table.column("guest").to_numpy(zero_copy_only=False)
    ids, units = table.column("vec_id").to_numpy(), matrix(table.column("unit"), dim)
    gi, gv, ri, rv = ids[guest], units[guest], ids[~guest], units[~guest]
    near = gv @ rv.T >= similarity if len(gi) and len(ri) else np.zeros((len(gi), len(ri)), bool)
    near &= gi[:, None] != ri[None, :]
    count = near.sum(axis=1)
    # Smallest label spreads over the block's bipartite graph until nothing changes.
    own, other = gi.copy(), ri.copy()
    big = np.iinfo(np.int64).max
    rows, cols = np.nonzero(near)
    while len(rows):
        low = np.full(len(ri), big)
        np.minimum.at(low, cols, own[rows])
        other_new = np.minimum(other, low)
        low = np.full(len(gi), big)
        np.minimum.at(low, rows, other_new[cols])
        own_new = np.minimum(own, low)
        if (own_new == own).all() and (other_new == other).all():
            break
        own, other = own_new, other_new
    linked = count > 0
    met = near.any(axis=0) if len(rows) else np.zeros(len(ri), bool)
    u = np.concatenate((gi[linked], ri[met]))
    v = np.concatenate((own[linked], other[met]))
    n = np.concatenate((count[linked], np.zeros(int(met.sum()), np.int64)))
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "n": pa.array(n, pa.int64())})


def duplicate_vectors(vectors: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors link when their labels are equal and not null and their cosine is at
    least ``similarity``. Null, empty, zero and non-finite vectors, vectors with
    a null component and vectors of unequal length link with nothing. Rows that
    repeat a vec_id are one vector; of unequal ones each is compared. A row
    without vec_id is returned alone. An empty table gives no rows.
    """
    spark = ready(vectors.sparkSession)
    units = stored(usable(vectors), "embed-units").distinct()
    sizes = units.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n").alias("n"), F.max_by("dim", "n").alias("dim")).first()
    dim, cells = largest["dim"] or 0, min(MAX_CELLS, -(-(largest["n"] or 0) // PER_CELL))
    chosen = units.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample if cells > 1 else 0)
    rows = np.array([r["unit"] for r in chosen.select("unit").collect()], np.float64)
    homes = stored(placed(units, fit_codebook(rows.reshape(len(rows), dim), cells), dim, similarity), "embed-cells")

    place = ["label", "dim", "cell"]
    visits = homes.withColumn("cell", F.explode("visits"))
    filled = homes.groupBy("label", "dim", F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("nr"))
    calls = visits.groupBy(*place).agg(F.count(F.lit(1)).alias("nv"))
    # One row per label and cell, so bounded by the labels times MAX_CELLS.
    blocks = filled.join(calls, place).select(*place, F.ceil(F.col("nr") / block).cast("int").alias("rb"), F.ceil(F.col("nv") / block).cast("int").alias("vb"))
    turn = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["vec_id", *place, "unit"]
    residents = homes.withColumn("cell", F.col("home")).select(*keep).join(blocks, place)
    residents = residents.select(*keep, turn("rb").alias("r"), every("vb").alias("g"), F.lit(False).alias("guest"))
    guests = visits.select(*keep).join(blocks, place)
    guests = guests.select(*keep, turn("vb").alias("g"), every("rb").alias("r"), F.lit(True).alias("guest"))
    found = residents.unionByName(guests).groupBy(*place, "r", "g").applyInArrow(lambda t: block_links(t, similarity), "u long, v long, n long")
    found = stored(found, "embed-links")

    counts = found.groupBy(F.col("u").alias("vec_id")).agg(F.sum("n").alias("n_links"))
    group = components(found.select("u", "v")).withColumnRenamed("node", "vec_id")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"))
    rows = rows.join(counts, "vec_id", "left").join(group, "vec_id", "left")
    named = F.coalesce("component", "vec_id")
    return rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), named.alias("component_id"),
        F.coalesce(F.col("vec_id") == named, F.lit(True)).alias("kept"),
    )
