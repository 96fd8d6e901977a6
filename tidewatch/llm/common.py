"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import fresh_path, prepare

# A side is broadcast only when its counted rows stay below this.
BROADCAST_ROWS = 1_000_000
# Rows handed to Python at once: buffers of such batches stay small enough to be reused, on both sides.
BATCH_ROWS = 250
# Text handed to Python is worked on in slices of about this many bytes.
SLICE_BYTES = 750_000


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the text operators: UTC and Arrow batches of bounded size."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back; cuts the lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast if the counted ``rows`` are few; otherwise the join shuffles."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str, folds: int = 5) -> Column:
    """True for the rows that no model may learn from; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds == 0, F.lit(True))


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """One row (doc_id, y) per document with one clear 0/1 label outside the held-out fold."""
    y = F.col(label).cast("int")
    rows = labels.select("doc_id", y.alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("doc_id"))
    return rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_top")).where("y = _top").drop("_top")


def bounded_sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled rows of each class, those with the smallest hash of the id."""
    rows = labelled(labels, label)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return rows.where("y = 0").orderBy(*order).limit(per_class).unionByName(rows.where("y = 1").orderBy(*order).limit(per_class))


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose lengths add up to about ``limit``; one long row is a range of its own."""
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


_caches: list[dict] = []


def worker_cache() -> dict:
    """What a worker keeps from task to task for one operator, until another one runs in it."""
    _caches.append({})
    return _caches[-1]


def only(cache: dict | None = None) -> None:
    """Drop what other operators keep in this worker: its memory counts against one executor, whatever ran before."""
    others = [c for c in _caches if c and c is not cache]
    for other in others:
        other.clear()
    if others:
        give_back()


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a string column without nulls, no copy."""
    only(_powers)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    for a, b in slices(np.diff(offsets), limit):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
    give_back()


def give_back() -> None:
    """Give freed memory back to the system: the workers of an executor outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


# glibc alone has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and the document of every word; words do not cross documents."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    word = ~BLANK[data]
    opens, closes = word.copy(), word.copy()
    opens[1:] &= ~word[:-1]
    closes[:-1] &= ~word[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[firsts] |= word[firsts]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closes[lasts] |= word[lasts]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x + _STEP
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(256, dtype=np.uint64))
_powers = worker_cache()


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers.get(_BASE, ())) < n:
        size = max(n, SLICE_BYTES + 1)
        _powers.update({b: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, b, np.uint64)))) for b in (_BASE, _BACK)})
    return [_powers[_BASE], _powers[_BACK]]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: differences of a running polynomial, shifted to position 0."""
    up, down = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def row_key(df_id: str = "doc_id") -> Column:
    """An id that is never null, for joins."""
    return F.coalesce(F.col(df_id).cast("long"), F.lit(-(2**63) + 1))
