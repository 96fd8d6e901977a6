"""Toxicity by a subsequence string kernel support vector machine with Nyström landmarks.

A text is read as units: its words, letters spelled out one by one being one
unit. The kernel of two units counts their common subsequences of three symbols,
each occurrence weighted by ``DECAY`` to its span; a span reaches over at most
``SPAN`` further symbols, so inserted and dropped characters weaken a match
instead of ending it. Units are scaled by a function of their length.

Landmarks are units of the labelled sample. The support vector machine is linear
in the Nyström features of the landmarks. Since the kernel is a product of
explicit feature vectors, the weighted sum over the landmarks collapses into one
table of weights per subsequence, and scoring a text is a few look-ups per
character. A document's score is that of its worst unit, and the units that
stand for a toxic document are re-chosen by the model between rounds.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_sample, held_out, text_slices

SPAN = 5
DECAY = 0.6
THRESHOLD = 0.5
# Labelled documents of each class that the model is fitted on.
SAMPLE_PER_CLASS = 2000
LANDMARKS = 96  # of each side
UNITS = 3000  # training units of each side
ROUNDS = 4
# Times as often in toxic documents as in others, for a unit to be taken up before there is a model.
CLEAR = 15
TELLING = 3
RIDGE = 1e-3
PENALTY = 1e-4

_SYMBOLS = 64
_GONE = 255


def _symbol_table() -> np.ndarray:
    """Byte -> symbol: 0 blank, 1-26 letters, 27 digits, 28-63 bytes of other letters; other ASCII is left out."""
    table = np.full(256, _GONE, np.uint8)
    table[[9, 10, 11, 12, 13, 32]] = 0
    for i in range(26):
        table[[65 + i, 97 + i]] = 1 + i
    table[48:58] = 27
    for sign, letter in zip("013457@$", "oieastas"):
        table[ord(sign)] = 1 + ord(letter) - 97
    table[128:] = 28 + np.arange(128) % 36
    return table


_TABLE = _symbol_table()


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts, ends, document) of the units of a slice of texts; every unit has a blank on both sides."""
    raw = _TABLE[data]
    kept = raw != _GONE
    total = np.concatenate(([0], np.cumsum(kept)))
    bounds = total[offsets]
    sizes = np.diff(bounds)
    docs = len(sizes)
    symbols = np.zeros(bounds[-1] + docs + 1 + SPAN, np.uint8)
    symbols[np.arange(bounds[-1]) + np.repeat(np.arange(docs), sizes) + 1] = raw[kept]
    inside = symbols != 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    doc = np.searchsorted(bounds + np.arange(docs + 1), starts - 1, side="right") - 1
    if len(starts):
        # Single letters after single letters continue a unit.
        single = ends - starts == 1
        joins = np.zeros(len(starts), bool)
        joins[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1]) & (starts[1:] - ends[:-1] == 1)
        lasts = np.append(~joins[1:], True)
        starts, ends, doc = starts[~joins], ends[lasts], doc[~joins]
    return symbols, starts, ends, doc


def scale(n: np.ndarray) -> np.ndarray:
    """The length factor of a unit of n symbols, blanks included."""
    total = np.zeros(len(n))
    for d in range(2, SPAN + 1):
        total += (d - 1) * DECAY ** (2 * (d + 1)) * np.maximum(n - d, 0)
    return np.sqrt(np.maximum(total, 1e-12))


def _reach(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every place the number of symbols to the blank that closes its unit; 0 outside units."""
    n = ends - starts + 1
    first = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(first[-1]) + np.repeat(starts - 1 - first[:-1], n)
    reach = np.zeros(len(symbols), np.int32)
    reach[place] = np.repeat(ends, n) - place
    return reach


def unit_scores(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over the subsequences of each unit of their weights, scaled by its length."""
    if not len(starts):
        return np.zeros(0)
    reach = _reach(symbols, starts, ends)
    n = len(symbols) - SPAN
    low = symbols.astype(np.int32)
    mid, high = low * _SYMBOLS, low[:n] * _SYMBOLS**2
    total = np.zeros(n, np.float32)
    for d in range(2, SPAN + 1):
        part = np.zeros(n, np.float32)
        end = high + low[d : d + n]
        for j in range(1, d):
            part += weights[end + mid[j : j + n]]
        part *= np.float32(DECAY ** (d + 1))
        part[reach[:n] < d] = 0
        total += part
    return np.add.reduceat(total, starts - 1, dtype=np.float64) / scale(ends - starts + 2)


def stream(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units given as symbol strings, laid out like a text."""
    sizes = np.array([len(x) for x in names], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1] + 1
    symbols = np.frombuffer(b"\0" + b"\0".join(names) + bytes(1 + SPAN), np.uint8)
    return symbols, starts, starts + sizes


def features(names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, subsequence, weight) of every subsequence of the units, scaled."""
    symbols, starts, ends = stream(names)
    reach, low = _reach(symbols, starts, ends), symbols.astype(np.int64)
    owner = np.searchsorted(starts - 1, np.arange(len(symbols)), side="right") - 1
    factor = 1 / scale(ends - starts + 2)
    rows, codes, values = [], [], []
    for d in range(2, SPAN + 1):
        at = np.flatnonzero(reach >= d)
        for j in range(1, d):
            rows.append(owner[at])
            codes.append(low[at] * _SYMBOLS**2 + low[at + j] * _SYMBOLS + low[at + d])
            values.append(DECAY ** (d + 1) * factor[owner[at]])
    return np.concatenate(rows), np.concatenate(codes), np.concatenate(values)


def kernel(left: list[bytes], codes: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Kernel values of ``left`` with landmarks whose features over ``codes`` are ``basis``."""
    out = []
    for at in range(0, len(left), 500):
        some = left[at : at + 500]
        rows, found, values = features(some)
        spot = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        known = codes[spot] == found
        dense = np.bincount(rows[known] * len(codes) + spot[known], values[known], len(some) * len(codes))
        out.append(dense.reshape(len(some), -1) @ basis.T)
    return np.concatenate(out)


def machine(good: list[bytes], bad: list[bytes], landmarks: list[bytes], share: np.ndarray) -> tuple[np.ndarray, float]:
    """(subsequence weights, bias) of a squared-hinge SVM on Nyström features."""
    rows, found, values = features(landmarks)
    codes, spot = np.unique(found, return_inverse=True)
    basis = np.bincount(rows * len(codes) + spot, values, len(landmarks) * len(codes)).reshape(len(landmarks), -1)
    power, axes = np.linalg.eigh(basis @ basis.T)
    root = axes / np.sqrt(np.maximum(power, 0) + RIDGE)
    x = kernel(bad + good, codes, basis) @ root
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.concatenate((np.ones(len(bad)), -np.ones(len(good))))
    weight = np.concatenate((0.5 * share / share.sum(), np.full(len(good), 0.5 / len(good))))
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), PENALTY)
    keep[-1] = 1e-6
    for _ in range(20):
        on = y * (x @ w) < 1
        a = x[on] * weight[on, None]
        new = np.linalg.solve(a.T @ x[on] + np.diag(keep), a.T @ y[on])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    weights = np.zeros(_SYMBOLS**3, np.float32)
    weights[codes] = (root @ w[:-1]) @ basis
    return weights, float(w[-1])


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        symbols, starts, ends, doc = units(data, offsets)
        worst = np.full(len(offsets) - 1, -2.0)
        np.maximum.at(worst, doc, unit_scores(symbols, starts, ends, self.weights) + self.bias)
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -30, 30)))


def _first_witnesses(toxic: list[list[bytes]], clean: list[list[bytes]]) -> list[bytes]:
    """Of each toxic document the units that themselves or by their beginnings speak for the class: the first, and all that do so clearly."""

    def marks(unit: bytes) -> list[tuple]:
        return [(0, unit), *((n, unit[:n]) for n in (4, 5, 6) if len(unit) > n)]

    seen = [Counter(m for bag in bags for m in {m for u in bag for m in marks(u)}) for bags in (toxic, clean)]
    ratio = lambda m: (seen[0][m] + 0.25) / (seen[1][m] + 0.25)
    out = []
    for bag in toxic:
        rated = sorted(((max(map(ratio, marks(u))), u) for u in bag if len(u) > 2), reverse=True)
        out += [u for i, (r, u) in enumerate(rated) if r >= (CLEAR if i else CLEAR / 3)]
    return out


def train(toxic: list[list[bytes]], clean: list[list[bytes]]) -> Model | None:
    """Fit on bags of units. None where no unit tells the classes apart."""
    seen = [Counter(u for bag in bags for u in bag) for bags in (toxic, clean)]
    # What clean documents say as well cannot be what makes a document toxic.
    toxic = [[u for u in bag if seen[0][u] + 0.25 >= TELLING * (seen[1][u] + 0.25)] for bag in toxic]
    witnesses = _first_witnesses(toxic, clean)
    harmless = sorted({u for bag in clean for u in bag}, key=lambda u: (hash_order(u), u))
    if not witnesses or not harmless:
        return None
    hard = harmless[:UNITS]
    flat = [u for bag in toxic for u in bag]
    bounds = np.cumsum([len(b) for b in toxic])[:-1]
    for _ in range(ROUNDS):
        counts = Counter(witnesses)
        bad = [u for u, _ in counts.most_common(UNITS)]
        marks = bad[:LANDMARKS] + hard[:LANDMARKS]
        # A unit that stands for many documents weighs more, by the root of their number.
        weights, bias = machine(hard + harmless[: UNITS // 2], bad, marks, np.sqrt([counts[u] for u in bad]))
        mild = unit_scores(*stream(harmless), weights) + bias
        hard = [harmless[i] for i in np.argsort(-mild, kind="stable")[:UNITS]]
        values = np.split(unit_scores(*stream(flat), weights) + bias, bounds) if flat else []
        witnesses = [bag[i] for bag, v in zip(toxic, values) if len(bag) for i in {int(np.argmax(v)), *np.flatnonzero(v > 0.5).tolist()} if v[i] > -1] or witnesses
    worst = lambda bags: np.array([unit_scores(*stream(b), weights).max() + bias if b else -2.0 for b in bags])
    return Model(weights, bias, *_calibrated(worst(toxic), worst(clean)))


def hash_order(unit: bytes) -> int:
    import zlib

    return zlib.crc32(unit)


def _calibrated(high: np.ndarray, low: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the document values, both classes weighing the same."""
    v = np.concatenate((high, low))
    y = np.concatenate((np.ones(len(high)), np.zeros(len(low))))
    weight = np.where(y > 0, 0.5 / max(len(high), 1), 0.5 / max(len(low), 1))
    x = np.stack([v, np.ones(len(v))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-4 * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-4 * np.eye(2)
        w = w - np.linalg.solve(hess, grad)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, text: str = "text") -> Model | None:
    """Fit on at most ``per_class`` labelled documents a class; None where a class has none."""

    def gather(batches):
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                symbols, starts, ends, doc = units(data, offsets)
                raw, bags = symbols.tobytes(), [set() for _ in range(b - a)]
                for s, e, d in zip(starts.tolist(), ends.tolist(), doc.tolist()):
                    bags[d].add(raw[s:e])
                kind = pa.list_(pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([sorted(x) for x in bags], kind)], names=["y", "units"])

    sample = bounded_sample(labels, "toxic", per_class)
    chosen = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = chosen.select("y", "text").mapInArrow(gather, "y int, units array<binary>").collect()
    bags = sorted((r["y"], [bytes(u) for u in r["units"]]) for r in rows)
    return train([u for y, u in bags if y == 1], [u for y, u in bags if y == 0])


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, repeated rows included.

    A text without a unit (null, empty, signs only) has the lowest value there
    is. Without a model (no labels, one class only) every score is 0. Only the
    text is read; an empty table gives no rows.
    """

    def apply(batches):
        for batch in batches:
            found = np.zeros(batch.num_rows)
            if model is not None:
                for a, b, data, offsets in text_slices(batch.column(1), 1_500_000):
                    found[a:b] = model.scores(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    scored = rows.mapInArrow(apply, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
