"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage becomes a vector of
text statistics and, through a learned layer, an embedding; a gated attention
network, learned from document labels alone, weighs the passages; the weighted
sum is scored. One junk passage can so decide about a long document.

The model has a few hundred numbers. It is fitted on the driver on a bounded
sample of labelled rows and travels with the scoring function; scoring reads
every passage of every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_sample, held_out, text_slices, word_hashes, word_spans

PASSAGE = 64
THRESHOLD = 0.3
# Labelled documents of each class that the model is fitted on.
SAMPLE_PER_CLASS = 1500
EMBED, GATE, EPOCHS, RATE, DECAY = 16, 8, 300, 0.02, 1e-4
N_FEATURES = 13

# Counted byte classes, three to a 64-bit number of 21-bit fields.
_CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", "!?", ".,;:", "\n")
_FIELD = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)


def _tables() -> list[np.ndarray]:
    out = []
    for group in (_CLASSES[:3], _CLASSES[3:]):
        table = np.zeros(256, np.uint64)
        for k, chars in enumerate(group):
            for c in chars:
                table[ord(c)] += np.uint64(1) << (np.uint64(k) * _FIELD)
        out.append(table)
    return out


_COUNTED = _tables()


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, document) of every passage; a text without words has one passage of zeros."""
    docs = len(offsets) - 1
    starts, ends, doc = word_spans(data, offsets)
    words = np.bincount(doc, minlength=docs) if len(doc) else np.zeros(docs, np.int64)
    size = np.maximum(-(-words // PASSAGE), 1)
    bag = np.repeat(np.arange(docs), size)
    x = np.zeros((len(bag), N_FEATURES))
    if not len(starts):
        return x, bag
    first_word = np.concatenate(([0], np.cumsum(words)))
    first_passage = np.concatenate(([0], np.cumsum(size)))
    place = np.arange(len(doc)) - first_word[doc]
    row = first_passage[doc] + place // PASSAGE
    lengths = (ends - starts).astype(np.float64)
    n = np.bincount(row, minlength=len(bag)).astype(np.float64)
    full = n > 0
    n1 = np.maximum(n, 1)
    mean = np.bincount(row, lengths, len(bag)) / n1
    spread = np.sqrt(np.maximum(np.bincount(row, lengths**2, len(bag)) / n1 - mean**2, 0))
    hashes = word_hashes(data, starts, ends)
    grid = np.zeros((len(bag), PASSAGE), np.uint64)
    grid[row, place % PASSAGE] = hashes | np.uint64(1)
    again = ((grid[:, 1:] == grid[:, :-1]) & (grid[:, 1:] != 0)).sum(axis=1)
    grid.sort(axis=1)
    distinct = ((grid[:, 1:] != grid[:, :-1]) & (grid[:, 1:] != 0)).sum(axis=1) + (grid[:, 0] != 0)
    # A passage reaches from its first word to the next passage's first word, or to the text's end.
    opens = np.ones(len(row), bool)
    opens[1:] = row[1:] != row[:-1]
    at, used = starts[opens], row[opens]
    until = np.append(at[1:], len(data))
    until = np.minimum(until, offsets[doc[opens] + 1])
    counts = np.zeros((len(bag), 6))
    for g, table in enumerate(_COUNTED):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data], out=total[1:])
        inside = total[until] - total[at]
        for k in range(3):
            counts[used, 3 * g + k] = (inside >> (np.uint64(k) * _FIELD)) & _MASK
    size_of = np.ones(len(bag))
    size_of[used] = until - at
    longest = np.zeros(len(bag))
    np.maximum.at(longest, row, lengths)
    x[:, 0], x[:, 1], x[:, 2] = np.log1p(n), mean, spread
    x[:, 3], x[:, 4] = np.where(full, distinct / n1, 0), again / n1
    x[:, 5], x[:, 6] = counts[:, 0] / size_of, counts[:, 1] / size_of
    x[:, 7:11] = np.minimum(counts[:, 2:6] / n1[:, None], 8)
    x[:, 11], x[:, 12] = np.log1p(longest), np.log1p(words[bag])
    return x, bag


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, x: np.ndarray, bag: np.ndarray) -> np.ndarray:
        """The score of every bag; ``bag`` is sorted and has no gaps."""
        return _forward(self.weights, (x - self.mean) / self.scale, _edges(bag))["p"]


def _edges(bag: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(np.diff(bag)) + 1)) if len(bag) else np.zeros(0, np.int64)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def _forward(w: dict, x: np.ndarray, edges: np.ndarray) -> dict:
    """Embeddings, gated attention inside each bag, the weighted sum and its score."""
    bag = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(x))))
    e = np.tanh(x @ w["A"] + w["a"])
    t, q = np.tanh(e @ w["V"]), _sigmoid(e @ w["U"])
    s = (t * q) @ w["w"]
    s = np.exp(s - np.maximum.reduceat(s, edges)[bag])
    alpha = s / np.add.reduceat(s, edges)[bag]
    z = np.add.reduceat(alpha[:, None] * e, edges)
    return {"bag": bag, "e": e, "t": t, "q": q, "alpha": alpha, "z": z, "p": _sigmoid(z @ w["c"] + w["d"])}


def _gradient(w: dict, x: np.ndarray, edges: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(w, x, edges)
    e, t, q, alpha, bag = (f[k] for k in ("e", "t", "q", "alpha", "bag"))
    out = (f["p"] - y) / len(y)
    dz = out[:, None] * w["c"]
    dalpha = (e * dz[bag]).sum(axis=1)
    ds = alpha * (dalpha - np.add.reduceat(alpha * dalpha, edges)[bag])
    gate = ds[:, None] * w["w"]
    dt, dq = gate * q * (1 - t * t), gate * t * q * (1 - q)
    de = (alpha[:, None] * dz[bag] + dt @ w["V"].T + dq @ w["U"].T) * (1 - e * e)
    return {
        "A": x.T @ de, "a": de.sum(axis=0), "V": e.T @ dt, "U": e.T @ dq, "w": (t * q).T @ ds,
        "c": f["z"].T @ out, "d": out.sum(keepdims=True),
    }


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> Model:
    """Fit by Adam on whole batches; the classes weigh the same because the sample is balanced or re-weighted by score."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    shapes = {"A": (x.shape[1], EMBED), "a": (EMBED,), "V": (EMBED, GATE), "U": (EMBED, GATE), "w": (GATE,), "c": (EMBED,), "d": (1,)}
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k in "AVUwc" else np.zeros(s) for k, s in shapes.items()}
    first, second = ({k: np.zeros(s) for k, s in shapes.items()} for _ in range(2))
    scaled, edges = (x - mean) / scale, _edges(bag)
    for step in range(1, epochs + 1):
        for k, g in _gradient(w, scaled, edges, y).items():
            g = g + DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            w[k] -= RATE * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return Model(mean, scale, w)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, text: str = "text") -> Model | None:
    """Fit on at most ``per_class`` labelled documents a class; None where a class has none."""

    def encode(batches):
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                x, bag = passages(data, offsets)
                parts = np.split(x.astype(np.float32), _edges(bag)[1:])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([p.tobytes() for p in parts], pa.binary())], names=["y", "x"])

    chosen = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(bounded_sample(labels, "quality", per_class)), "doc_id")
    rows = chosen.select("y", "text").mapInArrow(encode, "y int, x binary").collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["x"])))
    y = np.array([r["y"] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return None
    parts = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in rows]
    return train(np.concatenate(parts).astype(np.float64), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), y)


def scored(docs: DataFrame, model: Model | None, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each text; other columns pass through, one named ``into`` is replaced."""
    others = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*others).alias("_row"), F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def apply(batches):
        for batch in batches:
            found = np.full(batch.num_rows, 0.5)
            if model is not None:
                for a, b, data, offsets in text_slices(batch.column(1)):
                    found[a:b] = model.scores(*passages(data, offsets))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["_row", "_score"])

    done = rows.mapInArrow(apply, rows.select("_row").schema.add("_score", "double"))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in others], F.col("_score").alias(into))


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, repeated rows included.

    Null and empty texts are a bag with one passage of zeros. Without a model
    (one class only, no labels) every score is 0.5. Only the text is read; an
    empty table gives no rows.
    """
    rows = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), model, text)
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
