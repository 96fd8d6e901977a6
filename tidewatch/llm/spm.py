"""SentencePiece encoding and decoding as a shortest path through composed transducers.

The model file is compiled into three parts: the normaliser (blanks become the
space sign, one is put in front), the piece transducer (a trie whose leaves are
pieces, with byte pieces for characters that are no piece) and a filter over
neighbouring pieces. A pair-merging model is no plain sum of piece scores, so the
filter carries its order of merges: two pieces may follow each other if merging
their joint text gives back these two, otherwise the arc has an infinite weight.
A path through input, pieces and filter on which all neighbours hold is the
segmentation of the merges. Weights are of the tropical semiring: nothing for an
arc that the filter admits, infinity for one that it does not; models that are
sums of scores have these as weights instead.

No piece has a space sign after another character, so the input falls apart at
the space signs that follow one. Paths of such units are found once per worker.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import only, worker_cache
from tidewatch.llm.units import UnitStore

SPACE = "▁"
NORMAL, UNKNOWN, BYTE, USER = 1, 2, 6, 4
UNIGRAM, BPE = 1, 2
MODEL = "piece_bpe_32k.model"
# Units and pairs of pieces a worker keeps; beyond it the store starts anew.
MAX_UNITS = 600_000
MAX_PAIRS = 500_000
UNKNOWN_WEIGHT = 1e6


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, raw[at : at + size]
        at += size


class Transducer:
    """A compiled model."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            parts = list(_fields(file.read()))
        self.pieces, self.scores, kinds = [], [], []
        for number, value in parts:
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                kinds.append(piece.get(3, NORMAL))
        trainer = dict(_fields(dict(parts).get(2, b"")))
        normaliser = dict(_fields(dict(parts).get(3, b"")))
        if normaliser.get(2):
            raise ValueError("a model with a character map needs its map compiled; only the identity is supported")
        self.prefix = bool(normaliser.get(3, 1))
        self.squeeze = bool(normaliser.get(4, 1))
        self.merges = trainer.get(3, UNIGRAM) == BPE
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else 0
        self.bytes = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.numbers = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k in (NORMAL, USER)}
        self.raw = [bytes([int(p[1:-1], 16)]) if k == BYTE else p.encode() for p, k in zip(self.pieces, kinds)]
        for i, k in enumerate(kinds):
            if k not in (NORMAL, USER, BYTE, UNKNOWN):
                self.raw[i] = b""
        # Character -> [arc that ends here or None, next characters].
        self.longest = max(map(len, self.numbers), default=1)
        self.trie: dict = {}
        for piece, number in self.numbers.items():
            if not self.merges or self.merged(piece) == [piece]:
                children = self.trie
                for char in piece:
                    node = children.setdefault(char, [None, {}])
                    children = node[1]
                node[0] = (piece, number)
        # Left piece -> right piece -> whether the filter lets it follow.
        self.follows: dict[int, dict[int, bool]] = {}
        self.pairs = 0
        self.units = UnitStore(lambda units: [self.path(SPACE + u) for u in units], MAX_UNITS)

    def normalised(self, text: str) -> str:
        out = text.replace(" ", SPACE)
        if self.squeeze:
            out = re.sub(f"{SPACE}+", SPACE, out.strip(SPACE))
        return SPACE + out if self.prefix and out else out

    def merged(self, text: str) -> list[str]:
        """The text after all merges, best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                number = self.numbers.get(parts[i] + parts[i + 1])
                if number is not None and (best is None or self.scores[number] > best):
                    best, at = self.scores[number], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def holds(self, left: tuple[str, int], right: tuple[str, int]) -> bool:
        """Whether the filter lets ``right`` follow ``left``; arcs are (text, piece number or -1). Kept for pieces."""
        found = self.merged(left[0] + right[0]) == [left[0], right[0]]
        if left[1] >= 0 and right[1] >= 0:
            if self.pairs > MAX_PAIRS:
                self.follows.clear()
                self.pairs = 0
            self.follows.setdefault(left[1], {})[right[1]] = found
            self.pairs += 1
        return found

    def arcs(self, text: str, at: int) -> list[tuple[str, int]]:
        """The pieces that begin at a place, longest last, or its character first where that is no piece."""
        children, found = self.trie, []
        for char in text[at : at + self.longest]:
            if char not in children:
                break
            arc, children = children[char]
            if arc is not None:
                found.append(arc)
        if not found or len(found[0][0]) > 1:
            found.insert(0, (text[at], -1))
        return found

    def path(self, text: str) -> bytes:
        """Piece numbers (unsigned 32-bit) of the best path through the composition with ``text``."""
        best = self.accepted(text) if self.merges else self.lightest(text)
        out = [number for _, number in best]
        if min(out, default=0) >= 0:
            return array("I", out).tobytes()
        out = []
        for piece, number in best:
            if number >= 0:
                out.append(number)
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return array("I", out).tobytes()

    def accepted(self, text: str) -> list[tuple[str, int]]:
        """The path of finite weight. With a merge filter there is one, so the first found is the shortest;
        states from which none leads on are remembered and left out."""
        path: list[tuple[str, int]] = []
        untried: list[list[tuple[str, int]]] = []  # for each arc of the path, the others at its place
        dead: set[tuple[int, str]] = set()
        at, last, here, size, none = 0, None, None, len(text), {}
        while at < size:
            if here is None:
                here = self.arcs(text, at)
            known = none if last is None else self.follows.get(last[1], none)
            while here:
                arc = here.pop()
                holds = last is None or known.get(arc[1])
                if holds is None:
                    holds = self.holds(last, arc)
                if holds and not (dead and (at + len(arc[0]), arc[0]) in dead):
                    path.append(arc)
                    untried.append(here)
                    at += len(arc[0])
                    last, here = arc, None
                    break
            else:
                if not path:
                    raise ValueError(f"no path for {text!r}")
                dead.add((at, last[0]))
                here = untried.pop()
                at -= len(path.pop()[0])
                last = path[-1] if path else None
        return path

    def lightest(self, text: str) -> list[tuple[str, int]]:
        """The path with the least sum of weights (negative scores), place by place."""
        best: list = [(0.0, None)] + [None] * len(text)
        for at in range(len(text)):
            if best[at] is None:
                continue
            for arc in self.arcs(text, at):
                total = best[at][0] + (-self.scores[arc[1]] if arc[1] >= 0 else UNKNOWN_WEIGHT)
                end = at + len(arc[0])
                if best[end] is None or total < best[end][0]:
                    best[end] = (total, arc)
        out, at = [], len(text)
        while at:
            out.append(best[at][1])
            at -= len(out[-1][0])
        return out[::-1]

    def ids(self, text: str) -> bytes:
        if self.prefix and not self.squeeze and text and "  " not in text and SPACE not in text and text[0] != " " and text[-1] != " ":
            return self.units.encoded(text.split(" "))
        out = self.normalised(text)
        head = re.match(f"[^{SPACE}]*", out).group()
        return (self.path(head) if head else b"") + self.units.encoded([u[1:] for u in re.findall(f"{SPACE}+[^{SPACE}]*", out)])

    def text(self, ids: list[int]) -> str:
        out = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", errors="replace").replace(SPACE, " ")
        return out[1:] if self.prefix and out.startswith(" ") else out

    def texts(self, lists: pa.ListArray) -> list[str | None]:
        """The text of each list. The numbers are taken out by list, as a Python object for each by Arrow takes longer than decoding."""
        values, edges = lists.values.to_numpy(), lists.offsets.to_pylist()
        return [self.text(values[a:b].tolist()) if there else None for a, b, there in zip(edges, edges[1:], lists.is_valid().to_pylist())]


_compiled = worker_cache()


def transducer(path: str) -> Transducer:
    """The compiled model, once per worker."""
    only(_compiled)
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def encode(docs: DataFrame, model: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the piece numbers of ``text`` in the column ``into``, which replaces one of that name.

    A null text has null ids, an empty one an empty list. Other columns pass
    through, whatever their names. Rows that repeat are encoded each.
    """
    others = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*others).alias("_row"), F.col(text).alias("_text"))

    def run(batches):
        compiled = transducer(model)
        for batch in batches:
            made = [None if t is None else compiled.ids(t) for t in batch.column(1).to_pylist()]
            edges = np.concatenate(([0], np.cumsum([len(m or b"") // 4 for m in made])))
            values = pa.array(np.frombuffer(b"".join(m or b"" for m in made), np.int32))
            lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values, mask=pa.array([m is None for m in made], pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["_row", "_ids"])

    done = rows.mapInArrow(run, rows.select("_row").schema.add("_ids", T.ArrayType(T.IntegerType())))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in others], F.col("_ids").alias(into))


def decode(docs: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of the piece numbers in ``ids``; null for null, other columns pass through."""
    others = [c for c in docs.columns if c != into]
    rows = docs.select(F.struct(*others).alias("_row"), F.col(ids).cast("array<int>").alias("_ids"))

    def run(batches):
        compiled = transducer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(compiled.texts(batch.column(1)), pa.string())], names=["_row", "_text"])

    done = rows.mapInArrow(run, rows.select("_row").schema.add("_text", "string"))
    return done.select(*[F.col("_row").getField(c).alias(c) for c in others], F.col("_text").alias(into))
