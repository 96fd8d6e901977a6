"""Packing of token sequences by a shortest-pack-first plan over the length histogram.

Each document becomes token ids plus an end id. Whole runs of ``budget`` ids are
pieces of their own, the rest of a document is one more piece, so pieces and
their checksums come out of the one pass that tokenises. The plan needs only the
histogram of piece lengths (``budget`` numbers at most, whatever the input): it
places lengths longest first, each into the open pattern with most room, and
moves counts of patterns, not pieces. Patterns then meet the pieces by the rank
of a piece among those of its length. Ranks are made of a rank inside the
writing task and an offset per (task, length), so that no length, however
common, is ordered in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import give_back, only, ready, stored, worker_cache
from tidewatch.llm.units import UnitStore

BUDGET = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, rank long"

# Units kept by a worker: what one holds beside the models of earlier stages counts against its executor.
STORED_UNITS = 250_000

_encoders = worker_cache()


def byte_ranks(tokenizer) -> dict[bytes, int]:
    """The vocabulary as byte strings; ids follow the order of merges, so they are the merge ranks too.

    Byte-level vocabularies write printable bytes as themselves and the others, in order, as the
    characters from 256 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(back[c] for c in t): i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if all(c in back for c in t)}


def encoder(path: str):
    """(function from a text to ids, unit store) of a vocabulary file, one per worker.

    New units are merged by a faster library under the same vocabulary and ranks. They are encoded
    in one run: a unit is a space and a string without spaces, so exactly its first token begins
    with a space. Strings of added tokens go to the tokenizer itself.
    """
    if path not in _encoders:
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        ranks = byte_ranks(tokenizer)
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        for token in added:
            ranks.pop(token.encode(), None)
        opens = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), bool)
        opens[[i for t, i in ranks.items() if t.startswith(b" ")]] = True
        merge = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def ids_of(text: str) -> np.ndarray:
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

        def encode(units: list[str]) -> list[bytes]:
            out = []
            for at in range(0, len(units), 20_000):
                some = units[at : at + 20_000]
                run = " " + " ".join(some)
                if not any(t in run for t in added):
                    ids = np.array(merge(run), np.uint32)
                    marks = np.flatnonzero(opens[ids])
                    if len(marks) == len(some):
                        raw, edges = ids.tobytes(), (4 * np.append(marks, len(ids))).tolist()
                        out += [raw[a:b] for a, b in zip(edges, edges[1:])]
                        continue
                out += [ids_of(f" {u}").tobytes() for u in some]
            return out

        _encoders[path] = ids_of, UnitStore(encode, STORED_UNITS)
    return _encoders[path]


def text_ids(text: str, path: str) -> bytes:
    """Token ids of a text as little-endian unsigned 32-bit numbers.

    A space before a non-space always opens a pre-token, so the units between
    single spaces are encoded apart. Double spaces join with what is around
    them; such texts go to the tokenizer whole.
    """
    ids_of, store = encoder(path)
    first, *rest = text.split(" ")
    if "" in rest:
        return ids_of(text).tobytes()
    return (ids_of(first).tobytes() if first else b"") + store.encoded(rest)


def pieces(docs: DataFrame, vocabulary: str, budget: int = BUDGET, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """Pieces of every document, with task and rank inside (task, length)."""
    end = end_id.to_bytes(4, "little")

    def cut(batches):
        task, seen = TaskContext.get().partitionId(), {}
        only(_encoders)
        for batch in batches:
            out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "rank")}
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = text_ids(body, vocabulary) + end
                n = len(ids) // 4
                for at in range(0, n, budget):
                    part = ids[4 * at : 4 * (at + budget)]
                    size = len(part) // 4
                    rank = seen.get(size, 0)
                    seen[size] = rank + 1
                    for k, v in zip(out, (doc, at, size, zlib.crc32(part), n, task, rank)):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([(k, pa.int32() if k == "task" else pa.int64()) for k in out])
            )
            out = None
            give_back()

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def plan(histogram: dict[int, int], budget: int = BUDGET) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, count) patterns that hold every piece of the histogram.

    Lengths go longest first; a length goes to the open patterns with most room
    (the shortest packs). Runs of equal lengths fill a pattern several times in
    one step, so the work depends on distinct lengths, not on pieces.
    """
    rooms: list[int] = []  # sorted rooms that have open patterns
    open_at: dict[int, dict[tuple[int, ...], int]] = {}
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], count: int) -> None:
        room = budget - sum(pattern)
        if room == 0:
            done.append((pattern, count))
            return
        if room not in open_at:
            open_at[room] = {}
            insort(rooms, room)
        open_at[room][pattern] = open_at[room].get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not rooms or rooms[-1] < length:
                fit = min(budget // length, left)
                count = left // fit
                put((length,) * fit, count)
                left -= fit * count
                continue
            room = rooms[-1]
            pattern, count = next(iter(open_at[room].items()))
            fit = min(room // length, max(1, left // count))
            used = min(count, left // fit)
            if used == count:
                del open_at[room][pattern]
                if not open_at[room]:
                    del open_at[room]
                    rooms.pop(bisect_left(rooms, room))
            else:
                open_at[room][pattern] = count - used
            put(pattern + (length,) * fit, used)
            left -= fit * used
    return done + [(p, c) for group in open_at.values() for p, c in group.items()]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset) of each place in a pattern."""
    out, ranks, base = [], {}, 0
    for pattern, count in patterns:
        at = 0
        for length in pattern:
            first = ranks.get(length, 0)
            out.append((length, first, first + count, base, at))
            ranks[length] = first + count
            at += length
        base += count
    return out


def pack(docs: DataFrame, vocabulary: str, budget: int = BUDGET, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """One row per piece with its sequence and its place there.

    Null and empty texts are the end id alone. Rows that repeat are packed each.
    A null doc_id stays null. Other columns of ``docs`` are not read. No rows in,
    no rows out. A text of any length is cut into runs of ``budget`` ids.
    """
    ready(docs.sparkSession)
    cut = stored(pieces(docs, vocabulary, budget, end_id, text), "pack-pieces")
    counts = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # At most ``budget`` rows, whatever the input.
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # From an Arrow table: from a list, Python processes of another kind would start on the executors and stay.
    names = ("length", "_first", "_end", "_base", "offset")
    found = np.array(slots(plan(histogram, budget)), np.int64).reshape(-1, len(names))
    places = docs.sparkSession.createDataFrame(pa.table({name: found[:, i] for i, name in enumerate(names)}))
    ranked = cut.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("_before"))
    # The places follow from the histogram, so their number is bounded by the budget as well.
    p, s = ranked.alias("p"), F.broadcast(places).alias("s")
    inside = (F.col("p.length") == F.col("s.length")) & (F.col("p.rank") >= F.col("s._first")) & (F.col("p.rank") < F.col("s._end"))
    return p.join(s, inside).select(
        "p.doc_id", "p.start", "p.length", "p.ids_crc32", "p.doc_tokens",
        (F.col("s._base") + F.col("p.rank") - F.col("s._first")).alias("sequence_id"),
        F.col("s.offset").alias("offset"),
    )
