"""Removal of repeated passages by content-defined chunking.

A gear hash rolls over the bytes; a word start is a cut where the hash of the
bytes before it falls into a fixed share of its values, so cuts depend on the
neighbourhood alone and chunks line up again right after an insertion. Chunks
are compared by a 128-bit digest. The occurrence with the smallest document and
place owns a repeated chunk. A later document loses every run of neighbouring
chunks owned elsewhere that holds at least ``MIN_WORDS`` words and, with the two
chunks around it, more than ``passage`` words: the repeated passage ends inside
those two. Shorter repeats (common lines, licence notes, short copies) stay.

``remove_passages`` is exact instead: every run of more than ``passage`` words
whose bytes occur earlier goes, and nothing else. Its unit is the window of
``passage`` + 1 words. Every window has a chunk between two cuts that are least
gear hashes of neighbouring word starts and lie inside the window, so equal
windows have equal chunks, whatever stands around them; only windows whose chunk
occurs twice are compared, by 128-bit digests of their bytes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import mix, ready, row_key, stored, text_slices, word_hashes, word_spans

# Bytes. A cut is looked for at word starts from MIN_CHUNK on, one in CUT_EVERY word starts holds.
MIN_CHUNK = 24
MAX_CHUNK = 1024
CUT_EVERY = 8
# Passages of more than so many words go.
PASSAGE = 50
MIN_WORDS = 12
WINDOW = 16
# Words that hold the bytes of a gear hash, a word and a blank being two bytes at least; least words of a window's chunk.
MARGIN_WORDS = WINDOW // 2
CHUNK_WORDS = 10

_GEAR = mix(np.arange(512, 768, dtype=np.uint64)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash after each byte: sum of G[b] << age over the last 16 bytes."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        h[step:] = h[step:] + (h[:-step] << np.uint16(step))
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
    """Word starts of a slice of texts, and the chunk edges of each text."""
    starts, _, doc = word_spans(data, offsets)
    # The hash before a start covers WINDOW bytes; nearer to the text's start it would cover another text.
    good = starts[starts - offsets[doc] >= WINDOW]
    good = good[gear(data)[good - 1] < np.uint16(65536 // CUT_EVERY)] if len(good) else good
    edges_of = np.searchsorted(good, offsets).tolist()
    places, ends, out = good.tolist(), offsets.tolist(), []
    for i in range(len(ends) - 1):
        last, edges = ends[i], [ends[i]]
        for at in (*places[edges_of[i] : edges_of[i + 1]], ends[i + 1]):
            while at - last > MAX_CHUNK:
                last = _whole(data, last + MAX_CHUNK)
                edges.append(last)
            if at - last >= MIN_CHUNK:
                edges.append(at)
                last = at
        if edges[-1] != ends[i + 1]:
            edges.append(ends[i + 1])
        out.append(edges)
    return starts, out


def _whole(data: np.ndarray, at: int) -> int:
    """The start of the character that the byte ``at`` belongs to."""
    while at and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def chunks(docs: DataFrame, text: str = "text") -> DataFrame:
    """(key, body, place, high, low) of every chunk; key and body name the text, place counts its chunks from 0."""
    kinds = {"key": pa.int64(), "body": pa.int64(), "place": pa.int32(), "high": pa.int64(), "low": pa.int64()}

    def split(batches):
        for batch in batches:
            keys, bodies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b, data, offsets in text_slices(batch.column(2)):
                _, edges = cuts(data, offsets)
                raw, size = data.tobytes(), [len(e) - 1 for e in edges]
                begin = np.array([x for e in edges for x in e[:-1]], np.int64)
                end = np.array([x for e in edges for x in e[1:]], np.int64)
                if not len(begin):
                    continue
                row = np.repeat(np.arange(b - a), size)
                digests = b"".join([hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(begin.tolist(), end.tolist())])
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                first = np.concatenate(([0], np.cumsum(size)))[:-1]
                columns = {
                    "key": keys[a + row], "body": bodies[a + row], "place": np.arange(len(row)) - first[row],
                    "high": halves[:, 0], "low": halves[:, 1],
                }
                yield pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in kinds.items()], names=list(kinds))

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(row_key().alias("key"), F.xxhash64(body).alias("body"), body.alias("text"))
    return rows.mapInArrow(split, "key long, body long, place int, high long, low long")


def repeated(found: DataFrame) -> DataFrame:
    """The places of chunks that another place owns, gathered per text: (key, body, places)."""
    here = F.struct("key", "body", "place")
    owners = found.groupBy("high", "low").agg(F.min(here).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written out, so that the join below shuffles both sides itself and can split a chunk that is everywhere.
    owners = stored(owners.select("high", "low", "owner"), "cdc-owners")
    later = found.join(owners, ["high", "low"]).where(here != F.col("owner"))
    # The chunks of one text are bounded by its length.
    return later.groupBy("key", "body").agg(F.collect_set("place").alias("places"))


def runs(raw: bytes, places: list[int], passage: int = PASSAGE) -> list[tuple[int, int, int]]:
    """(start, end, words) of the runs of neighbouring chunks at ``places`` that are long enough to go."""
    data = np.frombuffer(raw, np.uint8)
    starts, (edges,) = cuts(data, np.array([0, len(raw)]))
    before = np.searchsorted(starts, edges)
    gone = np.zeros(len(edges) + 1, bool)
    gone[np.array(places) + 1] = True
    turns = np.flatnonzero(gone[1:] != gone[:-1])
    out = []
    for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
        words = int(before[b] - before[a])
        around = int(before[min(b + 1, len(edges) - 1)] - before[max(a - 1, 0)])
        if words >= MIN_WORDS and around > passage:
            out.append((edges[a], edges[b], words))
    return out


def remove_repeats(docs: DataFrame, passage: int = PASSAGE, text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from ``text`` and the columns

    ``n_removed`` (passages cut), ``removed_words`` and ``removed_bytes``. The
    first occurrence (smallest doc_id, then place) stays. A null text stays null;
    texts of at most ``passage`` words are never cut. Rows with the same doc_id and
    text are one document. A null doc_id comes first. Other columns pass through
    unread, whatever their names, but for the three added ones, which are replaced.
    """
    ready(docs.sparkSession)
    places = repeated(stored(chunks(docs, text), "cdc-chunks"))
    return _without(docs, places, lambda raw, found: runs(raw, found, passage), text)


def _without(docs: DataFrame, places: DataFrame, spans: Callable[[bytes, list], list[tuple[int, int, int]]], text: str) -> DataFrame:
    """``docs`` without the (start, end, words) that ``spans`` makes of a text and its ``places`` (key, body, places)."""
    places = places.select("key", "body", F.col("places").alias("_places"))
    added = ("n_removed", "removed_words", "removed_bytes")
    others = [c for c in docs.columns if c not in added]
    wide = docs.select(
        F.struct(F.lit(0).alias("_"), *[c for c in others if c != text]).alias("_row"), F.col(text).alias("_text"),
        row_key().alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("body"),
    )
    joined = deflated(wide).join(places, ["key", "body"], "left").select("_row", "_text", "_places")

    def cut(batches):
        for batch in batches:
            bodies, lists = batch.column("_text").to_pylist(), batch.column("_places").to_pylist()
            texts, figures = [], np.zeros((3, batch.num_rows), np.int64)
            for i, (packed, found_at) in enumerate(zip(bodies, lists)):
                raw = None if packed is None else zlib.decompress(packed)
                at, keep = 0, []
                for start, end, words in spans(raw, found_at) if found_at else ():
                    keep.append(raw[at:start])
                    at = end
                    figures[:, i] += (1, words, end - start)
                texts.append(raw if not keep else b"".join([*keep, raw[at:]]))
            columns = [batch.column("_row"), pa.array(texts, pa.binary()).cast(pa.string()), *[pa.array(f, pa.int64()) for f in figures]]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "_new", *added])

    schema = wide.select("_row").schema.add("_new", "string")
    for name in added:
        schema = schema.add(name, "long")
    done = joined.mapInArrow(cut, schema)
    return done.select(*[F.col("_new").alias(c) if c == text else F.col("_row").getField(c).alias(c) for c in others], *added)


def deflated(wide: DataFrame) -> DataFrame:
    """The same rows with ``_text`` compressed: texts are most of what the join moves."""

    def deflate(batches):
        for batch in batches:
            packed = [None if t is None else zlib.compress(t.encode(), 1) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), *batch.columns[2:]], names=batch.schema.names)

    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == "_text" else f for f in wide.schema])
    return wide.mapInArrow(deflate, schema)


def least_places(values: np.ndarray, span: int) -> np.ndarray:
    """For each place, where the first least value of the ``span`` places from it on lies."""
    least, place, wide = values, np.arange(len(values)), 1
    while wide < span:
        step = min(wide, span - wide)
        left = least[:-step] <= least[step:]
        least, place = np.where(left, least[:-step], least[step:]), np.where(left, place[:-step], place[step:])
        wide += step
    return place


def spans_of(size: int) -> tuple[int, int, int]:
    """(least words of a chunk, word starts its first cut is the least of, and the same of its end) for windows of ``size`` words."""
    shortest = min(CHUNK_WORDS, size - MARGIN_WORDS - 1)
    if shortest < 1:
        raise ValueError(f"windows need at least {MARGIN_WORDS + 2} words")
    free = size + 1 - MARGIN_WORDS - shortest
    return shortest, free - max(1, free // 3), max(1, free // 3)


def anchors(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word starts and ends, and of every window of ``size`` words in one text: first word, text, hash of its chunk and first word of that.

    The chunk of a window begins at the word start with the least gear hash among the first ones that
    have their hashed bytes inside the window, and ends at the least one among those that follow the
    shortest chunk. Both lie in the window and depend on its bytes alone.
    """
    starts, ends, doc = word_spans(data, offsets)
    many = len(starts) - size + 1
    if many < 1:
        return starts, ends, *[np.zeros(0, kind) for kind in (np.int64, np.int64, np.uint64, np.int64)]
    shortest, head, tail = spans_of(size)
    rolled = gear(data)[np.maximum(starts - 1, 0)]
    begin = least_places(rolled, head)[MARGIN_WORDS : MARGIN_WORDS + many]
    places, at = np.unique(begin, return_inverse=True)
    until = least_places(rolled, tail)[places + shortest]
    hashes = word_hashes(data, starts[places], ends[until - 1])
    first = np.flatnonzero(doc[:many] == doc[size - 1 :])
    return starts, ends, first, doc[first], hashes[at[first]], begin[first]


def _anchor_rows(docs: DataFrame, size: int) -> DataFrame:
    """(key, body, anchor, again) of every window chunk of (key, body, text); ``again`` where its text has it elsewhere too."""

    def split(batches):
        for batch in batches:
            keys, bodies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, _, data, offsets in text_slices(batch.column(2)):
                _, _, _, doc, least, place = anchors(data, offsets, size)
                if not len(doc):
                    continue
                new = np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])))
                doc, least = doc[new], least[new]
                order = np.lexsort((least, doc))
                same = (least[order][1:] == least[order][:-1]) & (doc[order][1:] == doc[order][:-1])
                again = np.zeros(len(order), bool)
                again[order[1:]] = same
                columns = [pa.array(keys[a + doc]), pa.array(bodies[a + doc]), pa.array(least.view(np.int64)), pa.array(again)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "body", "anchor", "again"])

    return docs.mapInArrow(split, "key long, body long, anchor long, again boolean")


def _window_rows(rows: DataFrame, size: int) -> DataFrame:
    """(key, body, place, high, low) of the windows of (key, body, _text, anchors) with one of the anchors."""

    def split(batches):
        for batch in batches:
            keys, bodies = batch.column("key").to_pylist(), batch.column("body").to_pylist()
            for key, body, packed, wanted in zip(keys, bodies, batch.column("_text").to_pylist(), batch.column("anchors")):
                raw = zlib.decompress(packed)
                starts, ends, first, _, least, _ = anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), size)
                first = first[np.isin(least.view(np.int64), wanted.values.to_numpy())]
                begin, end = starts[first].tolist(), ends[first + size - 1].tolist()
                digests = b"".join([hashlib.blake2b(raw[x:y], digest_size=16).digest() for x, y in zip(begin, end)])
                halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = [np.full(len(first), key), np.full(len(first), body), first.astype(np.int32), halves[:, 0], halves[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "body", "place", "high", "low"])

    return rows.mapInArrow(split, "key long, body long, place int, high long, low long")


def _covered(raw: bytes, places: list[dict], size: int) -> list[tuple[int, int, int]]:
    """(start, end, words) of the words in windows at ``places``, up to the next word's start.

    Where a text repeats itself, words of the first occurrence are not covered by one that overlaps it.
    A place of -1 stands for all windows.
    """
    data = np.frombuffer(raw, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(raw)]))
    if places[0]["place"] < 0:
        return [(int(starts[0]), int(ends[-1]), len(starts))] if len(starts) >= size else []
    edge = np.zeros(len(starts) + 2, np.int64)
    for p in places:
        edge[max(p["place"], p["own"] + size)] += 1
        edge[p["place"] + size] -= 1
    gone = np.cumsum(edge) > 0
    turns = np.flatnonzero(gone != np.concatenate(([False], gone[:-1])))
    until = np.append(starts, ends[-1])
    return [(int(starts[a]), int(until[b]), b - a) for a, b in zip(turns[::2].tolist(), turns[1::2].tolist())]


def equal_texts(rows: DataFrame) -> DataFrame:
    """(key, body) of the texts that a smaller key has too, from (key, body, text)."""
    named = rows.select("key", "body", F.unhex(F.md5(F.col("text").cast("binary"))).alias("_digest"))
    owners = named.groupBy("body", "_digest").agg(F.min("key").alias("_first"), F.max("key").alias("_last")).where("_first < _last")
    return named.join(owners, ["body", "_digest"]).where("key > _first").select("key", "body").distinct()


def remove_passages(docs: DataFrame, passage: int = PASSAGE, text: str = "text") -> DataFrame:
    """``docs`` without the words of every run of more than ``passage`` words whose bytes occur earlier,

    in a smaller document or before in the same one, from the first word to the last; shorter
    repeats stay whole. Columns ``n_removed`` (runs), ``removed_words`` and ``removed_bytes`` are
    added; they replace columns of these names, others pass through unread. A null text stays null,
    an empty one or one of at most ``passage`` words is never cut. A null doc_id comes first. Rows with
    the same doc_id and text are one document. An empty table gives no rows; a very long text is
    worked on by itself.

    Chunks decide what is compared: texts equal to an earlier one go as a whole, the others give the
    chunk of each of their windows, and only windows whose chunk occurs in two different texts, or
    twice in one, are compared byte by byte, through 128-bit digests.
    """
    ready(docs.sparkSession)
    size = passage + 1
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(row_key().alias("key"), F.xxhash64(body).alias("body"), body.alias("text"))
    copies = stored(equal_texts(rows), "cdc-copies")
    found = stored(_anchor_rows(rows, size), "cdc-anchors")
    # Equal texts have equal bodies: what they alone share needs no window.
    shared = found.groupBy("anchor").agg((F.min("body") < F.max("body")).alias("differ"), F.max("again").alias("again"))
    twice = stored(shared.where("differ OR again").select("anchor"), "cdc-twice")
    wanted = found.join(twice, "anchor").join(copies, ["key", "body"], "left_anti").groupBy("key", "body").agg(F.collect_set("anchor").alias("anchors"))
    packed = deflated(rows.select("key", F.col("text").alias("_text"), "body"))
    windows = stored(_window_rows(packed.join(wanted, ["key", "body"]), size), "cdc-windows")
    here = F.struct("key", "body", "place")
    owners = windows.groupBy("high", "low").agg(F.min(here).alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1")
    owners = stored(owners.select("high", "low", "owner"), "cdc-owners")
    later = windows.join(owners, ["high", "low"]).where(here != F.col("owner"))
    same = (F.col("owner.key") == F.col("key")) & (F.col("owner.body") == F.col("body"))
    own = F.when(same, F.col("owner.place")).otherwise(F.lit(-size))
    place = F.struct("place", own.alias("own"))
    places = later.groupBy("key", "body").agg(F.collect_list(place).alias("places"))
    whole = copies.select("key", "body", F.array(F.struct(F.lit(-1).alias("place"), F.lit(-size).alias("own"))).alias("places"))
    return _without(docs, places.unionByName(whole), lambda raw, found_at: _covered(raw, found_at, size), text)
