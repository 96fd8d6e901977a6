"""Byte-pair encoding through a table of distinct words, and decoding through a piece table.

Texts are cut into words in front of every space that a visible character follows: such a space
always opens a pre-token, so words are encoded apart with the ids of the whole text. A word in
front of an added token stays with what is before it, as added tokens are taken out of a text first.

``split`` keeps texts as blocks: the distinct words of about ``BLOCK_BYTES`` of text and, for each
place, the number of its word there. Blocks are written once, bucketed by block, so they are never
shuffled. ``word_ids`` sends the words of all blocks to parts by a hash, encodes each distinct word
once in its part and sends ids back under (block, part). ``encode`` meets the two by block and puts
the ids of each word at its places. What travels is a word per block and not a word per place, and
no task sees more than one block or one part, however common a word is.

``decode`` joins ids with the table of pieces, whose size is that of the vocabulary, inside the tasks.
"""

from __future__ import annotations

import math
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewatch.llm.common import SLICE_BYTES, ready, text_slices, word_hashes
from tidewatch.session import fresh_path

VOCABULARY = "byte_bpe_50k.json"
# Text in a block, and words in a part of the word table; both bound the memory of a task.
BLOCK_BYTES = 28_000_000
PART_WORDS = 150_000
# Buckets of the table of blocks; a task takes the blocks of a bucket one after another.
MAX_BUCKETS = 20_000
# Words put together in one step of ``encode``.
STEP_WORDS = 100_000
# Words handed to the tokenizer at once.
CALL_WORDS = 4_000
ID = np.dtype("<u4")

# Bytes that open a visible character; others, such as the first bytes of wide spaces, open no word.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = _VISIBLE[0xC3:0xE1] = _VISIBLE[0xE4:] = True

_tokenizers: dict[str, object] = {}


def tokenizer_of(path: str):
    """The tokenizer of a vocabulary file without truncation and padding, one per worker."""
    if path not in _tokenizers:
        # A task has one core; threads of its own would only hold memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def added_tokens(path: str) -> list[bytes]:
    return [t.content.encode() for t in tokenizer_of(path).get_added_tokens_decoder().values()]


def word_starts(data: np.ndarray, offsets: np.ndarray, added: list[bytes]) -> np.ndarray:
    """Byte positions at which words begin, with the starts of texts."""
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[:-2] = (data[:-1] == 32) & _VISIBLE[data[1:]]
    raw = data.tobytes()
    for token in added:
        at = raw.find(token)
        while at >= 0:
            cut[max(at - 1, 0)] = False
            at = raw.find(token, at + 1)
    cut[offsets] = True
    return np.flatnonzero(cut[:-1])  # no start for the empty texts at the end


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, byte plane by byte plane, compressed."""
    planes = [a.astype(ID, copy=False).view(np.uint8).reshape(-1, 4).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(planes[0] if len(planes) == 1 else b"".join(planes))


def _unpack(blob: bytes, sizes: list[int]) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    out, at = [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(flat[at : at + 4 * n].reshape(4, n).T).view(ID).ravel())
        at += 4 * n
    return out


def _binary(data: bytes, lengths: np.ndarray) -> pa.Array:
    """A binary column from joined values and their lengths."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


BLOCKS = "block string, n_docs int, n_words int, n_distinct int, docs binary, places binary, lengths binary, words binary"


def _block(ids: list, data: bytearray, starts: list[np.ndarray], per_doc: list[np.ndarray]) -> dict:
    """One row of a block: document ids, words of each, number of the word at each place, distinct words."""
    edges = np.append(np.concatenate(starts), np.int32(len(data)))
    joined = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    words = joined.dictionary_encode()
    del joined, edges
    numbers = words.indices.to_numpy(zero_copy_only=False)
    # Common words get small numbers, which pack well.
    order = np.argsort(-np.bincount(numbers, minlength=len(words.dictionary)), kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    table = words.dictionary.take(pa.array(order))
    nulls = np.array([i is None for i in ids])
    keys = np.array([0 if i is None else i for i in ids], np.int64)
    compress = zstandard.ZstdCompressor(level=3).compress
    return {
        "block": uuid.uuid4().hex, "n_docs": len(ids), "n_words": len(numbers), "n_distinct": len(order),
        "docs": compress(keys.tobytes() + nulls.tobytes() + np.concatenate(per_doc).astype(np.int64).tobytes()),
        "places": _pack(rank[numbers]),
        "lengths": _pack(pc.binary_length(table).to_numpy(zero_copy_only=False)),
        "words": compress(b"".join(table.to_pylist())),
    }


def released() -> None:
    """Give freed memory back: the workers of an executor outlive their tasks."""
    pa.default_memory_pool().release_unused()


def _row(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: [v] for k, v in values.items()}, schema=schema)


_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in text.split(", ")])


class Blocks:
    """A written table of blocks, bucketed by block; ``n_words`` counts their distinct words."""

    def __init__(self, spark: SparkSession, name: str):
        self.rows = spark.table(name)
        totals = self.rows.agg(F.sum("n_distinct").alias("n"), F.count(F.lit(1)).alias("blocks")).first()
        self.n_words, self.n_blocks = totals["n"] or 0, totals["blocks"]


def split(docs: DataFrame, vocabulary: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> Blocks:
    """Write the texts as blocks of distinct words and word numbers by place."""
    spark = ready(docs.sparkSession)
    added = added_tokens(vocabulary)
    schema = _schema(BLOCKS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0

    def cut(batches):
        ids, held, starts, per_doc = [], bytearray(), [], []

        def made():
            nonlocal ids, held, starts, per_doc
            row = _row(_block(ids, held, starts, per_doc), schema)
            ids, held, starts, per_doc = [], bytearray(), [], []
            released()
            return row

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for a, b, data, offsets in text_slices(batch.column(1), min(block_bytes, SLICE_BYTES)):
                if held and len(held) + len(data) > block_bytes:
                    yield made()
                ids += keys[a:b]
                begins = word_starts(data, offsets, added)
                per_doc.append(np.diff(np.append(np.searchsorted(begins, offsets[:-1]), len(begins))))
                starts.append((begins + len(held)).astype(np.int32))
                held += data.tobytes()
        if ids:
            yield made()

    name = f"bpe_blocks_{uuid.uuid4().hex}"
    writer = rows.mapInArrow(cut, BLOCKS).write.format("parquet").option("path", fresh_path(spark, "bpe-blocks"))
    writer.bucketBy(min(max(8, math.ceil(size / block_bytes)), MAX_BUCKETS), "block").saveAsTable(name)
    return Blocks(spark, name)


PARTS = "part int, block string, n int, numbers binary, lengths binary, words binary"
IDS = "block string, n int, n_ids int, numbers binary, counts binary, ids binary"


def word_ids(blocks: Blocks, vocabulary: str, part_words: int = PART_WORDS) -> DataFrame:
    """(block, n, n_ids, numbers, counts, ids): ids of the distinct words of each block, a row per part."""
    n_parts = max(1, math.ceil(blocks.n_words / part_words))
    parts_schema, ids_schema = _schema(PARTS), _schema(IDS)

    def spread(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (lengths,) = _unpack(row["lengths"], [row["n_distinct"]])
                raw = zstandard.ZstdDecompressor().decompress(row["words"])
                ends = np.cumsum(lengths.astype(np.int64))
                part = (word_hashes(np.frombuffer(raw, np.uint8), ends - lengths, ends) % np.uint64(n_parts)).astype(np.int64)
                words = _binary(raw, lengths)
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(n_parts + 1))
                for p in np.flatnonzero(np.diff(edges)).tolist():
                    some = order[edges[p] : edges[p + 1]]
                    held = zstandard.ZstdCompressor(level=1).compress(b"".join(words.take(pa.array(some)).to_pylist()))
                    yield _row({"part": p, "block": row["block"], "n": len(some), "numbers": _pack(some), "lengths": _pack(lengths[some]), "words": held}, parts_schema)

    def encoded(batches):
        """One part: its rows come from all blocks, its distinct words fit one task."""
        blobs, keys, sizes = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                (lengths,) = _unpack(row["lengths"], [row["n"]])
                blobs.append(_binary(zstandard.ZstdDecompressor().decompress(row["words"]), lengths))
                keys.append((row["block"], row["numbers"]))
                sizes.append(row["n"])
        table = pa.concat_arrays(blobs).dictionary_encode()
        flat, counts = word_table(table.dictionary, vocabulary)
        starts = np.cumsum(counts) - counts
        at = 0
        for (block, numbers), n in zip(keys, sizes):
            which = table.indices[at : at + n].to_numpy(zero_copy_only=False)
            at += n
            held = gathered(flat, starts[which], counts[which])
            released()
            yield _row({"block": block, "n": n, "n_ids": len(held), "numbers": numbers, "counts": _pack(counts[which]), "ids": _pack(held)}, ids_schema)

    sent = blocks.rows.select("block", "n_distinct", "lengths", "words").mapInArrow(spread, PARTS)
    return sent.groupBy("part").applyInArrow(_by_batches(encoded), IDS)


def _by_batches(fn):
    """A grouped function over an iterator of batches, as ``applyInArrow`` takes it."""

    def grouped(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(fn(table.to_batches())), schema=_schema(IDS))

    return grouped


def word_table(words: pa.Array, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of distinct words, joined, and how many each has."""
    tokenizer = tokenizer_of(vocabulary)
    flat, counts = [], []
    for at in range(0, len(words), CALL_WORDS):
        some = words[at : at + CALL_WORDS].cast(pa.string()).to_pylist()
        lists = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        counts.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        flat.append(np.fromiter((i for ids in lists for i in ids), ID, int(counts[-1].sum())))
    empty = np.zeros(0, np.int64)
    return np.concatenate(flat or [empty.astype(ID)]), np.concatenate(counts or [empty])


def gathered(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + count]``, joined."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - counts), counts) + np.arange(total)]


ENCODED = "doc_id long, n_tokens long, ids binary"


def encode(docs: DataFrame, vocabulary: str, text: str = "text", block_bytes: int = BLOCK_BYTES, part_words: int = PART_WORDS) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of every text as little-endian unsigned 32-bit numbers.

    They are those of the tokenizer on the whole text, added tokens included. Null and empty texts
    have none. Repeated rows are encoded each, null ids stay null, other columns are not read, an
    empty table gives no rows. A text longer than ``block_bytes`` is a block of its own.
    """
    blocks = split(docs, vocabulary, text, block_bytes)
    found = word_ids(blocks, vocabulary, part_words)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        batches = []
        for row in left.to_pylist():
            counts = np.zeros(row["n_distinct"], np.int64)
            starts = np.zeros(row["n_distinct"], np.int64)
            held, at = [], 0
            for part in right.to_pylist():
                numbers, = _unpack(part["numbers"], [part["n"]])
                size, = _unpack(part["counts"], [part["n"]])
                held += _unpack(part["ids"], [part["n_ids"]])
                counts[numbers] = size
                starts[numbers] = at + np.cumsum(size.astype(np.int64)) - size
                at += part["n_ids"]
            flat = np.concatenate(held or [np.zeros(0, ID)])
            places, = _unpack(row["places"], [row["n_words"]])
            n, raw = row["n_docs"], zstandard.ZstdDecompressor().decompress(row["docs"])
            keys, nulls = np.frombuffer(raw, np.int64, n), np.frombuffer(raw, bool, n, 8 * n)
            ends = np.cumsum(np.frombuffer(raw, np.int64, n, 9 * n))
            a = 0
            while a < n:
                base = int(ends[a - 1]) if a else 0
                b = max(a + 1, int(np.searchsorted(ends, base + STEP_WORDS, side="right")))
                some = places[base : int(ends[b - 1])]
                per_word = counts[some]
                ids = gathered(flat, starts[some], per_word)
                til = np.concatenate(([0], np.cumsum(per_word)))[ends[a:b] - base]
                tokens = np.diff(til, prepend=0)
                batches.append(pa.RecordBatch.from_arrays(
                    [pa.array(keys[a:b], mask=nulls[a:b]), pa.array(tokens), _binary(ids.tobytes(), 4 * tokens)], schema=schema
                ))
                a = b
            del places, flat, held
        released()
        return pa.Table.from_batches(batches, schema=schema)

    own = blocks.rows.select("block", "n_docs", "n_words", "n_distinct", "docs", "places")
    return own.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(joined, ENCODED)


def pieces(vocabulary: str) -> list[tuple[int, bytes]]:
    """The piece table (id, bytes) of a byte-level vocabulary; added tokens are their own text.

    Byte-level vocabularies write printable bytes as themselves and the others, in order, as the
    characters from 256 on.
    """
    tokenizer = tokenizer_of(vocabulary)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    own = {i: bytes(back[c] for c in t) for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if all(c in back for c in t)}
    return sorted((own | {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}).items())


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Add the text of ``ids``; special tokens stay in it.

    The piece table is the broadcast side of the join: its size is that of the vocabulary. Ids
    outside of it have no text, bytes that are no UTF-8 become replacement characters, null ids
    give a null text.
    """
    spark = ready(encoded.sparkSession)
    table = pieces(vocabulary)
    top = max(i for i, _ in table) + 1
    lengths = np.zeros(top + 1, np.int64)
    lengths[[i for i, _ in table]] = [len(p) for _, p in table]
    side = spark.sparkContext.broadcast((np.frombuffer(b"".join(p for _, p in table), np.uint8), lengths))
    kept = [c for c in encoded.columns if c != into]

    def joined(batches):
        flat, sizes = side.value
        starts = np.cumsum(sizes) - sizes
        for batch in batches:
            texts = []
            for raw in batch.column(batch.schema.get_field_index(ids)):
                if not raw.is_valid:
                    texts.append(None)
                    continue
                # The last place of the table is empty; unknown ids go there.
                which = np.minimum(np.frombuffer(raw.as_buffer(), ID), len(sizes) - 1)
                parts = [gathered(flat, starts[w], sizes[w]).tobytes() for w in np.array_split(which, 1 + len(which) // STEP_WORDS)]
                texts.append(b"".join(parts).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, into])

    rows = encoded.select(*kept)
    return rows.mapInArrow(joined, StructType([*rows.schema.fields, StructField(into, StringType())]))
