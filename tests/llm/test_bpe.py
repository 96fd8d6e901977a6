"""Distinct-word encoding against the tokenizer on whole texts."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import bpe
from tidewatch.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def path():
    return vocabulary(bpe.VOCABULARY)


def expected(path, text):
    tokenizer = bpe.tokenizer_of(path)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)


def ids_of(row):
    return tuple(np.frombuffer(row.ids, bpe.ID).tolist())


ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "a   b\n\n c \n d\t e", "<|endoftext|>", "x  <|endoftext|>", "x <|endoftext|> y  <|endoftext|>z",
    " <|endoftext|>", "<|endoftext|> <|endoftext|>", "I'll don't 've ' s", "é ü ñ  ß", "wide　space 　x  y \u0085z  q", "数 字 と kana", "😀 😀😀 x😀",
    "\x00 \x1c \x1f a", "l" * 5000 + " " + "word " * 3000, "tab\t a\t\tb", "end \n", "naïve naïve naïve",
]


def test_encode_equals_the_tokenizer_on_odd_texts(spark, path):
    rng = random.Random(3)
    alphabet = [" ", "  ", "\n", "a", "bc", "é", "'s", "12", "<|endoftext|>", "　", "!?", "\t", "ß", "数"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(300)]
    rows = [(i, t, "x", 1, b"z") for i, t in enumerate(texts)] + [(None, "lost id", "x", 1, b"z")] * 2 + [(3, "a b", "x", 1, b"z")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, n_words int, ids binary")
    want = Counter((i, *expected(path, t)) for i, t, *_ in rows)
    for block_bytes, part_words in ((bpe.BLOCK_BYTES, bpe.PART_WORDS), (2_000, 200)):
        encoded = bpe.encode(df, path, block_bytes=block_bytes, part_words=part_words)
        got = bpe.decode(encoded, path).collect()
        assert all(r.n_tokens == len(ids_of(r)) for r in got)
        assert Counter((r.doc_id, ids_of(r), r.decoded) for r in got) == want


def test_each_distinct_word_is_encoded_once(spark, path):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("same words all over "), (F.col("id") % 7).cast("string")).alias("text")).repartition(8)
    blocks = bpe.split(docs, path, block_bytes=1_000)
    assert blocks.n_blocks >= 8
    parts = bpe.word_ids(blocks, path, part_words=10**9).collect()
    assert sum(r.n for r in parts) == blocks.n_words
    # A row of a part holds each word of its block once, however often the block has it.
    assert max(r.n for r in parts) <= 11


def test_blocks_are_not_shuffled(spark, path):
    docs = spark.range(10).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    plan = bpe.encode(docs, path)._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("FlatMapCoGroupsInArrow") :].split("Exchange")[0]
    assert "Bucketed: true" in left


def test_empty_table_and_unknown_ids(spark, path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(none, path).count() == 0
    assert bpe.decode(bpe.encode(none, path), path).count() == 0
    rows = [(1, np.array([0, 4_000_000_000, 60_000, 1], bpe.ID).tobytes()), (2, None), (3, b""), (4, np.array([447], bpe.ID).tobytes())]
    got = {r.k: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "k long, ids binary"), path).collect()}
    pieces = dict(bpe.pieces(path))
    assert got[1] == (pieces[0] + pieces[1]).decode() and got[2] is None and got[3] == ""
    assert got[4] == bpe.tokenizer_of(path).decode([447], skip_special_tokens=False)


def test_query_equals_the_tokenizer(spark, path):
    import hashlib

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in docs:
        ids, decoded = expected(path, r.text)
        want.add((r.doc_id, len(ids), hashlib.sha256(np.array(ids, bpe.ID).tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op12_bpe_words"](spark, SF).collect()]
    assert len(got) == len(docs) and set(got) == want


def test_the_unit_store_of_packing_stays_small():
    """A worker keeps it beside what earlier stages left there; starting anew changes no ids."""
    import public_tokenizers

    from tidewatch.llm import packing

    path = public_tokenizers.path(packing.VOCABULARY)
    ids_of, store = packing.encoder(path)
    assert store.limit <= 250_000
    texts = [" ".join(f"w{i}x{k}" for i in range(40)) for k in range(50)]
    held, store.limit = store.limit, 100
    try:
        assert [packing.text_ids(t, path) for t in texts] == [ids_of(t).tobytes() for t in texts]
        assert len(store) <= 140
    finally:
        store.limit = held
