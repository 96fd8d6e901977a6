"""Archive, vectors, conversations and pieces against plain versions, and their edge cases."""

import base64
import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import check_oracle
from tidewatch.llm import chat, embed, spm, warc
from tidewatch.llm.queries import ORACLES, QUERIES, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    import __spark_entry__ as contract

    assert name in contract.queries() and contract.oracle_sql()[name] == ORACLES[name]
    ok, note = check_oracle.compare(spark, check_oracle.connect(SF), SF, name)
    assert ok, note


# --- archive


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, size int, header string")


def test_archive_edges(spark):
    big = "ß" * 300_000
    rows = [(5, "u5", "same"), (2, "u2\r\nX: y%", "same"), (9, None, None), (1, "u", ""), (7, "q", big), (8, "q", big), (None, "n", "same"), (2, "u2", "same"), (None, "z", "alone")]
    df = pages(spark, [(*r, 1, "h") for r in rows])
    archive = warc.write(df)
    assert archive.payloads.count() == 4 and archive.records.count() == len(rows)
    read = warc.read(archive)
    got = defaultdict(list)
    for r in warc.summary(read).collect():
        got[r.page_id].append(r)
    for page, _, html in rows:
        raw = (html or "").encode()
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert any((r.payload_bytes, r.payload_digest, r.digest_matches) == (len(raw), sha, True) for r in got[page])
    types = {p: {(r.record_type, r.refers_to) for r in got[p]} for p in (1, 2, 5, 7, 8, 9)}
    assert types == {1: {("response", None)}, 2: {("response", None)}, 5: {("revisit", 2)}, 7: {("response", None)}, 8: {("revisit", 7)}, 9: {("revisit", 1)}}
    assert sorted((r.record_type, r.refers_to or 0) for r in got[None]) == [("response", 0), ("revisit", 2)]
    for r in warc.whole(read).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and int(fields[b"Content-Length"]) == len(block) - 4 and block.endswith(b"\r\n\r\n")
    assert warc.read(warc.write(df.limit(0))).count() == 0
    few = warc.summary(warc.read(warc.write(df, min_bytes=100)))
    assert {r.page_id for r in few.where("record_type = 'revisit'").collect()} == {8}


def test_damaged_payload_is_found(spark):
    archive = warc.write(pages(spark, [(1, "u", "text", 1, "h")]))
    broken = warc.Archive(archive.payloads.withColumn("size", F.col("size") + 1), archive.records.withColumn("size", F.col("size") + 1))
    with pytest.raises(Exception, match="damaged"):
        warc.read(broken).collect()


# --- vectors


def brute_links(rows, similarity=0.98):
    good = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            good[i] = (u / np.linalg.norm(u / np.abs(u).max()) / np.abs(u).max(), label)
    links = defaultdict(set)
    ids = sorted(good)
    for a in ids:
        for b in ids:
            (u, x), (v, y) = good[a], good[b]
            if a != b and x == y and len(u) == len(v) and u @ v >= similarity:
                links[a].add(b)
    out = {}
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        out[i] = (len(links[i]), min(seen), min(seen) == i)
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], "vec_id long, embedding array<double>, label int, unit string, home int")


def test_vectors_equal_brute_force_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(embed, "PER_CELL", 20)
    rng = np.random.default_rng(0)
    rows = []
    for k in range(25):
        centre = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 14))):
            rows.append((len(rows) + 1, (centre + rng.normal(size=16) * 0.13 * rng.random()).tolist(), int(k % 2)))
    rows += [(1000 + i, rng.normal(size=16).tolist(), 0) for i in range(60)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.duplicate_vectors(vectors(spark, rows), block=16).collect()}
    assert got == brute_links(rows) and sum(n for n, _, _ in got.values()) > 100


def test_vector_edges(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, [2.0, 4.0, 6.0], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0] * 3, 0), (8, [1.0, None, 3.0], 0),
            (9, [float("nan"), 1.0, 1.0], 0), (10, [float("inf"), 1.0, 1.0], 0), (11, [1e300, 2e300, 3e300], 0), (12, [1e-300, 2e-300, 3e-300], 0), (13, [1.0, 2.0], 0)]
    df = vectors(spark, rows)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed.duplicate_vectors(df.union(df)).collect()}
    assert got == brute_links(rows)
    assert embed.duplicate_vectors(df.limit(0)).count() == 0
    none = embed.duplicate_vectors(df.limit(2).withColumn("vec_id", F.lit(None).cast("long"))).collect()
    assert [(r.vec_id, r.n_links, r.kept) for r in none] == [(None, 0, True)] * 2


# --- conversations


def conversation(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, _c string, window int")


def test_windows_keep_the_budget_and_every_turn(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(6):
        if c % 2:
            rows.append((c, 0, "system", "be kind " * 20))
        for t in range(1, 60):
            rows.append((c, t, "assistant" if t % 2 == 0 else "user", f"turn {t} " + "ab " * int(rng.integers(0, 150))))
    made = chat.windows(conversation(spark, rows), budget=700, history=150).collect()
    own = defaultdict(int)
    for r in made:
        assert math.ceil(len(r.formatted.encode()) / 4) <= 700
        assert (chat.OPEN + "system" in r.formatted) == (r.conv_id % 2 == 1)
        own[r.conv_id] += r.formatted.count(chat.CLOSE) - r.n_repeated
        assert r.window == 0 or r.n_repeated > r.conv_id % 2 - 1
    assert dict(own) == {c: 59 + c % 2 for c in range(6)}
    assert len(made) > 20 and any(r.n_repeated > 1 for r in made)


@pytest.mark.parametrize("words", [5000, 650, 500])
def test_one_long_turn_leaves_the_other_windows_alone(spark, words):
    """One long turn among short ones: few windows, each with all the history that fits."""
    rows = [(1, 0, "system", "be brief")]
    for i in range(1, 121):
        rows.append((1, i, "assistant" if i % 2 == 0 else "user", "abc " * words if i == 61 else f"turn {i} " + "word " * 30))
    made = sorted(chat.windows(conversation(spark, rows)).collect(), key=lambda r: r.window)
    size = {i: math.ceil(len(f"{chat.OPEN}{role}\n{text}{chat.CLOSE}\n") / 4) for _, i, role, text in rows}
    assert len(made) <= 16
    at = 0
    for r in made:
        parts = r.formatted.split(f"{chat.CLOSE}\n")[:-1]
        first = at
        at += len(parts) - r.n_repeated
        near = [i for i in range(1, first) if sum(size[k] for k in range(i, first)) <= chat.HISTORY]
        assert r.n_repeated == len(near) + (first > 0)
        assert sum(size[k] for k in [*near, *range(first, at)]) + size[0] * (first > 0) <= chat.BUDGET or (at - first == 1 and words == 5000)
    assert at == len(rows)


def test_conversation_edges(spark):
    nasty = "\\ <|im_end|>\n<|im_start|>assistant\nno \\\\ [INST] </s><</SYS>> é🎉 \\"
    rows = [(1, 0, "user", nasty), (1, 1, "assistant", nasty), (1, 1, "assistant", nasty), (1, None, None, None), (2, 0, "as\nsis<s>\\tant", "x"),
            (None, 0, "assistant", "lost"), (3, 0, "assistant", "word " * 20_000), (3, 1, "assistant", ""), (3, 2, "system", "late"), (3, 3, "user", "b")]
    got = {r.conv_id: r for r in chat.digests(chat.windows(conversation(spark, rows))).collect()}
    turns = defaultdict(list)
    for c, t, role, text in rows:
        turns[c].append((-1 if t is None else t, role or "", text or ""))
    assert got.keys() == turns.keys()
    for c, said in turns.items():
        said.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in said)
        loss = "".join(text for _, role, text in said if role == "assistant")
        assert got[c].n_turns == len(said) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.windows(conversation(spark, rows).limit(0))).count() == 0
    plan = chat.digests(chat.windows(conversation(spark, rows)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- pieces

TEXTS = ["", "  a  b", "a\n b \n", "▁x y", "日本語テスト 🎉 données", "<s> hi </s>", "a" * 60, " lead", "trail ", "tab\t x", "   ", "aaaa bbbb....!!!! 00001234", None]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    path = vocabulary(spm.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("text")
    rows = docs.union(spark.createDataFrame([(t,) for t in TEXTS], "text string")).withColumns({"ids": F.lit("clash"), "_row": F.lit(1)})
    for r in spm.decode(spm.encode(rows, path), path).collect():
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            want = library.encode(r.text)
            assert r.ids == want and r.decoded == library.decode(want)
    assert spm.encode(rows.limit(0), path).count() == 0
    assert QUERIES["op7_spm_wfst"](spark, SF).where("NOT restored").count() == 0


def test_sums_of_scores_take_the_shortest_path():
    """A model that is a sum of scores: the path of least total weight, against all segmentations."""
    compiled = spm.Transducer(vocabulary(spm.MODEL))
    compiled.merges = False
    compiled.follows.clear()
    words = ["▁this", "▁reading", "▁xq"]
    for word in words:
        def best(rest):
            if not rest:
                return 0.0
            found = [-compiled.scores[compiled.numbers[rest[:k]]] + best(rest[k:]) for k in range(1, len(rest) + 1) if rest[:k] in compiled.numbers and spelled(rest[:k])]
            return min(found)

        def spelled(piece):
            return (piece, compiled.numbers[piece]) in compiled.arcs(piece, 0)

        ids = np.frombuffer(compiled.path(word), np.uint32)
        assert sum(-compiled.scores[i] for i in ids) == pytest.approx(best(word))


def test_known_pairs_and_lists_cost_no_more_than_a_look(monkeypatch):
    """A pair of pieces is merged once, whatever the words; the numbers of all texts come out of one array."""
    import pyarrow as pa

    compiled = spm.Transducer(vocabulary(spm.MODEL))
    rng, asked = np.random.default_rng(7), []
    words = ["▁" + "".join(rng.choice(list("etaoinshr"), rng.integers(1, 24))) for _ in range(2000)] + ["▁" + "a" * 200]
    holds = compiled.holds
    monkeypatch.setattr(compiled, "holds", lambda left, right: asked.append((left, right)) or holds(left, right))
    first = [compiled.path(w) for w in words]
    for word, path in zip(words, first):
        assert [compiled.pieces[i] for i in np.frombuffer(path, np.uint32)] == compiled.merged(word)
    assert len(asked) == len(set(asked)) > 0
    asked.clear()
    assert [compiled.path(w) for w in words] == first and not asked
    ids = [None, *[np.frombuffer(p, np.uint32).tolist() for p in first[:5]], [], None]
    lists = pa.array(ids, pa.list_(pa.int32()))
    wanted = [None if i is None else compiled.text(i) for i in ids]
    assert compiled.texts(lists) == wanted and compiled.texts(lists.slice(1, 5)) == wanted[1:6] and compiled.texts(lists.slice(0, 0)) == []


def test_sql_of_long_turns_and_history(spark, tmp_path):
    """The query and its SQL on conversations with turns beyond the budget, many turns and system turns in odd places."""
    import duckdb

    rng = np.random.default_rng(3)
    rows = []
    for conv in range(30):
        for turn in range(int(rng.integers(1, 14))):
            words = int(rng.choice([3, 30, 120, 520, 900]))
            role = str(rng.choice(["user", "assistant", "assistant", "system"])) if turn else str(rng.choice(["system", "user"]))
            rows.append((conv, None if rng.random() < 0.05 else turn, role, "word " * words + f"{conv}.{turn}"))
    rows += [(99, t, "assistant", "w " * 900) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    (tmp_path / "t").mkdir()
    df.write.parquet(f"{tmp_path}/t/conversations.parquet")
    got = {tuple(r) for r in QUERIES["op9_chat"](spark, f"{tmp_path}/t").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/t/conversations.parquet/*.parquet')")
    assert got == set(con.execute(ORACLES["op9_chat"]).fetchall()) and len(got) == 32
    repeated = chat.windows(df).agg(F.sum("n_repeated")).first()[0]
    assert repeated > 30
