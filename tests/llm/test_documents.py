"""Document operators against brute force, and their edge cases."""

import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import cdc, minhash, packing, quality, rules, toxicity
from tidewatch.llm.queries import QUERIES, vocabulary

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, key string, score double, _row int"


def frame(spark, texts, first=1):
    """Documents with an id, a text and columns whose names clash with those the operators use."""
    return spark.createDataFrame([(first + i, t, "k", 9.0, 3) for i, t in enumerate(texts)], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))


ODD = [None, "", "   \n\t ", "one", "é ñ 日本", "x" * 5000, "a " * 3000]


# --- near duplicates


def shingled(text):
    words = WORD.findall(text or "")
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def brute_groups(pairs_of, similarity=0.8):
    sets = [shingled(t) for _, t in pairs_of]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = sum((a & sets[j]).values())
            union = sum(a.values()) + sum(sets[j].values()) - both
            same = (pairs_of[i][1] or "") == (pairs_of[j][1] or "")
            if same or (union and both >= similarity * union):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(pairs_of):
        groups[find(i)].append(d)
    return {d: min(g) for g in groups.values() for d in g}


def test_near_duplicates_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r.cluster_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_groups(rows)


def test_near_duplicate_chain_and_edges(spark):
    base = prose(200, 1).split()
    chain = [" ".join(base[k:] + prose(k, 50 + k).split()) for k in (0, 9, 18, 27, 36)] if False else []
    for k in range(5):
        words = list(base)
        for j in range(k):
            words[10 + 37 * j] = f"new{j}"
        chain.append(" ".join(words))
    texts = [*chain, *chain[:1], *ODD, "", prose(300, 2)]
    df = frame(spark, texts)
    got = {r.doc_id: r.cluster_id for r in minhash.near_duplicates(df).collect()}
    assert got == brute_groups([(i + 1, t) for i, t in enumerate(texts)])
    twice = minhash.one_of_each(df.union(df))
    kept = {d for d, c in got.items() if d == c}
    assert sorted(r.doc_id for r in twice.collect()) == sorted(kept)
    assert twice.columns == df.columns
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    assert minhash.one_of_each(df.limit(0)).count() == 0
    nameless = df.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    assert [tuple(r)[2:] for r in minhash.near_duplicates(nameless).collect()] == [(None, True)] * 3


def test_large_group_of_near_copies(spark):
    rng, base, texts = np.random.default_rng(5), prose(120, 7).split(), []
    for _ in range(150):
        words = list(base)
        for j in rng.choice(120, 2, replace=False):
            words[j] = f"w{rng.integers(1000)}"
        texts.append(" ".join(words))
    got = {r.doc_id: r.cluster_id for r in minhash.near_duplicates(frame(spark, texts)).collect()}
    assert got == brute_groups([(i + 1, t) for i, t in enumerate(texts)])


def test_signature_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 2**60, 400).astype(np.uint64)
    b = np.concatenate((a[:320], rng.integers(1, 2**60, 80).astype(np.uint64)))
    ids, doc = np.concatenate((a, b)), np.repeat([0, 1], 400)
    s = minhash.signatures(ids, doc, 2, size=2048)
    assert abs((s[0] == s[1]).mean() - 320 / 480) < 0.05
    halves = np.where(np.arange(800) < 400, 1.0, 0.5)
    s = minhash.signatures(ids, doc, 2, size=2048, part=halves)
    assert abs((s[0] == s[1]).mean() - 160 / (400 + 200 - 160)) < 0.05


def test_components(spark):
    from tidewatch.llm.graph import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# --- repeated passages


def test_repeated_passage_goes_and_clean_text_stays(spark):
    passage = prose(70, 11)
    a, b = f"{prose(90, 12)}\n{passage}\n{prose(80, 13)}", f"{prose(33, 14)} é {passage} {prose(41, 15)}"
    texts = [a, b, prose(200, 16), "short line", "short line", *ODD]
    df = frame(spark, texts)
    out = {r.doc_id: r for r in cdc.remove_repeats(df).collect()}
    assert len(out) == len(texts)
    assert [out[i].text for i in (1, 3, 4, 5)] == [a, texts[2], "short line", "short line"]
    assert out[2].n_removed >= 1 and out[2].removed_words >= 35 and passage not in out[2].text
    assert out[2].text.startswith(prose(33, 14)) and out[2].text.endswith(prose(41, 15))
    assert len(out[2].text.encode()) == len(b.encode()) - out[2].removed_bytes
    for i, t in enumerate(ODD):
        row = out[6 + i]
        assert row.text == t or row.n_removed
    assert set(df.columns) <= set(cdc.remove_repeats(df).columns)
    assert cdc.remove_repeats(df.limit(0)).count() == 0


def test_repeats_equal_brute_force(spark, docs):
    """The same rule over plain dictionaries: chunks, owners, runs."""
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    import pyarrow as pa

    from tidewatch.llm.common import text_slices

    chunks, seen = {}, {}
    for d, t in rows:
        for _, _, data, offsets in text_slices(pa.array([t])):
            raw = data.tobytes()
            _, edges = cdc.cuts(data, offsets)
            chunks[d] = [(x, y, raw[x:y]) for x, y in zip(edges[0], edges[0][1:])]
    for d, _ in rows:
        for place, (_, _, body) in enumerate(chunks.get(d, [])):
            seen.setdefault(body, (d, place))
    want = {}
    for d, t in rows:
        mine = chunks.get(d, [])
        counts = [len(WORD.findall(body.decode())) for _, _, body in mine]
        raw, keep, at, p = t.encode(), [], 0, 0
        while p < len(mine):
            q = p
            while q < len(mine) and seen[mine[q][2]] != (d, q):
                q += 1
            if sum(counts[p:q]) >= cdc.MIN_WORDS and sum(counts[max(p - 1, 0) : q + 1]) > cdc.PASSAGE:
                keep.append(raw[at : mine[p][0]])
                at = mine[q - 1][1]
            p = max(q, p + 1)
        want[d] = b"".join([*keep, raw[at:]]).decode()
    got = {r.doc_id: r.text for r in cdc.remove_repeats(docs.select("doc_id", "text")).collect()}
    assert got == want


def exact_spans(rows):
    """Every window of 51 words against a dictionary of all earlier ones."""
    seen, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        at = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
        gone = set()
        for i in range(len(at) - 50):
            home = seen.setdefault(raw[at[i][0] : at[i + 50][1]], (d, i))
            if home != (d, i):
                gone.update(range(max(i, home[1] + 51) if home[0] == d else i, i + 51))
        keep = bytearray(raw)
        for w in sorted(gone, reverse=True):
            del keep[at[w][0] : at[w + 1][0] if w + 1 < len(at) else at[w][1]]
        out[d] = (None if t is None else keep.decode(), len(gone))
    return out


def test_passages_of_51_words_go_and_of_50_stay(spark):
    texts, planted = [], []
    for i, n in enumerate([40, 50, 51, 60] * 40):
        passage = prose(n, 1000 + i)
        planted.append(n)
        texts += [f"{prose(60, 2000 + i)} {passage} {prose(30, 3000 + i)}", f"{prose(20, 4000 + i)} {passage} {prose(25, 5000 + i)}"]
    out = {r.doc_id: r for r in cdc.remove_passages(frame(spark, texts)).collect()}
    for i, n in enumerate(planted):
        first, second = out[2 * i + 1], out[2 * i + 2]
        assert first.text == texts[2 * i] and first.n_removed == 0
        assert (second.n_removed, second.removed_words) == ((1, n) if n > 50 else (0, 0))
        assert second.text == (f"{prose(20, 4000 + i)} {prose(25, 5000 + i)}" if n > 50 else texts[2 * i + 1])
        assert len(second.text.encode()) == len(texts[2 * i + 1].encode()) - second.removed_bytes


def test_passages_equal_brute_force(spark, docs):
    twice = prose(60, 21)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rows += [(10**6 + i, t) for i, t in enumerate([*ODD, f"{twice} é\n{twice}", f"x {twice}", prose(60, 21).replace(" ", "  ")])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.removed_words) for r in cdc.remove_passages(df).collect()}
    assert got == exact_spans(rows)
    assert {r.doc_id: r.text for r in QUERIES["op6_cdc_dedup"](spark, SF).collect()}.items() <= {d: t for d, (t, _) in got.items()}.items()
    assert cdc.remove_passages(df.limit(0)).count() == 0


def test_equal_windows_have_equal_chunks():
    """Whatever stands around a run of words, its windows get the same chunks, each inside its window."""
    run = prose(80, 31) + " a a a a a a a a a a a a a b a a a a a a a a a a a " + prose(60, 32)
    n = len(WORD.findall(run))
    found = []
    for before, after in ((prose(40, 33), prose(30, 34)), ("x", "y"), (prose(7, 35) + "  é", "")):
        raw = f"{before} {run} {after}".encode()
        starts, ends, first, _, chunk, begin = cdc.anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 51)
        skip = len(WORD.findall(before))
        found.append([(int(c), int(b) - skip) for c, b in zip(chunk[skip : skip + n - 50], begin[skip : skip + n - 50])])
    assert found[0] == found[1] == found[2] and len(found[0]) == n - 50
    assert all(i + cdc.MARGIN_WORDS <= b < i + 51 - cdc.CHUNK_WORDS for i, (_, b) in enumerate(found[0]))
    assert len({b for _, b in found[0]}) < n / 5
    for size in range(cdc.MARGIN_WORDS + 2, 80):
        shortest, head, tail = cdc.spans_of(size)
        assert min(shortest, head, tail) >= 1 and cdc.MARGIN_WORDS + head - 1 + shortest + tail - 1 <= size - 1
    with pytest.raises(ValueError):
        cdc.spans_of(9)


def test_passages_of_repeated_rows_and_null_ids(spark):
    text, other = prose(120, 41), prose(70, 42)
    rows = [(None, text), (5, text), (5, text), (7, f"{other} {text}"), (8, other), (9, other), (9, prose(30, 43)), (9, prose(30, 43)), (10, None), (10, "")]
    df = spark.createDataFrame([(*r, 3, "k", 1) for r in rows], "doc_id long, text string, key int, body string, removed_words int")
    got = sorted(((r.doc_id is not None, r.doc_id, r.text, r.n_removed) for r in cdc.remove_passages(df).collect()), key=str)
    want = [(None, text, 0), (5, "", 1), (5, "", 1), (7, f"{other} ", 1), (8, "", 1), (9, "", 1), (9, prose(30, 43), 0), (9, prose(30, 43), 0), (10, None, 0), (10, "", 0)]
    assert got == sorted(((d is not None, d, t, n) for d, t, n in want), key=str)
    assert all(r.key == 3 and r.body == "k" for r in cdc.remove_passages(df).collect())


def test_cuts_resist_shifts_and_cover_the_text():
    body = prose(2000, 3).encode()
    for text in (body, b"inserted words here " + body, b"\xc3\xa9" * 3000):
        data = np.frombuffer(text, np.uint8)
        _, edges = cdc.cuts(data, np.array([0, len(text)]))
        sizes = np.diff(edges[0])
        assert edges[0][0] == 0 and edges[0][-1] == len(text) and sizes.max() <= cdc.MAX_CHUNK and sizes[:-1].min() >= cdc.MIN_CHUNK - 2
        text[edges[0][1] :].decode()
    parts = lambda t: {t[a:b] for e in cdc.cuts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[1] for a, b in zip(e, e[1:])}
    assert len(parts(body) & parts(b"inserted words here " + body)) > 0.9 * len(parts(body))


# --- packing


def test_packing_is_whole(spark, docs):
    from tokenizers import Tokenizer

    path = vocabulary(packing.VOCABULARY)
    tokenizer = Tokenizer.from_file(path)
    extra = frame(spark, [*ODD, "a  b", "x <|endoftext|> y", "tab\t\n  z ", prose(5000, 4)], 10_000).select("doc_id", "text")
    both = docs.select("doc_id", "text").unionByName(extra)
    rows = packing.pack(both, path).collect()
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1] for r in both.collect()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(array("I", ids[r.doc_id][r.start : r.start + r.length]).tobytes())
    assert pieces.keys() == ids.keys()
    for d, found in pieces.items():
        found.sort(key=lambda r: r.start)
        assert [r.start for r in found] == list(np.concatenate(([0], np.cumsum([r.length for r in found])[:-1])))
        assert sum(r.length for r in found) == len(ids[d])
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.BUDGET
    assert packing.pack(docs.limit(0), path).count() == 0


def test_plan_holds_every_length_with_little_padding():
    rng = np.random.default_rng(2)
    histogram = dict(Counter(rng.integers(1, 2049, 50_000).tolist()) + Counter({7: 40_000, 2048: 9}))
    plan = packing.plan(histogram)
    back = Counter()
    for pattern, count in plan:
        assert sum(pattern) <= 2048 and count > 0
        for length in pattern:
            back[length] += count
    assert back == Counter(histogram)
    total = sum(k * v for k, v in histogram.items())
    assert total / (2048 * sum(c for _, c in plan)) > 0.97
    assert packing.plan({}) == [] and sum(c for _, c in packing.plan({1: 5000})) == 3


# --- quality rules


def brute_statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered),
    )


def test_base_counts_equal_brute_force(spark, docs):
    odd = [*ODD, "a b c a b c", "a a a a", "l\nl\n\n \nl", "#*$ %&|<> x", " lead\u000btab ", "\n".join(["x y"] * 50)]
    rows = docs.select("doc_id", "text").unionByName(frame(spark, odd, 10_000).select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in rules.judge(rows, []).collect():
        want = brute_statistics(texts[r.doc_id])
        assert tuple(r[1:6]) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)


def test_rules_learn_and_emit_an_ordered_expression(spark, docs, labels):
    learned = rules.fit(docs, labels)
    assert learned and all(t.feature in rules.FEATURES for r in learned for t in r)
    judged = rules.judge(docs, learned).join(labels, "doc_id").where("NOT base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in judged]) > 0.93
    assert rules.fit(docs, labels.limit(0)) == [] and rules.judge(docs.limit(0), learned).count() == 0
    x = np.zeros((60, len(rules.FEATURES)))
    x[:30, 2] = 1.0
    found = rules.learn(x, x[:, 2] > 0)
    assert found == [(rules.Test("symbol_rate", True, 0.5),)]
    plan = rules.judge(docs, learned)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- classifiers


def held(spark, name, label, threshold):
    rows = QUERIES[name](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in rows)
    return np.mean([r.predicted == r[label] for r in rows if r.held_out])


def test_quality_on_held_out_labels(spark):
    assert held(spark, "op2_quality_mil", "quality", quality.THRESHOLD) > 0.95


def test_toxicity_on_held_out_labels(spark):
    assert held(spark, "op5_toxicity_ssk", "toxic", toxicity.THRESHOLD) > 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_edges(spark, docs, labels, module):
    model = module.fit(docs, labels.union(labels))
    df = frame(spark, ODD)
    scored = module.score(df.union(df), model).collect()
    assert len(scored) == 2 * len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert {r.doc_id: r.score for r in scored} == {r.doc_id: r.score for r in module.score(df, model).collect()}
    assert module.score(df.limit(0), model).count() == 0
    assert module.fit(docs, labels.limit(0)) is None
    assert module.score(df, None).count() == len(ODD)


def test_attention_gradient_is_the_derivative():
    rng = np.random.default_rng(0)
    x, bag, y = rng.normal(size=(12, 5)), np.array([0] * 5 + [1] + [2] * 6), np.array([1.0, 0, 1])
    shapes = {"A": (5, quality.EMBED), "a": (quality.EMBED,), "V": (quality.EMBED, quality.GATE), "U": (quality.EMBED, quality.GATE), "w": (quality.GATE,), "c": (quality.EMBED,), "d": (1,)}
    w = {k: rng.normal(size=s) * 0.5 for k, s in shapes.items()}
    edges = quality._edges(bag)

    def loss():
        p = quality._forward(w, x, edges)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    grads = quality._gradient(w, x, edges, y)
    for k in w:
        flat, at = w[k].ravel(), rng.integers(w[k].size)
        old = flat[at]
        flat[at] = old + 1e-6
        high = loss()
        flat[at] = old - 1e-6
        low = loss()
        flat[at] = old
        assert abs((high - low) / 2e-6 - grads[k].ravel()[at]) < 1e-6


def test_kernel_tolerates_gaps_and_collapses_to_weights():
    def unit(word):
        symbols, starts, ends, _ = toxicity.units(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]))
        return symbols.tobytes()[starts[0] : ends[0]]

    names = [unit(w) for w in ("loser", "loxser", "l.o.s.e.r", "l0ser", "l o s e r", "winner")]
    rows, codes, values = toxicity.features(names)
    every, spot = np.unique(codes, return_inverse=True)
    basis = np.bincount(rows * len(every) + spot, values, len(names) * len(every)).reshape(len(names), -1)
    k = toxicity.kernel(names, every, basis)
    assert k[0, 2] == pytest.approx(k[0, 0]) and k[0, 3] == pytest.approx(k[0, 0])
    assert k[0, 1] > 5 * k[0, 5] and k[0, 4] > k[0, 5]
    weights = np.zeros(64**3, np.float32)
    weights[every] = basis[0]
    assert toxicity.unit_scores(*toxicity.stream(names), weights) == pytest.approx(k[:, 0], rel=1e-4)
