"""Whitening against a dense eigensolver, and the parts of the contour method one by one."""

import math

import numpy as np
import pytest

from tidewatch.llm import whiten
from tidewatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RNG = np.random.default_rng(5)


def spectrum(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


MATRICES = {
    "spread": spectrum(np.geomspace(1, 1e6, 40)),
    "close": spectrum(100 + 1e-3 * np.arange(64)),
    "equal": spectrum([5.0] * 20 + [3.0] * 20 + [1.0] * 4),
    "one": spectrum([9.0] + [1.0] * 30),
    "rank3": spectrum([7, 5, 2] + [0] * 20),
    "diagonal": np.diag(np.arange(1.0, 33.0)),
    "tiny": np.array([[4.0]]),
    "covariance": np.cov(RNG.standard_normal((500, 64)).T * 36, bias=True),
}


@pytest.mark.parametrize("name", sorted(MATRICES))
def test_leading_equals_a_dense_solver(name):
    m = MATRICES[name]
    want = np.linalg.eigvalsh((m + m.T) / 2)[::-1]
    want = want[want > 1e-9 * want[0]][:16]
    values, vectors = whiten.leading((m + m.T) / 2, 16)
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-12
    assert np.abs(m @ vectors - vectors * values).max() < 1e-11 * want[0]


@pytest.mark.parametrize("name", sorted(MATRICES))
def test_inertia_counts_eigenvalues(name):
    m = (MATRICES[name] + MATRICES[name].T) / 2
    values = np.linalg.eigvalsh(m)
    for t in np.linspace(values[0] - 1.37, values[-1] + 1.01, 23):
        if np.abs(values - t).min() > 1e-9 * max(1, values[-1]):
            assert whiten.inertia(m, t) == (values > t).sum()
    if len(m) > 2:
        indefinite = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, 0]])
        assert whiten.inertia(indefinite, 0.0) == 1


def test_intervals_hold_what_is_wanted():
    m = MATRICES["covariance"]
    values = np.linalg.eigvalsh(m)
    parts = whiten.intervals(m, 16)
    assert len(parts) > 1 and sum(c for _, _, c in parts) >= 16
    for low, high, count in parts:
        assert count == ((values > low) & (values <= high)).sum() <= whiten.PER_INTERVAL
    assert max(h for _, h, _ in parts) >= values[-1]


def test_contour_keeps_the_interval_and_damps_the_rest():
    m = np.diag(np.arange(1.0, 33.0))
    out = np.diag(whiten.contour(m, np.eye(32), 9.5, 14.5))
    assert np.abs(out[9:14] - 1).max() < 0.1 and np.abs(np.delete(out, range(8, 15))).max() < 0.01


def brute(rows, components=16):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-9 * values.max()]
    out = {}
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums.tolist()))
        w = (np.array(x) - sums / n) @ vectors[:, order] / np.sqrt(values[order])
        out.setdefault(i, []).append((deviation, w))
    return n, out, values[order] / values.sum()


def held(got, rows):
    n, want, explained = brute(rows)
    by_row = {}
    for r in got:
        assert r.n == n and 0 <= r.identity_error <= 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        by_row.setdefault((r.vec_id, r.component), []).append(r)
    assert sum(map(len, by_row.values())) == len(explained) * sum(map(len, want.values()))
    signs = {}
    for (i, k), found in by_row.items():
        assert len(found) == len(want[i])
        for r, (deviation, w) in zip(sorted(found, key=lambda r: r.deviation), sorted(want[i], key=lambda p: p[0])):
            assert r.deviation == deviation
            if abs(w[k - 1]) > 1e-6:
                signs.setdefault(k, set()).add(round(r.whitened / w[k - 1], 6))
    # Either sign, the same for all rows.
    assert all(s in ({1.0}, {-1.0}) for s in signs.values())


def test_query_equals_a_dense_solver(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    held(QUERIES["op13_whitening"](spark, SF).collect(), rows)


def test_odd_vectors(spark):
    good = [(i, RNG.standard_normal(5).tolist()) for i in range(40)]
    good += [(3, good[3][1]), (99, good[3][1]), (None, good[4][1])]
    bad = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0]), (202, [float("nan")] * 5), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (204, [1.0]), (205, []), (206, [1e300] * 5)]
    df = spark.createDataFrame([(i, v, 1, [2]) for i, v in good + bad], "vec_id long, embedding array<double>, n int, x array<int>")
    n, want, _ = brute([(i, np.array(v)) for i, v in good if i is not None])
    got = whiten.whiten(df).collect()
    assert {r.vec_id for r in got} == {i for i, _ in good} and {r.n for r in got} == {40}
    assert len(got) == 5 * len(good) and {r.component for r in got} == {1, 2, 3, 4, 5}
    again = [r for r in got if r.vec_id in (3, 99)]
    assert len(again) == 15 and len({(r.component, r.whitened, r.deviation) for r in again}) == 5
    assert whiten.whiten(df.limit(0)).count() == 0
    assert whiten.whiten(df.where("vec_id in (3, 99)")).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(9)], "vec_id long, embedding array<double>")
    got = whiten.whiten(flat).collect()
    assert {r.component for r in got} == {1} and len(got) == 9 and abs(got[0].explained - 1) < 1e-12


def test_deviation_beyond_64_bits():
    model = whiten.Whitening(4_000_000_000, np.array([4_000_000_000 * 1_000_000]), np.ones(1), np.eye(1), np.ones(1), 0.0)
    x = np.array([[1_000_000 + 5], [2**52]])
    assert model.deviations(x).tolist() == [[20_000_000_000], [4_000_000_000 * (2**52 - 1_000_000)]]
