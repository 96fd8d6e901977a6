"""Hot-key-safe scans, joins and percentiles against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewatch.functions import scan
from tidewatch.functions.quantiles import exact_percentiles
from tidewatch.functions.skew import salted_join
from tidewatch.operators.features import amount_deviation, trailing_count
from tidewatch.operators.metrics import histogram, rolling_accuracy, word_count


def make(n=400, seed=1):
    """A third or more of the rows share one key; one key is NULL."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        out.append((i, key, rnd.randrange(0, 3000), rnd.choice([None, rnd.randrange(-5, 20)])))
    return out


@pytest.mark.parametrize("width", [7, 500, 10**6])
def test_running(spark, width):
    data = make()
    df = spark.createDataFrame(data, "id INT, key STRING, us BIGINT, v INT")
    got = scan.running(
        df,
        ["key"],
        ["us", "id"],
        scan.time_block("us", width),
        {
            "total": scan.Running("sum", F.col("v")),
            "before": scan.Running("sum", F.col("v"), inclusive=False),
            "top": scan.Running("max", F.col("v")),
            "last": scan.Running("last", F.col("v"), inclusive=False),
            "ahead": scan.Running("next", F.col("us")),
            "n": scan.Running("sum", F.lit(1)),
        },
    )
    want = []
    for key in {r[1] for r in data}:
        seen = []
        ordered = sorted((r for r in data if r[1] == key), key=lambda r: (r[2], r[0]))
        for i, r in enumerate(ordered):
            held = [x for x in seen if x is not None]
            now = held + ([r[3]] if r[3] is not None else [])
            want.append(
                (r[0], sum(now), sum(held), max(now) if now else None, held[-1] if held else None,
                 ordered[i + 1][2] if i + 1 < len(ordered) else None, i + 1)
            )
            seen.append(r[3])
    assert rows(got, "id", "total", "before", "top", "last", "ahead", "n") == sorted(want)


@pytest.mark.parametrize("width", [3, 50, 10**6])
def test_islands(spark, width):
    points = sorted(random.Random(3).sample(range(200), 90))
    df = spark.createDataFrame([("x", p, float(p)) for p in points], "key STRING, us BIGINT, v DOUBLE")
    got = scan.islands(df, ["key"], "us", F.lit(2), width, ["v"])
    want, start = [], points[0]
    for a, b in zip(points, [*points[1:], 10**9]):
        if b - a > 2:
            want.append((start, a, len([p for p in points if start <= p <= a]), float(start), float(a)))
            start = b
    assert rows(got, "start_us", "end_us", "points", "first_v", "last_v") == sorted(want)


def test_value_bin_is_monotone(spark):
    values = [-1e300, -5.0, -1.0, -1e-320, 0.0, 1e-320, 1e-9, 0.5, 0.50001, 1.0, 7.0, 1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select("v", scan.value_bin("v").alias("b")).orderBy("v")
    bins = [r.b for r in df.collect()]
    assert bins == sorted(bins)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_percentiles(spark, seed):
    rnd = random.Random(seed)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([None, rnd.gauss(0, 50), float(rnd.randrange(3))])) for _ in range(500)]
    df = spark.createDataFrame([*data, ("one", 4.0)], "g STRING, v DOUBLE")
    probs = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p999": 0.999, "p100": 1.0}
    got = exact_percentiles(df, ["g"], "v", probs)
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
    for a, b in zip(rows(got, "g", *probs), rows(want, "g", *probs)):
        assert a[0] == b[0]
        assert a[1:] == pytest.approx(b[1:], abs=1e-12)


def test_salted_join_keeps_every_row(spark):
    facts = spark.createDataFrame([(i, None if i % 10 == 7 else "hot" if i % 3 else f"k{i}") for i in range(300)], "id INT, k STRING")
    dim = spark.createDataFrame([("hot", 1), ("k3", 2), ("k6", 3)], "k STRING, v INT")
    for share in (1e-4, 0.01, 0.5):
        got = salted_join(facts, dim, ["k"], ["id"], share=share)
        assert rows(got, "id", "k", "v") == rows(facts.join(dim, "k", "left"), "id", "k", "v")


def test_trailing_count(spark):
    rnd = random.Random(5)
    data = [(i, rnd.choice(["u", "u", "v"]), rnd.randrange(0, 400)) for i in range(200)]
    df = spark.createDataFrame(data, "id INT, k STRING, us BIGINT")
    for block in (1, 60, 10**6):
        got = trailing_count(df, "k", "us", ["id"], 50, "n", block)
        want = [(i, sum(1 for _, k2, t2 in data if k2 == k and t - 50 <= t2 <= t)) for i, k, t in data]
        assert rows(got, "id", "n") == sorted(want)


@pytest.mark.parametrize("block_rows", [5, 12, 1000])
def test_rolling_accuracy(spark, block_rows):
    rnd = random.Random(7)
    data = [(i, "m" if i % 4 else "n", i * 10, rnd.random() < 0.7) for i in range(120)]
    df = spark.createDataFrame(data, "id INT, m STRING, us BIGINT, hit BOOLEAN")
    got = rolling_accuracy(df, ["m"], "us", ["id"], F.col("hit"), 5, 100, block_rows)
    want = []
    for m in ("m", "n"):
        hits = []
        for i, name, _, hit in data:
            if name == m:
                hits.append(hit)
                want.append((i, pytest.approx(sum(hits[-5:]) / len(hits[-5:]))))
    assert rows(got, "id", "rolling_accuracy") == sorted(want, key=lambda r: r[0])


def test_histogram_counts_bounds_inclusively(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.5), ("a", 70.0), ("a", None)], "k STRING, v DOUBLE")
    got = histogram(df, ["k"], "v", [0.1, 0.5, 1.0])
    assert rows(got, "le", "bucket", "count") == [(0.1, 1, 3), (0.5, 2, 3), (1.0, 2, 3), (float("inf"), 3, 3)]


def test_word_count_splits_like_python(spark):
    texts = ["", "  a b\tc\n", "one", "a b　c", "x\x1cy", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING").select("i", word_count("t").alias("n"))
    assert rows(df) == [(i, len((t or "").split())) for i, t in enumerate(texts)]


def test_deviation_from_an_equal_mean_follows_the_order_only(spark):
    """0.1 + 0.2 + 0.3 ends above 0.6 and 0.3 + 0.2 + 0.1 at it: the sign of the zero is that of the summing order, however the rows are dealt."""
    for n, values in enumerate([[0.1, 0.2, 0.3], [0.3, 0.2, 0.1]]):
        total = 0.0
        for v in values:
            total += v
        want = 0.2 - total / 3
        assert want != 0
        table = [("a", i, v) for i, v in enumerate(values)] + [("b", i, float(i * i)) for i in range(4)]
        for parts in (1, 2, 5):
            df = spark.createDataFrame(table, "u STRING, us BIGINT, v DOUBLE").repartition(parts, F.col("us") * 7)
            out = amount_deviation(df, "u", "v", ["us"], "d", order=["us"])
            assert out.count() == 7
            got = out.where("u = 'a' AND v = 0.2").first().d
            assert (got < 0) == (want < 0) and abs(got) < 1e-12
            assert out.where("u = 'b' AND v = 9").first().d == pytest.approx(5.5 / 4.041451884327381)
