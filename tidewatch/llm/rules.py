"""Quality rules learned as a decision list over text statistics.

Statistics, joins and verdicts are DataFrame expressions. The learner sees a
bounded sample of labelled statistics: it grows a conjunction of thresholds by
information gain on one part, prunes it on the other, removes what it covers
and starts again (sequential covering). What it emits is an ordered Spark
conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_sample

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
FEATURES = (
    "n_words", "mean_word", "symbol_rate", "dup_line_share", "repeat_share", "upper_share", "exclaim_rate",
    "distinct_share", "digit_share",
)
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Labelled rows of each class that the rules are learned from.
SAMPLE_PER_CLASS = 2000
MIN_PRECISION = 0.9
MIN_COVER = 3


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.threshold) if self.above else c <= F.lit(self.threshold)

    def mask(self, x: np.ndarray) -> np.ndarray:
        v = x[:, FEATURES.index(self.feature)]
        return v >= self.threshold if self.above else v <= self.threshold


Rule = tuple[Test, ...]


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, the base counts and the features of every text.

    A null text counts as empty; an empty text has zeros everywhere. Each array
    is a column of its own before it is used twice, so it is built once a row.
    Windows of three words are told apart by a 64-bit hash inside one text.
    """
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    kept_chars = lambda c, chars: F.length(F.regexp_replace(c, f"[^{chars}]+", "")).cast("long")
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.select(
        *keep,
        F.expr(rf"regexp_extract_all(_t, r'{WORD}', 0)").alias("_w"),
        F.regexp_replace("_t", f"[^A-Z0-9!{SYMBOLS}]+", "").alias("_marks"),
        F.filter(F.split("_t", "\n", -1), lambda line: line.rlike(WORD)).alias("_lines"),
    )
    rows = rows.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        kept_chars("_marks", SYMBOLS).alias("n_symbols"),
        kept_chars("_marks", "A-Z").alias("_upper"),
        kept_chars("_marks", "!").alias("_exclaim"),
        kept_chars("_marks", "0-9").alias("_digits"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("_w")).cast("long").alias("_distinct"),
        F.expr(
            "CASE WHEN size(_w) < 3 THEN array() ELSE sort_array(transform(sequence(1, size(_w) - 2), i -> "
            "struct(xxhash64(element_at(_w, i), element_at(_w, i + 1), element_at(_w, i + 2)) AS h, i AS i))) END"
        ).alias("_windows"),
    )
    twice = (
        "filter(_windows, (x, k) -> x.h <=> get(_windows, k - 1).h OR x.h <=> get(_windows, k + 1).h)"
    )
    rows = rows.select(
        *[c for c in rows.columns if c != "_windows"],
        F.expr(f"transform({twice}, x -> x.i)").alias("_twice"),
    ).withColumn(
        "n_repeat_words",
        F.expr("size(array_distinct(flatten(transform(_twice, i -> array(i, i + 1, i + 2)))))").cast("long"),
    )
    return rows.select(
        *keep, *BASE,
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "n_words").alias("symbol_rate"),
        share("n_dup_lines", "_n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("_upper", "word_chars").alias("upper_share"),
        share("_exclaim", "n_words").alias("exclaim_rate"),
        share("_distinct", "n_words").alias("distinct_share"),
        share("_digits", "word_chars").alias("digit_share"),
    )


def learn(x: np.ndarray, bad: np.ndarray, seed: int = 7) -> list[Rule]:
    """Rules whose rows are rejected, in order. Few or one-sided labels give no rule."""
    order = np.random.default_rng(seed).permutation(len(bad))
    third = len(bad) // 3
    prune, grow = order[:third], order[third:]
    rules: list[Rule] = []
    while True:
        gx, gy = x[grow], bad[grow]
        if gy.sum() < MIN_COVER or gy.all():
            return rules
        rule = _pruned(_grown(gx, gy), x[prune], bad[prune])
        if not rule:
            return rules
        hit = _covers(rule, x)
        if hit[grow].sum() < MIN_COVER or bad[hit].mean() < MIN_PRECISION:
            return rules
        rules.append(rule)
        grow, prune = grow[~hit[grow]], prune[~hit[prune]]


def _covers(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test in rule:
        out &= test.mask(x)
    return out


def _grown(x: np.ndarray, y: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(y), bool)
    while not y[inside].all():
        best = _best_test(x[inside], y[inside])
        if best is None:
            break
        rule += (best,)
        inside &= best.mask(x)
    return rule


def _best_test(x: np.ndarray, y: np.ndarray) -> Test | None:
    """The threshold with the largest gain; it lies midway between two values."""
    base = math.log2(max(y.mean(), 1e-9))
    best, found = 1e-9, None
    for j, name in enumerate(FEATURES):
        order = np.argsort(x[:, j], kind="stable")
        v, hits = x[order, j], y[order]
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        low_p, low_n = np.cumsum(hits)[cuts], cuts + 1
        for above in (False, True):
            p = hits.sum() - low_p if above else low_p
            n = len(y) - low_n if above else low_n
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - base), -1.0)
            at = int(np.argmax(gain))
            if gain[at] > best:
                best, found = gain[at], Test(name, above, float((v[cuts[at]] + v[cuts[at] + 1]) / 2))
    return found


def _pruned(rule: Rule, x: np.ndarray, y: np.ndarray) -> Rule:
    """The shortest head of the rule with the best (right - wrong) / covered on unseen rows."""

    def worth(r: Rule) -> float:
        hit = _covers(r, x)
        return (2 * y[hit].sum() - hit.sum()) / hit.sum() if hit.any() else -1.0

    heads = [rule[:k] for k in range(1, len(rule) + 1)]
    return max(heads, key=lambda r: (worth(r), -len(r))) if heads else ()


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, text: str = "text") -> list[Rule]:
    """Learn from a bounded sample of ``labels.quality`` outside the held-out fold."""
    sample = bounded_sample(labels, "quality", per_class)
    # At most 2 * per_class rows.
    chosen = docs.select("doc_id", text).join(F.broadcast(sample), "doc_id")
    rows = statistics(chosen, text, ("doc_id", "y")).select("doc_id", "y", *FEATURES).orderBy("doc_id", *FEATURES).collect()
    if not rows:
        return []
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    return learn(x, np.array([r["y"] == 0 for r in rows]))


def verdict(rules: list[Rule]) -> Column:
    """True where no rule fires; the rules are tried in order."""
    found = None
    for rule in rules:
        when = rule[0].column()
        for test in rule[1:]:
            when = when & test.column()
        found = F.when(when, F.lit(False)) if found is None else found.when(when, F.lit(False))
    return F.lit(True) if found is None else found.otherwise(F.lit(True))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the base counts, ``base_failed`` and ``kept`` of every row, repeated rows included.

    Null and empty texts have no word and fail the base. Ties at a threshold go
    to the rule's side. Other columns of ``docs`` are not read, so their names
    cannot clash.
    """
    # Always true, but not foldable and not deterministic for the optimizer: a filter on the verdict stays
    # above the projections that build the arrays instead of building them again for each comparison.
    here = F.spark_partition_id() >= 0
    rows = statistics(docs, text, keep)
    return rows.select(*keep, *BASE, (base_failed() & here).alias("base_failed"), (~base_failed() & verdict(rules) & here).alias("kept"))
