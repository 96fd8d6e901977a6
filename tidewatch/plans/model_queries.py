"""Registered feature, drift and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import drift, scoring
from tidewatch.operators.features import FEATURE_NAMES, fraud_label
from tidewatch.plans import views
from tidewatch.plans.metric_queries import LABEL_SQL
from tidewatch.plans.registry import query
from tidewatch.plans.samples import EVERY, SPLIT, feature_counts
from tidewatch.plans.series_queries import EXACT_SQL

NAMES = ", ".join(n for n in FEATURE_NAMES if n != "amount_deviation")


@query("fraud_features", f"SELECT transaction_id, {NAMES}, round(amount_deviation, 6) AS amount_deviation FROM ml_features")
def fraud_features(spark, sf_dir):
    """All nine features, engineered from the raw transactions."""
    rows = views.ml_features(spark, sf_dir).withColumn("amount_deviation", F.round("amount_deviation", 6))
    return rows.select("transaction_id", *FEATURE_NAMES)


@query("fraud_labels", f"SELECT transaction_id, {LABEL_SQL} AS label FROM ml_features")
def fraud_labels(spark, sf_dir):
    return views.ml_features(spark, sf_dir).select("transaction_id", fraud_label().alias("label"))


@query(
    "feature_vectors",
    "SELECT transaction_id, concat_ws(' ', "
    + ", ".join(f"printf('%.4f', CAST({n} AS DOUBLE))" for n in FEATURE_NAMES)
    + ") AS features FROM ml_features",
)
def feature_vectors(spark, sf_dir):
    """Assembled vectors, shown as text."""
    from pyspark.ml.functions import vector_to_array

    rows = scoring.assembler(keep_invalid=True).transform(scoring.numeric(views.ml_features(spark, sf_dir, exact=True)))
    shown = F.transform(vector_to_array("features_raw"), lambda x: F.format_string("%.4f", x))
    return rows.select("transaction_id", F.array_join(shown, " ").alias("features"))


SCALED_SQL = [f"CAST({n} AS DOUBLE)" for n in FEATURE_NAMES]


@query(
    "scaled_features",
    "SELECT transaction_id, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {n}_scaled" for n, c in zip(FEATURE_NAMES, SCALED_SQL))
    + " FROM ml_features",
)
def scaled_features(spark, sf_dir):
    """All nine features, standardised."""
    rows = scoring.standardised(scoring.numeric(views.ml_features(spark, sf_dir)), FEATURE_NAMES)
    return rows.select("transaction_id", *[F.round(f"{n}_scaled", 6).alias(f"{n}_scaled") for n in FEATURE_NAMES])


# Share of right decisions that the model must pass for either label.
ACCURACY_FLOOR = 0.5


def _ks_sql(week: str, by: str) -> str:
    union = " UNION ALL ".join(
        f"SELECT {week} AS part, '{n}' AS feature, {c} AS v, ts >= TIMESTAMP '{SPLIT}' AS cur FROM ml_features WHERE {n} IS NOT NULL" for n, c in EXACT_SQL.items()
    )
    return f"""WITH x AS ({union}),
c AS (SELECT feature, v, count(*) FILTER (WHERE NOT cur) AS a, count(*) FILTER (WHERE cur) AS b FROM x GROUP BY 1, 2),
f AS (SELECT feature, sum(a) OVER w / sum(a) OVER (PARTITION BY feature) AS fa, sum(b) OVER w / sum(b) OVER (PARTITION BY feature) AS fb,
  sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb FROM c WINDOW w AS (PARTITION BY feature ORDER BY v))
SELECT feature, CAST(na AS BIGINT) AS reference_rows, CAST(nb AS BIGINT) AS current_rows, round(max(abs(fa - fb)), 9) AS drift_score FROM f GROUP BY 1, 2, 3"""


@query("ks_drift", _ks_sql("0", "feature"))
def ks_drift(spark, sf_dir):
    """First half of the month as reference, second half as current rows."""
    scores = drift.ks_drift(feature_counts(spark, sf_dir), F.col("late"), rows=F.col("n"))
    return scores.withColumn("drift_score", F.round("drift_score", 9))


_DAILY = " UNION ALL ".join(f"SELECT '{n}' AS feature, ts, {c} AS v FROM ml_features WHERE {n} IS NOT NULL" for n, c in EXACT_SQL.items())


@query(
    "ks_drift_daily",
    f"""WITH f0 AS ({_DAILY}), r AS (SELECT feature, v FROM f0 WHERE ts < TIMESTAMP '{SPLIT}'),
d AS (SELECT feature, CAST(ts AS DATE) AS log_date, v FROM f0 WHERE ts >= TIMESTAMP '{SPLIT}'),
rc AS (SELECT feature, v, count(*) AS a FROM r GROUP BY 1, 2),
x AS (SELECT feature, log_date, v, 0 AS a, count(*) AS b FROM d GROUP BY 1, 2, 3
  UNION ALL SELECT feature, log_date, rc.v, rc.a, 0 FROM rc JOIN (SELECT DISTINCT feature, log_date FROM d) dd USING (feature)),
c AS (SELECT feature, log_date, v, sum(a) AS a, sum(b) AS b FROM x GROUP BY 1, 2, 3),
f AS (SELECT feature, log_date, sum(a) OVER w / sum(a) OVER g AS fa, sum(b) OVER w / sum(b) OVER g AS fb FROM c
  WINDOW w AS (PARTITION BY feature, log_date ORDER BY v), g AS (PARTITION BY feature, log_date))
SELECT feature, log_date, round(max(abs(fa - fb)), 9) AS drift_score FROM f GROUP BY 1, 2""",
)
def ks_drift_daily(spark, sf_dir):
    """Every day of the second half against the whole first half, for all nine features."""
    day = F.timestamp_micros(F.col("scrape_us") - EVERY).cast("date")
    counts, n = feature_counts(spark, sf_dir).withColumn("log_date", day), F.col("n")
    scores = drift.ks_windows(counts.where("NOT late"), counts.where("late"), "log_date", ["feature"], n, n)
    return scores.select("feature", "log_date", F.round("drift_score", 9).alias("drift_score"))


@query(
    "fraud_scoring",
    f"""SELECT {LABEL_SQL} AS label, count(*) AS scored, TRUE AS confidence_in_range, TRUE AS decision_by_probability, 9 AS features_used, TRUE AS accurate,
  count(*) FILTER (WHERE amount_deviation IS NULL OR isnan(amount_deviation)) AS without_score
FROM ml_features WHERE ts >= TIMESTAMP '{SPLIT}' GROUP BY 1""",
)
def fraud_scoring(spark, sf_dir):
    """Train on the first half of the month, score every row of the second half; properties of the scores per label."""
    rows = views.ml_features(spark, sf_dir).withColumn("label", fraud_label())
    split = F.lit(SPLIT).cast("timestamp_ntz")
    model = scoring.train(rows.where(F.col("ts") < split))
    scored = scoring.score(model, rows.where(F.col("ts") >= split).select("label", *FEATURE_NAMES))
    # Rounding to four digits leaves the unrounded decision open at the threshold itself.
    agrees = F.when(F.abs(F.col("fraud_probability") - 0.5) < 1e-4, True).otherwise(F.col("is_fraud") == (F.col("fraud_probability") > 0.5))
    right = F.col("is_fraud") == F.col("label")
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("scored"),
        F.every(F.coalesce(F.col("confidence").between(0.5, 1.0), F.lit(True))).alias("confidence_in_range"),
        F.every(F.coalesce(agrees, F.lit(True))).alias("decision_by_probability"),
        F.max("features_used").alias("features_used"),
        (F.avg(F.when(right, 1.0).otherwise(F.when(right.isNotNull(), 0.0))) > ACCURACY_FLOOR).alias("accurate"),
        F.count_if(F.col("reason").isNotNull()).alias("without_score"),
    )
