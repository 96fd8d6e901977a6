"""Fraud model: assembly, scaling, training and scoring with MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.features import FEATURE_NAMES

# Number of trees and seed of the model, decision threshold.
TREES = 50
SEED = 42
FRAUD_THRESHOLD = 0.5
MODEL_VERSION = "v2.1.0"


def numeric(df: DataFrame, features: Sequence[str] = tuple(FEATURE_NAMES)) -> DataFrame:
    """Feature columns as doubles, booleans as 0 and 1."""
    return df.withColumns({f: F.col(f).cast("double") for f in features})


def assembler(features: Sequence[str] = tuple(FEATURE_NAMES), keep_invalid: bool = False) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="keep" if keep_invalid else "skip")


def standardised(df: DataFrame, features: Sequence[str], population: bool = True) -> DataFrame:
    """Features minus mean over deviation, as plain columns, in one aggregation.

    ``population`` uses the deviation with divisor n. A constant feature is only
    centred. The statistics are one row.
    """
    deviation = F.stddev_pop if population else F.stddev_samp
    stats = df.agg(
        F.struct(*[F.struct(F.avg(f).alias("mean"), deviation(f).alias("std")).alias(f) for f in features]).alias("s")
    ).scalar()
    with_stats = df.withColumn("_s", stats)
    scale = lambda f: F.coalesce(F.nullif(F.col(f"_s.{f}.std"), F.lit(0.0)), F.lit(1.0))
    return with_stats.withColumns({f"{f}_scaled": (F.col(f) - F.col(f"_s.{f}.mean")) / scale(f) for f in features}).drop("_s")


def train(df: DataFrame, label: str = "label", features: Sequence[str] = tuple(FEATURE_NAMES), trees: int = TREES, seed: int = SEED) -> PipelineModel:
    """Assemble, scale and fit a random forest. A row that lacks a feature teaches nothing and is left out of the fit; ``score`` returns it all the same."""
    stages = [
        assembler(features),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed),
    ]
    return Pipeline(stages=stages).fit(numeric(df, features).withColumn(label, F.col(label).cast("double")))


def accuracy(model: PipelineModel, df: DataFrame, label: str = "label") -> float:
    scored = model.transform(numeric(df).withColumn(label, F.col(label).cast("double")))
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(scored)


def decision(probability: Column) -> dict[str, Column]:
    """Result columns from the probability of fraud; the decision uses the
    unrounded value."""
    return {
        "is_fraud": probability > FRAUD_THRESHOLD,
        "fraud_probability": F.round(probability, 4),
        "confidence": F.round(F.greatest(probability, 1 - probability), 4),
    }


def score(model: PipelineModel, df: DataFrame, version: str = MODEL_VERSION, features: Sequence[str] = tuple(FEATURE_NAMES)) -> DataFrame:
    """Scores for a batch or a stream, one for every row. Input columns are kept.

    A row that lacks a feature (NULL or NaN) has no score: decision, probability
    and confidence are NULL and ``reason`` names what is missing.
    """
    keep = [c for c in df.columns]
    absent = lambda f: F.col(f).isNull() | F.isnan(F.col(f).cast("double"))
    names = F.concat_ws(", ", *[F.when(absent(f), F.lit(f)) for f in features])
    rows = df.select(F.struct(*keep).alias("_in"), F.when(names != "", F.concat(F.lit("missing: "), names)).alias("reason"), *features)
    assembled = PipelineModel([assembler(features, keep_invalid=True), *model.stages[1:]])
    scored = assembled.transform(numeric(rows, features))
    probability = F.when(F.col("reason").isNull(), vector_to_array("probability")[1])
    return scored.select(
        *[F.col("_in").getField(c).alias(c) for c in keep],
        *[c.alias(n) for n, c in decision(probability).items()],
        F.lit(version).alias("model_version"),
        F.lit(len(features)).alias("features_used"),
        "reason",
    )
