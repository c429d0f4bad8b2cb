"""Batch scoring: the fitted feature steps and a model over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamped_interval
from ..operators import clean, features
from .regression import Encoders

# Error assumed when no metrics are known, and inputs assumed when left out.
DEFAULT_MAE = 2.5
DEFAULT_INPUTS = {
    "round": 1, "driver_points": 0.0, "team_points": 0.0, "driver_rank": 10, "team_rank": 5, "team_wins": 0,
    "name": "Unknown Circuit", "location": "Unknown", "country": "Unknown", "lat": 0.0, "lng": 0.0, "alt": 0.0,
    "driver_wins": 0,
}


def linear_prediction(weights: Mapping[str, float], intercept: float) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in weights.items()], F.lit(intercept))


def prepare_inputs(df: DataFrame, fitted: Encoders, keep: Sequence[str], fill: Mapping[str, object] | None = None) -> DataFrame:
    """Defaults, interactions, encoders, alignment and scaling, as in training."""
    df = clean.with_defaults(df, {"grid": "quali_position", "quali_position": "grid"}, fill or DEFAULT_INPUTS)
    return fitted.transform(features.advanced_features(df), tuple(keep))


def with_interval(df: DataFrame, pred: str = "pred", mae: float = DEFAULT_MAE) -> DataFrame:
    low, high = clamped_interval(F.col(pred), mae)
    return df.withColumns({"rounded": F.bround(F.col(pred), 0).cast("bigint"), "low": low, "high": high})


def score_linear(
    df: DataFrame, fitted: Encoders, weights: Mapping[str, float], intercept: float, keep: Sequence[str],
    mae: float = DEFAULT_MAE,
) -> DataFrame:
    """Scores from plain weights: column arithmetic only."""
    ready = prepare_inputs(df, fitted, keep).withColumn("pred", linear_prediction(weights, intercept))
    return with_interval(ready.select(*keep, "pred"), "pred", mae)


def score_model(df: DataFrame, fitted: Encoders, model: Model, keep: Sequence[str], mae: float = DEFAULT_MAE) -> DataFrame:
    """Scores from a fitted Spark ML model."""
    ready = prepare_inputs(df, fitted, keep)
    packed = VectorAssembler(inputCols=fitted.columns, outputCol="features").transform(ready)
    scored = model.transform(packed).select(*keep, F.col("prediction").alias("pred"))
    return with_interval(scored, "pred", mae)


def with_scenarios(df: DataFrame, scenarios: Mapping[str, Mapping[str, Column]], name: str = "scenario") -> DataFrame:
    """Every row once per scenario, with that scenario's changed inputs."""
    changed = {c for s in scenarios.values() for c in s}
    options = F.array(*[
        F.struct(F.lit(n).alias("n"), *[
            s.get(c, F.col(c)).cast(df.schema[c].dataType).alias(c) for c in sorted(changed)
        ]) for n, s in scenarios.items()
    ])
    rest = [c for c in df.columns if c not in changed]
    return df.select(*rest, F.explode(options).alias("__s")).select(
        *rest, F.col("__s.n").alias(name), *[F.col(f"__s.{c}").alias(c) for c in sorted(changed)]
    )
