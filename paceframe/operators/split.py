"""Train/test splits, folds and samples that do not depend on row layout."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import unit_hash
from .scan import hash_rank


def split_hash(df: DataFrame, key: str, test_share: float = 0.2, seed: int | str = 42, name: str = "split") -> DataFrame:
    """Random split by a seeded digest of the row key: no shuffle, stable under repartitioning."""
    return df.withColumn(name, F.when(unit_hash(key, seed) < test_share, "test").otherwise("train"))


def split_exact(df: DataFrame, key: str, test_share: float = 0.2, seed: int | str = 42, name: str = "split") -> DataFrame:
    """As ``split_hash`` with exactly ceil(share * n) test rows."""
    wanted = math.ceil(test_share * df.count())
    ranked = hash_rank(df, key, seed, name="__rank")
    return ranked.withColumn(name, F.when(F.col("__rank") <= wanted, "test").otherwise("train")).drop("__rank")


def split_temporal(df: DataFrame, date: str, cut: str, name: str = "split") -> DataFrame:
    """Rows before the cut train, rows from it on test; rows without a date are in neither."""
    moment = F.lit(cut).cast("timestamp")
    when = F.col(date).cast("timestamp")
    return df.withColumn(name, F.when(when < moment, "train").when(when >= moment, "test"))


def hash_folds(df: DataFrame, key: str, folds: int = 5, seed: int | str = 42, name: str = "fold") -> DataFrame:
    """Folds by a digest of their own: with the one of ``split_hash`` a test part would be whole folds."""
    return df.withColumn(name, F.floor(unit_hash(key, f"{seed}-fold") * folds).cast("int"))


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = 5, seed: int | str = 42, name: str = "fold"
) -> DataFrame:
    """Folds whose class counts differ by at most one."""
    ranked = hash_rank(df, key, seed, by=[label], name="__rank")
    return ranked.withColumn(name, ((F.col("__rank") - 1) % folds).cast("int")).drop("__rank")


def sample_share(df: DataFrame, key: str, share: float, seed: int | str = 42) -> DataFrame:
    """Exactly ceil(share * n) rows by digest order, without a global sort."""
    wanted = math.ceil(share * df.count())
    return hash_rank(df, key, seed, name="__rank").where(F.col("__rank") <= wanted).drop("__rank")


def nested_subsets(
    df: DataFrame, key: str, steps: int = 10, folds: int = 5, seed: int | str = 42
) -> DataFrame:
    """Fold and the smallest learning-curve step (1..steps) that contains the row."""
    folded = hash_folds(df, key, folds, seed)
    return folded.withColumn("step", (F.floor(unit_hash(key, f"{seed}-curve") * steps) + 1).cast("int"))


def learning_curve_sizes(df: DataFrame, key: str, steps: int = 10, folds: int = 5, seed: int | str = 42) -> DataFrame:
    """Training rows of every (fold, step): rows outside the fold up to the step.

    Rows are counted once per (fold, step) cell; the nesting is then summed over
    the folds x steps cells only.
    """
    cells = nested_subsets(df, key, steps, folds, seed).groupBy("fold", "step").agg(F.count(F.lit(1)).alias("n"))
    targets = F.explode(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda f: f != F.col("fold")))
    grown = F.explode(F.sequence(F.col("step"), F.lit(steps)))
    spread = cells.select("step", "n", targets.alias("held_out")).select(
        "held_out", "n", grown.alias("curve_step")
    )
    return spread.groupBy("held_out", "curve_step").agg(F.sum("n").alias("train_rows"))


def labelled(df: DataFrame, split: str, part: str, drop: Sequence[str] = ()) -> DataFrame:
    """One part of a split without the columns that must not reach a model."""
    return df.where(F.col(split) == part).drop(split, *drop)
