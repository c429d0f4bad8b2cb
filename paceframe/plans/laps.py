"""Lap-time flow: assembly, cleaning, outlier filter, features, label codes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators import clean, encode, features, impute, joins, profile
from ..operators.quantiles import medians
from ..session import materialise

ROWS_PER_TASK = 250_000  # that are compared with each other in one task
CODED = ("lap_group", "grid_group", "altitude_cat", "team_circuit_id", "year_group")


def distinct_rows(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distinct rows of a written table, over as many tasks as its rows need.

    Rows meet by their columns other than floating-point ones, whose equal values can differ in bits.
    """
    by = [c for c, t in df.dtypes if t not in ("float", "double")]
    tasks = math.ceil(df.count() / rows_per_task)
    return df.repartition(tasks, *by).dropDuplicates() if by and tasks > 1 else df.dropDuplicates()


def clean_laps(df: DataFrame, target: str = "milliseconds", keep_text: Sequence[str] = ()) -> DataFrame:
    """Distinct rows with a target, medians for numbers, 'Unknown' for text, no 3-IQR outliers."""
    df = materialise(distinct_rows(materialise(clean.keep_present(df, target))))
    numbers = [c for c in clean.numeric_columns(df) if c != target]
    df = impute.fill_median(df, numbers, medians(df, numbers))
    return profile.drop_outliers_iqr(impute.fill_unknown(df), target)


def prepare(tables: Mapping[str, DataFrame], target: str = "milliseconds") -> DataFrame:
    """Model-ready lap rows: candidate features with coded categories, and the target."""
    df = joins.assemble_laps(tables["laps"], tables["results"], tables["calendar"], tables["circuits"])
    df = materialise(features.lap_features(clean_laps(df, target)))
    for c in CODED:
        df = encode.apply_labels(df, encode.fit_labels(df, c), c)
    return clean.select_candidates(df, features.LAP_CANDIDATES, also=[target])
