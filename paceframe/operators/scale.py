"""Feature scaling: a fit is two numbers per column, kept with the plan as literals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quantiles import EXACT_ROWS, column_quantiles


@dataclass(frozen=True)
class Scaler:
    """(x - centre) / width per column."""

    centre: dict[str, float]
    width: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(m)) / F.lit(self.width[c]) for c, m in self.centre.items() if c in df.columns}
        )

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: F.col(c) * F.lit(self.width[c]) + F.lit(m) for c, m in self.centre.items() if c in df.columns}
        )

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(c, m, self.width[c]) for c, m in self.centre.items()]
        return spark.createDataFrame(rows, "column_name string, centre double, width double")

    @staticmethod
    def from_frame(df: DataFrame) -> Scaler:
        rows = df.collect()
        return Scaler({r["column_name"]: r["centre"] for r in rows}, {r["column_name"]: r["width"] for r in rows})


def _scaler(stats: dict[str, tuple[float | None, float | None]]) -> Scaler:
    """Columns without values are centred at 0; a zero width becomes 1."""
    centre = {c: float(m) if m is not None else 0.0 for c, (m, _) in stats.items()}
    width = {c: float(w) if w else 1.0 for c, (_, w) in stats.items()}
    return Scaler(centre, width)


def fit_standard(train: DataFrame, cols: Sequence[str]) -> Scaler:
    """Mean and population standard deviation."""
    if not cols:
        return Scaler({}, {})
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]
    ).first()
    return _scaler({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols})


def fit_minmax(train: DataFrame, cols: Sequence[str]) -> Scaler:
    """Minimum and range; a constant column maps to 0 and test rows are not clipped."""
    if not cols:
        return Scaler({}, {})
    row = train.agg(*[F.min(c).alias(f"a_{c}") for c in cols], *[F.max(c).alias(f"b_{c}") for c in cols]).first()
    stats = {c: (row[f"a_{c}"], row[f"b_{c}"]) for c in cols}
    return _scaler({c: (a, None if a is None else b - a) for c, (a, b) in stats.items()})


def fit_robust(train: DataFrame, cols: Sequence[str], exact_rows: int = EXACT_ROWS) -> Scaler:
    """Median and interquartile range, both exact."""
    q = column_quantiles(train, cols, [0.25, 0.5, 0.75], exact_rows=exact_rows)
    return _scaler({c: (v[1], None if v[0] is None else v[2] - v[0]) for c, v in q.items()})


def fit_dual(train: DataFrame, minmax: Sequence[str], standard: Sequence[str]) -> Scaler:
    """Min-max for one list of columns and standard for another, where they exist."""
    have = set(train.columns)
    low, mid = [c for c in minmax if c in have], [c for c in standard if c in have]
    if not low and not mid:
        return Scaler({}, {})
    row = train.agg(
        *[f(c).alias(f"{n}_{c}") for c in low for n, f in (("a", F.min), ("b", F.max))],
        *[f(c).alias(f"{n}_{c}") for c in mid for n, f in (("m", F.avg), ("s", F.stddev_pop))],
    ).first()
    stats = {c: (row[f"a_{c}"], None if row[f"a_{c}"] is None else row[f"b_{c}"] - row[f"a_{c}"]) for c in low}
    return _scaler({**stats, **{c: (row[f"m_{c}"], row[f"s_{c}"]) for c in mid}})
