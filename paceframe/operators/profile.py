"""Profiling, quality checks and correlation. Every report is one pass of map-side aggregates."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import share
from .clean import numeric_columns
from .entity import distinct_counts, duplicate_count
from .joins import left_join
from .quantiles import EXACT_ROWS, column_quantiles, group_quantiles


def describe_numeric(df: DataFrame, cols: Sequence[str], exact_rows: int = EXACT_ROWS) -> DataFrame:
    """count, mean, std, min, quartiles, max per column, quartiles exact."""
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact_rows=exact_rows)
    row = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            *[F.lit(v).cast("double").alias(n) for n, v in zip(("p25", "p50", "p75"), q.get(c, [None] * 3))],
            F.max(c).cast("double").alias("max"),
        ) for c in cols
    ])
    return df.agg(row.alias("r")).select(F.explode("r").alias("r")).select("r.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with NULLs: their number and percent, most first."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in df.columns])
    wide = df.agg(pairs.alias("p"), F.count(F.lit(1)).alias("rows"))
    long = wide.select(F.explode("p").alias("p"), "rows").select("p.*", "rows").where(F.col("nulls") > 0)
    return long.select("column_name", "nulls", (F.col("nulls") * 100.0 / F.col("rows")).alias("percent")).orderBy(
        F.desc("nulls"), "column_name"
    )


def type_profile(df: DataFrame) -> DataFrame:
    """Column types with the number of non-NULL values."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("type"), F.count(c).alias("non_null"))
        for c, t in df.dtypes
    ])
    return df.agg(pairs.alias("p")).select(F.explode("p").alias("p")).select("p.*")


def iqr_bounds(df: DataFrame, c: str, times: float = 3.0, exact_rows: int = EXACT_ROWS) -> tuple[float, float]:
    low, high = column_quantiles(df.select(c), [c], [0.25, 0.75], exact_rows=exact_rows)[c]
    return low - times * (high - low), high + times * (high - low)


def drop_outliers_iqr(df: DataFrame, c: str, times: float = 3.0) -> DataFrame:
    """Keep rows inside [Q1 - t*IQR, Q3 + t*IQR]; rows without a value are no outliers."""
    low, high = iqr_bounds(df, c, times)
    return df.where(F.coalesce(F.col(c).between(low, high), F.lit(True)))


def _checks(row: Sequence[tuple[str, Column, Column]]) -> Column:
    return F.array(*[
        F.struct(F.lit(n).alias("check"), v.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))
        for n, v, ok in row
    ])


def target_checks(df: DataFrame, target: str, max_null: float = 0.10, min_distinct: int = 100) -> DataFrame:
    """Is the target numeric, mostly present, and varied enough?"""
    numeric = target in numeric_columns(df)
    distinct = distinct_counts(df, [target]).select("distinct_values").scalar()
    base = df.agg(share(F.count_if(F.col(target).isNull()), F.count(F.lit(1))).alias("nulls"))
    rows = _checks([
        ("numeric", F.lit(int(numeric)), F.lit(numeric)),
        ("null_share", F.col("nulls"), F.col("nulls") < max_null),
        ("distinct", distinct, distinct > min_distinct),
    ])
    return base.select(F.explode(rows).alias("r")).select("r.*")


def quality_checks(
    df: DataFrame, target: str, critical: Sequence[str], valid: tuple[float, float] = (30_000, 300_000),
    cv: tuple[float, float] = (0.05, 1.0), min_rows: int = 10_000, min_distinct: int = 100,
) -> DataFrame:
    """Seven checks of a cleaned table as rows (check, value, ok)."""
    have = [c for c in critical if c in df.columns]
    nulls = sum((F.count_if(F.col(c).isNull()) for c in have), F.lit(0))
    base = df.agg(
        F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"),
        share(F.stddev_samp(target), F.avg(target)).alias("cv"),
        F.count_if(~F.coalesce(F.col(target).between(*valid), F.lit(False))).alias("out"),
    )
    dups = duplicate_count(df).select("duplicates").scalar()
    distinct = distinct_counts(df, [target]).select("distinct_values").scalar()
    numeric = len(numeric_columns(df))
    rows = _checks([
        ("duplicates", dups, dups == 0),
        ("critical_nulls", F.col("nulls"), F.col("nulls") == 0),
        ("variation", F.col("cv"), (F.col("cv") > cv[0]) & (F.col("cv") < cv[1])),
        ("numeric_columns", F.lit(numeric), F.lit(numeric > 0)),
        ("out_of_range", F.col("out"), F.col("out") == 0),
        ("rows", F.col("rows"), F.col("rows") > min_rows),
        ("distinct_target", distinct, distinct > min_distinct),
    ])
    return base.select(F.explode(rows).alias("r")).select("r.*")


def pearson(a: str, b: str) -> Column:
    """Correlation over rows where both are known; NULL (not an error) for a constant column."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(x) * F.stddev_pop(y))


def moments(df: DataFrame, cols: Sequence[str], complete: bool = False, centre: bool = True) -> DataFrame:
    """Sums of every ordered pair of columns over the rows where both are known: n, sum, squares, products.

    Each task adds up four matrices of its rows and returns them once, so a pass costs
    p x p numbers per task whatever the number of pairs. Columns are shifted by their
    means first (unless ``centre`` is off), which keeps the sums exact enough.
    """
    names = list(cols)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    numbers = numbers.dropna() if complete else numbers
    means = numbers.agg(*[F.avg(c).alias(c) for c in names]).first() if centre else [0.0] * len(names)
    shift = [float(v or 0.0) for v in means]

    def add(batches):
        p = len(names)
        total = np.zeros((4, p, p))
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in range(p)]) - shift
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            total += np.stack([m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x])
        i, j = np.divmod(np.arange(p * p), p)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(t.ravel()) for t in total)], names=["i", "j", "n", "s", "q", "xy"]
        )

    each = numbers.mapInArrow(add, "i int, j int, n double, s double, q double, xy double")
    sums = each.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q", "xy")])
    label = lambda c: F.get(F.array(*[F.lit(v) for v in names]), F.col(c))
    return sums.select("i", "j", label("i").alias("left_column"), label("j").alias("right_column"), "n", "s", "q", "xy")


def _upper(m: DataFrame) -> DataFrame:
    """Pairs i <= j with the sums of both sides."""
    other = m.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("s2"), F.col("q").alias("q2"))
    return m.where("i <= j").join(other, ["i", "j"])


def corr_matrix(df: DataFrame, cols: Sequence[str], complete: bool = False) -> DataFrame:
    """Pearson correlation of every pair i <= j over rows where both are known; NULL for a constant column.

    ``complete`` first drops rows with a NULL in any of the columns.
    """
    m = _upper(moments(df, cols, complete))
    vx, vy = F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.col("q2") - F.col("s2") * F.col("s2") / F.col("n")
    cov = F.col("xy") - F.col("s") * F.col("s2") / F.col("n")
    # what is left of a constant column's variance is rounding
    tiny = lambda v, q: v <= q * F.lit(1e-12)
    corr = F.when((F.col("n") > 0) & ~tiny(vx, F.col("q")) & ~tiny(vy, F.col("q2")), cov / F.sqrt(vx * vy))
    return m.select("left_column", "right_column", corr.alias("corr"))


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str, threshold: float = 0.1) -> DataFrame:
    """Correlation with the target, strongest first, and whether it counts as significant."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), pearson(c, target).alias("corr")) for c in cols])
    long = df.agg(pairs.alias("p")).select(F.explode("p").alias("p")).select("p.*")
    long = long.withColumn("strength", F.abs("corr"))
    return long.withColumn("significant", F.coalesce(F.col("strength") > threshold, F.lit(False))).orderBy(F.desc_nulls_last("strength"), "column_name")


def collinear_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.8) -> DataFrame:
    m = corr_matrix(df, cols)
    return m.where((F.col("left_column") != F.col("right_column")) & (F.abs("corr") > threshold))


def gram_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Uncentred sums of products of every pair i <= j over complete rows."""
    m = moments(df, cols, complete=True, centre=False).where("i <= j")
    return m.select("left_column", "right_column", F.col("xy").alias("dot"))


def vif(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Variance inflation of every given feature, without an intercept.

    The Gram matrix is a Spark aggregate; only its few numbers are inverted on
    the driver. VIF of a column is its diagonal times that of the inverse.
    """
    cols = list(cols)
    index = {c: i for i, c in enumerate(cols)}
    g = np.zeros((len(cols), len(cols)))
    for r in gram_matrix(df, cols).collect():
        i, j = index[r["left_column"]], index[r["right_column"]]
        g[i, j] = g[j, i] = r["dot"]
    scale = np.sqrt(np.where(np.diag(g) > 0, np.diag(g), 1.0))
    values = np.diag(np.linalg.pinv(g / np.outer(scale, scale)))
    rows = [(c, float(v)) for c, v in zip(cols, values)]
    return df.sparkSession.createDataFrame(rows, "column_name string, vif double")


def histogram(df: DataFrame, c: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed."""
    row = df.agg(F.min(c).cast("double").alias("a"), F.max(c).cast("double").alias("b")).first()
    low, high = row["a"], row["b"]
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0.0).alias("bin_start"), F.lit(0).cast("bigint").alias("rows")).limit(0)
    width = (high - low) / bins or 1.0
    slot = F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(c).isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"), "rows")


def box_stats(df: DataFrame, by: str, c: str, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Quartiles, fences and extremes by group."""
    q = group_quantiles(df.select(by, c), by, c, [0.25, 0.5, 0.75], ["q1", "median", "q3"], exact_rows=exact_rows)
    ends = df.groupBy(by).agg(F.min(c).alias("min"), F.max(c).alias("max"), F.count(c).alias("rows"))
    iqr = F.col("q3") - F.col("q1")
    return left_join(q, ends, by, null_safe=True).withColumns(
        {"low_fence": F.col("q1") - 1.5 * iqr, "high_fence": F.col("q3") + 1.5 * iqr}
    )
