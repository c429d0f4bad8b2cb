"""Exact interpolated quantiles that scale.

``percentile`` keeps every distinct value of a group in one task's memory. Up to
a row limit that is the fastest way; beyond it a sketch brackets each wanted
rank, and only the values inside the bracket are counted and scanned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import left_join

EXACT_ROWS = 250_000
ACCURACY = 20_000


def _plain(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    # one percentile call for all ranks: one value map per group
    q = df.groupBy(*by).agg(F.percentile(value, list(probs)).alias("__q"))
    return q.select(*by, *[F.get("__q", F.lit(i)).alias(n) for i, n in enumerate(names)])


def _bracketed(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str], accuracy: int
) -> DataFrame:
    slack = 2.0 / accuracy
    low = [max(0.0, p - slack) for p in probs]
    high = [min(1.0, p + slack) for p in probs]
    m = len(probs)
    sketch = df.groupBy(*by).agg(
        F.count(value).alias("__n"), F.percentile_approx(value, low + high, accuracy).alias("__edges")
    )
    rows = left_join(df.select(*by, value).where(F.col(value).isNotNull()), sketch, list(by), null_safe=True)
    marks = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                (F.col(value) < F.get("__edges", F.lit(i))).alias("below"),
                F.col(value).between(F.get("__edges", F.lit(i)), F.get("__edges", F.lit(m + i))).alias("inside"),
            )
            for i in range(m)
        ]
    )
    tagged = rows.select(*by, "__n", value, F.explode(marks).alias("__k")).select(
        *by, "__n", value, "__k.i", "__k.below", "__k.inside"
    ).where("below OR inside")
    # values below the bracket are only counted, so they collapse to one row per group and rank
    counted = tagged.groupBy(
        *by, "__n", "i", F.when(F.col("inside"), F.col(value)).alias("v")
    ).agg(F.count(F.lit(1)).alias("__c"))
    run = Window.partitionBy(*by, "i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    upto = counted.withColumn("__upto", F.sum("__c").over(run)).where(F.col("v").isNotNull())
    p = F.get(F.array(*[F.lit(float(x)) for x in probs]), F.col("i"))
    spot = (F.col("__n") - 1) * p
    holds = lambda k: (F.col("__upto") > k) & (F.col("__upto") - F.col("__c") <= k)
    ends = upto.groupBy(*by, "i", "__n").agg(
        F.max(F.when(holds(F.floor(spot)), F.col("v"))).alias("lo"),
        F.max(F.when(holds(F.ceil(spot)), F.col("v"))).alias("hi"),
    )
    frac = spot - F.floor(spot)
    missed = F.raise_error(F.lit("quantile bracket missed its rank"))
    lo, hi = F.coalesce(F.col("lo"), missed), F.coalesce(F.col("hi"), missed)
    exact = ends.select(*by, "i", F.when(frac == 0, lo).otherwise(lo + (hi - lo) * frac).cast("double").alias("q"))
    wide = exact.groupBy(*by).agg(
        *[F.max(F.when(F.col("i") == i, F.col("q"))).alias(n) for i, n in enumerate(names)]
    )
    if not by:
        return wide
    return left_join(df.select(*by).distinct(), wide, list(by), list(names), null_safe=True)


def quantile_name(p: float) -> str:
    return f"p{p * 100:g}".replace(".", "_")


def group_quantiles(
    df: DataFrame,
    by: Sequence[str] | str,
    value: str,
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    exact_rows: int = EXACT_ROWS,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """One row per group with its exact quantiles (linear interpolation)."""
    by = [by] if isinstance(by, str) else list(by)
    names = list(names) if names else [quantile_name(p) for p in probs]
    if df.count() <= exact_rows:
        return _plain(df, by, value, probs, names)
    return _bracketed(df, by, value, probs, names, accuracy)


def column_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    exact_rows: int = EXACT_ROWS,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns: a fitted statistic of fixed size."""
    cols = list(cols)
    if not cols:
        return {}
    if df.count() <= exact_rows:
        row = df.agg(*[F.percentile(F.col(c), list(probs)).alias(c) for c in cols]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}
    long = unpivot(df, cols)
    names = [f"q{i}" for i in range(len(probs))]
    rows = _bracketed(long, ["name"], "value", probs, names, accuracy).collect()
    return {r["name"]: [r[n] for n in names] for r in rows}


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form: one row per row and column, as (keep..., name, value double)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.explode(pairs).alias("__p")).select(*keep, "__p.name", "__p.value")


def medians(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, float | None]:
    return {c: q[0] for c, q in column_quantiles(df, cols, [0.5], **kw).items()}
