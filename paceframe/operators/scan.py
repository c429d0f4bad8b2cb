"""Ordered running totals that never put a whole group in one task.

A global or hot-group window is cut into bins of the order column. Each bin is
scanned on its own, and the totals of earlier bins are added as a carry. The
cut points come from an approximate percentile sketch, so bins hold about the
same number of rows whatever the value distribution; being literals in the
plan, they give the same bins on every retry.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import digest_number
from ..session import materialise
from .joins import left_join

ROWS_PER_BIN = 1_000_000
HOT_ROWS = 4_000_000
SLICE_DIGITS = 5


def cut_points(df: DataFrame, c: str, bins: int) -> list[float]:
    """At most ``bins - 1`` increasing cut points (bounded, so kept on the driver)."""
    if bins <= 1:
        return []
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(F.percentile_approx(F.col(c).cast("double"), probs, 4 * bins).alias("q")).first()
    return sorted(set(row["q"] or []))


def with_bin(df: DataFrame, c: str, cuts: Sequence[float], name: str = "__bin") -> DataFrame:
    """Bin number of a numeric column in its sort order: NULL is bin -1, below all values, and NaN is in the last bin."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    tool = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol="__x", outputCol=name, handleInvalid="keep"
    )
    return (
        tool.transform(df.withColumn("__x", F.col(c).cast("double")))
        .withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(-1))).drop("__x")
    )


def bins_for(rows: int, per_bin: int = ROWS_PER_BIN) -> int:
    return max(1, math.ceil(rows / per_bin))


def running_totals(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    rows_per_bin: int = ROWS_PER_BIN,
) -> DataFrame:
    """Inclusive running sums over distinct order values.

    ``df`` has one row per (by, order); ``sums`` maps input columns to result
    names. Rows are few per value because the caller aggregates ties first. A NULL
    order value sorts as in SQL windows: first upwards, last downwards.
    """
    bins = bins_for(df.count(), rows_per_bin)
    if bins > 1:
        df = materialise(df)
    cut = with_bin(df, order, cut_points(df, order, bins))
    direction = F.col(order).desc() if descending else F.col(order).asc()
    inner = (
        Window.partitionBy(*by, "__bin").orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = cut.withColumns({n: F.sum(c).over(inner) for c, n in sums.items()})
    if bins == 1:
        return scanned.drop("__bin")
    totals = cut.groupBy(*by, "__bin").agg(*[F.sum(c).alias(f"__t_{n}") for c, n in sums.items()])
    bin_order = F.col("__bin").desc() if descending else F.col("__bin").asc()
    earlier = Window.partitionBy(*by).orderBy(bin_order).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *by, "__bin", *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__c_{n}") for n in sums.values()]
    )
    joined = left_join(scanned, carry, [*by, "__bin"], null_safe=bool(by))
    return joined.withColumns({n: F.col(n) + F.col(f"__c_{n}") for n in sums.values()}).drop(
        "__bin", *[f"__c_{n}" for n in sums.values()]
    )


def hash_rank(
    df: DataFrame, key: str, seed: int | str = 42, by: Sequence[str] = (), name: str = "hash_rank"
) -> DataFrame:
    """Rank 1..n of rows in the order of a seeded digest of a unique key, within ``by``.

    The first hex digits of the digest cut every group into about a million even
    slices, so the rank of a group of any size is a slice-local row number plus
    the size of the earlier slices.
    """
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    cut = df.withColumns({"__digest": digest, "__slice": F.substring(digest, 1, SLICE_DIGITS)})
    sizes = cut.groupBy(*by, "__slice").agg(F.count(F.lit(1)).alias("__m"))
    earlier = Window.partitionBy(*by).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "__slice", F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__offset"))
    local = F.row_number().over(Window.partitionBy(*by, "__slice").orderBy("__digest", key))
    ranked = left_join(cut.withColumn("__local", local), offsets, [*by, "__slice"], null_safe=bool(by))
    return ranked.withColumn(name, (F.col("__local") + F.col("__offset")).cast("bigint")).drop(
        "__digest", "__slice", "__local", "__offset"
    )


def hash_number(key: str, seed: int | str = 42) -> Column:
    return digest_number(F.col(key), seed)


def hot_keys(df: DataFrame, key: str, limit: int = HOT_ROWS) -> DataFrame:
    """Table of the keys with more than ``limit`` rows, in the column ``key``."""
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    return materialise(sizes.where(F.col("__n") > limit).select(key))


def range_slices(df: DataFrame, order: Sequence[str], slices: int, name: str = "__bin") -> DataFrame:
    """Rows cut into about ``slices`` ranges of the full sort order, numbered upwards.

    Cuts fall between rows, not between values of the first column, so ties on it
    are split and any sortable type will do. NULLs come first, as in SQL windows.
    The rows are written with their number, so a retry can't cut them differently.
    """
    cut = df.repartitionByRange(max(1, slices), *order).withColumn(name, F.spark_partition_id())
    return materialise(cut)


def sorted_rank(df: DataFrame, order: Sequence[str], name: str, rows_per_slice: int = ROWS_PER_BIN) -> DataFrame:
    """Rank 0..n-1 in a sort order without ties, by ranges: a range-local number plus the size of earlier ranges."""
    cut = range_slices(df, order, math.ceil(df.count() / rows_per_slice))
    sizes = cut.groupBy("__bin").agg(F.count(F.lit(1)).alias("__m"))
    earlier = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bin", F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__offset"))
    local = F.row_number().over(Window.partitionBy("__bin").orderBy(*order)) - 1
    ranked = left_join(cut.withColumn("__local", local), offsets, "__bin")
    return ranked.withColumn(name, (F.col("__local") + F.col("__offset")).cast("bigint")).drop("__bin", "__local", "__offset")
