"""Career profiles of drivers and teams, value counts, and group summaries.

Each profile is one aggregate with conditional counts, so facts are shuffled
once, already reduced on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import share, to_number
from .joins import left_join

# The grid slot assumed when none is known, and the profile columns clustered on.
BACK_OF_GRID = 20
SEGMENT_FEATURES = (
    "avg_grid", "avg_finish", "win_rate", "podium_rate", "top10_rate", "dnf_rate", "avg_positions_gained",
)
# Team profile columns clustered on, in the given order.
TEAM_FEATURES = (
    "avg_points_per_race", "win_rate", "podium_rate", "dnf_rate", "scoring_consistency", "avg_grid",
)


def _numbers(results: DataFrame) -> DataFrame:
    have = set(results.columns)
    casts = {c: to_number(c) for c in ("grid", "position", "position_order", "points", "laps") if c in have}
    casts["grid"] = F.coalesce(casts["grid"], F.lit(float(BACK_OF_GRID)))
    return results.withColumns(casts)


def _career(finish: str = "position_order") -> dict[str, Column]:
    gained = F.when(F.col("position").isNotNull(), F.col("grid") - F.col("position"))
    return {
        "total_races": F.count("race_id"),
        "avg_grid": F.avg("grid"),
        "avg_finish": F.avg(finish),
        "wins": F.count_if(F.col(finish) == 1),
        "podiums": F.count_if(F.col(finish) <= 3),
        "top10": F.count_if(F.col(finish) <= 10),
        "dnfs": F.count_if(F.col("position").isNull()),
        "avg_positions_gained": F.coalesce(F.avg(gained), F.lit(0.0)),
    }


def _rates(df: DataFrame, of: Mapping[str, tuple[str, str]], scale: float = 1.0) -> DataFrame:
    ratio = lambda a, b: share(F.col(a), F.col(b))
    return df.withColumns({n: ratio(a, b) * scale if scale != 1.0 else ratio(a, b) for n, (a, b) in of.items()})


def driver_features(results: DataFrame, drivers: DataFrame, min_races: int = 20) -> DataFrame:
    """Profile of every driver with enough entries, with names.

    The entry count is part of the same aggregate, so the activity filter costs
    no second pass over the facts.
    """
    stats = (
        _numbers(results).where(F.col("driver_id").isNotNull()).groupBy("driver_id")
        .agg(F.count(F.lit(1)).alias("__rows"), *[c.alias(n) for n, c in _career().items()])
        .where(F.col("__rows") >= min_races).drop("__rows")
    )
    stats = _rates(stats, {
        "win_rate": ("wins", "total_races"), "podium_rate": ("podiums", "total_races"),
        "top10_rate": ("top10", "total_races"), "dnf_rate": ("dnfs", "total_races"),
    })
    return left_join(stats, drivers, "driver_id", ["driver_ref", "nationality"])


def main_partner(df: DataFrame, key: str, partner: str) -> DataFrame:
    """Most frequent partner per key, the smallest one on ties.

    Counting (key, partner) pairs first keeps a hot key's values out of a single
    aggregation buffer.
    """
    pairs = df.where(F.col(partner).isNotNull()).groupBy(key, partner).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min_by(F.col(partner), F.struct(-F.col("__n"), F.col(partner)))
    return pairs.groupBy(key).agg(best.alias("main_partner"))


def avg_side_metric(side: DataFrame, key: str, metric: str, name: str) -> DataFrame:
    """Average of a side fact's metric per key, from text or numbers."""
    return side.groupBy(key).agg(F.avg(to_number(metric)).alias(name))


def driver_features_ext(
    results: DataFrame, drivers: DataFrame, qualifying: DataFrame, min_races: int = 20
) -> DataFrame:
    """Wide profile: percent rates, points, laps, consistency, main team, average qualifying."""
    rows = _numbers(results).where(F.col("driver_id").isNotNull())
    more = {
        "total_points": F.sum("points"), "avg_points": F.avg("points"), "total_laps": F.sum("laps"),
        "consistency_score": F.coalesce(F.stddev_samp("position_order"), F.lit(0.0)),
    }
    stats = (
        rows.groupBy("driver_id").agg(*[c.alias(n) for n, c in {**_career(), **more}.items()])
        .where(F.col("total_races") >= min_races)
    )
    stats = _rates(stats, {"win_rate": ("wins", "total_races"), "points_per_race": ("total_points", "total_races")})
    stats = _rates(stats, {
        "podium_rate": ("podiums", "total_races"), "top10_rate": ("top10", "total_races"),
        "dnf_rate": ("dnfs", "total_races"),
    }, 100.0)
    stats = left_join(stats, main_partner(rows, "driver_id", "team_id"), "driver_id")
    stats = left_join(stats, avg_side_metric(qualifying, "driver_id", "position", "avg_quali_position"), "driver_id")
    return left_join(stats, drivers, "driver_id", ["driver_ref", "nationality"])


def driver_features_legacy(
    results: DataFrame, drivers: DataFrame, qualifying: DataFrame, min_races: int = 10
) -> DataFrame:
    """Older profile built on the numeric finish only (grid stays as given)."""
    rows = results.withColumns(
        {c: to_number(c) for c in ("position", "grid", "points", "laps")}
    ).where(F.col("driver_id").isNotNull())
    stats = rows.groupBy("driver_id").agg(
        F.avg("position").alias("avg_position"), F.stddev_samp("position").alias("std_position"),
        F.avg("grid").alias("avg_grid"), F.avg("points").alias("avg_points"),
        F.sum("points").alias("total_points"), F.count("race_id").alias("career_races"),
        F.count_if(F.col("position") <= 3).alias("total_podiums"),
        F.count_if(F.col("position") <= 10).alias("total_top10"), F.sum("laps").alias("total_laps"),
        F.count_if(F.col("position").isNull()).alias("total_dnf"),
    ).where(F.col("career_races") >= min_races)
    stats = _rates(stats, {"points_per_race": ("total_points", "career_races")})
    stats = _rates(stats, {
        "podium_rate": ("total_podiums", "career_races"), "top10_rate": ("total_top10", "career_races"),
        "dnf_rate": ("total_dnf", "career_races"),
    }, 100.0).withColumn("consistency_score", F.coalesce(F.col("std_position"), F.lit(0.0)))
    stats = left_join(stats, main_partner(rows, "driver_id", "team_id"), "driver_id")
    stats = left_join(stats, avg_side_metric(qualifying, "driver_id", "position", "avg_quali_position"), "driver_id")
    return left_join(stats, drivers, "driver_id", ["driver_ref", "nationality"])


def constructor_features(results: DataFrame, teams: DataFrame, min_races: int = 30) -> DataFrame:
    """Profile of every team that took part in enough distinct events.

    Entries are reduced to one row per team and event first; the number of
    events is then a plain count, and a hot team is spread over its events.
    """
    rows = _numbers(results).where(F.col("team_id").isNotNull())
    per_event = rows.groupBy("team_id", "race_id").agg(
        F.count("race_id").alias("n"), F.sum(F.coalesce("points", F.lit(0.0))).alias("pts"),
        F.count_if(F.col("position_order") == 1).alias("w"), F.count_if(F.col("position_order") <= 3).alias("p"),
        F.count_if(F.col("position_order") <= 10).alias("t"), F.count_if(F.col("position").isNull()).alias("d"),
        F.sum("grid").alias("g"), F.count("grid").alias("gn"),
    )
    stats = per_event.groupBy("team_id").agg(
        F.sum("n").alias("total_entries"), F.count("race_id").alias("races_participated"),
        F.sum("pts").alias("total_points"), F.sum("w").alias("wins"), F.sum("p").alias("podiums"),
        F.sum("t").alias("top10"), F.sum("d").alias("dnfs"), share(F.sum("g"), F.sum("gn")).alias("avg_grid"),
    ).where(F.col("races_participated") >= min_races)
    stats = _rates(stats, {
        "avg_points_per_race": ("total_points", "races_participated"), "win_rate": ("wins", "races_participated"),
        "podium_rate": ("podiums", "races_participated"), "dnf_rate": ("dnfs", "total_entries"),
        "scoring_consistency": ("top10", "total_entries"),
    })
    return left_join(stats, teams, "team_id", {"name": "team_ref", "nationality": "nationality"})


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Rows per value and their share of all rows; the total is taken over the counts."""
    counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.sum("rows").alias("t")).select("t").scalar()
    return counts.withColumn("share", share(F.col("rows"), total))


def class_balance(df: DataFrame, split: str, label: str) -> DataFrame:
    """Rows and percent of each class inside each split."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("rows"))
    inside = F.sum("rows").over(Window.partitionBy(split))
    return counts.withColumn("percent", F.col("rows") * 100.0 / inside)


def group_means(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in cols])


def global_stats(df: DataFrame, c: str) -> DataFrame:
    from .quantiles import column_quantiles

    mid = column_quantiles(df.select(c), [c], [0.5])[c][0]
    return df.agg(
        F.max(c).alias("max_value"), F.min(c).alias("min_value"), F.avg(c).alias("mean_value"),
    ).withColumn("median_value", F.lit(mid).cast("double"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column, exact unless told otherwise.

    Exact counting dedupes (column, value) pairs of all columns in one shuffle.
    """
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("n")) for c in cols])
        return wide.select(F.explode(pairs).alias("p")).select(
            F.col("p.k").alias("column_name"), F.col("p.n").alias("distinct_values")
        )
    pairs = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols])
    long = df.select(F.explode(pairs).alias("p")).select("p.k", "p.v").distinct()
    return long.groupBy(F.col("k").alias("column_name")).agg(F.count("v").alias("distinct_values"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of every set of equal rows."""
    same = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    return same.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"),
    )


def date_span(df: DataFrame, c: str) -> DataFrame:
    first, last = F.min(c), F.max(c)
    return df.agg(
        first.alias("first_day"), last.alias("last_day"), (F.datediff(last, first) / F.lit(365.25)).alias("years")
    )


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order: a per-partition heap, never a full sort."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, by: Sequence[str] | str, k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """First k rows per group; Spark limits each group before the shuffle."""
    by = [by] if isinstance(by, str) else list(by)
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """n rows in the order of a seeded digest of a unique key: repeatable on any layout."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(digest, F.col(key)).limit(n)
