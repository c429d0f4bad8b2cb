"""Left joins with explicit naming rules.

No side is hinted as broadcast: Catalyst and AQE decide from measured sizes, and
AQE splits a skewed left side of a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _match(left: DataFrame, right: DataFrame, on: Sequence[str], tags: Mapping[str, str], null_safe: bool) -> Column:
    cond = None
    for k in on:
        a, b = left[k], right[tags[k]]
        one = a.eqNullSafe(b) if null_safe else a == b
        cond = one if cond is None else cond & one
    return cond


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    take: Mapping[str, str] | Sequence[str] | None = None,
    suffix: str = "",
    null_safe: bool = False,
) -> DataFrame:
    """Left equi-join that never yields two columns of one name.

    ``take`` picks (and, as a mapping, renames) columns of the right side.
    Remaining clashes of non-key columns get ``suffix`` on the right.
    """
    on = [on] if isinstance(on, str) else list(on)
    if take is None:
        names = {c: c for c in right.columns if c not in on}
    elif isinstance(take, Mapping):
        names = dict(take)
    else:
        names = {c: c for c in take}
    renamed = {c: (n + suffix if n in left.columns else n) for c, n in names.items()}
    if set(renamed.values()) & set(left.columns) or len(set(renamed.values())) != len(renamed):
        raise ValueError(f"column names clash: {sorted(set(renamed.values()) & set(left.columns))}")
    slim = right.select(*on, *[F.col(c).alias(n) for c, n in renamed.items()])
    if not null_safe:
        return left.join(slim, on, "left").select(*left.columns, *renamed.values())
    tags = {k: f"__right_{k}" for k in on}
    slim = slim.withColumnsRenamed(tags)
    return left.join(slim, _match(left, slim, on, tags, True), "left").drop(*tags.values())


def duplicate_keys(df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*on).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def left_join_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | str,
    order: Sequence[Column | str],
    take: Mapping[str, str] | Sequence[str] | None = None,
    suffix: str = "",
    validate: bool = False,
) -> DataFrame:
    """Left join that keeps the number of left rows.

    The right side is reduced to its first row per key in ``order``; with
    ``validate`` a repeated key is an error instead.
    """
    on = [on] if isinstance(on, str) else list(on)
    if validate and not duplicate_keys(right, on).isEmpty():
        raise ValueError(f"right side has repeated keys {on}")
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    rest = [c for c in right.columns if c not in on]
    first = right.groupBy(*on).agg(F.min_by(F.struct(*rest), F.struct(*keys)).alias("__r"))
    return left_join(left, first.select(*on, "__r.*"), on, take, suffix)


def attach_group_stats(
    df: DataFrame, by: Sequence[str] | str, stats: Mapping[str, Column], null_safe: bool = False
) -> DataFrame:
    """Add group aggregates to every row.

    A partial aggregate and a join back stand in for a window over the whole
    group, so a key with a third of all rows never has to sit in one task.
    Rows with a NULL key get NULL unless ``null_safe``.
    """
    by = [by] if isinstance(by, str) else list(by)
    agg = df.groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])
    return left_join(df, agg, by, list(stats), null_safe=null_safe)


def assemble_regression(
    results: DataFrame,
    schedule: DataFrame,
    qualifying: DataFrame,
    driver_standings: DataFrame,
    team_standings: DataFrame,
    circuits: DataFrame,
) -> DataFrame:
    """Entry rows with event, qualifying, both standings and circuit."""
    df = left_join(results, schedule, "race_id", ["year", "round", "circuit_id"])
    df = left_join(df, qualifying, ["race_id", "driver_id"], {"position": "quali_position"})
    df = left_join(
        df, driver_standings, ["race_id", "driver_id"],
        {"points": "driver_points", "position": "driver_rank", "wins": "driver_wins"},
    )
    df = left_join(
        df, team_standings, ["race_id", "team_id"],
        {"points": "team_points", "position": "team_rank", "wins": "team_wins"},
    )
    return left_join(
        df, circuits, "circuit_id",
        {"name": "circuit_name", "location": "circuit_location", "country": "circuit_country",
         "lat": "lat", "lng": "lng", "alt": "alt"},
    )


def assemble_classification(
    results: DataFrame,
    schedule: DataFrame,
    qualifying: DataFrame,
    circuits: DataFrame,
    drivers: DataFrame,
    teams: DataFrame,
) -> DataFrame:
    """Entry rows with every column of the five other tables; clashes carry a suffix."""
    df = left_join(results, schedule, "race_id", suffix="_race")
    df = left_join(df, qualifying, ["race_id", "driver_id"], suffix="_quali")
    df = left_join(df, circuits, "circuit_id", suffix="_circuit")
    df = left_join(df, drivers, "driver_id", suffix="_driver")
    return left_join(df, teams, "team_id", suffix="_team")


def assemble_laps(laps: DataFrame, results: DataFrame, calendar: DataFrame, circuits: DataFrame) -> DataFrame:
    """Lap rows with the entry (suffix ``_results``), the season calendar and the circuit."""
    df = left_join(laps, results, ["race_id", "driver_id"], suffix="_results")
    df = left_join(df, calendar, ["circuit_id", "year"], suffix="_calendar")
    return left_join(df, circuits, "circuit_id", suffix="_circuit")
