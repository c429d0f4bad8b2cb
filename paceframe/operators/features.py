"""Derived features as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .joins import attach_group_stats

# Band edges and labels.
LAP_BANDS = ((0.0, 0.33, 0.66, 1.0), ("early", "mid", "late"))
GRID_BANDS = ((0, 1, 10, 30), ("pole", "top10", "backmarker"))
ALTITUDE_BANDS = ((float("-inf"), 100, 600, float("inf")), ("low", "medium", "high"))
YEAR_BANDS = ((0, 2013, 2017, 2021, 2030), ("2010-2013", "2014-2017", "2018-2021", "2022+"))
LAP_CANDIDATES = (
    "lap", "lap_pct", "lap_group", "lap_squared", "driver_id", "team_id", "team_circuit_id", "circuit_id", "alt",
    "altitude_cat", "lat", "lng", "year", "year_group", "grid", "grid_group", "lap_altitude_interaction",
)


def advanced_features(df: DataFrame) -> DataFrame:
    """Nine interactions of grid, qualifying, points, ranks and altitude."""
    return df.withColumns({
        "grid_quali_gap": F.col("grid") - F.col("quali_position"),
        "driver_team_points_ratio": S.guarded_ratio("driver_points", "team_points"),
        "quali_x_team_points": F.col("quali_position") * F.col("team_points"),
        "season_share": F.col("round") / F.lit(S.ROUNDS_PER_SEASON),
        "rank_gap": F.col("driver_rank") - F.col("team_rank"),
        "log_driver_points": F.log1p("driver_points"),
        "log_team_points": F.log1p("team_points"),
        "quali_x_grid": F.col("quali_position") * F.col("grid"),
        "extreme_altitude": S.flag(F.col("alt") > S.EXTREME_ALTITUDE),
    })


def season_progress(df: DataFrame, year: str = "year", rnd: str = "round") -> DataFrame:
    """Share of the season completed, and flags for its first and last three rounds."""
    df = attach_group_stats(df, year, {"__last": F.max(rnd)}, null_safe=True)
    return df.withColumns({
        "season_progress": F.try_divide(F.col(rnd), F.col("__last")),
        "is_season_start": S.flag(F.col(rnd) <= 3),
        "is_season_end": S.flag(F.col(rnd) >= F.col("__last") - 2),
    }).drop("__last")


def qualifying_temporal(
    df: DataFrame, quali: str = "position_quali", born: str = "dob", sessions: Sequence[str] = ("q1", "q2", "q3"),
    strict: bool = False,
) -> DataFrame:
    """Qualifying flags, driver age, season progress, session times and presence flags."""
    df = df.withColumns({
        "quali_position_top3": S.flag(F.col(quali) <= 3),
        "quali_position_top5": S.flag(F.col(quali) <= 5),
        born: S.to_moment(born),
    })
    df = season_progress(df.withColumn("driver_age", S.years_between("year", born)))
    have = set(df.columns)
    times = {
        f"{q}_ms": S.clock_to_ms(q, strict) if q in have else F.lit(None).cast("double") for q in sessions
    }
    seen = {f"has_{q}": S.present(q) if q in have else F.lit(0) for q in sessions}
    return df.withColumns({**times, **seen})


def lap_features(df: DataFrame, altitude: str = "alt") -> DataFrame:
    """Lap bands, grid and era bands, interactions, and percent of the race completed."""
    df = attach_group_stats(df, "race_id", {"__laps": F.max("lap")}, null_safe=True)
    done = F.try_divide(F.col("lap"), F.col("__laps"))
    return df.withColumns({
        "lap_group": S.band(done, *LAP_BANDS),
        "grid_group": S.band("grid", *GRID_BANDS),
        "lap_squared": F.col("lap") * F.col("lap"),
        "altitude_cat": S.band(altitude, *ALTITUDE_BANDS),
        "team_circuit_id": S.pair_key("team_id", "circuit_id"),
        "year_group": S.band("year", *YEAR_BANDS),
        "lap_altitude_interaction": F.col("lap") * F.col(altitude) / F.lit(1000.0),
        "lap_pct": done * 100.0,
    }).drop("__laps")
