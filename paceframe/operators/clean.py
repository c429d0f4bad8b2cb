"""Row filters, column selection and column alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import flag, to_moment, to_number

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def is_numeric(dtype: str) -> bool:
    return dtype in NUMERIC or dtype.startswith("decimal")


def keep_era(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    return df.where(F.col(year).between(first, last))


def keep_finishers(df: DataFrame, position: str = "position", lo: int = 1, hi: int = 30) -> DataFrame:
    """Numeric finish inside [lo, hi]; unreadable or missing positions go."""
    return df.withColumn(position, to_number(position)).where(F.col(position).between(lo, hi))


def keep_present(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def drop_listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def drop_leaky_and_text(
    df: DataFrame, names: Sequence[str], keep_text: Sequence[str], variants: Sequence[str] = ("_x", "_y")
) -> DataFrame:
    """Drop listed columns with their suffix variants, and text outside an allow-list."""
    gone = {n + v for n in names for v in ("", *variants)}
    gone |= {c for c, t in df.dtypes if t == "string" and c not in keep_text}
    return df.drop(*sorted(gone))


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if is_numeric(t)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def coerce(df: DataFrame, numbers: Sequence[str] = (), moments: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({**{c: to_number(c) for c in numbers}, **{c: to_moment(c) for c in moments}})


def podium_target(df: DataFrame, position: str = "position", top: int = 3) -> DataFrame:
    """Keep rows with a numeric finish; add the finish as a copy and the 0/1 target."""
    df = df.withColumn(position, to_number(position)).where(F.col(position).isNotNull())
    return df.withColumns(
        {"position_original": F.col(position), "is_podium": flag(F.col(position) <= top)}
    )


def chronological(df: DataFrame, keys: Sequence[str] = ("date", "race_id", "result_id")) -> DataFrame:
    """Global order by date, event and row id; windows carry their own order."""
    return df.orderBy(*keys)


def active_keys(df: DataFrame, key: str, minimum: int, distinct: str | None = None) -> DataFrame:
    """Keys with at least ``minimum`` rows, or distinct values of ``distinct``."""
    size = F.count(F.lit(1)) if distinct is None else F.count_distinct(distinct)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(size.alias("__n")).where(F.col("__n") >= minimum).select(key)


def keep_active(df: DataFrame, key: str, minimum: int, distinct: str | None = None) -> DataFrame:
    """Rows of keys that occur often enough."""
    return df.join(active_keys(df, key, minimum, distinct), key, "left_semi")


def with_defaults(df: DataFrame, proxies: Mapping[str, str], defaults: Mapping[str, object]) -> DataFrame:
    """Optional inputs: first a proxy column, then a constant; absent columns are added."""
    have = set(df.columns)
    out: dict[str, Column] = {}
    for c in [*proxies, *[d for d in defaults if d not in proxies]]:
        options = [F.col(n) for n in (c, proxies.get(c)) if n is not None and n in have]
        if c in defaults:
            options.append(F.lit(defaults[c]))
        if options:
            out[c] = F.coalesce(*options)
    return df.withColumns(out)


def align_columns(df: DataFrame, fitted: Sequence[str], fill: object = 0) -> DataFrame:
    """Exactly the fitted columns in the fitted order; absent ones are filled."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in fitted])


def select_candidates(df: DataFrame, candidates: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Those of the candidate columns that exist."""
    have = set(df.columns)
    return df.select(*[c for c in [*also, *candidates] if c in have])
