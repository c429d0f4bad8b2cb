"""Column expressions shared by all operators. None of them needs a Python worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for a missing value in the raw files.
NULL_MARKERS = ("", "\\N", "NULL")
# Season length and session bounds used by the feature definitions.
ROUNDS_PER_SEASON = 24.0
LAST_GRID_SLOT = 24
EXTREME_ALTITUDE = 1000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column, markers: Sequence[str] = NULL_MARKERS) -> Column:
    """Replace every null marker by NULL; other text is untouched."""
    c = col(c)
    return F.when(~c.isin(*markers), c)


def to_number(c: str | Column) -> Column:
    """Text to double; anything unreadable, and NaN, becomes NULL."""
    v = col(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def to_moment(c: str | Column) -> Column:
    """Text to timestamp; unreadable text becomes NULL."""
    return col(c).try_cast("timestamp")


def flag(cond: Column) -> Column:
    """Condition to 0/1 where an unknown condition counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def present(c: str | Column) -> Column:
    return col(c).isNotNull().cast("int")


def years_between(year: str | Column, born: str | Column) -> Column:
    return col(year) - F.year(col(born))


def clock_to_ms(c: str | Column, strict: bool = False) -> Column:
    """Session time text (``M:SS.mmm``) to milliseconds.

    Only the first two ``:`` parts count. Without a colon the text is read as
    seconds, unless ``strict``, which demands exactly two parts.
    """
    c = col(c)
    parts = F.split(c, ":")
    minutes = F.get(parts, F.lit(0)).try_cast("int")
    seconds = F.get(parts, F.lit(1)).try_cast("double")
    clock = (minutes * 60 + seconds) * 1000
    if strict:
        return F.when(F.size(parts) == 2, clock)
    return F.when(c.contains(":"), clock).otherwise(c.try_cast("double") * 1000)


def guarded_ratio(num: str | Column, den: str | Column) -> Column:
    """num/den where den is positive, else 0."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0.0))


def share(num: Column, den: Column) -> Column:
    """num/den, NULL when den is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bands ``(lo, hi]``; values outside every band become NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    c = col(c)
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        cond = (c <= F.lit(hi)) if lo == float("-inf") else (c > F.lit(lo))
        if lo != float("-inf") and hi != float("inf"):
            cond = cond & (c <= F.lit(hi))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def pair_key(a: str | Column, b: str | Column, sep: str = "_") -> Column:
    """Interaction key; NULL if either part is NULL."""
    return F.concat(col(a).cast("string"), F.lit(sep), col(b).cast("string"))


def digest_number(key: Column, seed: int | str) -> Column:
    """32-bit number of a key: the same on every run and in every engine."""
    text = F.concat(key.cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def unit_hash(key: str | Column, seed: int | str = 42) -> Column:
    """Pseudo-random number in [0, 1) that depends on key and seed only."""
    return digest_number(col(key), seed) / F.lit(4294967296.0)


def hash_bucket(key: str | Column, buckets: int = 10_000, seed: int | str = "") -> Column:
    return digest_number(col(key), seed) % buckets


def clamped_interval(pred: Column, mae: float, lo: int = 1, hi: int = LAST_GRID_SLOT) -> tuple[Column, Column]:
    """Whole-number interval around a prediction, kept inside [lo, hi]."""
    low = F.greatest(F.lit(lo).cast("bigint"), F.floor(pred - F.lit(mae)))
    high = F.least(F.lit(hi).cast("bigint"), F.ceil(pred + F.lit(mae)))
    return low, high


def minutes_seconds(ms: str | Column) -> tuple[Column, Column]:
    """Whole minutes and remaining seconds of a millisecond value."""
    sec = col(ms) / F.lit(1000.0)
    whole = F.floor(sec / F.lit(60.0))
    return whole, sec - whole * F.lit(60.0)


def sq_distance(a: str | Column, b: str | Column) -> Column:
    """Squared Euclid distance of two array columns."""
    sq = F.zip_with(col(a), col(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x)


def euclid(a: str | Column, b: str | Column) -> Column:
    return F.sqrt(sq_distance(a, b))
