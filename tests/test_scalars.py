import datetime as dt

import pytest
from pyspark.sql import functions as F

from paceframe.functions import scalars as S


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr.alias("o")).orderBy("i").collect()]


def test_markers_become_null(spark):
    assert one(spark, ["1", "\\N", "NULL", "", None, "x"], S.blank_to_null("v")) == ["1", None, None, None, None, "x"]


def test_numbers_that_cannot_be_read_become_null(spark):
    assert one(spark, ["1.5", "R", "NaN", None, "\\N"], S.to_number("v")) == [1.5, None, None, None, None]


def test_dates_that_cannot_be_read_become_null(spark):
    got = one(spark, ["2020-01-02", "x", None], S.to_moment("v"))
    assert got == [dt.datetime(2020, 1, 2), None, None]


@pytest.mark.parametrize("strict,want", [
    (False, [83456.0, 95000.0, None, None, 62000.0, None]),
    (True, [83456.0, None, None, None, None, None]),
])
def test_clock_text(spark, strict, want):
    texts = ["1:23.456", "95", "\\N", None, "1:02:03", "a:b"]
    got = one(spark, texts, S.clock_to_ms("v", strict))
    assert [None if g is None else round(g, 6) for g in got] == want


def test_bands_are_right_closed_and_open_below(spark):
    got = one(spark, [0.0, 0.33, 0.5, 1.0, 1.1, None], S.band("v", (0.0, 0.33, 0.66, 1.0), ("a", "b", "c")), "double")
    assert got == [None, "a", "b", "c", None, None]
    inf = float("inf")
    assert one(spark, [-5.0, 100.0, 600.0, 601.0], S.band("v", (-inf, 100, 600, inf), ("l", "m", "h")), "double") == [
        "l", "l", "m", "h"]


def test_flags_and_ratio_treat_unknown_as_zero(spark):
    assert one(spark, [1, 3, 4, None], S.flag(F.col("v") <= 3), "int") == [1, 1, 0, 0]
    assert one(spark, [2.0, 0.0, -1.0, None], S.guarded_ratio(F.lit(1.0), "v"), "double") == [0.5, 0.0, 0.0, 0.0]


def test_interval_is_clamped(spark):
    low, high = S.clamped_interval(F.col("v"), 2.5)
    assert one(spark, [1.0, 12.2, 23.9], low, "double") == [1, 9, 21]
    assert one(spark, [1.0, 12.2, 23.9], high, "double") == [4, 15, 24]


def test_unit_hash_is_uniform_and_stable(spark):
    df = spark.range(20_000)
    share = df.where(S.unit_hash("id") < 0.2).count() / 20_000
    assert abs(share - 0.2) < 0.01
    a = df.select(S.unit_hash("id").alias("u")).agg(F.sum("u")).first()[0]
    b = df.repartition(7).select(S.unit_hash("id").alias("u")).agg(F.sum("u")).first()[0]
    assert a == pytest.approx(b)
