"""Joins, cleaning, imputation, profiles on small hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceframe.operators import clean, entity, impute, joins, profile
from paceframe.session import materialise
from paceframe.sources import tables as src


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [(1, 100, 1, 10, 1.0), (2, 100, 2, 10, 2.0), (3, 100, 3, 20, None), (4, 101, 1, None, 3.0)],
        "result_id long, race_id long, driver_id long, team_id long, position double",
    )


def test_join_suffix_and_clash(spark, facts):
    dim = spark.createDataFrame([(10, "a", 5.0), (20, "b", 6.0)], "team_id long, name string, position double")
    out = joins.left_join(facts, dim, "team_id", suffix="_team")
    assert out.columns == [*facts.columns, "name", "position_team"]
    assert rows(out.select("result_id", "name"), "result_id") == [(1, "a"), (2, "a"), (3, "b"), (4, None)]
    with pytest.raises(ValueError):
        joins.left_join(facts, dim, "team_id")


def test_repeated_keys_multiply_unless_unique(spark, facts):
    side = spark.createDataFrame([(10, 1), (10, 2), (20, 3)], "team_id long, wins long")
    assert joins.left_join(facts, side, "team_id").count() == 6
    assert joins.left_join_unique(facts, side, "team_id", ["wins"]).count() == 4
    with pytest.raises(ValueError):
        joins.left_join_unique(facts, side, "team_id", ["wins"], validate=True)
    assert rows(joins.duplicate_keys(side, ["team_id"]), "team_id") == [(10, 2)]


def test_null_keys_match_only_on_request(spark, facts):
    side = spark.createDataFrame([(None, 9)], "team_id long, wins long")
    assert joins.left_join(facts, side, "team_id").where("wins is not null").count() == 0
    assert joins.left_join(facts, side, "team_id", null_safe=True).where("wins is not null").count() == 1


def test_empty_side_keeps_rows(spark, facts):
    none = spark.createDataFrame([], "race_id long, driver_id long, q long")
    out = joins.left_join(facts, none, ["race_id", "driver_id"])
    assert out.count() == 4 and out.where("q is not null").count() == 0


@pytest.mark.parametrize("year,kept", [(-1, False), (0, False), (3000, False), (2010, True), (2024, True), (None, False)])
def test_era(spark, year, kept):
    df = spark.createDataFrame([(year,)], "year int")
    assert (clean.keep_era(df, 2010, 2024).count() == 1) is kept


@pytest.mark.parametrize("position,kept", [("-1", False), ("0", False), ("25", True), ("31", False), ("R", False), (None, False)])
def test_finishers(spark, position, kept):
    df = spark.createDataFrame([(position,)], "position string")
    assert (clean.keep_finishers(df).count() == 1) is kept


def test_leaky_and_text_columns(spark):
    df = spark.createDataFrame([(1, 2, "a", "b", 3)], "grid int, points_x int, nationality string, url string, time int")
    assert clean.drop_leaky_and_text(df, ["points", "time"], ["nationality"]).columns == ["grid", "nationality"]


def test_align_and_defaults(spark):
    df = spark.createDataFrame([(1, None)], "a int, grid int")
    assert clean.align_columns(df, ["b", "a"]).first().asDict() == {"b": 0, "a": 1}
    got = clean.with_defaults(df, {"grid": "quali"}, {"grid": 7, "extra": 1.5}).first().asDict()
    assert got == {"a": 1, "grid": 7, "extra": 1.5}


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1, 5, 3.0), (1, None, 4.0), (2, None, 8.0), (2, None, None)], "race long, quali int, grid double"
    ).withColumn("i", F.monotonically_increasing_id())
    got = impute.fill_group_max_plus1(df, "quali", "race")
    assert sorted(r["quali"] for r in got.collect()) == [5, 6, 7, 7]
    fixed = impute.fill_group_max_plus1(df, "quali", "race", fallback=25)
    assert sorted(r["quali"] for r in fixed.collect()) == [5, 6, 25, 25]
    proxy = impute.fill_proxy_then_median(df, "quali", "grid")
    assert sorted(r["quali"] for r in proxy.collect()) == [4.0, 5.0, 5.0, 8.0]


def test_date_median_and_all_null_column(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2000, 1, 1), None), (d(2000, 1, 3), None), (None, None)], "dob date, x double")
    got = impute.fill_median(df, ["dob", "x"]).collect()
    assert sorted(r["dob"] for r in got) == [d(2000, 1, 1), d(2000, 1, 2), d(2000, 1, 3)]
    assert [r["x"] for r in got] == [None] * 3


def test_driver_profile_by_hand(spark):
    df = spark.createDataFrame(
        [(1, 1, "1", "1", 1), (2, 1, "\\N", "2", 3), (3, 1, "5", "R", 9), (1, 2, "2", "4", 4)],
        "race_id long, driver_id long, grid string, position string, position_order long",
    )
    names = spark.createDataFrame([(1, "one", "x")], "driver_id long, driver_ref string, nationality string")
    got = entity.driver_features(df, names, 3).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["total_races"], r["wins"], r["podiums"], r["top10"], r["dnfs"]) == (3, 1, 2, 3, 1)
    assert r["avg_grid"] == pytest.approx((1 + 20 + 5) / 3)
    assert r["avg_positions_gained"] == pytest.approx((0 + 18) / 2)
    assert r["driver_ref"] == "one"


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, 9), (1, 3), (1, 9), (1, 3), (2, None)], "k long, p long")
    assert rows(entity.main_partner(df, "k", "p"), "k") == [(1, 3)]


def test_profiles_of_odd_tables(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None)], "a double, b double")
    assert rows(profile.null_profile(df), "column_name") == [("b", 2, 100.0)]
    d = {r["column_name"]: r for r in profile.describe_numeric(df, ["a", "b"]).collect()}
    assert d["a"]["std"] == 0.0 and d["b"]["count"] == 0 and d["b"]["p50"] is None
    assert profile.histogram(df, "a", 4).collect()[0]["rows"] == 2
    assert profile.histogram(df, "b", 4).count() == 0
    assert profile.corr_matrix(df, ["a", "b"]).count() == 3


def test_outliers_keep_unknown_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(9999.0,), (None,)], "v double")
    assert profile.drop_outliers_iqr(df, "v").count() == 21


def test_sources_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i long, s string")
    src.write_csv(df.withColumn("s", F.coalesce("s", F.lit("\\N"))), str(tmp_path / "c"))
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("s", T.StringType())])
    assert rows(src.read_csv(spark, str(tmp_path / "c"), schema), "i") == [(1, "a"), (2, None)]
    v = src.write_versioned(df, str(tmp_path / "v"), "1")
    assert spark.read.parquet(v).count() == 2
    src.write_text(df.limit(1), "s", str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 1
    src.write_metrics_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert rows(materialise(df), "i") == [(1, "a"), (2, None)]


def test_input_checks(spark):
    df = spark.range(3)
    src.assert_inputs({"a": df})
    with pytest.raises(ValueError):
        src.assert_inputs({"a": df.limit(0)})
    with pytest.raises(ValueError):
        src.assert_inputs({"a": df}, required=6)
