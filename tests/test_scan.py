"""Two-level scans against brute force, with many bins and with a hot key."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paceframe.operators import history, metrics, quantiles, scan
from paceframe.operators.split import sample_share, split_exact, stratified_folds


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_over_bins(spark, descending):
    rng = np.random.default_rng(1)
    values = np.unique(np.concatenate([rng.normal(size=400), rng.exponential(size=200) * 100]))
    df = spark.createDataFrame(pd.DataFrame({"s": values, "n": rng.integers(0, 9, len(values))}))
    got = scan.running_totals(df, "s", {"n": "run"}, descending=descending, rows_per_bin=25).toPandas()
    want = df.toPandas().sort_values("s", ascending=not descending)
    want["run"] = want["n"].cumsum()
    merged = got.merge(want, on="s")
    assert len(merged) == len(values) and (merged["run_x"] == merged["run_y"]).all()


def test_running_totals_by_group(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "s": rng.permutation(500) * 1.0, "n": 1})
    got = scan.running_totals(spark.createDataFrame(pdf), "s", {"n": "run"}, by=["g"], rows_per_bin=50).toPandas()
    want = pdf.sort_values("s").assign(run=pdf.sort_values("s").groupby("g")["n"].cumsum())
    assert (got.sort_values("s")["run"].to_numpy() == want["run"].to_numpy()).all()


def test_hash_rank_is_a_permutation_per_group(spark):
    df = spark.range(3000).withColumn("g", (F.col("id") % 3 == 0).cast("int"))
    got = scan.hash_rank(df, "id", by=["g"]).toPandas()
    for _, part in got.groupby("g"):
        assert sorted(part["hash_rank"]) == list(range(1, len(part) + 1))
    again = scan.hash_rank(df.repartition(9), "id", by=["g"]).toPandas()
    assert got.sort_values("id")["hash_rank"].tolist() == again.sort_values("id")["hash_rank"].tolist()


def test_exact_split_folds_and_sample(spark):
    df = spark.range(1001).withColumn("label", (F.col("id") % 10 == 0).cast("int"))
    parts = {r["split"]: r["count"] for r in split_exact(df, "id").groupBy("split").count().collect()}
    assert parts == {"test": 201, "train": 800}
    assert sample_share(df, "id", 0.2).count() == 201
    folds = stratified_folds(df, "id", "label").groupBy("label", "fold").count().toPandas()
    for _, part in folds.groupby("label"):
        assert len(part) == 5 and part["count"].max() - part["count"].min() <= 1


@pytest.mark.parametrize("shape", ["smooth", "ties", "hot"])
def test_bracketed_quantiles_equal_numpy(spark, shape):
    rng = np.random.default_rng(3)
    n = 6000
    values = {"smooth": rng.normal(size=n), "ties": rng.integers(0, 4, n) * 1.0,
              "hot": np.where(rng.random(n) < 0.4, 7.0, rng.exponential(size=n) * 10)}[shape]
    pdf = pd.DataFrame({"g": np.where(rng.random(n) < 0.6, "a", "b"), "v": values})
    pdf.loc[5, "g"] = None
    df = spark.createDataFrame(pdf, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.group_quantiles(df, "g", "v", probs, exact_rows=0, accuracy=500).toPandas()
    for _, row in got.iterrows():
        part = pdf[pdf["g"].isna()] if row["g"] is None or row["g"] != row["g"] else pdf[pdf["g"] == row["g"]]
        want = part["v"].quantile(probs).to_numpy()
        assert np.allclose([row[quantiles.quantile_name(p)] for p in probs], want)
    assert len(got) == 3
    whole = quantiles.column_quantiles(df, ["v"], [0.25, 0.75], exact_rows=0, accuracy=500)["v"]
    assert np.allclose(whole, pdf["v"].quantile([0.25, 0.75]))


def test_quantiles_of_empty_and_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i int, v double")
    assert quantiles.column_quantiles(df, ["v"], [0.5])["v"] == [None]


def _brute(pdf):
    """History by the plain definition, row by row."""
    out = {}
    ordered = pdf.sort_values(["date", "race_id", "result_id"])
    for row in ordered.itertuples():
        past = ordered[(ordered["driver_id"] == row.driver_id) & (
            ordered[["date", "race_id", "result_id"]].apply(tuple, axis=1) < (row.date, row.race_id, row.result_id))]
        season = past[past["year"] == row.year]
        out[row.result_id] = (
            float(past["is_podium"].tail(5).sum()), float(season["is_podium"].mean()) if len(season) else 0.0,
            float((season["position_original"] == 1).sum()),
        )
    return out


@pytest.fixture(scope="module")
def skewed():
    """A third of all rows belong to one driver; some drivers have one row, some none."""
    rng = np.random.default_rng(4)
    n = 420
    day = pd.to_datetime("2015-01-01") + pd.to_timedelta(rng.integers(0, 1400, n), unit="D")
    pos = rng.integers(1, 12, n)
    return pd.DataFrame({
        "result_id": rng.permutation(n), "race_id": day.strftime("%Y%m%d").astype(int),
        "driver_id": np.where(rng.random(n) < 0.34, 1, rng.integers(2, 60, n)), "date": day, "year": day.year,
        "position_original": pos, "is_podium": (pos <= 3).astype(int),
    })


@pytest.mark.parametrize("hot_rows", [10**9, 40, 12])
def test_history_with_and_without_hot_slices(spark, skewed, hot_rows):
    df = spark.createDataFrame(skewed)
    got = history.driver_history(df.repartition(5), hot_rows=hot_rows).toPandas().set_index("result_id")
    want = _brute(skewed)
    assert len(got) == len(skewed)
    for rid, (last5, rate, wins) in want.items():
        row = got.loc[rid]
        assert row["driver_podiums_last_5"] == last5
        assert row["driver_podium_rate_season"] == pytest.approx(rate)
        assert row["driver_wins_season"] == wins


def test_history_of_the_reference_fixtures(spark):
    rows = [(i, i, 1, f"2020-01-0{i}", 2020, p, 1) for i, p in enumerate([1, 1, 0, 1], 1)]
    df = spark.createDataFrame(rows, "result_id long, race_id long, driver_id long, d string, year long, is_podium int, position_original int")
    got = history.driver_history(df.withColumn("date", F.to_date("d"))).orderBy("race_id")
    assert [r["driver_podiums_last_5"] for r in got.collect()] == [0.0, 1.0, 2.0, 2.0]


def test_rows_without_a_key_have_no_history(spark):
    rows = [(i, i, None, f"2020-01-0{i}", 2020, 1, 1) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "result_id long, race_id long, driver_id long, d string, year long, is_podium int, position_original int")
    got = history.driver_history(df.withColumn("date", F.to_date("d"))).collect()
    assert [r["driver_podiums_last_5"] for r in got] == [0.0] * 5
    assert [r["driver_podium_rate_season"] for r in got] == [0.0] * 5


def test_team_event_unit_does_not_see_the_same_event(spark):
    rows = [(1, 10, 7, "2020-01-01", 2020, 1), (2, 10, 7, "2020-01-01", 2020, 1), (3, 11, 7, "2020-01-08", 2020, 0)]
    df = spark.createDataFrame(rows, "result_id long, race_id long, team_id long, d string, year long, is_podium int").withColumn("date", F.to_date("d"))
    by_row = {r["result_id"]: r["team_podiums_last_5"] for r in history.team_history(df).collect()}
    by_event = {r["result_id"]: r["team_podiums_last_5"] for r in history.team_history(df, unit="event").collect()}
    assert by_row == {1: 0.0, 2: 1.0, 3: 2.0}
    assert by_event == {1: 0.0, 2: 0.0, 3: 2.0}


def _hard_rows(kind):
    """One busy driver and some others, with NULL dates, equal instants, or dates as text."""
    rng = np.random.default_rng(5)
    n = 90
    day = pd.to_datetime("2015-01-01") + pd.to_timedelta(rng.integers(0, 900, n), unit="D")
    pdf = pd.DataFrame({
        "result_id": rng.permutation(n), "race_id": rng.integers(0, 30, n), "driver_id": np.where(rng.random(n) < 0.7, 1, rng.integers(2, 9, n)),
        "day": day.strftime("%Y-%m-%d"), "position_original": rng.integers(1, 5, n),
    })
    pdf["year"] = day.year
    if kind == "ties":
        pdf["day"] = "2016-02-03"
    pdf["is_podium"] = (pdf["position_original"] <= 3).astype(int)
    if kind == "nulls":
        pdf.loc[pdf["result_id"] % 5 == 0, ["day", "year"]] = None
    return pdf


@pytest.mark.parametrize("kind", ["nulls", "ties", "text"])
@pytest.mark.parametrize("hot_rows", [20, 7])
def test_hot_slices_agree_with_whole_windows(spark, kind, hot_rows):
    pdf = _hard_rows(kind)
    df = spark.createDataFrame(
        pdf.astype(object).where(pdf.notna(), None),
        "result_id long, race_id long, driver_id long, day string, position_original long, year long, is_podium long",
    )
    df = df.withColumnRenamed("day", "date") if kind == "text" else df.withColumn("date", F.to_date("day")).drop("day")
    whole = history.driver_history(df, hot_rows=10**9).orderBy("result_id").toPandas()
    cut = history.driver_history(df, hot_rows=hot_rows).orderBy("result_id").toPandas()
    for c in ("driver_podiums_last_5", "driver_podium_rate_season", "driver_wins_season"):
        assert np.allclose(whole[c], cut[c]), c


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_with_null_and_nan(spark, descending):
    rows = [(None, 5), (float("nan"), 7)] + [(float(i), i % 4) for i in range(60)]
    df = spark.createDataFrame(rows, "s double, n int")
    one = {repr(r["s"]): r["run"] for r in scan.running_totals(df, "s", {"n": "run"}, descending=descending).collect()}
    many = {repr(r["s"]): r["run"] for r in scan.running_totals(df, "s", {"n": "run"}, descending=descending, rows_per_bin=9).collect()}
    assert one == many and len(one) == 62


def test_average_precision_with_null_scores(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.random() < 0.2), None if rng.random() < 0.1 else float(rng.random())) for _ in range(500)]
    df = spark.createDataFrame(rows, "y int, s double")
    one = metrics.average_precision(df, "y", "s").first()[0]
    assert metrics.average_precision(df, "y", "s", rows_per_bin=20).first()[0] == pytest.approx(one)


def test_label_codes_of_values_with_one_prefix(spark):
    df = spark.createDataFrame([(f"Customer#{i:05d}",) for i in range(700)] + [(None,)], "c string")
    got = scan.sorted_rank(df.select(F.coalesce("c", F.lit("nan")).alias("c")), ["c"], "r", rows_per_slice=50).orderBy("c").toPandas()
    assert got["r"].tolist() == list(range(701))
