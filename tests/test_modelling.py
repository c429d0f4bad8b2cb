"""Encoders, scalers, metrics, models, flows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paceframe.operators import balance, cluster, encode, metrics, models, profile, scale, split
from paceframe.plans import defaults, scoring, segments


def test_target_encoding_unseen_and_null(spark):
    train = spark.createDataFrame([("a", 1.0)] * 3 + [("b", 0.0)], "k string, y double")
    fitted = encode.fit_target_encoding(train, "k", "y", smoothing=1.0, min_leaf=1.0)
    test = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    got = {r["k"]: r["e"] for r in encode.apply_target_encoding(test, fitted, "k", 0.75, "e").collect()}
    w = 1 / (1 + np.exp(-2))
    assert got["a"] == pytest.approx(w * 1 + (1 - w) * 0.75)
    assert got["z"] == got[None] == 0.75


def test_onehot_first_null_unseen(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "k string")
    fitted = encode.fit_many_categories(train, ["k"])
    assert fitted == {"k": ["a", "b", "c"]} == {"k": encode.fit_categories(train, "k")}
    assert [tuple(r) for r in encode.onehot_dropfirst(test, fitted).collect()] == [(0, 0), (1, 0), (0, 0), (0, 0)]
    with pytest.raises(ValueError):
        encode.fit_categories(train, "k", limit=2)


def test_label_codes_are_alphabetical(spark):
    df = spark.createDataFrame([("pear",), ("apple",), (None,), ("apricot",), ("pea",)], "k string")
    got = {r["value"]: r["code"] for r in encode.fit_labels(df, "k").collect()}
    assert got == {v: i for i, v in enumerate(sorted(["pear", "apple", "nan", "apricot", "pea"]))}


def test_scalers_handle_constants_and_round_trip(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (8.0, 5.0)], "x double, c double")
    for fit in (scale.fit_standard, scale.fit_minmax, scale.fit_robust):
        fitted = fit(df, ["x", "c"])
        out = fitted.transform(df)
        assert [r["c"] for r in out.collect()] == [0.0] * 3
        assert sorted(r["x"] for r in fitted.inverse(out).collect()) == pytest.approx([1.0, 3.0, 8.0])
        assert scale.Scaler.from_frame(fitted.to_frame(spark)) == fitted
    std = scale.fit_standard(df, ["x"])
    assert std.width["x"] == pytest.approx(np.std([1, 3, 8]))


def test_temporal_split_edges(spark):
    df = spark.createDataFrame([("2022-12-31",), ("2023-01-01",), (None,)], "d string").withColumn("d", F.to_date("d"))
    assert [r["split"] for r in split.split_temporal(df, "d", defaults.CUT_DATE).collect()] == ["train", "test", None]


@pytest.mark.parametrize("rows_per_bin", [10**6, 20])
def test_auc_and_average_precision_by_definition(spark, rows_per_bin):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.normal(size=400) + y * 0.7, 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s}))
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None]) + 0.5 * (pos[:, None] == neg[None])).mean()
    assert metrics.roc_auc(df, "y", "s", rows_per_bin).first()["roc_auc"] == pytest.approx(auc)
    ap, seen = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        recall, precision = (pos >= t).mean(), (y[s >= t] == 1).mean()
        ap, seen = ap + (recall - seen) * precision, recall
    assert metrics.average_precision(df, "y", "s", rows_per_bin).first()[0] == pytest.approx(ap)
    curve = metrics.roc_curve(df, "y", "s", rows_per_bin).toPandas().sort_values("threshold", ascending=False)
    assert curve["tpr"].is_monotonic_increasing and curve["tpr"].iloc[-1] == 1.0


def test_metrics_of_one_class_do_not_fail(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.4)], "y int, p int, s double")
    r = metrics.binary_metrics(df, "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert metrics.roc_auc(df, "y", "s").first()["roc_auc"] is None
    assert metrics.regression_metrics(df, "y", "s").first()["r2"] is None


def test_ranking_scorecard_report(spark):
    t = spark.createDataFrame([("a", 0.9), ("b", None), ("c", 0.9)], "model string, r2_test double")
    assert [r["model"] for r in metrics.rank_models(t, "r2_test").orderBy("rank").collect()] == ["a", "c", "b"]
    assert metrics.best_row(t, "r2_test", tie="model").first()["model"] == "a"
    assert models.select_top(metrics.rank_models(t, "r2_test"), 2) == ["a", "c"]
    m = spark.createDataFrame([("silhouette", 0.4, 0.4), ("dbi", 1.0, 2.0)], "metric string, a double, b double")
    assert tuple(metrics.scorecard(m, ["dbi"]).first()) == (1, 1, "b")


@pytest.fixture(scope="module")
def linear(spark):
    """y = 3 x0 + 2 x1 + noise, the seeded training fixture."""
    rng = np.random.default_rng(42)
    x = rng.normal(size=(160, 4))
    pdf = pd.DataFrame(x, columns=[f"x{i}" for i in range(4)])
    pdf["y"] = 3 * x[:, 0] + 2 * x[:, 1] + 0.1 * rng.normal(size=160)
    pdf["id"] = range(160)
    return split.split_hash(spark.createDataFrame(pdf), "id"), [f"x{i}" for i in range(4)]


def test_fit_regressors_and_skips(linear):
    df, names = linear
    fitted = models.fit_regressors(df, names, "y", names=("linear", "ridge", "decision_tree", "no such model"))
    table = {r["model"]: r for r in fitted.table.collect()}
    assert {m for m, r in table.items() if r["status"] == "ok"} == {"linear", "ridge", "decision_tree"}
    assert table["no such model"]["status"].startswith("failed") and "no such model" in fitted.failed
    assert table["linear"]["r2_test"] > 0.99 and table["linear"]["rank"] in (1, 2)
    checks = metrics.goal_checks(fitted.table).where("meets_goal").count()
    assert checks >= 2


def test_penalties_have_their_usual_meaning(linear):
    """Ridge and elastic net against a plain coordinate-free solution."""
    df, names = linear
    train = df.where("split = 'train'").toPandas()
    x, y = train[names].to_numpy(), train["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = models.fit_regressors(df, names, "y", names=("ridge",), params={"ridge": {"alpha": 50.0}}).models["ridge"]
    want = np.linalg.solve(xc.T @ xc + 50.0 * np.eye(4), xc.T @ yc)
    assert np.allclose(ridge.coefficients.toArray(), want, atol=1e-6)
    net = models.fit_regressors(df, names, "y", names=("elastic_net",), params={"elastic_net": {"alpha": 0.5}}).models["elastic_net"]
    b = np.zeros(4)
    for _ in range(2000):
        for j in range(4):
            r = yc - xc @ b + xc[:, j] * b[j]
            rho = xc[:, j] @ r / len(yc)
            b[j] = np.sign(rho) * max(abs(rho) - 0.25, 0) / (xc[:, j] @ xc[:, j] / len(yc) + 0.25)
    assert np.allclose(net.coefficients.toArray(), b, atol=1e-3)


def test_grid_search_folds_and_persistence(spark, linear, tmp_path):
    df, names = linear
    grid = defaults.REGRESSION_GRIDS["ridge"]
    assert [len(models.expand_grid(g)) for g in defaults.REGRESSION_GRIDS.values()] == [32, 4, 16, 16, 24]
    assert [len(models.expand_grid(g)) for g in defaults.CLASSIFICATION_GRIDS.values()] == [4, 48, 24, 16, 16, 16]
    model, table = models.tune(df, names, "y", "ridge", grid, "id", folds=3)
    scores = {r["params"]["alpha"]: r["score"] for r in table.collect()}
    assert len(scores) == 4 and max(scores, key=scores.get) in ("0.01", "0.1", "1.0")
    path = models.save_model(model.bestModel, str(tmp_path / "m"), "1")
    again = models.load_model(spark, path)
    assert np.allclose(again.coefficients.toArray(), model.bestModel.coefficients.toArray())


def test_unknown_estimator_is_none_and_unknown_parameter_fails():
    assert models.make_estimator("no such model", "regression", 10) is None
    with pytest.raises(ValueError):
        models.spark_params("ridge", {"colour": 1}, 10)


def test_classifier_with_weights(spark, linear):
    df, names = linear
    df = balance.class_weights(df.withColumn("c", (F.col("y") > 2).cast("int")), "c")
    fitted = models.fit_classifiers(df, names, "c", names=("logistic_regression",), weight="weight",
                                    params={"logistic_regression": {"c": 10.0}})
    row = fitted.table.first()
    assert row["f1"] > 0.9 and row["roc_auc"] > 0.97


def test_scenarios_change_only_their_inputs(spark):
    df = spark.createDataFrame([(1, 5, 2.0), (2, 9, 3.0)], "id int, grid int, pts double")
    got = scoring.with_scenarios(df, {"base": {}, "front": {"grid": F.lit(1)}})
    assert sorted(map(tuple, got.select("id", "scenario", "grid", "pts").collect())) == [
        (1, "base", 5, 2.0), (1, "front", 1, 2.0), (2, "base", 9, 3.0), (2, "front", 1, 3.0)]


def test_segments_separate_clear_groups(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(30, 3)) + c for c in ((0, 0, 0), (20, 0, 0), (0, 20, 5))])
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=range(90))
    model, rows = segments.train_segments(spark.createDataFrame(pdf), ["a", "b", "c"], 3, restarts=3)
    got = rows.toPandas().sort_values("id")
    assert got.groupby(np.repeat([0, 1, 2], 30))["cluster"].nunique().tolist() == [1, 1, 1]
    assert got["cluster"].nunique() == 3 and abs(got["pca_1"].mean()) < 1e-9
    table = segments.sweep(rows.select("id", "vec"), "id", (2, 3, 4), restarts=2)
    assert cluster.best_k(table).first()["k"] == 3
    linear_table = segments.sweep(rows.select("id", "vec"), "id", (2, 3), restarts=2, exact=False)
    assert cluster.best_k(linear_table).first()["k"] == 3


def _skewed_labels(spark, n=300):
    rng = np.random.default_rng(12)
    y = (rng.random(n) < 0.15).astype(int)
    x = rng.normal(size=n) + y
    rows = [(i, float(a), int(b), 3.0 if b else 1.0) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, x double, target int, weight double")


def test_weighing_makes_combinations_of_their_own(spark):
    grid = {"rounds": [3], "depth": [2], "balanced": [True, False], "positive": [None]}
    model, table = models.tune(_skewed_labels(spark), ["x"], "target", "random_forest", grid, "row_id", "classification", 2, weight="weight")
    assert table.count() == 2
    used = {m[model.getEstimator().weightCol] for m in model.getEstimatorParamMaps()}
    assert used == {"weight", "__w_one"}
    _, table = models.tune(
        _skewed_labels(spark), ["x"], "target", "boosting_depthwise", {"rounds": [1], "positive": [1.0, 4.0, 9.0]}, "row_id", "classification", 2, weight="weight")
    assert table.count() == 3


def test_a_failed_fit_is_a_row(spark):
    df = _skewed_labels(spark).withColumn("split", F.when(F.col("row_id") % 4 == 0, "test").otherwise("train"))
    out = models.fit_regressors(df, ["x"], "target", names=["linear", "decision_tree"], params={"decision_tree": {"depth": 99}})
    got = {r["model"]: r["status"] for r in out.table.collect()}
    assert got["linear"] == "ok" and got["decision_tree"].startswith("failed") and models.select_top(out.table, 5) == ["linear"]


def test_correlations_of_many_columns(spark):
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame(rng.normal(size=(400, 120)) + 1000.0, columns=[f"c{i}" for i in range(120)])
    pdf["c5"] = 7.0
    pdf.loc[::7, "c3"] = np.nan
    got = profile.corr_matrix(spark.createDataFrame(pdf), list(pdf.columns)).toPandas()
    want = pdf.corr()
    assert len(got) == 120 * 121 // 2
    have = got["corr"].to_numpy(dtype=float)
    full = np.array([want.loc[a, b] for a, b in zip(got["left_column"], got["right_column"])])
    assert np.allclose(have, full, atol=1e-9, equal_nan=True)
