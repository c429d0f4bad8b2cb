"""Whole flows on the smallest tables: balance, training, persistence, scoring."""

import os

import pytest
from pyspark.sql import functions as F

from paceframe.plans import classification, regression, scoring
from paceframe.session import materialise
from paceframe.workload.flows import CUT, ERA, tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def prepared(spark):
    return regression.encode_flow(regression.prepare(tables(spark, FOLDER), ERA))


def test_encoders_survive_a_round_trip(spark, prepared, tmp_path):
    _, fitted = prepared
    fitted.save(spark, str(tmp_path / "e"))
    again = regression.Encoders.load(spark, str(tmp_path / "e"))
    assert (again.columns, again.categories) == (fitted.columns, fitted.categories)
    rows = regression.prepare(tables(spark, FOLDER), ERA)
    a = fitted.transform(rows, ("row_id",)).orderBy("row_id").limit(50).collect()
    b = again.transform(rows, ("row_id",)).orderBy("row_id").limit(50).collect()
    assert a == b


def test_regression_training_and_scoring(spark, prepared):
    df, fitted = prepared
    assert df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first().asDict() == dict.fromkeys(df.columns, 0)
    winner, model, table = regression.train(
        df, fitted.columns, names=("ridge", "lasso", "decision_tree"), grids={"ridge": {"alpha": [0.1, 1.0]}}, folds=3)
    assert winner == "ridge" and table.count() == 1  # the others have no grid
    entries = regression.prepare(tables(spark, FOLDER), ERA)
    out = scoring.score_model(entries, fitted, model, ["row_id"])
    assert out.count() == entries.count()
    assert out.where("low < 1 or high > 24 or pred is null").count() == 0


def test_training_with_the_default_folds(spark, prepared):
    df, fitted = prepared
    small = {"rounds": [2], "leaves": [4]}
    winner, model, table = regression.train(
        df, fitted.columns, names=("ridge", "boosting_leafwise"), grids={"ridge": {"alpha": [0.1, 1.0]}, "boosting_leafwise": small},
        params={"boosting_leafwise": {"rounds": 2}})
    assert winner == "ridge" and {r["model"] for r in table.collect()} == {"ridge", "boosting_leafwise"}


def test_classification_balance_and_training(spark):
    df, names = classification.encode_flow(classification.prepare(tables(spark, FOLDER), CUT))
    df = materialise(df)
    both = materialise(classification.balance_train(df, names))
    count = lambda d: {(r["split"], r["target"]): r["count"] for r in d.groupBy("split", "target").count().collect()}
    before, after = count(df), count(both)
    assert after[("train", 1)] == int(0.5 * before[("train", 0)])
    assert {k: v for k, v in after.items() if k != ("train", 1)} == {k: v for k, v in before.items() if k != ("train", 1)}
    assert both.count() == both.select("row_id").distinct().count()
    small = {"rounds": 5, "depth": 4}
    winner, _, table = classification.train(
        df, names, names=("random_forest",), grids={"random_forest": {k: [v] for k, v in small.items()}}, folds=2,
        params={"random_forest": small})
    assert winner == "random_forest" and 0 <= table.first()["f1"] <= 1


class Asked(Exception):
    pass


def test_registered_fits_are_whole(spark, monkeypatch):
    from __spark_entry__ import SMOKE_DIR, queries
    from paceframe.operators import models
    from paceframe.plans import classification, defaults, regression

    seen = []

    def note(*args, **kwargs):
        seen.append((args, kwargs))
        raise Asked

    known = queries()
    for module, name in ((models, "fit_regressors"), (models, "fit_classifiers"), (models, "tune_many"),
                         (models, "sample_then_full"), (regression, "train"), (classification, "train")):
        monkeypatch.setattr(module, name, note)
    calls = {}
    for name in ("fit_regressors", "fit_classifiers", "feature_importance", "tune_regressor", "tune_classifier",
                 "sample_then_full", "regression_train", "classification_train"):
        with pytest.raises(Asked):
            known[name](spark, SMOKE_DIR)
        calls[name] = seen.pop()
    assert not any("params" in kwargs for _, kwargs in calls.values())
    args, kwargs = calls["fit_classifiers"]
    assert kwargs["weight"] == "weight" and len(args[0].select("target", "weight").distinct().take(3)) == 2
    assert calls["tune_regressor"][0][4] == defaults.REGRESSION_GRIDS
    args, kwargs = calls["tune_classifier"]
    assert args[4].keys() == defaults.CLASSIFICATION_GRIDS.keys() and kwargs["weight"] == "weight"
    assert len(args[4]["boosting_depthwise"]["positive"]) == 3
    assert calls["sample_then_full"][1]["names"] == models.REGRESSORS


def test_distinct_laps_take_tasks_by_rows(spark):
    from paceframe.plans import laps

    rows = [(i % 7, None if i % 5 == 0 else float(i % 3), "x") for i in range(100)] + [(1, -0.0, "x"), (1, 0.0, "x")]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    few = laps.distinct_rows(df, 10)
    assert sorted(map(str, few.collect())) == sorted(map(str, df.dropDuplicates().collect()))
    assert few.rdd.getNumPartitions() == 11


def test_a_sweep_takes_distances_once(spark, monkeypatch):
    from paceframe.operators import cluster
    from paceframe.plans import segments

    rows = [(i, [float(i % 9), float(i * i % 17)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    asked, own = [], cluster.cluster_silhouettes
    monkeypatch.setattr(cluster, "cluster_silhouettes", lambda *a, **k: asked.append(a[3]) or own(*a, **k))
    got = {r["k"]: r["silhouette"] for r in segments.sweep(df, "id", (2, 3), restarts=2).collect()}
    both = {r["method"]: r["silhouette"] for r in segments.hierarchical_check(df, "id", 3).collect()}
    assert [len(a) for a in asked] == [2, 2] and all(-1 <= s <= 1 for s in [*got.values(), *both.values()])
    model = segments.fit_kmeans(df, 3, restarts=2)
    assert abs(cluster.silhouette(segments.label_rows(model, df), "id").first()["silhouette"] - got[3]) < 1e-12


def test_a_sweep_reads_equal_vectors_once_and_clusters_once(spark, monkeypatch):
    from paceframe.operators import cluster, kmeans
    from paceframe.plans import segments

    rows = [(i, [float(i % 5), float(i % 3)]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    read, spread = [], []
    monkeypatch.setattr(kmeans, "_sums", lambda r, c, own=kmeans._sums: read.append(r.count()) or own(r, c))
    monkeypatch.setattr(cluster, "_spread", lambda *a, own=cluster._spread: spread.append(a) or own(*a))
    got = {r["k"]: r for r in segments.sweep(df, "id", (2, 3), restarts=2).collect()}
    assert set(read) == {15} and len(spread) == 2
    for k in (2, 3):
        model = kmeans.fit_many(df, [k], restarts=2)[k]
        labelled = segments.label_rows(model, df)
        assert abs(got[k]["inertia"] - model.cost) < 1e-9 and abs(cluster.inertia(labelled).first()[0] - model.cost) < 1e-9
        assert abs(cluster.davies_bouldin(labelled).first()[0] - got[k]["davies_bouldin"]) < 1e-9
