"""Grids over small tables: ensembles grow side by side, logistic grids share their passes."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator

from paceframe.operators import boosting, models
from paceframe.operators.boosting import Spec


def jobs(spark) -> int:
    """The highest number of a job so far."""
    spark.range(1).count()
    return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def table(spark, n=300):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 2)) * [3.0, 50.0]
    y = (x[:, 0] + x[:, 1] / 50 + rng.normal(size=n) > 0.7).astype(float)
    rows = [(i, float(a), float(b), float(t), 0.5 + float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, y double, w double")


def test_small_tables_grow_in_one_job_not_task_after_task(spark):
    df = models.assemble(table(spark), ["a", "b"], ["id", "y"])
    specs = [Spec(rounds=2, depth=2, seed=s, subsample=0.5) for s in range(24)]
    before = jobs(spark)
    fitted, _ = boosting.fit_many(df, "features", "y", specs, ["a", "b"], "id")
    assert all(len(m.trees) == 2 for m in fitted)
    assert jobs(spark) - before < 24


def test_tables_of_many_rows_need_no_pass_per_level(spark):
    """Rows of equal bins are added up, and what is left grows in tasks."""
    df = spark.range(70_000).selectExpr("id", "cast(id % 40 as double) a", "cast(id % 7 as double) b", "cast((id % 40) * (id % 7) + id % 3 as double) y")
    df = models.assemble(df, ["a", "b"], ["id", "y"])
    specs = [Spec(rounds=30, depth=3), Spec(growth="leaf", rounds=30, leaves=8), Spec(rounds=30, depth=3, subsample=0.5)]
    for some in (specs[:2], specs):
        before = jobs(spark)
        fitted, plain = boosting.fit_many(df, "features", "y", some, ["a", "b"], "id")
        assert jobs(spark) - before < 60 and plain.count() == 70_000
        assert all(len(m.trees) == 30 and m.trees[0].feature[0] >= 0 for m in fitted)


def test_cells_of_equal_bins_give_the_trees_of_single_rows(spark, monkeypatch):
    """A spec that draws rows keeps the rows single; the others of the same call learn the same from either."""
    df = spark.range(600).selectExpr("id", "cast(id % 9 as double) a", "cast(id % 5 as double) b", "cast((id % 9) * (id % 5) + id % 4 > 9 as double) y",
                                     "cast(id % 3 as int) fold", "1.0D + id % 2 w")
    df = models.assemble(df, ["a", "b"], ["id", "y", "fold", "w"])
    specs = [Spec(rounds=4, depth=3, loss="logistic", held_out=1), Spec(growth="leaf", rounds=4, leaves=6, weight="w", min_leaf=7), Spec(growth="oblivious", rounds=4, depth=3)]
    found = []
    for local_rows in (1 << 20, 0):
        monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
        for more in ([], [Spec(rounds=1, depth=1, subsample=0.5)]):
            found.append(boosting.fit_many(df, "features", "y", specs + more, ["a", "b"], "id", "fold")[0][:3])
    for other in found[1:]:
        for u, v in zip(found[0], other):
            for s, t in zip(u.trees, v.trees):
                assert (s.feature, s.cut, s.left, s.right) == (t.feature, t.cut, t.left, t.right)
                assert np.allclose(s.value, t.value)


def test_trees_of_tasks_and_of_passes_agree_in_every_growth(spark, monkeypatch):
    df = models.assemble(table(spark), ["a", "b"], ["id", "y"])
    specs = [
        Spec(rounds=3, depth=3, loss="logistic", subsample=0.7), Spec(growth="leaf", rounds=3, leaves=6, min_leaf=5),
        Spec(growth="oblivious", rounds=3, depth=3, l2=3.0, loss="logistic"),
    ]
    short, _ = boosting.fit_many(df, "features", "y", specs, ["a", "b"], "id")
    monkeypatch.setattr(boosting, "LOCAL_ROWS", 0)
    long, _ = boosting.fit_many(df, "features", "y", specs, ["a", "b"], "id")
    for u, v in zip(short, long):
        for s, t in zip(u.trees, v.trees):
            assert (s.feature, s.cut, s.left, s.right) == (t.feature, t.cut, t.left, t.right)
            assert np.allclose(s.value, t.value)


def test_logistic_grid_shares_passes_and_scores_as_cross_validation(spark):
    df = table(spark)
    grid = {"c": [0.001, 0.1, 10.0]}
    before = jobs(spark)
    found, rows = models.tune(df, ["a", "b"], "y", "logistic_regression", grid, "id", "classification", weight="w")
    assert jobs(spark) - before < 150  # fit by fit it is some hundreds
    got = [r["score"] for r in rows.orderBy("combination").collect()]

    data = models.assemble(models._folded(df, "id", "y", "classification", 5, 42), ["a", "b"], ["y", "fold", "w"]).persist()
    base = LogisticRegression(featuresCol="features", labelCol="y", weightCol="w", standardization=False, maxIter=1000, tol=1e-10)
    maps = [{base.regParam: 1.0 / (c * 300)} for c in grid["c"]]
    score = MulticlassClassificationEvaluator(labelCol="y", metricName="fMeasureByLabel", metricLabel=1.0)
    want = CrossValidator(estimator=base, estimatorParamMaps=maps, evaluator=score, numFolds=5, foldCol="fold").fit(data)
    assert np.allclose(got, want.avgMetrics)
    assert np.allclose(found.bestModel.coefficients.toArray(), want.bestModel.coefficients.toArray(), rtol=1e-3)


def test_logistic_grid_of_one_class_and_of_three(spark):
    df = table(spark, 60)
    none = df.withColumn("y", df["y"] * 0)
    _, rows = models.tune(none, ["a", "b"], "y", "logistic_regression", {"c": [1.0]}, "id", "classification")
    assert [r["score"] for r in rows.collect()] == [0.0]
    three = df.withColumn("y", (df["id"] % 3).cast("double"))
    model, rows = models.tune(three, ["a", "b"], "y", "logistic_regression", {"c": [1.0]}, "id", "classification")
    assert rows.count() == 1 and model.bestModel.numClasses == 3
