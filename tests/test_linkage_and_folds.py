"""Fold statistics, Ward linkage, ordered codes and isolation samples against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paceframe.operators import anomaly, encode, fold_statistics, kmeans, models, split, ward


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(240, 3)) * [1, 5, 0.2] + [1e4, -3, 7]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(id=range(240))
    pdf["y"] = x @ [2, -1, 4] + rng.normal(size=240)
    df = split.hash_folds(spark.createDataFrame(pdf), "id").withColumn("features", F.array("a", "b", "c"))
    return df.repartition(5), df.toPandas()


def plain_fit(kind, alpha, x, y):
    xc, yc = x - x.mean(0), y - y.mean()
    if kind in ("linear", "ridge"):
        b = np.linalg.solve(xc.T @ xc + (alpha if kind == "ridge" else 0) * np.eye(x.shape[1]), xc.T @ yc)
    else:
        l1, l2 = (alpha, 0) if kind == "lasso" else (alpha / 2, alpha / 2)
        b = np.zeros(x.shape[1])
        for _ in range(5000):
            for j in range(len(b)):
                r = xc[:, j] @ (yc - xc @ b + xc[:, j] * b[j]) / len(y)
                b[j] = np.sign(r) * max(abs(r) - l1, 0) / (xc[:, j] @ xc[:, j] / len(y) + l2)
    return b, y.mean() - b @ x.mean(0)


@pytest.mark.parametrize("kind, alphas", [("linear", [0.0]), ("ridge", [0.1, 30.0]), ("lasso", [0.05, 1.0]), ("elastic_net", [0.3])])
def test_grid_from_fold_statistics(rows, kind, alphas):
    df, pdf = rows
    parts = fold_statistics.moments(df, "features", "y", "fold")
    got = {(a, k): v for a, k, v in fold_statistics.fold_scores(parts, kind, alphas, 5)}
    x, y = pdf[["a", "b", "c"]].to_numpy(), pdf["y"].to_numpy()
    for a in alphas:
        for k in range(5):
            test = (pdf["fold"] == k).to_numpy()
            b, c = plain_fit(kind, a, x[~test], y[~test])
            want = 1 - ((y[test] - x[test] @ b - c) ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum()
            assert got[a, k] == pytest.approx(want, abs=1e-6)


def test_linear_grid_equals_cross_validation(rows):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    df, _ = rows
    data = models.assemble(df, ["a", "b", "c"], ["y", "fold"])
    base = models.make_estimator("linear", "regression", 240, label="y")
    model = CrossValidator(estimator=base, estimatorParamMaps=[{}], evaluator=RegressionEvaluator(labelCol="y", metricName="r2"), numFolds=5, foldCol="fold").fit(data)
    tuned, table = models.tune(df.drop("fold"), ["a", "b", "c"], "y", "linear", {}, "id")
    assert table.first()["score"] == pytest.approx(model.avgMetrics[0], abs=1e-6)
    assert np.allclose(tuned.bestModel.coefficients.toArray(), [2, -1, 4], atol=0.6)


def test_learning_curve_equals_single_fits(rows):
    df, _ = rows
    got = models.learning_curve(df, ["a", "b", "c"], "y", "id", ("ridge", "lasso"), steps=3, folds=2).toPandas()
    steps = split.nested_subsets(df.drop("fold"), "id", 3, 2).toPandas()
    assert len(got) == 2 * 2 * 3
    for r in got.itertuples():
        train = steps[(steps["fold"] != r.held_out) & (steps["step"] <= r.curve_step)]
        test = steps[steps["fold"] == r.held_out]
        b, c = plain_fit(r.model, 1.0, train[["a", "b", "c"]].to_numpy(), train["y"].to_numpy())
        y = test["y"].to_numpy()
        want = 1 - ((y - test[["a", "b", "c"]].to_numpy() @ b - c) ** 2).sum() / ((y - y.mean()) ** 2).sum()
        assert r.train_rows == len(train) and r.r2 == pytest.approx(want, abs=1e-6)


def test_boosting_learning_curve_uses_the_steps(rows):
    df, _ = rows
    small = {"boosting_leafwise": {"rounds": 3, "leaves": 4, "min_leaf": 2}}
    got = models.learning_curve(df, ["a", "b", "c"], "y", "id", ("boosting_leafwise",), 2, 2, params=small).toPandas()
    sizes = split.learning_curve_sizes(df.drop("fold"), "id", 2, 2).toPandas().sort_values(["held_out", "curve_step"])
    assert got.sort_values(["held_out", "curve_step"])["train_rows"].tolist() == sizes["train_rows"].tolist()
    assert got["r2"].notna().all()


def test_folds_are_not_the_test_part(spark):
    df = split.hash_folds(split.split_hash(spark.range(1000), "id"), "id").groupBy("split", "fold").count()
    assert df.count() == 10 and df.agg(F.min("count")).first()[0] > 10


def test_cells_of_edge_tables(spark):
    df = spark.createDataFrame([([1.0], 2.0, 0), ([1.0], None, 0), ([3.0], 2.0, None)], "features array<double>, y double, fold int")
    parts = fold_statistics.moments(df, "features", "y", "fold")
    assert list(parts) == [0] and parts[0].n == 1
    assert fold_statistics.fold_scores(parts, "ridge", [1.0], 2) == []
    assert fold_statistics.moments(df.where("y > 9"), "features", "y", "fold") == {}
    b, c = fold_statistics.solve(parts[0], "linear", 0.0)
    assert b.tolist() == [0.0] and c == 2.0 and fold_statistics.r2(parts[0], b, c) is None


def plain_ward(x, n):
    """Heights of one-by-one Ward merges."""
    items = [(k, np.array(v, float)) for k, v in zip(n, x)]
    heights = []
    while len(items) > 1:
        cost, i, j = min(
            (a * b / (a + b) * ((u - v) ** 2).sum(), i, j)
            for i, (a, u) in enumerate(items) for j, (b, v) in enumerate(items) if i < j)
        heights.append(np.sqrt(2 * cost))
        (a, u), (b, v) = items[i], items[j]
        items = [p for k, p in enumerate(items) if k not in (i, j)] + [(a + b, (a * u + b * v) / (a + b))]
    return sorted(heights)


def test_ward_equals_one_by_one_merges(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(15, 2)) + c for c in ((0, 0), (8, 0), (0, 8), (9, 9))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(60, x[0].tolist()), (61, None)], "id long, vec array<double>").repartition(3)
    tree = ward.linkage(df)
    order = sorted(map(tuple, x.tolist()))
    sizes = [2.0 if v == tuple(x[0].tolist()) else 1.0 for v in order]
    assert np.allclose([m[2] for m in tree.merges], plain_ward(order, sizes))
    got = tree.label(4).toPandas().sort_values("id")
    assert got["cluster"][:60].groupby(np.repeat(range(4), 15)).nunique().tolist() == [1] * 4 and got["cluster"].nunique() == 4
    assert got.set_index("id")["cluster"].isna().tolist() == [False] * 61 + [True]


def test_ward_of_ties_and_few_rows(spark):
    square = [[0.0, 0.0], [0.0, 1.0], [1.0, 0.0], [1.0, 1.0], [5.0, 5.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(square)], "id long, vec array<double>")
    assert np.allclose([m[2] for m in ward.linkage(df).merges], plain_ward(square, [1.0] * 5))
    for n in (0, 1):
        tree = ward.linkage(df.where(F.col("id") < n))
        assert tree.merges == [] and tree.label(3).count() == n


def test_ward_has_a_leaf_for_every_distinct_vector(spark):
    """No number of distinct vectors turns the leaves into cells of many."""
    x = np.random.default_rng(8).normal(size=(4400, 2)) + np.repeat([[0, 0], [40, 0], [0, 40], [40, 40]], 1100, axis=0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    tree = ward.linkage(df)
    assert len(tree.leaves) == 4400 and len(tree.merges) == 4399 and tree.merges[-1][3] == 4400
    got = tree.label(4).toPandas().sort_values("id")
    assert got.groupby(np.repeat(range(4), 1100))["cluster"].nunique().tolist() == [1] * 4 and got["cluster"].nunique() == 4


def test_ward_over_blocks_merges_like_ward_in_tasks(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = np.vstack([np.round(rng.normal(size=(120, 3)), 1), rng.integers(0, 4, (60, 3)) + 5.0])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(180, x[0].tolist()), (181, None)], "id long, vec array<double>").repartition(3)
    whole = ward.linkage(df)
    monkeypatch.setattr(ward, "MOST", 9)
    monkeypatch.setattr(ward, "BLOCK_ROWS", 16)
    blocks = ward.linkage(df)
    assert len(blocks.early) > 1 and not whole.early and len(blocks.late) < 9
    place = [{leaf: i for i, leaf in enumerate(t.leaves)} for t in (whole, blocks)]
    one, two = ([(at[a], at[b], n) for a, b, _, n in t.merges] for t, at in zip((whole, blocks), place))
    assert one == two and np.allclose([m[2] for m in whole.merges], [m[2] for m in blocks.merges], rtol=1e-12)
    for k in (1, 2, 5, 40, 500):
        a, b = (t.label(k).toPandas().sort_values("id") for t in (whole, blocks))
        assert a["cluster"].fillna(-1).tolist() == b["cluster"].fillna(-1).tolist() and a["cluster"].nunique() == min(k, len(whole.leaves))


def test_ward_of_cluster_features(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(size=(100, 2)) + c for c in ((0, 0), (30, 0), (0, 30))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    tree = ward.linkage(df, most=20)
    assert len(tree.leaves) <= 20 and tree.merges[-1][3] == 300
    got = tree.label(3).toPandas().sort_values("id")
    assert got.groupby(np.repeat([0, 1, 2], 100))["cluster"].nunique().tolist() == [1, 1, 1]


def test_no_row_sees_its_own_label(spark):
    pdf = pd.DataFrame({"id": range(60), "k": ["hot"] * 50 + ["cold"] * 8 + [None] * 2, "y": np.arange(60.0)})
    pdf.loc[5, "y"] = np.nan
    code = lambda p: encode.ordered_target_codes(
        spark.createDataFrame(p).withColumn("y", F.nanvl("y", F.lit(None).cast("double"))), "k", "y", "id", 3.0, digits=1).toPandas().set_index("id")["code"]
    first = code(pdf)
    for i in (0, 17, 49, 55):
        assert code(pdf.assign(y=pdf["y"].where(pdf["id"] != i, 1e6)))[i] == first[i]
    assert (first == 3.0).sum() >= 3  # the first of each category has the prior


def test_isolation_samples_are_the_first_of_each_order(spark):
    n, trees, k = 500, 7, 20
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(n)] + [(n, None)], "id long, vec array<double>").repartition(6)
    got = anomaly.isolation_samples(df, "id", trees=trees, subsample=k).toPandas()
    base = {r["id"]: r["b"] for r in spark.range(n).select("id", anomaly.digest_number(F.col("id"), 42).alias("b")).collect()}
    for t in range(trees):
        factor, shift = anomaly._turn(t)
        want = sorted(base, key=lambda i: ((base[i] * factor + shift) % anomaly.PRIME, i))[:k]
        assert sorted(got[got["tree"] == t]["id"]) == sorted(want)
    scores = anomaly.isolation_scores(df.where("id < 300").unionByName(spark.createDataFrame([(999, [9e3, -9e3])], df.schema)), "id", trees=50).toPandas()
    assert scores.loc[scores["isolation_score"].idxmin(), "id"] == 999


def test_kmeans_of_many_candidates(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(40, 3)) + c for c in ((0, 0, 0), (12, 0, 0), (0, 12, 5), (9, 9, 9))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(999, None)], "id long, vec array<double>").repartition(4)
    passes = []
    monkeypatch.setattr(kmeans, "_sums", lambda rows, c, old=kmeans._sums: passes.append(len(c)) or old(rows, c))
    found = kmeans.fit_many(df, [2, 4, 200], restarts=5)
    assert passes[0] == 15 and len(passes) <= kmeans.STEPS  # all candidates share the scans
    for k in (2, 4):
        p = found[k].points
        own = ((x[:, None] - p[None]) ** 2).sum(2)
        assert found[k].cost == pytest.approx(own.min(1).sum())
        moved = np.array([x[own.argmin(1) == i].mean(0) for i in range(k)])
        assert np.allclose(moved, p, atol=1e-3)  # a further step changes nothing
    assert found[200].getK() == 160 and found[200].cost == pytest.approx(0.0)
    got = df.withColumn("c", found[4].nearest("vec")).toPandas().sort_values("id")
    assert got["c"][:160].groupby(np.repeat(range(4), 40)).nunique().tolist() == [1] * 4 and np.isnan(got["c"].iloc[-1])
    assert kmeans.fit_many(df.limit(0), [3])[3].getK() == 0
