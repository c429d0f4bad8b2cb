"""Exact neighbour operators against brute force, over many small blocks and with many copies."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paceframe.operators import anomaly, balance, cluster, neighbors


def vectors(n=260, d=5, copies=0.0, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d)) * 4
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, d))
    x[rng.random(n) < copies] = x[0]
    return x


def frame(spark, x, **cols):
    rows = [(i, [float(v) for v in r], *[int(c[i]) for c in cols.values()]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ", ".join(["id long", "vec array<double>", *[f"{c} long" for c in cols]]))


def brute(q, b, k, exclude):
    d = np.sqrt(((q[:, None, :] - b[None, :, :]) ** 2).sum(-1))
    if exclude:
        np.fill_diagonal(d, np.inf)
    return {i: [(int(j), d[i, j]) for j in np.lexsort((np.arange(len(b)), d[i]))[:k] if np.isfinite(d[i, j])]
            for i in range(len(q))}


@pytest.mark.parametrize("copies,block", [(0.0, 16), (0.35, 16), (0.35, 1000), (1.0, 16)])
def test_self_join(spark, copies, block):
    x = vectors(copies=copies)
    df = frame(spark, x)
    got = neighbors.knn_join(df, df, 4, exclude_self=True, block_rows=block).toPandas()
    want = brute(x, x, 4, True)
    assert len(got) == 4 * len(x)
    for i, part in got.groupby("id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == [1, 2, 3, 4]
        assert part["neighbor_id"].tolist() == [j for j, _ in want[i]]
        assert np.allclose(part["distance"], [v for _, v in want[i]])


def test_two_tables_and_short_base(spark):
    q, b = vectors(40, seed=1), vectors(70, seed=2)
    got = neighbors.knn_join(frame(spark, q), frame(spark, b), 3, block_rows=8).toPandas()
    want = brute(q, b, 3, False)
    for i, part in got.groupby("id"):
        assert part.sort_values("rank")["neighbor_id"].tolist() == [j for j, _ in want[i]]
    few = neighbors.knn_join(frame(spark, q), frame(spark, b[:2]), 3).toPandas()
    assert len(few) == 2 * len(q)
    assert neighbors.knn_join(frame(spark, q), frame(spark, b).limit(0), 3).count() == 0


def silhouettes(x, c):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a, b = d[i, own].mean(), min(d[i, c == k].mean() for k in set(c) - {c[i]})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return np.array(out)


@pytest.mark.parametrize("copies,block", [(0.0, 16), (0.35, 16), (0.35, 1000)])
def test_silhouette(spark, copies, block):
    x = vectors(120, copies=copies)
    c = np.arange(120) % 4
    c[7] = 9  # a cluster of one
    df = frame(spark, x, cluster=c)
    got = cluster.silhouette_samples(df, "id", block_rows=block).toPandas().sort_values("id")
    assert np.allclose(got["silhouette"], silhouettes(x, c))
    assert got["silhouette"].between(-1, 1).all()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_not_shuffled_and_vectors_stay_off_the_driver(spark):
    df = frame(spark, vectors(120), cluster=np.arange(120) % 3)
    joined = plan_of(neighbors.knn_join(df, df, 4, exclude_self=True, block_rows=16))
    assert "CartesianProduct" in joined and "BroadcastHashJoin" not in joined
    scored = plan_of(cluster.silhouette_samples(df, "id", block_rows=16))
    assert "CartesianProduct" in scored and "BroadcastHashJoin" not in scored
    label = df.withColumn("label", (F.col("cluster") == 0).cast("int"))
    made = plan_of(balance.smote_rows(label, "id", "vec", "label", ratio=0.9, k=3, block_rows=16))
    assert all("vec#" not in line and "near#" not in line for line in made.split("\n") if "BroadcastExchange" in line)
    assert made.count("SortMergeJoin") > joined.count("SortMergeJoin")


def test_silhouettes_of_several_clusterings(spark):
    x = vectors(120, copies=0.3)
    a, b = np.arange(120) % 4, np.arange(120) % 3
    a[7] = 9  # a cluster of one
    rows = [(i, [float(v) for v in r], int(a[i]), None if i % 11 == 5 else f"g{b[i]}") for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, a long, b string")
    got = cluster.silhouettes(df, "id", ["a", "b"], block_rows=16, prefix="").toPandas().sort_values("id")
    assert np.allclose(got["a"], silhouettes(x, a))
    known = np.arange(120) % 11 != 5
    assert np.allclose(got["b"][known], silhouettes(x[known], b[known])) and got["b"][~known].isna().all()


def test_text_ids_break_ties(spark):
    x = [0.0, 1.0, 1.0, -1.0, 2.0]
    df = spark.createDataFrame([(k, [v]) for k, v in zip("cadbe", x)], "id string, vec array<double>")
    got = neighbors.knn_join(df, df, 2, exclude_self=True, block_rows=2)
    near = {}
    for r in got.orderBy("id", "rank").collect():
        near.setdefault(r["id"], []).append(r["neighbor_id"])
    assert near == {"c": ["a", "b"], "a": ["d", "c"], "d": ["a", "c"], "b": ["c", "a"], "e": ["a", "d"]}


def test_lof_with_small_blocks(spark):
    x = vectors(150)
    got = anomaly.lof_scores(frame(spark, x), "id", k=6, block_rows=16).toPandas().sort_values("id")
    near = brute(x, x, 6, True)
    kd = {i: n[-1][1] for i, n in near.items()}
    lrd = {i: 1 / (np.mean([max(kd[j], v) for j, v in n]) + 1e-10) for i, n in near.items()}
    want = [-np.mean([lrd[j] for j, _ in near[i]]) / lrd[i] for i in range(len(x))]
    assert np.allclose(got["lof_score"], want)


def test_smote_rows_lie_on_segments_and_reach_the_ratio(spark):
    x = vectors(200)
    label = (np.arange(200) % 8 == 0).astype(int)
    df = frame(spark, x, label=label)
    got = balance.smote_rows(df, "id", "vec", "label", ratio=0.5, k=3, block_rows=16).toPandas()
    assert len(got) == int(0.5 * (label == 0).sum()) - label.sum()
    for r in got.itertuples():
        a, b, s = x[r.base_id], x[r.neighbor_id], np.array(r.vec)
        assert label[r.base_id] == label[r.neighbor_id] == 1
        assert np.linalg.norm(s - a) + np.linalg.norm(s - b) == pytest.approx(np.linalg.norm(a - b))
    again = balance.smote_rows(df.repartition(3), "id", "vec", "label", ratio=0.5, k=3, block_rows=64).toPandas()
    key = ["base_id", "copy"]
    pd.testing.assert_frame_equal(
        got.sort_values(key)[key + ["neighbor_id"]].reset_index(drop=True),
        again.sort_values(key)[key + ["neighbor_id"]].reset_index(drop=True))


def test_one_class_is_an_error(spark):
    df = frame(spark, vectors(20), label=np.zeros(20))
    with pytest.raises(ValueError):
        balance.smote_rows(df, "id", "vec", "label")


def test_isolation_finds_the_far_points(spark):
    x = np.vstack([vectors(300, seed=3), np.full((3, 5), 60.0)])
    scored = anomaly.isolation_scores(frame(spark, x), "id")
    got = scored.toPandas().set_index("id")["isolation_score"]
    assert got.between(-1, 0).all()
    assert set(got.nsmallest(3).index) == {300, 301, 302}
    again = anomaly.isolation_scores(frame(spark, x).repartition(7), "id").toPandas().set_index("id")["isolation_score"]
    assert np.allclose(got.sort_index(), again.sort_index())
    share = anomaly.flag_lowest(scored, "isolation_score").where("is_anomaly").count() / len(x)
    assert abs(share - 0.1) < 0.02


def test_consensus_counts_unknown_flags_as_no(spark):
    df = spark.createDataFrame([(True, True, None), (False, True, None), (None, None, None)], "a boolean, b boolean, c boolean")
    got = [tuple(r) for r in anomaly.consensus(df, ["a", "b", "c"]).select("anomaly_votes", "is_anomaly_final").collect()]
    assert got == [(2, True), (1, False), (0, False)]


def test_assign_and_centroids(spark):
    x = vectors(60)
    df = frame(spark, x, cluster=np.arange(60) % 3)
    cents = cluster.centroids(df)
    for r in cents.collect():
        assert np.allclose(r["centroid"], x[np.arange(60) % 3 == r["cluster"]].mean(axis=0))
    got = cluster.assign_nearest(df, cents).toPandas().sort_values("id")
    c = np.array([r["centroid"] for r in cents.orderBy("cluster").collect()])
    assert got["assigned"].tolist() == ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1).tolist()
    assert cluster.name_clusters(df, {0: "a", 1: "b"}).where(F.col("cluster_name").isNull()).count() == 20
