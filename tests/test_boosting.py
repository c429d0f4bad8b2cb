"""Batched boosting against plain trees that are grown row by row on one machine."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paceframe.operators import boosting
from paceframe.operators.boosting import Boosted, Spec

NAMES = ["a", "b", "c"]


def data(n=300, seed=3, classes=False):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), np.round(rng.normal(size=n), 1), rng.integers(0, 3, n)]).astype(float)
    y = x[:, 0] * (x[:, 2] > 0) + np.sin(3 * x[:, 1]) + 0.3 * rng.normal(size=n)
    y = (y > 2.5).astype(float) if classes else y
    return pd.DataFrame(x, columns=NAMES).assign(y=y, id=range(n), fold=np.arange(n) % 3, w=1.0 + np.arange(n) % 2)


def frame(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("features", F.array(*NAMES)).repartition(3)


def plain_tree(bins, g, h, spec):
    """Nodes (rows, depth) split one at a time; returns the leaves' rows and values."""

    def value(r):
        return -spec.step * g[r].sum() / max(h[r].sum() + spec.l2, 1e-9)

    def score(r):
        return g[r].sum() ** 2 / max(h[r].sum() + spec.l2, 1e-9)

    def allowed(r, left):
        return min(left.sum(), len(r) - left.sum()) >= spec.min_leaf and len(r) >= spec.min_split

    def best(r):
        top = (0.0, None)
        for f in range(bins.shape[1]):
            for c in range(bins[:, f].max() + 1):
                left = bins[r, f] <= c
                if allowed(r, left):
                    gain = score(r[left]) + score(r[~left]) - score(r)
                    if gain > top[0] + 1e-9:
                        top = (gain, (f, c))
        return top

    deepest = spec.depth if spec.depth is not None else 99
    if spec.growth == "oblivious":
        level = [np.arange(len(g))]
        for _ in range(deepest):
            top = (0.0, None)
            for f in range(bins.shape[1]):
                for c in range(bins[:, f].max() + 1):
                    gain = sum(
                        score(r[bins[r, f] <= c]) + score(r[bins[r, f] > c]) - score(r)
                        for r in level if allowed(r, bins[r, f] <= c))
                    if gain > top[0] + 1e-9:
                        top = (gain, (f, c))
            if top[1] is None:
                break
            f, c = top[1]
            level = [part for r in level for part in (r[bins[r, f] <= c], r[bins[r, f] > c])]
        return [(r, value(r)) for r in level if len(r)]
    leaves = [(np.arange(len(g)), 0)]
    found = [best(leaves[0][0])]
    while len(leaves) < (spec.leaves or 10**9):
        order = [i for i in range(len(leaves)) if found[i][1] is not None and leaves[i][1] < deepest]
        if not order:
            break
        i = max(order, key=lambda k: found[k][0])
        r, d = leaves.pop(i)
        _, (f, c) = found.pop(i)
        for part in (r[bins[r, f] <= c], r[bins[r, f] > c]):
            leaves.append((part, d + 1))
            found.append(best(part))
    return [(r, value(r)) for r, _ in leaves]


def plain_margins(pdf, spec, cuts):
    """Margin of every row after all rounds, learned from the rows outside the held-out fold."""
    bins = np.column_stack([np.searchsorted(np.array(c), pdf[n], side="left") for n, c in zip(NAMES, cuts)])
    train = (pdf["fold"] != spec.held_out).to_numpy() if spec.held_out is not None else np.ones(len(pdf), bool)
    y = pdf["y"].to_numpy()
    w = pdf[spec.weight].to_numpy() if spec.weight else np.ones(len(pdf))
    mean = (y * w)[train].sum() / w[train].sum()
    margin = np.full(len(pdf), mean if spec.loss == "squared" else np.log(mean / (1 - mean)))
    for _ in range(spec.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (margin - y, np.ones(len(y))) if spec.loss == "squared" else (p - y, p * (1 - p))
        at = np.flatnonzero(train)
        for r, v in plain_tree(bins[at], (g * w)[at], (h * w)[at], spec):
            # held-out rows follow the bins of a row of the leaf
            margin[at[r]] += v
    return margin, train


SPECS = [
    Spec("level", 4, 0.3, depth=3), Spec("level", 3, 0.3, depth=2, l2=5.0, held_out=1), Spec("level", 3, 0.5, depth=4, min_split=60, weight="w"),
    Spec("leaf", 4, 0.3, leaves=5), Spec("leaf", 3, 0.3, leaves=6, depth=3, min_leaf=15), Spec("leaf", 3, 0.3, leaves=9, l2=20.0, held_out=2),
    Spec("oblivious", 4, 0.3, depth=3), Spec("oblivious", 3, 0.3, depth=4, l2=3.0, min_leaf=10),
]


@pytest.mark.parametrize("loss, local_rows", [("squared", 0), ("logistic", 0), ("squared", 1000), ("logistic", 1000)])
def test_all_growths_in_one_run_agree_with_plain_trees(spark, monkeypatch, loss, local_rows):
    monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(boosting, "TASK_ROWS", 80)
    monkeypatch.setattr(boosting, "BLOCK", 2)
    pdf = data(classes=loss == "logistic")
    specs = [Spec(**{**s.__dict__, "loss": loss}) for s in SPECS]
    models, _ = boosting.fit_many(frame(spark, pdf), "features", "y", specs, NAMES, "id", "fold")
    for spec, model in zip(specs, models):
        want, train = plain_margins(pdf, spec, model.cuts)
        bins = np.column_stack([np.searchsorted(np.array(c), pdf[n], side="left") for n, c in zip(NAMES, model.cuts)])
        got = model.base + boosting.margins_of([t.arrays() for t in model.trees], bins)
        assert np.allclose(got[train], want[train], atol=1e-8), spec
        if spec.growth == "leaf":
            assert max(t.feature.count(-1) for t in model.trees) <= spec.leaves


def test_leaves_and_penalty_act(spark):
    df = frame(spark, data())
    specs = [Spec("leaf", 2, 0.3, leaves=n, l2=l2) for n, l2 in ((2, 0.0), (8, 0.0), (8, 50.0))]
    few, many, held = boosting.fit_many(df, "features", "y", specs, NAMES, "id")[0]
    assert [t.feature.count(-1) for t in few.trees] == [2, 2] and [t.feature.count(-1) for t in many.trees] == [8, 8]
    assert max(map(abs, held.trees[0].value)) < max(map(abs, many.trees[0].value))


def test_oblivious_levels_share_their_test(spark):
    (model,), _ = boosting.fit_many(frame(spark, data()), "features", "y", [Spec("oblivious", 3, 0.3, depth=3)], NAMES, "id")
    for t in model.trees:
        level = [0]
        while any(t.feature[n] >= 0 for n in level):
            assert len({(t.feature[n], t.cut[n]) for n in level}) == 1
            level = [c for n in level for c in (t.left[n], t.right[n])]


def test_prefixes_subsamples_and_scoring(spark, tmp_path):
    pdf = data(classes=True)
    df = frame(spark, pdf)
    specs = [Spec("level", 6, 0.3, depth=2, subsample=0.7, loss="logistic", held_out=0), Spec("level", 3, 0.3, depth=2, subsample=0.7, loss="logistic", held_out=0)]
    (long, short), plain = boosting.fit_many(df, "features", "y", specs, NAMES, "id", "fold")
    assert long.prefix(3).trees == short.trees  # a shorter ensemble is a prefix
    scores = boosting.prefix_scores(plain, [long, short], [[3, 6], [3]])
    assert scores[0][3] == scores[1][3]
    out = long.transform(df).toPandas()
    held = out[out["fold"] == 0]
    tp = ((held["prediction"] == 1) & (held["y"] == 1)).sum()
    assert scores[0][6] == pytest.approx(2 * tp / ((held["prediction"] == 1).sum() + (held["y"] == 1).sum()))
    long.save(spark, str(tmp_path / "m"))
    again = Boosted.load(spark, str(tmp_path / "m"))
    assert again == long and again.transform(df).orderBy("id").collect() == long.transform(df).orderBy("id").collect()
    assert abs(sum(long.featureImportances) - 1) < 1e-9


def test_sums_do_not_depend_on_the_number_of_tasks(spark, monkeypatch):
    df = frame(spark, data())
    specs = [SPECS[3], Spec("level", 3, 0.3, depth=3, subsample=0.6, weight="w")]
    found = []
    for local_rows, task_rows in ((1000, 8192), (0, 8192), (0, 20)):
        monkeypatch.setattr(boosting, "LOCAL_ROWS", local_rows)
        monkeypatch.setattr(boosting, "TASK_ROWS", task_rows)
        models = boosting.fit_many(df, "features", "y", specs, NAMES, "id")[0]
        found.append([[(t.feature, t.cut) for t in m.trees] for m in models])
    assert found[0] == found[1] == found[2]


def test_constant_empty_and_null_labels(spark):
    pdf = data(20).assign(y=2.0)
    (model,), _ = boosting.fit_many(frame(spark, pdf), "features", "y", [SPECS[0]], NAMES, "id")
    assert model.base == 2.0 and all(t.feature == [-1] for t in model.trees)
    empty = frame(spark, pdf).where("id < 0")
    (model,), plain = boosting.fit_many(empty, "features", "y", [Spec(rounds=2, depth=2, held_out=0)], NAMES, "id", "fold")
    assert model.base == 0.0 and len(model.trees) == 2
    assert boosting.prefix_scores(plain, [model], [[1]]) == [{}]
    gaps = frame(spark, data(40)).withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    assert boosting.fit_many(gaps, "features", "y", [SPECS[0]], NAMES, "id")[1].count() == 20
