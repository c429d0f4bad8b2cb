"""Hard negatives against brute force in whole numbers, and the bounds themselves."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paceframe.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id int, q string, rank int"


def fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(rows, every=100, k=5, m=5, share=(80, 100)):
    one = {}
    for i, v, label in rows:
        if i is None or label is None or not fine(v):
            continue
        q = [max(-(2**28), min(2**28, math.floor(256 * x))) for x in v]
        one[i] = min(one.get(i, (label, q)), (label, q))
    out = []

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    for a, (label, q) in one.items():
        if a % every:
            continue
        ranked = sorted((-dot(q, w), b, other) for b, (other, w) in one.items() if b != a)
        for s, p, _ in [r for r in ranked if r[2] == label][:k]:
            fit = [(n, -t) for t, n, other in ranked if other != label and share[0] * -s <= 100 * -t <= share[1] * -s]
            out += [(a, p, r, n, -s, t) for r, (n, t) in enumerate(fit[:m], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, 1, "x", 2) for i, v, label in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in negatives.mine(df, **options).collect())


def clustered(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((7, dim))
    v = centres[rng.integers(0, 7, n)] + 0.3 * rng.standard_normal((n, dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(i, x.tolist(), int(rng.integers(0, labels))) for i, x in enumerate(v)]


@pytest.mark.parametrize("dim, every", [(64, 10), (5, 7), (1, 10)])
def test_against_brute_force(spark, monkeypatch, dim, every):
    monkeypatch.setattr(negatives, "ROW_ROWS", 64)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 8)
    rows = clustered(400, dim, dim)
    got = mined(spark, rows, every=every, chunk_bytes=3000)
    assert got and got == expected(rows, every)


def test_nulls_ties_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -0.25, 0.125]
    rows = [
        (0, v, 1), (100, v, 1), (200, [0.5], 2), (300, [], 1), (400, None, 1), (500, v, None), (None, v, 1), (600, [nan, 1.0], 1),
        (700, [inf], 1), (800, [None, 1.0], 1), (-100, v, 2), (1, v, 2), (2, v, 2), (3, v, 1), (3, v, 1), (3, v, 0), (4, [0.45, -0.25, 0.1], 2),
        (5, [1e300, 0.0, -1e300], 3), (6, [-0.5, 0.25, -0.125], 1), *[(i, v, 2) for i in range(900, 930)],
    ]
    got = mined(spark, rows)
    assert got and got == expected(rows)


def test_empty_and_lonely(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1), (1, [1.0], 2)]) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2), (3, [1.0], 1)]) == []


NUMBERS = st.lists(st.lists(st.integers(-300, 300), min_size=6, max_size=6), min_size=1, max_size=8)


@settings(max_examples=150, deadline=None)
@given(NUMBERS, NUMBERS, st.integers(-100_000, 100_000))
def test_bounds_lose_nothing(a, b, low):
    x, y = (negatives.Side(np.arange(len(v)), np.zeros(len(v)), np.array(v)) for v in (a, b))
    exact = np.array(a) @ np.array(b).T
    for (am, ad), (bm, bd) in zip(x.levels, y.levels):
        assert (np.abs(exact - am @ bm.T) <= ad @ bd.T + 1e-3).all()
    left, right, found, held = negatives.scores_between(x, y, np.full(len(a), low), np.full(len(a), low + 20_000))
    pairs = {(int(left[i]), int(right[j])) for i, j in zip(*np.nonzero(held))}
    assert pairs == {(i, j) for i, j in zip(*np.nonzero((exact >= low) & (exact <= low + 20_000)))}


def test_finer_segments_settle_more():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-100, 100, (2, 40, 64))
    x, y = (negatives.Side(np.arange(40), np.zeros(40), v) for v in (a, b))
    widths = [float((ad @ bd.T).mean()) for (_, ad), (_, bd) in zip(x.levels, y.levels)]
    assert widths == sorted(widths, reverse=True) and len(widths) == len(negatives.SEGMENTS)
