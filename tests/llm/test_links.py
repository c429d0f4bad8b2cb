"""Jaccard join, vector near-dedup and components against brute force."""

import random

import brute
import numpy as np
import pytest

from paceframe.llm import graph, shingles, vectors


def near_texts(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 5)))
    base = [[word() for _ in range(rng.choice([2, 9, 12, 30, 90, 200]))] for _ in range(6)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 9])):
            k = rng.randrange(len(w))
            w[k:k + 1] = [word()] if rng.random() < 0.6 else []
            w = w or [word()]
        out.append((rng.randrange(1000) * 1000 + i, "\t ".join(w).upper() if i % 9 == 0 else " ".join(w)))
    return out + [(1, ""), (2, None), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_components_equal_brute_force(spark, seed):
    rows = near_texts(seed, 160)
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, component_id int").repartition(4)
    got = shingles.link_classes(df, block_rows=7).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute.jaccard(rows)
    if seed == 1:
        kept = {r["doc_id"] for r in shingles.keep_one(df).collect()}
        assert kept == {i for i, (_, c) in brute.jaccard(rows).items() if i == c}


def test_linked_sets_agree_on_a_range():
    rng = np.random.default_rng(4)
    levels = shingles.Levels(shingles.THRESHOLD)
    missed = 0
    for _ in range(3000):
        n = int(rng.integers(9, 400))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        far = levels.differ(n, n)
        gone, new = int(rng.integers(0, far + 1)), int(rng.integers(0, far + 1))
        b = np.unique(np.concatenate([a[gone:], rng.integers(0, 2**63, new).astype(np.uint64)]))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if len(b) and shingles.linked(len(a), len(b), both, shingles.THRESHOLD):
            missed += not len(np.intersect1d(levels.keys(a), levels.keys(b))) and not np.array_equal(a, b)
    assert missed == 0


def test_jaccard_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (9, "a b c d"), (7, "q r s"), (7, "t u v"), (8, "t u v")]
    got = shingles.link_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [(0, None), (3, 3), (3, 3), (7, 7), (7, 7), (8, 7), (9, 3)]
    assert shingles.link_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def clouds(seed, n=400, dim=24):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((12, dim))
    x = centre[rng.integers(0, 12, n)] + rng.standard_normal((n, dim)) * rng.choice([0.05, 0.2, 1.0], (n, 1))
    x[: n // 4] = x[0]
    x[n // 4: n // 4 + 20] = -x[0] * 2
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(n * 3)[:n], x.astype(np.float32))]


@pytest.mark.parametrize("block_rows", [512, 16])
def test_vector_links_against_brute_force(spark, block_rows):
    rows = clouds(1)
    odd = [(90001, None), (90002, []), (90003, [0.0] * 24), (90004, [float("nan")] + [1.0] * 23), (90005, [1.0, None]),
           (90006, [float("inf")] + [1.0] * 23), (90007, [1.0, 2.0]), (90008, [2.0, 4.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], "vec_id long, embedding array<float>, kept int").repartition(5)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(df, block_rows=block_rows).collect()}
    want = brute.cosine_links([(i, v) for i, v in rows + odd])
    assert got.keys() == want.keys()
    links = sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(n for n, _, _ in got.values()) >= 0.97 * links
    assert all(got[i][1] >= want[i][1] and got[i][2] == (got[i][1] == i) for i in want)
    assert {i: got[i][:2] for i in range(90001, 90009)} == {i: want[i] for i in range(90001, 90009)}


def test_every_vector_has_a_direction_and_decoding_is_complete():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((200, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    code = vectors.CapCode(16, 2000)
    at, which = code.decode(x)
    assert set(at) == set(range(200))
    k = code.size
    whole = (x @ code.parts[0])[:, :, None, None] + (x @ code.parts[1])[:, None, :, None] + (x @ code.parts[2])[:, None, None, :]
    want = {(i, f) for i, f in zip(*np.nonzero(whole.reshape(200, k**3) >= code.level))}
    assert want <= set(zip(at.tolist(), which.tolist()))


def different_pairs(n, cosine, dim=64, seed=7):
    """Unit vectors of which 2 i and 2 i + 1 have exactly this cosine; no two are equal."""
    rng = np.random.default_rng(seed)
    x, y = rng.standard_normal((2, n // 2, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y *= np.sqrt(1 - cosine**2) / np.linalg.norm(y, axis=1, keepdims=True)
    return np.stack([x, cosine * x + y], axis=1).reshape(n, dim)


@pytest.mark.parametrize("n", [2000, 10000, 50000, 500000])
def test_different_vectors_meet_at_every_size(n):
    code = vectors.CapCode(64, n)
    for cosine, least in ((0.95, 0.98), (0.97, 0.99), (0.99, 0.995)):
        at, which = code.decode(different_pairs(4000, cosine))
        keys = np.unique((at // 2 * code.size**3 + which) * 2 + at % 2)
        both = keys[:-1][(keys[:-1] ^ 1) == keys[1:]] // 2
        assert len(np.unique(both // code.size**3)) >= least * 2000, cosine


def test_links_of_different_vectors_are_found_and_counted_once(spark):
    x = different_pairs(3000, 0.9501)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_duplicates(df).collect()}
    assert max(got.values()) == 1
    assert sum(got.values()) >= 0.98 * 3000


def test_repeated_and_null_vector_ids(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0]), (9, [0.0, 1.0])]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"] or 0, r["component_id"], r["kept"]) for r in got if r["vec_id"]) == [
        (2, 2, True), (5, 2, False), (5, 2, False), (9, 2, False)]
    assert [(r["component_id"], r["kept"]) for r in got if r["vec_id"] is None] == [(None, False)]
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 240)] + [(300 + i, 300 + (i + 1) % 9) for i in range(9)]
    pairs += [(rng.randrange(400, 460), rng.randrange(400, 460)) for _ in range(40)] + [(5, 5)]
    sets = brute.Sets()
    for a, b in pairs:
        sets.tie(a, b)
    df = spark.createDataFrame([(b, a) for a, b in pairs], "a long, b long")
    got = {r["id"]: r["component"] for r in graph.components(df).collect()}
    assert got == {x: sets.find(x) for p in pairs if p[0] != p[1] for x in p}
