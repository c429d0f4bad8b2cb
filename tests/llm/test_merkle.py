"""Merkle manifest against a plain tree, its layout, and its SQL."""

import hashlib
import zlib

import numpy as np
import pytest

from paceframe.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, tag int, leaf string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes):
    """Root of a list of digests and, per leaf, its siblings level by level."""
    where = list(range(len(nodes)))
    path = [[] for _ in nodes]
    while len(nodes) > 1:
        for i, w in enumerate(where):
            first = w - w % 8
            path[i].append((nodes[first:w], nodes[w + 1:first + 8]))
            where[i] = w // 8
        nodes = [h("".join(nodes[k:k + 8])) for k in range(0, len(nodes), 8)]
    return nodes[0], path


def expected(rows):
    """Sorted result of ``merkle.audit`` by the plain definition."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own])))
    root, over = climb([t[1] for t in trees])
    out = []
    for (own, subroot, paths), up in zip(trees, over):
        for r, path in zip(own, paths):
            bent = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                bent[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            at = leaf(bent)
            for before, after in path + up:
                at = h("".join(before + [at] + after))
            proof = h("".join("".join(b + a) for b, a in path + up))
            out.append((r[0], leaf(r), subroot, root, proof, at, at == root))
    return sorted(out, key=str)


def rows(n, langs=("en", "de", None, "漢")):
    return [(i * 7 % 1009, f"s{i % 5}", langs[i % 11 % len(langs)], i, f"Text {i} {'A' if i % 2 else 'é'}") for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in data], SCHEMA)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_the_array(levels):
    at = np.concatenate([merkle.address(levels, d, np.arange(8**d)) for d in range(levels)])
    assert sorted(at.tolist()) == list(range(merkle.size(levels)))
    assert merkle.address(levels, 0, np.array([0])).tolist() == [0]


def test_subtrees_are_contiguous():
    # five levels: two on top, then 64 bottom trees of three levels each
    for b in (0, 17, 63):
        own = [merkle.address(5, 2 + d, b * 8**d + np.arange(8**d)) for d in range(3)]
        at = sorted(np.concatenate(own).tolist())
        assert at == list(range(at[0], at[0] + merkle.size(3))) and at[0] == merkle.size(2) + b * merkle.size(3)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 65])
def test_block_against_plain_tree(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    height = next(k for k in range(9) if 8**k >= n)
    block = merkle.Block(height, n, merkle.construct(height, leaves))
    root, path = climb([x.hex() for x in leaves])
    assert block.node(height, 0).hex() == root
    assert [[("".join(b), "".join(a)) for b, a in p] for p in path] == merkle.paths(block)
    assert all(merkle.fold(x, p) == root for x, p in zip(leaves, merkle.paths(block)))


@pytest.mark.parametrize("height, n", [(4, 300), (1, 300), (2, 1000), (1, 9)])
def test_audit_against_plain_tree(spark, monkeypatch, height, n):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "RANK_ROWS", 64)
    data = rows(n)
    got = merkle.audit(frame(spark, data).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected(data)


def test_nulls_ties_and_repeats(spark):
    data = [
        (None, None, None, None, None), (None, "s", None, 1, ""), (3, "s", "en", None, "ABC"), (3, "s", "en", None, "ABC"),
        (3, "s", "en", None, "abc"), (12, "", "", 0, "A" * 200_000), (0, "s", "en", 2, "QUITE CAPITAL"),
    ]
    assert sorted((tuple(r) for r in merkle.audit(frame(spark, data)).collect()), key=str) == expected(data)


def test_empty_and_single(spark):
    assert merkle.audit(frame(spark, [])).collect() == []
    one = [(5, "s", "en", 1, "x")]
    (row,) = merkle.audit(frame(spark, one)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf(one[0]) and row["proof_sha256"] == h("")


def test_many_groups_and_paths(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    data = [(i, "s", f"g{i % 70:03d}", i, "T") for i in range(200)]
    assert sorted((tuple(r) for r in merkle.audit(frame(spark, data)).collect()), key=str) == expected(data)
