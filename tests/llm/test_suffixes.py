"""Byte-string removal against brute force, with copies, near copies, shared passages and odd rows."""

import random

import brute
import numpy as np
import pytest

from paceframe.llm import suffixes


def _texts(seed=1, n=60):
    rng = random.Random(seed)
    syll = ["th", "er", "an", "ou", "é", "ñ", "ing", "ß"]
    word = lambda: "".join(rng.choice(syll) for _ in range(rng.randint(1, 4)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passage, base = prose(30), prose(80)
    out = []
    for i in range(n):
        kind = i % 6
        if kind == 0:
            t = prose(40) + " " + passage + " " + prose(20)
        elif kind == 1:
            w = base.split()
            w[rng.randrange(len(w))] = word()
            t = " ".join(w)
        elif kind == 2:
            t = base
        elif kind == 3:
            t = passage[rng.randrange(40):] + prose(5)
        elif kind == 4:
            t = "a" * rng.choice([10, 49, 50, 51, 120])
        else:
            t = prose(rng.randint(0, 60))
        out.append((rng.randrange(10**6) * 100 + i, t))
    return out + [(1, ""), (2, None), (3, "x" * 49), (4, "x" * 50), (5, "y" + "x" * 50)]


@pytest.mark.parametrize("hot_docs", [10**6, 3])
def test_removed_bytes_equal_brute_force(spark, hot_docs):
    rows = _texts()
    df = spark.createDataFrame([(i, t, "kept", 7) for i, t in rows], "doc_id long, text string, kept string, spans int").repartition(5)
    got = suffixes.repeated_bytes(df, hot_docs=hot_docs).collect()
    have = {
        r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), brute.sha(bytes(r["kept"])))
        for r in got
    }
    assert have == brute.suffixes(rows)


def test_null_ids_repeated_rows_and_empty_table(spark):
    t = "the quick brown fox jumps over the lazy dog and then some more of it"
    rows = [(None, t), (2, t), (2, t), (5, t), (7, t + "!")]
    got = suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = sorted((r["doc_id"] or 0, sum(s["end"] - s["start"] for s in r["spans"])) for r in got)
    assert gone == [(0, 0), (2, 0), (2, 0), (5, len(t)), (7, len(t))]
    assert suffixes.repeated_bytes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_suffix_sort_is_the_order_of_bytes():
    rng = random.Random(3)
    items = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    groups = [list(range(0, 80)), list(range(80, 200))]
    order, shared = suffixes.sort_suffixes(items, groups)
    for part in (order[:80], order[80:]):
        assert [items[i] for i in part] == sorted(items[i] for i in part)
    for k in range(1, 80):
        a, b = items[order[k - 1]], items[order[k]]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert shared[k] == n


def test_wrong_hashes_are_found_by_the_bytes(monkeypatch):
    monkeypatch.setattr(suffixes, "prefix_hashes", lambda items: [[0] * (len(s) + 1) for s in items])
    items = [b"bcd", b"abc", b"abd", b"a"]
    order, shared = suffixes.sort_suffixes(items, [[0, 1, 2, 3]])
    assert [items[i] for i in order] == [b"a", b"abc", b"abd", b"bcd"] and shared == [-1, 1, 2, 0]


def test_anchors_cover_every_window_once():
    tables = suffixes.powers()
    text = bytes(np.random.default_rng(2).integers(97, 100, 3000, dtype=np.uint8))
    h, pos, first, last = suffixes.anchors(text, tables)
    windows = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert windows.tolist() == list(range(len(text) - suffixes.LENGTH + 1))
    assert ((pos >= last) & (pos - first <= suffixes.STEPS - 1)).all()


def test_common_passages_multiply_no_rows(spark, monkeypatch):
    rng = random.Random(8)
    prose = lambda k: "".join(rng.choice("abcdefghij ") for _ in range(k))
    passage, edges = prose(200), [prose(60) for _ in range(3)]
    rows = [(i, prose(80) + edges[i % 3] + passage + edges[i % 2] + prose(80)) for i in range(60)]
    plain, grouped, plans, crowded, exploded = suffixes.materialise, suffixes._grouped_windows, [], [], []

    def kept(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        out = plain(df)
        if "w" in out.columns:
            crowded.append(out.where("w is not null").count())
        return out

    monkeypatch.setattr(suffixes, "materialise", kept)
    monkeypatch.setattr(suffixes, "_grouped_windows", lambda each: (exploded.append(each.count()), grouped(each))[1])
    got = suffixes.repeated_bytes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), hot_docs=40).collect()
    have = {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), brute.sha(bytes(r["kept"]))) for r in got}
    assert have == brute.suffixes(rows)
    # grams in over 40 documents with several contexts, but few
    assert crowded[0] > 0 and exploded == [0]
    assert not any("Generate" in p for p in plans)
