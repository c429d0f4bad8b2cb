"""Quality votes, URL verdicts, source mixing, the bitmap, and the whole pipeline."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from paceframe.llm import mixing, quality, sieve, urls
from paceframe.llm.text import word_array

FOLDER = "/root/testdata/sf0.01"


def prose(rng, k, junk):
    words = ["".join(rng.choice(["th", "er", "an", "ing", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(k)]
    return " ".join(w.upper() + "!!" if junk else w for w in words)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randint(5, 80), i % 5 == 0), 7.0) for i in range(300)]
    docs = spark.createDataFrame(rows + [(1000, "", 1.0), (1001, None, 1.0), (1002, "@" * 300000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(300)] + [(3, None), (None, 1)], "doc_id long, quality int")
    return docs, labels


def test_votes_separate_held_out_rows(labelled):
    docs, labels = labelled
    held = "pmod(crc32(cast(doc_id as string)), 5) = 0"
    got = quality.score(docs, labels, held_out=held).withColumn("held", F.expr(held)).collect()
    assert len(got) == 303
    test = [r for r in got if r["held"] and r["doc_id"] < 300]
    assert np.mean([(r["score"] >= 0.3) == (r["doc_id"] % 5 != 0) for r in test]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[1000] == by[1001] and 0.7 < by[1000] < 0.9


def test_votes_without_labels_and_of_an_empty_table(labelled):
    docs, labels = labelled
    assert {r["score"] for r in quality.score(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_votes_equal_their_definition(labelled):
    docs, labels = labelled
    model = quality.fit(docs, labels, "text", "doc_id", "quality", None, 100)
    assert len(model.labels) == 100
    rows = np.stack([quality.counts(r["text"].encode()) for r in docs.where("doc_id < 20").collect()])
    got = model.scores(rows, 7, 8.0)
    for x, s in zip(model.place(rows), got):
        near = sorted(((float(x @ v), y) for v, y in zip(model.vectors, model.labels)), key=lambda p: -p[0])[:7]
        w = [max(c, 0) ** 8 for c, _ in near]
        assert s == pytest.approx(sum(a * y for a, (_, y) in zip(w, near)) / sum(w), abs=1e-3)


def test_counts_cover_the_whole_text():
    text = bytes(np.random.default_rng(1).integers(0, 256, 5000, dtype=np.uint8))
    whole = quality.counts(text)[:quality.DIM]
    assert whole.sum() == 5000 + 4999 + 4998
    assert quality.counts(b"ab ab  cd\nab ab")[quality.DIM:].tolist() == [16, 16]
    assert quality.counts(b"").sum() == 0 and quality.counts(b"a").sum() == 1


URLS = ["http://a.example.net/en/1", "http://x.NET/de/", "https://example.com/de/2?x=/fr/", "http://www.example.org/fr/1", "http://net", "net/x",
        None, "", "http://", "http://cheap-pills.example.com/en/4", "http://thering.example.com/en/4", "http://a.org/de/x#://b.net/", "http://y.net?a/", "://h.net/"]


def test_urls_follow_rules_then_the_model(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + URLS[:1])], "page_id long, url string, host string")
    got = urls.judge(df).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path, rule = brute.url_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule[0])
        if rule:
            assert r["verdict"] == rule[1]
    by = {r["url"]: r["verdict"] for r in got}
    assert by["http://cheap-pills.example.com/en/4"] == "block" and by["http://thering.example.com/en/4"] == "allow"
    assert by[None] == by["net/x"] == "allow"
    assert urls.judge(df.limit(0)).count() == 0


def test_mixing_meets_entropy_and_quotas(spark):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 30), "big" if i % 3 else f"s{i % 7}") for i in range(900)] + [(None, "a b", None), (5, None, "none"), (5, "", "none")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, source string, weight double")
    got = mixing.mix(df, block_tokens=200).toPandas()
    assert len(got) == len(rows) and (got["copies"] >= 1).all()
    per = got.groupby("source", dropna=False).agg(w=("weight", "first"), t=("n_tokens", "sum"))
    w = per["w"][per["w"] > 0]
    assert w.sum() == pytest.approx(1) and -(w * np.log(w)).sum() / math.log(len(w)) >= 0.97 - 1e-6 or per["t"].max() > 0
    used = (got["copies"] * got["n_tokens"]).groupby(got["source"]).sum()
    big = used["big"]
    for s in ("s0", "s3", "s6"):
        assert used[s] / big == pytest.approx(per["w"][s] / per["w"]["big"], rel=0.1)
    for _, part in got.groupby("source"):
        assert part["copies"].max() - part["copies"].min() <= 1
    again = mixing.mix(df.repartition(7), block_tokens=200).toPandas()
    key = ["doc_id", "source", "n_tokens", "block", "place", "copies"]
    assert sorted(map(str, got[key].itertuples(index=False))) == sorted(map(str, again[key].itertuples(index=False)))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixing_with_a_budget_takes_part_of_the_rows(spark):
    df = spark.createDataFrame([(i, "a b c d", "ab"[i % 2]) for i in range(400)], "doc_id long, text string, source string")
    got = mixing.mix(df, budget=400, block_tokens=40).toPandas()
    assert set(got["copies"]) == {0, 1} and abs((got["copies"] * got["n_tokens"]).sum() - 400) <= 16


def test_exponent_is_bisected(spark):
    totals = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "share double")
    a = mixing.exponent(totals, 0.9, None)
    p = np.array([0.7, 0.2, 0.1]) ** a
    p /= p.sum()
    assert -(p * np.log(p)).sum() / math.log(3) == pytest.approx(0.9, abs=1e-5)
    assert (0.1 / 0.7) ** (mixing.exponent(totals, 1.0, 2.0) - 1) == pytest.approx(2.0, abs=1e-4)
    assert mixing.exponent(totals, None, None) == 1.0


def test_bitmap_keeps_every_key(spark):
    keys = spark.range(0, 3000, 7).select(F.xxhash64("id").alias("k"))
    hit, rest = sieve.split(spark.range(3000), F.xxhash64("id"), keys, "k", 1 << 16)
    have = {r["id"] for r in hit.collect()}
    assert set(range(0, 3000, 7)) <= have and len(have) < 600
    assert len(have) + rest.count() == 3000
    bits = sieve.collected(keys, "k", 1 << 16)
    assert sieve.may_hold(bits, np.array([r["k"] for r in keys.collect()])).all()


def test_word_array_equals_its_pattern(spark):
    texts = ["Hello, World-x 9é", "", None, "  ", "İstanbul ΑΒ ß_ñ", "\x00a\x7fb"]
    got = [r["w"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(word_array(F.col("t")).alias("w")).collect()]
    assert got == [brute.words(t) for t in texts]


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 300")
    before = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == before, name
        assert [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_drops_near_copies_of_five_words(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 300")
    rows = [r.asDict() for r in docs.collect()]
    for r in [r for r in rows if len((r["text"] or "").split()) >= 60][:20]:
        w = r["text"].split()[:50]
        # one word of 50 changed: 41 of 51 five-word, 45 of 51 three-word n-grams are shared
        for k, word in ((0, w[25]), (1, "changed")):
            rows.append({**r, "doc_id": 10**6 + 2 * r["doc_id"] + k, "text": " ".join(w[:25] + [word] + w[26:])})
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{FOLDER}/{name}.parquet")
    folder = str(tmp_path)
    left = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:2]:
        left = stage(spark, left, folder)
    texts = [(r["doc_id"], r["text"]) for r in left.collect()]
    kept = [i for i, (_, c) in brute.jaccard(texts, 80, 100, 5).items() if i == c]
    assert len(kept) < sum(i == c for i, (_, c) in brute.jaccard(texts).items())
    want = corpus_pipeline.benchmark_decontamination(spark, left.where(F.col("doc_id").isin(kept)), folder)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()) == sorted(r["doc_id"] for r in want.collect())


def test_every_operator_has_a_query():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
