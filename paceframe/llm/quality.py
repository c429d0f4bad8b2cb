"""Quality by votes of the nearest labelled texts in a latent-semantic space."""

from __future__ import annotations

import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import raw_texts, slices

DIM = 4096  # hashed byte n-grams
WIDTH = DIM + 2  # and two terms for words that repeat the word before or don't
WORD_WEIGHT = 8  # counts of a word pair, so they weigh like the n-grams of a word
RANK = 48
NEIGHBOURS = 15
POWER = 8.0
#: Labelled rows used for the space and as voters: the first by digest of the id. This bounds what is sent to every task.
MAX_LABELLED = 4096
THRESHOLD = 0.3
SEED = 7
_MUL = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def counts(text: bytes) -> np.ndarray:
    """Hashed counts of byte n-grams (one to three bytes) of a whole text, and of word pairs alike or not; zero for an empty one."""
    out = np.zeros(WIDTH, dtype=np.float32)
    # a very long text is counted in pieces that overlap by two bytes, so memory stays bounded
    piece = 1 << 20
    for at in range(0, len(text), piece):
        b = np.frombuffer(text, dtype=np.uint8, count=min(piece + 2, len(text) - at), offset=at).astype(np.uint32)
        for n in (1, 2, 3):
            size = min(piece, len(b) - n + 1)
            if size <= 0:
                continue
            h = np.full(size, n * 0x27D4EB2F & 0xFFFFFFFF, dtype=np.uint32)
            for j in range(n):
                h = (h ^ b[j:j + size]) * _MUL[j]
                h ^= h >> np.uint32(15)
            out[:DIM] += np.bincount(h & np.uint32(DIM - 1), minlength=DIM).astype(np.float32)
    tokens = text.split()
    alike = sum(map(operator.eq, tokens, tokens[1:]))
    out[DIM:] = WORD_WEIGHT * alike, WORD_WEIGHT * (max(len(tokens) - 1, 0) - alike)
    return out


def damp(rows: np.ndarray) -> np.ndarray:
    """Counts to shares, in place, damped by a square root, so a text's length does not matter."""
    total = rows.sum(axis=1, keepdims=True)
    np.divide(rows, total, out=rows, where=total > 0)
    return np.sqrt(rows, out=rows)


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


@dataclass
class Voters:
    """Space and labelled vectors; its size is bounded by WIDTH, RANK and the number of labelled rows."""

    weight: np.ndarray
    mean: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def place(self, rows: np.ndarray) -> np.ndarray:
        """Latent vectors of unit length; a text without bytes has a zero vector."""
        some = rows.sum(axis=1) > 0
        out = unit((damp(rows.copy()) * self.weight - self.mean) @ self.basis)
        out[~some] = 0
        return out

    def scores(self, rows: np.ndarray, neighbours: int, power: float) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors.

        One exact product of the block with all labelled vectors. Without a similar
        voter the score is the share of label 1 among all of them.
        """
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        near = self.place(rows) @ self.vectors.T
        k = min(neighbours, near.shape[1])
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** power
        total = w.sum(axis=1)
        votes = (w * self.labels[top]).sum(axis=1)
        return np.where(total > 1e-12, votes / np.where(total > 1e-12, total, 1.0), self.prior)


def fit(docs: DataFrame, labels: DataFrame, text: str, doc: str, label: str, held_out: str | None, max_labelled: int) -> Voters:
    """Latent space and voters from a bounded sample of labelled rows.

    Labels of held-out ids are not read. Ids with several labels have their mean,
    rounded. The sample's counts, ``max_labelled`` rows of WIDTH numbers, reach the driver.
    """
    known = labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull())
    if held_out:
        known = known.where(~F.expr(held_out))
    chosen = (
        known.groupBy(F.col(doc).alias("_q_doc")).agg(F.round(F.avg(F.col(label))).cast("int").alias("_q_label"))
        .orderBy(F.xxhash64("_q_doc"), "_q_doc").limit(max_labelled)
    )
    rows = docs.select(F.col(doc).alias("_q_id"), F.col(text).alias("_q_text")).join(
        F.broadcast(chosen), F.col("_q_id") == F.col("_q_doc")
    ).select("_q_id", "_q_text", "_q_label")

    def count(batches):
        for b in slices(batches, 256):
            found = [counts(t or b"") for t in raw_texts(b.column("_q_text"))]
            yield pa.RecordBatch.from_arrays(
                # counts are mostly zeros
                [b.column("_q_id").cast(pa.string()), b.column("_q_label").cast(pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in found], pa.binary())],
                names=["id", "label", "counts"],
            )

    got = rows.mapInArrow(count, "id string, label int, counts binary")
    # documents that repeat an id vote once
    got = got.groupBy("id").agg(F.min("label").alias("label"), F.min("counts").alias("counts")).orderBy("id").collect()
    # one table, filled and changed in place: the driver holds it once
    x = np.zeros((len(got), WIDTH), dtype=np.float32)
    for i, r in enumerate(got):
        x[i] = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.float32)
    y = np.array([r["label"] for r in got], dtype=np.float64)
    del got
    use = x.sum(axis=1) > 0
    if not use.all():
        x, y = x[use], y[use]
    prior = float(y.mean()) if len(y) else 0.5
    df = np.count_nonzero(x, axis=0)
    damp(x)
    weight = (np.log((len(x) + 1) / (df + 1)) + 1).astype(np.float32)
    x *= weight
    mean = x.mean(axis=0) if len(x) else np.zeros(WIDTH, np.float32)
    x -= mean
    basis = principal(x, RANK)
    model = Voters(weight, mean, basis, np.zeros((0, basis.shape[1]), np.float32), y, prior)
    if len(x):
        model.vectors = unit(x @ basis)
    return model


def principal(x: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors by subspace iteration from a fixed start."""
    k = max(1, min(rank, *x.shape)) if len(x) else 1
    q = np.random.default_rng(SEED).standard_normal((x.shape[1], k)).astype(np.float32)
    for _ in range(8):
        q, _ = np.linalg.qr(x.T @ (x @ q)) if len(x) else np.linalg.qr(q)
    return q.astype(np.float32)


def score(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc: str = "doc_id", label: str = "quality",
    held_out: str | None = None, max_labelled: int = MAX_LABELLED, neighbours: int = NEIGHBOURS, power: float = POWER,
) -> DataFrame:
    """Add ``score``: 0 to 1, higher where label 1 is likelier; rows are as in ``docs``.

    Only the text is an input of the score. ``held_out`` is an SQL condition on the
    labels' id whose rows teach nothing. NULL and empty texts score the share of label
    1 among the voters, and so does everything without a similar voter; without any
    labels that share is 0.5. Repeated rows score alike, an empty table stays empty, and
    an input column named ``score`` is replaced.
    """
    model = fit(docs, labels, text, doc, label, held_out, max_labelled)
    keep = [c for c in docs.columns if c not in ("score", "_q_bytes")]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("_q_bytes"))
    schema = rows.drop("_q_bytes").withColumn("score", F.lit(0.0)).schema

    def vote(batches):
        for b in slices(batches, 256):
            bodies = raw_texts(b.column("_q_bytes"))
            table = np.stack([counts(t or b"") for t in bodies]) if bodies else np.zeros((0, WIDTH), np.float32)
            got = np.clip(model.scores(table, neighbours, power), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(got, pa.float64())], names=[*keep, "score"])

    return rows.mapInArrow(vote, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Documents that score at least ``threshold``, in their columns."""
    return score(docs, labels, **options).where(F.col("score") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
