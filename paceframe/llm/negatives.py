"""Hard negatives by segment summaries: bounds on inner products decide which are computed.

A vector is cut into segments; each keeps its mean and its deviation. For two vectors a
segment of length l contributes l times the product of the means, give or take l times the
product of the deviations (Cauchy-Schwarz on what is left after the means). Coarse
segments come first; pairs that the bounds do not settle meet finer ones, and only what is
left after the finest is multiplied out.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_folder
from .arrow import slices
from .store import materialise

SEGMENTS = (1, 4, 16)  # of a vector, coarse to fine
SCALE = 256
ANCHORS_EVERY = 100
POSITIVES = 5
NEGATIVES = 5
SHARE = (80, 100)  # of the positive's score that a negative reaches at least and at most, in hundredths
CHUNK_BYTES = 16 << 20  # anchors that travel with the tasks at once
ANCHOR_ROWS = 1024  # sides of one product in a task
ROW_ROWS = 2048

FOUND = "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
NOTHING = np.iinfo(np.int64).min


# ---- bounds

class Side:
    """Vectors of one side of a product with the summaries of their segments."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray):
        self.ids, self.labels, self.numbers = ids, labels, numbers
        x = numbers.astype(np.float64)
        self.real = x
        self.norm = float(np.sqrt((x * x).sum(axis=1)).max(initial=0))
        self.most = int(np.abs(numbers).max(initial=0))
        self.levels = [summary(x, k) for k in SEGMENTS if k <= max(1, x.shape[1])]

    def take(self, at: np.ndarray) -> Side:
        out = object.__new__(Side)
        out.ids, out.labels, out.numbers, out.real = self.ids[at], self.labels[at], self.numbers[at], self.real[at]
        out.norm, out.most = self.norm, self.most
        out.levels = [(m[at], d[at]) for m, d in self.levels]
        return out


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of each row's segments, times the root of the segment's length."""
    if not x.shape[1]:
        return np.zeros((len(x), 1)), np.zeros((len(x), 1))
    cuts = np.linspace(0, x.shape[1], segments + 1).astype(int)
    length = np.diff(cuts).astype(np.float64)
    mean = np.add.reduceat(x, cuts[:-1], axis=1) / length
    rest = x - np.repeat(mean, np.diff(cuts), axis=1)
    deviation = np.sqrt(np.add.reduceat(rest * rest, cuts[:-1], axis=1))
    return mean * np.sqrt(length), deviation


def scores_between(a: Side, b: Side, low: np.ndarray, high: np.ndarray | None = None):
    """Exact scores of all pairs with a score in [low, high] of its ``a`` row: rows of a, rows of b, scores and a mask.

    Rows that the bounds rule out in every pair are left out before the next level, and the
    mask marks the pairs that hold. The slack is far above the rounding of the bounds.
    """
    slack = 1e-9 * a.norm * b.norm + 1e-6
    floor = low.astype(np.float64) - slack
    ceiling = None if high is None else high.astype(np.float64) + slack
    left, right = np.arange(len(a.ids)), np.arange(len(b.ids))
    held = np.ones((len(left), len(right)), dtype=bool)
    for (am, ad), (bm, bd) in zip(a.levels, b.levels):
        middle = am[left] @ bm[right].T
        spread = ad[left] @ bd[right].T
        held &= middle + spread >= floor[left, None]
        if ceiling is not None:
            held &= middle - spread <= ceiling[left, None]
        some, other = held.any(axis=1), held.any(axis=0)
        if not some.any():
            return left[:0], right[:0], np.zeros((0, 0), dtype=np.int64), np.zeros((0, 0), dtype=bool)
        if not (some.all() and other.all()):
            left, right, held = left[some], right[other], held[some][:, other]
    if a.most * b.most * max(1, a.real.shape[1]) < 1 << 53:
        exact = (a.real[left] @ b.real[right].T).astype(np.int64)
    else:
        exact = a.numbers[left].astype(np.int64) @ b.numbers[right].astype(np.int64).T
    held &= exact >= low[left, None]
    if high is not None:
        held &= exact <= high[left, None]
    return left, right, exact, held


class Best:
    """The first ``k`` (score, id) of each key: higher scores first, then smaller ids."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.score = np.full((keys, k), NOTHING, dtype=np.int64)
        self.id = np.zeros((keys, k), dtype=np.int64)

    @property
    def last(self) -> np.ndarray:
        """Score that a new row must reach."""
        return self.score[:, -1]

    def add(self, key: np.ndarray, exact: np.ndarray, held: np.ndarray, ids: np.ndarray) -> None:
        """Take in the held pairs of a matrix whose rows are keys and whose columns are ids."""
        if exact.shape[1] > self.k:  # what is below a row's k-th score of this matrix can't stay
            shown = np.where(held, exact, NOTHING)
            held = held & (shown >= np.partition(shown, exact.shape[1] - self.k, axis=1)[:, [-self.k]])
        at, col = np.nonzero(held)
        if not len(at):
            return
        touched = np.unique(key[at])
        old = self.score[touched] > NOTHING
        keys = np.concatenate((key[at], np.repeat(touched, self.k)[old.ravel()]))
        score = np.concatenate((exact[at, col], self.score[touched][old]))
        owner = np.concatenate((ids[col], self.id[touched][old]))
        order = np.lexsort((owner, -score, keys))
        keys, score, owner = keys[order], score[order], owner[order]
        place = np.arange(len(keys)) - np.searchsorted(keys, keys)
        keep = place < self.k
        self.score[touched] = NOTHING
        self.score[keys[keep], place[keep]] = score[keep]
        self.id[keys[keep], place[keep]] = owner[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, ids and scores of what is kept."""
        key, place = np.nonzero(self.score > NOTHING)
        return key, self.id[key, place], self.score[key, place]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``dim``."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), dtype=flat.dtype)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _side(b: pa.RecordBatch | pa.Table, dim: int) -> Side:
    ids, labels = (b.column(k).to_numpy() if isinstance(b, pa.Table) else b.column(k).to_numpy(zero_copy_only=False) for k in ("id", "label"))
    return Side(ids, labels, _matrix(b.column("q"), dim))


def _parts(n: int, size: int) -> Iterator[np.ndarray]:
    for i in range(0, n, size):
        yield np.arange(i, min(n, i + size))


# ---- the two scans of a chunk of anchors

def _positives(anchors: pa.Table, dim: int, k: int):
    """Task function: per anchor the first ``k`` other rows of its label among the task's rows."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = _side(anchors, dim)
        best = Best(len(side.ids), k)
        of = {label: np.flatnonzero(side.labels == label) for label in np.unique(side.labels).tolist()}
        for b in slices(batches, ROW_ROWS):
            rows = _side(b, dim)
            for label in np.unique(rows.labels).tolist():
                if label not in of:
                    continue
                same = rows.take(np.flatnonzero(rows.labels == label))
                for part in _parts(len(of[label]), ANCHOR_ROWS):
                    at = of[label][part]
                    left, right, exact, held = scores_between(side.take(at), same, best.last[at])
                    held &= side.ids[at[left]][:, None] != same.ids[right][None, :]
                    best.add(at[left], exact, held, same.ids[right])
        key, ids, score = best.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array(side.ids[key], pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
            names=["anchor_id", "positive_id", "positive_score"],
        )

    return scan


def _negatives(anchors: pa.Table, dim: int, positives: dict[str, np.ndarray], share: tuple[int, int], k: int):
    """Task function: per anchor and positive the first ``k`` rows of other labels with a score in the positive's range."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = _side(anchors, dim)
        place = {a: i for i, a in enumerate(side.ids.tolist())}
        owner = np.array([place[a] for a in positives["anchor_id"].tolist()], dtype=np.int64)
        # slots of an anchor: its positives in any order; products of scores as Python integers can't overflow
        order = np.argsort(owner, kind="stable")
        owner = owner[order]
        slot = np.arange(len(owner)) - np.searchsorted(owner, owner)
        width = int(slot.max()) + 1
        low = np.full((len(side.ids), width), np.iinfo(np.int64).max, dtype=np.int64)
        high = np.full((len(side.ids), width), NOTHING, dtype=np.int64)
        known = np.zeros((len(side.ids), width), dtype=np.int64)
        score = positives["positive_score"][order]
        low[owner, slot] = [-(-share[0] * s // 100) for s in score.tolist()]
        high[owner, slot] = [share[1] * s // 100 for s in score.tolist()]
        known[owner, slot] = np.arange(len(owner))
        best = Best(len(side.ids) * width, k)
        for b in slices(batches, ROW_ROWS):
            rows = _side(b, dim)
            for part in _parts(len(side.ids), ANCHOR_ROWS):
                reach = np.maximum(low[part], best.last.reshape(-1, width)[part])
                left, right, exact, held = scores_between(side.take(part), rows, reach.min(axis=1), high[part].max(axis=1))
                held &= side.labels[part[left]][:, None] != rows.labels[right][None, :]
                for i in range(width):
                    own = held & (exact >= reach[left, i][:, None]) & (exact <= high[part[left], i][:, None])
                    best.add(part[left] * width + i, exact, own, rows.ids[right])
        key, ids, got = best.rows()
        at = order[known[key // width, key % width]]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (
            side.ids[key // width], positives["positive_id"][at], positives["positive_score"][at], ids, got,
        )], names=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    return scan


def _first(found: DataFrame, keys: list[str], score: str, owner: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), owner)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# ---- the operator

def prepare(vectors: DataFrame, vec: str, embedding: str, label: str, scale: int) -> DataFrame:
    """Written rows (id, label, q) that take part, one per id, components as whole numbers."""
    rows = vectors.select(F.col(vec).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)))
    held = float(1 << 28)
    q = F.transform("v", lambda x: F.least(F.greatest(F.floor(x * F.lit(float(scale))).cast("double"), F.lit(-held)), F.lit(held)).cast("int"))
    one = usable.select("id", "label", q.alias("q")).groupBy("id").agg(F.min(F.struct("label", "q")).alias("row"))
    return materialise(one.select("id", "row.label", "row.q"))


def mine(
    vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", label: str = "label", every: int = ANCHORS_EVERY,
    positives: int = POSITIVES, negatives: int = NEGATIVES, share: tuple[int, int] = SHARE, scale: int = SCALE,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose integer id is divisible by ``every``; all rows are candidates.
    A component x counts as floor(``scale`` * x), a score is the inner product of those whole
    numbers; higher scores come first, then smaller ids. An anchor's positives are its first
    ``positives`` other rows of its integer label; each has as negatives the first ``negatives``
    rows of other labels whose score is ``share`` hundredths of the positive's.

    Rows with a NULL id, label or vector, or a NULL, NaN or infinite component take no part.
    Rows that share an id are one row, the one with the smallest label and then vector. A
    shorter vector counts as filled up with zeros. Whole numbers beyond 2 ** 28 are held there,
    so that the score of up to 128 components fits 64 bits. An anchor without positives, or a
    positive without negatives, has no rows; neither has an empty table. Other columns are not read.

    Anchors travel with the tasks in chunks of about ``chunk_bytes``, dealt by a digest of the
    id; each chunk scans the written rows twice. Tasks send ``positives`` rows per anchor, then
    ``negatives`` per anchor and positive, never scores of all pairs.
    """
    spark = vectors.sparkSession
    rows = prepare(vectors, vec, embedding, label, scale)
    anchors = rows.where(F.col("id") % every == 0)
    size = anchors.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    dim = rows.agg(F.max(F.size("q")).alias("d")).first()["d"] or 0
    out = scratch_folder(spark)
    empty = spark.createDataFrame([], FOUND)
    _ranked(empty, negatives).write.parquet(out)
    chunks = math.ceil(size * (4 * dim + 16) / chunk_bytes)
    for c in range(chunks):
        own = anchors.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == c).toArrow()
        if not own.num_rows:
            continue
        near = _first(
            rows.mapInArrow(_positives(own, dim, positives), "anchor_id bigint, positive_id bigint, positive_score bigint"),
            ["anchor_id"], "positive_score", "positive_id", positives,
        ).drop("rank").toArrow()  # at most ``positives`` rows per anchor of the chunk
        if not near.num_rows:
            continue
        known = {k: near.column(k).to_numpy() for k in near.column_names}
        found = rows.mapInArrow(_negatives(own, dim, known, share, negatives), FOUND)
        _ranked(found, negatives).write.mode("append").parquet(out)
    return spark.read.schema(_ranked(empty, negatives).schema).parquet(out)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    first = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", k)
    return first.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
