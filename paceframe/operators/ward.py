"""Ward linkage by rounds of reciprocal nearest clusters.

Ward's distance is reducible: merging two clusters brings no third one closer to either.
So all pairs that are each other's nearest can merge in one round, and the merges are those
of the one-by-one procedure. Every distinct vector is a leaf, whatever their number.

* While there are more than ``MOST`` clusters they lie in a written table, in blocks by their
  ids, which follow the order of the vectors. Blocks meet in a product of partitions unless
  their boxes are too far apart for anything nearer than what a block holds itself; a task
  keeps the nearest of each of its clusters, and merges are rows of written tables.
* At most ``MOST`` clusters travel to the tasks, each of which asks for the nearest of some.

Both ways have one order of pairs (cost, smaller id, larger id), so merges don't depend on
where the ways meet. The work is quadratic in the distinct vectors where no box is far.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .neighbors import beside, every_pair, laid_out

MOST = 4096  # clusters of a round that tasks hold whole
ROWS = 64  # clusters that a task compares with the table at once
BLOCK_ROWS = 1024
CLUSTERS = "id bigint, n double, mean array<double>"


@dataclass
class Linkage:
    """Leaves, the leaf of every row, and merges: those over blocks in tables (a, b, height, n) by round, later ones in a list."""

    rows: DataFrame  # the input with a column ``leaf``
    table: DataFrame  # one row (leaf, n, mean, square) per leaf
    early: list[DataFrame] = field(default_factory=list)
    late: list[tuple[int, int, float, int]] = field(default_factory=list)

    @cached_property
    def leaves(self) -> list[int]:
        return sorted(r["leaf"] for r in self.table.select("leaf").collect())

    def _early(self) -> DataFrame | None:
        return reduce(DataFrame.unionByName, [m.withColumn("turn", F.lit(i)) for i, m in enumerate(self.early)]) if self.early else None

    @cached_property
    def merges(self) -> list[tuple[int, int, float, int]]:
        """Merges in order of height: (first id, second id, height, rows)."""
        found = self._early()
        first = [] if found is None else [(r["a"], r["b"], r["height"], int(r["n"])) for r in found.orderBy("turn", "a").collect()]
        return sorted(first + self.late, key=lambda m: m[2])

    def _kept(self, k: int) -> list[tuple[int, int, float, int]]:
        """The last k - 1 merges in order of height, which a cut leaves out; of equal heights those of later rounds."""
        found = self._early()
        last = [(r["height"], r["turn"], i, (r["a"], r["b"])) for i, r in enumerate(
            reversed(found.orderBy(F.desc("height"), F.desc("turn"), F.desc("a")).limit(k - 1).collect()))] if found is not None and k > 1 else []
        last += [(m[2], len(self.early), i, m[:2]) for i, m in enumerate(self.late)]
        return [m for *_, m in sorted(last)[max(0, len(last) - (k - 1)):]] if k > 1 else []

    def roots(self, k: int) -> DataFrame:
        """(leaf, root): the smallest leaf of each leaf's cluster after all but the last k - 1 merges."""
        kept = set(self._kept(k))
        spark = self.table.sparkSession
        out = self.table.select("leaf", F.col("leaf").alias("root"))
        # the pair of a merge is in no other one: the larger id goes
        gone = [b for _, b in kept]
        for m in self.early:
            done = m.where(~F.col("b").isin(gone)) if gone else m
            out = out.join(done.select(F.col("b").alias("root"), "a"), "root", "left").select("leaf", F.coalesce("a", "root").alias("root"))
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while x in up:
                up[x] = x = up.get(up[x], up[x])
            return x

        for a, b, _, _ in self.late:
            if (a, b) not in kept:
                a, b = sorted((root(a), root(b)))
                up[b] = a
        pairs = [(x, root(x)) for x in up]
        if pairs:  # fewer than ``MOST``
            later = spark.createDataFrame(pairs, "root bigint, a bigint")
            out = out.join(later, "root", "left").select("leaf", F.coalesce("a", "root").alias("root"))
        return out

    def _numbered(self, k: int) -> DataFrame:
        """(leaf, number): clusters 0..k-1 by their smallest leaf."""
        found = materialise(self.roots(k))
        known = sorted(r["root"] for r in found.select("root").distinct().collect())  # at most k
        number = self.table.sparkSession.createDataFrame(list(zip(known, range(len(known)))), "root bigint, number bigint")
        return found.join(number, "root").select("leaf", "number")

    def cut(self, k: int) -> dict[int, int]:
        """Cluster 0..k-1 of each leaf after all but the last k - 1 merges, numbered by their smallest leaf."""
        return {r["leaf"]: r["number"] for r in self._numbered(k).orderBy("leaf").collect()}

    def label(self, k: int, name: str = "cluster") -> DataFrame:
        """Rows with their cluster; NULL for rows without a vector."""
        return self.rows.join(self._numbered(k).withColumnRenamed("number", name), "leaf", "left").drop("leaf")


def cluster_features(df: DataFrame, vec: str = "vec", most: int | None = None, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Rows with their ``leaf``, and one row (leaf, n, mean, square) per leaf.

    Each distinct vector is a leaf of its own. Only where the caller gives ``most``, more
    distinct vectors than that share k-means cells.
    """
    rows = materialise(df.withColumn("__x", F.col(vec).cast("array<double>")))
    known = rows.where(F.col("__x").isNotNull()).groupBy("__x").agg(F.count(F.lit(1)).alias("n"))
    known = materialise(known)
    if most is None or known.count() <= most:
        numbered = known.orderBy("__x").withColumn("leaf", F.monotonically_increasing_id())
        leaves = materialise(numbered.select("leaf", "n", F.col("__x").alias("mean"), F.lit(0.0).alias("square")))
        marks = leaves.select("leaf", F.col("mean").alias("__x"))
        return rows.join(marks.hint("merge"), "__x", "left").drop("__x"), leaves
    ready = rows.where(F.col("__x").isNotNull()).withColumn("features", array_to_vector("__x"))
    cells = materialise(KMeans(k=most, seed=seed, maxIter=5).fit(ready).transform(ready).select("*", F.col("prediction").cast("bigint").alias("leaf")))
    spread = cells.select("leaf", F.posexplode("__x").alias("i", "x")).groupBy("leaf", "i").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    leaves = spread.groupBy("leaf").agg(
        F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("mean"),
        F.sum(F.col("v") * F.col("n")).alias("square"))
    bare = rows.where(F.col("__x").isNull()).withColumn("leaf", F.lit(None).cast("bigint"))
    labelled = cells.drop("features", "prediction").unionByName(bare)
    return labelled.drop("__x"), materialise(leaves)


def _nearest(ids: np.ndarray, n: np.ndarray, mean: np.ndarray):
    """Task function: the nearest cluster of each place, the pair with the smaller ids at a tie."""

    def search(batches):
        for b in batches:
            places = b.column("id").to_numpy(zero_copy_only=False)
            for i in range(0, len(places), ROWS):
                own = places[i:i + ROWS]
                gap = ((mean[own, None, :] - mean[None, :, :]) ** 2).sum(axis=2)
                cost = gap * (n[own, None] * n[None, :] / (n[own, None] + n[None, :]))
                cost[np.arange(len(own)), own] = np.inf
                least = cost.min(axis=1)
                low, high = np.minimum(ids[own, None], ids[None, :]), np.maximum(ids[own, None], ids[None, :])
                # the order of tied pairs is the same from both sides, so the first of all pairs is reciprocal
                tied = cost == least[:, None]
                low = np.where(tied, low, np.iinfo(np.int64).max)
                tied &= low == low.min(axis=1)[:, None]
                at = np.where(tied, high, np.iinfo(np.int64).max).argmin(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(at), pa.array(least)], names=["place", "other", "cost"])

    return search


def _packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a partition's clusters in their order, with the box of their means and the least rows of a cluster."""
    from pyspark import TaskContext

    task, turn, held, waiting = TaskContext.get().partitionId(), 0, [], 0

    def block(ids: np.ndarray, n: np.ndarray, mean: np.ndarray) -> pa.RecordBatch:
        listed = lambda x, kind: pa.array([x.ravel()], pa.list_(kind))
        return pa.RecordBatch.from_pydict({
            "block": pa.array([(task << 32) + turn], pa.int64()), "ids": listed(ids, pa.int64()), "n": listed(n, pa.float64()),
            "flat": listed(mean, pa.float64()), "low": listed(mean.min(axis=0), pa.float64()), "high": listed(mean.max(axis=0), pa.float64()),
            "least": pa.array([float(n.min())])})

    def flush(all_of_it: bool) -> Iterator[pa.RecordBatch]:
        nonlocal turn, held, waiting
        ids, n, mean = (np.concatenate(c) for c in zip(*held))
        while len(ids) >= BLOCK_ROWS or (all_of_it and len(ids)):
            yield block(ids[:BLOCK_ROWS], n[:BLOCK_ROWS], mean[:BLOCK_ROWS])
            ids, n, mean, turn = ids[BLOCK_ROWS:], n[BLOCK_ROWS:], mean[BLOCK_ROWS:], turn + 1
        held, waiting = [(ids, n, mean)], len(ids)

    for b in batches:
        if b.num_rows:
            mean = b.column("mean").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            held.append((b.column("id").to_numpy(), b.column("n").to_numpy(), mean))
            waiting += b.num_rows
            if waiting >= BLOCK_ROWS:
                yield from flush(False)
    if waiting:
        yield from flush(True)


BLOCKS = "block bigint, ids array<bigint>, n array<double>, flat array<double>, low array<double>, high array<double>, least double"


class _Near:
    """The nearest found so far of each cluster of a block, in the order of pairs."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, mean: np.ndarray):
        self.ids, self.n, self.mean = ids, n, mean
        self.cost, self.other = np.full(len(ids), np.inf), np.full(len(ids), -1, dtype=np.int64)

    def meet(self, ids: np.ndarray, n: np.ndarray, mean: np.ndarray) -> None:
        """Products only preselect, with a margin; the choice is made on direct differences."""
        own, far = (self.mean * self.mean).sum(axis=1), (mean * mean).sum(axis=1)
        share = self.n[:, None] * n[None, :] / (self.n[:, None] + n[None, :])
        rough = (own[:, None] + far[None, :] - 2.0 * (self.mean @ mean.T)) * share
        slack = 1e-11 * (own + far.max()) * (self.n * n.max() / (self.n + n.max()))
        same = ids.searchsorted(self.ids)
        at = np.flatnonzero((same < len(ids)) & (ids[np.minimum(same, len(ids) - 1)] == self.ids))
        rough[at, same[at]] = np.inf
        least = np.minimum(rough.min(axis=1), self.cost)
        i, j = np.nonzero((rough <= (least * (1 + 1e-7) + slack)[:, None]) & (rough < np.inf))
        cost = ((self.mean[i] - mean[j]) ** 2).sum(axis=1) * share[i, j]
        rows, costs, others = (np.concatenate(c) for c in ((np.arange(len(self.ids)), i), (self.cost, cost), (self.other, ids[j])))
        me = self.ids[rows]
        order = np.lexsort((np.maximum(me, others), np.minimum(me, others), costs, rows))
        first = order[np.concatenate(([True], np.diff(rows[order]) > 0))]
        self.cost, self.other = costs[first], others[first]


def _block(batch: pa.RecordBatch, i: int, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, n, flat = (batch.column(prefix + c)[i].values.to_numpy(zero_copy_only=False) for c in ("ids", "n", "flat"))
    return ids, n, flat.reshape(len(ids), -1)


def _reach(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the cost within which each of their clusters has another one of the same block."""
    for b in batches:
        reach = []
        for i in range(b.num_rows):
            near = _Near(*_block(b, i))
            near.meet(near.ids, near.n, near.mean)
            reach.append(float(near.cost.max()))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(reach)], names=[*b.schema.names, "reach"])


def _search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nearest of the clusters of each first block among the second blocks that it meets in a row."""

    def found(near: _Near) -> pa.RecordBatch:
        at = np.flatnonzero(near.other >= 0)
        me, other = near.ids[at], near.other[at]
        return pa.RecordBatch.from_pydict({"id": me, "cost": near.cost[at], "low": np.minimum(me, other), "high": np.maximum(me, other)})

    last, near = None, None
    for b in batches:
        for i, number in enumerate(b.column("block").to_pylist()):
            if number != last:
                if near is not None:
                    yield found(near)
                last, near = number, _Near(*_block(b, i))
            near.meet(*_block(b, i, "q_"))
    if near is not None:
        yield found(near)


def _merged(state: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """One round over blocks: the clusters after it, and its merges (a, b, height, n)."""
    tasks = max(1, min(math.ceil(count / BLOCK_ROWS), 4 * state.sparkSession.sparkContext.defaultParallelism))
    packed = state.repartitionByRange(tasks, "id").sortWithinPartitions("id").mapInArrow(_packed, BLOCKS)
    blocks = laid_out(materialise(packed).mapInArrow(_reach, BLOCKS + ", reach double"), number := math.ceil(count / BLOCK_ROWS) + tasks)
    second = blocks.select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "n", "flat", "low", "high", "least")])
    apart = F.zip_with(F.zip_with("low", "q_high", lambda x, y: x - y), F.zip_with("q_low", "high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    gap = F.aggregate(apart, F.lit(0.0), lambda s, x: s + x * x) * F.col("least") * F.col("q_least") / (F.col("least") + F.col("q_least"))
    # a margin for rounding
    pairs = every_pair(blocks, second, number, gap * (1 - 1e-9) <= F.col("reach"))
    near = pairs.select("block", "ids", "n", "flat", "q_ids", "q_n", "q_flat").mapInArrow(_search, "id bigint, cost double, low bigint, high bigint")
    best = near.groupBy("id").agg(F.min(F.struct("cost", "low", "high")).alias("p")).select("id", "p.*")
    # a pair that both sides name
    chosen = materialise(best.groupBy("low", "high").agg(F.count(F.lit(1)).alias("sides"), F.min("cost").alias("cost")).where("sides = 2"))
    a, b = (state.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("mean").alias(f"mean_{x}")) for x in ("low", "high"))
    total = F.col("n_low") + F.col("n_high")
    mean = F.zip_with("mean_low", "mean_high", lambda x, y: (x * F.col("n_low") + y * F.col("n_high")) / total)
    joined = materialise(beside(beside(chosen, a, "low"), b, "high").select(
        F.col("low").alias("a"), F.col("high").alias("b"), F.sqrt(2 * F.col("cost")).alias("height"), total.alias("n"), mean.alias("mean")))
    ends = joined.select(F.explode(F.array("a", "b")).alias("id"))
    rest = state.join(ends.hint("merge"), "id", "left_anti")
    left = materialise(rest.unionByName(joined.select(F.col("a").alias("id"), "n", "mean")))
    return left, joined.select("a", "b", "height", "n")


def linkage(df: DataFrame, vec: str = "vec", most: int | None = None, seed: int = 42) -> Linkage:
    """Ward tree of the rows' vectors; equal vectors are one leaf, rows without a vector are in none.

    The height of a merge is the root of twice the growth of the sum of squares, the
    distance of the two where both are single rows. ``most`` is that of ``cluster_features``.
    """
    rows, leaves = cluster_features(df, vec, most, seed)
    state = leaves.select(F.col("leaf").alias("id"), F.col("n").cast("double").alias("n"), "mean")
    count, early = state.count(), []
    while count > MOST:
        state, own = _merged(state, count)
        early.append(own)
        old, count = count, state.count()
        if count == old:
            raise ValueError("no nearest clusters among vectors that are not numbers")
    table = state.orderBy("id").toArrow()  # at most ``MOST`` rows
    ids = table.column("id").to_numpy().astype(np.int64)
    n = table.column("n").to_numpy().astype(float)
    mean = np.array(table.column("mean").to_pylist(), dtype=float).reshape(len(ids), -1 if len(ids) else 0)
    spark, late = df.sparkSession, []
    tasks = spark.sparkContext.defaultParallelism
    while len(ids) > 1:
        found = spark.range(0, len(ids), 1, min(tasks, len(ids))).mapInArrow(
            _nearest(ids, n, mean), "place bigint, other bigint, cost double").toArrow()
        other, cost = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids))
        at = found.column("place").to_numpy()
        other[at], cost[at] = found.column("other").to_numpy(), found.column("cost").to_numpy()
        a = np.flatnonzero((other[other] == np.arange(len(ids))) & (np.arange(len(ids)) < other))
        b = other[a]
        total = n[a] + n[b]
        late += [
            (int(min(ids[i], ids[j])), int(max(ids[i], ids[j])), float(np.sqrt(2 * c)), int(t)) for i, j, c, t in zip(a, b, cost[a], total)]
        mean[a] = (mean[a] * n[a, None] + mean[b] * n[b, None]) / total[:, None]
        n[a], ids[a] = total, np.minimum(ids[a], ids[b])
        keep = np.ones(len(ids), dtype=bool)
        keep[b] = False
        ids, n, mean = ids[keep], n[keep], mean[keep]
    return Linkage(rows, leaves, early, late)
