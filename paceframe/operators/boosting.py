"""Histogram boosting of many ensembles at once: by levels, by best leaves, or oblivious.

Columns are binned once. Every pass over the written rows adds up, for all ensembles that
are being grown, the gradients, curvatures and rows per (leaf, feature, bin); tasks send
these sums, whose size depends on leaves and bins and not on the rows, the sums meet by
(ensemble, block of features), and only the best split of each leaf reaches the driver. So
a grid over all folds costs the passes of its largest ensemble, not one fit per
combination, and shorter ensembles are prefixes of longer ones. Rows that agree in bins, fold
and weights have one margin, so unless rounds draw single rows they are added up first. A table
within ``LOCAL_ROWS`` and ``LOCAL_BYTES`` needs no passes: tasks get it whole and deal the
ensembles among them, with the same sums, splits and trees.

* ``level``: every leaf splits until ``depth``.
* ``leaf``: best-first up to ``leaves``. A node's place in that order is bounded by the
  least gain on its way, so one pass opens all leaves that can still be chosen.
* ``oblivious``: one split for a whole level; a leaf is the bits of the tests.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise

MAX_BINS = 64
BLOCK = 32  # features whose sums meet in one place
TASK_ROWS = 8192  # rows of a task at least
LOCAL_ROWS = 1 << 20  # a table of at most so many rows
LOCAL_BYTES = 64 << 20  # and binned bytes travels whole to tasks that each grow some of the ensembles
PENDING = 3  # trees of an ensemble that a pass adds to the written margins at most
LEAST_CURVATURE = 1e-9


@dataclass(frozen=True)
class Spec:
    """One ensemble. ``held_out`` is the fold it never learns from; ``weight`` names a column of row weights, 0 leaves a row out."""

    growth: str = "level"
    rounds: int = 100
    step: float = 0.1
    depth: int | None = None
    leaves: int | None = None
    l2: float = 0.0
    min_leaf: int = 1
    min_split: int = 2
    subsample: float = 1.0
    loss: str = "squared"
    weight: str | None = None
    held_out: int | None = None
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` -1 is a leaf; rows with bin <= ``cut`` go left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for x, v in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0)):
            x.append(v)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.cut, self.left, self.right, self.value))


def leaf_of(tree: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """Node in which each row of bins ends."""
    feature, cut, left, right, _ = tree
    at = np.zeros(len(bins), dtype=np.int64)
    if feature[0] < 0:
        return at
    # a leaf leads to itself; children come after their parent
    leaf, depth = feature < 0, np.zeros(len(feature), dtype=np.int64)
    child = np.where(leaf, np.arange(len(feature)), (left, right)).T.ravel()
    for n in np.flatnonzero(~leaf).tolist():
        depth[left[n]] = depth[right[n]] = depth[n] + 1
    feature, flat, first = np.maximum(feature, 0), bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    for _ in range(depth.max()):
        at = child.take(2 * at + (flat.take(first + feature.take(at)) > cut.take(at)))
    return at


def margins_of(trees: Sequence[tuple[np.ndarray, ...]], bins: np.ndarray) -> np.ndarray:
    total = np.zeros(len(bins))
    for t in trees:
        total += t[4][leaf_of(t, bins)]
    return total


def gradients(loss: str, n: np.ndarray, y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients and curvatures of cells of ``n`` (weighted) rows whose labels add up to ``y``."""
    if loss == "squared":
        return n * margin - y, n
    p = 1.0 / (1.0 + np.exp(-margin))
    return n * p - y, n * (p * (1.0 - p))


def drawn(seed: int, turn: int, digest: np.ndarray, share: float) -> np.ndarray:
    """Rows of one round's sub-sample, by a mix of the row's digest with seed and round."""
    x = digest.view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) < share * (1 << 53)


# ---- splits of summed histograms

@dataclass
class Split:
    """Best split of a leaf, with the sums of both sides; ``feature`` -1 where none is allowed."""

    feature: int
    cut: int
    gain: float
    left: tuple[float, float, float]  # gradient, curvature, rows
    total: tuple[float, float, float]


def _score(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / np.maximum(h + l2, LEAST_CURVATURE)


def _widths(sizes: Sequence[int]) -> list[tuple[int, list[int]]]:
    """Features by the power of two that their bins fill up, so that features of a kind share array operations."""
    out: dict[int, list[int]] = {}
    for f, size in enumerate(sizes):
        out.setdefault(1 << max(0, size - 1).bit_length(), []).append(f)
    return sorted(out.items())


def best_splits(sums: np.ndarray, sizes: Sequence[int], first: int, spec: Spec) -> list[Split]:
    """The best split of each slot over a block of features, or, for oblivious trees, the split best for all slots together.

    ``sums`` is slots x (all bins of the block) x 3. At equal gains the first feature and bin hold.
    """
    starts = np.concatenate(([0], np.cumsum(sizes)))
    parts = []
    for width, features in _widths(sizes):
        own = np.zeros((3, len(sums), len(features), width))
        for i, f in enumerate(features):
            own[:, :, i, :sizes[f]] = np.moveaxis(sums[:, starts[f]:starts[f + 1]], -1, 0)
        parts.append((features, own))
    return _best_of(parts, len(sizes), first, spec)


def _best_of(parts: Sequence[tuple[list[int], np.ndarray]], count: int, first: int, spec: Spec) -> list[Split]:
    """``best_splits`` of sums that lie by the width of their features, each 3 x slots x features x bins."""
    slots = parts[0][1].shape[1]
    total = next(own[:, :, features.index(0)].sum(axis=-1) for features, own in parts if 0 in features)
    oblivious = spec.growth == "oblivious"
    gains, cuts = np.zeros(count if oblivious else (slots, count)), np.zeros(count if oblivious else (slots, count), dtype=np.int64)
    lefts: dict[int, tuple[np.ndarray, int]] = {}
    for features, own in parts:
        left = np.cumsum(own, axis=-1)
        whole = left[..., -1:]
        (g, h, n), (all_g, all_h, all_n) = left, whole
        gain = _score(g, h, spec.l2) + _score(all_g - g, all_h - h, spec.l2) - _score(all_g, all_h, spec.l2)
        fine = (n >= spec.min_leaf) & (all_n - n >= spec.min_leaf) & (all_n >= spec.min_split)
        # a slot that an oblivious cut leaves on one side gains nothing, and does not forbid it
        shown = np.where(fine, gain, 0.0).sum(axis=0) if oblivious else np.where(fine, gain, -np.inf)
        at = np.argmax(shown, axis=-1)
        cuts[..., features] = at
        gains[..., features] = np.take_along_axis(shown, at[..., None], axis=-1)[..., 0]
        lefts |= {f: (left, i) for i, f in enumerate(features)}
    if oblivious:
        at, top = -1, 0.0
        for f, gain in enumerate(gains.tolist()):
            if gain > top + 1e-12:
                at, top = f, gain
        chosen, tops = [at] * slots, [top] * slots
    else:
        best, top = np.full(slots, -1), np.zeros(slots)
        for f in range(count):
            better = gains[:, f] > top + 1e-12
            best[better], top[better] = f, gains[better, f]
        chosen, tops = best.tolist(), top.tolist()
    out = []
    for s, (f, gain, own) in enumerate(zip(chosen, tops, total.T.tolist())):
        if f < 0:
            out.append(Split(-1, 0, 0.0, (0.0, 0.0, 0.0), tuple(own)))
            continue
        left, i = lefts[f]
        cut = int(cuts[f] if oblivious else cuts[s, f])
        out.append(Split(first + f, cut, gain, tuple(left[:, s, i, cut].tolist()), tuple(own)))
    return out


# ---- growing one ensemble

class Grower:
    """State of one ensemble on the driver: finished trees, the tree in the making, and the leaves it needs sums of."""

    def __init__(self, spec: Spec, base: float):
        self.spec, self.base = spec, base
        self.trees: list[Tree] = []
        self.written = 0  # trees that the written margins hold
        self._start()

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.spec.rounds

    def _start(self) -> None:
        self.tree = Tree()
        self.tree.add(0.0)
        self.depth = {0: 0}
        self.split: dict[int, Split] = {}
        self.children: dict[int, tuple[int, int]] = {}
        self.wanted = [0]

    def final(self, node: np.ndarray) -> np.ndarray:
        """Value, in the tree that was finished last, of rows by their nodes in it as it grew."""
        own = self.trees[-1]
        pruned = self.spec.growth == "leaf" and self.spec.leaves
        return np.array(own.value)[self.place[node] if pruned else node]

    def _value(self, sums: tuple[float, float, float]) -> float:
        g, h, _ = sums
        return -self.spec.step * g / max(h + self.spec.l2, LEAST_CURVATURE)

    def _open(self, node: int) -> None:
        """Give a node its two children, so that rows walk to them."""
        s, t = self.split[node], self.tree
        t.feature[node], t.cut[node], t.gain[node] = s.feature, s.cut, s.gain
        rest = tuple(a - b for a, b in zip(s.total, s.left))
        pair = t.add(self._value(s.left)), t.add(self._value(rest))
        t.left[node], t.right[node] = pair
        self.children[node] = pair
        for c in pair:
            self.depth[c] = self.depth[node] + 1

    def take(self, splits: Mapping[int, Split]) -> None:
        """Use the splits of the wanted leaves; afterwards ``wanted`` holds the next ones, of the next tree if this one is complete."""
        for node, s in splits.items():
            self.split[node] = s
            if node == 0:
                self.tree.value[0] = self._value(s.total)
        deepest = self.spec.depth if self.spec.depth is not None else math.inf
        able = [n for n in self.wanted if self.split[n].feature >= 0 and self.depth[n] < deepest]
        if self.spec.growth == "leaf":
            able = self._eligible(deepest)
        for n in able:
            self._open(n)
        # children at the deepest level need no sums
        self.wanted = [c for n in able for c in self.children[n] if self.depth[c] < deepest]
        if not self.wanted:
            self._finish()

    def _eligible(self, deepest: float) -> list[int]:
        """Unopened nodes that best-first growth can still choose."""
        most = (self.spec.leaves or 1 << 30) - 1
        reach = self._reach()
        known = sorted((-r, n) for n, r in reach.items() if self.split[n].feature >= 0 and self.depth[n] < deepest)
        return [n for _, n in known[:most] if n not in self.children]

    def _reach(self) -> dict[int, float]:
        """Least gain on the way from the root to each node with a known split."""
        out: dict[int, float] = {}
        todo = [(0, math.inf)]
        while todo:
            n, least = todo.pop()
            if n not in self.split:
                continue
            out[n] = min(least, self.split[n].gain)
            if n in self.children:
                todo += [(c, out[n]) for c in self.children[n]]
        return out

    def _finish(self) -> None:
        if self.spec.growth == "leaf" and self.spec.leaves:
            self._prune()
        self.trees.append(self.tree)
        self._start()

    def _prune(self) -> None:
        """Keep the splits that best-first growth takes; nodes opened ahead of time close again. ``place`` has the new node of each old one."""
        open_, taken = [(-self.split[0].gain, 0)] if 0 in self.children else [], set()
        while open_ and len(taken) < self.spec.leaves - 1:
            open_.sort()
            _, n = open_.pop(0)
            taken.add(n)
            open_ += [(-self.split[c].gain, c) for c in self.children[n] if c in self.children]
        old, new = self.tree, Tree()
        self.place = np.zeros(len(old.feature), dtype=np.int64)

        def copy(n: int) -> int:
            me = new.add(old.value[n])
            below = [n]
            if n in taken:
                new.feature[me], new.cut[me], new.gain[me] = old.feature[n], old.cut[n], old.gain[n]
                new.left[me] = copy(old.left[n])
                new.right[me] = copy(old.right[n])
                self.place[n] = me
                return me
            while below:
                x = below.pop()
                self.place[x] = me
                below += self.children.get(x, ())
            return me

        copy(0)
        self.tree = new


# ---- passes

def fit_cuts(df: DataFrame, features: str, names: Sequence[str], bins: int = MAX_BINS) -> list[list[float]]:
    """Upper edges of the bins of each feature but the last bin's: its values where there are few, else quantiles."""
    p = len(names)
    wide = df.select(*[F.get(features, F.lit(i)).alias(f"c{i}") for i in range(p)])
    probs = [i / bins for i in range(1, bins)]
    out: list[list[float]] = []
    for i in range(0, p, 64):  # sketches of 64 columns a pass
        some = range(i, min(p, i + 64))
        row = wide.agg(*[F.struct(
            F.percentile_approx(f"c{j}", probs, 100 * bins).alias("q"), F.max(f"c{j}").alias("top")
        ).alias(f"c{j}") for j in some]).first()
        # the last bin holds what is above all edges
        out += [sorted({q for q in row[f"c{j}"]["q"] or [] if q < row[f"c{j}"]["top"]}) for j in some]
    return out


def binned(df: DataFrame, features: str, cuts: Sequence[Sequence[float]], name: str = "bins") -> DataFrame:
    """One byte per feature: the number of edges below the value."""
    edges = [np.array(c) for c in cuts]

    @F.pandas_udf("binary")
    def cut(column):
        import pandas as pd

        x = np.stack(column.to_numpy()) if len(column) else np.zeros((0, len(edges)))
        out = np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)
        return pd.Series([r.tobytes() for r in out])

    return df.withColumn(name, cut(features))


def _flat(column: pa.Array, width: int, kind) -> np.ndarray:
    """Rows of a binary column of equal lengths, without a copy per row."""
    kind = np.dtype(kind)
    n = len(column)
    if not n or not width:
        return np.zeros((n, width), dtype=kind)
    start = np.frombuffer(column.buffers()[1], dtype=np.int32, count=1, offset=4 * column.offset)[0]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8, count=n * width * kind.itemsize, offset=int(start))
    return data.view(kind).reshape(n, width)


@dataclass
class _Ask:
    """What a pass adds up for one ensemble."""

    place: int  # of its margins
    spec: Spec
    turn: int
    pending: list[tuple[np.ndarray, ...]]
    tree: tuple[np.ndarray, ...]
    slot: np.ndarray  # of each node, -1 for none
    slots: int


def _add_up(asks: Sequence[_Ask], sizes: Sequence[int], width: int, weights: Sequence[str]):
    """Task function: rows (ensemble, block, task, sums) over the task's rows."""
    starts = np.concatenate(([0], np.cumsum(sizes)))
    total = int(starts[-1])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, np.ndarray] = {}
        for b in batches:
            bins = _flat(b.column("bins"), len(sizes), np.uint8)
            margins = _flat(b.column("margins"), width, np.float64)
            n, y, fold, digest = (b.column(k).to_numpy(zero_copy_only=False) for k in ("n", "y", "fold", "digest"))
            w = {k: b.column(k).to_numpy(zero_copy_only=False) for k in weights}
            columns = np.ascontiguousarray(bins.T)
            for a in asks:
                s = a.spec
                weight = w[s.weight] if s.weight else None
                margin = margins[:, a.place] + margins_of(a.pending, bins)
                g, h = gradients(s.loss, *((n, y) if weight is None else (n * weight, y * weight)), margin)
                node = a.slot[leaf_of(a.tree, bins)]
                at = np.flatnonzero(_used(s, a.turn, fold, digest, weight) & (node >= 0))
                own = np.empty((a.slots, total, 3))
                for features, sums in _histograms(columns, at, node[at], a.slots, sizes, (g, h, n)):
                    for i, f in enumerate(features):
                        own[:, starts[f]:starts[f + 1]] = np.moveaxis(sums[:, :, i, :sizes[f]], 0, -1)
                held[a.place] = held[a.place] + own if a.place in held else own
        task = TaskContext.get().partitionId()
        for place, sums in held.items():
            for k in range(0, len(sizes), BLOCK):
                part = sums[:, starts[k]:starts[min(k + BLOCK, len(sizes))]]
                yield pa.RecordBatch.from_pydict({
                    "ensemble": pa.array([place], pa.int32()), "block": pa.array([k], pa.int32()), "task": pa.array([task], pa.int32()),
                    "sums": pa.array([part.tobytes()], pa.binary()),
                })

    return scan


def _histograms(
    columns: np.ndarray, at: np.ndarray, slot: np.ndarray, slots: int, sizes: Sequence[int], values: Sequence[np.ndarray],
) -> list[tuple[list[int], np.ndarray]]:
    """Sums of gradients, curvatures and rows (3 x slots x features x bins) by the width of the features; rows ``at`` count, each in its slot.

    ``columns`` holds the bins feature by feature.
    """
    whole = len(at) == columns.shape[1]
    values = [v if whole else v[at] for v in values]
    same = values[1] is values[2] if whole else bool(np.array_equal(values[1], values[2]))
    out = []
    for width, features in _widths(sizes):
        own = np.empty((3, slots, len(features), width))
        base = slot * width
        for i, f in enumerate(features):
            key = base + (columns[f] if whole else columns[f][at])
            for k, v in enumerate(values):
                own[k, :, i] = own[1, :, i] if k == 2 and same else np.bincount(key, v, slots * width).reshape(slots, width)
        out.append((features, own))
    return out


def _used(spec: Spec, turn: int, fold: np.ndarray, digest: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
    """Rows that one round of an ensemble learns from."""
    use = np.ones(len(fold), dtype=bool) if spec.held_out is None else fold != spec.held_out
    if weight is not None:
        use &= weight > 0
    if spec.subsample < 1.0:
        use &= drawn(spec.seed, turn, digest, spec.subsample)
    return use


def _choose(specs: Mapping[int, tuple[Spec, int]], sizes: Sequence[int]):
    """Task function: add up the tasks' sums of an (ensemble, block) in their order and return its best splits."""

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(key, sums):
            place, k = key
            spec, slots = specs[place]
            own = sizes[k:k + BLOCK]
            found = best_splits(sums.reshape(slots, sum(own), 3), own, k, spec)
            return pa.RecordBatch.from_pydict({
                "ensemble": pa.array([place] * slots, pa.int32()), "block": pa.array([k] * slots, pa.int32()), "slot": pa.array(range(slots), pa.int32()),
                "feature": pa.array([s.feature for s in found], pa.int32()), "cut": pa.array([s.cut for s in found], pa.int32()),
                "gain": [s.gain for s in found], "sides": [[*s.left, *s.total] for s in found],
            })

        last, sums = None, None
        for b in batches:
            for place, k, data in zip(*(b.column(c).to_pylist() for c in ("ensemble", "block", "sums"))):
                own = np.frombuffer(data, dtype=np.float64)
                if (place, k) != last:
                    if last is not None:
                        yield flush(last, sums)
                    last, sums = (place, k), own.copy()
                else:
                    sums += own
        if last is not None:
            yield flush(last, sums)

    return merge


SPLITS = "ensemble int, block int, slot int, feature int, cut int, gain double, sides array<double>"


@dataclass
class Boosted:
    """A fitted ensemble. ``cuts`` are the bins' edges in the units of the features."""

    spec: Spec
    base: float
    trees: list[Tree]
    cuts: list[list[float]]

    def prefix(self, rounds: int) -> Boosted:
        return Boosted(self.spec, self.base, self.trees[:rounds], self.cuts)

    @property
    def featureImportances(self) -> DenseVector:
        """Gain per feature over all splits of a tree, each tree's shares adding up to one, as shares of all trees."""
        total = np.zeros(len(self.cuts))
        for t in self.trees:
            own = np.zeros(len(self.cuts))
            first = set()
            for f, g, c in zip(t.feature, t.gain, t.cut):
                # an oblivious tree repeats the level's split and gain in every node of it
                if f >= 0 and (self.spec.growth != "oblivious" or (f, c, g) not in first):
                    own[f] += g
                    first.add((f, c, g))
            total += own / own.sum() if own.sum() else own
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def transform(self, df: DataFrame, features: str = "features", rounds: int | None = None) -> DataFrame:
        """Rows with ``prediction`` and, for classes, ``probability``."""
        trees = [t.arrays() for t in self.trees[:rounds]]
        base = self.base
        column = vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features)
        ready = binned(df.withColumn("__x", column), "__x", self.cuts, "__bins").drop("__x")
        width = len(self.cuts)

        @F.pandas_udf("double")
        def score(bins):
            import pandas as pd

            x = np.frombuffer(b"".join(bins), dtype=np.uint8).reshape(-1, width)
            return pd.Series(base + margins_of(trees, x))

        if self.spec.loss == "squared":
            return ready.withColumn("prediction", score("__bins")).drop("__bins")
        from pyspark.ml.functions import array_to_vector

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("__margin")))
        out = ready.withColumn("__margin", score("__bins")).withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
        return out.withColumn("prediction", (F.col("__margin") > 0).cast("double")).drop("__bins", "__margin")

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees as rows of JSON, so that a folder of any file system will do."""
        rows = [(-1, json.dumps({"spec": asdict(self.spec), "base": self.base, "cuts": self.cuts}))]
        rows += [(i, json.dumps(asdict(t))) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, body string").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        head, *rest = [json.loads(r["body"]) for r in spark.read.parquet(path).orderBy("tree").collect()]
        return Boosted(Spec(**head["spec"]), head["base"], [Tree(**t) for t in rest], head["cuts"])


def _base(sums: Mapping, spec: Spec) -> float:
    """Constant margin of the rows an ensemble learns from."""
    key = spec.weight or "one"
    n = sum(r[f"n_{key}"] or 0.0 for f, r in sums.items() if spec.held_out is None or f != spec.held_out)
    s = sum(r[f"s_{key}"] or 0.0 for f, r in sums.items() if spec.held_out is None or f != spec.held_out)
    mean = s / n if n else 0.0
    if spec.loss == "squared":
        return mean
    mean = min(max(mean, 1e-9), 1 - 1e-9)
    return math.log(mean / (1 - mean))


def fit_many(
    df: DataFrame, features: str, label: str, specs: Sequence[Spec], names: Sequence[str], key: str | None = None, fold: str | None = None,
    bins: int = MAX_BINS, cuts: list[list[float]] | None = None,
) -> tuple[list[Boosted], DataFrame]:
    """Fit all ensembles in common passes; also returns the binned rows (y, fold, digest, bins, weights).

    ``features`` is a vector or array column without NULLs, ``label`` is numeric, 0 or 1 for
    the logistic loss; rows with a NULL label are left out. ``key`` identifies rows for
    sub-sampling, without it their content does. A fold without rows to learn from, or an
    empty table, gives ensembles of constants.
    """
    weights = sorted({s.weight for s in specs if s.weight})
    column = vector_to_array(features) if dict(df.dtypes)[features] == "vector" else F.col(features)
    rows = df.where(F.col(label).isNotNull()).select(
        F.col(label).cast("double").alias("y"), (F.col(fold) if fold else F.lit(-1)).cast("int").alias("fold"), column.cast("array<double>").alias("x"),
        F.xxhash64(F.col(key) if key else column).alias("digest"), *[F.col(w).cast("double").alias(w) for w in weights],
    )
    rows = materialise(rows)
    cuts = cuts or fit_cuts(rows, "x", names, bins)
    keys = ["fold", *weights]
    sums = {r["fold"]: r for r in rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_one"), F.sum("y").alias("s_one"),
        *[F.sum(w).alias(f"n_{w}") for w in weights], *[F.sum(F.col(w) * F.col("y")).alias(f"s_{w}") for w in weights],
    ).collect()}
    growers = [Grower(s, _base(sums, s)) for s in specs]
    size = sum(r["n_one"] for r in sums.values())
    cores = df.sparkSession.sparkContext.defaultParallelism
    plain = materialise(binned(rows, "x", cuts).drop("x").repartition(max(1, min(math.ceil(size / TASK_ROWS), 4 * cores)), "digest"))
    sizes = [len(c) + 1 for c in cuts]
    if not size:
        for g in growers:
            g.trees = [Tree() for _ in range(g.spec.rounds)]
            for t in g.trees:
                t.add(0.0)
        return [Boosted(g.spec, g.base, g.trees, cuts) for g in growers], plain
    cells = plain.withColumn("n", F.lit(1.0))
    if all(s.subsample >= 1.0 for s in specs):
        met = plain.groupBy("bins", *keys).agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("y"))
        cells = materialise(met.withColumn("digest", F.xxhash64("bins", *keys)))
        size = cells.count()
        cells = cells.repartition(max(1, min(math.ceil(size / TASK_ROWS), 4 * cores)), "digest")
    if size <= LOCAL_ROWS and size * (len(cuts) + 8 * len(weights) + 28) <= LOCAL_BYTES:
        _grown_in_tasks(cells, growers, sizes)
    state = _written(cells, growers, None) if any(not g.done for g in growers) else None
    while any(not g.done for g in growers):
        if any(len(g.trees) - g.written > PENDING for g in growers):
            state = _written(cells, growers, state)
        for g, own in zip(growers, _pass(state, growers, sizes, weights)):
            if own is not None:
                g.take(own)
    return [Boosted(g.spec, g.base, g.trees, cuts) for g in growers], plain


def _grown_in_tasks(cells: DataFrame, growers: Sequence[Grower], sizes: Sequence[int]) -> None:
    """Grow all ensembles over a small table, each in one task."""
    table = cells.orderBy("bins", "fold", "digest").toArrow().combine_chunks()
    todo = [(g.spec, g.base) for g in growers]

    def grow(batches):
        rows = {k: table.column(k).to_numpy() for k in table.column_names if k != "bins"}
        bins = _flat(table.column("bins").combine_chunks(), len(sizes), np.uint8)
        new = np.concatenate(([True], (bins[1:] != bins[:-1]).any(axis=1)))
        # rows of equal bins share margin and node
        kind, columns = np.cumsum(new) - 1, np.ascontiguousarray(bins[new].T)
        for b in batches:
            for place in b.column("id").to_pylist():
                trees = _ensemble(*todo[place], rows, kind, columns, sizes).trees
                yield pa.RecordBatch.from_pydict({
                    "place": pa.array([place], pa.int32()), "trees": pa.array([json.dumps([asdict(t) for t in trees])], pa.string())})

    spark = cells.sparkSession
    tasks = min(len(todo), 4 * spark.sparkContext.defaultParallelism)
    # an iterator over the tasks themselves would run them one after the other
    grown = materialise(spark.range(0, len(todo), 1, tasks).mapInArrow(grow, "place int, trees string"))
    for r in grown.toLocalIterator():
        growers[r["place"]].trees = [Tree(**t) for t in json.loads(r["trees"])]


def _ensemble(spec: Spec, base: float, rows: Mapping[str, np.ndarray], kind: np.ndarray, columns: np.ndarray, sizes: Sequence[int]) -> Grower:
    """One ensemble over rows whose distinct bins lie feature by feature in ``columns``; ``kind`` has the place of each row there."""
    own = Grower(spec, base)
    weight = rows[spec.weight] if spec.weight else None
    fixed = np.flatnonzero(_used(replace(spec, subsample=1.0), 0, rows["fold"], rows["digest"], weight))
    known, place = np.unique(kind[fixed], return_inverse=True)
    columns = np.ascontiguousarray(columns[:, known])
    n, y, digest, w = (rows[k][fixed] if k else None for k in ("n", "y", "digest", spec.weight))

    def added(at: np.ndarray | slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, their weights and weighted labels by distinct bins."""
        sums = [np.bincount(place[at], v, len(known)) for v in ((n[at], y[at]) if w is None else (n[at], n[at] * w[at], y[at] * w[at]))]
        return (sums[0], *sums) if w is None else tuple(sums)

    margin = np.full(len(known), base)
    count, mass, labels = added(slice(None))
    while not own.done:
        if spec.subsample < 1.0:
            count, mass, labels = added(np.flatnonzero(drawn(spec.seed, len(own.trees), digest, spec.subsample)))
        g, h = gradients(spec.loss, mass, labels, margin)
        node, turn = np.zeros(len(known), dtype=np.int64), len(own.trees)
        while len(own.trees) == turn:
            tree = own.tree
            slot = np.full(len(tree.feature), -1, dtype=np.int64)
            slot[own.wanted] = np.arange(len(own.wanted))
            at = slot[node]
            use = np.flatnonzero((at >= 0) & (count > 0))
            found = _best_of(_histograms(columns, use, at[use], len(own.wanted), sizes, (g, h, count)), len(sizes), 0, spec)
            own.take(dict(zip(own.wanted, found)))
            # rows of the nodes that were just opened go one step down
            feature, cut, left, right, _ = tree.arrays()
            moving = np.flatnonzero(feature[node] >= 0)
            old = node[moving]
            node[moving] = np.where(columns[feature[old], moving] <= cut[old], left[old], right[old])
        margin += own.final(node)
    return own


def _written(plain: DataFrame, growers: Sequence[Grower], state: DataFrame | None) -> DataFrame:
    """Rows with the margins of all finished trees, written, so that later passes start from there."""
    width = len(growers)
    base = np.array([g.base for g in growers])
    pending = [[t.arrays() for t in g.trees[g.written:]] for g in growers]
    source = plain if state is None else state

    def add(batches):
        for b in batches:
            bins = _flat(b.column("bins"), len(b.column("bins")[0].as_py()) if b.num_rows else 0, np.uint8)
            margins = np.tile(base, (b.num_rows, 1)) if "margins" not in b.schema.names else _flat(b.column("margins"), width, np.float64).copy()
            for place, trees in enumerate(pending):
                if trees:
                    margins[:, place] += margins_of(trees, bins)
            column = pa.array([r.tobytes() for r in margins], pa.binary())
            kept = [k for k in b.schema.names if k != "margins"]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), column], names=[*kept, "margins"])

    schema = ", ".join(f"`{c}` {t}" for c, t in plain.dtypes) + ", margins binary"
    out = materialise(source.select(*plain.columns, *([] if state is None else ["margins"])).mapInArrow(add, schema))
    for g in growers:
        g.written = len(g.trees)
    return out


def _pass(state: DataFrame, growers: Sequence[Grower], sizes: Sequence[int], weights: Sequence[str]) -> list[dict[int, Split] | None]:
    """Splits of all wanted leaves of all unfinished ensembles, from one scan."""
    asks = []
    for place, g in enumerate(growers):
        if g.done:
            continue
        slot = np.full(len(g.tree.feature), -1, dtype=np.int64)
        slot[g.wanted] = np.arange(len(g.wanted))
        asks.append(_Ask(place, g.spec, len(g.trees), [t.arrays() for t in g.trees[g.written:]], g.tree.arrays(), slot, len(g.wanted)))
    sums = state.mapInArrow(_add_up(asks, sizes, len(growers), weights), "ensemble int, block int, task int, sums binary")
    met = sums.repartition("ensemble", "block").sortWithinPartitions("ensemble", "block", "task")
    found = met.mapInArrow(_choose({a.place: (a.spec, a.slots) for a in asks}, sizes), SPLITS).toArrow().to_pylist()
    out: list[dict[int, Split] | None] = [None] * len(growers)
    nothing = Split(-1, 0, 0.0, (0.0, 0.0, 0.0), (0.0, 0.0, 0.0))
    for a in asks:
        out[a.place] = dict.fromkeys(growers[a.place].wanted, nothing)
    for r in sorted(found, key=lambda r: r["block"]):
        g, node = growers[r["ensemble"]], growers[r["ensemble"]].wanted[r["slot"]]
        s = Split(r["feature"], r["cut"], r["gain"], tuple(r["sides"][:3]), tuple(r["sides"][3:]))
        old = out[r["ensemble"]][node]
        if old is nothing or s.gain > old.gain + 1e-12:
            out[r["ensemble"]][node] = s
    return out


def prefix_scores(
    plain: DataFrame, fitted: Sequence[Boosted], rounds: Sequence[Sequence[int]], weights: Sequence[str] = ()
) -> list[dict[int, float]]:
    """Score of each ensemble's prefixes on its held-out fold, all in one pass: R2, or F1 of class 1.

    None where it is undefined: no held-out rows, a constant label, or no row of class 1.
    """
    sets = [(place, m.spec, m.base, [t.arrays() for t in m.trees], sorted(set(r))) for place, (m, r) in enumerate(zip(fitted, rounds))]

    def scan(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            bins = _flat(b.column("bins"), len(b.column("bins")[0].as_py()), np.uint8)
            y, fold = (b.column(k).to_numpy(zero_copy_only=False) for k in ("y", "fold"))
            for place, spec, base, trees, wanted in sets:
                at = np.flatnonzero(fold == spec.held_out)
                if not len(at):
                    continue
                own, x, done = y[at], bins[at], 0
                margin = np.full(len(at), base)
                for r in wanted:
                    margin += margins_of(trees[done:r], x)
                    done = r
                    if spec.loss == "squared":
                        sums = np.array([len(own), own.sum(), (own * own).sum(), ((own - margin) ** 2).sum()])
                    else:
                        said = margin > 0
                        sums = np.array([len(own), (said & (own == 1)).sum(), said.sum(), (own == 1).sum()], dtype=float)
                    total[place, r] = total.get((place, r), 0) + sums
        for (place, r), sums in total.items():
            yield pa.RecordBatch.from_pydict({
                "place": pa.array([place], pa.int32()), "rounds": pa.array([r], pa.int32()), **{k: [float(v)] for k, v in zip("abcd", sums)}})

    # the rows of a small table lie in few tasks; rows of one fold meet the ensembles of that fold only
    cores = plain.sparkSession.sparkContext.defaultParallelism
    dealt = plain if plain.rdd.getNumPartitions() >= cores else plain.repartitionByRange(cores, "fold", "digest")
    rows = dealt.select("y", "fold", "bins").mapInArrow(scan, "place int, rounds int, a double, b double, c double, d double")
    out: list[dict[int, float]] = [{} for _ in fitted]
    for r in rows.groupBy("place", "rounds").agg(*[F.sum(k).alias(k) for k in "abcd"]).collect():
        n, s, q, d = (r[k] for k in "abcd")
        if fitted[r["place"]].spec.loss == "squared":
            spread = q - s * s / n if n else 0.0
            out[r["place"]][r["rounds"]] = 1.0 - d / spread if spread > 0 else None
        else:
            out[r["place"]][r["rounds"]] = 2.0 * s / (q + d) if q + d else None
    return out
