"""Near-duplicate vectors by spherical-cap filters."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import runs, slices
from .graph import components, lowest
from .store import materialise

COSINE = 0.95
RECALL = 0.99  # share of pairs at the threshold that meet in a direction
FILTERS_PER_VECTOR = 12  # directions of a vector at least; more where the recall asks for them
MOST_FILTERS = 192  # beyond, every pair is verified
PROBES = 4096  # random pairs that the recall of a code is measured on
BUCKET = 16  # expected vectors of one direction, for vectors without clusters
BLOCKS = 3  # factors of a product code
BLOCK_ROWS = 512  # vectors of one side of a verified product
SEED = 11


class CapCode:
    """Random product code: a direction is a tuple of one code word per block of coordinates.

    A vector has all directions it exceeds ``level`` in, and its ``per_vector`` best ones
    in any case, as directions of one block word share their vectors and hits are uneven.
    ``per_vector`` grows until random pairs at ``cosine`` meet with probability ``recall``;
    a table too small for that, or a threshold too low, has one direction that all share.
    """

    def __init__(
        self, dim: int, n: int, per_vector: float = FILTERS_PER_VECTOR, bucket: float = BUCKET, seed: int = SEED,
        recall: float = RECALL, cosine: float = COSINE,
    ):
        per_vector = math.ceil(per_vector)
        while True:
            self._draw(dim, n, per_vector, bucket, seed)
            if self.size == 1 or self.recall(dim, cosine, seed) >= recall:
                break
            per_vector = math.ceil(per_vector * 1.25)

    def _draw(self, dim: int, n: int, per_vector: int, bucket: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        turn, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
        blocks = max(1, min(BLOCKS, dim))
        wanted = max(per_vector * 4, per_vector * n / bucket)
        whole = per_vector > MOST_FILTERS or per_vector * 4 > n
        self.size = 1 if whole else max(2, math.ceil(wanted ** (1 / blocks)))
        self.per_vector = min(per_vector, self.size ** blocks)
        cuts = np.linspace(0, dim, blocks + 1).astype(int)
        self.parts = []
        for i, j in zip(cuts, cuts[1:]):
            words = rng.standard_normal((self.size, j - i))
            words /= np.linalg.norm(words, axis=1, keepdims=True)
            self.parts.append(turn[:, i:j] @ words.T * math.sqrt((j - i) / dim))
        share = min(0.5, per_vector / self.size ** blocks)
        self.level = _normal_quantile(1 - share) / math.sqrt(dim)
        # the best tuples of words have ranks within their blocks whose product is at most per_vector
        ranks = [()]
        for _ in range(blocks):
            ranks = [(*r, i) for r in ranks for i in range(min(self.size, self.per_vector // math.prod(x + 1 for x in r)))]
        self.ranks = np.array(ranks)

    def recall(self, dim: int, cosine: float, seed: int) -> float:
        """Share of random pairs at exactly ``cosine`` that have a direction in common."""
        rng = np.random.default_rng([seed, dim, PROBES])
        x = _unit(rng.standard_normal((PROBES, dim)))
        y = rng.standard_normal((PROBES, dim))
        y -= (x * y).sum(axis=1, keepdims=True) * x
        if dim > 1:  # a line has no pairs between the same and the opposite direction
            y = cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * _unit(y)
        else:
            y = x
        whole = self.size ** len(self.parts)
        keys = [at * whole + which for at, which in (self.decode(x), self.decode(y))]
        return len(np.unique(np.intersect1d(*keys) // whole)) / PROBES

    def decode(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All directions that each unit row exceeds and its best ones, as distinct (row, direction)
        in this order, pruned block by block."""
        scores = [rows @ p for p in self.parts]
        rest = np.cumsum([s.max(axis=1) for s in reversed(scores)], axis=0)[::-1]
        at = np.arange(len(rows))
        code = np.zeros(len(rows), dtype=np.int64)
        total = np.zeros(len(rows))
        for k, s in enumerate(scores):
            full = total[:, None] + s[at]
            more = rest[k + 1][at][:, None] if k + 1 < len(scores) else 0.0
            i, j = np.nonzero(full + more >= self.level)
            at, code, total = at[i], code[i] * self.size + j, full[i, j]
        near, best = np.divmod(self._best(scores).ravel(), self.size ** len(scores))
        at, code = np.concatenate([at, near]), np.concatenate([code, best])
        order = np.lexsort((code, at))
        at, code = at[order], code[order]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1]) | (code[1:] != code[:-1])
        return at[fresh], code[fresh]

    def _best(self, scores: list[np.ndarray]) -> np.ndarray:
        """The ``per_vector`` best directions of each row, as row x number of directions + direction."""
        code, total = np.zeros((len(scores[0]), len(self.ranks)), dtype=np.int64), 0.0
        for k, s in enumerate(scores):
            order = np.argsort(-s, axis=1)[:, : self.per_vector]
            words = order[:, self.ranks[:, k]]
            code = code * self.size + words
            total = total + np.take_along_axis(s, words, axis=1)
        top = np.argpartition(-total, self.per_vector - 1, axis=1)[:, : self.per_vector]
        return np.arange(len(code))[:, None] * self.size ** len(scores) + np.take_along_axis(code, top, axis=1)


def _normal_quantile(p: float) -> float:
    """Quantile of the normal distribution by bisection of its error function."""
    low, high = -10.0, 10.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 0.5 * (1 + math.erf(mid / math.sqrt(2))) < p else (low, mid)
    return low


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column, dim: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def near_duplicates(
    vectors: DataFrame, vec: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE,
    per_vector: float = FILTERS_PER_VECTOR, bucket: float = BUCKET, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id`` and ``kept``.

    Links are pairs met in a common direction whose cosine, in double precision, is at
    least ``cosine``; a pair whose vectors share no direction is missed, at ``cosine``
    itself one in a hundred (``RECALL``, measured when the code is drawn). Equal vectors are one class, so copies cost nothing. A
    direction's bucket is cut into blocks of at most ``block_rows`` vectors, and each
    pair of blocks is one product, so no task holds a bucket. Tasks return one row per
    vector and block pair, with the number of links first met there and one tie to a
    component, never the pairs. Vectors that are NULL, empty, zero or hold a NULL,
    NaN or infinite number link with nothing; neither do vectors of different lengths.
    Rows that share an id are one node. A NULL id has no component and is not kept. An
    empty table stays empty, other columns are not read.
    """
    rows = vectors.select(F.col(vec).alias("id"), F.col(embedding).cast("array<double>").alias("v"))
    fine = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    usable = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    # -0.0 and 0.0 are one number
    usable = usable.select("id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    classes = materialise(usable.groupBy("v").agg(F.min("id").alias("c"), F.count_distinct("id").alias("copies")))
    members = materialise(usable.join(classes, "v").select("id", "c").distinct())
    dims = [(r["d"], r["n"]) for r in classes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()]
    # four bytes hold what four bytes brought; products are in double precision all the same
    real = "float" if dict(vectors.dtypes)[embedding] == "array<float>" else "double"
    found = None
    for dim, n in sorted(dims):
        part = _links(classes.where(F.size("v") == dim), dim, CapCode(dim, n, per_vector, bucket, cosine=cosine), real, cosine, block_rows)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "c bigint, links bigint, tie bigint")
    found = materialise(found)
    kind = dict(vectors.dtypes)[vec]
    ties = found.where("tie <> c").select(F.col("c").alias("a"), F.col("tie").alias("b"))
    # an id with several vectors ties its classes together
    several = members.groupBy("id").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("id")
    ties = ties.unionByName(members.join(several, "id").select(F.col("id").alias("a"), F.col("c").alias("b")))
    group = components(ties)
    links = found.groupBy("c").agg(F.sum("links").alias("links"))
    info = classes.groupBy("c").agg(F.max("copies").alias("copies")).join(links, "c", "left").join(
        group.withColumnRenamed("id", "c"), "c", "left"
    ).select("c", F.coalesce("links", F.lit(0)).alias("links"), "copies", F.coalesce("component", "c").alias("component"))
    per_id = members.join(info, "c").groupBy("id").agg(
        (F.sum(F.col("links") + F.col("copies")) - 1).cast("bigint").alias("n_links"), F.min("component").alias("component")
    )
    out = rows.select("id").join(per_id, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").cast(kind).alias(vec), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.cast(kind).alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"),
    )


def _links(classes: DataFrame, dim: int, code: CapCode, real: str, cosine: float, block_rows: int) -> DataFrame:
    """Links of classes by verified products inside each direction's bucket: rows (c, links, tie)."""

    def decode(batches):
        for b in slices(batches, 1024):
            rows = _unit(_matrix(b.column("v"), dim))
            at, which = code.decode(rows)
            first = np.searchsorted(at, np.arange(len(rows) + 1))
            # every row carries its directions before its own: a pair is counted in the first that both have
            n_before = np.arange(len(at)) - first[at]
            ends = np.concatenate(([0], np.cumsum(n_before)))
            before = which[np.arange(ends[-1]) - np.repeat(ends[:-1] - first[at], n_before)]
            pick = pa.array(at)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(before, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int64()), b.column("c").take(pick), b.column("copies").take(pick), b.column("v").take(pick), lists],
                names=["f", "c", "copies", "v", "before"],
            )

    spread = materialise(classes.select("c", "copies", F.col("v").cast(f"array<{real}>").alias("v")).mapInArrow(
        decode, f"f bigint, c bigint, copies bigint, v array<{real}>, before array<bigint>"
    ))
    sizes = spread.groupBy("f").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).cast("bigint").alias("k"))
    cut = spread.join(sizes, "f").withColumn("mine", F.pmod(F.xxhash64("c", "f"), F.col("k")))
    pairs = cut.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("other")).select(
        "f", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "c", "copies", "v", "before"
    )
    dealt = pairs.repartition("f", "i", "j").sortWithinPartitions("f", "i", "j", "c")

    def verify(batches):
        out = ([], [], [])
        for t in runs(batches, ["f", "i", "j"]):
            if t.num_rows < 2:
                continue
            got = _product(t, dim, cosine)
            for held, new in zip(out, got):
                held.append(new)
            if len(out[0]) >= 256:
                yield _flush(out)
        if out[0]:
            yield _flush(out)

    return dealt.mapInArrow(verify, "c bigint, links bigint, tie bigint")


def _flush(out: tuple[list, list, list]) -> pa.RecordBatch:
    batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], names=["c", "links", "tie"])
    for x in out:
        x.clear()
    return batch


def _product(t: pa.Table, dim: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified links of one pair of blocks: per vector the copies it links with, and the least id of its local component."""
    f, i, j = (t.column(k)[0].as_py() for k in ("f", "i", "j"))
    mine = t.column("mine").to_numpy()
    ids = t.column("c").to_numpy()
    copies = t.column("copies").to_numpy()
    x = _unit(_matrix(t.column("v"), dim))
    linked = x @ x.T >= cosine
    if i == j:
        np.fill_diagonal(linked, False)
    else:  # pairs inside a block belong to the block's own product
        linked &= mine[:, None] != mine[None, :]
    a, b = np.nonzero(linked)
    none = np.zeros(0, dtype=np.int64)
    if not len(a):
        return none, none, none
    # a pair counts where f is the first direction that both have
    lists = [np.asarray(v) for v in t.column("before").to_pylist()]
    used = np.unique(a)
    codes = {v: k for k, v in enumerate(sorted(set(itertools.chain.from_iterable(lists[u].tolist() for u in used))))}
    lower = np.zeros((len(ids), len(codes)), dtype=np.float32)
    for u in used.tolist():
        for v in lists[u].tolist():
            lower[u, codes[v]] = 1
    earlier = lower @ lower.T > 0 if lower.shape[1] else np.zeros_like(linked)
    count = (np.where(earlier, 0, linked) * copies[None, :]).sum(axis=1)
    least = lowest(len(ids), a, b)
    return ids[used], count[used].astype(np.int64), ids[least[used]]
