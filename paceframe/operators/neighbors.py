"""Exact nearest neighbours and distance sums over vectors, block by block.

Vectors are grouped into blocks of a bounded number of rows, each block one
row of a written table. Every block of one side meets every block of the other
in a product of partitions, which reads both sides where they lie and shuffles
nothing; NumPy works inside a pair, a task keeps the running result of the
block at hand, and only that leaves it (the k nearest, or a sum per cluster) -
never the pairs. So what is shuffled grows with the rows, though the work is
quadratic. Equal vectors are collapsed first, so a large group of copies is one
vector with a count.

The neighbour join prunes with the triangle inequality: base vectors belong to
cells around sampled pivots, and a query block visits a cell only if the cell
can hold something nearer than a proven bound. The bound never cuts a true
neighbour, so results are exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

BLOCK_ROWS = 1_024
MAX_CELLS = 512
PARTS = 8  # partitions of the second side of a product, each of which leaves a result per row of the first
PART_BLOCKS = 256  # blocks of such a partition at most
TILE = 128  # rows of a block whose distances are taken at once
_PAIR_CHUNK = 65_536


def _exact(a: np.ndarray, b: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of the listed index pairs by direct differences."""
    out = np.empty(len(r))
    for i in range(0, len(r), _PAIR_CHUNK):
        s = slice(i, i + _PAIR_CHUNK)
        diff = a[r[s]] - b[c[s]]
        out[s] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances of two blocks through matrix products.

    The product loses digits where points nearly coincide, so those pairs are
    redone by direct differences; the rest is good to about ten digits.
    """
    out = np.empty((len(a), len(b)))
    own, other = (a * a).sum(1), (b * b).sum(1)
    for i in range(0, len(a), TILE):
        part = a[i:i + TILE]
        norms = own[i:i + TILE, None] + other[None, :]
        sq = out[i:i + TILE]
        np.matmul(-2.0 * part, b.T, out=sq)
        sq += norms
        norms *= 1e-5
        r, c = np.nonzero(sq < norms)
        np.maximum(sq, 0.0, out=sq)
        np.sqrt(sq, out=sq)
        sq[r, c] = _exact(part, b, r, c)
    return out


def _matrix(flat, rows: int) -> np.ndarray:
    return np.asarray(flat, dtype=float).reshape(rows, -1)


def _nearest(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and exact distances of the k nearest b per a, ties by column.

    Block distances only preselect, with a margin; the ranking is on exact ones.
    """
    d = _distances(a, b)
    k = min(k, d.shape[1])
    edge = np.partition(d, k - 1, axis=1)[:, k - 1]
    r, c = np.nonzero(d <= edge[:, None] * (1 + 1e-7) + 1e-12)
    exact = _exact(a, b, r, c)
    order = np.lexsort((c, exact, r))
    r, c, exact = r[order], c[order], exact[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], c[keep], exact[keep]


def _within(x: np.ndarray, edge: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and exact distances of at least all pairs no farther than the row's edge."""
    own, other = (x * x).sum(1), (b * b).sum(1)
    # the product is off by far less than this share of the norms
    limit = (edge * (1 + 1e-7) + 1e-12) ** 2 + 1e-11 * (own + other.max(initial=0.0)) - own
    rows, cols = [], []
    for i in range(0, len(x), TILE):
        sq = (-2.0 * x[i:i + TILE]) @ b.T
        sq += other
        r, c = np.nonzero(sq <= limit[i:i + TILE, None])
        rows.append(r + i)
        cols.append(c)
    r, c = np.concatenate(rows), np.concatenate(cols)
    return r, c, _exact(x, b, r, c)


def _item(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


class _Running:
    """The nearest found so far of a query block's rows, ties by id, and how far away a better one can be."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, edge: np.ndarray, want: int):
        self.x, self.ids, self.edge, self.want = x, ids, edge.copy(), want
        self.found: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def meet(self, b: np.ndarray, b_ids: np.ndarray, rows: np.ndarray) -> None:
        """Compare the listed rows with a base block."""
        if not len(rows):
            return
        x, edge = self.x[rows], self.edge[rows]
        r, c, d = _nearest(x, b, self.want) if np.isinf(edge).any() else _within(x, edge, b)
        near = d <= edge[r] * (1 + 1e-7) + 1e-12
        if not near.any():
            return
        r, d, ids = rows[r[near]], d[near], b_ids[c[near]]
        if self.found is not None:
            r, d, ids = (np.concatenate(p) for p in zip(self.found, (r, d, ids)))
        order = np.lexsort((np.unique(ids, return_inverse=True)[1].ravel(), d, r))
        r, d, ids = r[order], d[order], ids[order]
        turn = np.arange(len(r)) - np.searchsorted(r, r)
        keep = turn < self.want
        last = turn == self.want - 1
        self.edge[r[last]] = np.minimum(self.edge[r[last]], d[last])
        self.found = r[keep], d[keep], ids[keep]

    def rows(self, kind: pa.DataType, base_kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if self.found is not None:
            r, d, ids = self.found
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.ids[r], kind), pa.array(ids, base_kind), pa.array(d)], names=["qid", "bid", "distance"])


def laid_out(blocks: DataFrame, count: int) -> DataFrame:
    """Blocks written to several files, so that a product has a task for each pair of a few of them."""
    most = 4 * blocks.sparkSession.sparkContext.defaultParallelism
    return materialise(blocks.repartition(max(1, min(count, most, max(PARTS, math.ceil(count / 2))))))


def every_pair(left: DataFrame, right: DataFrame, count: int, on: Column | None = None) -> DataFrame:
    """Rows of one written table beside those of another: all rows of the second in turn for each of the first.

    ``count`` is the number of rows of ``right``.
    """
    second = right.coalesce(max(PARTS, math.ceil(count / PART_BLOCKS))).hint("shuffle_replicate_nl")
    return left.join(second, F.lit(True) if on is None else on)


def beside(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Join of two tables that both grow with the rows. Spark counts an array as one value, so it could take one for small enough to go through the driver."""
    return a.join(b.hint("merge"), on)


def _blocks(df: DataFrame, keys: list[str], item: str, extra: list[str] | None = None) -> DataFrame:
    """One row per block: item ids, optional weights, and vectors laid end to end."""
    extra = extra or []
    packed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(item, *extra, "vec"))).alias("b"))
    return packed.select(
        *keys, F.col(f"b.{item}").alias("ids"), *[F.col(f"b.{e}").alias(e) for e in extra],
        F.flatten("b.vec").alias("flat"),
    )


def _pick(values: list[int], index: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]), index)


def knn_join(
    query: DataFrame,
    base: DataFrame,
    k: int,
    id_col: str = "id",
    vec_col: str = "vec",
    exclude_self: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest base rows of every query row: (id, rank, neighbor_id, distance).

    Ties go to the smaller id. With ``exclude_self`` a row is not its own
    neighbour (other rows with an equal vector are).
    """
    want = k + 1 if exclude_self else k
    q = query.select(F.col(id_col).alias("qid"), F.col(vec_col).cast("array<double>").alias("vec")).dropna()
    b = base.select(F.col(id_col).alias("bid"), F.col(vec_col).cast("array<double>").alias("vec")).dropna()

    # distinct base vectors with their first ids; more copies than wanted can never be used
    copy = F.row_number().over(Window.partitionBy("vec").orderBy("bid"))
    bvec = (
        b.withColumn("__c", copy).where(F.col("__c") <= want)
        .groupBy("vec").agg(F.sort_array(F.collect_list("bid")).alias("ids"))
        .withColumn("bid", F.get("ids", F.lit(0)))
    )
    bvec = materialise(bvec)
    qvec = materialise(q.groupBy("vec").agg(F.min("qid").alias("qid")))

    n = bvec.count()
    cells = max(1, min(MAX_CELLS, math.ceil(n / block_rows)))
    sample = bvec.select("bid", "vec").orderBy(F.xxhash64("bid"), "bid").limit(max(cells, 4 * want)).collect()
    if not sample:
        return query.sparkSession.createDataFrame(
            [], f"id {q.schema['qid'].dataType.simpleString()}, rank int, "
                f"neighbor_id {b.schema['bid'].dataType.simpleString()}, distance double")
    anchors = np.array([r["vec"] for r in sample], dtype=float)
    pivots = anchors[:cells]

    @F.pandas_udf("struct<cell:int,gap:double>")
    def locate(vec: pd.Series) -> pd.DataFrame:
        x = np.stack(vec.to_numpy()) if len(vec) else np.empty((0, pivots.shape[1]))
        rough = (pivots * pivots).sum(1)[None, :] - 2.0 * (x @ pivots.T)
        cell = rough.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "gap": np.linalg.norm(x - pivots[cell], axis=1)})

    def place(vectors: DataFrame, item: str) -> tuple[DataFrame, list[int], np.ndarray]:
        """Blocks of a table, their number in each cell, and the radius of the cells."""
        placed = vectors.select(item, "vec", locate("vec").alias("p")).select(item, "vec", "p.cell", "p.gap")
        stats = {r["cell"]: (r["n"], r["radius"]) for r in placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()}
        parts = [math.ceil(stats[c][0] / block_rows) if c in stats else 0 for c in range(cells)]
        part = F.pmod(F.xxhash64(item), _pick(parts, F.col("cell"))).cast("int")
        radius = np.array([stats[c][1] if c in stats else -np.inf for c in range(cells)])
        return _blocks(placed.withColumn("part", part), ["cell", "part"], item), parts, np.where(np.isnan(radius), np.inf, radius)

    base_blocks, parts, radius = place(bvec, "bid")
    base_blocks = laid_out(base_blocks.withColumnsRenamed({"ids": "b_ids", "flat": "b_flat"}), sum(parts))

    # a block of the own cell bounds the distance of the wanted ones better than the anchors do
    first = base_blocks.where("part = 0").select("cell", F.col("b_flat").alias("near_flat"))
    query_blocks, query_parts, _ = place(qvec, "qid")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("near_flat")
            bounds, wanted = [], []
            for i in range(batch.num_rows):
                x = _matrix(_item(batch.column("flat"), i), len(batch.column("ids")[i]))
                d = _distances(x, anchors)
                bound = np.full(len(x), np.inf)
                if anchors.shape[0] >= want:
                    bound = np.partition(d, want - 1, axis=1)[:, want - 1]
                if near[i].is_valid:
                    b = _item(near, i).reshape(-1, x.shape[1])
                    if len(b) >= want:
                        bound = np.minimum(bound, np.partition(_distances(x, b), want - 1, axis=1)[:, want - 1])
                bound = bound * (1 + 1e-7) + 1e-12
                bounds.append(bound)
                wanted.append((d[:, :cells] * (1 - 1e-7) - radius <= bound[:, None]).any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("ids"), batch.column("flat"), pa.array(bounds, pa.list_(pa.float64())),
                 pa.array(wanted, pa.list_(pa.bool_()))], names=["block", "ids", "flat", "bound", "wanted"])

    id_type = q.schema["qid"].dataType.simpleString()
    base_type = b.schema["bid"].dataType.simpleString()
    number = (F.col("cell").cast("bigint") * F.lit(1 << 32) + F.col("part")).alias("block")
    bounded = query_blocks.join(first.hint("merge"), "cell", "left").select(number, "ids", "flat", "near_flat").mapInArrow(
        route, f"block bigint, ids array<{id_type}>, flat array<double>, bound array<double>, wanted array<boolean>"
    )
    pairs = every_pair(laid_out(bounded, sum(query_parts)), base_blocks, sum(parts), F.get("wanted", F.col("cell")))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, state, kinds = None, None, ()
        for batch in batches:
            kinds = batch.column("ids").type.value_type, batch.column("b_ids").type.value_type
            blocks, cell = batch.column("block").to_pylist(), batch.column("cell").to_pylist()
            for i in range(batch.num_rows):
                if blocks[i] != block:
                    if state is not None:
                        yield from state.rows(*kinds)
                    block, ids = blocks[i], _item(batch.column("ids"), i)
                    state = _Running(_matrix(_item(batch.column("flat"), i), len(ids)), ids, _item(batch.column("bound"), i), want)
                    gap = _distances(state.x, pivots) * (1 - 1e-7)
                b_ids = _item(batch.column("b_ids"), i)
                rows = np.flatnonzero(gap[:, cell[i]] - radius[cell[i]] <= state.edge * (1 + 1e-7) + 1e-12)
                state.meet(_matrix(_item(batch.column("b_flat"), i), len(b_ids)), b_ids, rows)
        if state is not None:
            yield from state.rows(*kinds)

    found = pairs.select("block", "cell", "ids", "flat", "bound", "b_ids", "b_flat").mapInArrow(
        nearest, f"qid {id_type}, bid {base_type}, distance double"
    )
    rank = lambda c: F.row_number().over(Window.partitionBy("qid").orderBy("distance", c))
    best = found.withColumn("__r", rank("bid")).where(F.col("__r") <= want).drop("__r")
    # back from distinct vectors to rows
    rows = beside(best, bvec.select("bid", "ids"), "bid").select(
        "qid", "distance", F.explode("ids").alias("neighbor_id")
    )
    rows = rows.withColumn("__r", rank("neighbor_id")).where(F.col("__r") <= want)
    lists = rows.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("distance", "neighbor_id"))).alias("near"))
    by_vec = beside(qvec, lists, "qid").select("vec", "near")
    full = beside(q, by_vec, "vec").select("qid", "near")
    if exclude_self:
        full = full.withColumn("near", F.filter("near", lambda x: x["neighbor_id"] != F.col("qid")))
    return full.select("qid", F.posexplode(F.slice("near", 1, k)).alias("pos", "x")).select(
        F.col("qid").alias("id"), (F.col("pos") + 1).alias("rank"), F.col("x.neighbor_id").alias("neighbor_id"),
        F.col("x.distance").alias("distance"),
    )


def _silhouettes(sums: np.ndarray, own: np.ndarray, size: np.ndarray) -> pa.Array:
    """Silhouettes from the sums of distances to each cluster and the clusters' sizes; 0 alone in a cluster, NULL in none."""
    at = np.flatnonzero(own >= 0)
    part, c, lines = sums[at], own[at], np.arange(len(at))
    a = part[lines, c] / np.maximum(size[c] - 1, 1)
    mean = part / size
    mean[lines, c] = np.inf
    b = mean.min(axis=1, initial=np.inf)
    top = np.maximum(a, b)
    fine = (size[c] > 1) & np.isfinite(b) & (top > 0)
    out = np.full(len(own), np.nan)
    out[at] = 0.0
    out[at[fine]] = (b[fine] - a[fine]) / top[fine]
    return pa.array(out, mask=own < 0)


def cluster_silhouettes(
    df: DataFrame, id_col: str, vec_col: str, clusters: Sequence[str], block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, list[Column]]:
    """Euclid silhouettes of every distinct (vector, clusters), for several clusterings at once.

    Returns (vec, k0, k1, ..., s0, s1, ...), where ki is the number of the row's cluster in
    the i-th clustering, -1 for none, and the columns that number the clusters of ``df``.
    Rows alone in their cluster get 0, rows in none NULL. The work is quadratic in the
    number of distinct vectors by definition, and distances are taken once for all
    clusterings; a task holds a pair of blocks and a sum per cluster for each row of one.
    """
    places = range(len(clusters))
    codes, sizes = [], []
    rows = df.select(F.col(id_col).alias("rid"), F.col(vec_col).cast("array<double>").alias("vec"), *[F.col(c) for c in clusters]).dropna(
        subset=["rid", "vec"])
    rows = rows.where(F.coalesce(*[F.col(c).cast("string") for c in clusters]).isNotNull())
    items = materialise(rows.groupBy("vec", *clusters).agg(F.count(F.lit(1)).cast("double").alias("copies")))
    for c in clusters:
        known = items.where(F.col(c).isNotNull()).groupBy(c).agg(F.sum("copies").alias("n")).orderBy(c).collect()
        sizes.append(np.array([r["n"] for r in known]))
        listed = F.array(*[F.lit(r[c]) for r in known]).cast(f"array<{items.schema[c].dataType.simpleString()}>")
        codes.append((F.coalesce(F.array_position(listed, F.col(c)), F.lit(0)) - 1).cast("int"))
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sizes]))).astype(int)
    count = math.ceil(items.count() / block_rows)
    kept = [f"k{i}" for i in places]
    numbered = items.select("vec", "copies", *[c.alias(k) for c, k in zip(codes, kept)]).withColumn(
        "block", F.pmod(F.xxhash64("vec", *kept), F.lit(max(1, count))).cast("int"))
    packed = numbered.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("vec", *kept, "copies"))).alias("b"))
    blocks = laid_out(packed.select(
        "block", F.flatten("b.vec").alias("flat"), F.col("b.copies").alias("copies"), *[F.col(f"b.{k}").alias(k) for k in kept]), count)
    left = blocks.select("block", F.size("copies").alias("q_rows"), F.col("flat").alias("q_flat"))
    pairs = every_pair(left, blocks.drop("block"), count)

    def packed(block: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None
        for batch in batches:
            numbers, q_rows = batch.column("block").to_pylist(), batch.column("q_rows").to_pylist()
            for i in range(batch.num_rows):
                if numbers[i] != block:
                    if block is not None:
                        yield packed(block, total)
                    block, q = numbers[i], _matrix(_item(batch.column("q_flat"), i), q_rows[i])
                    total = np.zeros((len(q), starts[-1]))
                copies = _item(batch.column("copies"), i)
                member = np.zeros((len(copies), starts[-1]))
                for k, name in enumerate(kept):
                    own = _item(batch.column(name), i)
                    at = np.flatnonzero(own >= 0)
                    member[at, starts[k] + own[at]] = copies[at]
                total += _distances(q, _matrix(_item(batch.column("flat"), i), len(copies))) @ member
        if block is not None:
            yield packed(block, total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None
        for batch in batches:
            for number, part in zip(batch.column("block").to_pylist(), batch.column("total")):
                part = np.frombuffer(part.as_buffer(), dtype=float)
                if number == block:
                    total += part
                    continue
                if block is not None:
                    yield packed(block, total)
                block, total = number, part.copy()
        if block is not None:
            yield packed(block, total)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = [_item(batch.column(k), i) for k in kept]
                sums = np.frombuffer(batch.column("total")[i].as_buffer(), dtype=float).reshape(len(own[0]), -1)
                x = _matrix(_item(batch.column("flat"), i), len(own[0]))
                vecs = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                found = [_silhouettes(sums[:, starts[k]:starts[k + 1]], own[k], sizes[k]) for k in places]
                yield pa.RecordBatch.from_arrays([vecs, *[pa.array(o, pa.int32()) for o in own], *found], names=["vec", *kept, *scores])

    scores = [f"s{i}" for i in places]
    sums = pairs.select("block", "q_rows", "q_flat", "flat", "copies", *kept).mapInArrow(add, "block int, total binary")
    met = sums.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, total binary")
    found = beside(met, blocks, "block").select("total", "flat", *kept).mapInArrow(
        score, ", ".join(["vec array<double>", *[f"{k} int" for k in kept], *[f"{s} double" for s in scores]]))
    return found, codes
