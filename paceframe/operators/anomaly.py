"""Anomalies: isolation trees, local outlier factor, and a vote of methods."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import digest_number
from ..session import materialise
from .joins import left_join
from .neighbors import BLOCK_ROWS, knn_join
from .quantiles import EXACT_ROWS, column_quantiles

SUBSAMPLE = 256
PRIME = 4294967291  # the largest below 2 ** 32


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search in a binary tree of n leaves."""
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    m = n[big]
    out[big] = 2.0 * (np.log(m - 1.0) + np.euler_gamma) - 2.0 * (m - 1.0) / m
    return out


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple[int, float, int, int, float]]:
    """One isolation tree as rows (feature, cut, left, right, depth at leaf)."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(nodes)
        if parent >= 0:
            nodes[parent][2 + side] = me
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(open_features):
            nodes.append([-1, 0.0, -1, -1, depth + float(_average_path(np.array([len(rows)]))[0])])
            continue
        f = int(rng.choice(open_features))
        cut = float(rng.uniform(low[f], high[f]))
        nodes.append([f, cut, -1, -1, 0.0])
        goes_left = part[:, f] <= cut
        todo.append((rows[~goes_left], depth + 1, me, 1))
        todo.append((rows[goes_left], depth + 1, me, 0))
    return [tuple(n) for n in nodes]


def _turn(tree: int) -> tuple[int, int]:
    """Factor and shift of a tree's hash of row digests."""
    return (tree * 2654435761 + 1) % PRIME or 1, (tree * 40503 + 7) % PRIME


def _drawn(trees: int, subsample: int):
    """Task function: the first ``subsample`` rows of every tree's order among the task's rows."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple | None] = [None] * trees
        for b in batches:
            if not b.num_rows:
                continue
            base = b.column("base").to_numpy(zero_copy_only=False).astype(np.uint64)
            ids = b.column("id").to_numpy(zero_copy_only=False)
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            for t in range(trees):
                factor, shift = _turn(t)
                place = (base * np.uint64(factor) + np.uint64(shift)) % np.uint64(PRIME)
                at = np.lexsort((ids, place))[:subsample] if len(place) <= subsample else None
                if at is None:
                    some = np.flatnonzero(place <= np.partition(place, subsample - 1)[subsample - 1])
                    at = some[np.lexsort((ids[some], place[some]))][:subsample]
                own = place[at], ids[at], x[at]
                if held[t] is not None:
                    own = tuple(np.concatenate(p) for p in zip(held[t], own))
                    order = np.lexsort((own[1], own[0]))[:subsample]
                    own = tuple(p[order] for p in own)
                held[t] = own
        for t, own in enumerate(held):
            if own is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own[0]), t), pa.int32()), pa.array(own[0].astype(np.int64)), pa.array(own[1]), pa.array(list(own[2]), pa.list_(pa.float64()))],
                    names=["tree", "place", "id", "v"])

    return draw


def isolation_samples(
    df: DataFrame, id_col: str, vec: str = "vec", trees: int = 100, subsample: int = SUBSAMPLE, seed: int = 42
) -> DataFrame:
    """Rows (tree, place, id, v): each tree's sub-sample over all rows with a vector, by an integer id.

    A row's digest, times a factor of the tree, plus a shift, modulo a prime is its place in
    the tree's order; the first ``subsample`` places are drawn. Tasks send no more than
    that per tree.
    """
    pool = df.select(digest_number(F.col(id_col), seed).alias("base"), F.col(id_col).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("v"))
    drawn = pool.where(F.col("v").isNotNull() & F.col("id").isNotNull()).mapInArrow(
        _drawn(trees, subsample), "tree int, place bigint, id bigint, v array<double>")
    first = Window.partitionBy("tree").orderBy("place", "id")
    return drawn.withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= subsample).drop("__r")


def isolation_scores(
    df: DataFrame, id_col: str, vec: str = "vec", trees: int = 100, subsample: int = SUBSAMPLE, seed: int = 42,
    name: str = "isolation_score",
) -> DataFrame:
    """Isolation score in [-1, 0]; the lower, the more anomalous.

    Each tree learns from a sub-sample of its own over all rows (``isolation_samples``) and
    grows where its rows meet; only the nodes, a fixed number, reach the driver and then
    score every row where it lies.
    """
    drawn = isolation_samples(df, id_col, vec, trees, subsample, seed)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["place", "id"])
        t = int(pdf["tree"].iloc[0])
        limit = int(np.ceil(np.log2(max(min(subsample, len(pdf)), 2))))
        nodes = _grow(np.stack(pdf["v"].to_numpy()).astype(float), np.random.default_rng([seed, t]), limit)
        return pd.DataFrame(nodes, columns=["feature", "cut", "left", "right", "depth"]).assign(
            tree=t, node=range(len(nodes)), size=len(pdf))

    grown = drawn.groupBy("tree").applyInPandas(
        grow, "tree long, node int, feature int, cut double, left int, right int, depth double, size int"
    ).toPandas().sort_values(["tree", "node"])
    if grown.empty:
        return df.withColumn(name, F.lit(None).cast("double"))
    size = int(grown["size"].iloc[0])
    spark = df.sparkSession
    forest = spark.sparkContext.broadcast(
        [tuple(g[c].to_numpy() for c in ("feature", "cut", "left", "right", "depth")) for _, g in grown.groupby("tree")]
    )
    norm = float(_average_path(np.array([size]))[0]) or 1.0

    @F.pandas_udf("double")
    def score(vec: pd.Series) -> pd.Series:
        known = vec.notna().to_numpy()
        out = np.full(len(vec), np.nan)
        if known.any():
            m = np.stack(vec[known].to_numpy())
            total = np.zeros(len(m))
            for feature, cut, left, right, depth in forest.value:
                at = np.zeros(len(m), dtype=int)
                moving = feature[at] >= 0
                while moving.any():
                    i = np.flatnonzero(moving)
                    f = feature[at[i]]
                    at[i] = np.where(m[i, f] <= cut[at[i]], left[at[i]], right[at[i]])
                    moving[i] = feature[at[i]] >= 0
                total += depth[at]
            out[known] = -np.exp2(-total / len(forest.value) / norm)
        return pd.Series(out).where(known)

    return df.withColumn(name, score(F.col(vec).cast("array<double>")))


def flag_lowest(df: DataFrame, score: str, contamination: float = 0.1, name: str = "is_anomaly", exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Rows whose score lies below the contamination quantile."""
    edge = column_quantiles(df.select(score), [score], [contamination], exact_rows=exact_rows)[score][0]
    return df.withColumn(name, F.coalesce(F.col(score) < F.lit(edge).cast("double"), F.lit(False)))


def lof_scores(
    df: DataFrame, id_col: str, vec: str = "vec", k: int = 20, name: str = "lof_score", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Negative local outlier factor per row (about -1 is normal).

    The neighbour table feeds three joins, so it is written once instead of being
    computed three times.
    """
    near = materialise(knn_join(df, df, k, id_col, vec, exclude_self=True, block_rows=block_rows))
    reach_of = near.groupBy("id").agg(F.max("distance").alias("k_distance"))
    reach = near.join(reach_of.withColumnRenamed("id", "neighbor_id"), "neighbor_id")
    density = reach.groupBy("id").agg(
        (1.0 / (F.avg(F.greatest("k_distance", "distance")) + F.lit(1e-10))).alias("density")
    )
    around = near.join(density.withColumnsRenamed({"id": "neighbor_id", "density": "other"}), "neighbor_id")
    factor = around.groupBy("id").agg(F.avg("other").alias("other")).join(density, "id").select(
        F.col("id").alias(id_col), (-F.col("other") / F.col("density")).alias(name)
    )
    return left_join(df, factor, id_col)


def consensus(df: DataFrame, flags: Sequence[str], votes: int = 2) -> DataFrame:
    """Number of methods that flag a row, and whether enough of them do."""
    total = sum((F.coalesce(F.col(c), F.lit(False)).cast("int") for c in flags), F.lit(0))
    return df.withColumn("anomaly_votes", total).withColumn("is_anomaly_final", F.col("anomaly_votes") >= votes)


def anomaly_report(df: DataFrame, id_col: str) -> DataFrame:
    """Anomalous rows, most votes first."""
    return df.where("is_anomaly_final").orderBy(F.desc("anomaly_votes"), F.asc(id_col))


def method_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows flagged by each method, with percent."""
    pairs = F.array(*[F.struct(F.lit(c).alias("method"), F.count_if(F.col(c)).alias("flagged")) for c in flags])
    wide = df.agg(pairs.alias("p"), F.count(F.lit(1)).alias("rows"))
    return wide.select(F.explode("p").alias("p"), "rows").select(
        "p.method", "p.flagged", (F.col("p.flagged") * 100.0 / F.col("rows")).alias("percent")
    )
