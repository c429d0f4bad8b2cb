"""Connected components of links between ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import discard, materialise

MAX_ROUNDS = 60
SLAB = 400_000  # links that a task contracts at a time
EDGE = "u bigint, v bigint"


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (id, component) per linked id; ``component`` is the smallest id reachable.

    Tasks first contract the links they read to stars around their smallest ids; then
    large-star and small-star steps in turn tie every neighbour above, and below, an id
    to the smallest one, until all edges are stars. Rounds grow with the logarithm of a
    component's size. Each step aggregates before it joins, so a hot id moves one row
    per task into the aggregate, and the join splits it. No links give no rows.
    """
    edges = links.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).where("u <> v")
    edges = materialise(edges.mapInArrow(_contract, EDGE).distinct())
    for _ in range(MAX_ROUNDS):
        if _are_stars(edges):
            break
        before = edges
        edges = materialise(_small_star(_large_star(before.mapInArrow(_contract, EDGE))))
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    tops = edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(tops)


def _are_stars(edges: DataFrame) -> bool:
    """Every id has one end above it at most, and none that is an upper end is also a lower one."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("low")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("low"))
    )
    bad = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up > 1 or up + low > 1")
    return bad.limit(1).count() == 0


def _contract(batches):
    """Edges (u, v) to the smallest id v of each component of a slab, u > v."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= SLAB:
            yield _stars(held)
            held, rows = [], 0
    if rows:
        yield _stars(held)


def _stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    t = pa.Table.from_batches(held)
    ends = np.concatenate((t.column("u").to_numpy(), t.column("v").to_numpy()))
    ids, at = np.unique(ends, return_inverse=True)
    label = lowest(len(ids), at[:t.num_rows], at[t.num_rows:])
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[label[moved]])], names=["u", "v"])


def lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indexes over the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        np.minimum.at(new, label, new.copy())
        while True:
            short = new[new]
            if (short == new).all():
                break
            new = short
        if (new == label).all():
            return label
        label = new


def _large_star(edges: DataFrame) -> DataFrame:
    """Of edges (u, v) with u > v, each neighbour above an id goes to the smallest of the id and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    # an id that is no upper end has itself as the smallest
    above = edges.select(F.col("v").alias("u"), F.col("u").alias("w"))
    out = above.join(least, "u", "left").select(F.col("w").alias("u"), F.coalesce("m", "u").alias("v"))
    return out.where("u > v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each neighbour below an id, and the id, go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
