"""A bitmap of fixed size that tells which keys can be in a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = 1 << 15  # bits of one row of the bitmap


def bitmap(keys: DataFrame, col: str, bits: int) -> DataFrame:
    """Rows (page, map) of a bitmap of ``bits`` bits with the bit of every key of a bigint column set.

    Built by aggregation, at most ``bits`` / PAGE rows of 4 KB: its size does not grow with the table.
    """
    at = F.pmod(F.col(col), F.lit(bits))
    return keys.select(F.floor(at / F.lit(PAGE)).cast("int").alias("page"), F.pmod(at, F.lit(PAGE)).alias("bit")).groupBy(
        "page").agg(F.bitmap_construct_agg("bit").alias("map"))


def collected(keys: DataFrame, col: str, bits: int) -> np.ndarray:
    """The bitmap as one array of ``bits`` / 8 bytes."""
    out = np.zeros(bits // 8, dtype=np.uint8)
    for page, data in bitmap(keys, col, bits).collect():
        out[page * PAGE // 8:(page + 1) * PAGE // 8] = np.frombuffer(data, dtype=np.uint8)
    return out


def may_hold(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys have their bit set; true for every key of the table."""
    at = keys.view(np.uint64) & np.uint64(len(sieve) * 8 - 1)
    return (sieve[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def marked(df: DataFrame, key: Column, keys: DataFrame, col: str, bits: int, name: str) -> DataFrame:
    """Rows with a flag ``name``: may the key be in a table, by a join with the broadcast bitmap (``bits`` / 8 bytes)."""
    at = F.pmod(key, F.lit(bits))
    pages = bitmap(keys, col, bits)
    rows = df.withColumn("_sv_page", F.floor(at / F.lit(PAGE)).cast("int")).withColumn("_sv_bit", F.pmod(at, F.lit(PAGE)).cast("int"))
    joined = rows.join(F.broadcast(pages), F.col("_sv_page") == F.col("page"), "left")
    byte = "cast(conv(hex(substring(map, shiftright(_sv_bit, 3) + 1, 1)), 16, 10) as int)"
    hit = F.coalesce(F.expr(f"shiftright({byte}, pmod(_sv_bit, 8)) & 1 = 1"), F.lit(False))
    return joined.withColumn(name, hit).drop("_sv_page", "_sv_bit", "page", "map")


def split(df: DataFrame, key: Column, keys: DataFrame, col: str, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in a table, and the others."""
    rows = marked(df, key, keys, col, bits, "_sv_hit")
    return rows.where("_sv_hit").drop("_sv_hit"), rows.where("not _sv_hit").drop("_sv_hit")
