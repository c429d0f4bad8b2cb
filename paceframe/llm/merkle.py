"""Merkle manifest of a dataset in van Emde Boas order.

Rows are leaves; the leaves of one group make a tree in which every ``ARITY`` consecutive
nodes have one parent, and the trees' roots make one more tree. A tree is cut into aligned
blocks of ``ARITY ** HEIGHT`` leaves. A block is one array of digests in van Emde Boas
order: a subtree of L levels is its upper L // 2 levels followed by the subtrees below
them, each laid out likewise, so a walk from a leaf to the block's root touches few
stretches of the array whatever the size of a cache line. The roots of blocks are the
leaves of the next layer, until each tree is one block. Tasks hold one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scan import sorted_rank
from .arrow import runs, slices
from .store import materialise
from .text import ascii_lower

ARITY = 8
HEIGHT = 4  # of a block: 4,096 leaves
DIGEST = 32
RANK_ROWS = 200_000  # rows of one range of the global order
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: rows of blocks: keys and changed digests of the leaves, and all nodes in van Emde Boas order
BLOCKS = "tree bigint, block bigint, height int, n int, tags array<string>, changed array<binary>, nodes binary"
PATH = "array<struct<before: string, after: string>>"
PATH_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
PROOFS = f"tree bigint, pos bigint, tag string, leaf string, subroot string, root string, path {PATH}, proof_sha256 string, folded_root string"


# ---- leaves

def field(col: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


# ---- layout

def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of nodes ``index`` of one depth (0 is the root) in a complete tree of so many levels."""
    index = np.asarray(index, dtype=np.int64)
    if levels <= 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    # bottom trees stand one after the other behind the top tree
    width = ARITY ** (depth - top)
    return size(top) + index // width * size(levels - top) + address(levels - top, depth - top, index % width)


def size(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def parent(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(map(bytes.hex, children)).encode()).digest()


def widths(height: int, n: int) -> list[int]:
    """Nodes of each level of a block from the leaves up."""
    out = [n]
    for _ in range(height):
        out.append(-(-out[-1] // ARITY))
    return out


def construct(height: int, leaves: Sequence[bytes]) -> bytes:
    """The block's array; places without a node are zero."""
    levels = height + 1
    nodes = np.zeros((size(levels), DIGEST), dtype=np.uint8)
    row = list(leaves)
    for up, width in enumerate(widths(height, len(leaves))):
        if up:
            row = [parent(row[i:i + ARITY]) for i in range(0, len(row), ARITY)]
        at = address(levels, height - up, np.arange(width))
        nodes[at] = np.frombuffer(b"".join(row), dtype=np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


class Block:
    """Reads nodes of a stored array by address."""

    def __init__(self, height: int, n: int, nodes: bytes):
        self.height, self.nodes, self.widths = height, nodes, widths(height, n)
        self.at = [address(height + 1, height - up, np.arange(w)).tolist() for up, w in enumerate(self.widths)]

    def node(self, up: int, index: int) -> bytes:
        at = self.at[up][index] * DIGEST
        return self.nodes[at:at + DIGEST]

    def hexes(self) -> list[list[str]]:
        return [[self.node(up, i).hex() for i in range(w)] for up, w in enumerate(self.widths)]


def paths(block: Block) -> list[list[tuple[str, str]]]:
    """Per leaf and level up to the block's root: the siblings before and after it, as hex text."""
    rows = block.hexes()
    out = []
    for i in range(block.widths[0]):
        own, at = [], i
        for row in rows[:-1]:
            first = at - at % ARITY
            own.append(("".join(row[first:at]), "".join(row[at + 1:first + ARITY])))
            at //= ARITY
        out.append(own)
    return out


def fold(digest: bytes, path: Sequence[tuple[str, str]]) -> str:
    """Root that a leaf and its siblings give, as hex text."""
    text = digest.hex()
    for before, after in path:
        text = hashlib.sha256(f"{before}{text}{after}".encode()).hexdigest()
    return text


# ---- distributed construction

@dataclass
class Manifest:
    """Written tables: ``layers`` of blocks from the leaves up (BLOCKS), ``groups`` (the group's value, tree, subroot)
    and ``top``, the layers over the subroots."""

    group: str
    layers: list[DataFrame]
    groups: DataFrame
    top: list[DataFrame]


def _layer(nodes: DataFrame) -> DataFrame:
    """Blocks of rows (tree, pos, total, tag, leaf, changed)."""
    whole = ARITY**HEIGHT
    height = F.when(F.col("total") > whole, F.lit(HEIGHT))
    for h in range(HEIGHT + 1):
        height = height.when(F.col("total") <= ARITY**h, F.lit(h))
    rows = nodes.withColumns({"block": F.floor(F.col("pos") / whole), "height": height})
    dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")

    def build(batches):
        for t in runs(batches, ["tree", "block"]):
            leaves = t.column("leaf").to_pylist()
            height = t.column("height")[0].as_py()
            yield pa.RecordBatch.from_pydict({
                "tree": t.column("tree")[:1].to_pylist(), "block": t.column("block")[:1].to_pylist(), "height": pa.array([height], pa.int32()),
                "n": pa.array([len(leaves)], pa.int32()), "tags": pa.array([t.column("tag").to_pylist()], pa.list_(pa.string())),
                "changed": pa.array([t.column("changed").to_pylist()], pa.list_(pa.binary())),
                "nodes": pa.array([construct(height, leaves)], pa.binary()),
            })

    return materialise(dealt.mapInArrow(build, BLOCKS))


def _roots(blocks: DataFrame) -> DataFrame:
    # the first node of the order is the root
    return blocks.select("tree", F.col("block").alias("pos"), F.expr(f"substring(nodes, 1, {DIGEST})").alias("leaf"))


def _layers(nodes: DataFrame) -> list[DataFrame]:
    """Layers of blocks until no tree has two; a layer has ``ARITY ** HEIGHT`` times fewer rows than the one below."""
    out = [_layer(nodes)]
    while out[-1].where("block > 0").limit(1).count():
        roots = _roots(out[-1])
        totals = roots.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
        out.append(_layer(roots.join(totals, "tree").where("total > 1").withColumns(
            {"tag": F.lit(None).cast("string"), "changed": F.lit(None).cast("binary")})))
    return out


def build(rows: DataFrame, key: str, group: str, leaf: str, changed: str, rank_rows: int = RANK_ROWS) -> Manifest:
    """Trees over the digests ``leaf`` of rows, in ascending order of ``key`` within ``group``.

    ``changed`` is another digest kept beside a leaf, or NULL. NULL keys and the NULL group
    come first; rows that share group and key stand in the order of their digests, all of
    them. Group values order as UTF-8 bytes. A table without rows has no trees.
    """
    narrow = materialise(rows.select(
        F.col(key).alias("key"), F.col(group).alias("grp"), F.col(leaf).alias("leaf"), F.col(changed).alias("changed"),
        F.monotonically_increasing_id().alias("tie"),
    ))
    # the written tie cuts repeated rows into ranges like any others; the ranges are written, so the rank can be read twice
    ranked = sorted_rank(narrow, ["grp", "key", "leaf", "tie"], "rank", rank_rows)
    sizes = ranked.groupBy("grp").agg(F.count(F.lit(1)).alias("total"), F.min("rank").alias("first"))
    trees = materialise(sorted_rank(sizes, ["grp"], "tree", rank_rows))
    placed = ranked.join(trees, ranked["grp"].eqNullSafe(trees["grp"]))
    nodes = placed.select(
        "tree", (F.col("rank") - F.col("first")).alias("pos"), "total", F.col("key").cast("string").alias("tag"), "leaf", "changed"
    )
    layers = _layers(nodes)
    ends = reduce(DataFrame.unionByName, [_roots(x).withColumn("layer", F.lit(k)) for k, x in enumerate(layers)])
    last = ends.groupBy("tree").agg(F.max(F.struct("layer", "leaf")).alias("end")).select("tree", F.col("end.leaf").alias("subroot"))
    groups = materialise(trees.join(last, "tree").select(F.col("grp").alias(group), "tree", "total", "subroot"))
    total = groups.count()
    over = groups.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.lit(total).cast("bigint").alias("total"),
        F.lit(None).cast("string").alias("tag"), F.col("subroot").alias("leaf"), F.lit(None).cast("binary").alias("changed"),
    )
    return Manifest(group, layers, groups, _layers(over))


# ---- sibling retrieval

def _down(layers: list[DataFrame], ends: DataFrame) -> DataFrame:
    """Blocks of the lowest layer with the path above them.

    ``ends`` holds (tree, path, subroot, root) above each tree's last layer.
    """
    above = None
    for depth in reversed(range(len(layers))):
        blocks = layers[depth]
        # a tree that ends in this layer has one block here, and its path comes from outside
        own = blocks.join(ends, "tree")
        if above is not None:
            tall = above.withColumnRenamed("pos", "block")
            single = own.join(tall.select("tree").distinct(), "tree", "left_anti")
            own = blocks.join(tall, ["tree", "block"]).unionByName(single)
        if not depth:
            return own

        def emit(batches):
            for b in slices(batches, 1):
                for r in b.to_pylist():
                    found = paths(Block(r["height"], r["n"], r["nodes"]))
                    first = r["block"] * ARITY**HEIGHT
                    up = [(x["before"], x["after"]) for x in r["path"]]
                    for i in range(0, len(found), 256):
                        part = found[i:i + 256]
                        yield pa.RecordBatch.from_pydict({
                            "tree": pa.array([r["tree"]] * len(part), pa.int64()), "pos": pa.array(range(first + i, first + i + len(part)), pa.int64()),
                            "path": pa.array([[{"before": x, "after": y} for x, y in p + up] for p in part], PATH_ARROW),
                            "subroot": [r["subroot"]] * len(part), "root": [r["root"]] * len(part),
                        })

        above = materialise(own.mapInArrow(emit, f"tree bigint, pos bigint, path {PATH}, subroot string, root string"))


def _ends(manifest: Manifest) -> DataFrame:
    """Per tree: its subroot, the root over all trees, and the siblings of the subroot on the way there."""
    top = manifest.top
    spark = manifest.groups.sparkSession
    last = _roots(top[-1]).first()
    none = spark.range(0).select(F.col("id").alias("tree"))
    root = bytes(last["leaf"]).hex() if last else ""
    start = (none if last is None else spark.range(1).select(F.col("id").alias("tree"))).select(
        "tree", F.array().cast(PATH).alias("path"), F.lit("").alias("subroot"), F.lit(root).alias("root")
    )

    def emit(batches):
        for b in slices(batches, 1):
            for r in b.to_pylist():
                first = r["block"] * ARITY**HEIGHT
                up = [(x["before"], x["after"]) for x in r["path"]]
                block = Block(r["height"], r["n"], r["nodes"])
                found = [p + up for p in paths(block)]
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array(range(first, first + len(found)), pa.int64()),
                    "path": pa.array([[{"before": x, "after": y} for x, y in p] for p in found], PATH_ARROW),
                    "subroot": [block.node(0, i).hex() for i in range(len(found))], "root": [r["root"]] * len(found),
                })

    return materialise(_down(top, start).mapInArrow(emit, f"tree bigint, path {PATH}, subroot string, root string"))


def proofs(manifest: Manifest, with_path: bool = True) -> DataFrame:
    """One row per leaf: its key as text (``tag``), digests, the siblings on its way to the root (``path``), the digest
    of all of them in that order, and the root folded from the changed leaf, or from the leaf where none is kept."""
    blocks = _down(manifest.layers, _ends(manifest))

    def emit(batches):
        for b in slices(batches, 1):
            for r in b.to_pylist():
                block = Block(r["height"], r["n"], r["nodes"])
                up = [(x["before"], x["after"]) for x in r["path"]]
                tail = "".join(x + y for x, y in up).encode()
                found = paths(block)
                first = r["block"] * ARITY**HEIGHT
                for i in range(0, len(found), 512):
                    part = found[i:i + 512]
                    k = len(part)
                    leaves = [block.node(0, j) for j in range(i, i + k)]
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([r["tree"]] * k, pa.int64()), "pos": pa.array(range(first + i, first + i + k), pa.int64()),
                        "tag": pa.array(r["tags"][i:i + k], pa.string()), "leaf": [x.hex() for x in leaves],
                        "subroot": [r["subroot"]] * k, "root": [r["root"]] * k,
                        "path": pa.array([[{"before": x, "after": y} for x, y in p + up] if with_path else [] for p in part], PATH_ARROW),
                        "proof_sha256": [hashlib.sha256("".join(x + y for x, y in p).encode() + tail).hexdigest() for p in part],
                        "folded_root": [fold(c or x, p + up) for c, x, p in zip(r["changed"][i:i + k], leaves, part)],
                    })

    return blocks.mapInArrow(emit, PROOFS)


def tampered_text(key: Column, text: Column) -> Column:
    """The text with A-Z lowered where 3 divides the CRC-32 of the key's decimal digits; a NULL key leaves it alone."""
    return F.when(F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 0, F.lit(False)), ascii_lower(text)).otherwise(text)


def audit(docs: DataFrame, key: str = "doc_id", group: str = "lang", text: str = "text", fields: Sequence[str] = FIELDS) -> DataFrame:
    """Manifest of ``docs`` and the check of a tampered copy against it, one row per document.

    A leaf is the digest of ``fields``. NULL and empty values differ. Columns that are not
    fields are not read. Returns the key, ``leaf``, ``subroot``, ``root``, ``proof_sha256``,
    ``folded_root`` (with the tampered leaf, where tampering changed the text) and ``verified``.
    A table without rows gives none.
    """
    kept = [F.col(f) for f in fields]
    bent = [tampered_text(F.col(key), F.col(text)) if f == text else F.col(f) for f in fields]
    rows = docs.select(
        F.col(key).alias("key"), F.col(group).alias("grp"), leaf(kept).alias("leaf"),
        F.when(tampered_text(F.col(key), F.col(text)) != F.col(text), leaf(bent)).alias("changed"),
    )
    found = proofs(build(rows, "key", "grp", "leaf", "changed"), with_path=False)
    kind = dict(docs.dtypes)[key]
    return found.select(
        F.col("tag").cast(kind).alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
