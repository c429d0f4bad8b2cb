"""Jaccard join of documents on word n-grams by blocked sparse products.

A document's row of the incidence matrix is its sorted array of n-gram hashes. The
size-derived bound (at most (x + y) / 19 n-grams differ between linked sets of sizes x
and y at 0.9) splits the columns into one more range than may differ, so linked rows
agree on a whole range: only rows that agree on one can have the overlap, all other
pairs are discarded unseen. Counts of n-grams per hash interval bound the overlap of the
others from above and discard most of them. What is left meets in blocks of bounded size,
where a sparse product accumulates the overlap counts and the exact bound decides.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import raw_texts, runs, slices
from .graph import components, lowest
from .sieve import split
from .text import WordHashes, chain, mix, space_words
from .store import discard, materialise

SIZE = 3
THRESHOLD = Fraction(9, 10)
GROWTH = 1.5  # ratio of set sizes inside a level
SPARE = 2  # ranges at least more than the bound asks for, so empty ones need not count
BLOCK_ROWS = 1024
SIEVE_BITS = 1 << 23


def shingle_set(text: bytes, hashes: WordHashes, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a shorter text is one n-gram, one without words has none."""
    tokens = space_words(text)
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    h = hashes.of(tokens)
    if len(h) < size:
        return chain([*(h[i:i + 1] for i in range(len(h))), np.array([len(h)], dtype=np.uint64)])
    n = len(h) - size + 1
    return np.unique(chain([h[i:i + n] for i in range(size)]))


class Levels:
    """Ranges of hash columns by set size, such that linked sets agree on a range both have."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        # below this size no set of another size or with another n-gram links
        start = 1
        while self.differ(start, start + 1) < 1 and self.differ(start, start) < 2:
            start += 1
        self.bounds = [start]
        self.known: dict[int, tuple[int, int]] = {}

    def differ(self, x: int, y: int) -> int:
        """n-grams that may stand in one of two linked sets only."""
        return int((x + y) * (1 - self.t) / (1 + self.t))

    def level(self, n: int) -> int:
        while self.bounds[-1] <= n:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * GROWTH)))
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def ranges(self, level: int) -> tuple[int, int]:
        """Ranges of a level, whose pairs have the smaller set in it, and how many of them may be empty and not count.

        There are as many ranges as leave, over those that may differ, more than the
        smallest set of the level leaves empty (its mean and three deviations). Empty
        ranges look alike in all sets; where they counted, they would tie whole levels.
        """
        if level not in self.known:
            self.level(self.bounds[min(level, len(self.bounds) - 1)])
            least, most = self.bounds[level], self.bounds[level + 1] - 1
            needed = self.differ(most, int(most / self.t)) + 1
            k = needed + SPARE
            while k < 2 * needed and (empty := k * math.exp(-least / k)) + 3 * math.sqrt(empty) > k - needed:
                k += 1
            self.known[level] = k, k - needed
        return self.known[level]

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """One hash per non-empty range, of its level and of the one below where a linked smaller set can be there."""
        n = len(grams)
        own = self.level(n) if n >= self.bounds[0] else -1
        if own < 0:
            return np.zeros(0, dtype=np.uint64)
        levels = [own]
        if own > 0 and -(-n * self.t.numerator // self.t.denominator) < self.bounds[own]:
            levels.append(own - 1)
        spread = mix(grams ^ np.uint64(0x5851F42D4C957F2D))
        out = []
        for lv in levels:
            k, spare = self.ranges(lv)
            part = ((grams >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            sums = np.add.reduceat(spread, first)
            names = part[first]
            if k - len(first) > spare:  # too many empty ranges: they count as well
                empty = np.setdiff1d(np.arange(k, dtype=np.uint64), names)
                names, sums = np.concatenate((names, empty)), np.concatenate((sums, np.zeros(len(empty), dtype=np.uint64)))
            out.append(mix(sums + mix(names + np.uint64((lv + 1 << 40) + 1))))
        return np.concatenate(out)


def sketch(grams: np.ndarray) -> np.ndarray:
    """How many n-grams of a sorted set stand in each of equal hash intervals, two to four on average, one byte each."""
    bits = max(0, len(grams).bit_length() - 2)
    while True:
        at = (grams >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
        counts = np.bincount(at, minlength=1 << bits)
        if counts.max(initial=0) < 256:
            return counts.astype(np.uint8)
        bits += 1


def folded(counts: np.ndarray, width: int) -> np.ndarray:
    """The sketch of the same set in ``width`` intervals."""
    return counts.reshape(width, -1).sum(axis=1, dtype=np.int32)


def linked(x: int, y: int, both, t: Fraction):
    """The exact test: overlap over union at least ``t``."""
    return both * (t.numerator + t.denominator) >= t.numerator * (x + y)


def link_classes(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", size: int = SIZE, threshold: Fraction = THRESHOLD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``.

    Documents link when the Jaccard similarity of their n-gram sets reaches
    ``threshold``; ``component_id`` is the smallest id reachable by links. Equal sets
    are one class and never pair up. NULL and empty texts have no n-grams and link with
    nothing. Rows that share an id are one node; a NULL id links with nothing and has no
    component. An empty table stays empty, other columns are not read.
    """
    rows = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    keyed = materialise(rows.mapInArrow(
        _keyed(size, threshold), "doc bigint, n bigint, d1 bigint, d2 bigint, keys array<bigint>, sketch binary"
    ))
    sets = materialise(keyed.select("doc", "n", "d1", "d2"))
    classes = materialise(
        sets.where("doc is not null and n > 0").groupBy("d1", "d2").agg(F.min("doc").alias("c"), F.min("n").alias("n"))
    )
    reps = materialise(
        keyed.where("size(keys) > 0").join(classes.drop("n"), ["d1", "d2"]).where("doc = c").select("c", "n", "keys", "sketch")
    )
    discard(keyed)
    links = _links(rows, reps, size, threshold, block_rows)
    # an id with several texts ties their classes
    nodes = sets.where("doc is not null and n > 0").join(classes.drop("n"), ["d1", "d2"]).where("doc <> c").select("doc", "c").distinct()
    several = nodes.groupBy("doc").count().where("count > 1").select("doc")
    also = sets.where("n > 0").select("doc", "d1", "d2").join(classes.select("c", "d1", "d2"), ["d1", "d2"]).where("doc <> c")
    own = classes.select(F.col("c").alias("doc")).distinct()
    ties = nodes.join(several, "doc", "left_semi").unionByName(also.select("doc", "c").distinct().join(own, "doc", "left_semi"))
    group = components(links.unionByName(ties.select(F.col("doc").alias("a"), F.col("c").alias("b"))))
    named = classes.select("d1", "d2", "c").join(group.withColumnRenamed("id", "c"), "c", "left").select(
        "d1", "d2", F.coalesce("component", "c").alias("component")
    )
    out = sets.select("doc", "n", "d1", "d2").join(named, ["d1", "d2"], "left")
    return out.select(
        F.col("doc").alias(doc), F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"),
    )


def _links(rows: DataFrame, reps: DataFrame, size: int, t: Fraction, block_rows: int) -> DataFrame:
    """Written links between classes, enough to reach every class that any link reaches."""
    sketches = materialise(reps.select("c", "n", "sketch"))
    groups, pairs, held = _candidates(reps)
    possible = materialise(_possible(pairs, sketches, t))
    links = _verify(rows, possible, size, t, block_rows)
    if held is not None:
        done = components(links)
        open_ = materialise(_open(held, done, sketches, t, block_rows))
        more = _settle(rows, open_, done, size, t, block_rows)
        discard(open_, held)
        links = links.unionByName(more)
    discard(reps, groups, pairs, possible, sketches)
    return links


def _keyed(size: int, threshold: Fraction):
    def keyed(batches):
        hashes, levels = WordHashes(), Levels(threshold)
        for b in slices(batches, 256):
            n, d1, d2, keys, ends, counts = [], [], [], [], [0], []
            for t in raw_texts(b.column("text")):
                grams = shingle_set(t or b"", hashes, size)
                n.append(len(grams))
                if len(grams):
                    digest = np.frombuffer(xxhash.xxh3_128_digest(grams.tobytes()), dtype=np.int64)
                    d1.append(int(digest[0]))
                    d2.append(int(digest[1]))
                else:
                    d1.append(None)
                    d2.append(None)
                keys.append(levels.keys(grams).view(np.int64))
                ends.append(ends[-1] + len(keys[-1]))
                counts.append(sketch(grams).tobytes() if len(keys[-1]) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys) if keys else [], pa.int64())),
                 pa.array(counts, pa.binary())],
                names=["doc", "n", "d1", "d2", "keys", "sketch"],
            )

    return keyed


def _candidates(reps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Written tables: ranges of over one class; distinct pairs (a, b) of classes that agree on one; classes of ranges of over two.

    A range of many classes ties each to its smallest and its largest one only: pairs
    grow with the rows, never with their square. What these ties leave open is found
    by ``_open`` and settled by ``_settle``.
    """
    each = reps.select("c", F.explode("keys").alias("k"))
    groups = materialise(each.groupBy("k").agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("n")
    ).where("lo < hi"))
    pairs = groups.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    large = groups.where("n > 2")
    held = None
    if large.limit(1).count() > 0:
        maybe, _ = split(each, F.col("k"), large, "k", SIEVE_BITS)
        held = materialise(maybe.join(large.select("k", "lo", "hi"), "k"))
        both = held.select(
            F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("c").alias("b")), F.struct(F.col("c").alias("a"), F.col("hi").alias("b")))).alias("p")
        ).select("p.a", "p.b").where("a < b")
        pairs = pairs.unionByName(both)
    return groups, materialise(pairs.distinct()), held


def _possible(pairs: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """Pairs whose sizes allow the threshold, and whose sketches allow the overlap: equal intervals share the smaller count at most."""
    p, q = t.numerator, t.denominator
    both = pairs.join(sketches.select(F.col("c").alias("a"), F.col("n").alias("an"), F.col("sketch").alias("ak")), "a").join(
        sketches.select(F.col("c").alias("b"), F.col("n").alias("bn"), F.col("sketch").alias("bk")), "b"
    ).where(f"(an * {q} >= bn * {p}) and (bn * {q} >= an * {p})").select("a", "b", "an", "bn", "ak", "bk")

    def bounded(batches):
        for batch in batches:
            sizes = zip(batch.column("an").to_pylist(), batch.column("bn").to_pylist())
            ok = []
            for (x, y), i, j in zip(sizes, batch.column("ak").to_pylist(), batch.column("bk").to_pylist()):
                width = min(len(i), len(j))
                most = np.minimum(folded(np.frombuffer(i, np.uint8), width), folded(np.frombuffer(j, np.uint8), width)).sum()
                ok.append(bool(linked(x, y, int(most), t)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(bounded, "a bigint, b bigint")


def _open(held: DataFrame, done: DataFrame, sketches: DataFrame, t: Fraction, block_rows: int) -> DataFrame:
    """Ties (a, b) that hold all classes together which agree on a range, aren't linked yet, and whose sketches allow a link.

    In each range, the classes outside its largest linked component meet all its
    classes block by block; a block sends one tie per class, never its pairs.
    """
    named = held.select("k", "c").join(done.withColumnRenamed("id", "c"), "c", "left").select("k", "c", F.coalesce("component", "c").alias("g"))
    named = materialise(named)
    blocks = _split_groups(named, "k", "g", block_rows)
    members = named.join(blocks, "k")
    dealt = _dealt(members, "k", "c", "g <> top", ["g"]).join(sketches, "c").repartition("k", "i", "j").sortWithinPartitions("k", "i", "j", "c")

    def ties(batches):
        for table in runs(batches, ["k", "i", "j"]):
            a, b = possible_ties(table, t)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(ties, "a bigint, b bigint").distinct()


def _split_groups(named: DataFrame, group: str, part: str, block_rows: int) -> DataFrame:
    """Groups of over two rows in several parts: the largest part ``top``, and the numbers of blocks of the other rows and of all."""
    parts = named.groupBy(group, part).agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy(group).agg(
        F.max_by(part, F.struct("n", part)).alias("top"), F.sum("n").alias("all"), F.max("n").alias("most")
    # a group of two is one candidate pair, which is tested
    ).where((F.col("most") < F.col("all")) & (F.col("all") > 2))
    return largest.select(
        group, "top", F.ceil((F.col("all") - F.col("most")) / F.lit(float(block_rows))).cast("bigint").alias("ka"),
        F.ceil(F.col("all") / F.lit(float(block_rows))).cast("bigint").alias("kb"),
    )


def _dealt(members: DataFrame, group: str, row: str, chosen: str, also: list[str]) -> DataFrame:
    """Rows of pairs of blocks (group, i, j): the chosen ones as side 0 in all j, every one as side 1 in all i."""
    def upto(n: str):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))

    open_ = members.where(chosen).select(group, F.pmod(F.xxhash64(row), F.col("ka")).alias("i"), upto("kb").alias("j"), row, *also, F.lit(0).alias("side"))
    every = members.select(group, upto("ka").alias("i"), F.pmod(F.xxhash64(row), F.col("kb")).alias("j"), row, *also, F.lit(1).alias("side"))
    return open_.unionByName(every)


def _settle(rows: DataFrame, open_: DataFrame, done: DataFrame, size: int, t: Fraction, block_rows: int) -> DataFrame:
    """Ties between classes that sketches allow and links don't hold yet.

    A group is all that open ties and links reach. Its members outside its largest
    linked component are multiplied with all its members, block by block: the overlap
    counts of a pair of blocks stand in one small matrix, and only one tie per member
    leaves it.
    """
    group = components(open_.unionByName(done.select(F.col("id").alias("a"), F.col("component").alias("b")))).withColumnRenamed("component", "s")
    named = materialise(group.join(done, "id", "left").select("id", "s", F.coalesce("component", "id").alias("g")))
    members = materialise(named.join(_split_groups(named, "s", "g", block_rows), "s"))
    held = _grams(rows, members.select("id"), size)
    dealt = _dealt(members, "s", "id", "g <> top", []).join(held, "id").repartition("s", "i", "j").sortWithinPartitions("s", "i", "j", "id")

    def product(batches):
        for table in runs(batches, ["s", "i", "j"]):
            a, b = block_ties(table, t)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    out = materialise(dealt.mapInArrow(product, "a bigint, b bigint").distinct())
    discard(named, members, held)
    return out


def _verify(rows: DataFrame, pairs: DataFrame, size: int, t: Fraction, block_rows: int) -> DataFrame:
    """Linked pairs of ``pairs``, by overlap counts of blocks: one row of the matrix against up to ``block_rows`` others."""
    ids = materialise(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    held = _grams(rows, ids, size)
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).cast("bigint").alias("k"))
    members = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("k")).alias("s"), F.col("b").alias("id"), F.lit(1).alias("side"))
    leaders = blocks.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("s"), F.col("a").alias("id"), F.lit(0).alias("side"))
    dealt = members.unionByName(leaders).join(held, "id").repartition("a", "s").sortWithinPartitions("a", "s", "side", "id")

    def product(batches):
        for table in runs(batches, ["a", "s"]):
            a, b = overlapping(table, t)
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    out = materialise(dealt.mapInArrow(product, "a bigint, b bigint").distinct())
    discard(ids, held)
    return out


def _grams(rows: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """n-gram sets of the documents in ``ids``, and of a few more that the bitmap lets through, made anew from their texts."""
    maybe, _ = split(rows.where("doc is not null"), F.xxhash64("doc"), ids.select(F.xxhash64("id").alias("k")), "k", SIEVE_BITS)

    def grams(batches):
        hashes = WordHashes()
        for b in slices(batches, 256):
            found = [shingle_set(x or b"", hashes, size).view(np.int64) for x in raw_texts(b.column("text"))]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else [], pa.int64()))],
                names=["id", "grams"],
            )

    return materialise(maybe.mapInArrow(grams, "id bigint, grams array<bigint>").where("size(grams) > 0"))


def block_ties(table: pa.Table, t: Fraction, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Per linked row of a block its component's smallest id: the block's sparse product, accumulated over column chunks."""
    table = table.combine_chunks()
    side = table.column("side").to_numpy()
    ids = table.column("id").to_numpy()
    lists = table.column("grams").combine_chunks()
    ends = lists.offsets.to_numpy()
    sizes = np.diff(ends)
    values = lists.values.to_numpy()[ends[0]:ends[-1]]
    row = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    column = np.cumsum(new) - 1
    # an n-gram of one row counts for no pair
    several = np.bincount(column)[column] > 1
    column, row = column[several], row[several]
    if not len(column):
        return ids[:0], ids[:0]
    column = np.cumsum(np.concatenate(([True], column[1:] != column[:-1]))) - 1
    open_, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    both = np.zeros((len(open_), len(every)), dtype=np.float32)
    at = 0
    for first in range(0, int(column[-1]) + 1, columns):
        end = int(np.searchsorted(column, first + columns))
        chunk = np.zeros((len(ids), columns), dtype=np.float32)
        chunk[row[at:end], column[at:end] - first] = 1
        both += chunk[open_] @ chunk[every].T
        at = end
    ok = linked(sizes[open_][:, None], sizes[every][None, :], both.astype(np.int64), t) & (ids[open_][:, None] != ids[every][None, :])
    i, j = np.nonzero(ok)
    if not len(i):
        return ids[:0], ids[:0]
    a, b = open_[i], every[j]
    label = lowest(len(ids), a, b)
    used = np.unique(np.concatenate((a, b)))
    used = used[ids[label[used]] != ids[used]]
    return ids[used], ids[label[used]]


def possible_ties(table: pa.Table, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a block that may link with one of another component, by sketches: the smallest id that such ties reach."""
    table = table.combine_chunks()
    side, ids, part, sizes = (table.column(k).to_numpy() for k in ("side", "c", "g", "n"))
    raw = [np.frombuffer(x, np.uint8) for x in table.column("sketch").to_pylist()]
    width = min(map(len, raw))
    counts = np.stack([folded(x, width) for x in raw])
    counts = counts.astype(np.uint8 if counts.max() < 256 else np.int32)
    open_, every = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    pairs = []
    for i in open_.tolist():
        fits = (part[every] != part[i]) & linked(sizes[i], sizes[every], np.minimum(sizes[i], sizes[every]), t)
        near = every[fits]
        most = np.minimum(counts[i], counts[near]).sum(axis=1, dtype=np.int64)
        near = near[linked(sizes[i], sizes[near], most, t)]
        pairs.append((np.full(len(near), i), near))
    a, b = (np.concatenate(x) for x in zip(*pairs)) if pairs else (ids[:0], ids[:0])
    if not len(a):
        return ids[:0], ids[:0]
    label = lowest(len(ids), a, b)
    used = np.unique(np.concatenate((a, b)))
    used = used[ids[label[used]] != ids[used]]
    return ids[used], ids[label[used]]


def overlapping(table: pa.Table, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of one block: rows of side 0 (texts of the id ``a``) against rows of side 1."""
    table = table.combine_chunks()
    side = table.column("side").to_numpy()
    ids = table.column("id").to_numpy()
    lists = table.column("grams").combine_chunks()
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy()
    lead, rest = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(lead) or not len(rest):
        return ids[:0], ids[:0]
    sizes = np.diff(ends)
    out = []
    for i in lead.tolist():
        row = np.sort(values[ends[i]:ends[i + 1]])
        at = np.minimum(np.searchsorted(row, values), len(row) - 1)
        hits = np.concatenate(([0], np.cumsum(row[at] == values)))
        both = hits[ends[1:]] - hits[ends[:-1]]
        ok = rest[linked(sizes[i], sizes[rest], both[rest], t)]
        out.append(ids[ok])
    b = np.unique(np.concatenate(out))
    return np.full(len(b), ids[lead[0]]), b


def keep_one(docs: DataFrame, text: str = "text", doc: str = "doc_id", **options) -> DataFrame:
    """Rows whose id is the smallest of its component, in the columns of ``docs``; rows without id stay."""
    gone = link_classes(docs, text, doc, **options).where(f"`{doc}` <> component_id").select(F.col(doc).alias("_sh_gone")).distinct()
    return docs.join(gone, F.col(doc) == F.col("_sh_gone"), "left_anti")
