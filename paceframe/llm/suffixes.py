"""Removal of byte strings that an earlier document holds, by sorted suffixes of sampled positions.

Every window of 50 bytes has one anchor: the leftmost of its grams with the least
hash. Equal windows have equal anchors at equal distance, so only suffixes at anchors
(about one in 18 positions) have to meet. Anchors whose gram stands in one document
only are dropped by a count over all documents. The others carry the few bytes around
them that their windows cover; in each task those are sorted as suffixes to the right
and, reversed, to the left, and runs of common prefixes give the equal windows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import merged, raw_texts, runs, slices
from .sieve import collected, may_hold, split
from .text import mix
from .store import materialise

LENGTH = 50
GRAM = 16
STEPS = LENGTH - GRAM + 1  # grams of one window
PIECE = 1 << 18  # bytes of a text that are hashed at a time
MULTIPLIER = 0x9E3779B97F4A7C15
SIEVE_BITS = 1 << 26  # a bitmap of 8 MB
HOT_BITS = 1 << 20
ID_BITS = 1 << 22
#: The anchors of a gram that has more are spread; if it has more contexts too, they go by grouped windows, as their suffixes would fill a task.
HOT_DOCS = 16384
#: Runs of window offsets of a context, with the smallest document that holds them and the largest of the context.
RUNS = "h bigint, c bigint, first bigint, l_from int, l_to int, hi bigint, w binary"
#: Rows of a table of repeated texts up to which it is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000
_FAR = np.iinfo(np.int64).max


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, made once per task."""
    n = PIECE + LENGTH + 1
    return _powers(MULTIPLIER, n), _powers(pow(MULTIPLIER, -1, 1 << 64), n)


def _slide(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours."""
    k = 1
    while k * 2 <= w:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[:len(x) - (w - k)], x[w - k:]) if k < w else x


def anchors(text: bytes, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, position, first and last window of every anchor of a text, from prefix polynomial hashes."""
    return keyed_anchors(text, tables)[:4]


def keyed_anchors(text: bytes, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """What ``anchors`` gives, and a key of the bytes that the anchor's windows cover and of its place in them."""
    parts = []
    up, down = tables
    for at in range(0, max(0, len(text) - LENGTH + 1), PIECE):
        b = np.frombuffer(text, dtype=np.uint8, offset=at, count=min(PIECE + LENGTH - 1, len(text) - at)).astype(np.uint64) + np.uint64(1)
        n = len(b)
        prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(b * up[:n], out=prefix[1:])
        h = mix((prefix[GRAM:] - prefix[:-GRAM]) * down[:n - GRAM + 1])
        low = np.uint64((1 << 23) - 1)
        least = _slide((h & ~low) | np.arange(len(h), dtype=np.uint64), STEPS) & low
        first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        last = np.concatenate((first[1:] - 1, [len(least) - 1]))
        pos = least[first].astype(np.int64)
        place = ((pos - first) * LENGTH + last - first + 1).astype(np.uint64)
        key = mix((prefix[last + LENGTH] - prefix[first]) * down[first] + mix(place))
        parts.append((h[pos].view(np.int64), pos + at, first + at, last + at, key.view(np.int64)))
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


# ---- suffix sort of the anchors of one gram ------------------------------------------------------------------------

def prefix_hashes(suffixes: list[bytes]) -> list[list[int]]:
    """Polynomial hashes of every prefix of every suffix."""
    width = max(map(len, suffixes), default=0)
    table = np.zeros((len(suffixes), width), dtype=np.uint64)
    for i, s in enumerate(suffixes):
        table[i, :len(s)] = np.frombuffer(s, dtype=np.uint8)
    table += np.uint64(1)
    up = _powers(MULTIPLIER, max(width, 1))
    sums = np.cumsum(table * up[:width], axis=1, dtype=np.uint64)
    return [[0, *row] for row in sums.tolist()]


def common(a: list[int], b: list[int], most: int) -> int:
    """Length of the longest common prefix by binary search over prefix hashes."""
    low, high = 0, most
    while low < high:
        mid = (low + high + 1) >> 1
        if a[mid] == b[mid]:
            low = mid
        else:
            high = mid - 1
    return low


def sort_suffixes(suffixes: list[bytes], groups: list[list[int]]) -> tuple[list[int], list[int]]:
    """Suffix numbers, sorted inside each group, and the common prefix of each with the one before (-1 at a group's start).

    A merge sort whose comparisons find the first difference by prefix hashes. The
    bytes of neighbours verify it; a group where a hash was wrong is sorted by its bytes.
    """
    hashes = prefix_hashes(suffixes)

    def compare(i: int, j: int) -> int:
        a, b = suffixes[i], suffixes[j]
        n = common(hashes[i], hashes[j], min(len(a), len(b)))
        if n == len(a) or n == len(b):
            return len(a) - len(b)
        return a[n] - b[n]

    key = functools.cmp_to_key(compare)
    order: list[int] = []
    shared: list[int] = []
    for g in groups:
        got = sorted(g, key=key)
        lcp = [-1]
        for i, j in zip(got, got[1:]):
            lcp.append(common(hashes[i], hashes[j], min(len(suffixes[i]), len(suffixes[j]))))
        if not all(_verified(suffixes[i], suffixes[j], n) for i, j, n in zip(got, got[1:], lcp[1:])):
            got = sorted(g, key=suffixes.__getitem__)
            lcp = [-1, *(_plain_common(suffixes[i], suffixes[j]) for i, j in zip(got, got[1:]))]
        order += got
        shared += lcp
    return order, shared


def _verified(a: bytes, b: bytes, n: int) -> bool:
    """Equal up to ``n``, and in order from there on."""
    return a[:n] == b[:n] and (n == len(a) or (n < len(b) and a[n] < b[n]))


def _plain_common(a: bytes, b: bytes) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def earliest(contexts: list[bytes], left: np.ndarray, first: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Per context and window offset the smallest document that holds the window.

    ``left`` is the number of bytes before the gram, ``first`` the smallest document of
    the context, ``group`` a number per gram, rows sorted by it. Offset ``l`` is the window
    that starts ``l`` bytes before the gram. Windows that a context does not cover have none.
    """
    n = len(contexts)
    size = np.array([len(c) for c in contexts], dtype=np.int64)
    out = np.full((n, STEPS), _FAR, dtype=np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    groups = [list(range(i, j)) for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), n])]
    ways = []
    for ends in ([c[k:] for c, k in zip(contexts, left.tolist())], [c[:k][::-1] for c, k in zip(contexts, left.tolist())]):
        order, shared = sort_suffixes(ends, groups)
        ways.append((np.array(order), np.array(shared)))
    for offset in range(STEPS):
        covers = (left >= offset) & (size - left >= LENGTH - offset)
        if not covers.any():
            continue
        run = np.zeros((2, n), dtype=np.int64)
        for k, ((order, shared), need) in enumerate(zip(ways, (LENGTH - offset, offset))):
            run[k, order] = np.cumsum(shared < need)
        at = np.flatnonzero(covers)
        key = run[0, at] * (n + 1) + run[1, at]
        _, inverse = np.unique(key, return_inverse=True)
        least = np.full(inverse.max() + 1, _FAR, dtype=np.int64)
        np.minimum.at(least, inverse, first[at])
        out[at, offset] = least[inverse]
    return out


# ---- jobs ----------------------------------------------------------------------------------------------------------

def _text_key() -> list[Column]:
    return [F.xxhash64("_sx_text").alias("_sx_a"), F.xxhash64(F.lit("text"), F.col("_sx_text")).alias("_sx_b")]


def repeated_bytes(docs: DataFrame, text: str = "text", doc: str = "doc_id", hot_docs: int = HOT_DOCS) -> DataFrame:
    """Add ``n_bytes``, ``spans`` (removed byte ranges: start, end) and ``kept`` (the bytes that stay) to every row.

    A byte goes where a window of 50 bytes over it also starts in a row with a smaller
    id. Windows are judged on the input and never cross rows. NULL texts are empty.
    Rows with a NULL id lose nothing and take nothing from others; rows of one id take
    nothing from each other. An empty table stays empty, and input columns with the
    names of added ones are replaced.
    """
    added = ("n_bytes", "spans", "kept")
    keep = [c for c in docs.columns if c not in added and not c.startswith("_sx_")]
    rows = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text), F.lit("")).alias("_sx_text"), F.col(doc).cast("bigint").alias("_sx_doc")
    ).withColumns({"_sx_a": F.xxhash64("_sx_text"), "_sx_b": F.xxhash64(F.lit("text"), F.col("_sx_text"))})
    whole = _repeated_texts(rows)
    n = whole.count()
    whole = F.broadcast(whole) if n <= BROADCAST_ROWS else whole
    told = rows.join(whole, ["_sx_a", "_sx_b"], "left")
    copy = F.coalesce(F.col("_sx_doc") > F.col("_sx_first"), F.lit(False))
    own = told.where(~copy & F.col("_sx_doc").isNotNull()).where(F.octet_length("_sx_text") >= LENGTH).select("_sx_doc", "_sx_a", "_sx_text")
    spans = materialise(_spans(own, hot_docs))
    pick = [F.col(f"`{c}`") for c in keep]
    none = F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    hit, rest = split(
        told.withColumn("_sx_copy", copy), F.xxhash64("_sx_doc"), spans.select(F.xxhash64("_sx_doc").alias("k")), "k", ID_BITS
    )
    some = hit.join(spans, ["_sx_doc", "_sx_a"], "left").select(*pick, "_sx_text", "_sx_copy", F.col("_sx_spans"))
    out = some.unionByName(rest.select(*pick, "_sx_text", "_sx_copy", none.alias("_sx_spans")))
    return _cut(out, keep)


def _repeated_texts(rows: DataFrame) -> DataFrame:
    """Texts of several rows, with the smallest id: later copies are removed whole."""
    return materialise(
        rows.where("_sx_doc is not null").groupBy("_sx_a", "_sx_b").agg(F.min("_sx_doc").alias("_sx_first"), F.max("_sx_doc").alias("hi"))
        .where("_sx_first < hi").drop("hi")
    )


def _spans(own: DataFrame, hot_docs: int) -> DataFrame:
    """Removed ranges (not merged) of every text that loses bytes."""

    def found(batch, *sieves: np.ndarray):
        """Anchors of every text whose gram is in all sieves."""
        tables = powers()
        for d, a, t in zip(batch.column("_sx_doc").to_pylist(), batch.column("_sx_a").to_pylist(), raw_texts(batch.column("_sx_text"))):
            cols = keyed_anchors(t, tables)
            for v in sieves:
                ok = may_hold(v, cols[0])
                cols = tuple(x[ok] for x in cols)
            h, pos, first, last, keys = cols
            yield d, a, t, h, keys, pos, first, last

    def columns(rows, width: int) -> list[np.ndarray]:
        """Rows of arrays joined to one array per column."""
        held = list(rows)
        return [np.concatenate(x) for x in zip(*held)] if held else [np.zeros(0, dtype=np.int64)] * width

    def grams(batches):
        for b in slices(batches, 1024):
            yield _collapsed(*columns(((h, keys, np.full(len(h), d, dtype=np.int64)) for d, _, _, h, keys, *_ in found(b)), 3))

    # a gram in one document only is no candidate; one with the same bytes around it everywhere is settled by its first document
    seen = materialise(own.mapInArrow(grams, "h bigint, c bigint, doc bigint, n int").repartition("h").groupBy("h").agg(
        F.min("doc").alias("first"), F.max("doc").alias("hi"), F.min("c").alias("c"), F.max("c").alias("c2"), F.sum("n").alias("n")
    ).where("first < hi").select("h", "c", "first", "n", (F.col("c") != F.col("c2")).alias("several")))
    known = collected(seen, "h", SIEVE_BITS)
    mixed = collected(seen.where("several"), "h", SIEVE_BITS)
    hot = collected(seen.where(F.col("several") & (F.col("n") > hot_docs)), "h", HOT_BITS)

    def places(batches):
        for b in slices(batches, 256):
            out = columns(
                # the position and both limits of the offsets in one number
                ((h, keys, np.full(len(h), d, dtype=np.int64), np.full(len(h), a, dtype=np.int64), pos * 4096 + (pos - first) * 64 + pos - last)
                 for d, a, _, h, keys, pos, first, last in found(b, known)), 5)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["h", "c", "doc", "a", "at"])

    def contexts(batches):
        for b in slices(batches, 1024):
            texts = []

            def gathered():
                for d, _, t, h, keys, pos, first, last in found(b, mixed):
                    yield h, keys, np.full(len(h), d, dtype=np.int64), np.full(len(h), len(texts), dtype=np.int64), pos, first, last
                    texts.append(t)

            h, c, doc, row, pos, first, last = columns(gathered(), 7)
            # copies of a context inside a batch are one row
            order = np.lexsort((c, h))
            h, c, doc = h[order], c[order], doc[order]
            at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))) if len(h) else order
            lo, hi = (f.reduceat(doc, at) if len(at) else at for f in (np.minimum, np.maximum))
            one = order[at]
            around = [texts[r][i:j] for r, i, j in zip(row[one].tolist(), first[one].tolist(), (last[one] + LENGTH).tolist())]
            h, c, left = h[at], c[at], pos[one] - first[one]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(c), pa.array(left, pa.int64()), pa.array(around, pa.binary()), pa.array(lo, pa.int64()),
                 pa.array(hi, pa.int64()), pa.array(np.where(may_hold(hot, h), c | 1, 0))],
                names=["h", "c", "l", "x", "lo", "hi", "part"],
            )

    # rows of a hot gram are spread and its contexts counted once, all others of a gram meet in one place
    dealt = own.mapInArrow(contexts, "h bigint, c bigint, l bigint, x binary, lo bigint, hi bigint, part bigint").repartition(
        "h", "part").sortWithinPartitions("part", "h", "c")
    # one row per run of offsets, or per context of a hot gram
    solved = materialise(dealt.mapInArrow(_solved, RUNS))
    # all windows of an anchor hold its gram, so the ranges of several runs cover one range
    windows = solved.where("w is null").select("h", "c", "first", "l_from", "l_to").unionByName(
        seen.where("not several").select("h", "c", "first", F.lit(0).alias("l_from"), F.lit(STEPS - 1).alias("l_to"))
    ).unionByName(_hot_windows(solved.where("w is not null"), hot_docs))
    # a common passage may stand in every document: contexts part the anchors of its grams, and AQE splits what one context has too many of
    at = own.mapInArrow(places, "h bigint, c bigint, doc bigint, a bigint, at bigint")
    hits = at.join(windows, ["h", "c"]).where("first < doc").select(
        "doc", "a", F.shiftright("at", 12).alias("pos"),
        F.least("l_to", F.shiftright("at", 6).bitwiseAND(F.lit(63))).alias("before"),
        F.greatest("l_from", F.col("at").bitwiseAND(F.lit(63))).alias("after"),
    ).select("doc", "a", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") - F.col("after") + LENGTH).cast("bigint").alias("end"))
    dealt = hits.repartition("doc", "a").sortWithinPartitions("doc", "a", "start")
    return dealt.mapInArrow(_joined, "_sx_doc bigint, _sx_a bigint, _sx_spans array<struct<start:bigint,end:bigint>>")


def _joined(batches):
    """Disjoint ranges of each text; a text has no more ranges than anchors."""
    for group in _several(runs(batches, ["doc", "a"]), 512):
        spans = [merged(list(zip(t.column("start").to_pylist(), t.column("end").to_pylist()))) for t in group]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t.column(k)[0].as_py() for t in group], pa.int64()) for k in ("doc", "a")]
            + [pa.array([[{"start": i, "end": j} for i, j in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["_sx_doc", "_sx_a", "_sx_spans"],
        )


def _several(items, n: int):
    held = []
    for x in items:
        held.append(x)
        if len(held) == n:
            yield held
            held = []
    if held:
        yield held


def _collapsed(h: np.ndarray, c: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """One or two rows per gram of a batch, with its extreme documents and contexts; ``n`` counts the anchors."""
    order = np.argsort(h, kind="stable")
    h, c, doc = h[order], c[order], doc[order]
    at = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, dtype=np.int64)
    n = np.diff(np.concatenate((at, [len(h)])))
    if len(at):
        c1, c2, d1, d2 = (f.reduceat(x, at) for x in (c, doc) for f in (np.minimum, np.maximum))
    else:
        c1 = c2 = d1 = d2 = at
    two = (c1 != c2) | (d1 != d2)
    cols = ((h[at], h[at][two]), (c1, c2[two]), (d1, d2[two]), (n, np.zeros(int(two.sum()), dtype=np.int64)))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), k) for x, k in zip(cols, kinds)], names=["h", "c", "doc", "n"])


def _hot_windows(contexts: DataFrame, hot_docs: int) -> DataFrame:
    """Runs of offsets of grams with very many anchors: those of few contexts are sorted like all others, the rest go by grouped windows."""
    rows = contexts.select("h", "c", F.col("first").alias("lo"), "hi", F.col("l_from").cast("bigint").alias("l"), F.col("w").alias("x"))
    many = rows.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > hot_docs).select("h")
    few = rows.join(many, "h", "left_anti").repartition("h").sortWithinPartitions("h", "c").mapInArrow(_sorted_windows, RUNS)
    return few.select("h", "c", "first", "l_from", "l_to").unionByName(_grouped_windows(rows.join(many, "h", "left_semi").mapInArrow(_exploded, RUNS)))


def _grouped_windows(each: DataFrame) -> DataFrame:
    """Windows of grams of very many contexts, grouped by their bytes with partial minima."""
    least = each.groupBy("h", "l_from", "w").agg(F.min("first").alias("least"))
    # one row per context and document, from its first to its last offset
    return each.join(least, ["h", "l_from", "w"]).where("least < hi").groupBy("h", "c", F.col("least").alias("first")).agg(
        F.min("l_from").alias("l_from"), F.max("l_to").alias("l_to"))


def _solved(batches):
    """Cold grams sorted; each context of a hot one as a row with its bytes, both offsets the bytes before the gram."""
    import itertools

    def cold(items):
        for b in items:
            part = b.column("part").to_numpy()
            if (part != 0).any():
                hot.append(b.filter(pa.array(part != 0)))
                b = b.filter(pa.array(part == 0))
            yield b
            while hot:
                one, h, c, lo, hi = _contexts(hot.pop())
                left = one.column("l")
                out.append(_runs_batch(h, c, lo, left.to_numpy(), left.to_numpy(), hi, one.column("x")))

    hot: list[pa.RecordBatch] = []
    out: list[pa.RecordBatch] = []
    for b in itertools.chain(_sorted_windows(cold(batches)), [None]):
        while out:
            yield out.pop()
        if b is not None:
            yield b


def _contexts(b):
    """One row per context of rows in which each stands together, its gram and key, and its extreme documents."""
    h, c, lo, hi = (b.column(k).to_numpy() for k in ("h", "c", "lo", "hi"))
    at = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]))))
    return b.take(pa.array(at)), h[at], c[at], np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)


def _exploded(batches):
    """Windows of contexts, each as a row with its bytes."""
    for b in slices(batches, 8192):
        one, h, c, lo, hi = _contexts(b)
        left, x = one.column("l").to_numpy(), one.column("x").to_pylist()
        least = np.maximum(0, left + LENGTH - np.array([len(v) for v in x], dtype=np.int64))
        n = left - least + 1
        row = np.repeat(np.arange(len(h)), n)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + least[row]
        w = [x[i][j:j + LENGTH] for i, j in zip(row.tolist(), (left[row] - offset).tolist())]
        yield _runs_batch(h[row], c[row], lo[row], offset, offset, hi[row], pa.array(w, pa.binary()))


def _runs_batch(h, c, first, l_from, l_to, hi, w: pa.Array) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
    cols = [pa.array(x, k) for x, k in zip((h, c, first, l_from, l_to, hi), kinds)]
    return pa.RecordBatch.from_arrays([*cols, w], names=["h", "c", "first", "l_from", "l_to", "hi", "w"])


def _sorted_windows(batches):
    """Runs of window offsets with the smallest document, of contexts sorted by gram and key.

    Whole grams are gathered up to some thousand rows; a gram has no more rows
    than documents, and hot grams of many contexts do not come here.
    """
    held, rows = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        h = b.column("h").to_numpy()
        if rows >= 8_000:
            # cut where the next gram begins
            new = np.flatnonzero(h != held[-1].column("h")[-1].as_py())
            cut = int(new[0]) if len(new) else len(h)
            held.append(b.slice(0, cut))
            if cut < len(h):
                yield _windows(pa.Table.from_batches(held))
                held, rows = [b.slice(cut)], b.num_rows - cut
            continue
        held.append(b)
        rows += b.num_rows
    if held:
        yield _windows(pa.Table.from_batches(held))


def _windows(t: pa.Table) -> pa.RecordBatch:
    t, h, c, lo, hi = _contexts(t)
    left = t.column("l").to_numpy().astype(np.int64)
    x = t.column("x").to_pylist()
    size = np.array([len(v) for v in x], dtype=np.int64)
    group = np.cumsum(np.concatenate(([True], h[1:] != h[:-1])))
    several = np.bincount(group)[group] > 1
    offsets = np.arange(STEPS)
    covers = (left[:, None] >= offsets) & ((size - left)[:, None] >= LENGTH - offsets)
    first = np.where(covers, lo[:, None], _FAR)
    some = np.flatnonzero(several)
    if len(some):
        first[some] = earliest([x[i] for i in some.tolist()], left[some], lo[some], group[some])
    first[first >= hi[:, None]] = _FAR
    # runs of equal values along the offsets
    edge = np.ones((len(first), STEPS), dtype=bool)
    edge[:, 1:] = first[:, 1:] != first[:, :-1]
    row, start = np.nonzero(edge)
    end = np.concatenate((start[1:] - 1, [STEPS - 1])) if len(start) else start
    end = np.where(end < start, STEPS - 1, end)
    value = first[row, start]
    ok = value != _FAR
    row, start, end, value = row[ok], start[ok], end[ok], value[ok]
    return _runs_batch(h[row], c[row], value, start, end, hi[row], pa.nulls(len(row), pa.binary()))


def _cut(rows: DataFrame, keep: list[str]) -> DataFrame:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = rows.select(
        *[F.col(f"`{c}`") for c in keep], F.lit(0).cast("bigint").alias("n_bytes"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.lit(b"").alias("kept"),
    ).schema

    def cut(batches):
        for b in slices(batches, 256):
            sizes, spans, kept = [], [], []
            for t, copy, s in zip(raw_texts(b.column("_sx_text")), b.column("_sx_copy").to_pylist(), b.column("_sx_spans").to_pylist()):
                gone = [(0, len(t))] if copy and len(t) >= LENGTH else merged([(v["start"], v["end"]) for v in s or ()])
                left, at = [], 0
                for i, j in gone:
                    left.append(t[at:i])
                    at = j
                left.append(t[at:])
                sizes.append(len(t))
                spans.append([{"start": i, "end": j} for i, j in gone])
                kept.append(b"".join(left))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=[*keep, "n_bytes", "spans", "kept"],
            )

    return rows.mapInArrow(cut, schema)
