"""Benchmark decontamination: windows of test items found in training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import merged, raw_texts, slices
from .text import words

WINDOW = 10
#: Words of one block of benchmark texts. Only a block is held in a task and sent with it; a larger
#: benchmark is scanned block by block, so the bound drops nothing.
BLOCK_WORDS = 2_000_000


class WindowSet:
    """Hash set of the normalised windows of a block of items, with the words to verify hits."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[str]]] = {}
        for item, tokens in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1) if size else ():
                by_length.setdefault(size, {}).setdefault(tuple(ids[i:i + size]), []).append(item)
        self.by_length = by_length
        self.hashes = {n: np.unique(self._hash(np.array(list(known), dtype=np.uint64))) for n, known in by_length.items()}

    @staticmethod
    def _hash(windows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(windows), dtype=np.uint64)
        for j in range(windows.shape[1]):
            out = WindowSet._step(out, windows[:, j])
        return out

    @staticmethod
    def _step(state: np.ndarray, ids: np.ndarray) -> np.ndarray:
        state = (state ^ ids) * np.uint64(0x9E3779B97F4A7C15)
        return state ^ (state >> np.uint64(29))

    def scan(self, tokens: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Verified occurrences as (first word, end word) and the items they belong to."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in tokens), dtype=np.uint64, count=len(tokens))
        known = ids > 0
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not known.any():
            return spans, items
        runs = np.cumsum(known)
        for n, windows in self.by_length.items():
            if len(ids) < n:
                continue
            inside = runs[n - 1:] - np.concatenate(([0], runs[:-n])) == n
            starts = np.flatnonzero(inside)
            if not len(starts):
                continue
            state = np.zeros(len(starts), dtype=np.uint64)
            for j in range(n):
                state = self._step(state, ids[starts + j])
            table = self.hashes[n]
            at = np.minimum(np.searchsorted(table, state), len(table) - 1)
            for i in starts[table[at] == state].tolist():
                owners = windows.get(tuple(ids[i:i + n].tolist()))
                if owners:
                    spans.append((i, i + n))
                    items.update(owners)
        return spans, items


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items with words, in blocks of bounded size, streamed from the table one partition at a time."""
    held: list[tuple[str, list[bytes]]] = []
    size = 0
    rows = benchmark.select(F.col(item).cast("string"), text).where(f"`{text}` is not null and `{item}` is not null")
    for key, body in rows.toLocalIterator():
        tokens = words(body.encode())
        if not tokens:
            continue
        if held and size + len(tokens) > block_words:
            yield held
            held, size = [], 0
        held.append((key, tokens))
        size += len(tokens)
    if held:
        yield held


def contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``spans`` (hit word ranges) and ``items`` (ids of items with occurring windows).

    A window is ``window`` consecutive words of an item, or the whole item if it
    has fewer words. Items without words or id match nothing. NULL and empty texts
    have no words. Repeated rows are scanned alike, an empty benchmark hits nothing,
    and input columns with the names of added ones are replaced. Items of one id count once.
    """
    added = ("n_words", "n_hit", "spans", "items")
    keep = [c for c in docs.columns if c not in added]
    out = docs.select(
        *[F.col(f"`{c}`") for c in keep], F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.array().cast("array<string>").alias("items"),
    )
    blocks = benchmark_blocks(benchmark, item, item_text, block_words)
    block = next(blocks, [])
    while True:
        out = _scan(out, keep, text, WindowSet(block, window))
        block = next(blocks, None)
        if block is None:
            break
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return out.select(*[F.col(f"`{c}`") for c in keep], "n_words", hit.alias("n_hit"), "spans", "items")


def _scan(df: DataFrame, keep: list[str], text: str, known: WindowSet) -> DataFrame:
    """One pass over the texts; joins its hits to those of earlier blocks."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches):
        for b in slices(batches, 500):
            n_words, spans, items = [], [], []
            for body, old, names in zip(
                raw_texts(b.column(text)), b.column("spans").to_pylist(), b.column("items").to_pylist()
            ):
                tokens = words(body or b"")
                found, owners = known.scan(tokens)
                n_words.append(len(tokens))
                spans.append(merged(found + [(s["start"], s["end"]) for s in old]))
                items.append(sorted(owners.union(names)))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [
                    pa.array(n_words, pa.int64()),
                    pa.array([[{"start": i, "end": j} for i, j in s] for s in spans], span),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=[*keep, "n_words", "spans", "items"],
            )

    return df.mapInArrow(scan, df.schema)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents without a hit, with their columns as they are."""
    return contaminated(docs, benchmark, **options).where("n_hit = 0").select(*[F.col(f"`{c}`") for c in docs.columns])
