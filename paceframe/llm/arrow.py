"""Streams of Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a text column without decoding."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so a task holds few whole texts in Python form."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of one key after the other from batches sorted by int64 keys.

    The caller bounds the rows of a key, as a run is held whole.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for i, j in zip(starts, starts[1:]):
            key = tuple(c[i] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint sorted spans; touching ones join."""
    out: list[list[int]] = []
    for i, j in sorted(spans):
        if out and i <= out[-1][1]:
            out[-1][1] = max(out[-1][1], j)
        else:
            out.append([i, j])
    return [tuple(x) for x in out]
