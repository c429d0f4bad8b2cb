"""Byte-aligned variable-length numbers with their control bytes apart.

A number takes one to four bytes, low byte first. Its length less one is a two-bit
code; four codes make a control byte, the first number in the low bits. Control bytes
and data bytes are two streams, so a decoder looks up four lengths per control byte,
adds them up to offsets, and gathers all numbers at once.
"""

from __future__ import annotations

import numpy as np

#: lengths of the four numbers of each control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def encode(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    numbers = np.ascontiguousarray(numbers, dtype="<u4")
    code = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    quads = np.zeros(-(-len(code) // 4) * 4, dtype=np.uint8)
    quads[:len(code)] = code
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4) <= code[:, None]
    return control.tobytes(), numbers.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ``count`` numbers of the two streams."""
    if not count:
        return np.zeros(0, dtype=np.uint32)
    lengths = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    at = np.cumsum(lengths, dtype=np.int64)
    if at[-1] != len(data):
        raise ValueError(f"control bytes ask for {at[-1]} data bytes, {len(data)} are there")
    at -= lengths
    padded = np.frombuffer(data + b"\0\0\0", dtype=np.uint8)
    out = padded[at].astype(np.uint32)
    for k in (1, 2, 3):
        out |= padded[at + k].astype(np.uint32) << np.uint32(8 * k)
    return out & MASKS[lengths]
