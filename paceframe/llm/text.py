"""Words of whole texts: byte tables for tasks, column expressions for native plans."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# ASCII bytes that are no digit and no letter separate words; A-Z is lowered; all other bytes stay
_WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def word_array(text: Column) -> Column:
    """Lower-case words of a text as an array; empty for NULL."""
    clean = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD, " ")
    return F.when(F.trim(clean) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(clean), " "))


def words(text: bytes) -> list[bytes]:
    """The same words as ``word_array``, of UTF-8 bytes."""
    return text.translate(_WORD_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """ASCII-lowered words between ASCII white space."""
    return text.lower().split()


class WordHashes(dict):
    """64-bit hash of a word, remembered; forgets all when it holds too many words."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value
        return value

    def of(self, items: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, items), dtype=np.uint64, count=len(items))


_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def chain(parts: Iterable[np.ndarray]) -> np.ndarray:
    """One ordered hash of several equally long arrays of hashes."""
    out = None
    for p in parts:
        out = mix(p + _A) if out is None else mix(out * _A + p)
    return out
