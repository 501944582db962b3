"""Vectorised hashing of the words of a batch of texts.

A batch is cut into blocks of about a megabyte, so memory does not follow the batch size; a text is
never cut. All hashes are 64 bit and depend on nothing but the bytes of the words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
BLOCK_TEXTS = 512
LEAST_POWERS = 1 << 18  # a worker keeps 16 bytes for each
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(
    texts: pa.Array, size: int = BLOCK_BYTES
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of successive blocks; a null counts as an empty text."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(filled):
        return
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset :][: len(filled) + 1]
    data = filled.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(filled):
        limit = offsets[first] + size
        last = int(np.searchsorted(offsets, limit, "right")) - 1
        last = min(max(last, first + 1), first + BLOCK_TEXTS, len(filled))
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        all_same = np.full(size, base, np.uint64)
        all_same[0] = 1
        return np.multiply.accumulate(all_same)

    return powers(_BASE), powers(_INVERSE)


def words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word of a block; `separator` tells of each of the 256 bytes
    whether it stands between words. A text's end ends its last word."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~separator[data]
    fresh = np.zeros(size + 1, bool)
    fresh[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    after = np.concatenate((inside[1:], [False]))
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    power, inverse = _powers(max(LEAST_POWERS, 1 << (size - 1).bit_length()))
    running = np.zeros(size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:size], out=running[1:])
    hashes = mix((running[ends] - running[starts]) * inverse[starts])
    return np.searchsorted(offsets, starts, "right") - 1, hashes


def shingles(owner: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first word and hash of every run of `size` words of one text."""
    count = len(owner) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    joined = np.zeros(count, np.uint64)
    for step in range(size):
        joined = joined * np.uint64(_BASE) + hashes[step : step + count]
    at = np.flatnonzero(owner[:count] == owner[size - 1 :])
    return at, mix(joined[at])


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# The six ASCII white-space bytes, and all ASCII bytes but letters and digits.
WHITE_SPACE = byte_class(b" \t\n\r\x0b\x0c")
NOT_ALPHANUMERIC = byte_class(bytes(c for c in range(128) if not chr(c).isalnum()))
