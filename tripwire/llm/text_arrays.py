"""Texts as byte arrays inside a task: words and their hashes without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes worked on at once

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# One fixed 64-bit number for each byte, and an odd base with its inverse modulo 2**64.
_VALUES = np.random.Generator(np.random.PCG64(20_240_817)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _FOLD[data]


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text; null is the empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield data[a:b]


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        known = np.full(max(n, PIECE + 1), base, np.uint64)
        known[0] = 1
        _powers[name] = known = np.cumprod(known)
    return known[:n]


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    space = np.ones(len(data) + 2, bool)
    space[1:-1] = _SPACE[data]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _power("up", _BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word of a text; long texts are cut between words."""
    if len(data) <= PIECE:
        return _piece_hashes(data) if len(data) else np.zeros(0, np.uint64)
    out, at = [], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        out.append(_piece_hashes(data[at:end]))
        at = end
    return np.concatenate(out)
