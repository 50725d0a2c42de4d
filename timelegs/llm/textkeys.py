"""Vectorised tokenising and hashing of UTF-8 bytes in numpy, used inside tasks.

A hash of a run of bytes or words is a polynomial over random 64-bit values with an odd base,
read off a running sum, so each window costs two look-ups whatever its length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 21

SPACES = bytes([0x20, *range(0x09, 0x0E)])
# Everything below 0x80 but digits and letters.
NON_WORD = bytes(b for b in range(0x80) if not chr(b).isalnum())


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, U64), np.full(size, INVERSE, U64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``size`` of them."""
    return _powers(max(PIECE, 1 << (max(1, size) - 1).bit_length()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (the 64-bit finaliser of MurmurHash3)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@lru_cache(maxsize=8)
def byte_values(separators: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """A random value for each byte, and whether the byte belongs to words."""
    values = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return values, inside


def running(values: np.ndarray) -> np.ndarray:
    """Running sums for ``window``; one more entry than ``values``."""
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def window(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run ``starts[i]:ends[i]``."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def words(data: np.ndarray, separators: bytes = SPACES, lower: bool = False):
    """Start, end and 64-bit hash of every word of a byte array, in pieces of bounded memory."""
    values, inside = byte_values(separators, lower)
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data):  # cut between words; a word longer than a piece stays whole
            gaps = np.flatnonzero(~inside[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
                break
            end = min(len(data), end + PIECE)
        piece = data[at:end]
        mask = inside[piece]
        edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = running(values[piece])
        hashes = window(sums, starts, ends) ^ (ends - starts).astype(U64)
        found.append((starts + at, ends + at, hashes))
        at = end
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` hashes."""
    if len(hashes) < size:
        return np.empty(0, U64)
    sums = running(hashes)
    starts = np.arange(len(hashes) - size + 1)
    return window(sums, starts, starts + size)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys.astype(int)
    return keys[first], np.diff(np.append(first, len(keys)))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null is empty."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    return np.frombuffer(body, np.uint8) if body else np.empty(0, np.uint8), offsets
