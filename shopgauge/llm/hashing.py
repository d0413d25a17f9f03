"""Hashes of words, word runs and byte runs over many texts at once, as NumPy arrays inside tasks.

A text column is seen as one run of UTF-8 bytes plus the offsets of its texts. Every byte maps to a fixed random number, and the
hash of a run is a polynomial of those numbers modulo 2^64, read from prefix sums and mixed at the end. Two independent
families (0 and 1) give 128 bits where equality decides a result. Polynomials modulo a power of two can't tell some long runs apart
whatever the base (the two orders of Thue and Morse, from 1,024 items on), so runs above LONGEST items are hashed by BLAKE2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Items of the longest run that a polynomial stands for, and of the stretch whose prefix sums are held at a time.
LONGEST, STRETCH = 128, 1 << 16

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = [_RANDOM.integers(0, 2**64, 256, dtype=np.uint64) for _ in range(2)]
_BASE = [int(x) | 1 for x in _RANDOM.integers(2**62, 2**63, 2)]
_RUN_BASE = [int(x) | 1 for x in _RANDOM.integers(2**62, 2**63, 2)]
_MASK = 2**64 - 1
_POWERS: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64. Kept per process and grown by doubling, to the size of a stretch and a run at most."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1024 if have is None else len(have)
        while size < n:
            size *= 2
        have = np.ones(size, np.uint64)
        have[1] = base
        done = 2
        while done < size:
            more = min(done, size - done)
            have[done : done + more] = have[:more] * np.uint64(pow(base, done, 2**64))
            done += more
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values from each start to each end, a stretch of values at a time, so that no text makes the tables grow."""
    if len(start) > 1 and (np.diff(start) < 0).any():
        order = np.argsort(start, kind="stable")
        out = np.empty(len(start), np.uint64)
        out[order] = _spans(values, start[order], end[order], base)
        return out
    inverse = pow(base, -1, 2**64)
    out = np.zeros(len(start), np.uint64)
    short = end - start <= LONGEST
    low = 0
    while low < len(start):
        first = int(start[low])
        high = int(np.searchsorted(start, first + STRETCH))
        near = np.flatnonzero(short[low:high]) + low
        if len(near):
            part = values[first : int(end[near].max())]
            prefix = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * powers(base, len(part)), out=prefix[1:])
            a, b = start[near] - first, end[near] - first
            out[near] = mix((prefix[b] - prefix[a]) * powers(inverse, len(prefix))[a])
        low = high
    key = base.to_bytes(8, "little")
    for k in np.flatnonzero(~short).tolist():
        body = hashlib.blake2b(np.ascontiguousarray(values[int(start[k]) : int(end[k])]), digest_size=8, key=key)
        out[k] = int.from_bytes(body.digest(), "little")
    return out


def blocks(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about `size` bytes; a longer text is a run of its own. NULL is empty."""
    column = column.fill_null("").cast(pa.large_binary()) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs without ASCII white space) and, per text, the index of its first word."""
    gap = SPACE[data]
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    before[cut] = True
    after[cut - 1] = True
    start = np.flatnonzero(~gap & before)
    return start, np.flatnonzero(~gap & after) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    return _spans(_BYTE[family][data], start, end, _BASE[family])


def runs(hashes: np.ndarray, start: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """Hash of the `length` items from each start on."""
    return _spans(hashes, start, start + length, _RUN_BASE[family])


def windows(hashes: np.ndarray, length: int, family: int = 0) -> np.ndarray:
    """What `runs` gives for all starts there are, one after another, which saves looking them up."""
    n = max(0, len(hashes) - length + 1)
    if length > LONGEST:
        return runs(hashes, np.arange(n), length, family)
    base = _RUN_BASE[family]
    inverse = pow(base, -1, 2**64)
    out = np.empty(n, np.uint64)
    for low in range(0, n, STRETCH):
        part = hashes[low : min(low + STRETCH, n) + length - 1]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers(base, len(part)), out=prefix[1:])
        found = prefix[length:] - prefix[:-length]
        found *= powers(inverse, len(found))
        out[low : low + len(found)] = mix(found)
    return out


def spans(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, family: int = 0) -> np.ndarray:
    """Hash of the items from each start to each end."""
    return _spans(hashes, start, end, _RUN_BASE[family])


def byte_values(data: np.ndarray, family: int = 0) -> np.ndarray:
    """The random numbers of the bytes, as items for `runs` and `spans`."""
    return _BYTE[family][data]


def starts(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """All start positions of runs of `length` items inside one text, and the index of the text of each."""
    counts = np.maximum(0, np.diff(offsets) - length + 1)
    text = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[text], text
