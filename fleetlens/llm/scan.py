"""Words, word hashes and shingles of many texts at once, as numpy over their bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from fleetlens.llm.common import mix

#: Bytes that end a word: ``[\x20\x09-\x0D]``.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z; other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: A 64-bit value per byte, an odd factor and its inverse modulo 2**64.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTOR = 0x2545F4914F6CDD1D
INVERSE = pow(FACTOR, -1, 1 << 64)
#: Bytes of words hashed at once; each takes eight bytes in several arrays.
HASHED_AT_ONCE = 1 << 18


@lru_cache(4)
def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, factor: int) -> np.ndarray:
    """``factor ** i`` modulo 2**64 for ``i < n``."""
    size = HASHED_AT_ONCE if n <= HASHED_AT_ONCE else 1 << 21
    while size < n:
        size <<= 1
    return _powers(size, factor)[:n]


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none
    inside = ~BLANK[raw]
    first = np.zeros(n + 1, bool)
    first[at[:-1]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:n]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(at, start, side="right") - 1


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, with A-Z as a-z; words come in order and none overlaps another."""
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        # a word's hash depends on its own bytes alone, so any run of words can be done by itself
        base = start[first]
        last = max(first + 1, int(np.searchsorted(end, base + HASHED_AT_ONCE, side="right")))
        begins, ends = start[first:last] - base, end[first:last] - base
        total = BYTE_VALUE[LOWER[raw[base : end[last - 1]]]]
        n = len(total)
        total *= powers(n, FACTOR)
        np.cumsum(total, out=total)
        value = total[ends - 1]
        value[begins > 0] -= total[begins[begins > 0] - 1]
        value *= powers(n, INVERSE)[begins]
        out[first:last] = mix(value + (ends - begins).astype(np.uint64))
        first = last
    return out


def shingles(hashes: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``width`` words; a row with fewer words gives them all as one."""
    n = len(hashes)
    value = np.zeros(n, np.uint64)
    for k in range(width):
        part = hashes[k:] * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64))
        value[: max(0, n - k)] += part[: max(0, n - k)]
    whole = np.zeros(n, bool)
    if n >= width:
        whole[: n - width + 1] = row[: n - width + 1] == row[width - 1 :]
    out_row, out = [row[whole]], [value[whole]]
    if n:
        rows, first, count = np.unique(row, return_index=True, return_counts=True)
        for length in range(1, width):
            few = first[count == length]
            short = np.full(len(few), length, np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            for k in range(length):
                short += hashes[few + k] * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64))
            out_row.append(row[few])
            out.append(short)
    return np.concatenate(out_row), mix(np.concatenate(out))


def distinct(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs sorted by row and value, each once."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    keep = np.ones(len(row), bool)
    keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[keep], value[keep]


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row, sorted by row and hash."""
    start, end, row = words(raw, at)
    return distinct(*shingles(word_hashes(raw, start, end), row, width))
