"""Prefix-free parse of texts into phrases, cut where a rolling hash triggers.

The trigger of a window of ``SPAN`` bytes is its gram with the least rolling
hash.  Neighbouring windows with one trigger make a phrase, so phrases of a
text overlap by ``SPAN - 1`` bytes and every window is in exactly one.  Equal
windows have equal triggers wherever they stand: strings of ``SPAN`` bytes
repeat only between phrases with the same trigger.
"""

from __future__ import annotations

import numpy as np

from fleetlens.llm.common import mix
from fleetlens.llm.scan import BYTE_VALUE, FACTOR, INVERSE, powers

#: Bytes of a repeated string.
SPAN = 50
#: Bytes of a trigger.
GRAM = 20
#: Bytes parsed at once; positions take the low bits of the keys that are compared.
PIECE = 1 << 21
_PLACE = np.uint64((1 << 22) - 1)


def parse(raw: np.ndarray, at: np.ndarray, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(row, first, last, trigger, phrase, left, right)`` of every phrase: its
    row, its first and last window in ``raw``, the hash of its trigger and of
    its bytes, and 15-bit marks of the trigger with the bytes to its left and to
    its right that make up half of a window's rest.

    A window holds its trigger and that half on one side at least, so windows
    are equal only where a mark is.  0 stands for a half that the row cuts off.
    ``raw`` may hold up to 4 MB.
    """
    n = len(raw)
    none = np.empty(0, np.int64)
    if n < span:
        return none, none, none, *[none.astype(np.uint64)] * 4
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUE[raw] * powers(n, FACTOR), out=total[1:])
    back = powers(n, INVERSE)
    hashes = mix((total[gram:] - total[:-gram]) * back[: n - gram + 1])
    key = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    # least key of each run of `wide` grams, by doubling
    wide, have = span - gram + 1, 1
    while have * 2 <= wide:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < wide:
        key = np.minimum(key[: len(key) - (wide - have)], key[wide - have :])
    place = (key & _PLACE).astype(np.int64)
    inside = np.zeros(n + 1, np.int8)
    size = np.diff(at)
    has = size >= span
    np.add.at(inside, at[:-1][has], 1)
    np.add.at(inside, at[1:][has] - span + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[:-1])[: len(place)])
    if not len(window):
        return none, none, none, *[none.astype(np.uint64)] * 4
    place = place[window]
    cut = np.flatnonzero(np.r_[True, (place[1:] != place[:-1])])
    first, trigger = window[cut], place[cut]
    last = window[np.r_[cut[1:], len(window)] - 1]
    value = (total[last + span] - total[first]) * back[first]
    shape = (last - first).astype(np.uint64) * np.uint64(64) + (trigger - first).astype(np.uint64)
    row = np.searchsorted(at, first, side="right") - 1
    half = (span - gram) // 2

    def mark(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        inside = (begin >= at[row]) & (end <= at[row + 1])
        begin, end = np.where(inside, begin, 0), np.where(inside, end, 0)
        value = (mix((total[end] - total[begin]) * back[begin]) >> np.uint64(49)) + np.uint64(1)
        return np.where(inside, value, np.uint64(0))

    return row, first, last, hashes[trigger], mix(value + mix(shape)), mark(trigger - half, trigger + gram), mark(trigger, trigger + gram + half)
