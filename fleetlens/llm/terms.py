"""Lower-cased words of whole texts: runs of digits, letters a-z and characters beyond ASCII."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from fleetlens.llm.common import slices

#: A word of an original text; words of a normalised one are the same runs with A-Z as a-z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: A-Z to a-z, digits, a-z and bytes of longer characters as they are, all else a blank.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else 32 for b in range(256))


def split_words(text: bytes) -> list[bytes]:
    """The normalised words of one text in UTF-8."""
    return text.translate(NORMAL).split()


def word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, list[list[bytes]]]]:
    """``(ids, bytes, starts, words of each row)`` of slices of ``(id, text)``; null text has no words."""
    for ids, raw, at in slices(batches):
        whole = raw.tobytes()
        low = whole.translate(NORMAL)
        yield ids, whole, at, [low[at[i] : at[i + 1]].split() for i in range(len(ids))]
