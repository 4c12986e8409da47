"""Bucket identifiers of text positions, refined by the identifiers of later offsets.

The initial bucket of a position is its q-gram of 8 bytes. A bucket is refined by the
identifier found at a later offset, and each refinement reuses the one before it:
8 bytes give 16, 16 give 26, and 26 give the 50 bytes of a whole window. Identifiers
are 64-bit digests, so every task gives equal strings equal identifiers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

LENGTH = 50  # of the strings looked for
GRAM = 26  # of the grams that name a window's bucket
SPAN = LENGTH - GRAM + 1  # grams in a window
STEP = 1 << 17  # windows worked on at once
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_S = np.uint64(32)


def refine(head: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of buckets split by the identifier at a later offset."""
    x = head * _A
    x += later
    x ^= x >> _S
    x *= _B
    x ^= x >> _S
    return x


def grams8(data: np.ndarray) -> np.ndarray:
    """The initial buckets: 8 bytes from each position as one number."""
    n = len(data)
    out = np.empty(max(0, n - 7), np.uint64)
    for k in range(min(8, len(out))):
        out[k::8] = data[k : k + (n - k) // 8 * 8].view("<u8")
    return out


def buckets26(data: np.ndarray) -> np.ndarray:
    first = grams8(data)
    second = refine(first[:-8], first[8:])
    return refine(second[:-10], second[10:])


def buckets50(deep: np.ndarray) -> np.ndarray:
    """Whole windows from the buckets of their first and last 26 bytes."""
    return refine(deep[: -(LENGTH - GRAM)], deep[LENGTH - GRAM :])


def _least(values: np.ndarray) -> np.ndarray:
    """The smallest of each `SPAN` neighbours."""
    for reach in (1, 2, 4, 8):
        values = np.minimum(values[:-reach], values[reach:])
    return np.minimum(values[: -(SPAN - 16)], values[SPAN - 16 :])


@dataclass
class Stretches:
    """Neighbouring windows that share a bucket, of texts that lie end to end."""

    key: np.ndarray  # bucket identifier: the smallest 26-byte bucket in each window
    owner: np.ndarray  # row of the text
    at: np.ndarray  # place of the first window
    count: np.ndarray  # windows
    first: int  # place of `deep[0]`
    deep: np.ndarray  # 26-byte buckets of the part of the texts these come from

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, stretch and 50-byte identifier of each window of the chosen stretches."""
        at, count = self.at[chosen], self.count[chosen]
        nth = np.repeat(np.arange(len(at)), count)
        place = np.arange(len(nth)) + np.repeat(at - (np.cumsum(count) - count), count)
        head = place - self.first
        return place, nth, refine(self.deep[head], self.deep[head + LENGTH - GRAM])


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[Stretches]:
    """All 50-byte windows of the texts that lie end to end in `data`, by their bucket.

    Windows with equal bytes always have the same key, whatever stands around them, so
    two texts share a 50-byte string only where they share a key.
    """
    total = len(data)
    for a in range(0, max(0, total - LENGTH + 1), STEP):
        b = min(a + STEP, total - LENGTH + 1)
        deep = buckets26(data[a : b + LENGTH - 1])
        least = _least(deep)
        # A window may not cross the end of a text: no offset lies inside it.
        edges = offsets[np.searchsorted(offsets, a, side="right") : np.searchsorted(offsets, b + LENGTH)]
        change = np.zeros(b - a + 1, np.int32)
        np.add.at(change, np.clip(edges - (LENGTH - 1) - a, 0, b - a), 1)
        np.add.at(change, np.clip(edges - a, 0, b - a), -1)
        whole = np.cumsum(change[:-1]) == 0
        first = whole.copy()
        first[1:] &= (least[1:] != least[:-1]) | ~whole[:-1]
        at = np.flatnonzero(first)
        if len(at):
            valid = np.concatenate([[0], np.cumsum(whole)])
            count = np.diff(valid[np.append(at, b - a)])
            owner = np.searchsorted(offsets, at + a, side="right") - 1
            yield Stretches(least[at], owner, at + a, count, a, deep)
