"""Sets of word shingles as 64-bit digests, for many texts at once."""

from __future__ import annotations

import numpy as np

from curatrix.llm.suffixes import refine

WORDS = 5
_TABLE = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
CHUNK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, CHUNK + 1), _powers(_INVERSE, CHUNK + 1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and digest of every word of the texts that lie end to end in `data`."""
    inner = ~_SPACE[data]
    begin, end = inner.copy(), inner.copy()
    begin[1:] &= ~inner[:-1]
    end[:-1] &= ~inner[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begin[edges] = inner[edges]
    end[edges - 1] = inner[edges - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    digest = np.empty(len(start), np.uint64)
    # A sum of powers over a piece of the bytes; a word longer than a piece is summed by pieces.
    first = 0
    while first < len(start):
        base = start[first]
        last = max(first + 1, int(np.searchsorted(stop, base + CHUNK, side="right")))
        a, b = start[first:last], stop[first:last]
        if b[-1] - base <= CHUNK:
            values = _TABLE[_LOWER[data[base : b[-1]]]] * _UP[: b[-1] - base]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
            digest[first:last] = (sums[b - base] - sums[a - base]) * _DOWN[a - base]
        else:
            total = np.zeros(1, np.uint64)
            for at in range(int(base), int(b[-1]), CHUNK):
                part = _TABLE[_LOWER[data[at : min(at + CHUNK, int(b[-1]))]]]
                total = refine(total, (part * _UP[: len(part)]).sum(dtype=np.uint64)[None])
            digest[first:last] = total
        first = last
    owner = np.searchsorted(offsets, start, side="right") - 1
    return owner, refine(digest, (stop - start).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text: text number and digest, sorted by both.

    A text with fewer words than a shingle has its whole sequence as the only one; a text
    without words has none.
    """
    owner, word = words(data, offsets)
    n = len(word)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    if n >= WORDS:
        two = refine(word[:-1], word[1:])
        four = refine(two[:-2], two[2:])
        five = refine(four[:-1], word[4:])
        inside = owner[: n - WORDS + 1] == owner[WORDS - 1 :]
        who, digest = owner[: n - WORDS + 1][inside], five[inside]
    else:
        who, digest = owner[:0], word[:0]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        heads = np.cumsum(counts) - counts
        whole = counts[short].astype(np.uint64)
        for k in range(WORDS - 1):
            has = counts[short] > k
            whole[has] = refine(whole[has], word[heads[short[has]] + k])
        who, digest = np.concatenate([who, short]), np.concatenate([digest, whole])
    order = np.lexsort((digest, who))
    who, digest = who[order], digest[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (digest[1:] != digest[:-1])
    return who[new], digest[new]
