"""Places in texts where a term of a dictionary may start, by rolling hashes.

Terms fall into classes by size: class `p`, a power of two, holds those of `p` to `2p - 1`
bytes. The hashes of all windows of `p` bytes come from those of half the size, so a text
is read once however many terms there are. Two filters of fixed size are asked: whether a
term of the class starts with this window, and, where it may, whether the whole term (its
first and last `p` bytes and its size) is in the dictionary. What passes is a candidate;
it is compared with the terms themselves later.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 22  # each of the two filters has 2^22 bits
_PIECE = 1 << 18  # bytes whose hashes are held at once
_SHORT = 8  # terms of so many bytes are compared as one number
_BUCKET = 32_768  # bits of a row of the JVM's bitmap aggregate

_BYTES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MIX = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and their `len + 1` offsets; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), at - at[:1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def _rolled(data: np.ndarray, classes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each class `p` that fits, the hashes of all windows of `p` bytes."""
    hashes, p = _BYTES[data], 1
    while classes and p <= classes[-1] and len(hashes):
        if p in classes:
            yield p, hashes
        if len(hashes) <= p:
            return
        hashes = hashes[:-p] * np.uint64(pow(_BASE, p, 1 << 64)) + hashes[p:]
        p *= 2


def _spread(hashes: np.ndarray, salt: int) -> np.ndarray:
    mixed = (hashes ^ np.uint64(salt * _BASE % (1 << 64))) * _MIX[0]
    return mixed ^ (mixed >> np.uint64(32))


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a filter for each hash."""
    mask = np.uint64((1 << BITS) - 1)
    return hashes & mask, (hashes >> np.uint64(64 - BITS)) & mask


def _whole(first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    return _spread(first * _MIX[1] + last, size)


@dataclass
class TermMap:
    """The sizes of the terms by class, and the two filters as bytes."""

    sizes: dict[int, list[int]]
    heads: np.ndarray
    wholes: np.ndarray

    @property
    def longest(self) -> int:
        return max((s[-1] for s in self.sizes.values()), default=0)


def _asked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter lets through."""
    one, two = _slots(hashes)
    found = np.flatnonzero(bits[one >> np.uint64(3)] >> (one & np.uint64(7)).astype(np.uint8) & 1)
    two = two[found]
    return found[(bits[two >> np.uint64(3)] >> (two & np.uint64(7)).astype(np.uint8) & 1) == 1]


def _term_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        sizes = np.diff(offsets)
        kinds, slots = [], []
        classes = sorted({1 << int(s).bit_length() - 1 for s in set(sizes.tolist()) if s})
        for p, hashes in _rolled(data, classes):
            mine = np.flatnonzero((sizes >= p) & (sizes < 2 * p))
            first = hashes[offsets[mine]]
            last = hashes[offsets[mine + 1] - p]
            whole = np.concatenate([_whole(first[sizes[mine] == n], last[sizes[mine] == n], n) for n in sorted(set(sizes[mine].tolist()))])
            for kind, found in ((0, _spread(first, p)), (1, whole)):
                for slot in _slots(found):
                    kinds.append(np.full(len(slot), kind, np.int32))
                    slots.append(slot.astype(np.int64))
        if kinds:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kinds)), pa.array(np.concatenate(slots))], names=["kind", "slot"])


def term_map(terms: DataFrame) -> TermMap:
    """The map of the only column of `terms`; the driver gets it and the distinct sizes."""
    sizes = sorted(r[0] for r in terms.select(F.octet_length(terms.columns[0])).distinct().collect() if r[0])
    by_class: dict[int, list[int]] = {}
    for size in sizes:
        by_class.setdefault(1 << size.bit_length() - 1, []).append(size)
    rows = (
        terms.mapInArrow(_term_slots, "kind int, slot long")
        .groupBy("kind", F.expr("bitmap_bucket_number(slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
        .collect()  # 2 * (2^BITS / 32768 + 1) rows of 4 KB at most
    )
    # The aggregate gives slot 0 a bucket of its own and starts the next one after it.
    whole = np.zeros((2, (1 << BITS) // _BUCKET + 2, _BUCKET // 8), np.uint8)
    for row in rows:
        whole[row["kind"], row["bucket"]] = np.frombuffer(row["bits"], np.uint8)
    filters = []
    for bits in whole:
        flat = np.unpackbits(bits, axis=1, bitorder="little")
        filters.append(np.packbits(np.concatenate([flat[0, :1], flat[1:].ravel()])[: 1 << BITS], bitorder="little"))
    return TermMap(by_class, *filters)


def candidates(data: np.ndarray, offsets: np.ndarray, terms: TermMap) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, text, start) of each place where a term of that size may be."""
    classes = sorted(terms.sizes)
    for a in range(0, len(data), _PIECE):
        piece = data[a : a + _PIECE + terms.longest - 1]
        for p, hashes in _rolled(piece, classes):
            starts = _asked(terms.heads, _spread(hashes[:_PIECE], p))
            text = np.searchsorted(offsets, starts + a, side="right") - 1
            room = offsets[text + 1] - a - starts
            for size in terms.sizes[p]:
                fits = np.flatnonzero(room >= size)
                at = starts[fits]
                found = _asked(terms.wholes, _whole(hashes[at], hashes[at + size - p], size))
                if len(found):
                    yield size, text[fits[found]], at[found] + a


def spelled(data: np.ndarray, offsets: np.ndarray, terms: TermMap) -> set[tuple[int, bytes]]:
    """Distinct (text, candidate) as bytes."""
    out: set[tuple[int, bytes]] = set()
    raw = data.tobytes()
    for size, text, start in candidates(data, offsets, terms):
        if size <= _SHORT and len(start) > 1:
            number = np.zeros(len(start), np.uint64)
            for k in range(size):
                number = number << np.uint64(8) | data[start + k].astype(np.uint64)
            order = np.lexsort((number, text))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(text[order]) != 0) | (number[order][1:] != number[order][:-1])
            text, start = text[order[new]], start[order[new]]
        out.update((t, raw[s : s + size]) for t, s in zip(text.tolist(), start.tolist(), strict=True))
    return out
