"""Keys that more than one document has.

Keys travel in rows of many keys: a block of documents sends each of its different keys
once, to the part that the key belongs to. So a key that a third of all documents have
costs a part one entry for each block, not one for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curatrix.llm.common import giving_back

BLOCK_KEYS = 1 << 19
KEY_BITS = 47  # of a key that travel; equal keys stay equal, a rare false match is harmless
SCHEMA = "part int, settled boolean, ids binary, owners binary, keys binary"
_NAMES = ["part", "settled", "ids", "owners", "keys"]


def cut(keys: np.ndarray) -> np.ndarray:
    """The part of each key that travels."""
    return keys >> np.uint64(64 - KEY_BITS)


def _row(part: int, settled: bool, ids: np.ndarray, keys: np.ndarray) -> tuple:
    table, owners = np.unique(ids, return_inverse=True)
    small = owners.astype("<u2" if len(table) <= 1 << 16 else "<u4")
    packed = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return part, settled, _pack_sorted(table), small.tobytes(), packed.tobytes()


def _pack_sorted(table: np.ndarray) -> bytes:
    """Ascending ids as the first one and the steps to the next, in as few bytes as they need."""
    steps = np.diff(table)
    most = int(steps.max(initial=0))
    width = 2 if 0 <= most < 1 << 16 else 8  # a step may overflow, and then comes back the same way
    return np.int64(table[0]).tobytes() + bytes([width]) + steps.astype(f"<i{width}" if width == 8 else "<u2").tobytes()


def _unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, "<i8" if data[8] == 8 else "<u2", offset=9).astype(np.int64)
    return np.concatenate([np.frombuffer(data, "<i8", 1), steps]).cumsum()


def unpack_ids(ids: bytes | np.ndarray, owners: bytes) -> np.ndarray:
    table = np.frombuffer(ids, "<i8")
    return table[np.frombuffer(owners, "<u2" if len(table) <= 1 << 16 else "<u4")]


def unpack_keys(keys: bytes) -> np.ndarray:
    wide = np.zeros((len(keys) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(keys, np.uint8).reshape(-1, 6)
    return wide.view("<u8")[:, 0]


def block_rows(ids: np.ndarray, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of one block: its different keys by part, and what the block already knows.

    A key that several documents of the block have is settled for all but the first of
    them; that first one carries the news to the key's part.
    """
    keys = cut(keys)
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new_key = np.ones(len(keys), bool)
    new_key[1:] = keys[1:] != keys[:-1]
    new_pair = new_key.copy()
    new_pair[1:] |= ids[1:] != ids[:-1]
    keys, ids, new_key = keys[new_pair], ids[new_pair], new_key[new_pair]
    heads = np.flatnonzero(new_key)
    several = np.diff(np.append(heads, len(keys))) > 1
    rows = []
    sent, owners = (keys[heads] << np.uint64(1)) | several.astype(np.uint64), ids[heads]
    home = ((keys[heads] >> np.uint64(KEY_BITS - 32)) * np.uint64(parts)) >> np.uint64(32)
    bounds = np.searchsorted(home, np.arange(parts + 1, dtype=np.uint64))
    for part in range(parts):
        a, b = bounds[part], bounds[part + 1]
        if a < b:
            rows.append(_row(part, False, owners[a:b], sent[a:b]))
    rest = ~new_key
    if rest.any():
        # These go anywhere; the smallest id spreads them.
        rows.append(_row(int(ids[rest].min() % parts), True, ids[rest], keys[rest] << np.uint64(1)))
    return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=_NAMES
    )


class Blocks:
    """Gathers keys until a block is full."""

    def __init__(self, parts: int) -> None:
        self.parts, self.held = parts, 0
        self.ids: list[np.ndarray] = []
        self.keys: list[np.ndarray] = []

    def add(self, ids: np.ndarray, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.ids.append(ids)
        self.keys.append(keys)
        self.held += len(keys)
        if self.held >= BLOCK_KEYS:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield block_rows(np.concatenate(self.ids), np.concatenate(self.keys), self.parts)
            self.ids, self.keys, self.held = [], [], 0


def _shared_of_part(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([b[0] for b in blocks])
    sent = np.concatenate([b[1] for b in blocks])
    order = np.argsort(sent >> np.uint64(1), kind="stable")
    ids, sent = ids[order], sent[order]
    keys = sent >> np.uint64(1)
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    several = np.bitwise_or.reduceat(sent & np.uint64(1), heads) > 0
    several |= np.minimum.reduceat(ids, heads) != np.maximum.reduceat(ids, heads)
    keep = np.repeat(several, np.diff(np.append(heads, len(keys))))
    return ids[keep], keys[keep]


def shared_keys(blocks: DataFrame, partitions: int) -> DataFrame:
    """`id`, `key` of the keys that several documents have, each pair at least once."""
    @giving_back
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for part, settled, ids, owners, keys in zip(*columns, strict=True):
                pair = unpack_ids(_unpack_sorted(ids), owners), unpack_keys(keys)
                if settled:
                    found.append((pair[0], pair[1] >> np.uint64(1)))
                    if sum(len(f[0]) for f in found) > BLOCK_KEYS:
                        yield from _out(found)
                        found = []
                else:
                    held.setdefault(part, []).append(pair)
        for part in list(held):
            found.append(_shared_of_part(held.pop(part)))
            if sum(len(f[0]) for f in found) > BLOCK_KEYS:
                yield from _out(found)
                found = []
        yield from _out(found)

    return blocks.repartition(partitions, "part").mapInArrow(find, "id long, key long")


def _out(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for ids, keys in found:
        order = np.argsort(ids, kind="stable")  # neighbours of one id pack well
        for i in range(0, len(ids), 1 << 17):
            part = order[i : i + (1 << 17)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[part]), pa.array(keys[part].astype(np.int64))], names=["id", "key"]
            )


def sizes(n_bytes: int) -> tuple[int, int]:
    """Parts of the key space, and partitions that hold them, for so many bytes of text.

    A part gets the keys of about 2 MB of text, so that the arrays a task works on stay
    small; a partition holds the parts of about 16 MB one after another.
    """
    return max(64, n_bytes >> 21), max(16, n_bytes >> 24)
