"""Benchmark decontamination by q-gram counts in diagonal bands and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, strings
from curatrix.llm.suffixes import grams8, refine

GRAM = 8  # bytes of a q-gram
SHARED = 6  # a match shares grams for one in so many bytes of its item at least
RATE = 0.1  # edits for each byte of an item
WORD = 12  # edits at least, as for one long word, where the lemma's bound allows them
BLOCK_BYTES = 1 << 20  # of benchmark text searched for at once
_SLICE = 1 << 20  # bytes of documents worked on at once
_TABLE_BITS = 21


def normalise(text: str | None) -> bytes:
    """Lower case, one space for each run of white space."""
    return " ".join((text or "").lower().split()).encode()


def _grams(data: np.ndarray) -> np.ndarray:
    """A digest of the `GRAM` bytes from each place where there are as many."""
    return refine(grams8(data), np.zeros(1, np.uint64))


@dataclass
class Index:
    """Grams of a block of items, and the bounds that the q-gram lemma gives them."""

    ids: list
    texts: list[bytes]
    gram: np.ndarray  # distinct, ascending
    head: np.ndarray  # of each gram's postings
    item: np.ndarray
    offset: np.ndarray
    may: np.ndarray  # by the upper bits of a gram: whether any item may have it
    edits: np.ndarray  # budget of each item
    least: np.ndarray  # shared grams that a match within the budget has
    width: np.ndarray  # half the width of a band


def build_index(items: list[tuple[object, bytes]], rate: float = RATE) -> Index:
    """Index of items; those shorter than a gram have none (see `short_matches`).

    A match of `n` bytes with `k` edits shares at least `n - GRAM + 1 - k * GRAM` grams.
    Where the rate, or one long word, allows more edits than keep this above `n / SHARED`,
    the budget is lowered, so that few chance pairs are aligned.
    """
    items = [(i, t) for i, t in items if len(t) >= GRAM]
    sizes = np.asarray([len(t) for _, t in items], np.int64)
    wanted = np.maximum(WORD if rate else 0, (sizes * rate).astype(np.int64))
    edits = np.minimum(wanted, np.maximum(0, (sizes - GRAM + 1 - np.maximum(1, sizes // SHARED)) // GRAM))
    least = np.maximum(1, sizes - GRAM + 1 - edits * GRAM)
    grams = [_grams(np.frombuffer(t, np.uint8)) for _, t in items]
    if not grams:
        none = np.zeros(0, np.int64)
        return Index([], [], none.astype(np.uint64), np.zeros(1, np.int64), none, none, np.zeros(1 << _TABLE_BITS, bool), none, none, none)
    all_ = np.concatenate(grams)
    item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams])
    order = np.argsort(all_, kind="stable")
    gram, head = np.unique(all_[order], return_index=True)
    may = np.zeros(1 << _TABLE_BITS, bool)
    may[gram >> np.uint64(64 - _TABLE_BITS)] = True
    return Index(
        [i for i, _ in items], [t for _, t in items], gram, np.append(head, len(order)), item[order], offset[order],
        may, edits, least, edits + 1,
    )


def candidates(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Text, item and first diagonal of each band with enough shared grams.

    A gram at `pos` of a text and `offset` of an item lies on diagonal `pos - offset`. An
    alignment within the budget stays on `edits + 1` neighbouring diagonals, so it lies
    in one of the bands of twice that width that start every `edits + 1` diagonals.
    """
    gram = _grams(data)
    at = np.flatnonzero(index.may[gram >> np.uint64(64 - _TABLE_BITS)])
    if not len(at) or not len(index.gram):
        return
    where = np.minimum(np.searchsorted(index.gram, gram[at]), len(index.gram) - 1)
    owner = np.searchsorted(offsets, at, side="right") - 1
    real = (index.gram[where] == gram[at]) & (at + GRAM <= offsets[owner + 1])
    at, where, owner = at[real], where[real], owner[real]
    many = index.head[where + 1] - index.head[where]
    posting = np.arange(many.sum()) + np.repeat(index.head[where] - (np.cumsum(many) - many), many)
    owner = np.repeat(owner, many)
    item = index.item[posting]
    diagonal = np.repeat(at, many) - offsets[owner] - index.offset[posting]
    band = diagonal // index.width[item]
    low = int(band.min()) - 1 if len(band) else 0
    span = int(band.max()) - low + 1 if len(band) else 1
    pair = (owner * len(index.ids) + item) * span - low
    keys, counts = np.unique(np.concatenate([pair + band, pair + band - 1]), return_counts=True)
    pair_of, band_of = keys // span, keys % span + low
    item_of = pair_of % len(index.ids)
    for i in np.flatnonzero(counts >= index.least[item_of]):
        yield int(pair_of[i] // len(index.ids)), int(item_of[i]), int(band_of[i] * index.width[item_of[i]])


def banded_distance(pattern: bytes, text: bytes, diagonal: int, width: int, edits: int) -> tuple[int, int]:
    """Fewest edits that turn `pattern` into a part of `text`, and the place where it ends.

    Only diagonals from `edits` before the band to `edits` behind it are filled: one row
    of the matrix for each byte of the pattern, all diagonals of the row at once. Beyond
    `edits` the distance is only known to be more.
    """
    n, span = len(pattern), 2 * width + 2 * edits + 1
    first = diagonal - edits
    room = np.full(n + span + 1, 256, np.int16)  # outside the text nothing matches
    a, b = max(0, first), min(len(text), first + n + span)
    if a >= b:
        return n, 0
    room[a - first : b - first] = np.frombuffer(text, np.uint8, b - a, a)
    steps = np.arange(span)
    # The alignment may start anywhere in the text, but not outside it.
    row = np.where((first + steps >= 0) & (first + steps <= len(text)), 0, n + span)
    for i, byte in enumerate(pattern):
        new = row + (room[i : i + span] != byte)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
        if i % 16 == 15 and row.min() > edits:
            return edits + 1, 0  # costs never fall from row to row
    ends = first + steps + n
    row = np.where((ends >= 0) & (ends <= len(text)), row, n + span)
    best = int(np.argmin(row))
    return int(row[best]), int(ends[best])


def matches(index: Index, texts: list[bytes]) -> Iterator[tuple[int, int, int, int]]:
    """Text, item, edits and end (in the normalised text) of the best match of each pair."""
    row = 0
    while row < len(texts):
        last, held = row, 0
        while last < len(texts) and (last == row or held + len(texts[last]) <= _SLICE):
            held += len(texts[last])
            last += 1
        part = texts[row:last]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in part])]).astype(np.int64)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for who, item, diagonal in candidates(index, np.frombuffer(b"".join(part), np.uint8), offsets):
            known = best.get((who, item))
            if known and known[0] == 0:
                continue
            found = part[who].find(index.texts[item])
            edits = int(index.edits[item])
            if found >= 0:
                result = (0, found + len(index.texts[item]))
            else:
                result = banded_distance(index.texts[item], part[who], diagonal, int(index.width[item]), edits)
            if result[0] <= edits and (known is None or result < known):
                best[(who, item)] = result
        for (who, item), (distance, end) in best.items():
            yield row + who, item, distance, end
        row = last


def short_matches(items: list[tuple[object, bytes]], texts: list[bytes]) -> Iterator[tuple[int, object, int, int]]:
    """Text, item id, edits (none) and end of items shorter than a gram, found as whole words."""
    short = [(i, t) for i, t in items if 0 < len(t) < GRAM]
    for who, text in enumerate(texts if short else ()):
        padded = b" %s " % text
        for item, word in short:
            at = padded.find(b" %s " % word)
            if at >= 0:
                yield who, item, 0, at + len(word)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, bytes]]]:
    """The items in blocks of about `BLOCK_BYTES`, each small enough for every task."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, count)))
    for i in range(count):
        yield [(r["item_id"], normalise(r["text"])) for r in items.where(block == i).distinct().collect()]


def contaminations(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """Every benchmark item that a document holds within the edit budget.

    Returns `doc_id`, `item_id`, `n_edits` and `match_end` (in the normalised text), one
    row for each pair of a document row and an item. Texts are compared in lower case
    with single spaces, byte by byte, whole. An item may have `rate` edits a byte, or as
    many as one long word has, as far as the q-gram lemma's bound keeps a sixth of its grams; items
    under 8 bytes are looked for as whole words, without edits. Null and empty texts hold
    nothing; null and empty items are in nothing; repeated rows of documents are reported
    each, repeated items once; other columns are not read; either table may be empty.

    The benchmark is searched for in blocks of bounded size, each against all documents,
    and nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)
    doc_type, item_type = docs.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType
    schema = f"doc_id {doc_type.simpleString()}, item_id {item_type.simpleString()}, n_edits int, match_end long"
    source = docs.select("doc_id", "text")
    out = None
    for items in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        @giving_back
        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = build_index(shared.value, rate)
            for batch in batches:
                texts = [normalise(t) for t in strings(batch.column(1))]
                found = [(who, index.ids[item], edits, end) for who, item, edits, end in matches(index, texts)]
                found += short_matches(shared.value, texts)
                if found:
                    who, item, edits, end = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(who)),
                            pa.array(item, pa.int64() if isinstance(item[0], int) else None),
                            pa.array(edits, pa.int32()),
                            pa.array(end, pa.int64()),
                        ],
                        names=["doc_id", "item_id", "n_edits", "match_end"],
                    )

        part = source.mapInArrow(search, schema)
        out = part if out is None else out.union(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    # The id types of the inputs are kept by the declared schema.
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no benchmark item."""
    bounded_batches(docs.sparkSession)
    for items in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        @giving_back
        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = build_index(shared.value, rate)
            for batch in batches:
                texts = [normalise(t) for t in strings(batch.column(batch.schema.get_field_index("text")))]
                bad = np.zeros(len(texts), bool)
                bad[[m[0] for m in matches(index, texts)]] = True
                bad[[m[0] for m in short_matches(shared.value, texts)]] = True
                yield batch.filter(pa.array(~bad))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
