"""Pattern packing by non-negative least squares over the histogram of lengths."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, strings, written

CAPACITY = 2048
DRAWS = 16  # patterns tried for each length
MOST_DRAWN = 5  # partners drawn for a pattern
MOST_DOCUMENTS = 8  # lengths of a pattern

# Words of these characters are classed alike by every Unicode version.
_LATIN = re.compile(r"[\n -~¡-ɏ]*")
_ONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class TextIds:
    """Token ids of texts as little-endian 32-bit bytes.

    Runs of Latin characters go through the merge ranks of the same vocabulary, which
    gives the same ids faster. Words with other characters, or with what may be a
    special string, go through the tokenizer itself. A text is parted only at single
    spaces between two visible characters, where a new word always starts.
    """

    def __init__(self, json_path: str, ranks_path: str | None) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(json_path)
        self.model.no_truncation()
        self.model.no_padding()
        self.ranks = None
        if ranks_path:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding(
                "latin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def _other(self, text: str) -> bytes:
        ids = self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.asarray(ids, "<u4").tobytes()

    def _latin(self, text: str) -> bytes:
        return np.asarray(self.ranks.encode_ordinary(text), "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.ranks is None:
            return self._other(text)
        if "<|" not in text and _LATIN.fullmatch(text):
            return self._latin(text)
        out = []
        words = _ONE_SPACE.split(text)
        words[1:] = [f" {w}" for w in words[1:]]
        for latin, run in groupby(words, lambda w: "<|" not in w and bool(_LATIN.fullmatch(w))):
            joined = "".join(run)
            out.append(self._latin(joined) if latin else self._other(joined))
        return b"".join(out)


@lru_cache(maxsize=2)
def _text_ids(json_path: str, ranks_path: str | None) -> TextIds:
    return TextIds(json_path, ranks_path)


def pieces(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Token pieces of every document: ids of the text, then `end_id`.

    A document of more than `capacity` ids is cut into pieces of that length, the first
    may be shorter. Null text counts as empty (one piece of one id). `slice` and `nth`
    number the pieces of one length within the task that made them.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.asarray([end_id], "<u4").tobytes()
    schema = f"id {id_type}, piece int, start long, length int, ids_crc32 long, slice int, nth long"
    schema += ", ids array<long>" * with_ids

    @giving_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _text_ids(json_path, ranks_path)
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            rows, number_of, start_of, length_of, crc, nth, ids = [], [], [], [], [], [], []
            for row, text in enumerate(strings(batch.column(1))):
                data = encode(text) + end
                total = len(data) // 4
                at, piece = 0, 0
                while at < total:
                    length = (total % capacity or capacity) if at == 0 else capacity
                    part = data[4 * at : 4 * (at + length)]
                    rows.append(row)
                    number_of.append(piece)
                    start_of.append(at)
                    length_of.append(length)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[length])
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
                    seen[length] += 1
                    at += length
                    piece += 1
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(number_of, pa.int32()),
                pa.array(start_of, pa.int64()),
                pa.array(length_of, pa.int32()),
                pa.array(crc, pa.int64()),
                pa.array([number] * len(rows), pa.int32()),
                pa.array(nth, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32", "slice", "nth"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def candidate_patterns(lengths: np.ndarray, weights: np.ndarray, capacity: int, draws: int = DRAWS) -> list[tuple[int, ...]]:
    """Multisets of a few lengths that fill a sequence exactly.

    `lengths` ascend. For each of them `draws` patterns are started with up to five partners
    drawn from the histogram, so that all lengths take part as often as they occur, and
    closed with the longest that fits. The number of patterns is bounded by `draws` times
    the number of distinct lengths, whatever the number of documents.
    """
    rng = np.random.default_rng(len(lengths))
    below = np.cumsum(weights.astype(float))
    sorted_lengths = lengths.tolist()
    found: set[tuple[int, ...]] = set()
    for length in sorted_lengths:
        for draw, luck in enumerate(rng.random((draws, MOST_DRAWN)).tolist()):
            pattern, room = [length], capacity - length
            for part in luck[: draw % (MOST_DRAWN + 1)]:
                if not (n := bisect_right(sorted_lengths, room)):
                    break
                at = min(int(np.searchsorted(below, part * below[n - 1], side="right")), n - 1)
                pattern.append(sorted_lengths[at])
                room -= sorted_lengths[at]
            while room and len(pattern) < MOST_DOCUMENTS and (n := bisect_right(sorted_lengths, room)):
                pattern.append(sorted_lengths[n - 1])
                room -= sorted_lengths[n - 1]
            if not room:
                found.add(tuple(sorted(pattern, reverse=True)))
    return sorted(found)


def fit_counts(patterns: list[tuple[int, ...]], wanted: np.ndarray, sweeps: int = 6) -> np.ndarray:
    """Non-negative least squares: repeats of each pattern whose lengths add up to `wanted`.

    Coordinate descent: one repeat after another takes its best value given the others. So
    few patterns carry most of the histogram, with repeats well above 1. `wanted` has the
    count of every length.
    """
    rng = np.random.default_rng(len(patterns))
    left = wanted.astype(float).tolist()
    needs = [tuple(Counter(pattern).items()) for pattern in patterns]
    sizes = [sum(n * n for _, n in need) for need in needs]
    repeats = [0.0] * len(patterns)
    for _ in range(sweeps):
        for i in rng.permutation(len(patterns)).tolist():
            need = needs[i]
            new = max(0.0, repeats[i] + sum(n * left[length] for length, n in need) / sizes[i])
            if change := new - repeats[i]:
                repeats[i] = new
                for length, n in need:
                    left[length] -= n * change
    return np.asarray(repeats)


def fitted_patterns(counts: np.ndarray, capacity: int = CAPACITY, rounds: int = 8) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and whole repeats that `counts`, by length, has room for.

    Repeats are rounded so that their sums stay what was fitted, and cut to what is there.
    What that leaves is fitted again, until a round places less than a hundredth.
    """
    left, total = counts.copy(), int(counts.sum())
    out: list[tuple[tuple[int, ...], int]] = []
    for _ in range(rounds):
        lengths = np.flatnonzero(left)
        patterns = candidate_patterns(lengths, left[lengths], capacity) if len(lengths) else []
        if not patterns:
            break
        repeats, carry, before = fit_counts(patterns, left), 0.5, int(left.sum())
        for i in np.argsort(-repeats, kind="stable").tolist():
            carry += repeats[i]
            times, carry = int(carry), carry % 1
            need = Counter(patterns[i])
            if times := min(times, *(int(left[length]) // n for length, n in need.items())):
                out.append((patterns[i], times))
                for length, n in need.items():
                    left[length] -= n * times
        if before - int(left.sum()) < 0.01 * total:
            break
    return out


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Places for every piece: rows of length, first rank, repeats, first sequence, offset.

    The pieces of a length with ranks `first rank .. + repeats - 1` go to consecutive
    sequences from `first sequence`, at `offset`. What the fitted patterns leave is packed
    by repeating the fullest pattern that the largest length left can start, until nothing
    is left. The number of rows depends on the number of distinct lengths only.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def place(pattern: tuple[int, ...], repeats: int) -> None:
        nonlocal sequence
        offset = 0
        for length in pattern:
            rows.append((length, int(used[length]), repeats, sequence, offset))
            used[length] += repeats
            left[length] -= repeats
            offset += length
        sequence += repeats

    if left[capacity]:
        place((capacity,), int(left[capacity]))
    for pattern, times in fitted_patterns(left, capacity):
        place(pattern, times)
    while left.any():
        free_count = left.copy()
        largest = int(np.flatnonzero(free_count)[-1])
        pattern = [largest]
        free_count[largest] -= 1
        room = capacity - largest
        while room > 0 and len(free := np.flatnonzero(free_count[: room + 1])):
            for length in _closing(free, room, free_count):
                pattern.append(length)
                free_count[length] -= 1
                room -= length
        need = Counter(pattern)
        place(tuple(pattern), min(int(left[length]) // n for length, n in need.items()))
    return rows


def _closing(free: np.ndarray, room: int, count: np.ndarray) -> list[int]:
    """The one or two lengths of `free` (ascending) that fill `room` best."""
    single = int(free[-1])
    at = np.searchsorted(free, room - free, side="right") - 1
    partner = np.where(at >= 0, free[at], 0)
    # A length can close with itself only if it is there twice.
    same = (partner == free) & (count[free] < 2)
    lower = np.where(at >= 1, free[np.maximum(at - 1, 0)], 0)
    partner = np.where(same, lower, partner)
    total = np.where(partner > 0, free + partner, 0)
    best = int(np.argmax(total))
    if total[best] > single:
        return sorted((int(free[best]), int(partner[best])), reverse=True)
    return [single]


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into few sequences of at most `capacity` tokens.

    Returns one row per piece: `id_col`, `piece`, `start`, `length`, `ids_crc32`,
    `sequence_id` and `offset` (and `ids` if asked for). Null texts count as empty;
    repeated rows are packed each; an empty table gives an empty result; columns other
    than the two named are not read.

    The pieces are written once. The driver gets the histogram, at most `capacity` rows,
    and fits repeat counts of few-document patterns to it. A piece's rank among those of
    its length is its number within its task plus the counts of earlier tasks, so a
    length that most documents share is ranked without meeting in one task.
    """
    table = written(
        pieces(docs, json_path, ranks_path, id_col, text_col, capacity, end_id, with_ids), "pieces"
    )
    by_task = table.groupBy("slice", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = sorted(plan_sequences(counts, capacity)) if counts else []
    plan = np.asarray(rows, np.int64).reshape(-1, 5)
    starts = {int(v): int(i) for v, i in zip(*np.unique(plan[:, 0], return_index=True), strict=True)}
    ends = {v: int(np.searchsorted(plan[:, 0], v, side="right")) for v in starts}
    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select(
        "slice", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    ranked = table.join(offsets, ["slice", "length"]).withColumn("rank", F.col("nth") + F.col("before"))
    ranked = ranked.drop("slice", "nth", "before")
    names = [c for c in ranked.columns if c != "rank"]

    @giving_back
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy(zero_copy_only=False)
            at = np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            values, first = np.unique(length[order], return_index=True)
            for value, rows_of in zip(values, np.split(order, first[1:]), strict=True):
                a, b = starts[int(value)], ends[int(value)]
                at[rows_of] = a + np.searchsorted(plan[a:b, 1], rank[rows_of], side="right") - 1
            sequence = plan[at, 3] + rank - plan[at, 1]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(plan[at, 4])], names=[*names, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "rank")
    packed = ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")
    out = ["id", "piece", "start", F.col("length").cast("long"), "ids_crc32", "sequence_id", "offset"]
    return packed.select(*out, *(["ids"] if with_ids else [])).withColumnRenamed("id", id_col)
