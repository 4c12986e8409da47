"""Spelling variants of words by sorted permuterm rotations."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, strings, written

TERMINATOR = "\x00"  # marks a word's end; no word may hold it
_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")
_PIECE = 1 << 20  # code points whose runs are listed at once
_HELD = 200_000  # counted words a task holds before it hands them on


def runs(text: str) -> Iterator[list[str]]:
    """All maximal runs of letters of `text`, A to Z lower-cased, a bounded piece at a time."""
    text = text.encode().lower().decode()  # bytes have no other lower case than that of ASCII
    start = 0
    while start < len(text):
        end = len(text)
        if end - start > _PIECE:
            gap = _OTHER.search(text, start + _PIECE)
            end = gap.start() if gap else end
        yield _RUN.findall(text, start, end)
        start = end


def _slipped(word: str, seed: int, every: int) -> str:
    """`word` without one code point if the checksum that `seed` begins is a multiple of `every`."""
    h = zlib.crc32(word.encode(), seed)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(
    docs: DataFrame,
    min_length: int = 5,
    min_count: int = 3,
    slip_every: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`word` and `n`, its occurrences in all texts.

    Words are the maximal runs of `[A-Za-z\\u00C0-\\u00FF]`, of which only A to Z are
    lower-cased. With `slip_every` a run loses one code point where the checksum of its
    document and itself says so, which plants misspellings. Null texts have no words; a
    null id counts as an empty one. Tasks add up their words before the shuffle and hold
    a bounded number of them.
    """
    bounded_batches(docs.sparkSession)

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for who, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)), strict=True):
                found: Counter = Counter()
                for piece in runs(text):
                    found.update(piece)
                if slip_every:
                    seed = zlib.crc32(f"{'' if who is None else who}:".encode())
                    for word, n in found.items():
                        held[_slipped(word, seed, slip_every)] += n
                else:
                    held.update(found)
                if len(held) > _HELD:
                    yield _counted(held, min_length)
                    held = Counter()
        yield _counted(held, min_length)

    counted = docs.select(id_col, text_col).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _counted(held: Counter, min_length: int) -> pa.RecordBatch:
    chosen = [(w, n) for w, n in held.items() if len(w) >= min_length]
    return pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in chosen], pa.string()), pa.array([n for _, n in chosen], pa.int64())],
        names=["word", "n"],
    )


def rotations(words: DataFrame) -> DataFrame:
    """The rotations of each terminated word, each with and without its last code point.

    `key` is what a rotation is sorted by. With `edited` empty it is the whole rotation;
    else it is the rotation less its last code point `edited`, the prefix that the word
    shares with every word that has another code point in that place, and with the word
    that has none there. `first` tells the first of equal neighbouring code points, so
    that a deletion inside such a stretch is met once.
    """
    mark = "'\\0'"
    whole = (
        f"transform(sequence(0, length(word)), i -> named_struct('key', concat(substring(word, i + 1), {mark},"
        " substring(word, 1, i)), 'edited', '', 'first', true))"
    )
    skipping = (
        f"transform(sequence(1, length(word)), i -> named_struct('key', concat(substring(word, i + 1), {mark},"
        " substring(word, 1, i - 1)), 'edited', substring(word, i, 1),"
        " 'first', i = 1 OR substring(word, i, 1) <> substring(word, i - 1, 1)))"
    )
    return (
        words.where(f"length(word) > 0 AND instr(word, {mark}) = 0")
        .select("word", "n", F.explode(F.expr(f"concat({whole}, {skipping})")).alias("r"))
        .select("r.key", "r.edited", "r.first", "word", "n")
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each member of each group of equal keys; keys come in order.

    A group has at most one word of each code point that can stand in the edited place,
    and one without it, so its size is bounded by the alphabet.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows])
        rows = rows.combine_chunks()
        new = _changes(rows["key"])
        last = int(np.flatnonzero(new)[-1])  # the last group may go on in the next batch
        yield from _neighbours(rows.slice(0, last), new[:last])
        rest = rows.slice(last)
    if rest is not None:
        yield from _neighbours(rest, _changes(rest["key"]))


def _changes(keys: pa.ChunkedArray) -> np.ndarray:
    keys = keys.combine_chunks()
    new = np.ones(len(keys), bool)
    if len(keys) > 1:
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
    return new


def _neighbours(rows: pa.Table, new: np.ndarray) -> Iterator[pa.RecordBatch]:
    group = np.cumsum(new) - 1
    more = np.bincount(group, minlength=1)[group] > 1 if len(group) else np.zeros(0, bool)
    if not more.any():
        return
    rows, group = rows.filter(pa.array(more)), group[more]
    rows = rows.append_column("group", pa.array(group))
    # From here on a row's place tells its order of preference inside its group.
    rows = rows.take(pc.sort_indices(rows, [("group", "ascending"), ("n", "descending"), ("word", "ascending")]))
    group = np.unique(rows["group"].to_numpy(), return_inverse=True)[1]
    whole = pc.equal(rows["edited"], "").to_numpy()
    first = rows["first"].to_numpy() & ~whole
    n_groups, none = int(group[-1]) + 1, len(group)

    def best(chosen: np.ndarray, skip: int = 0) -> np.ndarray:
        """Place of the first row among `chosen` of each group, or of the one after it."""
        at = np.flatnonzero(chosen)
        head = np.flatnonzero(np.concatenate([[True], group[at][1:] != group[at][:-1]])) if len(at) else at
        out = np.full(n_groups, none)
        mine = group[at[head]]
        head = head + skip
        fits = head < len(at)
        fits[fits] = group[at[head[fits]]] == mine[fits]
        out[mine[fits]] = at[head[fits]]
        return out

    def number(chosen: np.ndarray) -> np.ndarray:
        return np.bincount(group[chosen], minlength=n_groups)

    place = np.arange(len(group))
    top, second = best(~whole)[group], best(~whole, 1)[group]
    other = np.where(top == place, second, top)
    shorter = np.where(first, best(whole)[group], none)
    near = np.where(whole, best(first)[group], np.minimum(other, shorter))
    count = np.where(whole, number(first)[group], number(~whole)[group] - 1 + (first & (number(whole)[group] > 0)))
    found = np.flatnonzero(count > 0)
    if len(found):
        at = near[found]
        yield pa.RecordBatch.from_arrays(
            [
                rows["word"].combine_chunks().take(pa.array(found)),
                pa.array(count[found].astype(np.int64)),
                rows["word"].combine_chunks().take(pa.array(at)),
                rows["n"].combine_chunks().take(pa.array(at)),
            ],
            names=["word", "n_near", "near", "near_n"],
        )


def nearest(words: DataFrame) -> DataFrame:
    """`word`, `n_near` and `near`, `near_n`: the near word with the largest count.

    Words are near if they differ by exactly one inserted, deleted or replaced code point;
    of near words with equal counts the smallest in code-point order is taken. Words
    without a near one are left out. All rotations are sorted over range partitions; equal
    keys stand together, and a pair of near words meets in exactly one group.
    """
    sorted_keys = rotations(words).repartitionByRange("key").sortWithinPartitions("key")
    found = sorted_keys.mapInArrow(_scan, "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near")))
    return (
        found.groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best.alias("best"))
        .select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.order")).alias("near_n"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """`word` and `root`, the end of its chain of forms.

    Each round jumps to the form's own root so far, so rounds grow with the logarithm of
    the longest chain. Counts rise along a chain, so it has an end. The driver sees a count.
    """
    roots = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while roots.where("moved").limit(1).count():
        further = roots.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        roots = written(
            roots.join(further, F.col("root") == F.col("_word"), "left").select(
                "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
            ),
            "roots",
        )
    return roots.select("word", "root")


def spelling_variants(words: DataFrame, ratio: float = 2) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` of each word of `words` (`word`, `n`).

    A word's form is its near word with the largest count (ties: the smallest), if that is
    at least `ratio` (above 1) times its own, else null; its root is the end of the chain of forms, or
    the word itself. Repeated words are added up first. Null words, empty words and words
    that hold the terminator U+0000 have no near words; null words are left out. An empty
    table gives an empty result; further columns are not read.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = written(
        words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words"
    )
    near = nearest(words)
    known = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("near_n") >= F.col("n") * ratio, F.col("near")).alias("form"),
        F.when(F.col("near_n") >= F.col("n") * ratio, F.col("near_n")).alias("form_n"),
    )
    known = written(known, "forms")
    roots = _roots(known.where("form is not null"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
