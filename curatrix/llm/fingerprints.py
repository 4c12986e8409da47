"""Document fingerprints by a homomorphic hash of the multiset of paragraphs."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, strings

WIDE = 8  # 64-bit words of a paragraph's digest, summed modulo 2^64: they decide equality
LANES = 256  # signed counts of a paragraph's windows, summed modulo 2^32: they tell likeness
WINDOW = 8  # bytes of a window
_BLOCK = 1 << 20  # bytes of whole paragraphs hashed at once
_SLICES = 4  # slices of the order by shuffle partition
_FIRST = -(1 << 63)  # order of a row without an id

Vector = tuple[np.ndarray, np.ndarray]


def zero() -> Vector:
    return np.zeros(WIDE, np.uint64), np.zeros(LANES, np.uint32)


def plus(a: Vector, b: Vector) -> Vector:
    return a[0] + b[0], a[1] + b[1]


def minus(a: Vector, b: Vector) -> Vector:
    return a[0] - b[0], a[1] - b[1]


def _windows(padded: bytes) -> np.ndarray:
    """Signed counts, by lane, of all windows of bytes; each lane is a hash of the window."""
    lanes = np.zeros(2 * LANES, np.int64)
    for a in range(0, len(padded) - WINDOW + 1, _BLOCK):
        n = min(_BLOCK, len(padded) - WINDOW + 1 - a)
        values = np.empty(n, np.uint64)
        for k in range(WINDOW):  # every eighth window starts at byte k of an aligned word
            values[k::WINDOW] = np.frombuffer(padded, "<u8", (n - k + WINDOW - 1) // WINDOW, a + k) if n > k else 0
        # Windows with fewer than four bytes at an edge of their paragraph say too little.
        values = values[((values & np.uint64(0xFFFFFFFFFF)) != 0) & (values >> np.uint64(24) != 0)]
        values *= np.uint64(0x9E3779B97F4A7C15)
        values ^= values >> np.uint64(32)
        values *= np.uint64(0xD6E8FEB86659FD93)
        lanes += np.bincount((values >> np.uint64(64 - 9)).astype(np.int64), minlength=2 * LANES)
    return lanes[::2] - lanes[1::2]


def vector(data: bytes) -> Vector:
    """The sum of the vectors of all paragraphs (lines, also empty ones) of a UTF-8 text.

    A paragraph's vector depends on nothing but the paragraph, so the order of paragraphs
    does not matter, and that of two texts joined by a line end is the sum of theirs.
    """
    wide, lanes = zero()
    start = 0
    while start <= len(data):
        end = data.find(b"\n", min(start + _BLOCK, len(data)))
        end = len(data) if end < 0 else end
        paragraphs = data[start:end].split(b"\n")
        digests = b"".join(hashlib.blake2b(p, digest_size=8 * WIDE).digest() for p in paragraphs)
        wide = wide + np.frombuffer(digests, "<u8").reshape(-1, WIDE).sum(axis=0, dtype=np.uint64)
        # Zero bytes between paragraphs keep a window from reaching from one into the next.
        gap = bytes(WINDOW - 1)
        lanes = lanes + _windows(gap + gap.join(paragraphs) + gap).astype(np.uint32)
        start = end + 1
    return wide, lanes


def text_of(v: Vector) -> str:
    """A vector as text: base64 of its little-endian words."""
    return base64.b64encode(v[0].astype("<u8").tobytes() + v[1].astype("<u4").tobytes()).decode()


def of_text(fingerprint: str) -> Vector:
    data = base64.b64decode(fingerprint)
    return np.frombuffer(data[: 8 * WIDE], "<u8"), np.frombuffer(data[8 * WIDE :], "<u4")


def likeness(a: Vector, b: Vector) -> float:
    """Share of equal windows of two texts, estimated from their vectors; 1 for equal ones.

    The difference of two vectors is the vector of what one text has and the other has
    not; its squared length against those of both vectors tells how much that is. With
    256 lanes the error is about 0.06.
    """
    if (a[0] == b[0]).all() and (a[1] == b[1]).all():
        return 1.0
    x, y = a[1].astype(np.int32).astype(float), b[1].astype(np.int32).astype(float)
    size = x @ x + y @ y
    return float(min(max(1 - ((x - y) ** 2).sum() / size, 0.0), 1.0)) if size else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and `fingerprint` of every whole text; nothing is shuffled.

    A null text counts as empty: one empty paragraph. Texts whose paragraphs (lines) are
    the same in another order have equal fingerprints; other texts differ, but for a
    collision of 512 bits. Rows stay as they are, repeated ones too.
    """
    bounded_batches(docs.sparkSession)

    @giving_back
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_of(vector(text.encode())) for text in strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["id", "fingerprint"])

    kept = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return kept.mapInArrow(mapped, "id long, fingerprint string").withColumnRenamed("id", id_col)


def changed(known: DataFrame, changes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`known` (id, `fingerprint`) after `changes` (id, `paragraph`, `times`), texts not read.

    `times` paragraphs are inserted, or deleted if it is negative; a null paragraph counts
    as empty, null times as none. Documents without a change stay; changes of unknown
    documents, or without an id, do nothing. Each task adds up the changes of a document
    before they are shuffled as numbers by place, so one document may have most of them.
    """
    places = WIDE + LANES
    bounded_batches(known.sparkSession)

    @giving_back
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Vector] = {}
        for batch in batches:
            for who, text, times in zip(batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                if who is None or not times:
                    continue
                wide, lanes = vector(text.encode())
                with np.errstate(over="ignore"):
                    part = wide * np.uint64(times % (1 << 64)), lanes * np.uint32(times % (1 << 32))
                held[who] = plus(held[who], part) if who in held else part
                if len(held) >= 1000:
                    yield _numbers(held)
                    held = {}
        if held:
            yield _numbers(held)

    picked = changes.select(
        F.col(id_col).cast("long").alias("id"), F.col("paragraph").cast("string"), F.col("times").cast("long")
    )
    # Sums may wrap: whole numbers of 38 digits hold any number of 64-bit words.
    total = (
        picked.mapInArrow(sums, "id long, place int, value decimal(20,0)")
        .groupBy("id", "place")
        .agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        .groupBy("id")
        .agg(F.collect_list(F.struct("place", "value")).alias("change"))  # at most one entry for each place
    )

    @F.pandas_udf("string")
    def applied(fingerprint: pd.Series, change: pd.Series) -> pd.Series:
        out = []
        for text, entries in zip(fingerprint, change, strict=True):
            if entries is None or text is None:
                out.append(text)
                continue
            numbers = [0] * places
            for e in entries:
                numbers[e["place"]] = int(e["value"])
            wide = np.array([n % (1 << 64) for n in numbers[:WIDE]], np.uint64)
            lanes = np.array([n % (1 << 32) for n in numbers[WIDE:]], np.uint32)
            out.append(text_of(plus(of_text(text), (wide, lanes))))
        return pd.Series(out)

    return known.join(total.withColumnRenamed("id", id_col), id_col, "left").select(
        id_col, applied("fingerprint", "change").alias("fingerprint")
    )


def _numbers(held: dict[int, Vector]) -> pa.RecordBatch:
    values = [int(x) for wide, lanes in held.values() for x in (*wide.tolist(), *lanes.tolist())]
    places = WIDE + LANES
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.fromiter(held, np.int64, len(held)), places)),
            pa.array(np.tile(np.arange(places, dtype=np.int32), len(held))),
            pa.array(values, pa.decimal128(20, 0)),
        ],
        names=["id", "place", "value"],
    )


def _in_order(docs: DataFrame) -> DataFrame:
    """`id` and `text` by slices of descending id, each with the row that follows it.

    Rows come sorted by `slice`, `turn` and descending id; turn 1 is the head of the slice
    that follows, sent twice. The driver sees two numbers for each slice.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * _SLICES
    order = F.coalesce("id", F.lit(_FIRST))
    cuts = docs.agg(F.percentile_approx(order, [i / n for i in range(1, n)], F.lit(10 * n))).first()[0] or []
    cuts = ~np.unique(np.asarray(cuts, np.int64))[::-1]  # ascending; ~x = -1 - x turns the order round

    @F.pandas_udf("int")
    def slice_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ~ids.to_numpy(np.int64)), dtype="int32")

    sliced = docs.withColumn("order", order).withColumn("slice", slice_of("order"))
    heads = sorted((r["slice"], r["head"]) for r in sliced.groupBy("slice").agg(F.max("order").alias("head")).collect())
    before = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}  # the first follows the last

    @F.pandas_udf("array<int>")
    def slices_of(ids: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, ~ids.to_numpy(np.int64))
        return pd.Series([[s] if (to := before.get(i)) is None else [s, to] for s, i in zip(own.tolist(), ids.tolist(), strict=True)])

    placed = docs.withColumn("order", order).select(
        "id", "text", "order", F.posexplode(slices_of("order")).alias("turn", "slice")
    )
    return placed.repartition(n // _SLICES, "slice").sortWithinPartitions(
        "slice", "turn", F.col("id").desc_nulls_last(), "text"
    )


def edited_text(text: str, follower: str) -> str:
    """`text` whose last half of code points gives way to as many first ones of `follower`."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def _compared(text: str, whole: Vector, follower: str) -> tuple[str, Vector]:
    """The edited text's digest and vector; the paragraphs that both have are not hashed again."""
    edited = edited_text(text, follower)
    kept = text.rfind("\n", 0, len(text) - len(text) // 2)
    # Deleting what the edit takes away and inserting what it brings changes the rest alone.
    gone, come = text[kept + 1 :], edited[kept + 1 :]
    return hashlib.sha256(edited.encode()).hexdigest(), plus(minus(whole, vector(gone.encode())), vector(come.encode()))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and two likenesses.

    The edited text has the last half of the code points replaced by as many first ones (or
    all) of the text that follows by descending id; the last is followed by the first. Rows
    with equal ids follow each other by text, rows without an id come last; a null text
    counts as empty. A single row follows itself. Returns the id, `n_chars`,
    `edited_sha256`, `fingerprint`, `edited_fingerprint`, `near_edited` and `near_next`; an
    empty table gives no rows. The edited fingerprint comes from the text's own by deletion
    and insertion of paragraphs.

    Texts are shuffled once, in slices of the order. Rows with one id stay in one slice.
    """
    bounded_batches(docs.sparkSession)
    kept = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    @giving_back
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # a row that waits for the one that follows it
        out: list[tuple] = []
        for batch in batches:
            ids, turns = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            for who, turn, text in zip(ids, turns, strings(batch.column(1)), strict=True):
                if turn and held is None:
                    continue  # of several heads with one id only the first follows
                whole = vector(text.encode())
                if held is not None:
                    before, own, mine = held
                    digest, other = _compared(own, mine, text)
                    out.append((before, len(own), digest, text_of(mine), text_of(other), likeness(mine, other), likeness(mine, whole)))
                held = None if turn else (who, text, whole)
                if len(out) >= 500:
                    yield _rows(out, names)
                    out = []
        if out:
            yield _rows(out, names)

    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double"
    )
    return _in_order(kept).mapInArrow(follow, schema).withColumnRenamed("id", id_col)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )
