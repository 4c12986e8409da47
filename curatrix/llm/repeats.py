"""Repeated passages across documents by bucket-pointer refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - `pa.compute` is used in tasks
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, utf8, written
from curatrix.llm.idmap import choose, wanted_map
from curatrix.llm.sharing import SCHEMA, Blocks, cut, shared_keys, sizes, unpack_ids, unpack_keys
from curatrix.llm.suffixes import LENGTH, SPAN, STEP, buckets26, buckets50, refine, stretches

_ENTRIES = "part int, settled boolean, ids binary, digests binary, owners binary, starts binary, counts binary, keys binary, bytes binary"
_HELD = 1 << 18  # windows compared at once within a batch
_SHARE = 1 << 19  # windows of a part compared at once
_TOGETHER = 20_000  # buckets of documents that are sent to one part for one first document
_MARKS = "id long, digest long, spans binary"


def _first_buckets(texts: DataFrame, parts: int) -> DataFrame:
    """The initial buckets: the keys of all windows of every text."""
    @giving_back
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(parts)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = utf8(batch.column(1))
            for part in stretches(data, offsets):
                yield from blocks.add(ids[part.owner], part.key)
        yield from blocks.flush()

    return texts.select("id", "text").mapInArrow(gather, SCHEMA)


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows of sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _later(ids: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether a document with a smaller id has the same window.

    Buckets are sorted by the identifiers of their windows' later offsets; the smallest
    id of each refined bucket keeps its bytes.
    """
    order = np.argsort(bucket)
    bucket, sorted_ids = bucket[order], ids[order]
    heads = _groups(bucket)
    least = np.minimum.reduceat(sorted_ids, heads) if len(heads) else sorted_ids
    out = np.empty(len(ids), bool)
    out[order] = sorted_ids > np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


def _merge(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of the spans of each owner; spans that touch become one. No spans give none."""
    if not len(owner):
        return owner, start, end
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    # Ends grow within an owner after this, also where one span lies inside another.
    width = int(end.max()) + 1 if len(end) else 1
    reach = np.maximum.accumulate(owner * width + end) - owner * width
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(owner)) - 1
    return owner[heads], start[heads], reach[last]


def _pack_spans(start: np.ndarray, end: np.ndarray) -> bytes:
    """Starts and lengths in as few bytes as they need, after the two widths."""
    length = end - start
    wide_start, wide_length = 8 if int(start.max()) >> 31 else 4, 8 if int(length.max()) >> 16 else 2
    first = start.astype(f"<i{wide_start}").tobytes()
    return bytes([wide_start, wide_length]) + first + length.astype("<u2" if wide_length == 2 else "<i8").tobytes()


def _unpack_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = (len(data) - 2) // (data[0] + data[1])
    start = np.frombuffer(data, f"<i{data[0]}", n, 2).astype(np.int64)
    length = np.frombuffer(data, "<u2" if data[1] == 2 else "<i8", n, 2 + n * data[0]).astype(np.int64)
    return start, start + length


def _mark_rows(ids: np.ndarray, digests: np.ndarray, owner: np.ndarray, start: np.ndarray) -> Iterator[tuple]:
    """Per text: id, digest and the merged spans of the windows that start at `start`."""
    yield from _span_rows(ids, digests, *_window_spans(owner, start))


def _window_spans(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = start.astype(np.int64)
    return _merge(owner.astype(np.int64), start, start + LENGTH)


def _span_rows(
    ids: np.ndarray, digests: np.ndarray, owner: np.ndarray, start: np.ndarray, end: np.ndarray
) -> Iterator[tuple]:
    heads = _groups(owner)
    for a, b in zip(heads, [*heads, len(owner)][1:], strict=True):
        who = owner[a]
        yield int(ids[who]), int(digests[who]), _pack_spans(start[a:b], end[a:b])


def _homes(shared: DataFrame, parts: int) -> DataFrame:
    """`key` and `deal`: its home, and how many ways its windows are dealt, times `parts`.

    Keys with the same first document meet in one part, so a document meets few parts
    beside each older one that it shares passages with. What many documents share with
    one first document is dealt over several parts by key, and a single key that many
    have by the identifier of the whole window; equal windows always meet.
    """
    firsts = shared.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    total = firsts.groupBy("first").agg(F.sum("n").alias("all"))
    salt = F.pmod(F.xxhash64("key"), F.ceil(F.col("all") / _TOGETHER))
    home = F.pmod(F.xxhash64("first", salt), F.lit(parts))
    ways = F.ceil(F.col("n") / _TOGETHER)
    # One number for both: arrays of numbers are packed closer than arrays of structs.
    return firsts.join(total, "first").select("key", (ways * parts + home).alias("deal"))


def _entry_rows(
    ids: np.ndarray, digests: np.ndarray, data: np.ndarray, owner: np.ndarray, key: np.ndarray,
    place: np.ndarray, home: np.ndarray, base: np.ndarray, parts: int,
) -> Iterator[tuple]:
    """Rows of windows to compare, each stretch with its bytes, by their part."""
    order = np.argsort(place, kind="stable")
    owner, key, place, home = owner[order], key[order], place[order], home[order]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1]) | (key[1:] != key[:-1]) | (home[1:] != home[:-1])
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(place)))
    pieces = -(-count // SPAN)  # a count travels as one byte
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = np.repeat(place[heads], pieces) + nth * SPAN
    count = np.minimum(np.repeat(count, pieces) - nth * SPAN, SPAN)
    owner, key, home = (np.repeat(c[heads], pieces) for c in (owner, key, home))
    order = np.argsort(home, kind="stable")
    bounds = np.searchsorted(home[order], np.arange(parts + 1))
    for part in range(parts):
        chosen = order[bounds[part] : bounds[part + 1]]
        if not len(chosen):
            continue
        table, small = np.unique(owner[chosen], return_inverse=True)
        spans = count[chosen] + LENGTH - 1
        where = np.arange(spans.sum()) + np.repeat(at[chosen] - (np.cumsum(spans) - spans), spans)
        yield (
            part,
            False,
            ids[table].astype("<i8").tobytes(),
            digests[table].astype("<i8").tobytes(),
            small.astype("<u2" if len(table) <= 1 << 16 else "<u4").tobytes(),
            (at[chosen] - base[owner[chosen]]).astype("<i8" if int(at.max()) >> 31 else "<i4").tobytes(),
            count[chosen].astype(np.uint8).tobytes(),
            cut(key[chosen]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
            data[where].tobytes(),
        )


def _refined(texts: DataFrame, shared: DataFrame, parts: int) -> DataFrame:
    """Windows of shared buckets that no earlier document near them in their batch has.

    Those that one has are settled there: their spans pass through as marks.
    """
    kept = (
        shared.join(_homes(shared, parts), "key")
        .groupBy(F.col("id").alias("_id"))
        .agg(F.collect_list("key").alias("keys"), F.collect_list("deal").alias("deals"))
    )
    joined = texts.join(kept, F.col("id") == F.col("_id"), "left").select("id", "digest", "text", "keys", "deals")

    @giving_back
    def refine_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            digests = batch.column(1).to_numpy(zero_copy_only=False)
            data, offsets = utf8(batch.column(2))
            keys, deals = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (3, 4))
            if not len(keys):
                continue
            known, first = np.unique(keys, return_index=True)
            wanted = known.astype(np.uint64)
            ways, home = np.divmod(deals[first], parts)
            found: list[tuple[np.ndarray, ...]] = []
            held = 0
            for part in stretches(data, offsets):
                short = cut(part.key)
                at = np.minimum(np.searchsorted(wanted, short), len(wanted) - 1)
                chosen = np.flatnonzero(wanted[at] == short)
                if len(chosen):
                    place, nth, window = part.windows(chosen)
                    which = at[chosen][nth]
                    way = (refine(window, part.key[chosen][nth]) >> np.uint64(33)).astype(np.int64) % ways[which]
                    found.append((part.owner[chosen][nth], part.key[chosen][nth], place, window, (home[which] + way) % parts))
                    held += len(place)
                if held >= _HELD:
                    yield from settle(ids, digests, data, offsets, found)
                    found, held = [], 0
            if found:
                yield from settle(ids, digests, data, offsets, found)

    def settle(
        ids: np.ndarray, digests: np.ndarray, data: np.ndarray, offsets: np.ndarray, found: list[tuple[np.ndarray, ...]]
    ) -> Iterator[pa.RecordBatch]:
        owner, key, place, window, home = (np.concatenate(c) for c in zip(*found, strict=True))
        known = _later(ids[owner], refine(window, key))
        sent = (c[~known] for c in (owner, key, place, home))
        rows = list(_entry_rows(ids, digests, data, *sent, offsets, parts))
        if known.any():
            marks = _mark_rows(ids, digests, owner[known], place[known] - offsets[owner[known]])
            rows += [(i % parts, True, *m, b"", b"", b"", b"") for i, m in enumerate(_as_columns(marks))]
        types = [pa.int32(), pa.bool_(), *[pa.binary()] * 7]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
            names=[f.split()[0] for f in _ENTRIES.split(", ")],
        )

    return joined.mapInArrow(refine_windows, _ENTRIES)


def _as_columns(marks: Iterator[tuple]) -> Iterator[tuple[bytes, bytes, bytes]]:
    """Settled marks in the columns of an entry row."""
    for who, digest, spans in marks:
        yield np.int64(who).tobytes(), np.int64(digest).tobytes(), spans


def _marks(entries: DataFrame, partitions: int) -> DataFrame:
    """Spans of each text that a text of a smaller id also has."""
    @giving_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            out = []
            for row in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
                if row[1]:
                    out.append((int(np.frombuffer(row[2], "<i8")[0]), int(np.frombuffer(row[3], "<i8")[0]), row[4]))
                else:
                    held.setdefault(row[0], []).append(row[2:])
            yield from _mark_batch(out)
        found = [_compare_part(held.pop(part)) for part in list(held)]
        yield from _mark_batch(list(_joined_marks([f for f in found if len(f[0])])))

    return entries.repartition(partitions, "part").mapInArrow(compare, _MARKS)


def _mark_batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        types = [pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["id", "digest", "spans"]
        )


def _joined_marks(found: list[tuple[np.ndarray, ...]]) -> Iterator[tuple]:
    """One row for each text of the spans that the parts of a task have found in it."""
    if not found:
        return
    ids, digests, start, end = (np.concatenate(c) for c in zip(*found, strict=True))
    texts, owner = np.unique(np.column_stack([ids, digests]), axis=0, return_inverse=True)
    yield from _span_rows(texts[:, 0], texts[:, 1], *_merge(owner.ravel(), start, end))


def _compare_part(rows: list[tuple]) -> tuple[np.ndarray, ...]:
    """Id, digest, start and end of the spans of the part's texts that an older text has too."""
    ids, digests, start, count, key, data = [], [], [], [], [], []
    for who, digest, owners, starts, counts, keys, text in rows:
        n = len(counts)
        ids.append(unpack_ids(who, owners))
        digests.append(unpack_ids(digest, owners) if len(who) == len(digest) else None)
        start.append(np.frombuffer(starts, "<i4" if len(starts) == 4 * n else "<i8").astype(np.int64))
        count.append(np.frombuffer(counts, np.uint8).astype(np.int64))
        key.append(unpack_keys(keys))
        data.append(np.frombuffer(text, np.uint8))
    ids, digests, start, count, key, data = map(np.concatenate, (ids, digests, start, count, key, data))
    # One number for each text: its id and digest together.
    texts, owner = np.unique(np.column_stack([ids, digests]), axis=0, return_inverse=True)
    owner = owner.ravel()
    offsets = np.cumsum(count + LENGTH - 1) - (count + LENGTH - 1)
    before = np.cumsum(count) - count
    total = int(count.sum())

    def stretch(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nth = np.searchsorted(before, index, side="right") - 1
        return nth, index - before[nth]

    bucket = np.empty(total, np.uint64)
    for a in range(0, total, STEP):
        index = np.arange(a, min(a + STEP, total))
        nth, step = stretch(index)
        place = offsets[nth] + step
        low = place[0]
        deep = buckets26(data[low : place[-1] + LENGTH])
        bucket[index] = refine(buckets50(deep)[place - low], key[nth])
    # A part that many windows share, as of one word repeated, is compared by shares.
    shares = total // _SHARE + 1
    spans = []
    for share in range(shares):
        index = np.flatnonzero(bucket % np.uint64(shares) == share) if shares > 1 else np.arange(total)
        nth, step = stretch(index)
        later = _later(ids[nth], bucket[index])
        spans.append(_window_spans(owner[nth[later]], (start[nth] + step)[later]))
    who, first, last = _merge(*(np.concatenate(c) for c in zip(*spans, strict=True)))
    return texts[who, 0], texts[who, 1], first, last


def _unpacked(spans) -> tuple[np.ndarray, np.ndarray]:
    """Merged starts and ends of several packed spans of one text."""
    start, end = map(np.concatenate, zip(*map(_unpack_spans, spans), strict=True))
    _, start, end = _merge(np.zeros(len(start), np.int64), start, end)
    return start, end


def _without(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    left, at = [], 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        left.append(text[at:a])
        at = b
    return b"".join([*left, text[at:]])


def _apply(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """What the cuts take from each text with a mark, and the digest of what is left."""
    by_id = marks.groupBy("id").agg(F.collect_list(F.struct("digest", "spans")).alias("spans"))
    joined = texts.join(by_id.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    schema = "id long, digest long, n_removed long, n_spans long, kept_sha256 string"

    @giving_back
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts_ = batch.column(2)
            for i, spans in enumerate(batch.column(3)):
                who, digest = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                own = [s["spans"] for s in spans.as_py() or () if s["digest"] == digest]
                if own:
                    start, end = _unpacked(own)
                    text = texts_[i].as_py().encode()
                    left = _without(text, start, end)
                    rows.append((who, digest, len(text) - len(left), len(start), hashlib.sha256(left).hexdigest()))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=[f.split()[0] for f in schema.split(", ")]
            )

    return joined.select("id", "digest", "text", "spans").mapInArrow(remove, schema)


def _digest(text: F.Column) -> F.Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _found(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts that are looked into, the marks found in them, and the keeper of each set of copies."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, partitions = sizes(total)
    keepers = (
        _measured(docs)
        .where(f"doc_id is not null and n_bytes >= {LENGTH}")
        .groupBy("digest", "second", "n_bytes")
        .agg(F.min("doc_id").alias("keeper"))
    )
    by_id = docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).where(
        f"doc_id is not null and octet_length(text) >= {LENGTH}"
    ).repartition(partitions, "id")
    # The exclusive or keeps the digest out of the join's keys, so the texts stay dealt by id.
    texts = by_id.join(
        keepers.select("keeper", F.col("digest").alias("own")).hint("shuffle_merge"),
        (F.col("id") == F.col("keeper")) & (F.xxhash64("text").bitwiseXOR(F.col("own")) == 0),
    ).select("id", F.col("own").alias("digest"), "text")
    shared = written(shared_keys(_first_buckets(texts, parts), partitions), "shared")
    return texts, _marks(_refined(texts, shared, parts), partitions), keepers


def _measured(docs: DataFrame, *more: str) -> DataFrame:
    """Id, two digests and size of every text, which counts as empty if null, and columns `more`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _digest(F.col("text")).alias("digest"),
        F.xxhash64(F.lit("second"), text).alias("second"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        *more,
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Remove every byte of a 50-byte string that also starts in a document of a smaller id.

    Returns one row per input row: `doc_id`, `n_bytes`, `n_removed`, `n_spans` (maximal
    removed runs) and `kept_sha256`. Null texts count as empty. A row without an id keeps
    all its bytes and removes none elsewhere. Rows of one id remove nothing from each
    other, and each gets its own result, also if repeated. Columns other than `doc_id` and
    `text` are not read; an empty table gives an empty result. For the texts see
    `cut_repeats`.

    1. Of exact copies only the one with the smallest id is looked into; the others lose
       every byte (if there are 50).
    2. The key of a 50-byte window is its smallest 26-byte bucket. Keys that only one
       document has are final buckets of one and are left.
    3. The windows of the other buckets are refined to 50 bytes by the identifiers of
       later offsets, first within a batch of documents, then, with the bytes of what is
       not settled there, over all documents.
    4. The spans are merged for each document and cut out.

    The texts are shuffled once, by id; each step that reads them again reuses that
    shuffle.
    """
    id_type = docs.schema["doc_id"].dataType
    texts, marks, keepers = _found(docs)
    found = _apply(texts, marks).dropDuplicates(["id", "digest"])
    sha256 = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    base = _measured(docs.select("doc_id", "text", sha256.alias("sha256")), "sha256")
    out = (
        base.join(keepers, ["digest", "second", "n_bytes"], "left")
        .join(
            found.withColumnRenamed("digest", "_digest"),
            (F.col("doc_id") == F.col("id")) & (F.col("digest") == F.col("_digest")),
            "left",
        )
    )
    copy = F.col("doc_id") > F.col("keeper")
    return out.select(
        F.col("doc_id").cast(id_type).alias("doc_id"),
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def cut_repeats(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, with their repeated passages cut out of `text`.

    `n_chars`, if there, follows the text. What is left of a character that was cut is
    dropped. A row of which nothing is left goes; rows that were empty stay. Only texts
    with something cut out are shuffled again, to meet their spans.
    """
    _, marks, keepers = _found(docs)
    spans = written(
        marks.groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(F.collect_list("spans").alias("_spans")), "spans"
    )
    copies = written(
        _measured(docs).join(keepers, ["digest", "second", "n_bytes"]).where("doc_id > keeper")
        .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(),
        "copies",
    )
    changed = wanted_map(spans.select("_id").union(copies.select("_id")))
    own = (F.col("doc_id") == F.col("_id")) & (_digest(F.col("text")) == F.col("_digest"))
    rest = choose(docs, changed).join(copies, own, "left_anti").join(spans, own, "left")
    text_at, names = docs.columns.index("text"), docs.columns
    chars = docs.schema["n_chars"].dataType if "n_chars" in names else None

    @giving_back
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, left = batch.column(text_at).to_pylist(), []
            for text, own_spans in zip(texts, batch.column(len(names)).to_pylist(), strict=True):
                cut_ = text if own_spans is None else _without(text.encode(), *_unpacked(own_spans)).decode("utf-8", "ignore")
                left.append(cut_)
            columns = [batch.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(left, batch.schema.field(text_at).type)
            is_cut = np.asarray([a is not b for a, b in zip(texts, left, strict=True)], bool)
            if chars is not None:
                at = names.index("n_chars")
                counted = pa.array([len(t or "") for t in left]).cast(columns[at].type)
                columns[at] = pa.compute.if_else(pa.array(is_cut), counted, columns[at])
            keep = [not c or bool(t) for c, t in zip(is_cut.tolist(), left, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    cut_rows = rest.select(*[F.col(f"`{n}`") for n in names], "_spans").mapInArrow(cut_out, docs.schema)
    return choose(docs, changed, inside=False).unionByName(cut_rows)
