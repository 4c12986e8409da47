"""Exact Jaccard join on word shingles by partitions of the universe of tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, utf8, written
from curatrix.llm.graph import components
from curatrix.llm.idmap import choose, is_wanted, wanted_map
from curatrix.llm.sharing import KEY_BITS, SCHEMA, Blocks, shared_keys, sizes
from curatrix.llm.shingles import shingle_sets
from curatrix.llm.suffixes import refine

# Similarity 0.8 as whole numbers: two sets of sizes a and b differ in at most
# (a + b) * (1 - 0.8) / (1 + 0.8) = (a + b) / 9 tokens.
_SHARE, _OF = 80, 100
_ALONE = 3  # sets of at most so many tokens are only similar to their equals
_TOKENS = 1 << 19  # worked on at once
_SHAPE = ("band", "own_skip", "next_skip")
_FOLDED = 16  # 64-bit words of the sketch that every set has
_WIDEST = 64  # and at most of a wide one


@lru_cache(maxsize=1)
def band_tops() -> np.ndarray:
    """Largest set size of each band; similar sets are in one band or in neighbours."""
    tops = [5]
    while tops[-1] < 1 << 40:
        tops.append(tops[-1] * 5 // 4)
    return np.asarray(tops)


def most_different(size: int | np.ndarray, top: int | np.ndarray) -> int | np.ndarray:
    """Tokens in which a set of `size` and a similar one of at most `top` tokens differ."""
    return (size + np.minimum(top, size * 5 // 4)) // 9


@lru_cache(maxsize=256)
def allocation(band: int) -> tuple[int, int]:
    """Segments of a band, and how many of them also index one-deletion neighbours.

    A segment compared whole finds differences of none, one with neighbours finds
    differences of one, so a set needs `whole + 2 * with neighbours > most_different`.
    The cheapest allocation is taken: signatures sent, plus a charge for signatures of a
    single token, which unrelated sets share most. Segments that come out empty find
    nothing, so some are added until sets of the band's sizes have enough almost surely;
    for those that still have not, see `signatures`. A tenth more lets a set do without
    its dearest keys, see `without_dearest`.
    """
    tops = band_tops()
    top = int(tops[band])
    low = int(tops[band - 2]) + 1 if band >= 2 else _ALONE + 1
    best = None
    limit = int(most_different(top, top))
    for total in range(1, 2 * limit + 12):
        for near in {0, total // 2, total}:
            if total + near < limit + 1:
                continue
            enough = True
            for size in (low, top):
                empty = (1 - 1 / total) ** size
                one = size / total * (1 - 1 / total) ** max(size - 1, 0) if total > 1 else float(size == 1)
                units = total * (1 - empty) + near * (1 - empty - one)
                spread = (total * empty + near * (empty + one)) ** 0.5
                if total == 1:
                    units, spread = 1 + near, 0
                enough &= units - 3 * spread >= 1.1 * most_different(size, top) + 1
            if not enough:
                continue
            mean = top / total
            single = min(1.0, mean) * (1 - 1 / total) ** (top - 1) if total > 1 else 0.0
            cost = (total - near) + near * (1 + mean) + 4 * (total * single + 2 * near * single)
            if best is None or cost < best[0]:
                best = (cost, total, near)
        if best and total > 2 * best[1] + 8:
            break
    return (best[1], best[2]) if best else (2 * limit + 12, 2 * limit + 12)


@dataclass
class _Segments:
    """Non-empty segments of sets of sorted tokens, in one band each."""

    token_owner: np.ndarray
    weight: np.ndarray  # of each token, sorted by segment
    owner: np.ndarray  # of each segment
    name: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    near: np.ndarray  # whether one-deletion neighbours are indexed
    units: np.ndarray  # of each set
    spare: np.ndarray  # of each set: units beyond the most different similar set


def _segments(owner: np.ndarray, token: np.ndarray, sizes_: np.ndarray, alive: np.ndarray, step: int, seed: int) -> _Segments:
    chosen = alive[owner]
    who, what = owner[chosen], token[chosen]
    band = np.searchsorted(band_tops(), sizes_) + step
    total, near = np.ones(len(sizes_), np.int64), np.zeros(len(sizes_), np.int64)
    for b in np.unique(band[alive]):
        total[band == b], near[band == b] = allocation(int(b))
    mixed = refine(what, np.full(1, seed * 1_000_003 + 17, np.uint64))
    segment = ((mixed >> np.uint64(33)) % total[who].astype(np.uint64)).astype(np.int64)
    place = who * (int(total.max()) + 1) + segment
    order = np.argsort(place, kind="stable")
    place, who, segment = place[order], who[order], segment[order]
    weight = refine(what[order], np.full(1, 99, np.uint64))
    heads = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    counts = np.diff(np.append(heads, len(place)))
    head_owner, head_segment = who[heads], segment[heads]
    name = (
        (band[head_owner].astype(np.uint64) << np.uint64(40))
        | (head_segment.astype(np.uint64) << np.uint64(8))
        | np.uint64(seed & 255)
    )
    several = (head_segment < near[head_owner]) & (counts > 1)
    units = np.bincount(head_owner, 1 + several, minlength=len(sizes_)).astype(np.int64)
    spare = units - most_different(sizes_, band_tops()[band])
    return _Segments(who, weight, head_owner, name, np.add.reduceat(weight, heads), counts, several, units, spare)


def _key(sums: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Key of a segment; its two lowest bits that travel tell odd bands and later seeds."""
    low = np.uint64(64 - KEY_BITS)
    odd, later = name >> np.uint64(40) & np.uint64(1), (name & np.uint64(255) > 0).astype(np.uint64)
    plain = refine(sums, name) & ~(np.uint64(3) << low)
    return plain | odd << low | later << (low + np.uint64(1))


def signatures(owner: np.ndarray, token: np.ndarray, sizes_: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Owners and keys by which similar sets are sure to share one.

    Tokens, sorted by owner, are hashed to the segments of the set's own band and of the
    next. A segment's key is made of the sum of its tokens, so a neighbour's key is that
    sum less one token. A set whose segments are too often empty to be sure of a match is
    hashed again with another seed; a pair is found with the first seed that serves
    either of its sets.
    """
    for step in (0, 1):
        alive, seed = sizes_ > _ALONE, 0
        while alive.any():
            s = _segments(owner, token, sizes_, alive, step, seed)
            yield s.owner, _key(s.sums, s.name)
            inside = np.repeat(s.near, s.counts)
            if inside.any():
                less = np.repeat(s.sums, s.counts)[inside] - s.weight[inside]
                yield s.token_owner[inside], _key(less, np.repeat(s.name, s.counts)[inside])
            alive = alive & (s.spare < 1)
            seed += 1


def index_shape(owner: np.ndarray, token: np.ndarray, sizes_: np.ndarray) -> tuple[np.ndarray, ...]:
    """Band of each set, and the keys that it can skip of its own and of the next band.

    Each token in which two sets differ spoils one unit of the first seed's segments, and
    what is left is keys that they share: one key for each unit, or for two where
    segments are indexed with neighbours. All but one of the keys that a set must share
    with any similar set can be skipped.
    """
    alive = sizes_ > _ALONE
    out = [np.searchsorted(band_tops(), sizes_)]
    for step in (0, 1):
        skip = np.zeros(len(sizes_), np.int64)
        if alive.any():
            s = _segments(owner, token, sizes_, alive, step, 0)
            per_key = np.ones(len(sizes_), np.int64)
            per_key[np.unique(s.owner[s.near])] = 2
            skip = np.where(alive, np.maximum(0, -(-s.spare // per_key) - 1), 0)
        out.append(skip)
    return tuple(out)


def sketch_words(size: np.ndarray) -> np.ndarray:
    """Words of the sketch of a set: four bits a token, as a power of two within bounds."""
    words = 1 << np.ceil(np.log2(np.maximum(size, 1) / 16)).astype(np.int64).clip(0, 40)
    return np.clip(words, _FOLDED, _WIDEST)


def sketches(owner: np.ndarray, token: np.ndarray, sizes_: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bitmaps of each set: whether the number of its tokens in a bucket is odd.

    Two sets differ in at least as many tokens as their bitmaps of one width in bits. A
    bitmap folds to half its width by the exclusive or of its halves. Returns that of
    `_FOLDED` words, and the whole one where it is wider (else without words).
    """
    words = sketch_words(sizes_)
    folded = np.zeros((len(sizes_), _FOLDED), np.int64)
    wide: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sizes_)
    for width in np.unique(words).tolist():
        bits = 64 * width
        for some in np.array_split(rows := np.flatnonzero(words == width), -(-len(rows) * bits // (1 << 21)) or 1):
            place = np.full(len(sizes_), -1)
            place[some] = np.arange(len(some))
            mine = place[owner]
            inside = mine >= 0
            at = mine[inside] * bits + (token[inside] & np.uint64(bits - 1)).astype(np.int64)
            odd = (np.bincount(at, minlength=len(some) * bits) & 1).astype(np.uint8)
            whole = np.packbits(odd, bitorder="little").view(np.int64).reshape(len(some), width)
            if width > _FOLDED:
                for row, own in zip(some.tolist(), whole, strict=True):
                    wide[row] = own
            while whole.shape[1] > _FOLDED:
                half = whole.shape[1] // 2
                whole = whole[:, :half] ^ whole[:, half:]
            folded[some] = whole
    return folded, wide


def _bits(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda total, w: total + F.bit_count(w))


def _narrowed(wide: Column, size: Column) -> Column:
    """A wide bitmap folded once if it is wider than `size` words; similar sets need no more."""
    half = F.floor(F.size(wide) / 2).cast("int")
    folded = F.zip_with(F.slice(wide, 1, half), F.slice(wide, half + 1, half), lambda a, b: a.bitwiseXOR(b))
    return F.when(F.size(wide) > size, folded).otherwise(wide)


def may_be_similar(a: str, b: str) -> Column:
    """Whether sizes and bitmaps of two sides, by the suffix of their columns, allow the similarity."""
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    apart = F.lit(0)
    for i in range(_FOLDED):
        apart = apart + F.bit_count(F.col(f"s{i}_{a}").bitwiseXOR(F.col(f"s{i}_{b}")))
    wide_a, wide_b = F.col(f"wide_{a}"), F.col(f"wide_{b}")
    size = F.least(F.size(wide_a), F.size(wide_b))
    far = F.zip_with(_narrowed(wide_a, size), _narrowed(wide_b, size), lambda x, y: x.bitwiseXOR(y))
    # The folded bitmaps are compared first; the wide ones only of pairs that they leave.
    return (
        (_OF * n_a >= _SHARE * n_b)
        & (_OF * n_b >= _SHARE * n_a)
        & (9 * apart <= n_a + n_b)
        & ((size == 0) | (9 * _bits(far) <= n_a + n_b))
    )


_SKETCH = [f"s{i}" for i in range(_FOLDED)] + ["wide"]


def without_dearest(keys: DataFrame, sets: DataFrame) -> DataFrame:
    """`id`, `key` without the keys that most sets have, as far as each set can skip them.

    Two similar sets share more keys of a band than either skips, so the one of them that
    the fewest sets have is kept by both. Keys of later seeds are all kept.
    """
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_sets"))
    shape = sets.groupBy("id").agg(
        F.min("band").alias("band"), F.max("band").alias("other"),
        F.min("own_skip").alias("own_skip"), F.min("next_skip").alias("next_skip"),
    )
    odd, later = F.col("key").bitwiseAND(1), F.col("key").bitwiseAND(2) > 0
    skip = F.when(odd == F.col("band").bitwiseAND(1), F.col("own_skip")).otherwise(F.col("next_skip"))
    dearest = Window.partitionBy("id", "odd", "later").orderBy(F.desc("n_sets"), "key")
    return (
        keys.join(counts, "key")
        .join(shape, "id")
        .withColumns({"odd": odd, "later": later, "skip": F.when(F.col("band") == F.col("other"), skip).otherwise(0)})
        .withColumn("nth", F.row_number().over(dearest))
        .where("later or nth > skip")
        .select("id", "key")
    )


def _sets_in(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = utf8(batch.column(column))
    owner, token = shingle_sets(data, offsets)
    return owner, token, np.bincount(owner, minlength=batch.num_rows)


def _digests(owner: np.ndarray, token: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of each set that do not depend on the order of its tokens."""
    out = []
    for salt in (1, 2):
        mixed = refine(token, np.full(1, salt, np.uint64))
        total = np.zeros(count, np.uint64)
        if len(owner):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            total[owner[heads]] = np.add.reduceat(mixed, heads)
        out.append(total.view(np.int64))
    return out[0], out[1]


def set_table(docs: DataFrame) -> DataFrame:
    """`id`, size, digests and index shape of the shingle set of every text."""
    @giving_back
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, token, count = _sets_in(batch, 1)
            one, two = _digests(owner, token, batch.num_rows)
            shapes = [index_shape(*part) for _, part in _portions(owner, token, count)]
            shape = [np.concatenate(c) for c in zip(*shapes, strict=True)]
            folded, wide = sketches(owner, token, count)
            columns = [*map(pa.array, (count, one, two, *shape, *folded.T)), pa.array(wide, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n", "one", "two", *_SHAPE, *_SKETCH])

    numbers = ("id", "n", "one", "two", *_SHAPE, *_SKETCH[:-1])
    fields = ", ".join(f"{c} long" for c in numbers) + ", wide array<long>"
    return docs.select("id", "text").mapInArrow(measure, fields)


def _portions(
    owner: np.ndarray, token: np.ndarray, count: np.ndarray
) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """First row, owners, tokens and sizes of runs of sets with a bounded number of tokens."""
    bounds = np.concatenate([[0], np.cumsum(count)])
    row = 0
    while row < len(count):
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _TOKENS, side="right")) - 1)
        a, b = bounds[row], bounds[last]
        yield row, (owner[a:b] - row, token[a:b], count[row:last])
        row = last


def candidate_keys(docs: DataFrame, wanted, parts: int, partitions: int) -> DataFrame:
    """`id`, `key` of every wanted set for the keys that several sets have."""
    @giving_back
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(parts)
        for batch in batches:
            batch = batch.filter(pa.array(is_wanted(wanted, batch.column(0))))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            owner, token, count = _sets_in(batch, 1)
            for row, part in _portions(owner, token, count):
                for who, key in signatures(*part):
                    yield from blocks.add(ids[row + who], key)
        yield from blocks.flush()

    return shared_keys(docs.select("id", "text").mapInArrow(index, SCHEMA), partitions)


def verified(docs: DataFrame, pairs: DataFrame, tag: str) -> DataFrame:
    """The pairs `a`, `b` whose sets are similar, by comparing the whole sets.

    Texts travel only for ids in a pair. The partners of a much-wanted `a` are dealt over
    groups of some hundred, and its text is sent once to each group.
    """
    pairs = written(pairs, f"{tag}-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    texts = choose(docs, wanted_map(ids), "id")
    groups = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    dealt = pairs.join(groups, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / 256)).alias("deal")
    )
    first = (
        dealt.select("a", "deal").distinct().join(texts, F.col("a") == F.col("id"))
        .select("a", "deal", F.col("text").alias("text_a"))
    )
    second = dealt.join(texts, F.col("b") == F.col("id")).select("a", "deal", "b", F.col("text").alias("text_b"))

    @giving_back
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who_a, token_a, n_a = _sets_in(batch, 2)
            who_b, token_b, n_b = _sets_in(batch, 3)
            who, token = np.concatenate([who_a, who_b]), np.concatenate([token_a, token_b])
            order = np.lexsort((token, who))
            who, token = who[order], token[order]
            same = (who[1:] == who[:-1]) & (token[1:] == token[:-1])
            common = np.bincount(who[1:][same], minlength=batch.num_rows)
            similar = (_OF * common >= _SHARE * (n_a + n_b - common)) & (common > 0)
            yield batch.select([0, 1]).filter(pa.array(similar))

    return (
        first.join(second, ["a", "deal"])
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(compare, "a long, b long")
    )


def similar_components(docs: DataFrame) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of 0.8 or more.

    Returns one row per input row: `doc_id`, `n_shingles` and `component_id`, the smallest
    id reachable by links. Null and empty texts have no shingles and stay alone. Rows of
    equal sets, so also repeated rows, are one component. A null id gets a null component
    and links nothing. Columns other than `doc_id` and `text` are not read; an empty table
    gives an empty result. Ids that name several texts are compared by all of them.

    1. Equal sets are one node, named by its smallest id.
    2. Nodes that share a key (`signatures`) are candidates; no similar pair is missed.
    3. The smallest node of each key is its head. Each node is compared with the head of
       most of its keys, and linked nodes are joined.
    4. Keys whose nodes are still apart are compared across the components: every pair that
       is not joined yet, so that no link between components is missed.

    Sizes and bitmaps, which bound the difference of two sets from below, keep most pairs
    of unlike nodes from being made at all.
    """
    bounded_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where("id is not null")
    table = written(set_table(rows), "sets")
    keepers = (
        table.where("id is not null and n > 0").groupBy("one", "two", "n").agg(F.min("id").alias("keeper"))
    )
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, partitions = sizes(total)
    wanted = wanted_map(keepers.where(f"n > {_ALONE}").select("keeper"))
    size = table.where("id is not null and n > 0")
    keys = written(candidate_keys(known, wanted, parts, partitions), "keys")
    keys = written(without_dearest(keys, size), "keys")
    about = size.select(F.col("id").alias("_id"), "n", *_SKETCH).distinct()  # an id may name several texts
    heads = keys.groupBy("key").agg(F.min("id").alias("a"))
    common = keys.join(heads, "key").where("id <> a").groupBy(F.col("id").alias("b"), "a").agg(F.count(F.lit(1)).alias("keys"))
    closest = common.groupBy("b").agg(F.max_by("a", F.struct("keys", -F.col("a"))).alias("a"))
    tried = written(closest.select("a", "b"), "near")
    links = written(verified(known, tried, "near"), "links")
    labels = components(links)
    named = keys.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    apart = named.groupBy("key").agg(F.min("component").alias("main"), F.max("component").alias("other")).where("main <> other")
    open_keys = named.join(apart.select("key", "main"), "key").join(about, F.col("id") == F.col("_id")).drop("_id")
    open_keys = written(open_keys, "open")
    others, members = (
        open_keys.select(
            F.col("key").alias(f"key_{e}"), F.col("main").alias(f"main_{e}"), F.col("id").alias(e),
            F.col("component").alias(f"c{e}"), *(F.col(c).alias(f"{c}_{e}") for c in ("n", *_SKETCH)),
        )
        for e in "xy"
    )
    others = others.where("cx <> main_x")
    across = others.join(
        members,
        # Each pair once for a key: with one of the main component, or in the order of ids.
        (F.col("key_x") == F.col("key_y"))
        & F.expr("cx <> cy and (cy = main_y or x < y)")
        & may_be_similar("x", "y"),
    )
    across = across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    rest = across.join(tried, ["a", "b"], "left_anti")
    more = written(verified(known, rest, "across"), "links")
    if not more.isEmpty():
        labels = components(links.union(more))
    out = (
        table.join(keepers, ["one", "two", "n"], "left")
        .join(labels.withColumnRenamed("id", "node"), F.col("keeper") == F.col("node"), "left")
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "keeper", "id"))
    return out.select(
        F.col("id").cast(id_type).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        component.cast(id_type).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, without near duplicates: one document of each component.

    The document with the smallest id stays, once. Rows without an id stay. Only texts
    that may have to go are shuffled.
    """
    labels = written(similar_components(docs), "components")
    gone = labels.where("doc_id <> component_id").select("doc_id").distinct()
    repeated = labels.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    looked_at = wanted_map(gone.union(repeated.select("doc_id")))
    kept = choose(docs, looked_at, inside=False)
    rest = choose(docs, looked_at).join(gone, "doc_id", "left_anti")
    return kept.unionByName(rest.dropDuplicates(["doc_id", "text"]))
