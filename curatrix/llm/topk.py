"""Exact top-k inner products by a three-phase uniform threshold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back

LISTS = 4  # groups of components; each gives a list of partial scores
QUERY_BLOCK = 1024  # queries looked for at once
_ROWS = 1024  # candidates scored at once
_SAFE = float(1 << 53)  # whole numbers below this are exact in a double


def scaled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """`id` and `v`, the components as whole numbers `floor(scale * x)`.

    Vectors that are null or hold a null or a component that is not finite are left out,
    and so are rows without an id.
    """
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & finite)
        .select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), max(width, int(sizes.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(offsets[0], offsets[-1])
    out[row, at - np.repeat(offsets[:-1], sizes)] = values[at]
    return out


def _partials(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Partial scores by list, query and candidate; whole numbers throughout."""
    width = max(queries.shape[1], rows.shape[1])
    q = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    r = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    top = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * max(width, 1)
    kind = np.float64 if top < _SAFE else np.int64
    parts = np.array_split(np.arange(width), LISTS)
    return np.stack([(q[:, p].astype(kind) @ r[:, p].astype(kind).T).astype(np.int64) for p in parts])


def _local_lists(table: DataFrame, queries, k: int) -> DataFrame:
    """Phase 1: the best partial scores of each list within each task, with whole scores."""
    @giving_back
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, _ = queries.value
        best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for who, rows in _rows(batches, matrix.shape[1]):
            partial = _partials(matrix, rows)
            total = partial.sum(axis=0)
            partial[:, who[None, :] == ids[:, None]] = np.iinfo(np.int64).min  # not the query itself
            few = min(k, len(who))
            chosen = np.argpartition(-partial.astype(np.float64), few - 1, axis=2)[:, :, :few]
            for part in chosen:
                query = np.repeat(np.arange(len(ids)), few)
                at = part.ravel()
                other = who[at] != ids[query]
                best.append((query[other], who[at][other], total[query[other], at[other]]))
            if sum(len(b[0]) for b in best) > 1 << 18:
                best = [_largest(*_different(*map(np.concatenate, zip(*best, strict=True))), k)]
        if best:
            query, who, score = _largest(*_different(*map(np.concatenate, zip(*best, strict=True))), k)
            yield _scores(ids[query], who, score)

    return table.mapInArrow(gather, "query_id long, vec_id long, score long")


def _different(query: np.ndarray, who: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each entry once: a candidate may stand in several lists."""
    return tuple(np.unique(np.stack([query, who, score]), axis=1))


def _largest(query: np.ndarray, who: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The `k` best candidates of each query; ties go to the smaller id."""
    order = np.lexsort((who, -score, query))
    query, who, score = query[order], who[order], score[order]
    heads = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(heads, np.diff(np.append(heads, len(query))))
    return query[rank < k], who[rank < k], score[rank < k]


def _scores(query: np.ndarray, who: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(query), pa.array(who), pa.array(score)], names=["query_id", "vec_id", "score"])


def _rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS):
            part = batch.slice(a, _ROWS)
            yield part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), width)


def _resolved(table: DataFrame, queries, cutoffs, k: int) -> DataFrame:
    """Phases 2 and 3: entries that a list has at or above its share of the cutoff, resolved.

    A candidate below the share in every list is below the cutoff in sum, so none that
    belongs to the result is left out. Those let through get their whole scores, and
    only scores that reach the cutoff leave the task, at most `k` for each query.
    """
    @giving_back
    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, times = queries.value
        cutoff = cutoffs.value
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for who, rows in _rows(batches, matrix.shape[1]):
            partial = _partials(matrix, rows)
            # Floor division keeps the share at or below an equal part of the cutoff.
            enough = (partial >= (cutoff // LISTS)[None, :, None]).any(axis=0)
            query, at = np.nonzero(enough & (who[None, :] != ids[:, None]))
            score = partial[:, query, at].sum(axis=0)
            reach = score >= cutoff[query]
            held.append((query[reach], who[at[reach]], score[reach]))
            if sum(len(h[0]) for h in held) > 1 << 18:
                held = [_largest(*map(np.concatenate, zip(*held, strict=True)), k)]
        if held:
            query, who, score = _largest(*map(np.concatenate, zip(*held, strict=True)), k)
            if len(query):
                # A query row that is repeated has each of its scores as often, up to the rank asked for.
                copies = np.repeat(np.arange(len(query)), np.minimum(times[query], k))
                yield _scores(ids[query][copies], who[copies], score[copies])

    return table.mapInArrow(resolve, "query_id long, vec_id long, score long")


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(table: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The `k` highest inner products of each query against all other rows, exactly.

    Both frames have `id` and `v` (see `scaled`). Returns `query_id`, `rank` (from 1),
    `vec_id` and `score`; ties go to the smaller id, and a query with fewer candidates
    gets all. A candidate has another id than the query. Every row counts: a repeated
    candidate can take several ranks, and an id that names several query rows has the best
    of all their scores, each as often as its row. Vectors of different lengths are compared as if the shorter ended in zeros. Empty
    tables give an empty result.

    The components are parted into four lists. Queries are asked in blocks of bounded
    size, which every task gets; the driver sees one cutoff for each query of a block.
    """
    spark = table.sparkSession
    bounded_batches(spark)
    queries = queries.groupBy("id", "v").agg(F.count(F.lit(1)).alias("times"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    out = None
    for i in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == i).orderBy("id", "v").collect()
        if not rows:
            continue
        ids = np.asarray([r["id"] for r in rows], np.int64)
        width = max(len(r["v"]) for r in rows)
        matrix = np.zeros((len(rows), max(width, LISTS)), np.int64)
        for row, r in zip(matrix, rows, strict=True):
            row[: len(r["v"])] = r["v"]
        times = np.asarray([r["times"] for r in rows], np.int64)
        shared = spark.sparkContext.broadcast((ids, matrix, times))
        # Entries of one id may come from several of its rows; each counts once, which keeps the cutoff safe.
        gathered = _ranked(_local_lists(table, shared, k).distinct(), k).groupBy("query_id").agg(
            F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n")
        )
        low = np.iinfo(np.int64).min // 2
        known = {r["query_id"]: r["cutoff"] if r["n"] == k else low for r in gathered.collect()}
        cutoffs = spark.sparkContext.broadcast(np.asarray([known.get(int(v), low) for v in ids], np.int64))
        part = _resolved(table, shared, cutoffs, k)
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _ranked(out, k).select("query_id", "rank", "vec_id", "score")
