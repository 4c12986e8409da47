"""Exact centroid clustering with bounds from an n-simplex projection."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import bounded_batches, giving_back, written

PIVOTS = 5
_MOST = 1 << 27  # largest size of a component: squared distances then stay inside a long
_FLAT = 1e-3  # a pivot lower than this part of the widest distance adds nothing to the simplex


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to one point."""
    apart = rows - point
    return np.einsum("ij,ij->i", apart, apart)


class Simplex:
    """Pivots with the base simplex that their distances span.

    A vector's squared distances to the pivots give it an apex: coordinates inside the
    base, and its height above it. The distance of two apexes on the same side of the base
    is at most that of the vectors, on opposite sides at least.
    """

    def __init__(self, candidates: np.ndarray, most: int) -> None:
        chosen, base = [0], np.zeros((0, 0))
        apart = np.stack([squared(candidates, c) for c in candidates]).astype(float)
        widest = apart.max(initial=0)
        while len(chosen) < min(most, len(candidates)):
            self.pivots, self._base = candidates[chosen], base
            heights = self.apexes(apart[:, chosen])[:, -1]
            best = int(np.argmax(heights))
            if heights[best] ** 2 <= _FLAT * widest:
                break
            row = self.apexes(apart[[best]][:, chosen])[0]
            n = len(base)
            grown = np.zeros((n + 1, n + 1))
            grown[:n, :n], grown[n] = base, row
            chosen, base = [*chosen, best], grown
        self.pivots, self._base = candidates[chosen], base

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """Coordinates by row, the height last, from squared distances to the pivots."""
        if not len(self._base):
            return np.sqrt(distances[:, :1])
        sizes = np.einsum("ij,ij->i", self._base, self._base)
        inside = np.linalg.solve(self._base, (distances[:, :1] + sizes - distances[:, 1:]).T / 2).T
        height = np.sqrt(np.maximum(distances[:, 0] - np.einsum("ij,ij->i", inside, inside), 0))
        return np.column_stack([inside, height])

    def project(self, rows: np.ndarray) -> np.ndarray:
        return self.apexes(np.column_stack([squared(rows, p) for p in self.pivots]).astype(float))


def possible(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centres may be nearest, by apexes: lower bound not above the least upper bound.

    Bounds are floating point; the slack is far above their error, so that no nearest
    centre is lost. What is let through is compared exactly.
    """
    inside = ((rows[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
    low = inside + (rows[:, None, -1] - centres[None, :, -1]) ** 2
    high = inside + (rows[:, None, -1] + centres[None, :, -1]) ** 2
    slack = 1e-6 * (1 + (rows**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1).max())
    return low <= high.min(axis=1, keepdims=True) + slack


def assign(rows: np.ndarray, apexes: np.ndarray, centres: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each row (ties: the smaller number) and its exact squared distance."""
    maybe = possible(apexes, tops)
    cluster = np.full(len(rows), -1)
    nearest = np.full(len(rows), np.iinfo(np.int64).max)
    for j, centre in enumerate(centres):
        at = np.flatnonzero(maybe[:, j])
        distance = squared(rows[at], centre)
        closer = distance < nearest[at]
        cluster[at[closer]], nearest[at[closer]] = j, distance[closer]
    return cluster, nearest


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """`id` and `v`, the components as `floor(scale * x)`, of vectors of `width` finite components."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where((F.size(vector_col) == width) & finite).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
    )


def _block(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, width)


def _batches(batches: Iterator[pa.RecordBatch], width: int, tall: int) -> Iterator[tuple]:
    for batch in batches:
        if batch.num_rows:
            yield batch.column(0), _block(batch, 1, width).astype(np.int64), _block(batch, 2, tall)


def _sums(table: DataFrame, state, width: int) -> DataFrame:
    """Per cluster the sums of components (by place), the count (-1) and the distance (-2).

    Each task adds up its own rows, so a cluster of any size gives it `width + 2` rows.
    """
    @giving_back
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, tops = state.value
        total = np.zeros((len(centres), width + 2), np.int64)
        for _, rows, apexes in _batches(batches, width, tops.shape[1]):
            cluster, distance = assign(rows, apexes, centres, tops)
            for j in range(len(centres)):
                mine = cluster == j
                total[j, :width] += rows[mine].sum(axis=0)
                total[j, -2] += distance[mine].sum()
                total[j, -1] += mine.sum()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(centres), dtype=np.int32), width + 2)),
                pa.array(np.tile(np.concatenate([np.arange(width), [-2, -1]]).astype(np.int32), len(centres))),
                pa.array(total.ravel()),
            ],
            names=["cluster", "place", "total"],
        )

    found = table.mapInArrow(add, "cluster int, place int, total long")
    return found.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    pivots: int = PIVOTS,
    seed: str = "3",
    width: int = 64,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """`vec_id`, `cluster`, `distance`, `cluster_inertia`, `inertia`, `centroid_sha256` by row.

    Vectors of `width` components, none null or not finite, become whole numbers
    `floor(scale * x)`; all others are left out. The `k` of them (all, if fewer) with the
    smallest SHA-256 of `<seed>:<id>` start as centres; equal ids go by their components,
    rows without an id come last. Each round gives every vector to the nearest centre by
    exact squared distance (ties: smaller number) and replaces each centre that has
    vectors by the floor of their mean; a last pass assigns them once more. Repeated rows
    count each. An empty table gives an empty result. A component of 2^27 or more ends
    the job, because squared distances would not fit into a long.

    Distances to a few of the starting vectors are taken once and kept as apex
    coordinates; they bound the distance to each centre from both sides, and only
    centres that may be nearest are compared exactly. The driver holds `k` centres; every
    round it gets `k * (width + 2)` sums.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    kept = whole_vectors(vectors, id_col, vector_col, width, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    starts = kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    schema = f"{id_col} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not starts:
        return spark.createDataFrame([], schema)
    centres = np.asarray([r["v"] for r in starts], np.int64)
    _in_range(centres)
    simplex = Simplex(centres, pivots)

    @giving_back
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _block(batch, 1, width)
            _in_range(rows)
            tops = simplex.project(rows)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.ListArray.from_arrays(pa.array(ends * width), pa.array(rows.astype(np.int32).ravel())),
                    pa.ListArray.from_arrays(pa.array(ends * tops.shape[1]), pa.array(tops.ravel())),
                ],
                names=["id", "v", "apex"],
            )

    table = written(kept.mapInArrow(project, "id long, v array<int>, apex array<double>"), "apexes")

    def shared(points: np.ndarray):
        return spark.sparkContext.broadcast((points, simplex.project(points)))

    for _ in range(rounds):
        moved = centres.copy()
        sums = _grid(_sums(table, shared(centres), width), len(centres), width)
        for j, row in enumerate(sums):
            if row[-1]:
                moved[j] = [int(s) // int(row[-1]) for s in row[:width]]
        if (moved == centres).all():
            break  # further rounds would change nothing
        centres = moved

    state = shared(centres)
    last = _grid(_sums(table, state, width), len(centres), width)
    inertia = [int(row[-2]) for row in last]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]

    @giving_back
    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, tops = state.value
        for ids, rows, apexes in _batches(batches, width, tops.shape[1]):
            mine, distance = assign(rows, apexes, points, tops)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(mine.astype(np.int32)),
                    pa.array(distance),
                    pa.array(np.asarray(inertia, np.int64)[mine]),
                    pa.array(np.full(len(mine), sum(inertia), np.int64)),
                    pa.array(digests).take(pa.array(mine)),
                ],
                names=[id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
            )

    return table.mapInArrow(tell, schema)


def _in_range(rows: np.ndarray) -> None:
    if rows.size and (rows.max() >= _MOST or rows.min() <= -_MOST):
        raise ValueError("a scaled component is 2^27 or more; squared distances would not fit into a long")


def _grid(sums: DataFrame, k: int, width: int) -> list[list[int]]:
    """Sums by cluster; the distance is the last but one, the count the last."""
    out = [[0] * (width + 2) for _ in range(k)]
    for row in sums.collect():  # k * (width + 2) rows
        out[row["cluster"]][row["place"]] = int(row["total"])
    return out


def oracle(k: int = 8, rounds: int = 10, seed: str = "3", width: int = 64, scale: int = 1024) -> str:
    """The same clustering in plain SQL: every distance, round by round."""
    distance = "CAST(list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"
    parts = [
        f"""kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
                   row_number() OVER () AS r
            FROM embeddings
            WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS cluster, v
            FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k})
        )""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} AS MATERIALIZED (
            SELECT vec_id, r, v, cluster, distance FROM (
                SELECT kept.*, c.cluster, {distance} AS distance FROM kept, c{i} c
            ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, cluster) = 1
        )"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} AS MATERIALIZED (
            SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM (
                SELECT cluster, place, sum(x) AS s, count(*) AS n
                FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM a{i})
                GROUP BY cluster, place
            ) GROUP BY cluster
        ), c{i + 1} AS MATERIALIZED (SELECT cluster, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (cluster))"""
            )
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} c USING (cluster)"""
