"""A map of wanted ids of fixed size, to leave most texts out of a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import giving_back

_BITS = 26


def wanted_map(ids: DataFrame):
    """A broadcast map of the values of the only column of `ids`: 2^26 bits, however many there are.

    It may let other ids through (all, if there are very many) but stops none that is wanted.
    """
    spark = ids.sparkSession
    place = F.pmod(F.col(ids.columns[0]).cast("long"), F.lit(1 << _BITS))
    rows = (
        ids.select(place.alias("p"))
        .where("p is not null")
        .groupBy(F.expr("bitmap_bucket_number(p)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("bits"))
        .collect()  # at most 2^26 / 32768 + 1 rows of 4 KB
    )
    bits = np.zeros((((1 << _BITS) >> 15) + 2) * 4096, np.uint8)
    for row in rows:
        bits[row["bucket"] * 4096 : (row["bucket"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(bits)


def is_wanted(wanted, ids: pa.Array) -> np.ndarray:
    """Whether the map lets each id through; a null id is not wanted."""
    numbers = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    place = numbers % (1 << _BITS)
    # Buckets count from 1 and start after place 0, which has bucket 0 to itself.
    bucket = np.where(place > 0, 1 + (place - 1) // 32768, 0)
    position = np.where(place > 0, (place - 1) % 32768, 0)
    bit = wanted.value[bucket * 4096 + position // 8] >> (position % 8).astype(np.uint8) & 1
    return (bit == 1) & ~np.asarray(ids.is_null())


def choose(docs: DataFrame, wanted, id_col: str = "doc_id", inside: bool = True) -> DataFrame:
    """The rows whose id the map lets through, or the others; columns stay as they are."""
    @giving_back
    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            through = is_wanted(wanted, batch.column(batch.schema.get_field_index(id_col)))
            yield batch.filter(pa.array(through == inside))

    return docs.mapInArrow(filtered, docs.schema)
