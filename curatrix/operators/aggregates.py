"""Aggregation, deduplication and pivots. Group keys that are null are dropped
where the rule of the job says so; every aggregate combines before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions.arrays import size_or_zero
from curatrix.operators.ranking import running_total


def count_per(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key combination; rows with a null key do not count."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_matrix(
    df: DataFrame, row: str, column: str, values: Sequence[str], total: str = "total"
) -> DataFrame:
    """Counts of `column` values per `row` key, 0 where none, with the row total.

    One conditional count per value gives the matrix in a single shuffle. A value that
    is not listed ends the job, because it would be in the total and in no column.
    """
    kept = df.na.drop(subset=[row, column])
    cells = [F.count_if(F.col(column) == F.lit(v)).alias(v) for v in values]
    stray = F.max(F.when(~F.col(column).isin(*values), F.col(column)))
    listed = F.when(stray.isNull(), F.count(F.lit(1))).otherwise(
        F.raise_error(F.concat(F.lit(f"value of {column} without a column: "), stray.cast("string")))
    )
    return kept.groupBy(row).agg(*cells, listed.cast("long").alias(total))


def by_total(df: DataFrame, key: str, total: str = "total") -> DataFrame:
    """Largest total first; equal totals by key."""
    return df.orderBy(F.desc(total), F.asc(key))


def digest(c: Column | str) -> Column:
    """A key that stands for a long text; null stays null."""
    return F.sha2(c, 256)


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in `order`, which must leave no ties that matter.

    Spark limits each group to one row per task before it shuffles, so copies of a
    hot key never meet in one task. For a long text as key pass its `digest`, so that
    the shuffle carries 64 characters instead of the text.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") == 1).drop("_nth")


def last_by_key(df: DataFrame, key: str, position: str, value: str) -> DataFrame:
    """The value at the last position per key, with the position the key first had.

    Positions are expected to be unique per key.
    """
    return df.groupBy(key).agg(
        F.min(position).alias(position), F.max_by(value, position).alias(value)
    )


def value_lists(df: DataFrame, key: str, value: str, name: str, part_size: int = 1000) -> DataFrame:
    """Sorted values per key in parts of at most `part_size`; null keys are dropped.

    Most keys have the single part 0. A key with more values gets further parts, so
    no task ever holds the whole list of a hot key. Repeated values are counted
    first and written back by their count within a part.
    """
    copies = (
        df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    placed = running_total(copies, [key], [F.col(value)], F.col("_copies"), "_before")
    first_part = F.floor(F.col("_before") / part_size)
    last_part = F.floor((F.col("_before") + F.col("_copies") - 1) / part_size)
    start = F.greatest(F.col("_before"), F.col("part") * part_size)
    end = F.least(F.col("_before") + F.col("_copies"), (F.col("part") + 1) * part_size)
    pieces = placed.withColumn("part", F.explode(F.sequence(first_part, last_part))).withColumn(
        "_values", F.array_repeat(F.col(value), (end - start).cast("int"))
    )
    return pieces.groupBy(key, "part").agg(
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(value), F.col("_values")))),
                lambda s: s["_values"],
            )
        ).alias(name)
    )


def list_totals(df: DataFrame, array: str, total: str, rows: str) -> DataFrame:
    """The summed sizes of a list column and the number of rows."""
    return df.agg(
        F.coalesce(F.sum(size_or_zero(F.col(array)).cast("long")), F.lit(0)).alias(total),
        F.count(F.lit(1)).alias(rows),
    )


def count_present(df: DataFrame, column: str, name: str, rows: str) -> DataFrame:
    return df.agg(F.count(F.col(column)).alias(name), F.count(F.lit(1)).alias(rows))
