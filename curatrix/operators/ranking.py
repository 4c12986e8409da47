"""Ranks and positions inside groups, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.session import materialise, settle


def running_total(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], weight: Column, name: str
) -> DataFrame:
    """Add the summed `weight` of the rows before each row of its group.

    Rows are range-partitioned by group and order, so a group that fills a third of
    the table spreads over many slices. The slices are written once; each row then
    needs the sum inside its slice and the sums of the earlier slices of its group,
    of which there are at most as many as slices. Order keys must be unique within
    a group.
    """
    keys = [F.col(g) for g in group]
    sliced = df.repartitionByRange(*keys, *order).withColumn("_slice", F.spark_partition_id())
    sliced = materialise(sliced.withColumn("_weight", weight.cast("long")), "slices")
    sums = sliced.groupBy(*group, "_slice").agg(F.sum("_weight").alias("_slice_sum"))
    offsets = sums.withColumn(
        "_offset",
        F.sum("_slice_sum").over(
            Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ),
    ).drop("_slice_sum")
    inside = F.sum("_weight").over(
        Window.partitionBy(*group, "_slice")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        sliced.withColumn("_inside", inside)
        .join(offsets, [*group, "_slice"])
        .withColumn(
            name, F.coalesce(F.col("_inside"), F.lit(0)) + F.coalesce(F.col("_offset"), F.lit(0))
        )
        .drop("_inside", "_offset", "_slice", "_weight")
    )


def rank_in_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Rank by descending value; ties share the lowest rank. Null values get no rank.

    Equal values are counted first, so ranks are computed over distinct values.
    """
    levels = (
        df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_total(levels, [group], [F.col(value).desc()], F.col("_n"), "_better")
    ranked = ranked.select(group, value, (F.col("_better") + 1).alias(name))
    return df.join(ranked, [group, value], "left")


def index_ranks(df: DataFrame, group: str, entity: str, previous: str, current: str) -> DataFrame:
    """Ranks of two years, rank change, value change and the leader per indicator."""
    df = settle(df, "indicators")
    ranked = rank_in_group(df, group, previous, "rank_previous")
    ranked = rank_in_group(ranked, group, current, "rank_current")
    leaders = (
        df.filter(F.col(current).isNotNull())
        .groupBy(group, current)
        .agg(F.min(entity).alias("_entity"))
        .groupBy(group)
        .agg(
            F.max_by("_entity", current).alias("leader_name"),
            F.max(current).alias("leader_value"),
        )
    )
    return (
        ranked.join(leaders, group, "left")
        .withColumn("value_change", F.col(current) - F.col(previous))
        .withColumn("rank_change", F.col("rank_previous") - F.col("rank_current"))
    )
