"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """`id` and `component` (smallest id reachable) of every end of the links `a`, `b`.

    Labels move to smaller neighbours and then jump to their label's label, so the rounds
    grow with the logarithm of a chain's length. Each round is written to the shared
    folder, which cuts the lineage; the driver sees one sum for each round.
    """
    both = written(
        links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links"
    )
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels"
    )
    before = None
    while True:
        total = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if total is None or total == before:
            return labels
        before = total
        near = (
            both.join(labels, F.col("b") == F.col("id"))
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        moved = labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.least("component", "near").alias("component")
        )
        moved = written(moved, "labels")
        jump = moved.select(F.col("id").alias("_id"), F.col("component").alias("further"))
        labels = written(
            moved.join(jump, F.col("component") == F.col("_id"), "left").select(
                "id", F.coalesce("further", "component").alias("component")
            ),
            "labels",
        )
