"""Refresh of the source ids of news outlets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.domains import with_domains
from curatrix.operators.filters import flag_and_fill
from curatrix.schemas import OUTLETS, conform
from curatrix.session import broadcast_if_small


def refresh_sources(
    outlets: DataFrame, sources: DataFrame, rules: DataFrame, by_raw_domain: bool = False
) -> DataFrame:
    """Outlets with the source id of their registered-domain label and a missing flag.

    `sources` holds `label` and `source_uri`; of several ids for a label the smallest
    counts, so the number of outlets never changes. `by_raw_domain` looks the raw domain
    up among the labels instead, which only finds bare labels. The rules travel to the
    outlets, so outlets are only moved to meet the ids, and a map of them that is small
    not even for that.
    """
    known = conform(outlets, OUTLETS).filter(F.col("domain_name").isNotNull())
    labelled = with_domains(known, "domain_name", rules, "_label")
    ids = (
        sources.filter(F.col("source_uri") != "")
        .groupBy(F.col("label").alias("_source_label"))
        .agg(F.min("source_uri").alias("eventregistry_sourceuri"))
    )
    if by_raw_domain:
        # Only labels some outlet was looked up by are in the map.
        used = labelled.select(F.col("_label").alias("_source_label")).distinct()
        ids = ids.join(used, "_source_label", "left_semi")
    probe = "domain_name" if by_raw_domain else "_label"
    joined = labelled.join(broadcast_if_small(ids), F.col(probe) == F.col("_source_label"), "left").drop(
        "_source_label", "_label"
    )
    return flag_and_fill(joined, "eventregistry_sourceuri", "flag_missing_uri")
