"""Guards on physical plans: what must not, and what must, be in them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from curatrix.operators import aggregates as agg
from curatrix.operators import joins
from curatrix.registry import QUERIES

PYTHON_QUERIES = {
    "page_rows", "page_links", "page_text", "article_text", "mentions_scanned", "job_mentions",
    "mentions", "mentions_joined", "keyword_table_tags", "concept_overlap", "concept_languages", "job_concept_articles",
    "registered_domain", "source_refresh", "domain_suffixes", "unruled_hosts", "page_links_class", "job_article_links",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_has_a_costly_shape(name, tables):
    text = plan(QUERIES[name](tables))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A window without partition keys would gather its input in one task.
    assert not re.search(r"Window \[.*\], \[\]", text) and not re.search(r"WindowGroupLimit \[\]", text)
    uses_python = any(node in text for node in ("ArrowEvalPython", "MapInPandas", "MapInArrow", "BatchEvalPython"))
    assert not uses_python or name in PYTHON_QUERIES
    assert "BatchEvalPython" not in text


def test_keep_first_limits_groups_before_the_shuffle(tables):
    text = plan(agg.keep_first(tables.documents.select("doc_id", "text"), ["text"], ["doc_id"]))
    assert re.search(r"row_number\(\), 1, Partial", text)


def test_distinct_keys_before_the_anti_join_shuffle(tables):
    text = plan(joins.anti_join(tables.documents.select("doc_id"), tables.labels, "doc_id"))
    assert "Join" in text and "HashAggregate(keys=[_right_key" in text


def test_reconciliation_shuffles_each_input_once(tables, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["job_reconcile_missing"](tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keyed = re.findall(r"Exchange hashpartitioning\(_key", text)
    # Old, new and checked papers; the join of labels to documents is the test's own.
    assert len(keyed) == 3
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 5


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(QUERIES["age_days"](tables))
    assert "LessThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text
    assert "EqualTo(o_orderstatus,P)" in plan(QUERIES["left_join_count"](tables))


def test_matrix_is_one_shuffle(tables):
    rows = tables.orders.withColumnRenamed("o_orderpriority", "p")
    text = plan(agg.count_matrix(rows, "p", "o_orderstatus", ["F", "O", "P"]))
    assert text.count("Exchange hashpartitioning") == 1


def test_summaries_by_length_shuffle_nothing(tables):
    from curatrix.operators.summaries import summarise

    text = plan(summarise(tables.documents.select("doc_id", "text"), "text", score="length"))
    assert "hashpartitioning" not in text and "Python" not in text


@pytest.fixture
def skewed(spark):
    """Small thresholds, so that a few thousand rows count as a hot partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _hot(spark, n, key):
    """A third of the rows under one key; many map partitions, so it can be split."""
    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(0, n, 1, 16).select(value.alias(key), F.md5(F.col("id").cast("string")).alias(f"{key}_v"))


@pytest.mark.parametrize("side", ["left", "right"])
def test_hot_keys_are_split_on_either_side(skewed, side):
    big, small = _hot(skewed, 30_000, "k"), _hot(skewed, 12, "r")
    if side == "left":
        out = joins.left_join(big, small, "k", "r", hot_right=True)
    else:
        out = joins.left_join(small, big, "r", "k", hot_right=True)
    got = len(out.collect())
    assert "skew=true" in plan(out)
    # 4 small rows are hot and meet 10,000 big ones; 8 more keys occur once on each side.
    unmatched = 30_000 - 10_000 - 8 if side == "left" else 0
    assert got == 10_000 * 4 + 8 + unmatched


def test_hot_copies_shrink_before_the_shuffle(spark):
    """A third of the rows under one key: at most one row per task and key is shuffled."""
    df = _hot(spark, 30_000, "k")
    out = agg.keep_first(df, ["k"], ["k_v"])
    assert out.count() == 20_001
    counted = agg.count_per(df, ["k"])
    assert counted.filter("k = 'hot'").first()["count"] == 10_000
    assert "partial_count" in plan(counted)


def test_spread_leaves_shuffled_and_wide_frames_alone(spark, tables):
    from curatrix.session import spread

    grouped = tables.documents.groupBy("lang").count()
    assert spread(grouped) is grouped
    wide = spark.range(0, 100, 1, 64)
    assert spread(wide) is wide
    assert spread(tables.documents.select("text")).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_broadcast_needs_a_measured_size(spark):
    from curatrix.session import broadcast_if_small

    df = spark.range(100)
    assert "broadcast" in broadcast_if_small(df)._jdf.queryExecution().analyzed().toString().lower()
    assert broadcast_if_small(df, max_rows=99) is df
    assert broadcast_if_small(df, max_bytes=50) is df


def test_shared_folder_comes_from_the_session(spark):
    from curatrix.session import shared_dir

    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = shared_dir(spark, "t"), shared_dir(spark, "t")
    assert first != second
    if root:
        assert first.startswith(root)
