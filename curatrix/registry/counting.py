"""Aggregation, deduplication, pivots, ranks and inventory reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.functions.arrays import labels_where
from curatrix.operators.aggregates import (
    by_total, count_matrix, count_per, count_present, digest, keep_first, last_by_key, value_lists,
)
from curatrix.operators.filters import without_key
from curatrix.operators.joins import left_join
from curatrix.operators.naming import naming_failures
from curatrix.operators.ranking import index_ranks
from curatrix.registry import inputs as i
from curatrix.registry.base import query

REASONS_SQL = """
    reasoned AS (
        SELECT lang, list_filter([
            CASE WHEN l.doc_id IS NULL THEN 'no_label' END,
            CASE WHEN quality = 0 THEN 'low_quality' END,
            CASE WHEN toxic = 1 THEN 'toxic' END,
            CASE WHEN n_chars < 200 THEN 'short' END], lambda r: r IS NOT NULL) AS reasons
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    )"""


def document_reasons(t):
    labelled = t.labels.withColumnRenamed("doc_id", "labelled")
    rows = left_join(t.documents.select("doc_id", "lang", "n_chars"), labelled.withColumn(
        "has_label", F.lit(True)), "doc_id", "labelled")
    reasons = labels_where((
        ("no_label", F.col("has_label").isNull()),
        ("low_quality", F.col("quality") == 0),
        ("toxic", F.col("toxic") == 1),
        ("short", F.col("n_chars") < 200),
    ))
    return rows.select("lang", reasons.alias("reasons"))


@query(
    "reasons_counts",
    f"""WITH {REASONS_SQL} SELECT lang, reason, count(*) AS n
        FROM (SELECT lang, unnest(reasons) AS reason FROM reasoned) GROUP BY lang, reason""",
)
def reasons_counts(t):
    rows = document_reasons(t).select("lang", F.explode("reasons").alias("reason"))
    return count_per(rows, ["lang", "reason"], "n")


@query(
    "reasons_combo",
    f"""WITH {REASONS_SQL} SELECT array_to_string(reasons, '|') AS reasons, count(*) AS n
        FROM reasoned GROUP BY 1""",
)
def reasons_combo(t):
    rows = document_reasons(t).select(F.array_join("reasons", "|").alias("reasons"))
    return count_per(rows, ["reasons"], "n")


PIVOT_SQL = """SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS "F",
       count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P",
       count(*) AS total FROM orders"""


def priority_matrix(t):
    rows = t.orders.withColumnRenamed("o_orderpriority", "priority")
    return count_matrix(rows, "priority", "o_orderstatus", ["F", "O", "P"])


@query("pivot_counts", f"{PIVOT_SQL} GROUP BY o_orderpriority ORDER BY total DESC, priority")
def pivot_counts(t):
    return by_total(priority_matrix(t), "priority")


@query(
    "pivot_excl_key",
    f"{PIVOT_SQL} WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority ORDER BY total DESC",
)
def pivot_excl_key(t):
    return by_total(without_key(priority_matrix(t), "priority", "5-LOW"), "priority")


@query(
    "alias_lists",
    """SELECT company, CAST(part AS BIGINT) AS part, string_agg(alias, '|' ORDER BY pos) AS aliases,
              count(*) AS n
       FROM (SELECT company, alias, pos, (pos - 1) // 64 AS part FROM (
           SELECT p_brand AS company, p_name AS alias,
                  row_number() OVER (PARTITION BY p_brand ORDER BY p_name) AS pos FROM part))
       GROUP BY company, part""",
)
def alias_lists(t):
    rows = t.part.select(F.col("p_brand").alias("company"), F.col("p_name").alias("alias"))
    lists = value_lists(rows, "company", "alias", "aliases", part_size=64)
    return lists.select(
        "company", "part", F.array_join("aliases", "|").alias("aliases"),
        F.size("aliases").cast("long").alias("n"),
    )


@query("distinct_values", "SELECT DISTINCT source FROM documents")
def distinct_values(t):
    return t.documents.select("source").distinct()


@query("dedup_rows", "SELECT md5(text) AS text_md5, lang FROM (SELECT DISTINCT text, lang FROM documents)")
def dedup_rows(t):
    # The digest stands for the text, so the shuffle carries no whole texts.
    return t.documents.select(F.md5("text").alias("text_md5"), "lang").dropDuplicates()


@query(
    "keep_first",
    """SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (
           PARTITION BY text ORDER BY doc_id) AS nth FROM documents) WHERE nth = 1""",
)
def keep_first_query(t):
    rows = t.documents.select("doc_id", "source", digest("text").alias("text_digest"))
    return keep_first(rows, ["text_digest"], ["doc_id"]).drop("text_digest")


@query(
    "nonnull_count",
    f"WITH {i.PATENTS_SQL} SELECT count(url) AS n_urls, count(*) AS n_rows FROM patents",
)
def nonnull_count(t):
    return count_present(i.patents(t), "url", "n_urls", "n_rows")


@query(
    "last_by_key",
    """SELECT conv_id, min(turn) AS turn, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id""",
)
def last_by_key_query(t):
    return last_by_key(t.conversations, "conv_id", "turn", "text")


INDEX_RANK_SQL = """
    WITH v AS (
        SELECT c_mktsegment AS indicator, c_name AS company,
               count(*) FILTER (o_orderstatus = 'F') AS previous,
               count(*) FILTER (o_orderstatus = 'O') AS current
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment, c_name
    )
    SELECT *, rank_previous - rank_current AS rank_change, current - previous AS value_change FROM (
        SELECT indicator, company, previous, current,
               rank() OVER (PARTITION BY indicator ORDER BY previous DESC) AS rank_previous,
               rank() OVER (PARTITION BY indicator ORDER BY current DESC) AS rank_current,
               first_value(company) OVER (PARTITION BY indicator ORDER BY current DESC, company)
                   AS leader_name,
               max(current) OVER (PARTITION BY indicator) AS leader_value
        FROM v)"""


@query("index_rank", INDEX_RANK_SQL)
def index_rank(t):
    status = F.col("o_orderstatus")
    counts = t.orders.groupBy("o_custkey").agg(
        F.count_if(status == "F").alias("previous"), F.count_if(status == "O").alias("current")
    )
    values = t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("c_mktsegment").alias("indicator"), F.col("c_name").alias("company"), "previous", "current"
    )
    return index_ranks(values, "indicator", "company", "previous", "current")


@query("head_n", "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5")
def head_n(t):
    return t.documents.select("doc_id", "lang", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(5)


NAMING_SQL = f"""
    WITH {i.INVENTORY_SQL},
    checked AS (SELECT * FROM inventory
                WHERE dataset_id <> 'curated_hubspot' AND NOT starts_with(dataset_id, 'product_index')),
    failed AS (
        SELECT DISTINCT 'dataset' AS level, dataset_id AS item FROM checked
        WHERE NOT regexp_matches(dataset_id, '^(raw_|curated_|product_|temporary)')
        UNION ALL
        SELECT 'table', dataset_id || '.' || table_id FROM checked
        WHERE NOT regexp_matches(table_id, '^(insurance_|banking_|payments_|omni_)')
    )"""


@query("naming_audit", f"{NAMING_SQL} SELECT level, item FROM failed")
def naming_audit(t):
    return naming_failures(i.order_inventory(t))
