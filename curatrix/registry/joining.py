"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.operators.aggregates import list_totals
from curatrix.operators.joins import (
    anti_join, companies_by_concept, count_matches, difference, left_join, shared_concepts, unnest,
)
from curatrix.plans.concepts import company_concepts
from curatrix.plans.outlets import refresh_sources
from curatrix.plans.reconcile import compare_versions
from curatrix.registry import inputs as i
from curatrix.registry.base import query


@query(
    "left_join",
    """SELECT o_orderkey, c_name
       FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders) o
       LEFT JOIN (SELECT c_name, c_custkey AS k FROM customer UNION ALL SELECT 'nobody', NULL) c
       ON o.k IS NOT DISTINCT FROM c.k""",
)
def left_join_query(t):
    """A null key of an order meets the one null key of the right side."""
    left = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    nobody = t.spark.createDataFrame([("nobody", None)], "c_name string, rk long")
    right = t.customer.select("c_name", F.col("c_custkey").alias("rk")).unionByName(nobody)
    return left_join(left, right, "k", "rk").select("o_orderkey", "c_name")


@query(
    "count_change",
    """SELECT c.nation, c.n_customers, s.n_suppliers, c.n_customers - s.n_suppliers AS change
       FROM (SELECT n_name AS nation, count(*) AS n_customers FROM customer
             JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name) c
       LEFT JOIN (SELECT n_name AS nation, count(*) AS n_suppliers FROM supplier
                  JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name) s
       ON c.nation = s.nation""",
)
def count_change(t):
    def per_nation(df, key, name):
        counted = df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
        named = counted.join(t.nation, F.col(key) == F.col("n_nationkey"))
        return named.select(F.col("n_name").alias("nation"), name)

    customers = per_nation(t.customer, "c_nationkey", "n_customers")
    suppliers = per_nation(t.supplier, "s_nationkey", "n_suppliers")
    return difference(
        left_join(customers, suppliers, "nation"), "n_customers", "n_suppliers", "change"
    )


@query(
    "left_join_count",
    """SELECT n_name AS nation, count(o_orderkey) AS n_orders
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') o ON o_custkey = c_custkey
       WHERE c_mktsegment = 'BUILDING' GROUP BY n_name""",
)
def left_join_count(t):
    companies = (
        t.customer.filter("c_mktsegment = 'BUILDING'")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("nation"))
    )
    pending = t.orders.filter("o_orderstatus = 'P'")
    return count_matches(
        companies, pending, "c_custkey", "o_custkey", "o_orderkey", "nation", "n_orders"
    )


@query(
    "anti_nullsafe",
    """SELECT doc_id, lang FROM documents d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id IS NOT DISTINCT FROM d.doc_id)""",
)
def anti_nullsafe(t):
    return anti_join(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query(
    "company_concepts",
    f"""WITH {i.CONCEPT_COMPANIES_SQL}
        SELECT id, name, CASE WHEN len(urls) > 0 THEN array_to_string(urls, '|') END AS urls
        FROM companies""",
)
def company_concepts_query(t):
    rows = company_concepts(i.concept_metadata(t), i.concept_urls(t), "index bank")
    return rows.select("id", "name", F.array_join("url_list", "|").alias("urls"))


@query(
    "list_size_totals",
    f"""WITH {i.CONCEPT_COMPANIES_SQL}
        SELECT sum(len(urls))::BIGINT AS n_urls, count(*) AS n_companies FROM companies""",
)
def list_size_totals(t):
    rows = company_concepts(i.concept_metadata(t), i.concept_urls(t), "Index Bank")
    return list_totals(rows, "url_list", "n_urls", "n_companies")


@query(
    "alias_explode",
    """SELECT id, url FROM (SELECT CAST(p_partkey AS VARCHAR) AS id, unnest(
           CASE WHEN p_size > 5 THEN [CASE WHEN p_size > 10 THEN 'c/' || p_brand END,
                                      CASE WHEN p_size > 30 THEN 'c/' || p_name END]
                ELSE [] END) AS url FROM part)""",
)
def alias_explode(t):
    return unnest(i.concept_urls(t), "concept_url", "url", "url")


@query(
    "concept_overlap",
    f"""WITH {i.WORD_COMPANIES_SQL},
        docs AS (SELECT doc_id, unnest(string_split(text, ' ')) AS uri FROM documents
                 WHERE list_has_any(string_split(text, ' '), ['the', 'of', 'und', 'la', 'el'])),
        wanted AS (SELECT company_id, unnest(urls) AS uri FROM companies)
        SELECT DISTINCT doc_id, company_id FROM docs JOIN wanted USING (uri)""",
)
def concept_overlap(t):
    companies = i.word_companies(t).withColumnRenamed("id", "company_id")
    articles = t.documents.select("doc_id", F.split("text", " ").alias("uris"))
    topics = F.array(*map(F.lit, ("the", "of", "und", "la", "el")))
    pairs = companies_by_concept(articles, companies, F.col("uris"), "company_id", "url_list", topics)
    return pairs.select("doc_id", "company_id")


@query(
    "concept_languages",
    f"""WITH {i.WORD_COMPANIES_SQL},
        docs AS (SELECT lang, unnest(string_split(text, ' ')) AS uri FROM documents),
        wanted AS (SELECT company_id, unnest(urls) AS uri FROM companies)
        SELECT DISTINCT lang, company_id FROM docs JOIN wanted USING (uri)""",
)
def concept_languages(t):
    """The same by language: many articles make one pair."""
    companies = i.word_companies(t).withColumnRenamed("id", "company_id")
    return shared_concepts(t.documents, companies, ["lang"], F.split("text", " "), "company_id", "url_list")


@query(
    "source_refresh",
    """WITH outlets AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host,
                              regexp_extract(url, '([^./]+)\\.example\\.(com|net|org)', 1) AS label, url
                       FROM pages),
       ids AS (SELECT DISTINCT label FROM outlets WHERE starts_with(url, 'https:'))
       SELECT page_id AS ranking, host AS domain_name,
              CASE WHEN i.label IS NULL THEN '' ELSE 'uri/' || i.label END AS source_uri,
              CASE WHEN i.label IS NULL THEN 1 ELSE 0 END AS missing
       FROM outlets o LEFT JOIN ids i ON o.label = i.label""",
)
def source_refresh(t):
    rows = refresh_sources(i.outlets(t), i.source_ids(t), i.test_suffix_rules(t))
    return rows.select(
        F.col("ranking").cast("long").alias("ranking"), "domain_name",
        F.col("eventregistry_sourceuri").alias("source_uri"),
        F.col("flag_missing_uri").alias("missing"),
    )


@query(
    "union_all",
    """SELECT doc_id, lang FROM documents WHERE n_chars < 1000
       UNION ALL SELECT doc_id, lang FROM documents WHERE n_chars >= 500""",
)
def union_all(t):
    short = t.documents.filter("n_chars < 1000").select("doc_id", "lang")
    long = t.documents.filter("n_chars >= 500").select("lang", "doc_id")
    return short.unionByName(long)


SIDES_SQL = """
    versions AS (
        SELECT CASE source WHEN 'src3' THEN NULL WHEN 'src5' THEN 'old/' || md5(text) ELSE md5(text) END AS k, 1 AS side
        FROM documents
        UNION ALL SELECT CASE lang WHEN 'es' THEN NULL WHEN 'de' THEN 'new/' || md5(text) ELSE md5(text) END, 2
        FROM documents
    )"""


@query(
    "reconcile_both_ways",
    f"""WITH {SIDES_SQL}
        SELECT k, count(*) FILTER (side = 1) AS n_old, count(*) FILTER (side = 2) AS n_new,
               CASE bit_or(side) WHEN 1 THEN 'old' WHEN 2 THEN 'new' ELSE 'both' END AS side
        FROM versions GROUP BY k""",
)
def reconcile_both_ways(t):
    """Two overlapping versions with null and repeated keys, in one pass."""
    digest = F.md5("text")
    old = F.when(F.col("source") == "src5", F.concat(F.lit("old/"), digest)).when(F.col("source") != "src3", digest)
    new = F.when(F.col("lang") == "de", F.concat(F.lit("new/"), digest)).when(F.col("lang") != "es", digest)
    return compare_versions(t.documents.select(old.alias("k")), t.documents.select(new.alias("k")), "k")
