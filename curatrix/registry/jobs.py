"""The composed jobs."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from curatrix.plans import counts, events, inventory, outlets, reconcile
from curatrix.plans.articles import relevance, summaries
from curatrix.plans.concepts import company_concepts, concept_articles
from curatrix.plans.mentions import article_texts, linked_articles, mentions
from curatrix.registry import inputs as i
from curatrix.registry.base import query
from curatrix.registry.counting import INDEX_RANK_SQL, NAMING_SQL
from curatrix.registry.reading import EXPORT_SQL, LIVE_SQL, given_tables_inventory, live_inventory
from curatrix.registry.texts import (
    CUES, HITS_SQL, ODDS_SQL, RARITY_SQL, RULE_SQL, RULE_TERMS, odds_scorer,
)
from curatrix.session import shared_dir
from curatrix.sinks.tables import write_csv
from curatrix.sources.files import scan_csv


@query(
    "job_events_raw",
    f"WITH {i.EVENTS_RAW_SQL} SELECT name, date, company_id, event FROM raw",
)
def job_events_raw(t):
    return events.events_raw(i.calendar_pages(t), i.calendar_links(t))


@query(
    "job_events_rejects",
    """SELECT 'https://cal.example/' || o_custkey || '/' || o_orderkey AS url, 'Q1 2025' AS date,
              CASE o_orderstatus WHEN 'F' THEN 'Pre-market Q1 Release (Projected)'
                   WHEN 'P' THEN 'Annual DIVIDEND payment'
                   ELSE 'Meeting ' || o_orderpriority END AS event
       FROM orders WHERE o_totalprice < 5000 AND o_orderpriority <> '5-LOW'""",
)
def job_events_rejects(t):
    return events.events_and_rejects(i.calendar_pages(t), i.calendar_links(t))[1]


@query(
    "job_events_curated",
    f"""WITH {i.EVENTS_RAW_SQL}
        SELECT date, trim(replace(replace(replace(event, 'Release', 'Call'), '(Projected)', ''),
                     'Pre-market', '')) AS event, name
        FROM raw WHERE NOT contains(lower(event), 'dividend')""",
)
def job_events_curated(t):
    return events.events_curated(job_events_raw(t))


@query(
    "job_mentions",
    f"""WITH {i.ALIASES_SQL}, texts AS ({i.ARTICLE_TEXT_SQL}),
        hits AS (SELECT link, string_agg(DISTINCT company, '|' ORDER BY company) AS mentions
                 FROM texts JOIN aliases ON contains(content, alias) AND alias <> '' GROUP BY link)
        SELECT t.link, md5(content) AS content_md5, coalesce(mentions, '') AS mentions
        FROM texts t LEFT JOIN hits h ON t.link = h.link""",
)
def job_mentions(t):
    texts = article_texts(i.article_pages(t), drop_ids=("about-us",), drop_heading="OUR TEAM")
    found = mentions(texts, i.alias_companies(t))
    return found.select(
        "link", F.md5("content").alias("content_md5"), F.array_join("banks_mentioned", "|").alias("mentions")
    )


@query(
    "job_article_links",
    f"""WITH texts AS ({i.ARTICLE_TEXT_SQL})
        SELECT replace(t.link, '/a/', 'https://brief.example/all/') AS link,
               CASE WHEN NOT ends_with(t.link, '7') THEN md5(content) END AS content_md5
        FROM texts t JOIN documents d ON t.link = '/a/' || d.doc_id WHERE lang <> 'es'""",
)
def job_article_links(t):
    """From index pages over their links to the texts of the stored articles."""
    read = linked_articles(
        i.index_pages(t), i.stored_articles(t), i.ARTICLE_CLASS, i.ARTICLE_BASE, position="fetched",
        drop_ids=("about-us",), drop_heading="OUR TEAM",
    )
    return read.select("link", F.md5("content").alias("content_md5"))


def missing_papers(t):
    return reconcile.missing_from_new(
        i.old_papers(t), i.new_papers(t), i.qa_papers(t), old_order=["doc_id"], qa_order=["doc_id"]
    )


@query(
    "job_reconcile_missing",
    f"""WITH {i.MISSING_SQL} SELECT company_name, paper_url, authors, title, md5(description) AS description, excluded_tags,
        author_name, array_to_string(reasons, '|') AS exclusion_reason FROM missing""",
)
def job_reconcile_missing(t):
    rows = missing_papers(t).withColumn("description", F.md5("description"))
    return rows.withColumn("exclusion_reason", F.array_join("exclusion_reason", "|"))


@query(
    "job_reconcile_added",
    f"""WITH {i.PAPERS_SQL}
        SELECT f.paper_url, f.paper_title, md5(f.paper_description) AS description_md5, q.publication_date,
               CASE WHEN q.url IS NOT NULL THEN coalesce(q.tags, '[]') END AS tags,
               CASE WHEN q.url IS NOT NULL THEN coalesce(q.excluded_tags, '[]') END AS excluded_tags,
               q.keyword_tags
        FROM fresh f LEFT JOIN qa q ON f.paper_url = q.url
        WHERE f.company_name IN ('src1', 'src2', 'src3')
          AND f.paper_url NOT IN (SELECT CASE WHEN company_name IN ('src4', 'src5') THEN paper_url
                                              ELSE 'moved/' || paper_url END FROM old)""",
)
def job_reconcile_added(t):
    # Papers of other companies are known by an address that has changed since.
    moved = F.when(F.col("company_name").isin("src4", "src5"), F.col("paper_url")).otherwise(
        F.concat(F.lit("moved/"), "paper_url")
    )
    old = i.old_papers(t).withColumn("paper_url", moved)
    rows = reconcile.added_in_new(old, i.new_papers(t), i.qa_papers(t), ("src1", "src2", "src3"))
    return rows.withColumn("description_md5", F.md5("paper_description")).drop("paper_description")


@query(
    "job_reconcile_both",
    f"""WITH {i.MISSING_SQL},
        added AS (SELECT f.paper_url, q.keyword_tags FROM fresh f LEFT JOIN qa q ON f.paper_url = q.url
                  WHERE f.company_name IN ('src1', 'src2', 'src3') AND f.paper_url NOT IN (SELECT paper_url FROM old))
        SELECT 'missing' AS direction, paper_url, array_to_string(reasons, '|') AS detail FROM missing
        UNION ALL SELECT 'added', paper_url, keyword_tags FROM added""".replace(
        "old AS (SELECT md5(text)", "old AS (SELECT CASE WHEN source = 'src3' THEN 'gone/' ELSE '' END || md5(text)"
    ),
)
def job_reconcile_both(t):
    """Both directions from one comparison of the urls; one company's old urls have all changed."""
    old = i.old_papers(t)
    gone = F.when(F.col("company_name") == "src3", "gone/").otherwise("")
    old = old.withColumn("paper_url", F.concat(gone, "paper_url"))
    _, missing, added = reconcile.reconcile(
        old, i.new_papers(t), i.qa_papers(t), ("src1", "src2", "src3"), old_order=["doc_id"], qa_order=["doc_id"]
    )
    found = missing.select(
        F.lit("missing").alias("direction"), "paper_url", F.array_join("exclusion_reason", "|").alias("detail")
    )
    return found.unionByName(added.select(F.lit("added").alias("direction"), "paper_url", F.col("keyword_tags").alias("detail")))


def _matrix_sql(source: str) -> str:
    cells = ", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in reconcile.REASONS)
    return f"""WITH {i.MISSING_SQL}
        SELECT company_name, {cells}, count(*) AS total
        FROM (SELECT company_name, {source} AS reason FROM missing)
        WHERE company_name <> 'src7' GROUP BY company_name"""


@query("job_exclusion_matrix", _matrix_sql("unnest(reasons)"))
def job_exclusion_matrix(t):
    return reconcile.exclusion_matrix(missing_papers(t), drop_company="src7")


@query(
    "job_exclusion_combinations",
    f"""WITH {i.MISSING_SQL}
        SELECT company_name, coalesce(nullif(array_to_string(reasons, '|'), ''), 'none') AS exclusion_reason,
               count(*) AS count
        FROM missing GROUP BY 1, 2""",
)
def job_exclusion_combinations(t):
    """The second mode, from reasons that went through a CSV file as text."""
    rows = missing_papers(t).select("company_name", "paper_url", "exclusion_reason")
    path = write_csv(rows, shared_dir(t.spark, "combinations"))
    from curatrix.registry.reading import PAPER_ROW

    return reconcile.reason_counts(scan_csv(t.spark, path, PAPER_ROW), per_combination=True)


def _combination_sql() -> str:
    cells = ", ".join(f"count_if(reason = '{c}') AS \"{c}\"" for c in reconcile.all_combinations())
    return f"""WITH {i.MISSING_SQL},
        rows AS (SELECT company_name, coalesce(nullif(array_to_string(reasons, '|'), ''), 'none') AS reason FROM missing)
        SELECT company_name, {cells}, count(*) AS total FROM rows
        WHERE company_name IS NOT NULL AND company_name <> 'src7' GROUP BY company_name"""


@query("job_exclusion_matrix_combinations", _combination_sql())
def job_exclusion_matrix_combinations(t):
    return reconcile.exclusion_matrix(missing_papers(t), per_combination=True, drop_company="src7")


@query(
    "job_relevance",
    f"""WITH {i.MISSING_SQL}
        SELECT paper_url, md5(description) AS body_md5, {RULE_SQL} AS relevance
        FROM (SELECT *, {HITS_SQL.format("coalesce(description, '')")} AS hits FROM missing
              WHERE company_name IN ('src1', 'src2'))""",
)
def job_relevance(t):
    """Labels by rule of the papers that two companies lack in the new version."""
    labelled = relevance(missing_papers(t), ("src1", "src2"), RULE_TERMS)
    return labelled.select("paper_url", F.md5("body").alias("body_md5"), "relevance")


@query(
    "job_relevance_fitted",
    f"""WITH {i.MISSING_SQL}, {ODDS_SQL}
        SELECT DISTINCT m.paper_url, md5(m.description) AS body_md5, coalesce(l.relevance, 'Unsure') AS relevance
        FROM missing m LEFT JOIN documents d ON m.description = d.text LEFT JOIN labelled l ON d.doc_id = l.doc_id
        WHERE m.company_name IN ('src1', 'src2')""",
)
def job_relevance_fitted(t):
    """The same papers by the fitted scorer; what it cannot tell within its error rate is `Unsure`."""
    labelled = relevance(missing_papers(t), ("src1", "src2"), model=odds_scorer(t))
    return labelled.select("paper_url", F.md5("body").alias("body_md5"), "relevance")


@query(
    "job_count_change",
    f"""WITH {i.PATENTS_SQL},
        new AS (SELECT ids.company, count(p.url) AS n FROM ids LEFT JOIN patents p ON ids.id = p.company_id
                WHERE ids.sector = 'building' GROUP BY ids.company)
        SELECT new.company, n AS new_count, v2024 AS index_count, n - v2024 AS change
        FROM new LEFT JOIN published ON new.company = published.company""",
)
def job_count_change(t):
    index = counts.published_index(t.spark, i.published_file(t))
    changed = counts.count_change(i.company_ids(t), i.patents(t), index, sector="building")
    return changed.toDF("company", "new_count", "index_count", "change")


@query(
    "job_index_ranks",
    INDEX_RANK_SQL.replace(
        "c_name AS company", "CASE WHEN c_acctbal > 0 THEN c_name ELSE 'Former ' || c_name END AS company"
    ).replace("GROUP BY c_mktsegment, c_name", "GROUP BY ALL"),
)
def job_index_ranks(t):
    ranked = counts.published_ranks(counts.published_index(t.spark, i.published_file(t)))
    return ranked.withColumnsRenamed(
        {
            "Company": "company",
            "Indicator Code": "indicator",
            "2023 Index Patent Count": "previous",
            "2024 Index Patent Count": "current",
        }
    )


@query(
    "job_source_refresh",
    """WITH o AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host,
                         regexp_extract(url, '([^./]+)\\.example\\.(com|net|org)', 1) AS label, url FROM pages),
       ids AS (SELECT DISTINCT label FROM o WHERE starts_with(url, 'https:'))
       SELECT 'example' AS domain_name_root, host AS domain_name, starts_with(url, 'https') AS is_top_tier,
              CAST(page_id AS VARCHAR) AS company_id, coalesce('uri/' || ids.label, '') AS eventregistry_sourceuri,
              CASE WHEN ids.label IS NULL THEN 1 ELSE 0 END AS flag_missing_uri
       FROM o LEFT JOIN ids ON o.label = ids.label""",
)
def job_source_refresh(t):
    from curatrix.sinks.tables import write_table
    from curatrix.sources.tables import scan_table

    rows = outlets.refresh_sources(i.outlets(t), i.source_ids(t), i.test_suffix_rules(t))
    path = write_table(rows, shared_dir(t.spark, "outlets"))
    return scan_table(t.spark, path).select(
        "domain_name_root", "domain_name", "is_top_tier", "company_id", "eventregistry_sourceuri",
        "flag_missing_uri",
    )


@query(
    "job_concept_articles",
    f"""WITH {i.CONCEPT_ARTICLES_SQL}, {i.WORD_COMPANIES_SQL},
        uses AS (SELECT url, dateTimePub, data_type, unnest(uris) AS uri FROM articles
                 WHERE date BETWEEN DATE '2024-01-15' AND DATE '2024-11-30' AND lang = 'eng'
                 AND data_type IN ('news', 'pr') AND list_has_any(uris, ['the', 'of'])),
        wanted AS (SELECT company_id, unnest(urls) AS uri FROM companies)
        SELECT DISTINCT url, company_id, data_type, 'Index Bank' AS sector,
               '2024-12-01T00:00:00.000000+00:00' AS run_datetime,
               substring(sha1(dateTimePub || '_' || url), 1, 10) AS temp_id,
               sha256('=' || company_id || chr(31) || '=' || url || chr(31) || '=' || dateTimePub) AS article_id
        FROM uses JOIN wanted USING (uri)""",
)
def job_concept_articles(t):
    words = i.word_companies(t)
    metadata = words.select(
        "id", F.col("id").alias("name"), F.lit(None).cast("string").alias("additional_names"),
        F.lit("bank").alias("company_type"), F.lit("INDEX bank").alias("internal_classification"),
    )
    urls = words.select(
        "id", F.transform("url_list", lambda u: F.struct(u.alias("url"))).alias("concept_url")
    )
    companies = company_concepts(metadata, urls, "Index Bank")
    stamped = concept_articles(
        i.concept_articles(t), companies, "2024-01-15", "2024-11-30", "Index Bank",
        F.expr("timestamp'2024-12-01 00:00:00'"), topics=("the", "of"),
    )
    return stamped.select("url", "company_id", "data_type", "sector", "run_datetime", "temp_id", "article_id")


@query(
    "job_summarise",
    f"""WITH {RARITY_SQL}
        SELECT 'http://' || source || '.example/' || d.doc_id AS url, split_part(text, chr(10), 1) AS title,
               md5(text) AS body_md5, source AS source_name,
               '2024-01-' || lpad(CAST(1 + n_chars % 28 AS VARCHAR), 2, '0') AS date_published,
               lang AS pillar, summary
        FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id""",
)
def job_summarise(t):
    rows = summaries(i.article_input(t), cues=CUES)
    return rows.withColumn("body_md5", F.md5("body")).drop("body")


@query(
    "job_naming_audit",
    f"""{NAMING_SQL}
        SELECT level, item, chr(10) || item AS line FROM failed
        UNION ALL SELECT 'dataset', 'none', 'none' WHERE NOT EXISTS (SELECT 1 FROM failed WHERE level = 'dataset')
        UNION ALL SELECT 'table', 'All passing', 'All passing'
        WHERE NOT EXISTS (SELECT 1 FROM failed WHERE level = 'table')""",
)
def job_naming_audit(t):
    return inventory.naming_audit(i.order_inventory(t))


@query(
    "job_naming_by_project",
    f"""{NAMING_SQL.replace("SELECT * FROM inventory", "SELECT *, 'p-' || (o_key % 50) AS project FROM inventory")
                   .replace("SELECT DISTINCT 'dataset' AS level", "SELECT DISTINCT project, 'dataset' AS level")
                   .replace("SELECT 'table',", "SELECT project, 'table',")
                   .replace("SELECT CASE WHEN o_orderpriority = '1-URGENT'", "SELECT o_custkey AS o_key, CASE WHEN o_orderpriority = '1-URGENT'")},
        projects AS (SELECT DISTINCT 'p-' || (o_custkey % 50) AS project FROM orders)
        SELECT project, level, item, chr(10) || item AS line FROM failed
        UNION ALL SELECT project, 'dataset', 'none', 'none' FROM projects
        WHERE project NOT IN (SELECT project FROM failed WHERE level = 'dataset')
        UNION ALL SELECT project, 'table', 'All passing', 'All passing' FROM projects
        WHERE project NOT IN (SELECT project FROM failed WHERE level = 'table')""",
)
def job_naming_by_project(t):
    """A report for each of many projects, some without a failure."""
    project = F.concat(F.lit("p-"), F.col("o_custkey") % 50)
    listed = i.order_inventory(t, project)
    return inventory.naming_audit(listed, by_project=True)


@query(
    "job_table_age",
    f"""WITH {i.INVENTORY_SQL},
        aged AS (SELECT dataset_id, table_id,
                        floor(epoch(TIMESTAMP '2000-01-01 00:00:00' - created) / 86400)::BIGINT AS created_days,
                        floor(epoch(TIMESTAMP '2000-01-01 00:00:00' - modified) / 86400)::BIGINT AS modified_days
                 FROM inventory)
        SELECT dataset_id, table_id, created_days AS days_since_created, modified_days AS days_since_modified,
               table_id || ' was created ' || created_days || ' days ago and last modified ' || modified_days
                   || ' days ago.' AS message
        FROM aged WHERE created_days >= 30""",
)
def job_table_age(t):
    return inventory.table_ages(i.order_inventory(t), F.expr("timestamp'2000-01-01 00:00:00'"))


@query(
    "job_table_age_live",
    f"""SELECT table_id, true AS aged, table_id || ' was created 39 days ago and last modified ' AS message
        FROM ({LIVE_SQL})""",
)
def job_table_age_live(t):
    """Ages of the live catalog's tables, forty days less a minute from now."""
    later = F.lit(datetime.now(timezone.utc) + timedelta(days=40, minutes=-1))
    ages = inventory.table_ages(live_inventory(t), later, "given")
    aged = (F.col("days_since_created") == 39) & (F.col("days_since_modified") >= 39)
    return ages.select("table_id", aged.alias("aged"), F.regexp_extract("message", r"^.* modified ", 0).alias("message"))


@query(
    "job_export",
    EXPORT_SQL.replace("given", "all").replace("'done' AS status", "'done' AS status, NULL AS error")
    + """
    UNION ALL SELECT 'all.late_orders', NULL, NULL, 'skipped',
                     'all.late_orders is a VIEW, not a base table'""",
)
def job_export(t):
    load = lambda spark, dataset, table: getattr(t, table)
    return inventory.export(given_tables_inventory(t, "all"), load, shared_dir(t.spark, "backup"))
