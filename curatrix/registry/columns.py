"""Projection, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.functions import dates, text
from curatrix.functions.arrays import parse_list_text, size_or_zero
from curatrix.operators.filters import aged, marker_to_null, search_articles
from curatrix.operators.pages import split_row
from curatrix.plans.concepts import stamp
from curatrix.registry import inputs as i
from curatrix.registry.base import query


@query("project", "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders")
def project(t):
    return t.orders.select("o_totalprice", "o_orderkey", "o_orderstatus")


@query("rename", "SELECT c_custkey AS customer_id, c_name AS company, c_nationkey FROM customer")
def rename(t):
    kept = t.customer.select("c_custkey", "c_name", "c_nationkey")
    return kept.withColumnsRenamed({"c_custkey": "customer_id", "c_name": "company"})


@query("drop_cols", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_cols(t):
    return t.customer.drop("c_acctbal", "c_nationkey")


@query("filter_ci", "SELECT doc_id, lang FROM documents WHERE lower(lang) = 'fr'")
def filter_ci(t):
    return t.documents.filter(text.equals_ignore_case(F.col("lang"), "FR")).select("doc_id", "lang")


@query("filter_in", "SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src4', 'src9')")
def filter_in(t):
    return t.documents.filter(F.col("source").isin("src1", "src4", "src9")).select("doc_id", "source")


@query(
    "filter_notnull",
    f"WITH {i.PATENTS_SQL} SELECT company_id, url FROM patents WHERE url IS NOT NULL",
)
def filter_notnull(t):
    return i.patents(t).filter(F.col("url").isNotNull())


@query(
    "age_days",
    """SELECT o_orderkey, date_sub('day', o_orderdate, TIMESTAMP '2000-01-01 06:30:00') AS days
       FROM orders WHERE date_sub('day', o_orderdate, TIMESTAMP '2000-01-01 06:30:00') >= 30""",
)
def age_days(t):
    now = F.expr("timestamp_ntz'2000-01-01 06:30:00'")
    return aged(t.orders, "o_orderdate", now, 30, "days").select("o_orderkey", "days")


@query(
    "article_search",
    f"""WITH {i.CONCEPT_ARTICLES_SQL} SELECT url, strftime(date, '%Y-%m-%d') AS date, data_type
        FROM articles WHERE date BETWEEN DATE '2024-02-01' AND DATE '2024-10-31' AND lang = 'eng'
        AND data_type IN ('news', 'pr') AND list_has_any(uris, ['the', 'of', 'that'])
        AND list_has_any(uris, ['and', 'with', 'for'])""",
)
def article_search(t):
    found = search_articles(
        i.concept_articles(t), "2024-02-01", "2024-10-31", ["the", "of", "that"], ["and", "with", "for"]
    )
    return found.select("url", F.col("date").cast("string").alias("date"), "data_type")


@query(
    "article_stamp",
    f"""WITH {i.CONCEPT_ARTICLES_SQL}
        SELECT sha256('=' || lang || chr(31) || '=' || url || chr(31) || '=' || dateTimePub) AS article_id,
               lang AS company_id, 'Payments' AS sector,
               '2024-03-01T12:00:00.000000+00:00' AS run_datetime,
               substring(sha1(dateTimePub || '_' || url), 1, 10) AS temp_id, url
        FROM articles""",
)
def article_stamp(t):
    rows = i.concept_articles(t).withColumn("company_id", F.col("lang"))
    stamped = stamp(rows, "Payments", F.expr("timestamp'2024-03-01 12:00:00'"))
    return stamped.select("article_id", "company_id", "sector", "run_datetime", "temp_id", "url")


@query(
    "empty_marker_to_null",
    """SELECT p_partkey, CASE WHEN p_size >= 10 THEN p_brand END AS tags,
              CASE WHEN p_size >= 20 THEN p_name ELSE '[] ' END AS names FROM part""",
)
def empty_marker_to_null(t):
    rows = t.part.select(
        "p_partkey",
        F.when(F.col("p_size") < 10, "[]").otherwise(F.col("p_brand")).alias("tags"),
        F.when(F.col("p_size") < 20, "[] ").otherwise(F.col("p_name")).alias("names"),
    )
    return marker_to_null(rows)


@query(
    "clean_event",
    """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS date,
              CASE WHEN o_totalprice < 200000 THEN 'Q1 Release (Projected)' ELSE 'a bc' END AS event
       FROM orders WHERE o_orderstatus <> 'P'""",
)
def clean_event(t):
    event = F.when(F.col("o_totalprice") < 200000, "Q1 Release (Projected)").otherwise("a   b    c")
    tail = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.concat(F.lit("\n    x\n\n  "), event, F.lit("\n"))
    )
    raw = F.concat(F.lit("\xa0 \t "), F.date_format("o_orderdate", "dd/MM/yyyy"), tail)
    rows = t.orders.select("o_orderkey", raw.alias("row_text"))
    return split_row(rows, F.col("row_text")).select("o_orderkey", "date", "event")


@query(
    "event_dates",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
              THEN strftime(o_orderdate, '%Y/%m/%d') END AS event_date FROM orders""",
)
def event_dates(t):
    day = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(day, "d/M/yyyy"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(day, "d/M/yy"))
        .when(F.col("o_orderpriority") == "5-LOW", "Q1 2025")
        .otherwise(F.date_format(day, "'31/02/'yyyy"))
    )
    return t.orders.select(
        "o_orderkey", dates.slashed(dates.parse_day_first(written)).alias("event_date")
    )


@query(
    "clean_bullets",
    """SELECT p_partkey, '•' || p_name || chr(10) || '•' || p_brand || chr(10) || '•' || p_type AS summary
       FROM part""",
)
def clean_bullets(t):
    raw = F.concat(
        F.lit("\n\n• "), "p_name", F.lit("\n\n• "), "p_brand", F.lit("•"), "p_type", F.lit(" \n")
    )
    return t.part.select("p_partkey", text.clean_bullets(raw).alias("summary"))


@query(
    "parse_list",
    """SELECT o_orderkey,
              CASE o_orderstatus WHEN 'F' THEN o_orderpriority || '|it''s' ELSE '' END AS reasons,
              CASE o_orderstatus WHEN 'F' THEN 2 ELSE 0 END AS n FROM orders""",
)
def parse_list(t):
    status = F.col("o_orderstatus")
    written = (
        F.when(status == "F", F.concat(F.lit("['"), "o_orderpriority", F.lit("', \"it's\"]")))
        .when(status == "O", F.concat(F.lit("bad "), "o_orderpriority"))
        .otherwise("[]")
    )
    rows = t.orders.select("o_orderkey", parse_list_text(written).alias("parsed"))
    return rows.select(
        "o_orderkey", F.array_join("parsed", "|").alias("reasons"), size_or_zero(F.col("parsed")).alias("n")
    )


@query(
    "replace_chain",
    """SELECT p_partkey, trim(replace(replace(replace(p_name, 'red', 'crimson'), 'plate', ''), 'hot ', ''))
       AS name FROM part""",
)
def replace_chain(t):
    pairs = (("red", "crimson"), ("plate", ""), ("hot ", ""))
    return t.part.select("p_partkey", text.tidy_event_name(F.col("p_name"), pairs).alias("name"))


@query(
    "temp_id",
    "SELECT page_id, substring(sha1(CAST(page_id AS VARCHAR) || '_' || url), 1, 10) AS temp_id FROM pages",
)
def temp_id(t):
    made = text.short_article_id(F.col("page_id").cast("string"), F.col("url"))
    return t.pages.select("page_id", made.alias("temp_id"))


@query(
    "clock_text",
    "SELECT event_id, strftime(ts, '%I:%M %p') AS clock FROM events",
)
def clock_text(t):
    return t.events.select("event_id", dates.clock_text(F.col("ts")).alias("clock"))
