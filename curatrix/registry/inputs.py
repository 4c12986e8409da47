"""Frames derived from the given tables in the shape the operators expect, and the
same derivations as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.operators.domains import suffix_rules
from curatrix.registry.base import Tables
from curatrix.session import shared_dir
from curatrix.sinks.tables import write_csv

# Names below example.com, .net and .org are the registered ones in the test pages.
TEST_SUFFIXES = ("example.com", "example.net", "example.org")


def first_line_of(c: str) -> Column:
    return F.substring_index(c, "\n", 1)


# --- articles and papers --------------------------------------------------------------

ARTICLES_SQL = """
    SELECT 'http://' || source || '.example/' || doc_id AS url,
           split_part(text, chr(10), 1) AS title, text AS body, source AS source_name,
           '2024-01-' || lpad(CAST(1 + n_chars % 28 AS VARCHAR), 2, '0') AS date_published,
           lang AS pillar
    FROM documents"""


def article_input(t: Tables) -> DataFrame:
    day = F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0")
    return t.documents.select(
        F.concat(F.lit("http://"), "source", F.lit(".example/"), F.col("doc_id")).alias("url"),
        first_line_of("text").alias("title"),
        F.col("text").alias("body"),
        F.col("source").alias("source_name"),
        F.concat(F.lit("2024-01-"), day).alias("date_published"),
        F.col("lang").alias("pillar"),
    )


def old_papers(t: Tables) -> DataFrame:
    """One paper per document; copies of a text share the url."""
    return t.documents.select(
        F.md5("text").alias("paper_url"), F.col("source").alias("company_name"), "doc_id"
    )


def new_papers(t: Tables) -> DataFrame:
    good = t.labels.filter("quality = 1").select("doc_id")
    return t.documents.join(good, "doc_id").select(
        F.md5("text").alias("paper_url"),
        first_line_of("text").alias("paper_title"),
        F.col("text").alias("paper_description"),
        F.col("source").alias("company_name"),
    )


def qa_papers(t: Tables) -> DataFrame:
    # Papers in one language were checked under another address, so their urls are missing.
    return t.documents.select(
        F.md5(F.when(F.col("lang") == "de", F.concat(F.lit("de/"), "text")).otherwise(F.col("text"))).alias("url"),
        F.when(F.col("lang") == "fr", "[]").otherwise(F.col("source")).alias("authors"),
        first_line_of("text").alias("title"),
        F.when(~F.col("source").isin("src1", "src5"), "2024-01-01").alias("publication_date"),
        F.col("text").alias("description"),
        (F.col("n_chars") < 400).alias("is_patent"),
        F.when(F.contains("text", F.lit("the")), '["ai"]').otherwise("[]").alias("tags"),
        F.when(F.contains("text", F.lit("http")), '["web"]').otherwise("[]").alias("excluded_tags"),
        F.col("lang").alias("keyword_tags"),
        F.lit(True).alias("has_publication_info"),
        F.when(F.col("lang") != "es", F.col("source")).alias("author_name"),
        "doc_id",
    )


PAPERS_SQL = """
    old AS (SELECT md5(text) AS paper_url, source AS company_name, doc_id FROM documents),
    fresh AS (
        SELECT md5(text) AS paper_url, split_part(text, chr(10), 1) AS paper_title,
               text AS paper_description, source AS company_name
        FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
    ),
    qa AS (
        SELECT md5(CASE WHEN lang = 'de' THEN 'de/' || text ELSE text END) AS url,
               CASE WHEN lang = 'fr' THEN NULL ELSE source END AS authors,
               split_part(text, chr(10), 1) AS title,
               CASE WHEN source NOT IN ('src1', 'src5') THEN '2024-01-01' END AS publication_date,
               text AS description, n_chars < 400 AS is_patent,
               CASE WHEN contains(text, 'the') THEN '["ai"]' END AS tags,
               CASE WHEN contains(text, 'http') THEN '["web"]' END AS excluded_tags,
               lang AS keyword_tags,
               CASE WHEN lang <> 'es' THEN source END AS author_name, doc_id
        FROM documents
    )"""

MISSING_SQL = PAPERS_SQL + """,
    first_old AS (
        SELECT paper_url, arg_min(company_name, doc_id) AS company_name FROM old
        WHERE paper_url NOT IN (SELECT paper_url FROM fresh) GROUP BY paper_url
    ),
    first_qa AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY url ORDER BY doc_id) AS nth FROM qa
        ) WHERE nth = 1
    ),
    missing AS (
        SELECT o.company_name, o.paper_url, q.authors, q.title, q.description, q.excluded_tags,
               q.author_name,
               list_filter([
                   CASE WHEN q.is_patent THEN 'is_patent' END,
                   CASE WHEN q.excluded_tags IS NOT NULL THEN 'excluded_tags' END,
                   CASE WHEN q.tags IS NULL THEN 'no_tags' END,
                   CASE WHEN q.authors IS NULL THEN 'no_authors' END,
                   CASE WHEN q.publication_date IS NULL THEN 'no_publication_date' END,
                   CASE WHEN q.author_name IS NULL THEN 'no_author_name' END
               ], lambda r: r IS NOT NULL) AS reasons
        FROM first_old o LEFT JOIN first_qa q ON o.paper_url = q.url
    )"""


# --- companies, patents and the published index ---------------------------------------

PATENTS_SQL = """
    ids AS (
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS company, lower(c_mktsegment) AS sector
        FROM customer
    ),
    patents AS (
        SELECT CAST(o_custkey AS VARCHAR) AS company_id,
               CASE WHEN o_orderstatus <> 'P' THEN 'p/' || o_orderkey END AS url
        FROM orders
    ),
    published AS (
        SELECT CASE WHEN c_acctbal > 0 THEN c_name ELSE 'Former ' || c_name END AS company,
               c_mktsegment AS indicator,
               count(*) FILTER (o_orderstatus = 'F') AS v2023,
               count(*) FILTER (o_orderstatus = 'O') AS v2024
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY ALL
    )"""


def company_ids(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("company"),
        F.lower("c_mktsegment").alias("sector"),
    )


def patents(t: Tables) -> DataFrame:
    url = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("p/"), F.col("o_orderkey")))
    return t.orders.select(F.col("o_custkey").cast("string").alias("company_id"), url.alias("url"))


def published_file(t: Tables) -> str:
    """A published index as a CSV folder, with line breaks in two headers.

    Companies without a positive balance are published under another name.
    """
    status = F.col("o_orderstatus")
    counts = t.orders.groupBy("o_custkey").agg(
        F.count_if(status == "F").alias("Raw Value\n2023"),
        F.count_if(status == "O").alias("Raw Value\n2024"),
    )
    rows = (
        t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(F.concat(F.lit("Former "), "c_name")).alias("Company"),
            F.lit("Patents").alias("Indicator Group"),
            F.col("c_mktsegment").alias("Indicator Code"),
            "`Raw Value\n2023`",
            "`Raw Value\n2024`",
        )
    )
    return write_csv(rows, shared_dir(t.spark, "published"))


# --- calendar pages -------------------------------------------------------------------

def _event_row() -> Column:
    """The text of one table row as a page holds it, with its odd blanks."""
    day = F.when(F.col("o_totalprice") < 5000, F.lit("Q1 2025")).otherwise(
        F.date_format("o_orderdate", "d/M/yyyy")
    )
    event = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Pre-market Q1 Release (Projected)"))
        .when(F.col("o_orderstatus") == "P", F.lit("Annual DIVIDEND payment"))
        .otherwise(F.concat(F.lit("Meeting "), F.col("o_orderpriority")))
    )
    return F.concat(F.lit("\n\xa0 \t"), day, F.lit("\n    08:00\n\n    "), event, F.lit("  \n"))


def calendar_url() -> Column:
    return F.concat(F.lit("https://cal.example/"), F.col("o_custkey"), F.lit("/"), F.col("o_orderkey"))


def calendar_pages(t: Tables) -> DataFrame:
    """One page per order: an event, the same event again, and a row outside the card."""
    cells = F.concat(F.lit("<tr><td>"), _event_row(), F.lit("</td></tr>"))
    html = F.concat(
        F.lit("<html><body><table><tr><td>1/1/2000\n\nOutside</td></tr></table>"),
        F.lit('<div id="next-events-card"><div><table>'),
        cells,
        cells,
        F.lit("</table></div></div><table><tr><td>2/1/2000\n\nAfter</td></tr></table></body>"),
    )
    status = F.when(F.col("o_orderpriority") == "5-LOW", 404).otherwise(200)
    return t.orders.select(calendar_url().alias("url"), status.alias("status"), html.alias("html"))


def calendar_links(t: Tables) -> DataFrame:
    """The company of each page; pages of finished orders belong to a second one."""
    named = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    first = named.select(
        calendar_url().alias("market_screener_link"),
        F.col("c_custkey").cast("string").alias("company_id"),
        F.col("c_name").alias("name"),
    )
    second = named.filter("o_orderstatus = 'F'").select(
        calendar_url().alias("market_screener_link"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("company_id"),
        F.concat(F.lit("Holding "), F.col("c_nationkey")).alias("name"),
    )
    return first.unionByName(second)


EVENTS_RAW_SQL = """
    listed AS (
        SELECT o_orderkey, c_name, c_nationkey, CAST(c_custkey AS VARCHAR) AS custkey, o_orderstatus,
               strftime(o_orderdate, '%Y/%m/%d') AS date,
               CASE o_orderstatus WHEN 'F' THEN 'Pre-market Q1 Release (Projected)'
                    WHEN 'P' THEN 'Annual DIVIDEND payment'
                    ELSE 'Meeting ' || o_orderpriority END AS event
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice >= 5000 AND o_orderpriority <> '5-LOW'
    ),
    raw AS (
        SELECT c_name AS name, date, custkey AS company_id, event FROM listed
        UNION
        SELECT 'Holding ' || c_nationkey, date, 'n' || c_nationkey, event FROM listed
        WHERE o_orderstatus = 'F'
    )"""


# --- article pages and alias dictionaries ----------------------------------------------

def _escaped(c: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def article_pages(t: Tables) -> DataFrame:
    """One page per document with a lead, two unwanted sections and a closing one."""
    html = F.concat(
        F.lit('<main><div class="wide nws-container" id="lead"><h2>'),
        _escaped(first_line_of("text")),
        F.lit("</h2><p>"),
        _escaped(F.col("text")),
        F.lit('</p></div><div class="nws-container" id="about-us"><p>About</p></div>'),
        F.lit('<div class="nws-container"><h2> OUR TEAM </h2><p>'),
        F.col("lang"),
        F.lit('</p></div><div class="other">skip</div><div class="nws-container"><p>More at '),
        F.col("source"),
        F.lit("</p></div></main>"),
    )
    return t.documents.select(F.concat(F.lit("/a/"), F.col("doc_id")).alias("url"), html.alias("html"))


ARTICLE_CLASS = "text-black no-underline"
ARTICLE_BASE = "https://brief.example/all/index.html"


def index_pages(t: Tables) -> DataFrame:
    """Index pages of up to twenty articles each; those in one language carry another class."""
    kind = F.when(F.col("lang") == "es", "no-underline").when(F.col("lang") == "de", " text-black\n  no-underline").otherwise(
        F.lit(ARTICLE_CLASS)
    )
    target = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/all/"), F.col("doc_id")))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("https://brief.example/all/"), F.col("doc_id")))
        .otherwise(F.col("doc_id").cast("string"))
    )
    entry = F.concat(F.lit('<li><a class="'), kind, F.lit('" href="'), target, F.lit('">'), F.lit("x</a></li>"))
    return (
        t.documents.groupBy(F.floor(F.col("doc_id") / 20).alias("n"))
        .agg(F.array_join(F.sort_array(F.collect_list(entry)), "").alias("list"))
        .select(
            F.concat(F.lit("https://brief.example/index/"), "n").alias("url"),
            F.concat(F.lit('<ul><li><a class="other" href="/all/0">no</a></li>'), "list", "list", F.lit("</ul>")).alias("html"),
        )
    )


def stored_articles(t: Tables) -> DataFrame:
    """Two fetches of each article page, the later one whole; a tenth moved to another address."""
    moved = F.when(F.endswith("url", F.lit("7")), "/moved/").otherwise("/all/")
    stored = article_pages(t).withColumn(
        "url", F.concat(F.lit("https://brief.example"), moved, F.substring_index("url", "/", -1))
    )
    early = stored.select("url", F.lit('<div class="nws-container">draft</div>').alias("html"), F.lit(1).alias("fetched"))
    return stored.select("url", "html", F.lit(2).alias("fetched")).unionByName(early)


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
ARTICLE_TEXT_SQL = f"""
    SELECT '/a/' || doc_id AS link,
           concat_ws(' ', nullif(trim(split_part(text, chr(10), 1), {SPACES}), ''),
                     nullif(trim(text, {SPACES}), ''), 'More at ' || source) AS content
    FROM documents"""


def alias_companies(t: Tables) -> DataFrame:
    """A company per benchmark item; its aliases are its first line and all its pairs of words."""
    word = F.split("text", " ")
    pairs = F.zip_with(word, F.slice(word, F.lit(2), F.size(word)), lambda a, b: F.concat(a, F.lit(" "), b))
    # The last word has no partner: a null alias, as a stored dictionary may have it.
    aliases = F.array_append(pairs, first_line_of("text"))
    return t.benchmark.select(
        F.concat(F.lit("item-"), F.col("item_id")).alias("company"),
        F.when(F.col("item_id") >= 0, "bank").alias("sector"),
        F.transform(aliases, lambda a: F.struct(a.alias("linkedin_organisation"))).alias("linkedin_id"),
    )


ALIASES_SQL = """
    aliases AS (
        SELECT DISTINCT 'item-' || item_id AS company, unnest(list_append(
            list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]), split_part(text, chr(10), 1)
        )) AS alias FROM (SELECT item_id, text, string_split(text, ' ') AS w FROM benchmark)
    )"""


# --- concepts --------------------------------------------------------------------------

def concept_metadata(t: Tables) -> DataFrame:
    sector = (
        F.when(F.col("p_type") == "ECONOMY", "Index Bank")
        .when(F.col("p_type") == "SMALL", "INDEX BANK")
        .otherwise("Payments")
    )
    return t.part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("additional_names"),
        F.col("p_type").alias("company_type"),
        sector.alias("internal_classification"),
    )


def concept_urls(t: Tables) -> DataFrame:
    """Per part an array of url structs: empty, all null, partly null or full."""
    pair = F.array(
        F.struct(F.when(F.col("p_size") > 10, F.concat(F.lit("c/"), F.col("p_brand"))).alias("url")),
        F.struct(F.when(F.col("p_size") > 30, F.concat(F.lit("c/"), F.col("p_name"))).alias("url")),
    )
    return t.part.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_size") > 5, pair)
        .otherwise(F.array().cast("array<struct<url:string>>"))
        .alias("concept_url"),
    )


CONCEPT_COMPANIES_SQL = """
    companies AS (
        SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
               list_filter([CASE WHEN p_size > 10 THEN 'c/' || p_brand END,
                            CASE WHEN p_size > 30 THEN 'c/' || p_name END],
                           lambda u: u IS NOT NULL) AS urls
        FROM part WHERE p_type IN ('ECONOMY', 'SMALL')
    )"""


def concept_articles(t: Tables) -> DataFrame:
    """Documents as articles; their words are their concepts."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 365).cast("int"))
    return t.documents.select(
        day.alias("date"),
        F.when(F.col("lang") == "en", "eng").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("source").isin("src1", "src2", "src3"), "news")
        .when(F.col("source").isin("src4", "src5"), "pr")
        .otherwise("blog")
        .alias("data_type"),
        F.concat(day.cast("string"), F.lit("T00:00:00Z")).alias("dateTimePub"),
        F.concat(F.lit("http://"), "source", F.lit("/"), F.col("doc_id")).alias("url"),
        F.transform(F.split("text", " "), lambda w: F.struct(w.alias("uri"))).alias("concepts"),
    )


CONCEPT_ARTICLES_SQL = """
    articles AS (
        SELECT DATE '2024-01-01' + CAST(n_chars % 365 AS INTEGER) AS date,
               CASE WHEN lang = 'en' THEN 'eng' ELSE lang END AS lang,
               CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'news'
                    WHEN source IN ('src4', 'src5') THEN 'pr' ELSE 'blog' END AS data_type,
               strftime(DATE '2024-01-01' + CAST(n_chars % 365 AS INTEGER), '%Y-%m-%d')
                   || 'T00:00:00Z' AS dateTimePub,
               'http://' || source || '/' || doc_id AS url, string_split(text, ' ') AS uris
        FROM documents
    )"""


def word_companies(t: Tables) -> DataFrame:
    """A company per benchmark item with the item's words as concept urls."""
    return t.benchmark.select(
        F.concat(F.lit("item-"), F.col("item_id")).alias("id"), F.split("text", " ").alias("url_list")
    )


WORD_COMPANIES_SQL = """
    companies AS (SELECT 'item-' || item_id AS company_id, string_split(text, ' ') AS urls FROM benchmark)"""


# --- outlets ---------------------------------------------------------------------------

def outlets(t: Tables) -> DataFrame:
    from curatrix.operators.domains import host_of

    secure = F.startswith("url", F.lit("https"))
    return t.pages.select(
        F.lit("example").alias("domain_name_root"),
        host_of(F.col("url")).alias("domain_name"),
        secure.alias("is_top_tier"),
        F.lit(False).alias("is_blacklisted"),
        F.col("page_id").cast("int").alias("ranking"),
        F.lit(None).cast("string").alias("media_logo"),
        (~secure).alias("paywall"),
        F.lit(False).alias("partial_paywall"),
        F.lit(False).alias("is_company_site"),
        F.lit(False).alias("is_index"),
        F.col("page_id").cast("string").alias("company_id"),
        F.concat(F.lit("c"), F.col("page_id")).alias("company_name"),
        F.lit("bank").alias("sector"),
    )


def source_ids(t: Tables) -> DataFrame:
    """Source ids known for the labels of securely served pages."""
    label = F.regexp_extract("url", r"([^./]+)\.example\.(com|net|org)", 1)
    return (
        t.pages.filter(F.startswith("url", F.lit("https:")))
        .select(label.alias("label"), F.concat(F.lit("uri/"), label).alias("source_uri"))
        .distinct()
    )


def test_suffix_rules(t: Tables) -> DataFrame:
    return suffix_rules(t.spark, TEST_SUFFIXES)


# A list file as its keepers write it: comments, a note after a rule, two parts.
SUFFIX_LIST = """// A short list
// ===BEGIN ICANN DOMAINS===
com
net
org

*.example.com  any label
!blog.example.com
// ===END ICANN DOMAINS===
// ===BEGIN PRIVATE DOMAINS===
example.org
// ===END PRIVATE DOMAINS===
"""


def suffix_list_file(t: Tables) -> str:
    path = shared_dir(t.spark, "suffixes")
    t.spark.createDataFrame([(SUFFIX_LIST,)], "value string").coalesce(1).write.text(path)
    return path


def suffix_cases(t: Tables) -> DataFrame:
    """Page urls whose hosts meet each kind of rule, none, or are a suffix themselves."""
    from curatrix.operators.domains import host_of

    host, case = host_of(F.col("url")), F.col("page_id") % 7
    changed = (
        F.when(case == 1, F.upper(host))
        .when(case == 2, F.replace(host, F.lit("example.com"), F.lit("blog.example.com")))
        .when(case == 3, F.regexp_replace(host, "[a-z]+$", "zz"))
        .when(case == 4, F.concat(F.lit("a.b."), host))
        .when(case == 5, F.regexp_extract(host, "example.*", 0))
        .when(case == 6, F.concat(host, F.lit(".")))
        .otherwise(host)
    )
    return t.pages.select("page_id", F.concat(F.lit("https://user@"), changed, F.lit(":80/x?y")).alias("url"))


# --- inventory -------------------------------------------------------------------------

def order_inventory(t: Tables, project: Column | None = None) -> DataFrame:
    """One table per order; datasets follow status and priority."""
    prefix = (
        F.when(F.col("o_orderstatus") == "F", "raw_")
        .when(F.col("o_orderstatus") == "O", "curated_")
        .otherwise("misc_")
    )
    dataset = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("curated_hubspot"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("product_index_"), F.col("o_orderstatus")))
        .otherwise(F.concat(prefix, F.left("o_orderpriority", F.lit(1))))
    )
    table = F.concat(
        F.when(F.col("o_totalprice") < 100000, "banking_")
        .when(F.col("o_totalprice") < 200000, "omni_")
        .otherwise("x_"),
        F.col("o_orderkey"),
    )
    created = F.col("o_orderdate").cast("timestamp")
    return t.orders.select(
        (F.lit("test") if project is None else project).alias("project"),
        dataset.alias("dataset_id"),
        table.alias("table_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "VIEW").otherwise("TABLE").alias("table_type"),
        created.alias("created"),
        (created + F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 2000).cast("int"))).alias("modified"),
    )


INVENTORY_SQL = """
    inventory AS (
        SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'curated_hubspot'
                    WHEN o_orderpriority = '2-HIGH' THEN 'product_index_' || o_orderstatus
                    ELSE CASE o_orderstatus WHEN 'F' THEN 'raw_' WHEN 'O' THEN 'curated_' ELSE 'misc_' END
                         || substring(o_orderpriority, 1, 1) END AS dataset_id,
               CASE WHEN o_totalprice < 100000 THEN 'banking_' WHEN o_totalprice < 200000 THEN 'omni_'
                    ELSE 'x_' END || o_orderkey AS table_id,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'VIEW' ELSE 'TABLE' END AS table_type,
               o_orderdate AS created,
               o_orderdate + INTERVAL 1 HOUR * CAST(o_custkey % 2000 AS INTEGER) AS modified
        FROM orders
    )"""
