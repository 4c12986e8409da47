"""Sources and sinks."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatrix.operators.filters import without_key
from curatrix.plans.counts import published_index
from curatrix.registry import inputs as i
from curatrix.registry.base import TABLE_NAMES, query
from curatrix.schemas import ARTICLE_INPUT, TEXT, struct
from curatrix.session import shared_dir
from curatrix.sinks.export import export_tables
from curatrix.sinks.tables import write_csv, write_stamped, write_table
from curatrix.sources.files import scan_csv
from curatrix.sources.inventory import inventory, inventory_from_catalog
from curatrix.sources.pages import fetched_pages
from curatrix.sources.tables import from_records, scan_sql, scan_table

ORDER_ROW = struct(o_custkey=T.LongType(), o_orderstatus=TEXT, cents=T.LongType())
PAPER_ROW = struct(company_name=TEXT, paper_url=TEXT, exclusion_reason=TEXT)


@query(
    "param_sql_scan",
    """SELECT lang, source, count(*) AS n_docs, sum(n_chars)::BIGINT AS chars FROM documents
       WHERE lower(lang) = 'en' AND n_chars >= 500 GROUP BY lang, source""",
)
def param_sql_scan(t):
    return scan_sql(
        t.spark,
        """SELECT lang, source, count(*) AS n_docs, sum(n_chars) AS chars FROM {docs}
           WHERE lower(lang) = lower(:lang) AND n_chars >= :least GROUP BY lang, source""",
        {"docs": t.documents},
        {"lang": "EN", "least": 500},
    )


@query(
    "csv_scan",
    """SELECT o_custkey, o_orderstatus, count(*) AS n, sum(CAST(o_totalprice * 100 AS BIGINT))::BIGINT AS cents
       FROM orders GROUP BY o_custkey, o_orderstatus""",
)
def csv_scan(t):
    path = write_csv(
        t.orders.select(
            F.col("o_orderkey").alias("index"), "o_custkey", "o_orderstatus",
            F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"),
        ),
        shared_dir(t.spark, "orders-csv"),
    )
    rows = scan_csv(
        t.spark, path, ORDER_ROW, index_column=True
    )
    return rows.groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )


@query(
    "csv_multiline_scan",
    f"WITH {i.PATENTS_SQL} SELECT company, indicator, v2023, v2024 FROM published",
)
def csv_multiline_scan(t):
    return published_index(t.spark, i.published_file(t)).toDF("company", "indicator", "v2023", "v2024")


@query("typed_scan", i.ARTICLES_SQL)
def typed_scan(t):
    path = write_csv(i.article_input(t), shared_dir(t.spark, "articles-csv"))
    return scan_csv(t.spark, path, ARTICLE_INPUT, multi_line=True)


@query(
    "csv_roundtrip",
    f"""WITH {i.MISSING_SQL}
        SELECT company_name, paper_url,
               CASE WHEN len(reasons) = 0 THEN '[]'
                    ELSE '["' || array_to_string(reasons, '","') || '"]' END AS exclusion_reason
        FROM missing""",
)
def csv_roundtrip(t):
    from curatrix.registry.jobs import missing_papers

    rows = missing_papers(t).select("company_name", "paper_url", "exclusion_reason")
    path = write_csv(rows, shared_dir(t.spark, "missing-csv"))
    return scan_csv(t.spark, path, PAPER_ROW)


@query(
    "overwrite_sink",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
)
def overwrite_sink(t):
    columns = ("o_orderkey", "o_custkey", "o_orderstatus")
    path = shared_dir(t.spark, "overwritten")
    write_table(t.orders.select(*columns), path)
    write_table(without_key(t.orders, "o_orderstatus", "P").select(*columns), path)
    return scan_table(t.spark, path)


@query(
    "overwrite_self",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'",
)
def overwrite_self(t):
    """A stored table replaced by a part of itself."""
    path = write_table(t.orders.select("o_orderkey", "o_orderstatus"), shared_dir(t.spark, "replaced"))
    write_table(without_key(scan_table(t.spark, path), "o_orderstatus", "P"), path)
    return scan_table(t.spark, path)


@query(
    "stamped_output",
    "SELECT doc_id, lang, 'articles_feb01_1504' AS folder FROM documents",
)
def stamped_output(t):
    """Rows that went through a path with the run's time in its name."""
    path = write_stamped(t.documents.select("doc_id", "lang"), shared_dir(t.spark, "stamped"), "articles", datetime(2024, 2, 1, 15, 4))
    return scan_table(t.spark, path).withColumn("folder", F.lit(path.rsplit("/", 1)[1]))


@query(
    "param_table_scan",
    "SELECT lang AS k, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY lang",
)
def param_table_scan(t):
    """The names of table and column as parameters."""
    t.documents.createOrReplaceTempView("given_documents")
    return scan_sql(
        t.spark,
        "SELECT IDENTIFIER(:column) AS k, count(*) AS n, sum(n_chars) AS chars FROM IDENTIFIER(:table) GROUP BY ALL",
        args={"column": "lang", "table": "given_documents"},
    )


PART_BYTES = 1 << 20


@query(
    "csv_bounded",
    """SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS text_md5, true AS bounded FROM documents
       UNION ALL SELECT 'all ' || count(*), md5(repeat('long text' || chr(10), 70000)), true FROM documents""",
)
def csv_bounded(t):
    """Texts and a very long one, each on one line, that went through files of at most a bound."""
    rows = t.documents.select(F.col("doc_id").cast("string").alias("id"), "text")
    longest = t.documents.agg(F.count(F.lit(1)).alias("n")).select(
        F.concat(F.lit("all "), F.col("n")).alias("id"), F.repeat(F.lit("long text\n"), F.lit(70_000)).alias("text")
    )
    path = write_csv(rows.unionByName(longest), shared_dir(t.spark, "bounded"), max_bytes=PART_BYTES, one_line=True)
    parts = t.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    header = len("id,text\n")
    largest = parts.agg(F.max("length")).first()[0]
    back = scan_csv(t.spark, path, struct(id=TEXT, text=TEXT), one_line=True)
    return back.select("id", F.md5("text").alias("text_md5"), F.lit(largest <= PART_BYTES + header).alias("bounded"))


@query(
    "records_join",
    """SELECT n_name AS nation, r_name AS region, count(c_custkey) AS n_customers
       FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
       GROUP BY n_name, r_name""",
)
def records_join(t):
    """A dictionary held in memory, with its declared schema, beside a stored table."""
    kind = struct(key=T.LongType(), nation=TEXT, region=TEXT)
    named = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    nations = from_records(t.spark, [tuple(r) for r in named.select("n_nationkey", "n_name", "r_name").collect()], kind)
    counts = t.customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("n_customers"))
    joined = nations.join(counts, F.col("key") == F.col("c_nationkey"), "left")
    return joined.select("nation", "region", F.coalesce("n_customers", F.lit(0)).alias("n_customers"))


@query("run_suffix", "SELECT event_id, lower(strftime(ts, '%b%d_%H%M')) AS suffix FROM events")
def run_suffix_query(t):
    from curatrix.functions.dates import run_suffix

    return t.events.select("event_id", run_suffix(F.col("ts")).alias("suffix"))


@query(
    "pages_scan",
    "SELECT page_id, url, md5(html) AS html_md5 FROM pages WHERE starts_with(url, 'https')",
)
def pages_scan(t):
    # Plain http addresses answer with a redirect, so they hold no page.
    status = F.when(F.startswith("url", F.lit("https")), 200).otherwise(301)
    return fetched_pages(t.pages.withColumn("status", status)).select(
        "page_id", "url", F.md5("html").alias("html_md5")
    )


@query(
    "inventory_scan",
    f"""WITH {i.INVENTORY_SQL} SELECT dataset_id, table_type, count(*) AS n_tables,
        strftime(min(created), '%Y-%m-%d') AS oldest, strftime(max(modified), '%Y-%m-%d') AS changed
        FROM inventory GROUP BY dataset_id, table_type""",
)
def inventory_scan(t):
    return (
        inventory(i.order_inventory(t))
        .groupBy("dataset_id", "table_type")
        .agg(
            F.count(F.lit(1)).alias("n_tables"),
            F.date_format(F.min("created"), "yyyy-MM-dd").alias("oldest"),
            F.date_format(F.max("modified"), "yyyy-MM-dd").alias("changed"),
        )
    )


SHARD_BYTES = 1 << 20


@query(
    "export_shards",
    """SELECT 'given.' || t AS table, n AS n_rows, n AS n_read, 'done' AS status, true AS bounded FROM (
           SELECT 'documents' AS t, count(*) AS n FROM documents UNION ALL SELECT 'orders', count(*) FROM orders
           UNION ALL SELECT 'lineitem', count(*) FROM lineitem)""",
)
def export_shards(t):
    """Tables exported in shards of bounded size, read back and measured."""
    names = ("documents", "orders", "lineitem")
    listed = given_tables_inventory(t, "given").filter(F.col("table_id").isin(*names))
    load = lambda spark, dataset, table: getattr(t, table)
    root = shared_dir(t.spark, "shards")
    manifest = export_tables(listed, load, root, max_bytes=SHARD_BYTES)
    files = t.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(root)
    name = F.regexp_extract("path", "/([^/]+)/part-", 1)
    largest = files.groupBy(name.alias("name")).agg(F.max("length").alias("largest"))
    counts = [t.spark.read.parquet(f"{root}/given/{n}").select(F.lit(f"given.{n}").alias("read")) for n in names]
    read = counts[0].union(counts[1]).union(counts[2]).groupBy("read").agg(F.count(F.lit(1)).alias("n_read"))
    joined = manifest.join(read, F.col("table") == F.col("read")).join(largest, F.col("table") == F.concat(F.lit("given."), "name"))
    return joined.select("table", "n_rows", "n_read", "status", (F.col("largest") <= SHARD_BYTES).alias("bounded"))


def live_inventory(t):
    """The catalog's inventory while the given tables are registered in it, and a view."""
    name = f"curatrix_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE {name}")
    try:
        for table in TABLE_NAMES:
            path = f"{t.folder}/{table}.parquet"
            t.spark.catalog.createTable(f"{name}.{table}", path, source="parquet")
        t.spark.sql(f"CREATE VIEW {name}.late_orders AS SELECT * FROM {name}.orders WHERE o_orderstatus = 'P'")
        listed = inventory_from_catalog(t.spark, "test").filter(F.col("dataset_id") == name)
        return listed.withColumn("dataset_id", F.lit("given"))
    finally:
        # The tables are external, so their files stay.
        t.spark.sql(f"DROP DATABASE {name} CASCADE")


LIVE_SQL = " UNION ALL ".join(f"SELECT '{n}' AS table_id, 'TABLE' AS table_type" for n in TABLE_NAMES) + (
    " UNION ALL SELECT 'late_orders', 'VIEW'"
)


@query(
    "catalog_inventory",
    f"SELECT 'test' AS project, 'given' AS dataset_id, table_id, table_type, true AS dated FROM ({LIVE_SQL})",
)
def catalog_inventory(t):
    """Tables of the live catalog, each with the times of its creation and last change."""
    dated = F.col("created").isNotNull() & F.col("modified").isNotNull()
    return live_inventory(t).select("project", "dataset_id", "table_id", "table_type", dated.alias("dated"))


def given_tables_inventory(t, dataset: str):
    """Inventory rows of the given tables, plus a view that an export skips."""
    rows = t.spark.createDataFrame(
        [(n, "TABLE") for n in TABLE_NAMES] + [("late_orders", "VIEW")], "table_id string, table_type string"
    )
    never = F.lit(None).cast("timestamp")
    return rows.select(
        F.lit("test").alias("project"), F.lit(dataset).alias("dataset_id"), "table_id", "table_type",
        never.alias("created"), never.alias("modified"),
    )


EXPORT_SQL = "\n    UNION ALL ".join(
    f"SELECT 'given.{n}' AS table, 'given/{n}' AS path, count(*) AS n_rows, 'done' AS status FROM {n}"
    for n in TABLE_NAMES
)


@query("export_manifest", EXPORT_SQL)
def export_manifest(t):
    listed = given_tables_inventory(t, "given").filter("table_type = 'TABLE'")
    load = lambda spark, dataset, table: getattr(t, table)
    manifest = export_tables(listed, load, shared_dir(t.spark, "export"))
    return manifest.select("table", "path", "n_rows", "status")
