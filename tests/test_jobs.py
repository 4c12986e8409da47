"""The composed jobs on small frames with the edge rows of each input."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from curatrix import schemas
from curatrix.operators.domains import suffix_rules
from curatrix.operators.naming import Conventions
from curatrix.plans import articles, concepts, counts, events, inventory, mentions, outlets, reconcile
from curatrix.session import shared_dir
from curatrix.sinks.tables import stamped_path, write_csv, write_table
from curatrix.sources.files import scan_csv
from curatrix.sources.inventory import inventory_from_catalog
from curatrix.sources.tables import from_records, scan_sql, scan_table


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- calendar events -------------------------------------------------------------------

def card(*cells):
    body = "".join(f"<tr><td>{c}</td></tr>" for c in cells)
    return f'<div id="next-events-card"><table>{body}</table></div>'


@pytest.fixture
def event_pages(frame):
    release = "\n1/2/2024\n    x\n\n  Pre-market Q1 Release (Projected)\n"
    return frame(
        [
            ("shared", 200, card(release, release, "31/02/2024\n\nBad day", "1/2/24\n\nShort year")),
            ("lone", 200, card("3/4/2024\n\nDÉTACHEMENT x", "5/6/2024\n\nQ1 Call", "no block")),
            ("gone", 404, card("3/4/2024\n\nLost")),
            ("plain", 200, "<p>no card</p>"),
        ],
        "url string, status int, html string",
    )


@pytest.fixture
def event_links(spark):
    return from_records(
        spark,
        [("shared", "1", "A"), ("shared", "2", "B"), ("shared", "2", "B"), ("other", "3", "C")],
        schemas.CALENDAR_LINKS,
    )


def test_events_raw(event_pages, event_links):
    assert rows(events.events_raw(event_pages, event_links)) == sorted(
        [
            ("A", "2024/02/01", "1", "Pre-market Q1 Release (Projected)"),
            ("B", "2024/02/01", "2", "Pre-market Q1 Release (Projected)"),
            (None, "2024/04/03", None, "DÉTACHEMENT x"),
            (None, "2024/06/05", None, "Q1 Call"),
        ],
        key=repr,
    )
    assert {r.date for r in events.bad_dates(event_pages).collect()} == {"31/02/2024", "1/2/24"}


def test_events_strict_empties_the_page(event_pages, event_links):
    assert {r.name for r in events.events_raw(event_pages, event_links, strict=True).collect()} == {"A", "B"}


def test_events_curated(event_pages, event_links):
    out = rows(events.events_curated(events.events_raw(event_pages, event_links)))
    assert out == sorted(
        [("2024/02/01", "Q1 Call", "A"), ("2024/02/01", "Q1 Call", "B"), ("2024/06/05", "Q1 Call", None)], key=repr
    )


# --- reconciliation --------------------------------------------------------------------

@pytest.fixture
def papers(spark):
    old = from_records(
        spark,
        [("seen", "X"), ("dup", "B"), ("dup", "A"), ("bare", "X"), (None, "N"), ("clean", "X"), ("empty", "X")],
        schemas.PAPERS_OLD,
    )
    new = from_records(
        spark,
        [("seen", "t", "d", "ING"), ("fresh", "t1", "d1", "ING"), ("fresh", "t2", "d2", "HSBC"), ("else", "t", "d", "Z")],
        schemas.PAPERS_NEW,
    )
    full = dict(
        url="clean", authors="a", title="t", publication_date="2024", description="d", is_patent=None,
        tags="['x']", excluded_tags="[]", keyword_tags="[]", has_publication_info=True, author_name="n",
    )
    qa = [
        full,
        {**full, "url": "dup", "title": "second", "is_patent": True},
        {**full, "url": "dup", "title": "first", "excluded_tags": "['e']", "tags": "[]"},
        {**full, "url": "empty", "authors": "[]", "author_name": "[]"},
        {**full, "url": "fresh", "keyword_tags": "k1"},
        {**full, "url": "fresh", "keyword_tags": "k2"},
        {**full, "url": None, "title": "null url", "is_patent": True},
    ]
    qa = from_records(spark, [tuple(q.values()) for q in qa], schemas.PAPERS_QA)
    return old, new, qa


def test_missing_papers(papers):
    old, new, qa = papers
    found = {r.paper_url: r for r in reconcile.missing_from_new(old, new, qa).collect()}
    assert set(found) == {"dup", "bare", None, "clean", "empty"}
    assert found["dup"].company_name == "A" and found["dup"].title == "first"
    assert found["dup"].exclusion_reason == ["excluded_tags", "no_tags"]
    assert found["bare"].exclusion_reason == list(reconcile.REASONS[2:])
    assert found["clean"].exclusion_reason == [] and found["clean"].excluded_tags is None
    assert found["empty"].exclusion_reason == ["no_authors", "no_author_name"]
    assert found[None].title == "null url" and found[None].exclusion_reason == ["is_patent"]


def test_null_url_on_both_sides_is_not_missing(papers, frame):
    old, new, qa = papers
    with_null = new.unionByName(new.limit(1).withColumn("paper_url", F.lit(None).cast("string")))
    assert None not in {r.paper_url for r in reconcile.missing_from_new(old, with_null, qa).collect()}


def test_added_papers_fan_out(papers):
    old, new, qa = papers
    out = reconcile.added_in_new(old, new, qa, ("ING", "HSBC"))
    assert {(r.paper_url, r.paper_title, r.keyword_tags) for r in out.collect()} == {
        ("fresh", t, k) for t in ("t1", "t2") for k in ("k1", "k2")
    }
    assert out.columns == [
        "paper_url", "paper_title", "paper_description", "publication_date", "tags", "excluded_tags", "keyword_tags",
    ]


def test_exclusion_matrix_from_text_and_arrays(frame):
    data = [("A", "['is_patent', 'no_tags']"), ("A", "['no_tags']"), ("B", "bad"), ("B", "[]"), (None, "['no_tags']"), ("J", "['no_tags']")]
    missing = frame(data, "company_name string, exclusion_reason string")
    matrix = reconcile.exclusion_matrix(missing, drop_company="J").collect()
    assert [(r.company_name, r.is_patent, r.no_tags, r.total) for r in matrix] == [("A", 1, 2, 3)]
    combined = reconcile.exclusion_matrix(missing, per_combination=True, drop_company="absent")
    got = {r.company_name: r.asDict() for r in combined.collect()}
    assert got["A"]["is_patent|no_tags"] == 1 and got["A"]["total"] == 2
    assert got["B"]["none"] == 2 and set(got) == {"A", "B", "J"}
    counted = reconcile.reason_counts(missing)
    exploded = reconcile.reason_rows(missing).filter("company_name is not null").count()
    assert counted.agg(F.sum("count")).first()[0] == exploded


def test_all_combinations_are_in_rule_order():
    combos = reconcile.all_combinations()
    assert len(combos) == 64 and "none" in combos and "is_patent|no_tags" in combos


# --- counts ----------------------------------------------------------------------------

INDEX = (
    'Company,Pillar,Indicator Code,"Raw Value\n2023","Raw Value\n2024",Indicator Rank Change,"Leading Bank\nName"\n'
    'Alpha,Innovation,I1,5,7,+2,Alpha\n"Beta, Inc",Innovation,I1,5,3,-1,Alpha\nGamma,Innovation,I1,1,,0,Alpha\n'
)


def test_count_change_and_ranks(spark, tmp_path):
    (tmp_path / "index.csv").write_text(INDEX)
    index = counts.published_index(spark, str(tmp_path / "index.csv"))
    ids = from_records(
        spark, [("1", "Alpha", "bank"), ("2", "Beta, Inc", "bank"), ("3", "Delta", "bank"), ("4", "Eps", "pay")],
        schemas.COMPANY_IDS,
    )
    patents = from_records(spark, [("1", "u"), ("1", None), ("4", "v"), ("1", "w")], schemas.PATENTS)
    assert rows(counts.count_change(ids, patents, index)) == [
        ("Alpha", 2, 7, -5), ("Beta, Inc", 0, 3, -3), ("Delta", 0, None, None),
    ]
    ranks = {r.Company: r for r in counts.published_ranks(index).collect()}
    assert [ranks[c].rank_previous for c in ("Alpha", "Beta, Inc", "Gamma")] == [1, 1, 3]
    assert [ranks[c].rank_current for c in ("Alpha", "Beta, Inc", "Gamma")] == [1, 2, None]
    assert ranks["Beta, Inc"].rank_change == -1 and ranks["Gamma"].leader_name == "Alpha"


# --- outlets and concepts --------------------------------------------------------------

def outlet(domain, n=0):
    return ("r", domain, True, False, n, None, False, False, False, False, "1", "c", "bank")


def test_source_refresh_keeps_every_outlet(spark):
    names = ["www.x.co.uk", "x.co.uk", "x", "y.com", "bbc.zz", None, "x.co.uk"]
    given = from_records(spark, [outlet(d, n) for n, d in enumerate(names)], schemas.OUTLETS)
    ids = spark.createDataFrame([("x", "uri/x"), ("x", "uri/y"), ("y", ""), ("zz", "uri/zz")], "label string, source_uri string")
    out = outlets.refresh_sources(given, ids, suffix_rules(spark))
    got = [(r.ranking, r.eventregistry_sourceuri, r.flag_missing_uri) for r in out.orderBy("ranking").collect()]
    assert got == [(0, "uri/x", 0), (1, "uri/x", 0), (2, "uri/x", 0), (3, "", 1), (4, "uri/zz", 0), (6, "uri/x", 0)]
    raw = outlets.refresh_sources(given, ids, suffix_rules(spark), by_raw_domain=True)
    assert {r.ranking for r in raw.filter("flag_missing_uri = 0").collect()} == {2}


def test_company_concepts(spark):
    meta = from_records(
        spark,
        [(i, f"n{i}", None, "t", s) for i, s in (("1", "Index Bank"), ("2", "INDEX BANK"), ("3", "index bank"), ("4", "Other"), (None, "Index Bank"))],
        schemas.COMPANY_METADATA,
    )
    urls = from_records(
        spark,
        [("1", [("a",), (None,)]), ("1", [("b",)]), ("2", []), ("3", [(None,)]), (None, [("z",)])],
        schemas.COMPANY_CONCEPTS,
    )
    out = concepts.company_concepts(meta, urls, "Index bank")
    assert {(r.id, tuple(r.url_list) if r.url_list else None) for r in out.collect()} == {
        ("1", ("a",)), ("1", ("b",)), ("2", None), ("3", None), (None, None),
    }


def test_concept_articles_keep_article_columns(spark):
    day = dt.date(2024, 1, 2)
    topic = concepts.TOPIC_CONCEPTS[0]
    made = from_records(
        spark,
        [
            (day, "eng", "news", "p1", "u1", [(topic,), ("a",), ("b",)]),
            (day, "eng", "news", "p2", "u2", [("a",)]),
            (dt.date(2024, 1, 9), "eng", "news", "p3", "u3", [(topic,), ("a",)]),
        ],
        schemas.ARTICLES,
    ).withColumn("title", F.upper("url"))
    companies = spark.createDataFrame([("A", ["a", "b"]), ("B", ["b"]), ("C", None)], "id string, url_list array<string>")
    out = concepts.concept_articles(made, companies, day, day, "Payments", F.lit(dt.datetime(2024, 2, 1)))
    got = out.collect()
    assert {(r.url, r.company_id, r.title, r.sector) for r in got} == {("u1", "A", "U1", "Payments"), ("u1", "B", "U1", "Payments")}
    assert len({r.article_id for r in got}) == 2 and len({r.temp_id for r in got}) == 1
    again = concepts.concept_articles(made, companies, day, day, "Payments", F.lit(dt.datetime(2024, 2, 1)))
    assert {r.article_id for r in again.collect()} == {r.article_id for r in got}


def test_concept_articles_tell_rows_of_one_url_apart(spark):
    day, topic = dt.date(2024, 1, 2), concepts.TOPIC_CONCEPTS[0]
    made = from_records(
        spark,
        [
            (day, "eng", "news", "p1", "u1", [(topic,), ("a",)]),
            (day, "eng", "news", "p2", "u1", [(topic,)]),
            (day, "eng", "news", "p3", None, [(topic,), ("a",)]),
        ],
        schemas.ARTICLES,
    )
    companies = spark.createDataFrame([("A", ["a"])], "id string, url_list array<string>")
    got = concepts.concept_articles(made, companies, day, day, "Payments", F.lit(dt.datetime(2024, 2, 1))).collect()
    assert {(r.dateTimePub, r.url) for r in got} == {("p1", "u1"), ("p3", None)} and len(got[0].concepts) == 2


def test_mentions(spark):
    companies = from_records(
        spark,
        [("Beta", "bank", [("hsbc",), ("HSBC",), (None,), ("",)]), ("Alpha", "bank", [("ING",)]), ("Pay", "payments", [("x",)]), ("None", "bank", [])],
        schemas.COMPANY_ALIASES,
    )
    texts = spark.createDataFrame([("a", "LEADING HSBC hsbc x"), ("b", "ing"), ("c", None)], "link string, content string")
    out = {r.link: r.banks_mentioned for r in mentions.mentions(texts, companies).collect()}
    assert out == {"a": ["Alpha", "Beta"], "b": [], "c": []}


def test_last_version_of_a_repeated_link(spark):
    block = '<div class="nws-container">%s</div>'
    given = spark.createDataFrame(
        [("l", 0, block % "old"), ("m", 1, block % "x"), ("l", 2, block % "new")], "url string, pos int, html string"
    )
    assert rows(mentions.article_texts(given, position="pos")) == [("l", "new"), ("m", "x")]
    assert rows(mentions.article_texts(given.filter("pos <> 2").unionByName(given.filter("pos = 0")).drop("pos"))) == [("l", "old"), ("m", "x")]


# --- articles --------------------------------------------------------------------------

def test_relevance_job(spark):
    given = spark.createDataFrame([("ING", "AI model", "u"), ("ING", None, "v"), ("Z", "AI", "w")], "company_name string, description string, paper_url string")
    assert rows(articles.relevance(given, ("ING", "HSBC"), ("ai", "model"))) == [("u", "AI model", "Yes"), ("v", None, "No")]


def test_summary_job_column_order(spark):
    given = from_records(spark, [("u", "t", "One. Two longer.", "s", "2024-01-05", "p"), ("v", "t", "unended", "s", "x", "p"), ("w", "t", " \n", "s", "x", "p"), ("n", "t", None, "s", "x", "p")], schemas.ARTICLE_INPUT)
    out = articles.summaries(given, score="length", k=1)
    assert out.columns == list(articles.SUMMARY_COLUMNS)
    assert {r.url: r.summary for r in out.collect()} == {"u": "•Two longer.", "v": "•unended", "w": None, "n": None}


# --- inventory -------------------------------------------------------------------------

NOW = dt.datetime(2024, 5, 1, 12)


def listed(spark, *names, kind="TABLE", created=NOW):
    return from_records(spark, [("p", d, t, kind, created, created) for d, t in names], schemas.INVENTORY)


def test_naming_audit_with_and_without_whitelists(spark):
    given = listed(
        spark, ("raw_x", "banking_x"), ("misc_x", "omni_x"), ("misc_x", "x"), ("curated_hubspot", "bad"),
        ("product_index_2", "bad"), ("temporary1", "payments_x"), ("misc_empty", None),
    )
    out = inventory.naming_audit(given).collect()
    assert [(r.level, r.item) for r in out] == [("dataset", "misc_empty"), ("dataset", "misc_x"), ("table", "misc_x.x")]
    assert out[0].line == "\nmisc_empty"
    older = Conventions(table_prefixes=("insurance_", "banking_", "payments_"), skip_datasets=(), skip_dataset_prefixes=())
    assert {r.item for r in inventory.naming_audit(given, older).filter("level = 'table'").collect()} == {
        "misc_x.omni_x", "misc_x.x", "curated_hubspot.bad", "product_index_2.bad",
    }
    fine = inventory.naming_audit(listed(spark, ("raw_x", "banking_x"))).collect()
    assert [(r.level, r.line) for r in fine] == [("dataset", "none"), ("table", "All passing")]


def test_naming_audit_by_project(spark):
    given = [("a", "raw_x", "banking_x"), ("b", "misc", "x"), ("b", "misc", "omni_y"), ("c", "raw_x", "x"), (None, "raw_x", "x")]
    listed_ = from_records(spark, [(p, d, t, "TABLE", NOW, NOW) for p, d, t in given], schemas.INVENTORY)
    out = inventory.naming_audit(listed_, by_project=True).collect()
    assert {(r.project, r.level, r.item) for r in out} == {
        ("a", "dataset", "none"), ("a", "table", "All passing"), ("b", "dataset", "misc"), ("b", "table", "misc.x"),
        ("c", "dataset", "none"), ("c", "table", "raw_x.x"), (None, "dataset", "none"), (None, "table", "raw_x.x"),
    }
    assert [r.project for r in out] == sorted((r.project for r in out), key=lambda p: p or "")


def test_audit_time_and_stamped_path(spark):
    out = inventory.naming_audit(listed(spark, ("raw_x", "banking_x")), now=F.lit(NOW)).collect()
    assert {r.time for r in out} == {"12:00 PM"}
    assert stamped_path("/out/", "articles", dt.datetime(2024, 2, 1, 15, 4)) == "/out/articles_feb01_1504"


def test_table_ages(spark):
    def at(name, created, modified):
        return ("p", "raw_x", name, "TABLE", created, modified)

    given = from_records(
        spark,
        [
            at("young", NOW - dt.timedelta(days=29, hours=23), NOW),
            at("old", NOW - dt.timedelta(days=30), NOW - dt.timedelta(hours=2)),
            at("future", NOW - dt.timedelta(days=31), NOW + dt.timedelta(hours=22)),
        ],
        schemas.INVENTORY,
    )
    out = inventory.table_ages(given, F.lit(NOW), dataset="raw_x").orderBy("table_id").collect()
    assert [(r.table_id, r.days_since_created, r.days_since_modified) for r in out] == [("future", 31, -1), ("old", 30, 0)]
    assert out[1].message == "old was created 30 days ago and last modified 0 days ago."


def test_export_records_failures_and_goes_on(spark):
    given = listed(spark, ("d", "a"), ("d", "broken"), ("d", "z")).unionByName(listed(spark, ("d", "v"), kind="VIEW"))

    def load(session, dataset, table):
        if table == "broken":
            raise RuntimeError("unreadable")
        return session.range(3)

    root = shared_dir(spark, "export-test")
    out = {r.table: r for r in inventory.export(given, load, root).collect()}
    assert {t: (r.status, r.n_rows) for t, r in out.items()} == {
        "d.a": ("done", 3), "d.broken": ("failed", None), "d.v": ("skipped", None), "d.z": ("done", 3),
    }
    assert out["d.broken"].error == "unreadable"
    assert spark.read.parquet(f"{root}/d/z").count() == 3


def test_export_in_shards_of_bounded_size(spark):
    root = shared_dir(spark, "shards-test")
    wide = spark.range(400).select("id", F.concat(*[F.md5(F.concat("id", F.lit(str(n)))) for n in range(40)]).alias("v"))
    one = wide.limit(1).select(F.lit(-1).alias("id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda i: F.md5(i.cast("string"))), "").alias("v"))
    manifest = inventory.export(listed(spark, ("d", "t")), lambda s, d, t: wide.repartition(2).unionByName(one), root, max_bytes=100_000)
    assert [(r.status, r.n_rows) for r in manifest.collect()] == [("done", 401)]
    sizes = sorted(part_sizes(f"{root}/d/t"))
    assert len(sizes) >= 7 and sizes[-2] <= 100_000 < sizes[-1]  # one row alone is larger
    assert spark.read.parquet(f"{root}/d/t").select("id").distinct().count() == 401


def test_one_task_writes_many_shards(spark):
    root = shared_dir(spark, "many-shards-test")
    digits = F.array_join(F.transform(F.sequence(F.lit(1), F.col("id") % 90 + 1), lambda i: F.md5(i.cast("string"))), "")
    mixed = spark.range(0, 3_000, numPartitions=2).select("id", F.when(F.col("id") % 7 > 0, digits).alias("v"))
    mixed = mixed.unionByName(spark.range(-5, 0, numPartitions=1).select("id", F.lit("few").alias("v")))
    (shards,) = inventory.export(listed(spark, ("d", "t")), lambda s, d, t: mixed, root, max_bytes=20_000).collect()
    assert (shards.status, shards.n_rows) == ("done", 3_005)
    back = spark.read.parquet(f"{root}/d/t")
    assert back.exceptAll(mixed).isEmpty() and mixed.exceptAll(back).isEmpty()
    # The rows of a shard stay within the bound as JSON text too, and a small task is one shard.
    text = F.octet_length(F.to_json(F.struct("id", "v")))
    found = back.groupBy(F.input_file_name().alias("file")).agg(F.sum(text).alias("n"), F.collect_set("v").alias("v")).collect()
    assert max(r.n for r in found) <= 20_000 and ["few"] in [r.v for r in found]
    assert len(found) > 200 and len({r.file.rsplit("-c", 1)[0] for r in found}) < 60


def test_a_failed_sharded_export_leaves_no_files(spark):
    root = shared_dir(spark, "failed-shards-test")
    rows_ = spark.range(2_000).withColumn("v", F.repeat(F.lit("x"), (F.col("id") % 900).cast("int")))
    failing = lambda s, d, t: rows_.filter(F.assert_true(F.col("id") < 1_999).isNull())
    (out,) = inventory.export(listed(spark, ("d", "t")), failing, root, max_bytes=5_000).collect()
    assert out.status == "failed" and out.error
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(f"{root}/d/t")


def test_inventory_from_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS listed")
    spark.sql("CREATE DATABASE IF NOT EXISTS nothing")
    try:
        spark.range(3).write.mode("overwrite").saveAsTable("listed.first")
        spark.range(0).write.mode("overwrite").saveAsTable("listed.empty")
        spark.sql("CREATE VIEW listed.seen AS SELECT * FROM listed.first")
        spark.range(3, 5).write.mode("append").saveAsTable("listed.first")
        out = inventory_from_catalog(spark, "p")
        assert out.schema.simpleString() == schemas.INVENTORY.simpleString()
        found = {(r.dataset_id, r.table_id): r for r in out.collect()}
        assert found["nothing", None].table_type is None
        table, view, odd = (found["listed", n] for n in ("first", "seen", "empty"))
        assert (table.table_type, view.table_type, odd.table_type) == ("TABLE", "VIEW", "TABLE")
        assert view.created == view.modified and odd.created is not None
        assert table.created.replace(microsecond=0) <= table.modified and table.modified > table.created
        later = F.expr("current_timestamp() + INTERVAL 40 DAYS")
        aged = {r.table_id: r for r in inventory.table_ages(out, later, "listed").collect()}
        assert set(aged) == {"first", "seen", "empty"}
        assert aged["first"].days_since_created in (39, 40) and "last modified" in aged["first"].message
    finally:
        spark.sql("DROP DATABASE listed CASCADE")
        spark.sql("DROP DATABASE nothing CASCADE")


# --- sources and sinks -----------------------------------------------------------------

def test_schema_drift_fails_before_running(spark):
    with pytest.raises(schemas.SchemaDrift, match="url: missing"):
        schemas.conform(spark.range(1).select(F.lit("1").alias("company_id")), schemas.PATENTS)
    with pytest.raises(schemas.SchemaDrift, match="url: int, declared string"):
        schemas.conform(spark.createDataFrame([("1", 1)], "company_id string, url int"), schemas.PATENTS)


def test_parameters_are_values_not_text(spark):
    given = spark.createDataFrame([("a",), ("x' OR '1'='1",)], "s string")
    out = scan_sql(spark, "SELECT s FROM {rows} WHERE s = :v", {"rows": given}, {"v": "x' OR '1'='1"})
    assert [r.s for r in out.collect()] == ["x' OR '1'='1"]


def test_csv_keeps_texts_and_reads_empty_as_missing(spark):
    kind = schemas.struct(k=schemas.TEXT, v=schemas.TEXT)
    data = [("1", ' a "quoted", text\nwith lines '), ("2", ""), ("3", None), ("4", "[]"), ("5", "back\\slash,\\\"")]
    path = write_csv(from_records(spark, data, kind), shared_dir(spark, "csv-test"))
    data[1] = ("2", None)
    assert rows(scan_csv(spark, path, kind, multi_line=True)) == data


def test_index_column_and_bad_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",k,n\n0,a,1\n1,b,2\n")
    kind = schemas.struct(k=schemas.TEXT, n=schemas.WHOLE)
    assert rows(scan_csv(spark, str(tmp_path / "a.csv"), kind, index_column=True)) == [("a", 1), ("b", 2)]
    (tmp_path / "c.csv").write_text("k,other\na,1\n")
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, str(tmp_path / "c.csv"), kind).collect()
    (tmp_path / "b.csv").write_text("k,n\na,one\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        scan_csv(spark, str(tmp_path / "b.csv"), kind).collect()


def test_a_frame_may_replace_what_it_reads(spark):
    path = write_table(spark.range(3), shared_dir(spark, "sink-test"))
    write_table(scan_table(spark, path).filter("id > 0"), path)
    assert rows(scan_table(spark, path)) == [(1,), (2,)]
    write_table(spark.range(2), path)
    assert scan_table(spark, path).count() == 2
    write_table(spark.range(7, 8), path, mode="append")
    assert rows(scan_table(spark, path)) == [(0,), (1,), (7,)]
    with pytest.raises(Exception, match="DIVIDE|zero"):
        write_table(scan_table(spark, path).selectExpr("1 div (id - 7) AS id"), path)
    assert rows(scan_table(spark, path)) == [(0,), (1,), (7,)]


def test_a_table_may_replace_itself(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS sinks")
    try:
        write_table(spark.range(3), "sinks.t")
        write_table(scan_table(spark, "sinks.t").filter("id > 0"), "sinks.t")
        write_table(spark.range(9, 10), "sinks.t", mode="append")
        assert rows(scan_table(spark, "sinks.t")) == [(1,), (2,), (9,)]
    finally:
        spark.sql("DROP DATABASE sinks CASCADE")


def part_sizes(path):
    import glob
    import os

    return [os.path.getsize(f) for f in glob.glob(f"{path}/part-*")]


@pytest.mark.parametrize("one_line", [False, True])
def test_csv_files_are_bounded_in_bytes(spark, one_line):
    kind = schemas.struct(k=schemas.TEXT, v=schemas.TEXT)
    data = [(str(n), f'line "{n}"\nand \\n more, é' * (n % 7)) for n in range(900)]
    data += [("long", "x\n" * 30_000), ("half", "y" * 2_500)]
    path = shared_dir(spark, "csv-bounded")
    header = len("k,v\n")
    write_csv(from_records(spark, data, kind).repartition(3), path, max_bytes=4_000, one_line=one_line)
    sizes = sorted(part_sizes(path))
    assert sizes[-1] > 60_000 and sizes[-2] <= 4_000 + header and len(sizes) > 10
    back = scan_csv(spark, path, kind, multi_line=not one_line, one_line=one_line)
    assert rows(back) == sorted((k, v or None) for k, v in data)
    write_csv(from_records(spark, data, kind).repartition(3), path)
    assert len(part_sizes(path)) <= 3 and scan_csv(spark, path, kind, multi_line=True).count() == len(data)
    write_csv(from_records(spark, [], kind), path)
    assert scan_csv(spark, path, kind).count() == 0


def test_line_escapes_come_back(spark):
    from curatrix.functions.text import escape_lines, unescape_lines

    texts = ["", "a\nb", "\\n", "\\\n", "\r\n\\r\\\\", "\x00\x01\\n", "\x00", "plain", "\\\\n\n"]
    given = spark.createDataFrame([(t,) for t in texts], "t string")
    out = given.select("t", escape_lines(F.col("t")).alias("e")).select("t", "e", unescape_lines(F.col("e")).alias("b")).collect()
    assert all(r.t == r.b and "\n" not in r.e and "\r" not in r.e for r in out)


def test_intermediate_tables_are_forgotten(spark, tmp_path, monkeypatch):
    from curatrix import session

    monkeypatch.setattr(session, "_root", lambda _: str(tmp_path))
    first, second = session.materialise(spark.range(3), "a"), session.materialise(spark.range(4), "b")
    (tmp_path / "other-application").mkdir()
    session.forget(first)
    assert second.count() == 4 and len(list(tmp_path.iterdir())) == 2
    assert session.forget_all(spark) == 1 and [p.name for p in tmp_path.iterdir()] == ["other-application"]


def test_names_are_parameters_too(spark):
    spark.range(3).createOrReplaceTempView("named_rows")
    sql = "SELECT IDENTIFIER(:column) AS v FROM IDENTIFIER(:table) WHERE id > :least"
    out = scan_sql(spark, sql, args={"table": "named_rows", "column": "id", "least": 0})
    assert rows(out) == [(1,), (2,)]
    for hostile in ("named_rows; DROP VIEW named_rows", "named_rows WHERE 1 = 1", "(SELECT 1)"):
        with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
            scan_sql(spark, sql, args={"table": hostile, "column": "id", "least": 0})
    assert spark.table("named_rows").count() == 3


def test_empty_records_keep_their_columns(spark):
    assert from_records(spark, [], schemas.EVENTS_RAW).columns == ["name", "date", "company_id", "event"]
