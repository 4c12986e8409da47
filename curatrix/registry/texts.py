"""Texts and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from curatrix.operators.domains import read_suffix_rules, unruled_hosts, with_domains
from curatrix.operators.pages import links, page_text, sections, table_rows
from curatrix.operators.relevance import fit_odds, label_by_rule
from curatrix.operators.summaries import summarise
from curatrix.operators.terms import keyword_tags, without_tags
from curatrix.plans.articles import with_prompt
from curatrix.plans.mentions import mentions
from curatrix.registry import inputs as i
from curatrix.registry.base import query

TAGS = {"LICENSE": ["license", "Copyright"], "CONTACT": ["@", "Phone"], "THE": ["the "]}
RULE_TERMS = ("license", "http", "@", "copyright")
CUES = ("license", "the ")


@query(
    "page_rows",
    """SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos,
              replace(replace(items[pos], '&amp;', '&'), '&quot;', '"') AS row_text
       FROM (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS pos FROM (
           SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1) AS items FROM pages))""",
)
def page_rows(t):
    rows = table_rows(t.pages, key="page_id", card=("nav", ""), row="li")
    return rows.withColumn("pos", F.col("pos").cast("long"))


@query(
    "page_links",
    """SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos,
              replace(replace(found[pos], '&amp;', '&'), '&quot;', '"') AS link
       FROM (SELECT page_id, found, unnest(range(1, len(found) + 1)) AS pos FROM (
           SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS found FROM pages))""",
)
def page_links(t):
    return links(t.pages, "page_id").withColumn("pos", F.col("pos").cast("long"))


@query(
    "page_text",
    f"""WITH bodies AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '^.*?<body>', '', 's'),
                           '</body>.*$', '', 's'), '<!--.*?-->', '', 'gs') AS body FROM pages),
        pieces AS (SELECT page_id, list_transform(regexp_split_to_array(body, '<[^>]*>'), lambda x: trim(
                       replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'),
                       {i.SPACES})) AS found FROM bodies)
        SELECT page_id, array_to_string(list_filter(found, lambda x: x <> ''), ' ') AS content FROM pieces""",
)
def page_text_query(t):
    return page_text(sections(t.pages, "page_id", tag="body"))


@query(
    "page_links_class",
    f"""SELECT DISTINCT '{i.ARTICLE_BASE.removesuffix("index.html")}' || doc_id AS link FROM documents WHERE lang <> 'es'""",
)
def page_links_class(t):
    """Links of one class, relative and absolute, found on index pages."""
    from curatrix.plans.mentions import index_links

    return index_links(i.index_pages(t), i.ARTICLE_CLASS, i.ARTICLE_BASE)


@query("article_text", i.ARTICLE_TEXT_SQL)
def article_text(t):
    from curatrix.plans.mentions import article_texts

    return article_texts(i.article_pages(t), drop_ids=("about-us",), drop_heading="OUR TEAM")


@query(
    "registered_domain",
    """SELECT page_id, regexp_extract(url, '([^./]+)\\.example\\.(com|net|org)', 1) AS label FROM pages""",
)
def registered_domain(t):
    return with_domains(t.pages, "url", i.test_suffix_rules(t), "label").select("page_id", "label")


SUFFIX_CASES_SQL = """
    hosts AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS h FROM pages),
    cases AS (
        SELECT page_id, CASE page_id % 7 WHEN 1 THEN upper(h) WHEN 2 THEN replace(h, 'example.com', 'blog.example.com')
            WHEN 3 THEN regexp_replace(h, '[a-z]+$', 'zz') WHEN 4 THEN 'a.b.' || h
            WHEN 5 THEN regexp_extract(h, 'example.*') ELSE h END AS host FROM hosts
    ),
    rules(base, kind) AS (VALUES ('com', 0), ('net', 0), ('org', 0), ('example.com', 1), ('blog.example.com', -1), ('example.org', 0)),
    split AS (SELECT page_id, host, string_split(host, '.') AS l FROM cases),
    held AS (
        SELECT page_id, coalesce(max(k - 1) FILTER (kind = -1), max(k + kind)) AS k FROM (
            SELECT page_id, kind, len(string_split(base, '.')) AS k, len(l) AS n
            FROM split JOIN rules ON lower(host) = base OR ends_with(lower(host), '.' || base)
        ) WHERE k + kind <= n GROUP BY page_id
    ),
    parted AS (
        SELECT s.page_id, lower(host) AS host, CASE WHEN k < len(l) THEN l[len(l) - k] END AS label,
               CASE WHEN k IS NOT NULL THEN array_to_string(l[len(l) - k + 1:], '.') END AS suffix
        FROM split s LEFT JOIN held h ON s.page_id = h.page_id
    )"""


@query("domain_suffixes", f"WITH {SUFFIX_CASES_SQL} SELECT page_id, label, suffix FROM parted")
def domain_suffixes(t):
    """Labels and suffixes by a list file with wildcard, exception and private rules."""
    rules = read_suffix_rules(t.spark, i.suffix_list_file(t))
    found = with_domains(i.suffix_cases(t), "url", rules, "label", "suffix", guess=False)
    return found.select("page_id", "label", "suffix")


@query(
    "unruled_hosts",
    f"""WITH {SUFFIX_CASES_SQL}
        SELECT host, CASE WHEN suffix IS NULL THEN 'no rule' ELSE 'is a suffix' END AS reason, count(*) AS n
        FROM parted WHERE label IS NULL GROUP BY ALL""",
)
def unruled_hosts_query(t):
    return unruled_hosts(i.suffix_cases(t), "url", read_suffix_rules(t.spark, i.suffix_list_file(t)))


MENTIONS_SQL = f"""
    WITH {i.ALIASES_SQL},
    hits AS (SELECT doc_id, string_agg(DISTINCT company, '|' ORDER BY company) AS mentions
             FROM documents JOIN aliases ON contains(text, alias) AND alias <> '' GROUP BY doc_id)
    SELECT d.doc_id, coalesce(mentions, '') AS mentions FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id"""


def _mentions(t, way="join"):
    texts = t.documents.select("doc_id", "text")
    found = mentions(texts, i.alias_companies(t), text="text", way=way)
    return found.select("doc_id", F.array_join("banks_mentioned", "|").alias("mentions"))


@query("mentions", MENTIONS_SQL)
def mentions_query(t):
    return _mentions(t)


@query("mentions_scanned", MENTIONS_SQL)
def mentions_scanned(t):
    return _mentions(t, "shipped")


@query(
    "mentions_joined",
    f"""
    WITH {i.ALIASES_SQL},
    texts AS (SELECT CASE WHEN doc_id % 3 > 0 THEN lang END AS k, text FROM documents),
    found AS (SELECT k, (SELECT string_agg(DISTINCT company, '|' ORDER BY company) FROM aliases
                         WHERE contains(text, alias) AND alias <> '') AS m FROM texts)
    SELECT k, coalesce(m, '') AS mentions, count(*) AS n FROM found GROUP BY ALL""",
)
def mentions_joined(t):
    """Texts whose key repeats or is null; each has the names of its own text."""
    key = F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("k")
    found = mentions(t.documents.select(key, "text"), i.alias_companies(t), text="text")
    return found.groupBy("k", F.array_join("banks_mentioned", "|").alias("mentions")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "keyword_table_tags",
    f"""
    WITH {i.ALIASES_SQL}
    SELECT doc_id, coalesce((SELECT string_agg(DISTINCT company, '|' ORDER BY company) FROM aliases
                             WHERE contains(lower(text), lower(alias)) AND alias <> ''), '') AS tags FROM documents""",
)
def keyword_table_tags(t):
    from curatrix.operators.terms import add_keyword_tags
    from curatrix.plans.mentions import company_aliases

    keywords = company_aliases(i.alias_companies(t), "bank")
    tagged = add_keyword_tags(t.documents.select("doc_id", "text"), "text", keywords, "company", "possible_name")
    return tagged.select("doc_id", F.array_join("tags", "|").alias("tags"))


TAGS_SQL = """
    tagged AS (SELECT doc_id, list_filter([
        CASE WHEN contains(lower(text), 'license') OR contains(lower(text), 'copyright') THEN 'LICENSE' END,
        CASE WHEN contains(text, '@') OR contains(lower(text), 'phone') THEN 'CONTACT' END,
        CASE WHEN contains(lower(text), 'the ') THEN 'THE' END], lambda x: x IS NOT NULL) AS tags
        FROM documents)"""


@query("keyword_tags", f"WITH {TAGS_SQL} SELECT doc_id, array_to_string(tags, '|') AS tags FROM tagged")
def keyword_tags_query(t):
    return t.documents.select("doc_id", F.array_join(keyword_tags(F.col("text"), TAGS), "|").alias("tags"))


@query("keyword_exclude", f"WITH {TAGS_SQL} SELECT doc_id FROM tagged WHERE len(tags) = 0")
def keyword_exclude(t):
    tagged = t.documents.select("doc_id", keyword_tags(F.col("text"), TAGS).alias("tags"))
    return without_tags(tagged, "tags").select("doc_id")


RULE_SQL = """CASE WHEN hits >= 2 THEN 'Yes' WHEN hits >= 1 THEN 'Unsure' ELSE 'No' END"""
HITS_SQL = """(contains(lower({0}), 'license')::INT + contains(lower({0}), 'http')::INT
       + contains(lower({0}), '@')::INT + contains(lower({0}), 'copyright')::INT)"""


@query(
    "relevance_rule",
    f"""SELECT doc_id, {RULE_SQL} AS relevance
        FROM (SELECT doc_id, {HITS_SQL.format('text')} AS hits FROM documents)""",
)
def relevance_rule(t):
    return t.documents.select("doc_id", label_by_rule(F.col("text"), RULE_TERMS).alias("relevance"))


ERROR_RATE = 0.1

# Words weigh by the labels of one part of the texts, are calibrated on another, and
# label all. The isotonic share of a bin is the largest, over the bins up to it, of the
# smallest mean from there to a bin at or above it.
ODDS_SQL = """
    parted AS (SELECT doc_id, text, quality, substring(md5(text), 1, 1) < '8' AS held
               FROM documents LEFT JOIN labels USING (doc_id)),
    said AS (SELECT doc_id, quality, held, unnest(list_distinct(regexp_split_to_array(lower(text), '\\s+'))) AS word
             FROM parted),
    size AS (SELECT count(*) FILTER (quality = 1) AS ones, count(*) FILTER (quality = 0) AS zeros
             FROM parted WHERE NOT held),
    odds AS (SELECT word, CAST(round((ln((count(*) FILTER (quality = 1) + 1) / (any_value(ones) + 2))
                                      - ln((count(*) FILTER (quality = 0) + 1) / (any_value(zeros) + 2))) * 1000000) AS BIGINT) AS weight
             FROM said, size WHERE NOT held AND quality IN (0, 1) GROUP BY word),
    binned AS (SELECT doc_id, greatest(least(CAST(floor(sum(weight) / (count(*) * 20000)) AS INTEGER), 100), -100) AS bin
               FROM said JOIN odds USING (word) GROUP BY doc_id),
    bins AS (SELECT bin, count(*) AS n, sum(quality) AS hits FROM binned JOIN parted USING (doc_id)
             WHERE held AND quality IN (0, 1) GROUP BY bin),
    spans AS (SELECT a.bin AS low, b.bin AS high, sum(c.hits) / sum(c.n) AS mean
              FROM bins a JOIN bins b ON a.bin <= b.bin JOIN bins c ON c.bin BETWEEN a.bin AND b.bin GROUP BY ALL),
    shares AS (SELECT bin, CAST(round(max(least_mean) * 1000000) AS BIGINT) AS share FROM (
                   SELECT t.bin, low, min(mean) AS least_mean FROM bins t JOIN spans ON low <= t.bin AND high >= t.bin
                   GROUP BY t.bin, low) GROUP BY bin),
    known AS (SELECT doc_id, max(s.bin) AS bin FROM binned b JOIN shares s
              ON s.bin <= greatest(b.bin, (SELECT min(bin) FROM shares)) GROUP BY doc_id),
    shared AS (SELECT p.doc_id, share FROM parted p LEFT JOIN known USING (doc_id) LEFT JOIN shares USING (bin)),
    labelled AS (SELECT doc_id, share, CASE WHEN share >= 900000 THEN 'Yes' WHEN share <= 100000 THEN 'No' ELSE 'Unsure' END
                 AS relevance FROM shared)"""


def odds_scorer(t):
    rows = t.documents.join(t.labels, "doc_id").select("text", "quality")
    return fit_odds(rows, "text", "quality", ERROR_RATE, calibrated=F.substring(F.md5("text"), 1, 1) < "8")


@query("relevance_ml", f"WITH {ODDS_SQL} SELECT doc_id, share, relevance FROM labelled")
def relevance_ml(t):
    """Labels of all texts by a fitted scorer, and the calibrated share behind them."""
    found = odds_scorer(t).label(t.documents.select("doc_id", "text"), "text", share="share")
    return found.select("doc_id", "share", "relevance")


@query(
    "render_template",
    """SELECT doc_id, CASE WHEN lang IN ('en', 'fr') THEN
              md5('Sector ' || lang || ': summarise <article>' || text || '</article> for ' || lang) END AS prompt
       FROM documents""",
)
def render_template(t):
    template = "Sector {lang}: summarise <article>{text}</article> for {lang}"
    templates = t.spark.createDataFrame([("en", template), ("fr", template)], "lang string, template string")
    rows = with_prompt(t.documents.select("doc_id", "lang", F.col("text").alias("body")), templates, "lang")
    return rows.select("doc_id", F.md5("prompt").alias("prompt"))


SENTENCES_SQL = """
    found AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(
                  regexp_replace(text, '([A-Za-zÀ-ÿ]{2}|[^A-Za-zÀ-ÿ\\s])([.!?]+["'')\\]]*)[ \t]+', '\\1\\2' || chr(10), 'g'),
                  '\n'), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents),
    sentences AS (SELECT doc_id, pos, s[pos] AS sentence
                  FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS pos FROM found))"""


@query(
    "summarise_topk",
    f"""WITH {SENTENCES_SQL},
        best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length(sentence) DESC, pos) AS nth
                 FROM sentences),
        joined AS (SELECT doc_id, string_agg('•' || sentence, chr(10) ORDER BY pos) AS summary
                   FROM best WHERE nth <= 3 GROUP BY doc_id)
        SELECT d.doc_id, summary FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id""",
)
def summarise_topk(t):
    rows = summarise(t.documents.select("doc_id", "text"), "text", score="length", by_position=True)
    return rows.select("doc_id", "summary")


RARITY_SQL = f"""
    {SENTENCES_SQL},
    doc_words AS (SELECT DISTINCT doc_id, w AS b
                  FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents)),
    weights AS (SELECT b, CAST(round(ln((SELECT count(text) FROM documents) / count(*)) * 1000000) AS BIGINT) AS idf
                FROM doc_words GROUP BY b),
    sentence_words AS (SELECT doc_id, pos, w AS b
                       FROM (SELECT doc_id, pos, unnest(string_split(lower(sentence), ' ')) AS w FROM sentences)),
    rarity AS (SELECT doc_id, pos, sum(coalesce(idf, 0)) AS score
               FROM sentence_words LEFT JOIN weights USING (b) GROUP BY doc_id, pos),
    scored AS (SELECT s.*, score + CASE WHEN contains(lower(sentence), 'license') THEN 20000000 ELSE 0 END
                      + CASE WHEN contains(lower(sentence), 'the ') THEN 20000000 ELSE 0 END AS score
               FROM sentences s JOIN rarity r ON s.doc_id = r.doc_id AND s.pos = r.pos),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS nth FROM scored),
    summed AS (SELECT doc_id, string_agg('•' || sentence, chr(10) ORDER BY nth) AS summary
               FROM ranked WHERE nth <= 3 GROUP BY doc_id)"""


@query(
    "summarise_rarity",
    f"WITH {RARITY_SQL} SELECT d.doc_id, summary FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id",
)
def summarise_rarity(t):
    return summarise(t.documents.select("doc_id", "text"), "text", cues=CUES).select("doc_id", "summary")


MMR_SQL = f"""
    WITH {SENTENCES_SQL},
    rated AS (SELECT doc_id, pos, sentence, length(sentence) AS score,
                     list_distinct(string_split(lower(sentence), ' ')) AS w FROM sentences),
    r1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS nth FROM rated),
    one AS (SELECT doc_id, pos AS p1, sentence AS s1, w AS w1 FROM r1 WHERE nth = 1),
    r2 AS (SELECT r.*, p1, s1, w1, row_number() OVER (PARTITION BY r.doc_id ORDER BY
               floor(score * (len(w) - len(list_intersect(w, w1))) / len(w)) DESC, pos) AS nth
           FROM rated r JOIN one USING (doc_id) WHERE pos <> p1),
    two AS (SELECT doc_id, pos AS p2, sentence AS s2, list_distinct(list_concat(w1, w)) AS w2 FROM r2 WHERE nth = 1),
    r3 AS (SELECT r.*, w2, row_number() OVER (PARTITION BY r.doc_id ORDER BY
               floor(score * (len(w) - len(list_intersect(w, w2))) / len(w)) DESC, pos) AS nth
           FROM rated r JOIN one USING (doc_id) JOIN two USING (doc_id) WHERE pos NOT IN (p1, p2)),
    three AS (SELECT doc_id, sentence AS s3 FROM r3 WHERE nth = 1)
    SELECT d.doc_id, CASE WHEN s1 IS NOT NULL THEN concat_ws(chr(10), '•' || s1, '•' || s2, '•' || s3) END AS summary
    FROM documents d LEFT JOIN one USING (doc_id) LEFT JOIN two USING (doc_id) LEFT JOIN three USING (doc_id)"""


@query("summarise_mmr", MMR_SQL)
def summarise_mmr(t):
    """Three bullets of which none repeats another."""
    rows = summarise(t.documents.select("doc_id", "text"), "text", score="length", diverse=True)
    return rows.select("doc_id", "summary")
