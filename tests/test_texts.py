"""Dictionary matching, domains, pages and summaries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from curatrix.operators import pages, rolling, terms
from curatrix.operators.domains import SuffixTrie, host_of, suffix_rules, unruled_hosts, with_domains
from curatrix.operators.summaries import sentences, summarise

WAYS = ["scan", "join", "shipped"]


def brute_force(texts, dictionary, fold=lambda s: s):
    return {
        k: sorted({n for n, t in dictionary if n is not None and t and text and fold(t) in fold(text)})
        for k, text in texts
    }


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("ignore_case", [False, True])
def test_ways_agree_with_brute_force(spark, way, ignore_case):
    draw = random.Random(19)
    word = lambda n: "".join(draw.choices("abAé😀 \n.", k=n))
    texts = [(i, word(draw.randrange(0, 60))) for i in range(60)]
    # One text that spans several pieces, with a term across a piece border.
    long = "x" * (rolling._PIECE - 3) + "across the border" + "y" * (2 * rolling._PIECE) + "end"
    texts += [(100, long), (101, None), (102, "")]
    dictionary = [(f"n{draw.randrange(12)}", word(draw.randrange(0, 7))) for _ in range(60)]
    dictionary += [("border", "across the border"), ("tail", "yend"), (None, "x"), ("null", None), ("blank", "")]
    found = terms.add_names(
        spark.createDataFrame(texts, "k int, body string"), "body",
        spark.createDataFrame(dictionary, "name string, term string"), "name", "term", "names",
        ignore_case=ignore_case, way=way,
    )
    fold = str.lower if ignore_case else (lambda s: s)
    assert {r.k: r.names for r in found.collect()} == brute_force(texts, dictionary, fold)


def test_terms_of_one_length_and_an_empty_dictionary(spark):
    texts = spark.createDataFrame([(1, "banker"), (2, "BANK")], "k int, body string")
    for words, names in ((["bank"], [["B"], []]), ([], [[], []])):
        dictionary = spark.createDataFrame([("B", w) for w in words], "name string, term string")
        for way in WAYS:
            out = terms.add_names(texts, "body", dictionary, "name", "term", "names", way=way)
            assert [r.names for r in out.orderBy("k").collect()] == names


@pytest.mark.parametrize("way", WAYS)
def test_each_row_has_its_own_names(spark, way):
    rows = [("k", "Alpha here"), ("k", "Beta here"), (None, "Alpha again"), (None, "Alpha again"), ("k", None)]
    texts = spark.createDataFrame(rows, "k string, body string")
    dictionary = spark.createDataFrame([("A", "Alpha"), ("B", "Beta")], "name string, term string")
    out = terms.add_names(texts, "body", dictionary, "name", "term", "names", way=way).collect()
    assert sorted(((r.k, r.body, r.names) for r in out), key=repr) == sorted(
        [("k", "Alpha here", ["A"]), ("k", "Beta here", ["B"]), (None, "Alpha again", ["A"]), (None, "Alpha again", ["A"]), ("k", None, [])],
        key=repr,
    )


def test_narrow_ways_refuse_a_dictionary_beyond_their_bounds(spark):
    texts = spark.createDataFrame([("a",)], "body string")
    many = spark.range(terms.SCAN_TERMS + 1).select(F.lit("n").alias("name"), F.col("id").cast("string").alias("term"))
    with pytest.raises(ValueError, match="too many"):
        terms.add_names(texts, "body", many, "name", "term", "names", way="scan")


@pytest.mark.parametrize(
    ("domain", "label"),
    [
        ("news.bbc.co.uk", "bbc"),
        ("https://a:b@x.bbc.co.uk:80/p", "bbc"),
        ("x.co.uk", "x"),
        ("bbc.com", "bbc"),
        ("localhost", "localhost"),
        ("bbc.zz", "zz"),
        ("co.uk", "co.uk"),
        ("com", "com"),
        ("a.b.foo.ck", "b"),
        ("www.ck", "www"),
        ("a.www.ck", "www"),
        ("10.0.0.1", "10.0.0.1"),
        ("News.BBC.Co.UK", "BBC"),
        ("", ""),
    ],
)
def test_registered_domains(spark, domain, label):
    given = spark.createDataFrame([(domain,), (None,)], "d string")
    out = with_domains(given, "d", suffix_rules(spark), "label").collect()
    assert sorted(map(tuple, out), key=repr) == sorted([(domain, label), (None, None)], key=repr)


def longest_rule(labels, rules):
    """Labels of the suffix, rule by rule."""
    found, exception = 0, None
    for rule in rules:
        bare = rule.removeprefix("*.").removeprefix("!").split(".")
        if labels[-len(bare):] != bare:
            continue
        if rule.startswith("!"):
            exception = max(exception or 0, len(bare) - 1)
        elif not rule.startswith("*."):
            found = max(found, len(bare))
        elif len(labels) > len(bare):
            found = max(found, len(bare) + 1)
    return found if exception is None else exception


def test_trie_equals_reading_all_rules():
    draw = random.Random(6)
    name = lambda n: ".".join(draw.choice(["a", "b", "ab", "a-b", "c0"]) for _ in range(n))
    for _ in range(200):
        bases = {name(draw.randrange(1, 4)) for _ in range(draw.randrange(0, 12))}
        rules = [r for b in bases for r in draw.choice([[b], [f"*.{b}"], [b, f"*.{b}"], [f"*.{b}", f"!x.{b}"]])]
        trie = SuffixTrie.of(rules)
        for _ in range(40):
            labels = name(draw.randrange(1, 6)).split(".")
            labels = ["x", *labels] if draw.random() < 0.3 else labels
            assert trie.suffix_size(labels) == longest_rule(labels, rules), (labels, rules)


def test_hosts_without_a_rule_are_reported(spark):
    urls = ["http://bbc.zz/a", "https://BBC.zz", "co.uk", "x.co.uk", "10.0.0.1", "[::1]:80", "http://", None]
    given = spark.createDataFrame([(u,) for u in urls], "d string")
    out = unruled_hosts(given, "d", suffix_rules(spark)).collect()
    assert sorted(map(tuple, out)) == [("", "no host", 1), ("bbc.zz", "no rule", 2), ("co.uk", "is a suffix", 1)]
    plain = with_domains(given, "d", suffix_rules(spark), "label", "suffix", guess=False)
    found = {r.d: (r.label, r.suffix) for r in plain.collect()}
    assert found["10.0.0.1"] == ("10.0.0.1", None) and found["[::1]:80"] == ("[::1]", None)
    assert found["co.uk"] == (None, "co.uk") and found["x.co.uk"] == ("x", "co.uk") and found[None] == (None, None)


def test_too_many_rules_are_refused(spark, monkeypatch):
    from curatrix.operators import domains

    monkeypatch.setattr(domains, "MOST_RULES", 3)
    with pytest.raises(ValueError, match="too many"):
        with_domains(spark.createDataFrame([("a.com",)], "d string"), "d", suffix_rules(spark), "label")


def test_host(value):
    assert value(host_of, "HTTP://u@H.x:9/p?q#f") == "H.x"


def page(spark, html, **more):
    return spark.createDataFrame([("u", html)], "url string, html string")


CARD = '<div class="x"><div id="next-events-card"><div><table><tr><th>D</th></tr>%s</table></div></div></div>'


def test_card_rows_through_nested_elements(spark):
    html = "<tr><td>no</td></tr>" + CARD % "<tr><td>a &amp; b</td><td>c</td></tr>" + "<tr><td>no</td></tr>"
    html += CARD % "<tr><td>second card</td></tr>"
    out = pages.table_rows(page(spark, html)).orderBy("pos").collect()
    assert [r.row_text for r in out] == ["D", "a & bc"]


def test_no_card_no_rows_and_only_status_200(spark):
    assert pages.table_rows(page(spark, "<table><tr><td>x</td></tr></table>")).count() == 0
    given = spark.createDataFrame(
        [("a", 404, CARD % ""), ("b", 200, CARD % ""), ("c", None, CARD % ""), ("d", 200, None)],
        "url string, status int, html string",
    )
    assert [r.url for r in pages.table_rows(given).collect()] == ["b"]


def test_row_without_second_block(spark):
    given = spark.createDataFrame(
        [("u", "1/1/2024\n\nQ1"), ("u", "1/1/2024 only"), ("v", "2/1/2024\nx\n\nQ2")], "url string, row_text string"
    )
    kept = pages.split_row(given, F.col("row_text"))
    assert {(r.date, r.event) for r in kept.collect()} == {("1/1/2024", "Q1"), ("2/1/2024", "Q2")}
    strict = pages.split_row(given, F.col("row_text"), strict_by="url")
    assert [r.url for r in strict.collect()] == ["v"]
    assert [r.row_text for r in pages.rejected_rows(given, F.col("row_text")).collect()] == ["1/1/2024 only"]


def test_links_by_class_in_order(spark):
    html = (
        '<a class="l no" href="/1">x</a><a class="l  no" href="">y</a><p class="l no" href="/2?a&amp;b"></p>'
        '<a class="no l" href="/3"></a><a href="/4"></a><a class="l no" href="/1"></a><!-- <a class="l no" href="/5"> -->'
    )
    out = pages.links(page(spark, html), "url", "l no").orderBy("pos").collect()
    assert [r.link for r in out] == ["/1", "/2?a&b", "/1"]
    assert [r.link for r in pages.links(page(spark, html), "url").orderBy("pos").collect()] == ["/1", "/3", "/4", "/1"]


SECTIONS = (
    '<div class="nws-container a" id="lead"><h2> Top </h2><p>one<br>two</p><script>no</script>'
    '<div class="nws-container">inner<h2>Second</h2></div></div>'
    '<div class="nws-container" id="about"><p>about</p></div>'
    '<div class="nws-container"><h2>OUR TEAM</h2>names</div>'
    '<div class="nws-container"><h2></h2>blank</div>'
    '<div class="nws-container-x">other</div><div class="nws-container">open <b>end'
)


def test_sections_keep_nested_text_and_first_heading(spark):
    found = pages.sections(page(spark, SECTIONS), "url", class_token="nws-container").first().sections
    assert [(s.section_id, s.heading, s.body) for s in found] == [
        ("lead", "Top", "Top one two inner Second"),
        (None, "Second", "inner Second"),
        ("about", None, "about"),
        (None, "OUR TEAM", "OUR TEAM names"),
        (None, "", "blank"),
        (None, None, "open end"),
    ]


def test_unwanted_sections(spark):
    read = pages.sections(page(spark, SECTIONS), "url", class_token="nws-container")
    exact = pages.page_text(read, ("about",), "OUR TEAM").first().content
    assert exact == "Top one two inner Second inner Second blank open end"
    within = pages.page_text(read, ("about",), "OUR TEAM", heading_within=True).first().content
    assert within == "Top one two inner Second inner Second open end"
    assert pages.page_text(pages.sections(page(spark, None), "url", class_token="x")).first().content == ""


def test_summaries_rank_and_nulls(spark):
    data = [(1, "Short. The longest sentence of them all! Mid size one? no end"), (2, "nothing here"), (3, None)]
    given = spark.createDataFrame(data, "k int, body string")
    best = {r.k: r.summary for r in summarise(given, "body", k=2, score="length").collect()}
    assert best == {1: "•The longest sentence of them all!\n•Mid size one?", 2: "•nothing here", 3: None}
    cued = summarise(given, "body", k=1, cues=["short"]).filter("k = 1").first().summary
    assert cued == "•Short."
    with pytest.raises(ValueError):
        summarise(given, "body", score="x")


def test_long_line_without_end_mark_is_read_once(spark):
    given = spark.createDataFrame([(1, "a" * 400_000 + "\nDone.")], "k int, body string")
    assert summarise(given, "body", score="length").first().summary == "•" + "a" * 400_000 + "\n•Done."


def test_unclosed_rows_are_read_in_one_pass(spark):
    rows = "".join(f"<tr><td>{i}<td>x" for i in range(50_000))
    given = page(spark, f'<div id="card"><table>{rows}</table></div>')
    found = pages.table_rows(given, "url", card=("div", "card"), row="tr")
    assert found.count() == 50_000 and found.filter("pos = 7").first().row_text == "7x"


def test_attributes_with_entities_are_found(spark):
    given = page(spark, '<a class="text&#45;black x" href="/a">t</a><div id="ca&#114;d"><p>r</p></div>')
    assert [r.link for r in pages.links(given, "url", "text-black x").collect()] == ["/a"]
    assert [r.row_text for r in pages.table_rows(given, "url", card=("div", "card"), row="p").collect()] == ["r"]


def test_suffix_file(spark, tmp_path):
    from curatrix.operators.domains import read_suffix_rules

    listed = "// ===BEGIN ICANN DOMAINS===\n\nse\n*.ck extra words\n!www.ck\nco.uk\n// ===BEGIN PRIVATE DOMAINS===\nshop.se\n"
    (tmp_path / "list").write_text(listed)
    rules = read_suffix_rules(spark, str(tmp_path / "list"))
    assert {r.rule for r in rules.collect()} == {"se", "*.ck", "!www.ck", "co.uk", "shop.se"}
    assert read_suffix_rules(spark, str(tmp_path / "list"), with_private=False).count() == 4
    hosts = spark.createDataFrame([("news.dn.se",), ("bbc.co.uk.",), ("a.shop.se",)], "url string")
    assert {r.url: r.label for r in with_domains(hosts, "url", rules, "label").collect()} == {
        "news.dn.se": "dn", "bbc.co.uk.": "bbc", "a.shop.se": "a",
    }


def test_sentences_are_whole(spark):
    text = 'Revenue rose 3.5% to $1.5bn in the U.S. market. It said "no!" Then?  Ok.\nA heading\n\nand an open end'
    given = spark.createDataFrame([(text,)], "body string")
    assert given.select(sentences(F.col("body")).alias("s")).first().s == [
        "Revenue rose 3.5% to $1.5bn in the U.S. market.", 'It said "no!"', "Then?", "Ok.", "A heading", "and an open end",
    ]


def test_only_rare_words_are_shuffled_to_their_weights(spark, monkeypatch):
    """With few words held, the others meet their weights by word; the scores stay the same."""
    from collections import Counter
    from math import log

    from curatrix.operators import summaries

    texts = {n: f"The one of {'x' * (n % 5)} the many. Rare{n} of of.\nNo{n // 2} word{n // 7} the" for n in range(40)}
    texts |= {40: None, 41: "", 42: "the the the rare1"}
    found = Counter(w for t in texts.values() if t is not None for w in set(t.lower().split(" ")))
    weight = {w: round(log(42 / n) * 1_000_000) for w, n in found.items()}
    expected = {
        (k, p): sum(weight.get(w, 0) for w in s.lower().split(" ")) + 20_000_000 * ("many" in s)
        for k, t in texts.items()
        for p, s in enumerate(x for x in (t or "").replace(". ", ".\n").split("\n") if x)
    }
    numbered = spark.createDataFrame(list(texts.items()), "_row long, body string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n_held in (0, 3, 12, 1_000):
            monkeypatch.setattr(summaries, "HELD_WORDS", n_held)
            scores = summaries.rarity_scores(numbered, "body", ["many"])
            assert {(r["_row"], r.position): r.score for r in scores.collect()} == expected
            plan = scores._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and ("SortMergeJoin" in plan) == (n_held < 1_000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
