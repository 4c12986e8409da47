"""Joins, aggregates and ranks: null rules, hot keys, brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curatrix.operators import aggregates as agg
from curatrix.operators import filters, joins, ranking


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_anti_join_matches_null_with_null(frame):
    left = frame([("a",), ("b",), (None,)], "k string")
    assert rows(joins.anti_join(left, frame([("a",), (None,)], "k string"), "k")) == [("b",)]
    assert rows(joins.anti_join(left, frame([("a",)], "k string"), "k")) == [("b",), (None,)]


@pytest.mark.parametrize("hot_right", [False, True])
def test_left_join_is_a_merge(frame, hot_right):
    draw = random.Random(3)
    keys = [None, "hot", "hot", "hot", "a", "b", "c"]
    left = [(draw.choice(keys), i) for i in range(60)]
    right = [(draw.choice([*keys, "z"]), -i) for i in range(40)]
    expected = []
    for k, v in left:
        hits = [w for q, w in right if q == k]
        expected += [(k, v, w) for w in hits] or [(k, v, None)]
    out = joins.left_join(
        frame(left, "k string, v int"), frame(right, "r string, w int"), "k", "r", hot_right=hot_right
    )
    assert out.columns == ["k", "v", "w"]
    assert rows(out) == sorted(expected, key=repr)


def test_left_join_on_one_name(frame):
    out = joins.left_join(frame([("a", 1), ("b", 2)], "k string, v int"), frame([("a", 9)], "k string, w int"), "k")
    assert rows(joins.difference(out, "w", "v", "d")) == [("a", 1, 9, 8), ("b", 2, None, None)]


def test_anti_and_semi_make_up_the_input(tables):
    docs = tables.documents.select("doc_id")
    kept = joins.anti_join(docs, tables.labels, "doc_id").count()
    assert kept + docs.join(tables.labels, "doc_id", "left_semi").count() == docs.count()


def test_count_matches(frame):
    companies = frame([("1", "a"), ("2", "b"), ("3", "a"), (None, "n")], "id string, name string")
    patents = frame(
        [("1", "u"), ("1", None), ("3", "v"), ("9", "w"), (None, "x")], "company_id string, url string"
    )
    out = joins.count_matches(companies, patents, "id", "company_id", "url", "name", "n")
    assert rows(out) == [("a", 2), ("b", 0), ("n", 0)]


def test_unnest_drops_empty_and_null_arrays(frame):
    df = frame([("a", [("x",), (None,)]), ("b", []), ("c", None)], "k string, u array<struct<url:string>>")
    assert rows(joins.unnest(df, "u", "url", "url")) == [("a", "x"), ("a", None)]


def test_shared_concepts_gives_each_pair_once(frame):
    articles = frame([("u", ["t", "c1", "c2", "c1"]), ("v", ["c1"]), ("w", ["t", None])], "url string, cs array<string>")
    companies = frame([("A", ["c1", "c2"]), ("B", ["c2", "c2"]), ("C", None)], "id string, us array<string>")
    out = joins.shared_concepts(articles, companies, ["url"], F.col("cs"), "id", "us", F.array(F.lit("t")))
    assert rows(out) == [("u", "A"), ("u", "B")]


def test_keep_first_and_null_keys(frame):
    df = frame([("a", 2), ("a", 1), (None, 3), (None, 4)], "k string, v int")
    assert rows(agg.keep_first(df, ["k"], ["v"])) == [("a", 1), (None, 3)]


def test_last_by_key_keeps_first_position(frame):
    df = frame([("l", 0, "old"), ("m", 1, "x"), ("l", 2, "new")], "k string, pos int, v string")
    assert rows(agg.last_by_key(df, "k", "pos", "v")) == [("l", 0, "new"), ("m", 1, "x")]


def test_counts_drop_null_keys(frame):
    df = frame([("a", "r"), ("a", "r"), (None, "r"), ("a", None)], "c string, reason string")
    assert rows(agg.count_per(df, ["c", "reason"])) == [("a", "r", 2)]


def test_matrix_refuses_unlisted_values(frame):
    df = frame([("a", "x"), ("a", "y"), ("b", "z"), ("b", "x"), ("b", "x")], "c string, r string")
    out = agg.by_total(agg.count_matrix(df, "c", "r", ["x", "y", "z"]), "c").collect()
    assert [tuple(r) for r in out] == [("b", 2, 0, 1, 3), ("a", 1, 1, 0, 2)]
    with pytest.raises(Exception, match="value of r without a column: z"):
        agg.count_matrix(df, "c", "r", ["x", "y"]).collect()


@pytest.mark.parametrize("part_size", [1, 3, 1000])
def test_value_lists_split_and_keep_everything(spark, part_size):
    draw = random.Random(5)
    data = [(draw.choice(["hot", "hot", "a", None]), draw.choice(["x", "y", "z", "w", None])) for _ in range(80)]
    out = agg.value_lists(spark.createDataFrame(data, "k string, v string"), "k", "v", "vs", part_size).collect()
    expected = defaultdict(list)
    for k, v in data:
        if k is not None and v is not None:
            expected[k].append(v)
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.k, r.part)):
        assert 0 < len(r.vs) <= part_size
        got[r.k] += r.vs
    assert got == {k: sorted(v) for k, v in expected.items()}


def test_ranks_against_brute_force(spark):
    draw = random.Random(11)
    data = [(draw.choice(["hot", "hot", "hot", "b"]), f"n{i}", draw.randrange(40), draw.choice([None, *range(9)])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, e string, p int, c int")
    out = {r.e: r for r in ranking.index_ranks(df, "g", "e", "p", "c").collect()}
    assert len(out) == len(data)
    for g, e, p, c in data:
        group = [d for d in data if d[0] == g]
        r = out[e]
        assert r.rank_previous == 1 + sum(d[2] > p for d in group)
        held = [d for d in group if d[3] is not None]
        assert r.rank_current == (None if c is None else 1 + sum(d[3] > c for d in held))
        top = max(d[3] for d in held)
        assert r.leader_value == top and r.leader_name == min(d[1] for d in held if d[3] == top)
        assert r.value_change == (None if c is None else c - p)


def test_running_total_spreads_one_group_over_slices(spark):
    df = spark.range(2000).select(F.lit("hot").alias("g"), "id")
    placed = ranking.running_total(df, ["g"], [F.col("id")], F.lit(1), "before")
    assert placed.filter("before <> id").count() == 0 and placed.count() == 2000


def test_filters(frame):
    df = frame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    assert rows(filters.without_key(df, "k", "a")) == [("b", 3), (None, 2)]
    assert filters.without_key(df, "k", "zz").count() == 3
    marked = frame([("[]", "x[]"), ("a", "[]")], "a string, b string")
    assert rows(filters.marker_to_null(marked)) == [("a", None), (None, "x[]")]
    assert rows(filters.flag_and_fill(df, "k", "f")) == [("", 2, 1), ("a", 1, 0), ("b", 3, 0)]


def test_list_totals_count_null_lists_as_rows(frame):
    df = frame([("a", ["x", "y"]), ("b", None), ("c", [])], "k string, u array<string>")
    assert rows(agg.list_totals(df, "u", "n", "rows")) == [(2, 3)]
    assert rows(agg.list_totals(df.limit(0), "u", "n", "rows")) == [(0, 0)]


def test_article_search_is_closed_and_needs_both_lists(frame):
    import datetime as dt

    day = lambda d: dt.date(2024, 1, d)
    kind = "date date, lang string, data_type string, url string, concepts array<struct<uri:string>>"
    data = [
        (day(1), "eng", "news", "first", [("t",), ("c",)]),
        (day(9), "eng", "pr", "last", [("t",), ("c",), (None,)]),
        (day(10), "eng", "pr", "late", [("t",), ("c",)]),
        (day(5), "deu", "pr", "lang", [("t",), ("c",)]),
        (day(5), "eng", "blog", "type", [("t",), ("c",)]),
        (day(5), "eng", "news", "one", [("t",)]),
        (day(5), "eng", "news", "none", None),
    ]
    found = filters.search_articles(frame(data, kind), day(1), "2024-01-09", ["t"], ["c"])
    assert Counter(r.url for r in found.collect()) == {"first": 1, "last": 1}
