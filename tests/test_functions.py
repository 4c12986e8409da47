"""Scalar and array functions on edge values."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from curatrix.functions import arrays, dates, text
from curatrix.operators.relevance import label_by_rule
from curatrix.operators.terms import keyword_tags
from curatrix.plans.events import EXCLUDED_EVENTS

BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      　"


@pytest.mark.parametrize("raw", ["", " ", BLANKS, BLANKS + "a b" + BLANKS, "a", "\na\n\nb\n", "x" + " " * 5000 + "y "])
def test_strip_is_unicode_strip(value, raw):
    assert value(text.strip, raw) == raw.strip()


def test_space_pairs_go_and_odd_space_stays(value):
    assert value(text.drop_space_pairs, "a   b    c") == "a bc"


def test_strip_and_pairs_on_random_texts(spark):
    draw = random.Random(7)
    made = ["".join(draw.choices(BLANKS + "ab•  ", k=draw.randrange(14))) for _ in range(500)]
    rows = spark.createDataFrame([(s,) for s in made], "c string")
    out = rows.select("c", text.clean_cell_text(F.col("c")).alias("o")).collect()
    assert all(r.o == "".join(r.c.strip().split("  ")) for r in out)


def test_event_cell(value):
    raw = "\xa0 \t 01/02/2024\n    x\n\n  Q1 Release (Projected)\n"
    cleaned = text.clean_cell_text(F.col("c"))
    assert value(lambda c: text.first_line(text.text_block(cleaned, 0)), raw) == "01/02/2024"
    assert value(lambda c: text.text_block(cleaned, 1), raw) == "Q1 Release (Projected)"
    assert value(lambda c: text.text_block(c, 1), "01/02/2024 only") is None


def test_event_name_chain(value):
    assert value(text.tidy_event_name, "Pre-market Q1 Release (Projected)") == "Q1 Call"
    assert value(text.tidy_event_name, "release (projected)") == "release (projected)"


def test_bullets(value):
    assert value(text.clean_bullets, "• a\n\n• b") == "•a\n•b"
    assert value(text.clean_bullets, "•a•b") == "•a\n•b"


def test_contains_term_never_matches_blank_or_null(value):
    for term in ("", None):
        assert value(lambda c, t=term: text.contains_term(c, F.lit(t).cast("string")), "abc") is False
    assert value(lambda c: text.contains_term(c, F.lit("b")), "abc") is True
    assert value(lambda c: text.contains_term(c, F.lit("B")), "abc") is False
    assert value(lambda c: text.contains_term(c, F.lit("B")), None) is False


def test_starts_with_any(value):
    assert value(lambda c: text.starts_with_any(c, ()), "raw_x") is False
    assert value(lambda c: text.starts_with_any(c, ("raw_", "temporary")), "temporaryx") is True
    assert value(lambda c: text.starts_with_any(c, ("raw_",)), "RAW_x") is False


def test_short_article_id(value):
    known = value(lambda c: text.short_article_id(F.lit("2024-01-01T00:00:00Z"), c), "http://x")
    assert known == "66b3b6b521"
    assert value(lambda c: text.short_article_id(F.lit(None).cast("string"), c), "u") == (
        hashlib.sha1(b"_u").hexdigest()[:10]
    )


def test_stable_id_tells_null_from_blank(value):
    ids = {value(lambda c: text.stable_id(c, F.lit("x")), v) for v in ("", None, "!", "=")}
    assert len(ids) == 4


def test_render_leaves_placeholders_of_the_text(value):
    out = value(lambda c: text.render(F.lit("{s}: {text}"), (("s", F.lit("bank")), ("text", c))), "a {s}")
    assert out == "bank: a {s}"


@pytest.mark.parametrize(
    ("written", "day"),
    [
        ("1/2/2024", dt.date(2024, 2, 1)),
        ("01/02/2024", dt.date(2024, 2, 1)),
        ("31/02/2024", None),
        ("1/2/24", None),
        ("Q1 2025", None),
        ("001/2/2024", None),
        (" 1/2/2024", None),
        ("1/2/2024\n", None),
        (None, None),
    ],
)
def test_day_first_dates(value, written, day):
    assert value(dates.parse_day_first, written) == day


def test_slashed(value):
    assert value(dates.slashed, dt.date(2024, 2, 1), "date") == "2024/02/01"


@pytest.mark.parametrize(
    ("delta", "days"),
    [
        (dt.timedelta(days=29, hours=23), 29),
        (dt.timedelta(days=30), 30),
        (dt.timedelta(hours=2), 0),
        (dt.timedelta(hours=-22), -1),
        (dt.timedelta(days=-1), -1),
    ],
)
def test_elapsed_days_are_floored_periods(value, delta, days):
    now = dt.datetime(2024, 5, 2, 1, 0)
    assert value(lambda c: dates.elapsed_days(c, F.lit(now)), now - delta, "timestamp_ntz") == days


def test_time_texts(value):
    at = dt.datetime(2024, 2, 1, 15, 4)
    assert value(dates.run_suffix, at, "timestamp_ntz") == "feb01_1504"
    assert value(dates.clock_text, at, "timestamp_ntz") == "03:04 PM"


@pytest.mark.parametrize(
    ("written", "parsed"),
    [
        ("['is_patent', 'no_tags']", ["is_patent", "no_tags"]),
        ("['a', \"b's\"]", ["a", "b's"]),
        (r"['it\'s']", ["it's"]),
        ("bad", []),
        ("[]", []),
        ("", []),
        (None, None),
    ],
)
def test_list_text(value, written, parsed):
    assert value(arrays.parse_list_text, written) == parsed


def test_struct_arrays(value):
    kind = "array<struct<url:string>>"
    assert value(lambda c: arrays.non_null_field(c, "url"), [("a",), (None,)], kind) == ["a"]
    for none in (None, [], [(None,)]):
        assert value(lambda c: arrays.has_non_null_field(c, "url"), none, kind) is False
    assert value(arrays.size_or_zero, None, kind) == 0


def test_keyword_tags_ignore_case(value):
    tags = lambda c: keyword_tags(c, EXCLUDED_EVENTS)
    assert value(tags, "DÉTACHEMENT x") == ["NOT_INTERESTING"]
    assert value(tags, "Q1 Call") == []


def test_rule_labels(value):
    rule = lambda c: label_by_rule(c, ("ai", "model"))
    assert [value(rule, t) for t in ("AI Model", "a model", "x", None)] == ["Yes", "Unsure", "No", "No"]
