"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import oracle
import pytest
from conftest import SMOKE

import __spark_entry__ as entry_module
from curatrix.registry import ORACLE, QUERIES
from curatrix.session import prepare

ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, spark, con):
    df = entry_module.queries()[name](spark, SMOKE)
    left = oracle.spark_rows(df)
    assert oracle.first_difference(left, oracle.sql_rows(con, ORACLE[name])) == ""
    assert left[1], "a query without rows checks nothing"


def test_only_fitted_labels_have_no_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


def test_fitted_labels_are_allowed_and_better_than_chance(spark, tables):
    from pyspark.sql import functions as F

    from curatrix.operators.relevance import fit_relevance, label_by_model, unexpected_labels

    rows = tables.documents.join(tables.labels, "doc_id").select("doc_id", "text", "quality")
    # Held out by a digest of the text, so copies of a text stay on one side.
    held_out = F.substring(F.md5("text"), 1, 1) < "4"
    model = fit_relevance(rows.filter(~held_out), "text", "quality", features=1 << 12)
    labelled = label_by_model(rows.filter(held_out), "text", model)
    assert unexpected_labels(labelled).count() == 0
    decided = labelled.filter("relevance <> 'Unsure'")
    right = decided.filter("(relevance = 'Yes') = (quality = 1)").count()
    assert decided.count() > 0 and right / decided.count() > 0.5


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = entry_module.entry(spark), entry_module.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0


def test_prepare_turns_skew_handling_on(spark):
    prepare(spark)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
