"""Joins. Null keys match null keys, as in a data-frame merge."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - `pa.compute` is used in tasks
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.session import materialise, settle, spread


def _renamed(right: DataFrame, key: str) -> tuple[DataFrame, str]:
    # A private name keeps the condition unambiguous when both sides share the column.
    return right.withColumnRenamed(key, "_right_key"), "_right_key"


def anti_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Left rows whose key does not occur on the right.

    The right side is reduced to its distinct keys before it is shuffled, so a key
    that fills a third of it costs one row per task.
    """
    keys = right.select(F.col(right_key or left_key).alias("_right_key")).distinct()
    return left.join(keys, F.col(left_key).eqNullSafe(F.col("_right_key")), "left_anti")


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str | None = None,
    hot_right: bool = False,
) -> DataFrame:
    """Left equi-join that drops the right key.

    Hot left keys are split by AQE in the plain form. AQE cannot split the right
    side of a left join, so `hot_right` joins the matches as an inner join, where
    both sides are split, and adds the left rows without a match. Either side is read
    twice, so one that is dear to compute is written first.
    """
    if hot_right:
        left, right = settle(left, "left"), settle(right, "right")
    renamed, key = _renamed(right, right_key or left_key)
    match = F.col(left_key).eqNullSafe(F.col(key))
    if not hot_right:
        return left.join(renamed, match, "left").drop(key)
    matched = left.join(renamed, match, "inner").drop(key)
    return matched.unionByName(
        anti_join(left, right, left_key, right_key), allowMissingColumns=True
    )


def count_matches(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    counted: str,
    group: str,
    name: str,
) -> DataFrame:
    """`count(counted)` per `group` of the left rows after a left join; 0 if unmatched.

    Counting per right key first lets the join carry one row per key, whatever
    share of the right rows a key has.
    """
    per_key = right.groupBy(F.col(right_key).alias("_right_key")).agg(
        F.count(F.col(counted)).alias("_n")
    )
    joined = left.join(per_key, F.col(left_key) == F.col("_right_key"), "left")
    return joined.groupBy(group).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))


def unnest(df: DataFrame, array: str, field: str, name: str) -> DataFrame:
    """One row per struct of `array`; rows with a null or empty array vanish."""
    return df.withColumn("_element", F.explode(array)).withColumn(
        name, F.col("_element").getField(field)
    ).drop("_element", array)


def difference(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """`left - right`; missing when either side is."""
    return df.withColumn(name, F.col(left) - F.col(right))


# Bounds of a company dictionary that every task holds.
HELD_CONCEPTS = 500_000
HELD_BYTES = 32 << 20


def _wanted(companies: DataFrame, company_key: str, company_uris: str) -> DataFrame:
    uris = F.explode(F.array_distinct(F.col(company_uris)))
    return (
        companies.select(F.col(company_key).alias("_company"), uris.alias("_uri"))
        .filter(F.col("_uri").isNotNull() & F.col("_company").isNotNull())
        .distinct()
    )


def _companies_in_rows(articles: DataFrame, uris: Column, wanted: DataFrame, kind: str, name: str) -> DataFrame:
    """`name`, each article's companies, found where the article is; for a dictionary that is held."""
    rows = wanted.collect()  # measured before
    companies = sorted({r["_company"] for r in rows})
    number = {company: n for n, company in enumerate(companies)}
    by_concept: dict[str, list[int]] = {}
    for r in rows:
        by_concept.setdefault(r["_uri"], []).append(number[r["_company"]])
    held = articles.sparkSession.sparkContext.broadcast((companies, {c: np.sort(n) for c, n in by_concept.items()}))

    @F.arrow_udf(f"array<{kind}>")
    def found(lists: pa.Array) -> pa.Array:
        names, known = held.value
        article = pa.compute.list_parent_indices(lists).to_numpy()
        coded = lists.flatten().dictionary_encode()
        each = [known.get(c, _NONE) for c in coded.dictionary.to_pylist()]
        sizes = np.array([len(e) for e in each], np.int64)
        code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        article, code = article[code >= 0], code[code >= 0]
        # One entry for each concept of an article and each of its companies; then each pair once.
        owner = np.repeat(article, sizes[code]) if len(code) else np.zeros(0, np.int64)
        company = np.concatenate([each[c] for c in code.tolist()] or [_NONE])
        pairs = np.unique(owner * max(1, len(names)) + company)
        owner, company = np.divmod(pairs, max(1, len(names)))
        ends = np.searchsorted(owner, np.arange(len(lists) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(names).take(pa.array(company)))

    return spread(articles).withColumn(name, found(uris))


_NONE = np.zeros(0, np.int64)


def companies_by_concept(
    articles: DataFrame,
    companies: DataFrame,
    uris: Column,
    company_key: str,
    company_uris: str,
    topics: Column | None = None,
) -> DataFrame:
    """The articles with the key of each company that shares a concept, one row a pair.

    With `topics` (an array) an article must also carry one of these. Articles without a
    company vanish, repeated ones stay repeated; null concepts are shared with nobody. A
    dictionary of companies within its bounds travels to the articles, and every pair is
    made once, in the article's own row. Beyond them both sides meet on the concept:
    articles are told apart by a number, and the repeats of a pair collapse in each task
    before they are shuffled as two numbers.
    """
    if topics is not None:
        articles = articles.filter(F.arrays_overlap(uris, topics))
    kind = dict(companies.dtypes)[company_key]
    wanted = materialise(_wanted(companies, company_key, company_uris), "concepts")
    width = F.octet_length("_uri") + F.octet_length(F.col("_company").cast("string"))
    n, size = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    if n <= HELD_CONCEPTS and size <= HELD_BYTES:
        listed = _companies_in_rows(articles, F.coalesce(uris, F.array().cast("array<string>")), wanted, kind, "_companies") if n else None
        if listed is None:
            return articles.limit(0).withColumn(company_key, F.lit(None).cast(kind))
        return listed.withColumn(company_key, F.explode("_companies")).drop("_companies")
    numbered = materialise(articles.withColumn("_row", F.monotonically_increasing_id()), "articles")
    by_concept = numbered.select("_row", F.explode(F.array_distinct(uris)).alias("_uri"))
    pairs = by_concept.join(wanted, "_uri").select("_row", F.col("_company").alias(company_key)).distinct()
    return numbered.join(pairs, "_row").drop("_row")


def shared_concepts(
    articles: DataFrame,
    companies: DataFrame,
    article_cols: list[str],
    uris: Column,
    company_key: str,
    company_uris: str,
    topics: Column | None = None,
) -> DataFrame:
    """One row per article and company that share at least one concept.

    As `companies_by_concept`, for `article_cols` only and each pair of their values once.
    """
    found = companies_by_concept(
        articles.select(*article_cols, uris.alias("_uris"), *([topics.alias("_topics")] if topics is not None else [])),
        companies, F.col("_uris"), company_key, company_uris, F.col("_topics") if topics is not None else None,
    )
    return found.select(*article_cols, company_key).distinct()
