"""Old and new versions of a dataset, the reasons for missing rows, and their counts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.arrays import labels_where, parse_list_text
from curatrix.operators.aggregates import by_total, count_matrix, count_per, keep_first
from curatrix.operators.filters import marker_to_null, without_key
from curatrix.operators.joins import anti_join, left_join
from curatrix.schemas import PAPERS_NEW, PAPERS_OLD, PAPERS_QA, conform, require
from curatrix.session import settle

# Reason labels, in the order they are tested.
REASONS = (
    "is_patent",
    "excluded_tags",
    "no_tags",
    "no_authors",
    "no_publication_date",
    "no_author_name",
)


def exclusion_reasons() -> Column:
    """Why a row was left out, as an array in the order of `REASONS`."""
    conditions = (
        F.col("is_patent"),
        F.col("excluded_tags").isNotNull(),
        F.col("tags").isNull(),
        F.col("authors").isNull(),
        F.col("publication_date").isNull(),
        F.col("author_name").isNull(),
    )
    return labels_where(tuple(zip(REASONS, conditions, strict=True)))


NO_REASON = "none"  # a combination of no reasons


def _keyed(df: DataFrame, column: str) -> DataFrame:
    # Two plain columns that equal each other exactly when the keys are null-safe
    # equal, so dedup, anti-join and join share one hash partitioning.
    return df.withColumn("_no_key", F.col(column).isNull()).withColumn(
        "_key", F.coalesce(F.col(column), F.lit(""))
    )


_KEY = ["_key", "_no_key"]


SIDES = ("old", "new", "both")


def compare_versions(old: DataFrame, new: DataFrame, key: str, new_key: str | None = None) -> DataFrame:
    """Each key of either version once: rows on each side, and which `side` has it.

    The set differences both ways, the intersection and the counts come from one pass:
    both versions are laid end to end with a flag for their side, and one grouping by key
    joins the flags. A key that fills a third of a version is added up in each task
    first. Null is a key as any other.
    """
    sides = old.select(F.col(key).alias(key), F.lit(1).alias("_side")).unionByName(
        new.select(F.col(new_key or key).alias(key), F.lit(2).alias("_side"))
    )
    return (
        sides.groupBy(key)
        .agg(
            F.count_if(F.col("_side") == 1).alias("n_old"),
            F.count_if(F.col("_side") == 2).alias("n_new"),
            F.bit_or("_side").alias("_flags"),
        )
        .withColumn("side", F.element_at(F.array(*map(F.lit, SIDES)), F.col("_flags")))
        .drop("_flags")
    )


def _keys_on(compared: DataFrame, side: str) -> DataFrame:
    keys = compared.filter(F.col("side") == side)
    return _keyed(keys.select(F.col(compared.columns[0]).alias("_url")), "_url").select(*_KEY)


def missing_from_new(
    old: DataFrame,
    new: DataFrame,
    qa: DataFrame,
    old_order: Sequence[str] = ("company_name",),
    qa_order: Sequence[str] = ("title", "authors", "description"),
    compared: DataFrame | None = None,
) -> DataFrame:
    """Rows of `old` whose url is not in `new`, with their exclusion reasons.

    Urls are unique in the result, so `old`, `qa` and the urls of `new` are reduced to
    one row per url before they meet; this drops the same rows as a dedup after the
    join, and no url can be hot in it. The orders decide which row stays; all further
    columns that are read follow them, so equal rows only are left to chance. With
    `compared`, the urls of both versions as from `compare_versions`, `new` is not read.
    """
    for frame, order in ((old, old_order), (qa, qa_order)):
        absent = set(order) - set(frame.columns)
        if absent:
            raise ValueError(f"order columns {sorted(absent)} are missing")
    require(old, PAPERS_OLD)
    require(qa, PAPERS_QA)
    old_order = [*old_order, *(c for c in PAPERS_OLD.names if c not in old_order)]
    qa_order = [*qa_order, *(c for c in PAPERS_QA.names if c not in qa_order)]
    first_old = keep_first(_keyed(old, "paper_url"), _KEY, old_order).select(
        "company_name", "paper_url", *_KEY
    )
    if compared is None:
        seen = _keyed(new.select("paper_url"), "paper_url").select(*_KEY).distinct()
        missing = first_old.join(seen, _KEY, "left_anti")
    else:
        missing = first_old.join(_keys_on(compared, "old"), _KEY, "left_semi")
    first_qa = keep_first(_keyed(qa, "url"), _KEY, qa_order).select(
        *_KEY, *[f.name for f in PAPERS_QA.fields if f.name != "url"]
    )
    joined = marker_to_null(missing.join(first_qa, _KEY, "left").drop(*_KEY))
    return joined.withColumn("exclusion_reason", exclusion_reasons()).select(
        "company_name",
        "paper_url",
        "authors",
        "title",
        "description",
        "excluded_tags",
        "author_name",
        "exclusion_reason",
    )


def added_in_new(
    old: DataFrame, new: DataFrame, qa: DataFrame, companies: Sequence[str], compared: DataFrame | None = None
) -> DataFrame:
    """Rows of `new` for some companies whose url is not in `old`, with their QA rows.

    Nothing is deduplicated: several QA rows for a url give several rows. With `compared`
    (see `compare_versions`) `old` is not read.
    """
    chosen = conform(new, PAPERS_NEW).filter(F.col("company_name").isin(*companies))
    if compared is None:
        added = anti_join(chosen, old, "paper_url")
    else:
        added = _keyed(chosen, "paper_url").join(_keys_on(compared, "new"), _KEY, "left_semi")
    added = added.select("paper_url", "paper_title", "paper_description")
    checks = conform(qa, PAPERS_QA).select(
        "url", "publication_date", "tags", "excluded_tags", "keyword_tags"
    )
    return left_join(added, checks, "paper_url", "url", hot_right=True)


def reconcile(
    old: DataFrame,
    new: DataFrame,
    qa: DataFrame,
    companies: Sequence[str],
    old_order: Sequence[str] = ("company_name",),
    qa_order: Sequence[str] = ("title", "authors", "description"),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The compared urls, what is missing from `new` and what `companies` added, from one comparison."""
    compared = settle(compare_versions(old, new, "paper_url"), "compared")
    missing = missing_from_new(old, new, qa, old_order, qa_order, compared)
    return compared, missing, added_in_new(old, new, qa, companies, compared)


def reason_rows(missing: DataFrame, per_combination: bool = False) -> DataFrame:
    """`(company_name, exclusion_reason)`, one row per reason or per combination.

    Reasons may be an array or its text. Per combination the joined reasons are one
    value, `none` where there are none; per reason a row without reasons vanishes.
    """
    reasons = F.col("exclusion_reason")
    if dict(missing.dtypes)["exclusion_reason"] == "string":
        reasons = parse_list_text(reasons)
    joined = F.when(F.size(reasons) == 0, NO_REASON).otherwise(F.array_join(reasons, "|"))
    value = joined if per_combination else F.explode(reasons)
    return missing.select("company_name", value.alias("exclusion_reason"))


def reason_counts(missing: DataFrame, per_combination: bool = False) -> DataFrame:
    return count_per(reason_rows(missing, per_combination), ["company_name", "exclusion_reason"])


def all_combinations(reasons: Sequence[str] = REASONS) -> list[str]:
    """Every joined combination the rules can give, in rule order."""
    return [
        "|".join(c) or NO_REASON for size in range(len(reasons) + 1) for c in combinations(reasons, size)
    ]


def exclusion_matrix(
    missing: DataFrame,
    per_combination: bool = False,
    values: Sequence[str] | None = None,
    drop_company: str | None = None,
) -> DataFrame:
    """Companies by reason with totals, largest total first, one company left out."""
    if values is None:
        values = all_combinations() if per_combination else REASONS
    rows = reason_rows(missing, per_combination)
    if drop_company is not None:
        rows = without_key(rows, "company_name", drop_company)
    return by_total(count_matrix(rows, "company_name", "exclusion_reason", values), "company_name")
