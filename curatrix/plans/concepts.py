"""Company concepts and the articles that carry them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.arrays import has_non_null_field, non_null_field
from curatrix.functions.dates import iso_text
from curatrix.functions.text import equals_ignore_case, short_article_id, stable_id
from curatrix.operators.joins import left_join, companies_by_concept
from curatrix.schemas import ARTICLES, COMPANY_CONCEPTS, COMPANY_METADATA, conform, require

# Topic concepts an article must carry one of.
TOPIC_CONCEPTS = (
    "https://en.wikipedia.org/wiki/Artificial_intelligence",
    "https://en.wikipedia.org/wiki/Machine_learning",
    "https://en.wikipedia.org/wiki/Natural_language_processing",
    "https://en.wikipedia.org/wiki/Deep_learning",
    "https://en.wikipedia.org/wiki/Chatbot",
    "http://en.wikipedia.org/wiki/Virtual_assistant",
    "http://en.wikipedia.org/wiki/Generative_model",
    "https://en.wikipedia.org/wiki/Generative_artificial_intelligence",
    "https://en.wikipedia.org/wiki/Reinforcement_learning",
    "https://en.wikipedia.org/wiki/Large_language_model",
    "http://en.wikipedia.org/wiki/ChatGPT",
    "http://en.wikipedia.org/wiki/GPT-4",
    "http://en.wikipedia.org/wiki/OpenAI",
    "http://en.wikipedia.org/wiki/Computer_vision",
)


def company_concepts(metadata: DataFrame, concepts: DataFrame, sector: str) -> DataFrame:
    """Companies of a sector, any case, with their concept urls; null when they have none."""
    chosen = conform(metadata, COMPANY_METADATA).filter(
        equals_ignore_case(F.col("internal_classification"), sector)
    )
    urls = (
        conform(concepts, COMPANY_CONCEPTS)
        .filter(has_non_null_field(F.col("concept_url"), "url"))
        .select(F.col("id").alias("_concept_id"), non_null_field(F.col("concept_url"), "url").alias("url_list"))
    )
    # A warehouse join: a null id matches nothing.
    with_id = urls.filter(F.col("_concept_id").isNotNull())
    return left_join(chosen, with_id, "id", "_concept_id", hot_right=True)


def stamp(articles: DataFrame, sector: str, run_at: Column, random_ids: bool = False) -> DataFrame:
    """Add article id, sector, run time and display id.

    Ids are digests of company, url and publication time, so a recomputed partition
    gives the same ones; `random_ids` draws new ones each time.
    """
    article_id = (
        F.uuid()
        if random_ids
        else stable_id(F.col("company_id"), F.col("url"), F.col("dateTimePub"))
    )
    return (
        articles.withColumn("article_id", article_id)
        .withColumn("sector", F.lit(sector))
        .withColumn("run_datetime", iso_text(run_at))
        .withColumn("temp_id", short_article_id(F.col("dateTimePub"), F.col("url")))
    )


def concept_articles(
    articles: DataFrame,
    companies: DataFrame,
    start,
    end,
    sector: str,
    run_at: Column,
    topics: Sequence[str] = TOPIC_CONCEPTS,
    lang: str = "eng",
    data_types: Sequence[str] = ("news", "pr"),
) -> DataFrame:
    """Stamped articles per company of `companies` (as from `company_concepts`).

    All companies are searched at once: articles in the date range, language and
    types that carry a topic get one row for each company that shares a concept. Urls may
    be null or repeat.
    """
    checked = require(articles, ARTICLES).filter(
        F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
        & (F.col("lang") == lang)
        & F.col("data_type").isin(*data_types)
    )
    paired = companies_by_concept(
        checked,
        companies.select(F.col("id").alias("company_id"), "url_list"),
        F.col("concepts.uri"),
        "company_id",
        "url_list",
        topics=F.array(*map(F.lit, topics)),
    )
    return stamp(paired, sector, run_at)
