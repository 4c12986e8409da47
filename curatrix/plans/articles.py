"""Relevance labels and summaries of article tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import render
from curatrix.operators.relevance import OddsScorer, label_by_model, label_by_rule
from curatrix.operators.summaries import summarise
from curatrix.schemas import ARTICLE_INPUT, conform

# Column order of the summary table.
SUMMARY_COLUMNS = ("url", "title", "body", "source_name", "date_published", "pillar", "summary")


def relevance(
    papers: DataFrame,
    companies: Sequence[str],
    terms: Sequence[str] = (),
    model: PipelineModel | OddsScorer | None = None,
    text: str = "description",
    key: str = "paper_url",
) -> DataFrame:
    """`(key, body, relevance)` for the papers of some companies."""
    chosen = papers.filter(F.col("company_name").isin(*companies)).select(key, F.col(text).alias("body"))
    if isinstance(model, OddsScorer):
        return model.label(chosen, "body")
    if model is not None:
        return label_by_model(chosen, "body", model)
    return chosen.withColumn("relevance", label_by_rule(F.col("body"), terms))


def with_prompt(articles: DataFrame, templates: DataFrame, sector: str, name: str = "prompt") -> DataFrame:
    """Render the `template` of each row's `sector`; the article text goes in last."""
    joined = articles.join(templates, sector, "left")
    values = ((sector, F.col(sector)), ("text", F.coalesce("body", F.lit(""))))
    return joined.withColumn(name, render(F.col("template"), values)).drop("template")


def summaries(articles: DataFrame, cues: Sequence[str] = (), score: str = "rarity", k: int = 3) -> DataFrame:
    """The article table with a summary column, null where a text has no sentence."""
    checked = conform(articles, ARTICLE_INPUT)
    return summarise(checked, "body", k=k, score=score, cues=cues).select(*SUMMARY_COLUMNS)
