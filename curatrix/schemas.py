"""Declared input schemas and the check that fails on drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TEXT, FLAG, WHOLE = T.StringType(), T.BooleanType(), T.IntegerType()


def struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CALENDAR_LINKS = struct(market_screener_link=TEXT, company_id=TEXT, name=TEXT)
EVENTS_RAW = struct(name=TEXT, date=TEXT, company_id=TEXT, event=TEXT)
PAPERS_OLD = struct(paper_url=TEXT, company_name=TEXT)
PAPERS_NEW = struct(paper_url=TEXT, paper_title=TEXT, paper_description=TEXT, company_name=TEXT)
PAPERS_QA = struct(
    url=TEXT,
    authors=TEXT,
    title=TEXT,
    publication_date=TEXT,
    description=TEXT,
    is_patent=FLAG,
    tags=TEXT,
    excluded_tags=TEXT,
    keyword_tags=TEXT,
    has_publication_info=FLAG,
    author_name=TEXT,
)
COMPANY_IDS = struct(id=TEXT, company=TEXT, sector=TEXT)
PATENTS = struct(company_id=TEXT, url=TEXT)
COMPANY_METADATA = struct(
    id=TEXT, name=TEXT, additional_names=TEXT, company_type=TEXT, internal_classification=TEXT
)
COMPANY_CONCEPTS = struct(id=TEXT, concept_url=T.ArrayType(struct(url=TEXT)))
COMPANY_ALIASES = struct(
    company=TEXT, sector=TEXT, linkedin_id=T.ArrayType(struct(linkedin_organisation=TEXT))
)
ARTICLES = struct(
    date=T.DateType(),
    lang=TEXT,
    data_type=TEXT,
    dateTimePub=TEXT,
    url=TEXT,
    concepts=T.ArrayType(struct(uri=TEXT)),
)
# The columns of the outlet table, in its order.
OUTLETS = struct(
    domain_name_root=TEXT,
    domain_name=TEXT,
    is_top_tier=FLAG,
    is_blacklisted=FLAG,
    ranking=WHOLE,
    media_logo=TEXT,
    paywall=FLAG,
    partial_paywall=FLAG,
    is_company_site=FLAG,
    is_index=FLAG,
    company_id=TEXT,
    company_name=TEXT,
    sector=TEXT,
)
ARTICLE_INPUT = struct(
    url=TEXT, title=TEXT, body=TEXT, source_name=TEXT, date_published=TEXT, pillar=TEXT
)
INVENTORY = struct(
    project=TEXT,
    dataset_id=TEXT,
    table_id=TEXT,
    table_type=TEXT,
    created=T.TimestampType(),
    modified=T.TimestampType(),
)


class SchemaDrift(ValueError):
    """An input lacks a declared column or holds it with another type."""


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame as it is; fails before running when a declared column drifted."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in schema.fields:
        if field.name not in have:
            problems.append(f"{field.name}: missing")
        elif have[field.name].simpleString() != field.dataType.simpleString():
            problems.append(
                f"{field.name}: {have[field.name].simpleString()}, declared "
                f"{field.dataType.simpleString()}"
            )
    if problems:
        raise SchemaDrift("; ".join(problems))
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, after the same check."""
    return require(df, schema).select(*[F.col(f"`{f.name}`") for f in schema.fields])
