"""Companies mentioned in stored articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.operators.aggregates import keep_first, last_by_key
from curatrix.operators.joins import unnest
from curatrix.operators.pages import links, page_text, sections
from curatrix.operators.terms import add_names
from curatrix.schemas import COMPANY_ALIASES, conform
from curatrix.session import materialise
from curatrix.sources.pages import fetched_pages


def company_aliases(companies: DataFrame, sector: str) -> DataFrame:
    """The long `(company, possible_name)` table of one sector."""
    one_sector = conform(companies, COMPANY_ALIASES).filter(F.col("sector") == sector)
    return unnest(one_sector, "linkedin_id", "linkedin_organisation", "possible_name").select(
        "company", "possible_name"
    )


def article_texts(
    pages: DataFrame,
    class_token: str | None = "nws-container",
    tag: str | None = None,
    drop_ids: Sequence[str] = (),
    drop_heading: str | None = None,
    heading_within: bool = False,
    position: str | None = None,
) -> DataFrame:
    """`(link, content)`, one row per link.

    Of repeated links the one with the last `position` counts; without positions they
    are taken to be copies of one page.
    """
    linked = pages.withColumnRenamed("url", "link")
    if position is not None:
        linked = last_by_key(fetched_pages(linked), "link", position, "html").drop(position)
    read = sections(linked, "link", tag=tag, class_token=class_token)
    texts = page_text(read, drop_ids, drop_heading, heading_within)
    return texts if position is not None else keep_first(texts, ["link"], ["content"])


def index_links(index_pages: DataFrame, class_value: str, base_url: str = "") -> DataFrame:
    """`link`, absolute, of the elements of `class_value` in the index pages, each once.

    A target is resolved against `base_url`: one with a scheme stays, one that starts
    with two slashes takes the scheme, one with a slash the host, any other the folder.
    """
    target = F.col("link")
    scheme = F.regexp_extract(F.lit(base_url), "^[a-zA-Z][a-zA-Z0-9+.-]*:", 0)
    host = F.regexp_extract(F.lit(base_url), "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_replace(F.lit(base_url), "(?<=[^/])/[^/]*$", "/")
    absolute = (
        F.when(F.regexp_like(target, F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*:")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
        .when(F.startswith(target, F.lit("/")), F.concat(host, target))
        .otherwise(F.concat(folder, target))
    )
    return links(index_pages, "url", class_value).select(absolute.alias("link")).distinct()


def linked_articles(
    index_pages: DataFrame,
    stored: DataFrame,
    class_value: str,
    base_url: str = "",
    position: str | None = None,
    **reading,
) -> DataFrame:
    """`(link, content)` of the pages that the index pages link to.

    Links are those of `class_value` (see `index_links`). Of a page stored more than once
    the last `position` counts; only linked pages are read. A link whose page is not
    stored has null content. `reading` are the options of `article_texts`.
    """
    wanted = materialise(index_links(index_pages, class_value, base_url), "links")
    pages = stored.join(wanted.withColumnRenamed("link", "url"), "url", "left_semi")
    texts = article_texts(pages, position=position, **reading)
    return wanted.join(texts, "link", "left").select("link", "content")


def mentions(
    texts: DataFrame,
    companies: DataFrame,
    sector: str = "bank",
    text: str = "content",
    way: str = "join",
) -> DataFrame:
    """Add `banks_mentioned`, the companies with an alias in the text."""
    aliases = company_aliases(companies, sector)
    return add_names(
        texts, text, aliases, "company", "possible_name", "banks_mentioned", way=way
    )
