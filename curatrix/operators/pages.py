"""Rows, links and sections of stored pages.

HTML needs a parser, so these read pages in Arrow batches in Python workers; what
follows the extraction is plain DataFrame work. One page gives one output batch row
or its own rows, nothing is gathered across pages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.text import clean_cell_text, first_line, text_block
from curatrix.session import spread
from curatrix.sources.pages import fetched_pages

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# A comment or declaration, a tag with its attributes, or text. A quote counts only
# right after an equals sign; a tag with an unclosed one is text.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=(?!\s*+["']))*+)>"""
    r"""|([^<]++|<)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'][^\s=/]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s]++))?""")
_CODE_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in ("script", "style")}


class _Attributes:
    """Attributes of a tag, parsed when one is asked for; the last of a name counts."""

    __slots__ = ("raw", "parsed")

    def __init__(self, raw: str):
        self.raw, self.parsed = raw, None

    def get(self, name: str, default: str | None = None) -> str | None:
        if self.parsed is None:
            self.parsed = {
                key.lower(): unescape(text[1:-1] if text[:1] in ('"', "'") else text)
                for key, text in _ATTRIBUTE.findall(self.raw)
            }
        return self.parsed.get(name, default)


class _Element:
    """One element of interest, those open around it, and the texts inside it."""

    __slots__ = ("tag", "attrs", "depth", "around", "texts", "start", "end")

    def __init__(self, tag: str, attrs: _Attributes, depth: int, around: list, texts: list[str]):
        self.tag, self.attrs, self.depth, self.around = tag, attrs, depth, around
        # The texts of the whole page; the element's own run from `start` to `end`.
        self.texts, self.start = texts, len(texts)
        self.end: int | None = None


# Start tags that end an element left open before them.
_IMPLIED_ENDS = {
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "li": ("li",),
    "option": ("option",),
    "p": ("p",),
}


class _Finished(Exception):
    """Raised by a `wanted` test when the rest of the page cannot matter."""


def _walk(html: str, wanted: Callable, found: list[_Element]) -> None:
    path: list[str] = []
    is_open: Counter[str] = Counter()
    marked: list[_Element] = []
    texts: list[str] = []
    at, end = 0, len(html)

    def close_last() -> str:
        last = path.pop()
        is_open[last] -= 1
        while marked and marked[-1].depth >= len(path):
            marked.pop().end = len(texts)
        return last

    while at < end:
        token = _TOKEN.match(html, at)
        at = token.end()
        close, tag, raw, text = token.groups()
        if text is not None:
            if marked and not is_open["template"]:
                texts.append(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if not close:
            attrs = _Attributes(raw)
            alone = tag in _VOID or raw.endswith("/")
            while path and path[-1] in _IMPLIED_ENDS.get(tag, ()):
                close_last()
            if wanted(tag, attrs, marked):
                element = _Element(tag, attrs, len(path), list(marked), texts)
                found.append(element)
                if alone:
                    element.end = element.start
                else:
                    marked.append(element)
            if alone:
                continue
            path.append(tag)
            is_open[tag] += 1
            if tag in _CODE_END:
                stop = _CODE_END[tag].search(html, at)
                at = stop.start() if stop else end
        elif is_open[tag]:
            while close_last() != tag:
                pass


def _pieces(element: _Element) -> list[str]:
    """The text between tags, piece by piece, with entities decoded."""
    return [unescape(t) for t in element.texts[element.start : element.end]]


def _read(html: str | None, wanted: Callable) -> list[_Element]:
    """The elements `wanted(tag, attrs, open elements)` accepts, in page order.

    An end tag closes up to the nearest open element of its name and is ignored when
    there is none; elements left open end with the page. Scripts and styles are no text.
    """
    found: list[_Element] = []
    try:
        _walk(html or "", wanted, found)
    except _Finished:
        pass
    return found


def _per_page(pages: DataFrame, key: str, schema: str, rows_of: Callable[[str], list[tuple]]) -> DataFrame:
    columns = [part.split()[0] for part in schema.split(", ")]

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (page, *row)
                for page, html in zip(batch[key], batch["html"], strict=True)
                for row in rows_of(html)
            ]
            yield pd.DataFrame(out, columns=[key, *columns])

    kind = dict(pages.dtypes)[key]
    return spread(fetched_pages(pages).select(key, "html")).mapInPandas(extract, f"{key} {kind}, {schema}")


def table_rows(
    pages: DataFrame,
    key: str = "url",
    card: tuple[str, str] = ("div", "next-events-card"),
    row: str = "tr",
) -> DataFrame:
    """The text of every `row` element in the first `card`, by element name and id.

    A card given with an empty id is any element of that name. No card, no rows.
    """
    card_tag, card_id = card

    def rows_of(html):
        seen = []

        def wanted(tag, attrs, open_elements):
            if not seen:
                if tag == card_tag and (not card_id or attrs.get("id") == card_id):
                    seen.append(tag)
                    return True
                return False
            if not open_elements:
                raise _Finished
            return tag == row

        found = _read(html, wanted)
        return [(i, "".join(_pieces(e))) for i, e in enumerate(found[1:])]

    # Pages without the card's tag are left out before they reach Python; a tag's name is
    # always written as it is, while an id may be written with entities.
    pages = pages.filter(F.contains(F.lower("html"), F.lit(f"<{card_tag.lower()}")))
    return _per_page(pages, key, "pos int, row_text string", rows_of)


def split_row(rows: DataFrame, row_text: Column, strict_by: str | None = None) -> DataFrame:
    """`date` and `event` from a row text: its first line, and its second block.

    Rows without a second block are dropped. With `strict_by` such a row drops every
    row of its page, as a page-wide failure does.
    """
    cleaned = rows.withColumn("_clean", clean_cell_text(row_text)).select(
        *rows.columns,
        first_line(text_block(F.col("_clean"), 0)).alias("date"),
        text_block(F.col("_clean"), 1).alias("event"),
    )
    if strict_by is not None:
        broken = cleaned.filter(F.col("event").isNull()).select(strict_by).distinct()
        cleaned = cleaned.join(broken, strict_by, "left_anti")
    return cleaned.filter(F.col("event").isNotNull())


def rejected_rows(rows: DataFrame, row_text: Column) -> DataFrame:
    """The rows `split_row` drops, for a reject table."""
    block = text_block(clean_cell_text(row_text), 1)
    return rows.filter(block.isNull())


def links(pages: DataFrame, key: str, class_value: str | None = None) -> DataFrame:
    """`href` of the elements whose class attribute equals `class_value`, in order.

    Without `class_value` all `a` elements count. Empty targets are skipped, repeats
    are kept.
    """

    def rows_of(html):
        def wanted(tag, attrs, _):
            if class_value is None:
                return tag == "a" and bool(attrs.get("href"))
            same = attrs.get("class", "").split() == class_value.split()
            return same and bool(attrs.get("href"))

        return [(i, e.attrs.get("href")) for i, e in enumerate(_read(html, wanted))]

    return _per_page(pages, key, "pos int, link string", rows_of)


def sections(
    pages: DataFrame, key: str, tag: str | None = None, class_token: str | None = None
) -> DataFrame:
    """One row per page with its sections, as an array in page order.

    A section is an element of name `tag`, or one carrying `class_token`. Nested
    sections each get their text. Every section has its id, the text of its first
    `h2` and its own text, whose pieces are stripped and joined by a blank.
    """
    schema = "sections array<struct<section_id:string,heading:string,body:string>>"

    def rows_of(html):
        def section(name, attrs):
            return name == tag if tag else class_token in attrs.get("class", "").split()

        def wanted(name, attrs, open_elements):
            return section(name, attrs) or (name == "h2" and bool(open_elements))

        out, headings = [], {}
        for e in _read(html, wanted):
            if e.tag == "h2":
                for outer in e.around:
                    headings.setdefault(id(outer), "".join(_pieces(e)).strip())
            if section(e.tag, e.attrs):
                out.append(e)
        out = [
            {
                "section_id": e.attrs.get("id"),
                "heading": headings.get(id(e)),
                "body": " ".join(filter(None, (t.strip() for t in _pieces(e)))),
            }
            for e in out
        ]
        return [(out,)]

    return _per_page(pages, key, schema, rows_of)


def page_text(
    sectioned: DataFrame,
    drop_ids: Sequence[str] = (),
    drop_heading: str | None = None,
    heading_within: bool = False,
    name: str = "content",
) -> DataFrame:
    """Section texts of each page joined by a blank, unwanted sections left out.

    A section goes when its id is listed or its heading equals `drop_heading`; with
    `heading_within` also when the heading, even an empty one, is part of it.
    """

    def kept(s: Column) -> Column:
        unwanted = F.coalesce(s["section_id"].isin(*drop_ids), F.lit(False)) if drop_ids else F.lit(False)
        if drop_heading is not None:
            same = (
                F.contains(F.lit(drop_heading), s["heading"])
                if heading_within
                else s["heading"] == drop_heading
            )
            unwanted = unwanted | F.coalesce(same, F.lit(False))
        return ~unwanted

    bodies = F.transform(F.filter("sections", kept), lambda s: s["body"])
    return sectioned.withColumn(name, F.array_join(bodies, " ")).drop("sections")
