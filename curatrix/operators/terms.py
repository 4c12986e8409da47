"""Which dictionary names occur in a text, by plain substring of one of their terms.

The dictionary is a long table `(name, term)` of any size. Rolling hashes (see `rolling`)
find the places where a term may be, in one reading of each text against two filters of
fixed size; only these candidates become rows, and an equi-join on the bytes of the term
keeps the real ones. Each text row is told apart by a number it gets when it is written,
never by its own columns, so rows with null or equal keys have their own names.

Two narrower ways give the same rows and are taken only on request, for a dictionary
within their bounds: `scan` tests a few terms by one expression, `shipped` sends the names
to the workers, which look candidates up without a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.functions.arrays import empty_strings
from curatrix.functions.text import contains_term
from curatrix.operators.rolling import spelled, term_map, utf8
from curatrix.session import broadcast_if_small, materialise, spread

SCAN_TERMS = 128
SHIPPED_TERMS = 100_000
SHIPPED_CHARS = 2 << 20


def _terms(dictionary: DataFrame, name: str, term: str, ignore_case: bool) -> DataFrame:
    spelled = F.lower(F.col(term)) if ignore_case else F.col(term)
    return (
        dictionary.select(F.col(name).alias("_name"), spelled.alias("_term"))
        .filter(F.col("_name").isNotNull() & (F.col("_term") != ""))
        .distinct()
    )


def _literal_names(rows: list, text: Column) -> Column:
    by_name: dict[str, list[str]] = {}
    for row in rows:
        by_name.setdefault(row["_name"], []).append(row["_term"])
    hits = []
    for name in sorted(by_name):
        hit = F.lit(False)
        for term in sorted(by_name[name]):
            hit = hit | contains_term(text, F.lit(term))
        hits.append(F.when(hit, F.lit(name)))
    found = F.array_compact(F.array(*hits)) if hits else empty_strings()
    return F.when(text.isNotNull(), found).otherwise(empty_strings())


def names_by_scan(texts: DataFrame, text: Column, rows: list, out: str) -> DataFrame:
    """Sorted names per text in one pass, for a dictionary that fits an expression."""
    return spread(texts).withColumn(out, _literal_names(rows, text))


def names_by_shipping(texts: DataFrame, text: Column, terms: DataFrame, rows: list, out: str) -> DataFrame:
    """Sorted names per text; the workers hold the dictionary."""
    if not rows:
        return names_by_scan(texts, text, rows, out)
    names_of: dict[bytes, list[str]] = {}
    for row in rows:
        names_of.setdefault(row["_term"].encode(), []).append(row["_name"])
    spark = texts.sparkSession
    shipped = spark.sparkContext.broadcast((term_map(terms.select("_term").distinct()), names_of))

    @F.arrow_udf("array<string>")
    def found(column: pa.Array) -> pa.Array:
        known, names = shipped.value
        data, offsets = utf8(column)
        lists: list[set[str]] = [set() for _ in range(len(column))]
        for at, term in spelled(data, offsets, known):
            lists[at].update(names.get(term, ()))
        return pa.array([sorted(x) for x in lists], pa.list_(pa.string()))

    return spread(texts).withColumn(out, found(text))


def name_pairs(texts: DataFrame, text: Column, terms: DataFrame) -> DataFrame:
    """Distinct `(_row, _name)` for a dictionary of any size."""
    terms = materialise(terms, "terms")
    spellings = terms.select("_term").distinct()
    shipped = texts.sparkSession.sparkContext.broadcast(term_map(spellings))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            found = list(spelled(data, offsets, shipped.value))
            rows = batch.column(0).take(pa.array([at for at, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([rows, pa.array([b for _, b in found], pa.binary())], names=["_row", "_spelled"])

    candidates = texts.select("_row", text.alias("_text")).mapInArrow(hits, "_row long, _spelled binary")
    known = terms.select(F.encode("_term", "UTF-8").alias("_spelled"), "_name")
    return candidates.join(broadcast_if_small(known), "_spelled").select("_row", "_name").distinct()


def names_by_join(texts: DataFrame, text: Column, terms: DataFrame, out: str) -> DataFrame:
    """Sorted names per text row, for a dictionary of any size."""
    numbered = materialise(spread(texts).withColumn("_row", F.monotonically_increasing_id()), "texts")
    names = (
        name_pairs(numbered, text, terms)
        .groupBy(F.col("_row").alias("_found"))
        .agg(F.array_sort(F.collect_list("_name")).alias("_names"))
    )
    return (
        numbered.join(names, F.col("_row") == F.col("_found"), "left")
        .withColumn(out, F.coalesce("_names", empty_strings()))
        .drop("_row", "_found", "_names")
    )


def _bounded(terms: DataFrame, way: str) -> list:
    """The dictionary's rows, measured before they come to the driver."""
    most = {"scan": SCAN_TERMS, "shipped": SHIPPED_TERMS}[way]
    width = F.length("_term") + F.length(F.col("_name").cast("string"))
    n, chars = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    if n > most or chars > SHIPPED_CHARS:
        raise ValueError(f"{n} terms of {chars} characters are too many for the way {way!r}")
    return terms.collect()


def add_names(
    texts: DataFrame,
    text: str,
    dictionary: DataFrame,
    name: str,
    term: str,
    out: str,
    ignore_case: bool = False,
    way: str = "join",
) -> DataFrame:
    """Add the sorted array of names with at least one term in the text; `[]` if none.

    Rows may repeat and hold nulls; each has the names of its own text. The dictionary
    may have any size; the ways `scan` and `shipped` refuse one beyond their bounds.
    """
    terms = _terms(dictionary, name, term, ignore_case)
    body = F.lower(F.col(text)) if ignore_case else F.col(text)
    if way == "join":
        return names_by_join(texts, body, terms, out)
    rows = _bounded(terms, way)
    return names_by_scan(texts, body, rows, out) if way == "scan" else names_by_shipping(texts, body, terms, rows, out)


def add_keyword_tags(
    texts: DataFrame, text: str, keywords: DataFrame, tag: str, keyword: str, out: str = "tags"
) -> DataFrame:
    """Tags with at least one keyword of the table `keywords` in the text, ignoring case."""
    return add_names(texts, text, keywords, tag, keyword, out, ignore_case=True)


def keyword_tags(text: Column, keywords: dict[str, list[str]]) -> Column:
    """Tags with at least one keyword in the text, ignoring case, in given order."""
    lowered = F.lower(text)
    tags = []
    for tag, words in keywords.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | contains_term(lowered, F.lower(F.lit(word)))
        tags.append(F.when(hit, F.lit(tag)))
    return F.array_compact(F.array(*tags)) if tags else empty_strings()


def without_tags(df: DataFrame, tags: str) -> DataFrame:
    """Rows whose tag list is empty."""
    return df.filter(F.size(tags) == 0)
