"""Delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatrix.functions.text import unescape_lines

# Quotes inside a quoted value are doubled, as spreadsheet tools write them.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    index_column: bool = False,
    multi_line: bool = False,
    one_line: bool = False,
) -> DataFrame:
    """Typed CSV scan; a row that does not fit the schema fails the job.

    An empty value is missing, quoted or not, as in a data-frame reader.
    The header is checked against the schema. `index_column` drops a leading, usually
    unnamed row-index column that `schema` does not list; the header is then not checked.
    `multi_line` is needed where values or headers hold line breaks; such files
    cannot be split, so write them in parts of bounded size (see `write_csv`). `one_line`
    reads values whose line breaks were escaped, from files of any size.
    """
    declared = schema
    if index_column:
        declared = T.StructType([T.StructField("_row_index", T.StringType()), *schema.fields])
    df = (
        spark.read.schema(declared)
        .options(
            **CSV_OPTIONS,
            mode="FAILFAST",
            multiLine=str(multi_line).lower(),
            enforceSchema=str(index_column).lower(),
        )
        .csv(path)
    )
    if one_line:
        texts = {f.name: unescape_lines(F.col(f"`{f.name}`")) for f in schema.fields if isinstance(f.dataType, T.StringType)}
        df = df.withColumns(texts) if texts else df
    return df.drop("_row_index") if index_column else df


def scan_csv_columns(
    spark: SparkSession, path: str, columns: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Columns picked by header name as `(header, new name, type)`.

    Headers may hold line breaks. Values are read as text and cast, so only the
    picked columns are converted.
    """
    raw = spark.read.options(**CSV_OPTIONS, multiLine="true", inferSchema="false").csv(path)
    return raw.select(*[F.col(f"`{header}`").cast(kind).alias(name) for header, name, kind in columns])
