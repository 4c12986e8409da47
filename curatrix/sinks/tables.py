"""Table and file sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatrix.functions.arrays import list_text
from curatrix.functions.text import escape_lines
from curatrix.session import forget, materialise, remove
from curatrix.sources.files import CSV_OPTIONS


def write_table(df: DataFrame, target: str, mode: str = "overwrite", fmt: str = "parquet") -> str:
    """Replace (or extend) a table, or a folder when `target` holds a slash.

    A replacement is written beside the old rows and takes their place when it is
    complete, so a frame may read the target that it replaces, and a job that fails
    leaves the old rows as they were. A folder is moved into place; a table is filled from
    the complete copy. A frame that was made from the old rows must be read anew.
    """
    if mode != "overwrite":
        writer = df.write.mode(mode).format(fmt)
        writer.save(target) if "/" in target else writer.saveAsTable(target)
    elif "/" in target:
        _replace_folder(df, target, fmt)
    else:
        copy = materialise(df, "replacement")
        copy.write.mode("overwrite").format(fmt).saveAsTable(target)
        forget(copy)
    return target


def _replace_folder(df: DataFrame, target: str, fmt: str) -> None:
    spark = df.sparkSession
    beside = f"{target.rstrip('/')}.{uuid.uuid4().hex[:12]}"
    df.write.mode("error").format(fmt).save(f"{beside}.new")
    jvm = spark._jvm
    new, old, goal = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{beside}.new", f"{beside}.old", target.rstrip("/")))
    files = goal.getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = files.exists(goal)
    if replaced and not files.rename(goal, old):
        raise OSError(f"{target} cannot be moved aside; the new rows are in {beside}.new")
    if not files.rename(new, goal):
        raise OSError(f"{target} cannot be put in place; the new rows are in {beside}.new, the old in {beside}.old")
    if replaced:
        files.delete(old, True)


def stamped_path(root: str, name: str, at: datetime) -> str:
    """Output path with the run time in its name, such as `articles_feb01_1504`."""
    return f"{root.rstrip('/')}/{name}_{at.strftime('%b%d_%H%M').lower()}"


def write_stamped(df: DataFrame, root: str, name: str, at: datetime, fmt: str = "parquet") -> str:
    """Write a frame below its stamped path, which the run's time sets apart; returns it."""
    return write_table(df, stamped_path(root, name, at), fmt=fmt)


def _text_row(df: DataFrame, one_line: bool) -> DataFrame:
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            column = list_text(column)
        if one_line and isinstance(field.dataType, (T.ArrayType, T.StringType)):
            column = escape_lines(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def write_bounded(
    rows: DataFrame,
    size: Column,
    max_bytes: int,
    path: str,
    fmt: str,
    options: Mapping[str, str] = MappingProxyType({}),
    rows_per_file: int = 1 << 40,
) -> int:
    """Replace a folder by files of at most `max_bytes` and `rows_per_file` rows; returns the number of rows.

    `size` are the bytes that a row takes. A task's rows make one file where they stay
    within the bound. The others are written by size: rows of which two, four, eight, ...
    always fit into a file are written together, so many to a file, and a row of more than
    half the bound gets a file of its own; only a single row can exceed it. A task writes
    file after file, so tasks follow the bytes and not the number of files, and no row is
    shuffled for it. A write that fails leaves no files.
    """
    spark = rows.sparkSession
    columns = [F.col(f"`{c}`") for c in rows.columns]
    size = F.coalesce(size.cast("long"), F.lit(0))
    fit = F.greatest(F.floor(F.lit(max_bytes) / F.greatest("_size", F.lit(1))), F.lit(1))
    measured = materialise(
        rows.withColumn("_size", size)
        .withColumn("_task", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_doublings", F.length(F.bin(fit)) - 1)
        .sortWithinPartitions("_doublings", "_at"),
        "bounded-rows",
        by=["_doublings"],
    )
    n_rows, mode = 0, "overwrite"

    def save(part: DataFrame, most: int) -> None:
        nonlocal n_rows, mode
        counted = Observation()
        part = part.select(*columns).observe(counted, F.count(F.lit(1)).alias("n"))
        part.write.mode(mode).format(fmt).options(**options).option("maxRecordsPerFile", most).save(path)
        n_rows, mode = n_rows + counted.get["n"], "append"

    # One number for each task that wrote rows.
    sums = measured.groupBy("_task").agg(F.sum("_size").alias("all")).filter(F.col("all") <= max_bytes)
    tasks = [(t["_task"], n) for n, t in enumerate(sums.select("_task").orderBy("_task").collect())]
    whole = F.broadcast(spark.createDataFrame(tasks, "_task int, _file int"))
    others = measured.join(whole, "_task", "left_anti") if tasks else measured
    doublings = sorted(r["_doublings"] for r in others.select("_doublings").distinct().collect())
    try:
        if tasks or not doublings:
            parts = measured.join(whole, "_task").repartitionById(max(1, len(tasks)), "_file")
            save(parts.sortWithinPartitions("_at"), rows_per_file)
        for n in doublings:
            save(others.filter(F.col("_doublings") == n), min(rows_per_file, 1 << n))
    except Exception:
        remove(spark, path)
        raise
    finally:
        forget(measured)
    return n_rows


def write_csv(df: DataFrame, path: str, max_bytes: int = 128 << 20, one_line: bool = False) -> str:
    """CSV folder with a header, in files of at most `max_bytes`; array columns become JSON text.

    Lines are measured as they will be written (see `write_bounded`). `one_line` escapes
    line breaks in values, so that readers can split a file (see `scan_csv`).
    """
    flat = _text_row(df, one_line)
    # The JVM's own writer measures the line; two bytes for its end.
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    line = F.to_csv(F.struct(*[F.col(f"`{c}`").cast("string") for c in flat.columns]), options)
    write_bounded(flat, F.octet_length(line) + 2, max_bytes, path, "csv", CSV_OPTIONS)
    return path
