"""Export of every base table of an inventory."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curatrix.sinks.tables import write_bounded

MANIFEST = "table string, path string, n_rows bigint, status string, error string"


def _listed(inventory: DataFrame) -> Iterator:
    return (
        inventory.filter(F.col("table_id").isNotNull())
        .select("dataset_id", "table_id", "table_type")
        .orderBy("dataset_id", "table_id")
        .toLocalIterator()
    )


def export_tables(
    inventory: DataFrame,
    load: Callable[[SparkSession, str, str], DataFrame],
    root: str,
    fmt: str = "parquet",
    rows_per_file: int = 10_000_000,
    at_once: int = 4,
    max_bytes: int | None = None,
) -> DataFrame:
    """Write each base table to `<root>/<dataset>/<table>` and return a manifest.

    The driver loops over table names only; every table is one distributed write, and
    `at_once` of them run side by side. Rows are counted as they are written. A failed
    table is recorded with its whole error and the run goes on. `fmt="avro"` needs the
    external Avro module on the class path.

    A table is sharded into files of at most `rows_per_file` rows. With `max_bytes` files
    are bounded in bytes too: a row counts with the size of its JSON text, which the
    columnar and binary formats stay below.
    """
    spark = inventory.sparkSession

    def write(entry) -> tuple:
        name = f"{entry.dataset_id}.{entry.table_id}"
        if entry.table_type != "TABLE":
            note = f"{name} is a {entry.table_type}, not a base table"
            return name, None, None, "skipped", note
        relative = f"{entry.dataset_id}/{entry.table_id}"
        path = f"{root.rstrip('/')}/{relative}"
        try:
            rows = load(spark, entry.dataset_id, entry.table_id)
            if max_bytes is not None:
                text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
                n_rows = write_bounded(rows, F.octet_length(text), max_bytes, path, fmt, rows_per_file=rows_per_file)
                return name, relative, n_rows, "done", None
            counted = Observation()
            rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
            rows.write.mode("overwrite").format(fmt).option("maxRecordsPerFile", rows_per_file).save(path)
            return name, relative, counted.get["n"], "done", None
        except Exception as failure:  # noqa: BLE001 - recorded per table
            return name, relative, None, "failed", str(failure)

    with ThreadPoolExecutor(at_once) as pool:
        manifest = list(pool.map(write, _listed(inventory)))
    return spark.createDataFrame(manifest, MANIFEST)
