"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every job relies on. Skewed join partitions are split by AQE,
# also where that costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # An Arrow batch holds whole texts; these bounds keep a worker's batch small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}


def build_session(app: str = "curatrix", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings applied; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="curatrix-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return root


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A fresh path below the folder the cluster names in `spark.checkpoint.dir`.

    Without that setting only a local master gets a temporary folder, because a
    machine-local path is not visible to the executors of a cluster.
    """
    return os.path.join(_root(spark), f"{spark.sparkContext.applicationId}-{tag}-{uuid.uuid4().hex[:12]}")


def materialise(df: DataFrame, tag: str, by: Sequence[str] = ()) -> DataFrame:
    """Write `df` to the shared folder and read it back, in a folder for each value of `by`.

    Later stages then restart from the written table when an executor is lost,
    and every reader sees the same rows in the same slices. See `forget`.
    """
    path = shared_dir(df.sparkSession, tag)
    df.write.partitionBy(*by).parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def forget(stored: DataFrame) -> None:
    """Remove what `materialise` wrote for this frame, once nothing reads it any more."""
    path = getattr(stored, "_stored_at", None)
    if path is not None:
        remove(stored.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def forget_all(spark: SparkSession) -> int:
    """Remove every intermediate table that this application has left; returns how many.

    For the end of a job, when none of its frames is read any more.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(_root(spark), f"{spark.sparkContext.applicationId}-*"))
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in files.globStatus(pattern) or ()]
    for path in found:
        files.delete(path, True)
    return len(found)


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000, max_bytes: int = 32 << 20) -> DataFrame:
    """Mark `df` for broadcast only after its rows and bytes were measured.

    Beyond the bound the frame is returned unmarked and the join shuffles.
    """
    width = sum(
        (F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c in df.columns),
        F.lit(0),
    )
    n_rows, n_bytes = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))
    ).first()
    return F.broadcast(df) if n_rows <= max_rows and n_bytes <= max_bytes else df


def settle(df: DataFrame, tag: str) -> DataFrame:
    """`df` for a caller that reads it more than once.

    A frame that comes straight from storage is returned as it is; any other is written
    once instead of being computed again.
    """
    return df if _is_scan(df) else materialise(df, tag)


# A table beyond this has splits enough; dealing it out anew would cost more than it gives.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Give a CPU-heavy step over a small scan one partition per core.

    A small file may be one split, whatever it costs to work on. Only frames that come
    straight from storage are looked at, and their size is known before anything runs.
    """
    if not _is_scan(df):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size < min(SPREAD_BYTES, cores * split) else df


def _is_scan(df: DataFrame) -> bool:
    """Whether the logical plan is a stored table under nothing but plain projections and filters."""
    node = df._jdf.queryExecution().analyzed()
    python = df.sparkSession._jvm.org.apache.spark.sql.catalyst.trees.TreePattern.PYTHON_UDF()
    if node.containsPattern(python):
        return False
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
        node = node.children().head()
    return node.nodeName() in ("LogicalRelation", "DataSourceV2Relation")
