"""Session settings the library relies on, and tables written to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Meaning, not tuning: UTC times, and the last of repeated JSON keys wins.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Runtime re-planning; broadcasts stay behind Spark's own size checks.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# For sessions that parse messages: without it, every field that is used of an exploded event is taken from the
# whole list by itself, before the list is exploded, and the reading of the list is worked out for each.
PARSING = {"spark.sql.optimizer.expression.nestedPruning.enabled": "false"}

# Returns its input as a stored table, or as it is when nothing is to be stored.
Cut = Callable[[DataFrame, str], DataFrame]


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on; leaves cluster sizing to the cluster."""
    for key, value in {**SEMANTICS, **ADAPTIVE}.items():
        spark.conf.set(key, value)
    return spark


def configure_parsing(spark: SparkSession) -> SparkSession:
    """:func:`configure`, and what makes parsing of messages cheaper."""
    for key, value in PARSING.items():
        spark.conf.set(key, value)
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A local session without one gets a temporary folder; a cluster without one
    is an error, as a machine-local folder would be lost with its machine.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="stallkeeper-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back: short lineage, and a size the planner knows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_cut(spark: SparkSession, folder: str | None = None) -> Cut:
    """A cut that writes each named step below ``folder`` (a fresh one by default)."""
    base = folder or f"{shared_dir(spark)}/cuts/{uuid.uuid4().hex}"
    return lambda df, name: stored(df, f"{base}/{name}")


def drop(spark: SparkSession, path: str) -> None:
    """Delete a table that no one reads any more, wherever it lies."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop_path, True)


def no_cut(df: DataFrame, name: str) -> DataFrame:
    """Leave the plan whole; right for small inputs and for inspecting plans."""
    return df
