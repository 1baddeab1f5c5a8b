"""Application of changes to the listings table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeeper.schemas import LISTING_FIELDS, LISTINGS


def merge(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Next state of the table.

    An update replaces every field, revives a deleted row and keeps
    ``created_at``; a delete only marks a stored row; a delete of an unknown
    listing does nothing.  One join on ``id``: a table bucketed by ``id`` is
    read in place and only the changes are shuffled.
    """
    names = [f.name for f in LISTING_FIELDS.fields]
    joined = current.alias("c").join(changes.alias("n"), F.col("c.id") == F.col("n.id"), "full_outer")
    touched, updated = F.col("n.id").isNotNull(), F.col("n.fields").isNotNull()
    columns = [F.coalesce("c.id", "n.id").alias("id")]
    columns += [
        F.when(updated, F.col(f"n.fields.{name}")).otherwise(F.col(f"c.{name}")).alias(name) for name in names
    ]
    columns += [
        F.when(touched, ~F.col("n.ends_live")).otherwise(F.col("c.is_deleted")).alias("is_deleted"),
        F.coalesce("c.created_at", "n.first_update_at").alias("created_at"),
        F.when(touched, F.col("n.touched_at")).otherwise(F.col("c.updated_at")).alias("updated_at"),
    ]
    known = F.col("c.id").isNotNull() | updated
    return joined.where(known).select(*columns)


def first_state(changes: DataFrame) -> DataFrame:
    """State of a table that held nothing before ``changes``; needs no join."""
    names = [f.name for f in LISTING_FIELDS.fields]
    return changes.where(F.col("fields").isNotNull()).select(
        "id",
        *[F.col(f"fields.{name}") for name in names],
        (~F.col("ends_live")).alias("is_deleted"),
        F.col("first_update_at").alias("created_at"),
        F.col("touched_at").alias("updated_at"),
    )


def empty_table(spark) -> DataFrame:
    return spark.createDataFrame([], LISTINGS)
