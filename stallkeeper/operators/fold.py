"""Collapse of many events per listing into one change per listing.

A change remembers the fields of the latest update, the kind of the latest
event, and when the listing was first updated and last touched.  That is enough
to apply it to any stored row, and it composes: folding changes of consecutive
batches gives the change of all their events.  ``max_by`` aggregates partially
before the shuffle, so a listing with very many events reaches its reducer as
one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.functions.rows import listing_fields, row_defect
from stallkeeper.schemas import DELETE_EVENT, UPDATE_EVENT

ORDER_COLUMNS = ("ord_time", "ord_partition", "ord_offset", "ord_pos")


def table_events(events: DataFrame, touched_at: Column) -> DataFrame:
    """Flattened updates and deletes, each with its order and write time.

    Other kinds are dropped.  Updates that cannot become a row and deletes
    without an identifier are left out; :func:`unwritable` has them.
    """
    p = F.col("payload")
    is_update = F.col("event") == UPDATE_EVENT
    writable = (is_update & row_defect(p).isNull()) | (
        (F.col("event") == DELETE_EVENT) & p["id"].isNotNull()
    )
    return events.where(writable).select(
        p["id"].alias("id"),
        F.struct(*ORDER_COLUMNS).alias("event_order"),
        is_update.alias("is_update"),
        F.when(is_update, listing_fields(p)).alias("fields"),
        touched_at.cast("bigint").alias("touched_at"),
    )


def unwritable(events: DataFrame) -> DataFrame:
    """Updates and deletes left out of the table, with the reason in ``defect``."""
    p = F.col("payload")
    defect = F.when(F.col("event") == UPDATE_EVENT, row_defect(p)).when(
        (F.col("event") == DELETE_EVENT) & p["id"].isNull(), "no_id"
    )
    return events.withColumn("defect", defect).where(F.col("defect").isNotNull())


def fold(events: DataFrame) -> DataFrame:
    """One change per listing from :func:`table_events` rows."""
    update_order = F.when(F.col("is_update"), F.col("event_order"))
    return events.groupBy("id").agg(
        F.max_by("fields", update_order).alias("fields"),
        F.max(update_order).alias("update_order"),
        F.max_by("is_update", "event_order").alias("ends_live"),
        F.max("event_order").alias("event_order"),
        F.min(F.when(F.col("is_update"), F.col("touched_at"))).alias("first_update_at"),
        F.max("touched_at").alias("touched_at"),
    )


def refold(changes: DataFrame, *before: str) -> DataFrame:
    """One change per listing from the changes of several batches.

    ``before`` names columns that order changes ahead of their events' own
    order; a batch number there makes a later batch win whatever its events'
    times, as it would if batches were merged one by one.
    """
    update_order = F.when(F.col("fields").isNotNull(), F.struct(*before, "update_order"))
    event_order = F.struct(*before, "event_order")
    folded = changes.groupBy("id").agg(
        F.max_by("fields", update_order).alias("fields"),
        F.max(update_order).alias("update"),
        F.max_by("ends_live", event_order).alias("ends_live"),
        F.max(event_order).alias("event"),
        F.min("first_update_at").alias("first_update_at"),
        F.max("touched_at").alias("touched_at"),
    )
    return folded.select(
        "id",
        "fields",
        F.col("update.update_order").alias("update_order"),
        "ends_live",
        F.col("event.event_order").alias("event_order"),
        "first_update_at",
        "touched_at",
    )
