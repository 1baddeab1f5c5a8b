"""Event kinds, and the two origins of a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.schemas import DELETE_EVENT, UPDATE_EVENT


def updates(events: DataFrame) -> DataFrame:
    return events.where(F.col("event") == UPDATE_EVENT)


def deletes(events: DataFrame) -> DataFrame:
    return events.where(F.col("event") == DELETE_EVENT)


def origin(generation_timestamp: Column) -> Column:
    """A stamped event comes from reconciliation, an unstamped one from the feed."""
    return F.when(generation_timestamp.isNull(), "realtime").otherwise("backfill")


def union_events(live: DataFrame, reconciled: DataFrame | None = None) -> DataFrame:
    """Feed events together with reconciliation events, if there are any."""
    return live if reconciled is None else live.unionByName(reconciled)
