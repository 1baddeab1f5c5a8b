"""Lookups in the listings table, each for many keys at once.

Latest-per-key lookups aggregate with ``max_by`` and so combine before the
shuffle; none of them ranks a whole key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEM_KEY = ("item_defindex", "item_quality_id")


def live(listings: DataFrame) -> DataFrame:
    return listings.where(~F.col("is_deleted"))


def _recency() -> Column:
    return F.struct("updated_at", "id")


def for_items(listings: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of the requested items only.  Rows without a quality never match."""
    keys = items.select(*ITEM_KEY).distinct()
    return listings.join(keys, list(ITEM_KEY), "left_semi")


# Keys that are written into a filter, so that a scan can leave out files and row groups; beyond, a join decides.
MAX_LITERALS = 1000


def relevant_to(listings: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows a batch of requests can look at: those of their items, or named by them.

    Two reads, each by one key: the filter of few keys reaches the scan, and a table bucketed by ``id``
    is read in the buckets of the named listings only.
    """
    items = requests.select(*ITEM_KEY).distinct().dropna()
    ids = requests.select(F.col("listing_id").alias("id")).distinct().dropna()
    of_items = narrowed(listings, items, "item_defindex").join(items, list(ITEM_KEY), "left_semi")
    named = narrowed(listings, ids, "id").join(ids, "id", "left_semi")
    return of_items.unionByName(named.join(items, list(ITEM_KEY), "left_anti")).select(*listings.columns)


def narrowed(listings: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows with one of the keys in ``column``, as a filter if the keys are few; all rows if not."""
    few = [r[0] for r in keys.select(column).distinct().limit(MAX_LITERALS + 1).collect()]
    return listings if len(few) > MAX_LITERALS else listings.where(F.col(column).isin(few))


def latest_market_names(listings: DataFrame) -> DataFrame:
    """Most recently updated market name per item, deleted rows included."""
    named = listings.where(F.col("market_name").isNotNull())
    return named.groupBy(*ITEM_KEY).agg(F.max_by("market_name", _recency()).alias("market_name"))


def live_ids(listings: DataFrame, items: DataFrame) -> DataFrame:
    """Live (id, steamid) of the requested items."""
    return for_items(live(listings), items).select(*ITEM_KEY, "id", "steamid")


def latest_id_by_seller(listings: DataFrame) -> DataFrame:
    """Most recently updated live listing per (market name, seller)."""
    rows = live(listings).where(F.col("market_name").isNotNull() & F.col("steamid").isNotNull())
    return rows.groupBy("market_name", "steamid").agg(F.max_by("id", _recency()).alias("id"))


def live_listings_for_items(listings: DataFrame, items: DataFrame, *, newest_first: bool = False) -> DataFrame:
    """Live rows of the requested items, optionally most recent first."""
    rows = for_items(live(listings), items).select(*ITEM_KEY, "id", "steamid", "market_name", "updated_at")
    return rows.orderBy(F.desc("updated_at"), "id") if newest_first else rows


def live_listings_by_id(listings: DataFrame, ids: DataFrame) -> DataFrame:
    """Live rows by ``listing_id``; a missing item number reads as zero."""
    wanted = ids.select(F.col("listing_id").alias("id")).distinct()
    return live(listings).join(wanted, "id", "left_semi").select(
        "id",
        "steamid",
        "market_name",
        F.coalesce("item_defindex", F.lit(0)).alias("item_defindex"),
        F.coalesce("item_quality_id", F.lit(0)).alias("item_quality_id"),
    )
