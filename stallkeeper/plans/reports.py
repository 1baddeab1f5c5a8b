"""Reports over the listings table.  The moment they look back from is a parameter."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.functions.times import ms_ago
from stallkeeper.operators import merge
from stallkeeper.operators.lookups import ITEM_KEY


# Result column, the time it looks at, and how far back.
ACTIVITY = {
    "last_hour_updates": ("updated_at", {"hours": 1}),
    "last_hour_new": ("created_at", {"hours": 1}),
    "last_minutes_updates": ("updated_at", {"minutes": 5}),
    "last_day_updates": ("updated_at", {"days": 1}),
}


def activity(
    listings: DataFrame, now: Column | None = None, windows: dict[str, tuple[str, dict[str, int]]] | None = None
) -> DataFrame:
    """Size of the table and its recent changes, in windows as :data:`ACTIVITY` names them."""
    counts = [
        F.count_if(F.col(column) > ms_ago(now, **back)).alias(name)
        for name, (column, back) in (ACTIVITY if windows is None else windows).items()
    ]
    return listings.agg(F.count("*").alias("total_listings"), *counts)


def by_item(listings: DataFrame, defindexes: list[int] | None = None) -> DataFrame:
    """Listings per item and side with the last update, ordered by item."""
    chosen = listings if defindexes is None else listings.where(F.col("item_defindex").isin(*defindexes))
    return (
        chosen.groupBy(*ITEM_KEY)
        .agg(
            F.count("*").alias("total_listings"),
            F.count_if(F.col("intent") == "buy").alias("buy_listings"),
            F.count_if(F.col("intent") == "sell").alias("sell_listings"),
            F.max("updated_at").alias("last_update"),
        )
        .orderBy(*ITEM_KEY)
    )


def item_deltas(current: DataFrame, changes: DataFrame) -> DataFrame:
    """What one batch of folded changes does to :func:`by_item`, per item: counts to add, times gained and lost.

    A changed listing is taken back from the item and side it had and added to those it has now.  Of the
    table only the changed listings are looked at: one join on ``id``, which reads a bucketed table in place.
    """
    old = current.join(changes.select("id"), "id", "left_semi")
    new = merge.merge(old, changes)
    columns = [*ITEM_KEY, "intent", "updated_at"]
    moves = old.select(*columns, F.lit(-1).alias("sign")).unionByName(new.select(*columns, F.lit(1).alias("sign")))
    sign, intent = F.col("sign"), F.col("intent")
    return moves.groupBy(*ITEM_KEY).agg(
        F.sum(sign).alias("total_listings"),
        F.sum(F.when(intent == "buy", sign).otherwise(0)).alias("buy_listings"),
        F.sum(F.when(intent == "sell", sign).otherwise(0)).alias("sell_listings"),
        F.max(F.when(sign > 0, F.col("updated_at"))).alias("gained_at"),
        F.max(F.when(sign < 0, F.col("updated_at"))).alias("lost_at"),
    )


def by_item_after(report: DataFrame, deltas: DataFrame, listings: DataFrame) -> DataFrame:
    """:func:`by_item` of the table after a batch, from the report before it and the batch's deltas.

    ``listings`` is the table after the batch.  It is read only for items whose last update may be one
    that went: the last update of an item cannot be taken back from a maximum.
    """
    counts = ["total_listings", "buy_listings", "sell_listings"]
    r, d = report.alias("r"), deltas.alias("d")
    same = reduce(Column.__and__, [F.col(f"r.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ITEM_KEY])
    # A null key is a key of its own, so presence needs a column that is never null.
    met = r.join(d, same, "full_outer").select(
        *[F.when(F.col("r.total_listings").isNotNull(), F.col(f"r.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in ITEM_KEY],
        *[(F.coalesce(f"r.{c}", F.lit(0)) + F.coalesce(f"d.{c}", F.lit(0))).cast("bigint").alias(c) for c in counts],
        F.greatest("r.last_update", "d.gained_at").alias("last_update"),
        F.coalesce((F.col("d.lost_at") >= F.col("r.last_update")) & ~(F.col("d.gained_at") >= F.col("d.lost_at")).eqNullSafe(True), F.lit(False)).alias("is_open"),
    )
    left = met.where(F.col("total_listings") > 0)
    items = left.where("is_open").select(*ITEM_KEY)
    l, i = listings.alias("l"), items.alias("i")
    same = reduce(Column.__and__, [F.col(f"l.{c}").eqNullSafe(F.col(f"i.{c}")) for c in ITEM_KEY])
    again = l.join(i, same, "left_semi").groupBy(*ITEM_KEY).agg(F.max("updated_at").alias("found_at"))
    m, a = left.alias("m"), again.alias("a")
    same = reduce(Column.__and__, [F.col(f"m.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ITEM_KEY])
    last = F.when(F.col("is_open"), F.col("found_at")).otherwise(F.col("last_update")).alias("last_update")
    return m.join(a, same, "left").select(*[f"m.{c}" for c in ITEM_KEY], *counts, last)


def price_ladder(listings: DataFrame, defindex: int, quality: int) -> DataFrame:
    """One item's listings from the cheapest up; listings without a value come last."""
    return listings.where(
        (F.col("item_defindex") == defindex) & (F.col("item_quality_id") == quality)
    ).orderBy(F.asc_nulls_last("raw_value"), "id")


def browse(listings: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of the table by identifier."""
    return listings.orderBy("id").limit(rows)
