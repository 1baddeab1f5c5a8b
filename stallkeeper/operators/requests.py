"""Type, acceptance and dispatch of reconciliation requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.functions.text import nonblank

# Which parts of the work a request type asks for.  A further type is added by
# passing a larger mapping to `classify`.
PARTS_BY_TYPE = {
    "FULL": ("buy", "sell"),
    "BUY_ONLY": ("buy",),
    "SELL_ONLY": ("sell",),
    "SINGLE_ID": ("single",),
}
PARTS = ("buy", "sell", "single")


def effective_type(request_type: Column, listing_id: Column) -> Column:
    """Given type, else a single listing when one is named, else everything."""
    return F.coalesce(request_type, F.when(nonblank(listing_id), "SINGLE_ID"), F.lit("FULL"))


def _inventory_limit_bad() -> Column:
    return F.coalesce(F.col("max_inventory_size") <= 0, F.lit(False))


def refusal(parts_by_type: dict[str, tuple[str, ...]] = PARTS_BY_TYPE) -> Column:
    """Why the request of ``effective_type`` cannot be handled, or null."""
    kind = F.col("effective_type")

    def types_with(part: str) -> list[str]:
        return [t for t, parts in parts_by_type.items() if part in parts]

    for_item = kind.isin(*(set(types_with("buy")) | set(types_with("sell"))))
    sell_alone = kind.isin(*[t for t in types_with("sell") if "buy" not in parts_by_type[t]])
    return (
        F.when(~kind.isin(*parts_by_type), "unknown_type")
        .when(for_item & F.coalesce(F.col("item_defindex") <= 0, F.lit(True)), "item_defindex")
        .when(for_item & F.coalesce(F.col("item_quality_id") < 0, F.lit(True)), "item_quality_id")
        .when(sell_alone & _inventory_limit_bad(), "max_inventory_size")
        .when(kind.isin(*types_with("single")) & ~nonblank(F.col("listing_id")), "listing_id")
    )


def classify(requests: DataFrame, parts_by_type: dict[str, tuple[str, ...]] = PARTS_BY_TYPE) -> DataFrame:
    """Adds ``effective_type``, ``refusal`` and one ``wants_*`` flag per part.

    The sell part of a request for both sides is left out, without a failure,
    when its inventory limit is not positive.
    """
    typed = requests.withColumn("effective_type", effective_type(F.col("request_type"), F.col("listing_id")))
    accepted = typed.withColumn("refusal", refusal(parts_by_type))

    def wants(part: str) -> Column:
        types = [t for t, parts in parts_by_type.items() if part in parts]
        return F.col("refusal").isNull() & F.col("effective_type").isin(*types)

    return accepted.select(
        "*",
        wants("buy").alias("wants_buy"),
        (wants("sell") & ~_inventory_limit_bad()).alias("wants_sell"),
        wants("single").alias("wants_single"),
    )
