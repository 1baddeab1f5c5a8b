"""Flattening of a listing payload into the columns of the listings table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallkeeper.functions.text import nonblank
from stallkeeper.functions.times import seconds_to_ms
from stallkeeper.schemas import LISTING_FIELDS


def _zero(parent: Column, name: str) -> Column:
    """A primitive field: missing reads as zero, a missing parent as null."""
    return F.when(parent.isNotNull(), F.coalesce(parent[name], F.lit(0)))


def _kept_texts(texts: Column) -> Column:
    kept = F.filter(texts, nonblank)
    return F.when(F.size(kept) > 0, kept)


def spell_ids(item: Column) -> Column:
    """Identifiers of the item's spells, blanks left out; null when none is left."""
    return _kept_texts(F.transform(item["spells"], lambda s: s["id"]))


def strange_part_ids(item: Column) -> Column:
    """Identifiers of the item's counters as text; null when there is none."""
    return _kept_texts(
        F.transform(item["strangeParts"], lambda s: _zero(s["killEater"], "id").cast("string"))
    )


def listing_fields(p: Column) -> Column:
    """Struct of the table fields an upsert writes, from a payload struct."""
    item, user, paint, value = p["item"], p["user"], p["item"]["paint"], p["value"]
    expressions = {
        "steamid": p["steamid"],
        "item_defindex": _zero(item, "defindex"),
        "item_quality_id": _zero(item["quality"], "id"),
        "intent": p["intent"],
        "appid": _zero(p, "appid"),
        "metal": p["currencies"]["metal"],
        "keys": p["currencies"]["keys"],
        "raw_value": _zero(value, "raw"),
        "short_value": value["short"],
        "long_value": value["long"],
        "details": p["details"],
        "listed_at": seconds_to_ms(p["listedAt"]),
        "market_name": item["marketName"],
        "status": p["status"],
        "user_agent_client": p["userAgent"]["client"],
        "user_name": user["name"],
        "user_premium": user["premium"],
        "user_online": user["online"],
        "user_banned": user["banned"],
        "user_trade_offer_url": user["tradeOfferUrl"],
        "item_tradable": item["tradable"],
        "item_craftable": item["craftable"],
        "item_quality_color": item["quality"]["color"],
        "item_particle_name": item["particle"]["name"],
        "item_particle_type": item["particle"]["type"],
        "bumped_at": seconds_to_ms(p["bumpedAt"]),
        "spell_ids": spell_ids(item),
        "strange_part_ids": strange_part_ids(item),
        "paint_id": _zero(paint, "id"),
        "paint_name": paint["name"],
        "paint_color": paint["color"],
        "paint_secondary_hex": item["paintSecondaryHex"],
    }
    return F.struct(
        *[expressions[f.name].cast(f.dataType).alias(f.name) for f in LISTING_FIELDS.fields]
    )


def row_defect(p: Column) -> Column:
    """Why a payload cannot become a table row, or null when it can."""
    return (
        F.when(p.isNull(), "no_payload")
        .when(p["id"].isNull(), "no_id")
        .when(p["steamid"].isNull(), "no_seller")
        .when(p["intent"].isNull(), "no_intent")
        .when(p["item"].isNull(), "no_item")
    )
