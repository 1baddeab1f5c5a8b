"""Listing identifiers: built from a market side's parts, or classified by shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stallkeeper.functions.text import nonblank


def sell_id(appid: Column, asset_id: Column) -> Column:
    """``{appid}_{asset}``; null for a blank asset."""
    asset = asset_id.cast("string")
    return F.when(nonblank(asset), F.concat_ws("_", appid.cast("string"), asset))


def buy_id(appid: Column, steamid: Column, market_name: Column) -> Column:
    """``{appid}_{steamid}_{md5(market name)}``; null for a blank seller or name."""
    return F.when(
        nonblank(steamid) & nonblank(market_name),
        F.concat_ws("_", appid.cast("string"), steamid, name_hash(market_name)),
    )


def name_hash(market_name: Column) -> Column:
    """Lower-case hex MD5 of the UTF-8 name."""
    return F.md5(market_name.cast("binary"))


def listing_id(intent: Column, appid: Column, asset_id: Column, steamid: Column, market_name: Column) -> Column:
    """Identifier by intent, whatever its case; null when it cannot be built."""
    side = F.lower(intent)
    return F.when(side == "sell", sell_id(appid, asset_id)).when(
        side == "buy", buy_id(appid, steamid, market_name)
    )


def listing_id_error(
    intent: Column, appid: Column, asset_id: Column, steamid: Column, market_name: Column
) -> Column:
    """Why :func:`listing_id` is null, or null when it is not."""
    side = F.lower(intent)
    return (
        F.when(F.coalesce(~side.isin("buy", "sell"), F.lit(True)), "unknown_intent")
        .when((side == "sell") & ~nonblank(asset_id.cast("string")), "blank_asset")
        .when((side == "buy") & ~nonblank(steamid), "blank_seller")
        .when((side == "buy") & ~nonblank(market_name), "blank_market_name")
    )


def underscores(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("_"), F.lit("")))


def is_buy_id(c: Column) -> Column:
    return F.coalesce(underscores(c) == 2, F.lit(False))


def is_sell_id(c: Column) -> Column:
    return F.coalesce(underscores(c) == 1, F.lit(False))
