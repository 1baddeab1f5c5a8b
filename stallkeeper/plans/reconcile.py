"""Reconciliation of the listings table with what is on the market.

All requests of a batch run as one plan: requests meet the snapshot of their
item, every listing the snapshot implies meets its landed detail, and the
stored listings that were not confirmed are deleted.  A request type only says
which parts (`buy`, `sell`, `single`) it wants.

Scale: requests are the small side and meet the large tables first, so those
are read once and filtered at the scan's side of the join; whether requests are
broadcast is left to Spark's size checks, which know the size because
intermediate steps are stored (``cut``).  Landed responses are filtered by the
keys that requests need before any of their text is read.  Groups are by (request, listing) or
(request, seller).  Nothing is ever gathered per request, as one item may hold
a large share of all listings: per-request facts are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.functions.ids import buy_id, is_buy_id, is_sell_id, sell_id
from stallkeeper.functions.text import nonblank
from stallkeeper.operators import lookups
from stallkeeper.operators.requests import PARTS_BY_TYPE, classify
from stallkeeper.schemas import APPID, DELETE_EVENT, PAYLOAD, UPDATE_EVENT
from stallkeeper.session import Cut, no_cut
from stallkeeper.sources.landing import details, inventories, snapshot_entries, snapshot_states

FAIL, SKIP = "fail", "skip"

# Stage of an event within its request, in emission order.
BUY_UPDATE, BUY_DELETE, SELL_UPDATE, SELL_DELETE = range(4)


@dataclass(frozen=True)
class Market:
    """Stored listings, and the landed responses: raw, or as `sources.landing` reads them.

    Raw rows are parsed here, after those that no request needs are left out.
    """

    listings: DataFrame
    snapshots: DataFrame
    details: DataFrame
    inventories: DataFrame


@dataclass(frozen=True)
class Options:
    """``assume_complete``: what has not landed never will; a detail that did not
    land counts as gone, a snapshot as null, an inventory as unreadable.
    Otherwise a request that needs it stays pending and emits nothing.

    ``missing_buy_detail``: ``fail`` stops the request at the first buy listing
    without a detail (what came before is kept, nothing is deleted); ``skip``
    treats such a listing as not on the market.

    ``max_age_ms``: a response fetched longer than this before the request does
    not answer it; unset, any age will do.
    """

    assume_complete: bool = False
    missing_buy_detail: str = FAIL
    max_age_ms: int | None = None


@dataclass(frozen=True)
class Steps:
    """Intermediate tables of a reconciliation."""

    located: DataFrame  # requests with market name and snapshot state
    stored: DataFrame  # (request, stored live listing)
    buy_rows: DataFrame  # (request, snapshot buy listing)
    sell_rows: DataFrame  # (request, snapshot sell listing)
    scans: DataFrame  # (request, seller) with the inventory's matching items
    answered: DataFrame  # (request, candidate listing) with its detail
    sellers: DataFrame  # (request, seller) with the first item that has a detail
    verdicts: DataFrame  # one row per request: status and how far it got


def wanted_only(landed: DataFrame, wanted: DataFrame, key: str, reader: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Landed responses that some row of ``wanted`` asks for, read; already read ones are only filtered."""
    keys = wanted.where(F.col(key).isNotNull()).select(key).distinct()
    chosen = landed.join(keys, key, "left_semi")
    return reader(chosen) if "body" in landed.columns else chosen


def _is_fresh(fetched_at: str, options: Options) -> Column:
    """The response is young enough for the request asked at ``asked_at``."""
    if options.max_age_ms is None:
        return F.lit(True)
    return F.coalesce(F.col(fetched_at) >= F.col("asked_at") - options.max_age_ms, F.lit(False))


def named_requests(requests: DataFrame, market: Market, parts_by_type=PARTS_BY_TYPE) -> DataFrame:
    """Classified requests with the latest market name of their item."""
    classified = classify(requests, parts_by_type)
    names = lookups.latest_market_names(lookups.for_items(market.listings, _item_requests(classified)))
    named = classified.join(names, list(lookups.ITEM_KEY), "left")
    return named.select(*classified.columns, "market_name", F.col("generation_timestamp").alias("asked_at"))


def locate(named: DataFrame, snapshots: DataFrame, options: Options) -> DataFrame:
    """Named requests with the state of their item's snapshot."""
    assume_complete = options.assume_complete
    states = snapshot_states(snapshots.where(F.col("appid") == APPID))
    absent = "null" if assume_complete else "pending"
    state = F.when(
        F.col("market_name").isNotNull(),
        F.coalesce(
            F.when(F.lit(assume_complete) & (F.col("snapshot_state") == "pending"), "null"),
            F.when(_is_fresh("snapshot_fetched_at", options), F.col("snapshot_state")),
            F.lit(absent),
        ),
    )
    located = named.join(states.drop("appid"), "market_name", "left").withColumn("snapshot_state", state)
    return located.select(*named.columns, "snapshot_state")


def _item_requests(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("wants_buy") | F.col("wants_sell"))


def stored_listings(located: DataFrame, listings: DataFrame) -> DataFrame:
    """Live stored listings of each request's item."""
    wanted = _item_requests(located).where(F.col("snapshot_state") == "ready")
    return (
        lookups.live(listings)
        .join(wanted.select("request_id", *lookups.ITEM_KEY), list(lookups.ITEM_KEY))
        .select("request_id", "id", "steamid", "updated_at")
    )


def _snapshot_rows(located: DataFrame, snapshots: DataFrame, part: str, intent: str) -> DataFrame:
    wanted = located.where(F.col(f"wants_{part}") & (F.col("snapshot_state") == "ready"))
    listed = snapshots.where(
        F.col("pos").isNotNull() & (F.col("appid") == APPID) & (F.lower("listing.intent") == intent)
    ).select("market_name", F.struct("page", "pos").alias("place"), "listing")
    return listed.join(
        wanted.select("request_id", "asked_at", "market_name", *lookups.ITEM_KEY, "max_inventory_size"), "market_name"
    ).select(
        "request_id",
        "asked_at",
        "place",
        "market_name",
        *lookups.ITEM_KEY,
        "max_inventory_size",
        F.col("listing.steamid").alias("steamid"),
        F.struct("listing.intent", "listing.steamid", "listing.item.defindex", "listing.item.quality").alias("listed"),
    )


def buy_rows(located: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Buy listings of the snapshot; their identifier follows from seller and name."""
    return _snapshot_rows(located, snapshots, "buy", "buy").withColumn(
        "listing_id", buy_id(F.lit(APPID), F.col("steamid"), F.col("market_name"))
    )


def sell_rows(located: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Sell listings of the snapshot; their identifier needs the seller's inventory."""
    return _snapshot_rows(located, snapshots, "sell", "sell")


def scan_inventories(rows: DataFrame, inventories: DataFrame, options: Options) -> DataFrame:
    """Matching items per (request, seller), and whether the seller is skipped.

    A seller with more matches than the request allows is skipped; so is one
    whose inventory cannot be read.  Listings of skipped sellers are neither
    updated nor deleted.
    """
    sellers = rows.groupBy("request_id", "steamid").agg(
        *[F.first(c).alias(c) for c in (*lookups.ITEM_KEY, "max_inventory_size", "asked_at")]
    )
    assume_complete = options.assume_complete
    scanned = sellers.join(inventories.select("steamid", "fetched_at", "state", "items"), "steamid", "left")
    scanned = scanned.withColumn("state", F.when(_is_fresh("fetched_at", options), F.col("state")))
    matches = F.expr(
        "filter(items, i -> coalesce(i.defindex, 0) = item_defindex and coalesce(i.quality, 0) = item_quality_id)"
    )
    waiting = F.coalesce(F.col("state").isin("retry", "denied", "failed"), F.lit(True))
    scanned = scanned.select(
        "request_id",
        "asked_at",
        "steamid",
        "max_inventory_size",
        F.when(~waiting, F.col("state")).otherwise("unreadable" if assume_complete else "pending").alias("inventory_state"),
        F.coalesce(matches, F.filter("items", lambda i: F.lit(False))).alias("matches"),
    )
    n = F.coalesce(F.size("matches"), F.lit(0))
    reason = F.when(~F.col("inventory_state").isin("ok", "pending"), "unreadable_inventory").when(
        n > F.col("max_inventory_size"), "inventory_size"
    )
    return scanned.select(
        "request_id", "asked_at", "steamid", "inventory_state", n.alias("n_matches"), reason.alias("skip_reason"), "matches"
    )


def candidates(located: DataFrame, buys: DataFrame, scans: DataFrame) -> DataFrame:
    """Every listing whose detail some request needs, from all parts."""
    none = F.lit(None)
    place_type, item_type = buys.schema["place"].dataType, scans.schema["matches"].dataType.elementType
    buy = buys.select(
        "request_id", "asked_at", F.lit("buy").alias("part"), "steamid", "listing_id", "place", "listed",
        none.cast("int").alias("item_pos"), none.cast(item_type).alias("item"),
    )
    open_scans = scans.where(F.col("skip_reason").isNull())
    sell = open_scans.select(
        "request_id", "asked_at", F.lit("sell").alias("part"), "steamid", F.posexplode("matches").alias("item_pos", "item")
    ).select(
        "request_id", "asked_at", "part", "steamid", sell_id(F.lit(APPID), F.coalesce("item.id", F.lit(0))).alias("listing_id"),
        none.cast(place_type).alias("place"), none.cast(buys.schema["listed"].dataType).alias("listed"),
        "item_pos", "item",
    )
    single = located.where("wants_single").select(
        "request_id", "asked_at", F.lit("single").alias("part"), none.cast("string").alias("steamid"), "listing_id",
        none.cast(place_type).alias("place"), none.cast(buys.schema["listed"].dataType).alias("listed"),
        none.cast("int").alias("item_pos"), none.cast(item_type).alias("item"),
    )
    return buy.unionByName(sell).unionByName(single)


def answer(wanted: DataFrame, details: DataFrame, options: Options) -> DataFrame:
    """Candidates with their detail; ``landed`` is false while it is awaited."""
    found = details.select("listing_id", "fetched_at", F.col("state").alias("detail_state"), "payload")
    met = wanted.join(found, "listing_id", "left")
    fresh = _is_fresh("fetched_at", options)
    landed = (fresh & F.coalesce(F.col("detail_state").isin("ok", "missing"), F.lit(False))) | F.lit(options.assume_complete)
    return met.select(
        *wanted.columns,
        F.when(fresh, F.col("detail_state")).alias("detail_state"),
        F.when(fresh, F.col("payload")).alias("payload"),
        landed.alias("landed"),
    )


def settle_sellers(scans: DataFrame, answered: DataFrame) -> DataFrame:
    """Per (request, seller) the first matching item, in inventory order, that has a detail."""
    tries = answered.where(F.col("part") == "sell")
    has_detail = F.col("payload").isNotNull()
    hits = tries.groupBy("request_id", "steamid").agg(
        F.min_by(F.struct("item", "listing_id", "payload"), F.when(has_detail, F.col("item_pos"))).alias("hit"),
        F.min(F.when(has_detail, F.col("item_pos"))).alias("hit_pos"),
        F.min(F.when(~F.col("landed"), F.col("item_pos"))).alias("awaited_pos"),
    )
    awaited = F.coalesce(F.col("awaited_pos") < F.coalesce("hit_pos", F.lit(2**31 - 1)), F.lit(False))
    return scans.drop("matches", "asked_at").join(hits, ["request_id", "steamid"], "left").select(
        "request_id",
        "steamid",
        "inventory_state",
        "n_matches",
        "skip_reason",
        F.when(F.col("hit_pos").isNotNull(), F.col("hit")).alias("hit"),
        ((F.col("inventory_state") == "pending") | awaited).alias("awaited"),
    )


def _usable(payload: Column) -> Column:
    return nonblank(payload["id"])


def judge(located: DataFrame, answered: DataFrame, sells: DataFrame, sellers: DataFrame, options: Options) -> DataFrame:
    """One row per request: ``status``, ``reason`` and what it may emit.

    ``buy_until`` and ``sell_until`` are the places of the first failing row:
    updates before it are emitted, later ones and all deletes are not.
    """
    stop = options.missing_buy_detail == FAIL
    buy = (
        answered.where(F.col("part") == "buy")
        .groupBy("request_id")
        .agg(
            F.max(F.col("listing_id").isNull()).alias("buy_no_id"),
            F.max(~F.col("landed")).alias("buy_awaited"),
            F.min(F.when(F.lit(stop) & ~_usable(F.col("payload")), F.col("place"))).alias("buy_until"),
        )
    )
    blank_seller = sells.where(F.col("steamid").isNull()).groupBy("request_id").agg(F.lit(True).alias("sell_no_id"))
    # Only a seller whose detail lacks an id stops a request; find its first row.
    broken = sellers.where(F.col("hit").isNotNull() & ~_usable(F.col("hit.payload"))).select("request_id", "steamid")
    sell_stop = (
        sells.join(broken, ["request_id", "steamid"], "left_semi").groupBy("request_id").agg(F.min("place").alias("sell_until"))
    )
    sell_wait = sellers.groupBy("request_id").agg(F.max("awaited").alias("sell_awaited"))
    single = answered.where(F.col("part") == "single").select(
        "request_id",
        (~F.col("landed")).alias("single_awaited"),
        (F.col("payload.id").isNotNull() & ~_usable(F.col("payload"))).alias("single_no_id"),
    )
    facts = reduce(
        lambda df, other: df.join(other, "request_id", "left"), [buy, blank_seller, sell_stop, sell_wait, single], located
    )

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    buy_fails = flag("buy_no_id") | F.col("buy_until").isNotNull()
    sell_runs = F.col("wants_sell") & (F.col("snapshot_state") == "ready") & ~(F.col("wants_buy") & buy_fails)
    for_item = F.col("wants_buy") | F.col("wants_sell")
    # Without its sell part, a request for both sides still fails like one.
    strict = F.col("effective_type") == "FULL"
    ready = F.col("snapshot_state") == "ready"
    pending = (
        (for_item & F.coalesce(F.col("snapshot_state") == "pending", F.lit(False)))
        | (F.col("wants_buy") & flag("buy_awaited") & ~flag("buy_no_id"))
        | (sell_runs & flag("sell_awaited"))
        | (F.col("wants_single") & flag("single_awaited"))
    )
    failure = (
        F.when(F.col("refusal").isNotNull(), F.concat(F.lit("refused: "), "refusal"))
        .when(F.col("wants_single") & flag("single_no_id"), "detail_without_id")
        .when(for_item & F.col("market_name").isNull() & strict, "no_market_name")
        .when(for_item & (F.col("snapshot_state") == "null") & strict, "null_snapshot")
        .when(for_item & (F.col("snapshot_state") == "no_listings"), "snapshot_without_listings")
        .when(F.col("wants_buy") & flag("buy_no_id"), "buy_without_seller")
        .when(F.col("wants_buy") & F.col("buy_until").isNotNull(), "buy_without_detail")
        .when(sell_runs & flag("sell_no_id"), "sell_without_seller")
        .when(sell_runs & F.col("sell_until").isNotNull(), "detail_without_id")
    )
    nothing_to_do = (
        F.when(for_item & F.col("market_name").isNull(), "no_market_name")
        .when(for_item & (F.col("snapshot_state") == "null"), "null_snapshot")
    )
    judged = facts.withColumn("pending", F.col("refusal").isNull() & pending).withColumn("failure", failure)
    go = ~F.col("pending") & ready
    emit_buy = go & F.col("wants_buy") & ~flag("buy_no_id")
    emit_sell = go & sell_runs & ~flag("sell_no_id")
    return judged.select(
        "request_id",
        "effective_type",
        "item_defindex",
        "item_quality_id",
        "listing_id",
        "generation_timestamp",
        F.when(F.col("pending"), "pending").when(F.col("failure").isNotNull(), "failed").otherwise("processed").alias("status"),
        F.when(~F.col("pending"), F.coalesce("failure", nothing_to_do)).alias("reason"),
        F.coalesce(emit_buy, F.lit(False)).alias("emit_buy"),
        "buy_until",
        F.coalesce(emit_sell, F.lit(False)).alias("emit_sell"),
        "sell_until",
        (F.col("wants_single") & ~F.col("pending") & ~flag("single_no_id")).alias("emit_single"),
    )


def prepare(
    requests: DataFrame,
    market: Market,
    options: Options = Options(),
    parts_by_type=PARTS_BY_TYPE,
    cut: Cut = no_cut,
) -> Steps:
    """The steps up to the verdicts; :func:`events` and :func:`outcomes` read them."""
    named = cut(named_requests(requests, market, parts_by_type), "named")
    snapshots = cut(wanted_only(market.snapshots, named, "market_name", snapshot_entries), "snapshots")
    located = cut(locate(named, snapshots, options), "located")
    buys, sells = buy_rows(located, snapshots), sell_rows(located, snapshots)
    scanned = wanted_only(market.inventories, sells, "steamid", inventories)
    scans = cut(scan_inventories(sells, scanned, options), "scans")
    wanted = cut(candidates(located, buys, scans), "candidates")
    answered = cut(answer(wanted, wanted_only(market.details, wanted, "listing_id", details), options), "answered")
    sellers = cut(settle_sellers(scans, answered), "sellers")
    verdicts = cut(judge(located, answered, sells, sellers, options), "verdicts")
    return Steps(
        located=located,
        stored=stored_listings(located, market.listings),
        buy_rows=buys,
        sell_rows=sells,
        scans=scans,
        answered=answered,
        sellers=sellers,
        verdicts=verdicts,
    )


def shared_work(requests: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """Requests that ask for the same are one: those to reconcile, and (request_id, of, stamp) for all.

    ``of`` is the request that is reconciled for them, the one with the smallest id.  With a limit on
    the age of responses, requests made at different times are not the same.
    """
    asked = ["request_type", *lookups.ITEM_KEY, "listing_id", "max_inventory_size"]
    if options.max_age_ms is not None:
        asked.append("generation_timestamp")
    # Absent fields are left out of the text, and names are in it, so equal texts ask for the same.
    keyed = requests.withColumn("asked", F.to_json(F.struct(*asked)))
    first = keyed.groupBy("asked").agg(F.min("request_id").alias("of"))
    members = keyed.select("request_id", "asked", F.col("generation_timestamp").alias("stamp")).join(first, "asked")
    representatives = requests.join(first.select(F.col("of").alias("request_id")), "request_id", "left_semi")
    return representatives.select(*requests.columns), members.select("request_id", "of", "stamp")


def for_every_request(df: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of reconciled requests (events, outcomes or verdicts), for each request that they stand for."""
    columns = {c: F.col(c) for c in df.columns}
    rows = df.withColumnRenamed("request_id", "of").join(members, "of")
    if "generation_timestamp" in columns:
        columns["generation_timestamp"] = F.col("stamp").cast("bigint").alias("generation_timestamp")
    return rows.select(*columns.values())


def newest_of(members: DataFrame) -> DataFrame:
    """Of the requests that ask for the same, the last: its events leave the table as those of all would."""
    return members.groupBy("of").agg(F.max_by("request_id", F.struct("stamp", "request_id")).alias("request_id"), F.max("stamp").alias("stamp"))


def buy_truth(steps: Steps) -> DataFrame:
    """Confirmed buy listings of requests that emit buy events."""
    verdicts = steps.verdicts.where("emit_buy").select("request_id", "generation_timestamp", "buy_until")
    rows = steps.answered.where(F.col("part") == "buy").join(verdicts, "request_id")
    in_time = F.col("buy_until").isNull() | (F.col("place") < F.col("buy_until"))
    return rows.where(in_time & _usable(F.col("payload")))


def sell_truth(steps: Steps) -> DataFrame:
    """Confirmed sell listings: each snapshot row with its seller's first hit."""
    verdicts = steps.verdicts.where("emit_sell").select("request_id", "generation_timestamp", "sell_until")
    hits = steps.sellers.where(F.col("hit").isNotNull()).select("request_id", "steamid", "hit")
    rows = steps.sell_rows.select("request_id", "steamid", "place", "listed").join(verdicts, "request_id")
    in_time = F.col("sell_until").isNull() | (F.col("place") < F.col("sell_until"))
    return rows.where(in_time).join(hits, ["request_id", "steamid"]).select(
        "request_id", "generation_timestamp", "place", "steamid", "listed", "hit.item", "hit.listing_id", "hit.payload"
    )


def stale_buys(steps: Steps) -> DataFrame:
    """Stored buy listings the market no longer confirms."""
    verdicts = steps.verdicts.where("emit_buy and buy_until is null").select("request_id", "generation_timestamp")
    kept = _truth_ids(steps.answered.where(F.col("part") == "buy"), F.col("payload"))
    stored = steps.stored.where(is_buy_id(F.col("id"))).join(verdicts, "request_id")
    return stored.join(kept, ["request_id", "id"], "left_anti")


def stale_sells(steps: Steps) -> DataFrame:
    """Stored sell listings not confirmed, except those of skipped sellers."""
    verdicts = steps.verdicts.where("emit_sell and sell_until is null").select("request_id", "generation_timestamp")
    kept = _truth_ids(steps.sellers.where(F.col("hit").isNotNull()), F.col("hit.payload"))
    skipped = steps.sellers.where(F.col("skip_reason").isNotNull()).select("request_id", "steamid")
    stored = steps.stored.where(is_sell_id(F.col("id"))).join(verdicts, "request_id")
    return stored.join(kept, ["request_id", "id"], "left_anti").join(skipped, ["request_id", "steamid"], "left_anti")


def _truth_ids(rows: DataFrame, payload: Column) -> DataFrame:
    return rows.where(payload["id"].isNotNull()).select("request_id", payload["id"].alias("id")).distinct()


def update_event(payload: Column, generation_timestamp: Column) -> list[Column]:
    """Event columns that replay a detail; the detail's own id counts."""
    return [
        payload["id"].alias("id"),
        F.lit(UPDATE_EVENT).alias("event"),
        payload.alias("payload"),
        generation_timestamp.cast("bigint").alias("generation_timestamp"),
    ]


def delete_event(listing_id: Column, steamid: Column, generation_timestamp: Column) -> list[Column]:
    """Event columns that delete a listing; the payload holds its keys only."""
    given = {"id": listing_id, "steamid": steamid}
    fields = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in PAYLOAD.fields]
    return [
        listing_id.alias("id"),
        F.lit(DELETE_EVENT).alias("event"),
        F.struct(*fields).alias("payload"),
        generation_timestamp.cast("bigint").alias("generation_timestamp"),
    ]


def single_events(steps: Steps, listings: DataFrame) -> DataFrame:
    """One event per single-listing request: update, delete or none."""
    verdicts = steps.verdicts.where("emit_single").select("request_id", "generation_timestamp")
    rows = steps.answered.where(F.col("part") == "single").join(verdicts, "request_id")
    found = rows.where(_usable(F.col("payload"))).select(
        "request_id", *_stage(BUY_UPDATE), *update_event(F.col("payload"), F.col("generation_timestamp"))
    )
    stored = lookups.live(listings).select(F.col("id").alias("listing_id"), F.col("steamid").alias("stored_steamid"))
    gone = rows.where(F.col("payload.id").isNull()).join(stored, "listing_id").select(
        "request_id",
        *_stage(BUY_DELETE),
        *delete_event(F.col("listing_id"), F.col("stored_steamid"), F.col("generation_timestamp")),
    )
    return found.unionByName(gone)


def _stage(stage: int, place: Column | None = None) -> list[Column]:
    zero = F.lit(0)
    return [
        F.lit(stage).alias("stage"),
        (zero if place is None else place["page"]).cast("bigint").alias("page"),
        (zero if place is None else place["pos"]).cast("int").alias("pos"),
    ]


def events(steps: Steps, listings: DataFrame) -> DataFrame:
    """Events of all requests: ``request_id, stage, page, pos`` and the event itself."""
    stamp, payload = F.col("generation_timestamp"), F.col("payload")

    def updates(truth: DataFrame, stage: int) -> DataFrame:
        return truth.select("request_id", *_stage(stage, F.col("place")), *update_event(payload, stamp))

    def deletes(stale: DataFrame, stage: int) -> DataFrame:
        return stale.select("request_id", *_stage(stage), *delete_event(F.col("id"), F.col("steamid"), stamp))

    parts = [
        updates(buy_truth(steps), BUY_UPDATE),
        deletes(stale_buys(steps), BUY_DELETE),
        updates(sell_truth(steps), SELL_UPDATE),
        deletes(stale_sells(steps), SELL_DELETE),
        single_events(steps, listings),
    ]
    return reduce(DataFrame.unionByName, parts)


def ordered_events(reconciled: DataFrame) -> DataFrame:
    """Same columns and order terms as feed events: placed at their generation time."""
    # Stages follow one another as offsets of their request; a page holds fewer than 2^31 listings.
    offset = F.shiftleft(F.shiftright(F.xxhash64("request_id"), 2), 2) + F.col("stage")
    place = F.col("page") * F.lit(2**31).cast("bigint") + F.col("pos")
    return reconciled.select(
        F.col("generation_timestamp").alias("ord_time"),
        F.lit(-1).alias("ord_partition"),
        offset.alias("ord_offset"),
        place.alias("ord_pos"),
        "id",
        "event",
        "payload",
        "generation_timestamp",
    )


def outcomes(
    steps: Steps, reconciled: DataFrame, finished_at: Column | None = None, members: DataFrame | None = None
) -> DataFrame:
    """One row per request: status, reason, how many events it led to, and given an end the milliseconds it took.

    ``members``: of :func:`shared_work`, for a row per request that asked for the same.
    """
    took = []
    if finished_at is not None:
        took = [finished_at.cast("bigint").alias("finished_at"), (finished_at - F.col("generation_timestamp")).cast("bigint").alias("took_ms")]
    counts = reconciled.groupBy("request_id").agg(
        F.count_if(F.col("event") == UPDATE_EVENT).alias("updates"),
        F.count_if(F.col("event") == DELETE_EVENT).alias("deletes"),
    )
    judged = steps.verdicts.join(counts, "request_id", "left")
    if members is not None:
        judged = for_every_request(judged, members)
    return judged.select(
        "request_id",
        "effective_type",
        "status",
        "reason",
        F.coalesce("updates", F.lit(0)).cast("bigint").alias("updates"),
        F.coalesce("deletes", F.lit(0)).cast("bigint").alias("deletes"),
        *took,
    )


def failed_outcomes(requests: DataFrame, reason: Column) -> DataFrame:
    """Outcomes of requests whose reconciliation did not come to an end."""
    return _outcomes_without_events(requests, "failed", F.concat(F.lit("error: "), reason))


def pending_outcomes(requests: DataFrame, reason: str) -> DataFrame:
    """Outcomes of requests that are tried again; ``reason`` is a column, null where there was no error."""
    return _outcomes_without_events(requests, "pending", F.concat(F.lit("retry after error: "), F.col(reason)))


def _outcomes_without_events(requests: DataFrame, status: str, reason: Column) -> DataFrame:
    return requests.select(
        "request_id",
        F.col("request_type").alias("effective_type"),
        F.lit(status).alias("status"),
        reason.alias("reason"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("updates", "deletes")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("finished_at", "took_ms")],
    )


def truth_profile(truth: DataFrame) -> DataFrame:
    """What is known of a confirmed listing, preferring the nearer source.

    Seller and intent come from the snapshot, then the detail; item numbers from
    the inventory, then the snapshot; the identifier only from the detail.
    """
    listed, item, detail = F.col("listed"), F.col("item"), F.col("payload")
    missing = F.concat_ws(
        ", ",
        F.when(listed.isNull(), "API listing"),
        F.when(item.isNull(), "Inventory item"),
        F.when(detail.isNull(), "Listing detail"),
    )
    has_item = item.isNotNull()

    def primitive(value: Column) -> Column:
        return F.coalesce(value, F.lit(0))

    return truth.select(
        "request_id",
        "place.page",
        "place.pos",
        F.coalesce(listed["intent"], detail["intent"]).alias("intent"),
        F.coalesce(listed["steamid"], detail["steamid"]).alias("steamid"),
        F.when(has_item, primitive(item["defindex"])).otherwise(listed["defindex"]).alias("defindex"),
        F.when(has_item, primitive(item["quality"])).otherwise(listed["quality"]).alias("quality"),
        F.when(has_item, primitive(item["id"])).alias("item_id"),
        detail["id"].alias("actual_id"),
        (listed.isNotNull() & item.isNotNull() & detail.isNotNull()).alias("is_complete"),
        detail["id"].isNotNull().alias("has_minimum"),
        F.when(missing == "", "Complete").otherwise(F.concat(F.lit("Missing: "), missing)).alias("missing"),
    )
