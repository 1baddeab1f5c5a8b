"""Landed responses of the market and inventory services, as DataFrames.

A fetcher outside Spark lands one row per response: its key, ``http_status`` and
``body``, and ``fetched_at`` (epoch milliseconds) when a key may be fetched
again: the newest response of a key then counts, and its age can be judged.
Without it a key must land once.  These functions read the bodies; filter the
landed rows by key first.  ``state`` says what a response means for the work that needs
it: ``ok``, ``missing`` (answered: no such thing), ``retry`` (not answered yet),
``denied``, ``failed`` or ``unreadable``.

:func:`response_states` keeps only that: a table of states, folded from new responses as they land, says
what is answered without a body being read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.functions import wire
from stallkeeper.functions.text import clean_json_body
from stallkeeper.functions.wire import Reader
from stallkeeper.schemas import APPID, INVENTORY, PAYLOAD, SNAPSHOT, record

_SNAPSHOT, _DETAIL, _INVENTORY = Reader(SNAPSHOT), Reader(PAYLOAD), Reader(INVENTORY)
_ITEMS = INVENTORY["result"].dataType["items"].dataType

SNAPSHOT_KEY = ("market_name", "appid")

# States that need no further call.  An inventory that could not be read is asked for again.
ANSWERED = {"snapshot": ("ok", "null", "no_listings"), "inventory": ("ok",), "detail": ("ok", "missing")}


def outcome(http_status: Column) -> Column:
    """Class of a response by its HTTP status; null status is a timeout."""
    return (
        F.when(http_status.isNull() | (http_status == 429) | (http_status >= 500), "retry")
        .when(http_status == 200, "ok")
        .when(http_status == 404, "missing")
        .when(http_status.isin(401, 403), "denied")
        .otherwise("failed")
    )


def latest(landed: DataFrame, *key: str) -> DataFrame:
    """Most recently fetched response per key, where keys are fetched repeatedly."""
    rest = [c for c in landed.columns if c not in key]
    newest = landed.groupBy(*key).agg(F.max_by(F.struct(*rest), "fetched_at").alias("r"))
    return newest.select(*key, "r.*")


def _newest(landed: DataFrame, *key: str) -> DataFrame:
    """One response per key; with a null ``fetched_at`` where landed rows have none."""
    if "fetched_at" in landed.columns:
        return latest(landed, *key)
    return landed.withColumn("fetched_at", F.lit(None).cast("bigint"))


def _document(landed: DataFrame, body: str, reader: Reader) -> DataFrame:
    """Adds ``document`` (typed) and ``state``."""
    read = reader.read(landed, body, "document")
    given, fit, variant = outcome(F.col("http_status")), F.col("document_fit"), F.col("document_variant")
    is_null = F.coalesce(F.is_variant_null(variant), F.lit(False))
    unreadable = (fit.isNull() & ~is_null) | (fit == wire.BAD)
    state = F.when(given != "ok", given).when(unreadable, "unreadable").otherwise("ok")
    # Through a generator on purpose: a filter on the state or the document stays above it.  Pushed into the
    # reader, it would have every step of the reading written out and worked out again.
    values = F.array(F.struct(F.col("document").alias("document"), state.alias("state")))
    return read.select(*landed.columns, F.inline_outer(values))


def snapshot_entries(landed: DataFrame, split_chars: int | None = None) -> DataFrame:
    """Snapshot pages to listings: one row per listing, in snapshot order.

    A page without listings keeps one row with a null ``pos``, so that the
    state of every page survives.  ``has_listings`` is false for a page whose
    list is absent; ``is_null`` marks a response that is JSON null.  With
    ``snapshot_at``, pages of a snapshot's older versions are left out.

    A page is one text in one task.  Where whole snapshots land as one, give
    ``split_chars``: longer pages are cut between their listings and dealt to all
    tasks before listings are read, see :func:`split_pages`.
    """
    pages = landed if "page" in landed.columns else landed.withColumn("page", F.lit(0).cast("bigint"))
    if "snapshot_at" in pages.columns:
        current = pages.groupBy(*SNAPSHOT_KEY).agg(F.max("snapshot_at").alias("snapshot_at"))
        pages = pages.join(current, [*SNAPSHOT_KEY, "snapshot_at"], "left_semi")
    pages = _newest(pages, *SNAPSHOT_KEY, "page")
    if split_chars is not None:
        pages = split_pages(pages, split_chars)
    read = _document(pages, "body", _SNAPSHOT)
    listings = F.when(F.col("state") == "ok", F.col("document.listings"))
    entries = read.select(
        *SNAPSHOT_KEY,
        "page",
        "fetched_at",
        "state",
        (F.col("state").eqNullSafe("ok") & F.col("document").isNull()).alias("is_null"),
        listings.isNotNull().alias("has_listings"),
        *([] if split_chars is None else ["first_pos"]),
        F.posexplode_outer(listings).alias("pos", "listing"),
    )
    if split_chars is None:
        return entries
    return entries.withColumn("pos", F.col("pos") + F.col("first_pos")).drop("first_pos")


def split_pages(pages: DataFrame, split_chars: int) -> DataFrame:
    """Pages with bodies longer than ``split_chars`` cut into several, and ``first_pos``, the place of a part's first listing.

    A long body is read once as it is, without a look at its listings; parts of about ``split_chars``
    are texts of their own, so the costly typed reading is spread.  The first part keeps the other
    fields of the body.  What has no list of listings stays whole.  A part that is unreadable leaves
    its snapshot open, as the whole page would.
    """
    long = F.col("http_status").eqNullSafe(200) & (F.coalesce(F.length("body"), F.lit(0)) > split_chars)
    short = pages.where(~long).withColumn("first_pos", F.lit(0))
    names = [c for c in pages.columns if c != "body"]
    read = pages.where(long).select(*names, "body", wire.parse(F.col("body")).alias("v"))
    items = F.try_variant_get("v", "$.listings", "array<variant>")
    rest = F.to_json(F.struct(*[F.try_variant_get("v", f"$.{f.name}", "variant").alias(f.name) for f in SNAPSHOT.fields if f.name != "listings"]))
    held = read.select(*names, "body", rest.alias("rest"), items.alias("items"))
    n = F.size("items")
    step = F.greatest(F.lit(1), F.floor(n * F.lit(split_chars) / F.length("body")).cast("int"))
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, step))
    cut = held.select(*names, "body", "rest", "items", step.alias("step"), F.explode_outer(starts).alias("start"))
    listings = F.to_json(F.slice("items", F.col("start") + 1, F.col("step")))
    head = F.when((F.col("start") == 0) & (F.col("rest") != "{}"), F.expr("concat(left(rest, length(rest) - 1), ',')")).otherwise("{")
    text = F.when(F.col("start").isNull(), F.col("body")).otherwise(F.concat(head, F.lit('"listings":'), listings, F.lit("}")))
    parts = cut.select(*names, text.alias("body"), F.coalesce("start", F.lit(0)).alias("first_pos"))
    dealt = parts.repartition(*SNAPSHOT_KEY, "page", "first_pos")
    return short.unionByName(dealt.select(*short.columns))


def snapshot_states(entries: DataFrame) -> DataFrame:
    """One row per snapshot: ``ready``, ``null``, ``no_listings`` or ``pending``, and its oldest page's age."""
    worst = F.max(
        F.when(F.col("state") != "ok", 3).when(F.col("is_null"), 2).when(~F.col("has_listings"), 1).otherwise(0)
    )
    names = F.array(*[F.lit(s) for s in ("ready", "no_listings", "null", "pending")])
    return entries.groupBy(*SNAPSHOT_KEY).agg(
        F.element_at(names, worst + 1).alias("snapshot_state"), F.min("fetched_at").alias("snapshot_fetched_at")
    )


def details(landed: DataFrame) -> DataFrame:
    """Listing details: ``listing_id, fetched_at, state, payload``; payload is null unless ``ok``."""
    read = _document(_newest(landed, "listing_id"), "body", _DETAIL)
    ok = F.col("state") == "ok"
    return read.select(
        "listing_id",
        "fetched_at",
        F.when(ok & F.col("document").isNull(), "missing").otherwise(F.col("state")).alias("state"),
        F.when(ok, F.col("document")).alias("payload"),
    )


STATE_KEY = ("endpoint", "key", "page")
STATES = record("endpoint string, key string, page bigint, version bigint, fetched_at bigint, state string")


def response_states(
    snapshots: DataFrame | None = None, inventory: DataFrame | None = None, detail: DataFrame | None = None
) -> DataFrame:
    """What each landed response says, one row per (endpoint, key, page) without its content.

    A snapshot's page is ``ok``, ``null`` or ``no_listings`` when it could be read; ``version`` is its
    ``snapshot_at``, where pages have one.  Inventories and details have page 0.  Every landed row that
    is passed has its body read once; pass new responses only, and :func:`fold_states` to what is known.
    """
    parts = []
    if snapshots is not None:
        versioned = snapshots if "snapshot_at" in snapshots.columns else snapshots.withColumn("snapshot_at", F.lit(None).cast("bigint"))
        pages = versioned if "page" in versioned.columns else versioned.withColumn("page", F.lit(0).cast("bigint"))
        pages = pages.where(F.col("appid") == APPID)
        read = _document(_newest(pages, *SNAPSHOT_KEY, "page", "snapshot_at"), "body", _SNAPSHOT)
        listed = F.when(F.col("document").isNull(), "null").when(F.col("document.listings").isNull(), "no_listings").otherwise("ok")
        state = F.when(F.col("state") == "ok", listed).otherwise(F.col("state"))
        parts.append(_state_rows(read, "snapshot", F.col("market_name"), state, F.col("page"), F.col("snapshot_at")))
    if inventory is not None:
        parts.append(_state_rows(inventories(inventory), "inventory", F.col("steamid"), F.col("state")))
    if detail is not None:
        parts.append(_state_rows(details(detail), "detail", F.col("listing_id"), F.col("state")))
    return reduce(DataFrame.unionByName, parts)


def _state_rows(read: DataFrame, endpoint: str, key: Column, state: Column, page: Column | None = None, version: Column | None = None) -> DataFrame:
    return read.where(key.isNotNull()).select(
        F.lit(endpoint).alias("endpoint"),
        key.alias("key"),
        F.coalesce(F.lit(0) if page is None else page, F.lit(0)).cast("bigint").alias("page"),
        (F.lit(None) if version is None else version).cast("bigint").alias("version"),
        F.col("fetched_at").cast("bigint").alias("fetched_at"),
        state.alias("state"),
    )


def answered(states: DataFrame) -> DataFrame:
    """(endpoint, key) of responses that need no further call; one open page leaves a whole snapshot open."""
    of_endpoint = [
        (F.col("endpoint") == endpoint) & F.col("state").isin(*good) for endpoint, good in ANSWERED.items()
    ]
    is_answered = F.coalesce(reduce(Column.__or__, of_endpoint), F.lit(False))
    whole = states.groupBy("endpoint", "key").agg(F.bool_and(is_answered).alias("is_answered"))
    return whole.where("is_answered").select("endpoint", "key")


def fold_states(states: DataFrame) -> DataFrame:
    """The newest state per (endpoint, key, page): of the last version, then the last fetched.

    Rows without a time are older than all with one; of equal ones an answer counts before a failure.
    Pages of a snapshot's older versions go, as a shorter version has fewer pages.
    """
    answered = F.col("state").isin(*{state for states in ANSWERED.values() for state in states})
    age = F.struct(F.col("version"), F.col("fetched_at"), answered, F.col("state"))
    newest = states.groupBy(*STATE_KEY).agg(F.max_by(F.struct("version", "fetched_at", "state"), age).alias("r"))
    newest = newest.select(*STATE_KEY, "r.*")
    last = newest.where(F.col("version").isNotNull()).groupBy("endpoint", "key").agg(F.max("version").alias("last_version"))
    current = newest.join(last, ["endpoint", "key"], "left")
    return current.where(F.col("last_version").isNull() | F.col("version").eqNullSafe(F.col("last_version"))).select(*STATES.names)


def inventories(landed: DataFrame) -> DataFrame:
    """Seller inventories: ``steamid, fetched_at, state, items, n_items``.

    Bodies are cleaned first.  A body without JSON and a result whose status is
    not 1 are both ``unreadable``.
    """
    cleaned = _newest(landed, "steamid").withColumn("cleaned", clean_json_body(F.col("body")))
    read = _document(cleaned, "cleaned", _INVENTORY)
    good = F.coalesce(F.col("document.result.status") == 1, F.lit(False))
    state = F.when((F.col("state") == "ok") & ~good, "unreadable").otherwise(F.col("state"))
    return read.select(
        "steamid",
        "fetched_at",
        state.alias("state"),
        F.when(state == "ok", F.coalesce("document.result.items", F.array().cast(_ITEMS))).alias("items"),
    ).withColumn("n_items", F.size("items"))
