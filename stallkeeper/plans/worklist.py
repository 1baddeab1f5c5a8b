"""What still has to be fetched, each key once, spaced by the endpoint's pace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeeper.functions.text import url_encoded
from stallkeeper.plans.reconcile import Steps
from stallkeeper.session import Cut, no_cut
from stallkeeper.sources.landing import ANSWERED, answered, snapshot_states

# Seconds between two calls of an endpoint.
PACE_SECONDS = {"snapshot": 10, "inventory": 10, "detail": 1}

# Keys are numbered bucket by bucket; a bucket is one task's share.  Each hex
# digit of the hash makes sixteen times as many.
BUCKET_DIGITS = 3


def needs(steps: Steps) -> DataFrame:
    """(request, endpoint, key) of every response the requests may depend on."""
    return _needs(steps, steps.answered)


def _needs(steps: Steps, candidates: DataFrame) -> DataFrame:
    def need(df: DataFrame, endpoint: str, key: str) -> DataFrame:
        return df.where(F.col(key).isNotNull()).select(
            "request_id", F.lit(endpoint).alias("endpoint"), F.col(key).alias("key")
        )

    items = steps.located.where(F.col("wants_buy") | F.col("wants_sell"))
    parts = [
        need(items, "snapshot", "market_name"),
        need(steps.scans, "inventory", "steamid"),
        need(candidates, "detail", "listing_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def settled(snapshots: DataFrame, inventories: DataFrame, details: DataFrame) -> DataFrame:
    """(endpoint, key) of responses, as `sources.landing` reads them, that need no further call.

    Where responses keep landing, fold `landing.response_states` of the new ones instead and use
    `landing.answered`: no body is read again.
    """

    def keys(df: DataFrame, endpoint: str, key: str) -> DataFrame:
        good = F.col("state").isin(*ANSWERED[endpoint])
        return df.where(good).select(F.lit(endpoint).alias("endpoint"), F.col(key).alias("key"))

    # One row per snapshot; one page that is missing leaves the whole snapshot open.
    whole = snapshot_states(snapshots).where(F.col("snapshot_state") != "pending")
    parts = [
        whole.select(F.lit("snapshot").alias("endpoint"), F.col("market_name").alias("key")),
        keys(inventories, "inventory", "steamid"),
        keys(details, "detail", "listing_id"),
    ]
    return reduce(DataFrame.unionByName, parts)


def frontier(steps: Steps, states: DataFrame) -> DataFrame:
    """(request_id, endpoint, key) of the calls that can be made now and may be needed.

    ``states`` is a table of `landing.response_states`.  Snapshots, inventories and details of buy and
    single listings are all needed.  Of a seller's matching items only the first one without an answer
    is, and only while no item before it has a detail: the search stops at the first hit.  Answered calls
    drop out; repeat after the answers have landed, until nothing is left.
    """
    done = answered(states)
    known = states.where((F.col("endpoint") == "detail") & F.col("state").isin(*ANSWERED["detail"]))
    known = known.select(F.col("key").alias("listing_id"), (F.col("state") == "ok").alias("is_hit"))
    tries = steps.answered.where(F.col("part") == "sell").select("request_id", "steamid", "item_pos", "listing_id")
    tries = tries.join(known, "listing_id", "left")
    is_open = F.col("is_hit").isNull()
    searches = tries.groupBy("request_id", "steamid").agg(
        F.min(F.when(F.col("is_hit"), F.col("item_pos"))).alias("hit_pos"),
        F.min(F.when(is_open, F.col("item_pos"))).alias("open_pos"),
        F.min_by("listing_id", F.when(is_open, F.col("item_pos"))).alias("key"),
    )
    going = F.col("open_pos").isNotNull() & (F.col("hit_pos").isNull() | (F.col("open_pos") < F.col("hit_pos")))
    next_items = searches.where(going).select("request_id", F.lit("detail").alias("endpoint"), "key")
    others = _needs(steps, steps.answered.where(F.col("part") != "sell")).distinct()
    return others.join(done, ["endpoint", "key"], "left_anti").select("request_id", "endpoint", "key").unionByName(next_items).distinct()


def calls_to_hit(steps: Steps, states: DataFrame) -> DataFrame:
    """Calls per request and endpoint when the frontier is followed to its end; ``states`` knows every answer.

    Of a seller's matching items those up to the first with a detail are asked for, all if there is none.
    Compare :func:`budget`, which counts every item.
    """
    hits = states.where((F.col("endpoint") == "detail") & (F.col("state") == "ok")).select(
        F.col("key").alias("listing_id"), F.lit(True).alias("is_hit")
    )
    tries = steps.answered.where(F.col("part") == "sell").select("request_id", "steamid", "item_pos", "listing_id")
    tries = tries.join(hits, "listing_id", "left")
    first = tries.groupBy("request_id", "steamid").agg(F.min(F.when(F.col("is_hit"), F.col("item_pos"))).alias("hit_pos"))
    asked = tries.join(first, ["request_id", "steamid"]).where(F.col("hit_pos").isNull() | (F.col("item_pos") <= F.col("hit_pos")))
    sells = asked.select("request_id", F.lit("detail").alias("endpoint"), F.col("listing_id").alias("key"))
    return budget(_needs(steps, steps.answered.where(F.col("part") != "sell")).unionByName(sells))


def worklist(
    needed: DataFrame, landed: DataFrame | None = None, cut: Cut = no_cut, bucket_digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Open keys with a call slot per endpoint and its earliest start in seconds.

    Slots follow the order of the keys' hashes.  They are numbered within hash
    buckets, and shifted by the sizes of the buckets before; only the bucket
    sizes, a bounded number of rows, are ever ordered in one task.  The open
    keys are read twice; ``cut`` has them worked out once.
    """
    open_keys = needed.select("endpoint", "key").distinct()
    if landed is not None:
        open_keys = open_keys.join(landed, ["endpoint", "key"], "left_anti")
    open_keys = cut(open_keys, "open_keys")
    digest = F.md5(F.col("key").cast("binary"))
    hashed = open_keys.select(
        "endpoint", "key", digest.alias("digest"), F.substring(digest, 1, bucket_digits).alias("bucket")
    )
    before = Window.partitionBy("endpoint").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        hashed.groupBy("endpoint", "bucket")
        .count()
        .select("endpoint", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    )
    inside = Window.partitionBy("endpoint", "bucket").orderBy("digest", "key")
    numbered = hashed.withColumn("rank", F.row_number().over(inside)).join(shifts, ["endpoint", "bucket"])
    slot = F.col("shift") + F.col("rank") - 1
    return numbered.select(
        "endpoint",
        "key",
        url_encoded(F.col("key")).alias("encoded_key"),
        slot.cast("bigint").alias("slot"),
        (slot * _pace()).cast("bigint").alias("start_second"),
    )


def _pace() -> Column:
    return reduce(
        lambda rest, one: rest.when(F.col("endpoint") == one[0], one[1]), PACE_SECONDS.items(), F.when(F.lit(False), 0)
    )


def budget(needed: DataFrame) -> DataFrame:
    """Calls per request and endpoint, each key counted once."""
    once = needed.distinct()
    return once.groupBy("request_id", "endpoint").agg(F.count("*").alias("calls"))
