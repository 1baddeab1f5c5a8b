"""Queries over the bound tables, one per capability of the library."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import binding
from catalogue.binding import DAILY, GENERATION_TS, c, tables
from stallkeeper import session
from stallkeeper.functions import ids, times, wire
from stallkeeper.functions.text import clean_json_body, url_encoded
from stallkeeper.operators import fold, lookups, merge, parse, requests, route
from stallkeeper.plans import counters, reconcile, reports, worklist
from stallkeeper.schemas import LISTING_UPDATE, LISTINGS
from stallkeeper.sources import feeds, landing
from stallkeeper.streaming.job import Job
from stallkeeper.streaming.requests import RequestJob
from stallkeeper.streaming.table import ListingTable

Query = Callable[[SparkSession, str], DataFrame]
COMPLETE = reconcile.Options(assume_complete=True)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.listing_events(parse.parse_listing_messages(tables(spark, sf_dir).messages))


def _changes(events: DataFrame) -> DataFrame:
    return fold.fold(fold.table_events(events, c(DAILY)))


def market(spark: SparkSession, sf_dir: str) -> reconcile.Market:
    t = tables(spark, sf_dir)
    return reconcile.Market(listings=t.listings, snapshots=t.snapshots, details=t.details, inventories=t.inventories)


def run_reconciliation(spark: SparkSession, sf_dir: str) -> tuple[reconcile.Steps, DataFrame]:
    """All requests, from the landed bodies to the events."""
    cut = session.table_cut(spark)
    m = market(spark, sf_dir)
    steps = reconcile.prepare(tables(spark, sf_dir).requests, m, COMPLETE, cut=cut)
    return steps, cut(reconcile.events(steps, m.listings), "events")


@lru_cache(maxsize=8)
def _reconciled(spark: SparkSession, application: str, sf_dir: str) -> tuple[reconcile.Steps, DataFrame]:
    return run_reconciliation(spark, sf_dir)


def reconciled(spark: SparkSession, sf_dir: str) -> tuple[reconcile.Steps, DataFrame]:
    """The reconciliation's steps; run once per session, then read as stored tables."""
    return _reconciled(spark, spark.sparkContext.applicationId, sf_dir)


# Parsing


def parse_fanout(spark, sf_dir):
    p = "payload"
    return _events(spark, sf_dir).select(
        "ord_time", "ord_partition", "ord_offset", "ord_pos", F.col("id").alias("event_key"), "event",
        F.col(f"{p}.id").alias("listing_id"), F.col(f"{p}.appid").alias("appid"),
        F.col(f"{p}.currencies.metal").alias("metal"), F.col(f"{p}.currencies.keys").alias("keys"),
        F.col(f"{p}.listedAt").alias("listed_at"), F.size(f"{p}.item.spells").alias("spells"),
        F.col(f"{p}.item.tradable").alias("tradable"),
    )


def broken_messages(spark, sf_dir):
    """The whole feed, most of its messages damaged in one of twelve ways."""
    damaged = c(
        """
        case (offset * 4 + partition) % 13
          when 1 then left(value, length(value) div 2)
          when 2 then replace(value, '"tradable":', '"level":"x","tradable":')
          when 3 then replace(value, '{"data":[', '{"data":null,"rest":[')
          when 4 then concat('[', value, ']')
          when 5 then ' '
          when 6 then 'null'
          when 7 then replace(value, '{"data":[', '{"data":[null,')
          when 8 then replace(value, '"details":"trade', '"details":{"a":1},"x":"trade')
          when 9 then replace(value, '"source":"feed"', '"source":[1]')
          when 10 then null
          when 11 then replace(value, '"', '\\'')
          when 12 then replace(value, '"metal":', '"metal":NaN,"rest":')
          else value end
        """
    )
    return tables(spark, sf_dir).messages.withColumn("value", damaged)


def parse_rejects(spark, sf_dir):
    parsed = parse.parse_listing_messages(broken_messages(spark, sf_dir))
    return parsed.groupBy("partition", "offset").agg(
        F.max("reject_reason").alias("reject_reason"), F.count("update").alias("events")
    )


def reject_previews(spark, sf_dir):
    def raw(table, key, text):
        return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(
            F.col(text).alias("value"), F.lit(table).alias("topic"), F.lit(0).alias("partition"), F.col(key).alias("offset"),
            F.timestamp_millis(F.lit(GENERATION_TS)).alias("timestamp"),
        )

    texts = raw("documents", "doc_id", "text").unionByName(raw("pages", "page_id", "html"))
    return parse.rejects(parse.parse_listing_messages(texts)).select("topic", "offset", "reject_preview", "reject_value")


def unwritable_changes(spark, sf_dir):
    """Updates and deletes that cannot change the table, in a feed where parts of some are missing."""
    damaged = c(
        """
        case (offset * 4 + partition) % 5
          when 1 then replace(value, '"intent":"buy",', '')
          when 2 then replace(value, '"steamid":', '"seller":')
          when 3 then replace(value, '"payload":{"id":', '"payload":{"key":')
          else value end
        """
    )
    raw = tables(spark, sf_dir).messages.withColumn("value", damaged)
    events = parse.listing_events(parse.parse_listing_messages(raw))
    return fold.unwritable(events).select(F.col("id").alias("event_key"), "event", "defect")


def json_round_trip(spark, sf_dir):
    written = _events(spark, sf_dir).select(parse.to_json(F.struct("id", "event", "payload", "generation_timestamp")).alias("j"))
    again = wire.Reader(LISTING_UPDATE).read(written, "j", "u").select("u.*")
    return again.select(
        F.col("id").alias("event_key"), "event", F.col("payload.id").alias("listing_id"), "payload.steamid",
        "payload.currencies.metal", "payload.value.raw", F.col("payload.listedAt").alias("listed_at"),
        F.col("payload.item.marketName").alias("market_name"),
    )


def _price_documents(spark, sf_dir, one):
    """A price in four shapes: object, array, number, absent."""
    text = c(
        f"""
        case event_id % 4
          when 0 then concat('{{"price":', {one}, '}}')
          when 1 then concat('{{"price":[{{"raw":', value, '}},{{"raw":', value * 2, '}}]}}')
          when 2 then '{{"price":5}}' else '{{}}' end
        """
    )
    return binding.trades(spark, sf_dir).select("event_id", wire.parse(text).alias("d"))


def price_polymorphism(spark, sf_dir):
    docs = _price_documents(spark, sf_dir, """'{"steam":{"raw":', value, ',"currency":"usd"}}'""")
    price = docs.select("event_id", parse.item_price(F.col("d"), "$.price").alias("p"))
    return price.select(
        "event_id", F.col("p.steam.raw").alias("steam_raw"), F.col("p.steam.currency").alias("currency"),
        F.col("p").isNotNull().alias("has_price"),
    )


def price_list(spark, sf_dir):
    docs = _price_documents(spark, sf_dir, """'{"raw":', value, '}'""")
    prices = docs.select("event_id", parse.price_list(F.col("d"), "$.price").alias("p"))
    total = F.when(
        F.size("p") > 0, F.aggregate("p", F.lit(0.0), lambda acc, x: acc + F.coalesce(x["raw"], F.lit(0.0)))
    )
    return prices.select("event_id", F.size("p").alias("prices"), total.alias("total_raw"))


# Routing and counting


def _keys(events):
    return events.select(F.col("id").alias("event_key"), F.col("payload.id").alias("listing_id"))


def route_updates(spark, sf_dir):
    return _keys(route.updates(_events(spark, sf_dir)))


def route_deletes(spark, sf_dir):
    return _keys(route.deletes(_events(spark, sf_dir)))


def event_counts(spark, sf_dir):
    raw = tables(spark, sf_dir).messages
    return counters.feed_counters(raw, parse.parse_listing_messages(raw))


def _all_events(spark, sf_dir):
    _, events = reconciled(spark, sf_dir)
    return route.union_events(_events(spark, sf_dir), reconcile.ordered_events(events))


def write_origins(spark, sf_dir):
    return counters.write_origins(_all_events(spark, sf_dir))


def union_events(spark, sf_dir):
    return _all_events(spark, sf_dir).groupBy("event").agg(
        F.count("*").alias("events"), F.count_distinct("payload.id").alias("listings")
    )


# Table state


def latest_state(spark, sf_dir):
    """Flagship: messages to the current state of every listing."""
    return merge.first_state(_changes(_events(spark, sf_dir))).select(
        "id", "steamid", "intent", "metal", "details", "is_deleted"
    )


def _flat(listings):
    joined = {n: F.array_join(n, ",").alias(n) for n in ("spell_ids", "strange_part_ids")}
    return listings.select(*[joined.get(f.name, F.col(f.name)) for f in LISTINGS.fields])


MID_MONTH_MS = 1_705_363_200_000  # 2024-01-16


def _slices(messages, *bounds):
    """Consecutive parts of the feed, cut by the messages' own time, so each is a filter on the scan."""
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = messages if low is None else feeds.since(messages, low)
        yield part if high is None else part.where(F.col("timestamp") < F.timestamp_millis(F.lit(high)))


def _parsed(messages):
    return parse.listing_events(parse.parse_listing_messages(messages))


def merge_state(spark, sf_dir):
    """The feed's first half as the stored table, the second half merged into it."""
    first, second = [_changes(_parsed(part)) for part in _slices(tables(spark, sf_dir).messages, MID_MONTH_MS)]
    return _flat(merge.merge(merge.first_state(first), second))


def refold_state(spark, sf_dir):
    """Changes of three consecutive batches folded together."""
    parts = _slices(tables(spark, sf_dir).messages, MID_MONTH_MS - 7 * times.DAY_MS, MID_MONTH_MS)
    first, second, third = [_changes(_parsed(part)) for part in parts]
    changes = fold.refold(first.unionByName(second).unionByName(third))
    return merge.first_state(changes).select("id", "details", "is_deleted", "created_at", "updated_at")


def merge_reconciled(spark, sf_dir):
    """The stored table after the reconciliation's events."""
    _, events = reconciled(spark, sf_dir)
    changes = fold.fold(fold.table_events(reconcile.ordered_events(events), F.col("ord_time")))
    return merge.merge(tables(spark, sf_dir).listings, changes).select(
        "id", "details", "is_deleted", "created_at", "updated_at"
    )


def stream_state(spark, sf_dir):
    """The feed through the streaming job: it runs three times as messages arrive, with a compaction."""
    root = f"{session.shared_dir(spark)}/stream/{uuid.uuid4().hex}"
    table = ListingTable(spark, f"{root}/table", buckets=8)
    job = Job(table, touched_at=c(DAILY), compact_every=2)
    for part in _slices(tables(spark, sf_dir).messages, MID_MONTH_MS - 7 * times.DAY_MS, MID_MONTH_MS):
        part.write.mode("append").parquet(f"{root}/messages")
        stream = feeds.file_stream(spark, f"{root}/messages")
        job.start(stream, f"{root}/checkpoint", interval=None).awaitTermination()
    return table.read().select("id", "details", "is_deleted", "created_at", "updated_at")


def stream_two_queries(spark, sf_dir):
    """Feed and requests in queries of their own: the requests' events reach the table through the feed's."""
    t = tables(spark, sf_dir)
    root = f"{session.shared_dir(spark)}/stream/{uuid.uuid4().hex}"
    table = ListingTable(spark, f"{root}/table", buckets=8)
    when = F.when(F.col("ord_partition") < 0, F.col("ord_time")).otherwise(c(DAILY))
    job = Job(table, touched_at=when, compact_every=2)
    asked = RequestJob(table, landed=lambda session: (t.snapshots, t.inventories, t.details), options=COMPLETE)
    numbered = t.requests.withColumn("offset", F.col("item_defindex").cast("bigint"))
    data = F.struct("item_defindex", "item_quality_id", "request_type", "listing_id", "max_inventory_size")
    numbered.select(
        F.lit(None).cast("binary").alias("key"), F.to_json(F.struct(data.alias("data"))).alias("value"), F.lit("requests").alias("topic"),
        F.lit(0).alias("partition"), "offset", F.timestamp_millis("generation_timestamp").alias("timestamp"),
    ).write.parquet(f"{root}/requests")
    t.messages.write.parquet(f"{root}/messages")

    def feed():
        stream = feeds.file_stream(spark, f"{root}/messages")
        job.start(stream, f"{root}/checkpoint", interval=None, events=asked.events(spark)).awaitTermination()

    feed()
    asked.start(feeds.file_stream(spark, f"{root}/requests"), f"{root}/asked", interval=None).awaitTermination()
    feed()
    return table.read().select("id", "details", "is_deleted", "created_at", "updated_at")


# Identifiers


def listing_ids(spark, sf_dir):
    parts = binding.trades(spark, sf_dir).select(
        "event_id",
        c("case event_id % 5 when 0 then upper(intent) when 1 then null when 2 then 'trade' else intent end").alias("side"),
        c("case when event_id % 6 = 0 then ' ' else cast(event_id as string) end").alias("asset"),
        c("case when event_id % 7 = 0 then null else steamid end").alias("seller"),
        c("case when event_id % 8 = 0 then '' else market end").alias("name"),
    )
    args = F.col("side"), F.lit(440), F.col("asset"), F.col("seller"), F.col("name")
    return parts.select("event_id", ids.listing_id(*args).alias("listing_id"), ids.listing_id_error(*args).alias("error"))


def id_class(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id", c("concat(source, '_', lang, case when doc_id % 3 = 0 then '_x' else '' end)").alias("id")
    )
    return docs.select("doc_id", ids.is_buy_id(F.col("id")).alias("is_buy"), ids.is_sell_id(F.col("id")).alias("is_sell"))


def url_values(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.col("url").alias("v"))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("v"))
    return pages.unionByName(parts).select("kind", "id", url_encoded(F.col("v")).alias("encoded"))


# Lookups and reports


def market_name_latest(spark, sf_dir):
    return lookups.latest_market_names(tables(spark, sf_dir).listings)


def existing_listings(spark, sf_dir):
    t = tables(spark, sf_dir)
    return lookups.live_ids(t.listings, t.requests)


def listing_by_seller(spark, sf_dir):
    return lookups.latest_id_by_seller(tables(spark, sf_dir).listings)


def live_listings_for_item(spark, sf_dir):
    t = tables(spark, sf_dir)
    return lookups.live_listings_for_items(t.listings, t.requests, newest_first=True)


def listing_by_id(spark, sf_dir):
    t = tables(spark, sf_dir)
    return lookups.live_listings_by_id(t.listings, t.requests.where(F.col("listing_id").isNotNull()))


def report_activity(spark, sf_dir):
    listings = tables(spark, sf_dir).listings
    now = listings.agg(F.max("updated_at").alias("m")).select((F.col("m") + 60_000).alias("m"))
    return reports.activity(listings, now.scalar())


def report_by_item(spark, sf_dir):
    return reports.by_item(tables(spark, sf_dir).listings)


def report_by_item_incremental(spark, sf_dir):
    """The report kept up to date over three parts of the feed, each a batch of changes."""
    cut = session.table_cut(spark)
    state = report = None
    parts = _slices(tables(spark, sf_dir).messages, MID_MONTH_MS - 7 * times.DAY_MS, MID_MONTH_MS)
    for k, part in enumerate(parts):
        changes = cut(_changes(_parsed(part)), f"changes_{k}")
        if state is None:
            state = cut(merge.first_state(changes), "state_0")
            report = cut(reports.by_item(state), "report_0")
            continue
        after = cut(merge.merge(state, changes), f"state_{k}")
        report = cut(reports.by_item_after(report, reports.item_deltas(state, changes), after), f"report_{k}")
        state = after
    return report


def report_by_chosen_items(spark, sf_dir):
    return reports.by_item(tables(spark, sf_dir).listings, [3, 5, 12])


def price_ladder(spark, sf_dir):
    return reports.price_ladder(tables(spark, sf_dir).listings, 5, 6).select("id", "intent", "raw_value", "short_value")


def browse(spark, sf_dir):
    return reports.browse(tables(spark, sf_dir).listings).select("id", "steamid", "market_name", "raw_value")


def time_helpers(spark, sf_dir):
    ev = binding.trades(spark, sf_dir).select("event_id", F.unix_millis("ts").alias("ms"))
    iso = ev.select("*", times.iso_local(F.col("ms")).alias("iso"))
    zoned = F.concat(F.substring("iso", 1, 19), F.lit("+01:00"))
    return iso.select(
        "event_id", "iso", times.iso_to_ms(F.col("iso")).alias("back"), times.iso_to_ms(zoned).alias("zoned"),
        times.ms_ago(F.col("ms"), minutes=5).alias("minutes_ago"), times.ms_ago(F.col("ms"), hours=2).alias("hours_ago"),
        times.ms_ago(F.col("ms"), days=3).alias("days_ago"),
    )


# Requests


def request_messages(spark, sf_dir):
    """One request message per trade, with types named, numbered, absent and unknown."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))

    def number(expression):
        return f"if({expression} = -1, null, if(event_id % 2 = 0, cast(cast({expression} as string) as variant), cast({expression} as variant)))"

    data = c(
        f"""
        struct(
          {number('event_id % 13 - 1')} as item_defindex,
          {number('event_id % 17 - 1')} as item_quality_id,
          case event_id % 9 when 0 then cast('FULL' as variant) when 1 then cast('BUY_ONLY' as variant)
            when 2 then cast('SELL_ONLY' as variant) when 3 then cast('SINGLE_ID' as variant) when 4 then cast(0 as variant)
            when 5 then cast('3' as variant) when 8 then cast('INVENTORY' as variant) end as request_type,
          case event_id % 5 when 0 then concat('440_', event_id) when 1 then ' ' end as listing_id,
          case event_id % 19 when 0 then 0 when 1 then 7 end as max_inventory_size)
        """
    )
    return ev.select(
        F.to_json(F.struct(data.alias("data"), F.lit("tool").alias("source"))).alias("value"),
        F.lit("requests").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), "timestamp",
    )


def request_types(spark, sf_dir):
    parsed = parse.parse_request_messages(request_messages(spark, sf_dir))
    asked = parsed.where(F.col("request").isNotNull()).select("offset", "request.*")
    return requests.classify(asked).select("offset", "effective_type", "refusal")


def request_rejects(spark, sf_dir):
    return parse.rejects(parse.parse_request_messages(request_messages(spark, sf_dir))).select("offset", "reject_reason")


# Landed responses


def _entries(entries):
    return entries.where(F.col("pos").isNotNull()).select(
        "market_name", "page", "pos", "listing.steamid", F.lower("listing.intent").alias("intent"), "listing.price",
        "listing.item.defindex",
    )


def snapshot_explode(spark, sf_dir):
    return _entries(landing.snapshot_entries(tables(spark, sf_dir).snapshots))


def snapshot_split(spark, sf_dir):
    """The same from bodies cut between their listings, about ten parts of each."""
    return _entries(landing.snapshot_entries(tables(spark, sf_dir).snapshots, split_chars=400))


def snapshot_states(spark, sf_dir):
    entries = landing.snapshot_entries(tables(spark, sf_dir).snapshots)
    counts = entries.groupBy("market_name", "appid").agg(F.count("pos").alias("listings"))
    return landing.snapshot_states(entries).join(counts, ["market_name", "appid"]).drop("appid", "snapshot_fetched_at")


def body_clean(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", clean_json_body(F.col("html")).alias("cleaned"))


def inventory_clean(spark, sf_dir):
    return landing.inventories(tables(spark, sf_dir).inventories).select("steamid", "state", "n_items")


def fetch_outcomes(spark, sf_dir):
    t = tables(spark, sf_dir)
    return counters.fetch_outcomes(snapshot=t.snapshots, inventory=t.inventories, detail=t.details)


def landed_latest(spark, sf_dir):
    """Details that were refused at first and answered later: the newest response counts."""
    t = tables(spark, sf_dir)
    answered = t.details.withColumn("fetched_at", F.lit(GENERATION_TS).cast("bigint"))
    refused = t.details.select(
        "listing_id", F.lit(429).alias("http_status"), F.lit(None).cast("string").alias("body"),
        F.lit(GENERATION_TS - 1000).cast("bigint").alias("fetched_at"),
    )
    return landing.details(answered.unionByName(refused)).select("listing_id", "state")


# Reconciliation


def request_freshness(spark, sf_dir):
    """Which listings of a request are answered when only responses of the last minute count."""
    t, cut = tables(spark, sf_dir), session.table_cut(spark)

    def fetched(landed, back):
        return landed.withColumn("fetched_at", (F.lit(GENERATION_TS) - back).cast("bigint"))

    old = F.ascii(F.substring("listing_id", -1, 1)) % 2 == 1
    details = fetched(t.details, F.when(old, 120_000).otherwise(30_000))
    second = F.lit(1000)
    landed = reconcile.Market(t.listings, fetched(t.snapshots, second), details, fetched(t.inventories, second))
    steps = reconcile.prepare(t.requests, landed, reconcile.Options(max_age_ms=60_000), cut=cut)
    return steps.answered.select("request_id", "part", "listing_id", "landed")


def _place(df, *columns):
    return df.select("request_id", "place.page", "place.pos", "steamid", *columns)


def snapshot_buy(spark, sf_dir):
    return _place(reconciled(spark, sf_dir)[0].buy_rows, "listing_id")


def snapshot_sell(spark, sf_dir):
    return _place(reconciled(spark, sf_dir)[0].sell_rows)


def inventory_match(spark, sf_dir):
    return reconciled(spark, sf_dir)[0].scans.select("request_id", "steamid", "n_matches", "skip_reason")


def inventory_skipped(spark, sf_dir):
    skipped = reconciled(spark, sf_dir)[0].scans.where(F.col("skip_reason").isNotNull())
    return skipped.select("request_id", "steamid", "skip_reason")


def buy_truth(spark, sf_dir):
    return _place(reconcile.buy_truth(reconciled(spark, sf_dir)[0]), F.col("payload.id").alias("id"))


def sell_truth(spark, sf_dir):
    truth = reconcile.sell_truth(reconciled(spark, sf_dir)[0])
    return _place(truth, F.col("item.id").alias("item_id"), F.col("payload.id").alias("id"))


def truth_profiles(spark, sf_dir):
    """Every buy listing looked up, found or not, and every confirmed sell listing."""
    steps = reconciled(spark, sf_dir)[0]
    columns = ["request_id", "place", "listed", "item", "payload"]
    buys = steps.answered.where(F.col("part") == "buy").select(*columns)
    return reconcile.truth_profile(buys.unionByName(reconcile.sell_truth(steps).select(*columns)))


def stale_buy(spark, sf_dir):
    return reconcile.stale_buys(reconciled(spark, sf_dir)[0]).select("request_id", "id", "steamid")


def stale_sell(spark, sf_dir):
    return reconcile.stale_sells(reconciled(spark, sf_dir)[0]).select("request_id", "id", "steamid")


def _event_rows(events):
    return events.select(
        "request_id", "stage", "page", "pos", "id", "event", "generation_timestamp", "payload.steamid", "payload.details"
    )


def _of_type(kind: str) -> Query:
    """Events of the requests of one type."""

    def query(spark, sf_dir):
        steps, events = reconciled(spark, sf_dir)
        chosen = steps.verdicts.where(F.col("effective_type") == kind).select("request_id")
        return _event_rows(events.join(chosen, "request_id", "left_semi"))

    return query


def reconcile_all(spark, sf_dir):
    """A fresh reconciliation of all requests."""
    return _event_rows(run_reconciliation(spark, sf_dir)[1])


COPIES = 3


def reconcile_shared(spark, sf_dir):
    """Every request made three times: reconciled once, and answered three times."""
    cut, m = session.table_cut(spark), market(spark, sf_dir)
    copies = tables(spark, sf_dir).requests.select("*", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("n")).select(
        F.concat_ws("-", "request_id", "n").alias("request_id"), "request_type", "item_defindex", "item_quality_id", "listing_id",
        "max_inventory_size", (F.col("generation_timestamp") + F.col("n")).alias("generation_timestamp"),
    )
    asked, members = (cut(df, name) for df, name in zip(reconcile.shared_work(copies, COMPLETE), ("asked", "members")))
    steps = reconcile.prepare(asked, m, COMPLETE, cut=cut)
    events = cut(reconcile.events(steps, m.listings), "events")
    return _event_rows(reconcile.for_every_request(events, members))


def request_outcomes(spark, sf_dir):
    return reconcile.outcomes(*reconciled(spark, sf_dir))


def request_times(spark, sf_dir):
    """Times of the requests by type: sketches of two batches, merged."""
    steps, events = reconciled(spark, sf_dir)
    end = F.lit(GENERATION_TS) + 10 * F.col("item_defindex") + F.coalesce(F.col("updates"), F.lit(0))
    outcomes = reconcile.outcomes(steps, events, end)
    odd = F.substring("request_id", -1, 1).isin("1", "3", "5", "7", "9")
    batches = [counters.request_times(outcomes.where(odd == bool(k)), k) for k in (0, 1)]
    return counters.merged_times(batches[0].unionByName(batches[1]))


def request_counters(spark, sf_dir):
    return counters.request_counters(request_outcomes(spark, sf_dir))


def handler_metrics(spark, sf_dir):
    return counters.handler_counters(*reconciled(spark, sf_dir))


@lru_cache(maxsize=8)
def _landed_states(spark: SparkSession, application: str, sf_dir: str) -> DataFrame:
    """States of all responses, as two batches of landings have left them: refused at first, answered later."""
    t, cut = tables(spark, sf_dir), session.table_cut(spark)
    landed = {"snapshots": t.snapshots, "inventory": t.inventories, "detail": t.details}

    def batch(number, http_status, body):
        rows = {
            name: df.withColumns({"http_status": http_status, "body": body, "fetched_at": F.lit(GENERATION_TS + number).cast("bigint")})
            for name, df in landed.items()
        }
        return cut(landing.response_states(**rows), f"states_{number}")

    refused = batch(0, F.lit(429), F.lit(None).cast("string"))
    return cut(landing.fold_states(refused.unionByName(batch(1, F.col("http_status"), F.col("body")))), "states")


def landed_state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of states; folded once per session, then read as a stored table."""
    return _landed_states(spark, spark.sparkContext.applicationId, sf_dir)


def landed_states(spark, sf_dir):
    return landed_state_table(spark, sf_dir).select("endpoint", "key", "page", "state")


def fetch_worklist(spark, sf_dir):
    """What has to be called: details that have not landed, and unreadable inventories again."""
    steps, states = reconciled(spark, sf_dir)[0], landed_state_table(spark, sf_dir)
    return worklist.worklist(worklist.needs(steps), landing.answered(states), session.table_cut(spark))


def fetch_frontier(spark, sf_dir):
    """The calls to make now, when a third of the details has not been asked for yet."""
    later = (F.col("endpoint") == "detail") & (F.ascii(F.substring("key", -1, 1)) % 3 == 0)
    return worklist.frontier(reconciled(spark, sf_dir)[0], landed_state_table(spark, sf_dir).where(~later))


def frontier_calls(spark, sf_dir):
    return worklist.calls_to_hit(reconciled(spark, sf_dir)[0], landed_state_table(spark, sf_dir))


def fetch_budget(spark, sf_dir):
    return worklist.budget(worklist.needs(reconciled(spark, sf_dir)[0]))


def catalogue() -> dict[str, Query]:
    """All queries by name."""
    plain = [
        parse_fanout, parse_rejects, reject_previews, unwritable_changes, json_round_trip, price_polymorphism, price_list, route_updates,
        route_deletes, event_counts, write_origins, union_events, latest_state, merge_state, refold_state,
        merge_reconciled, stream_state, stream_two_queries, listing_ids, id_class, url_values, market_name_latest, existing_listings,
        listing_by_seller, live_listings_for_item, listing_by_id, report_activity, report_by_item, report_by_item_incremental, price_ladder, browse,
        time_helpers, request_types, request_rejects, snapshot_explode, snapshot_split, snapshot_states, snapshot_buy, snapshot_sell,
        body_clean, inventory_clean, inventory_match, inventory_skipped, buy_truth, sell_truth, truth_profiles, stale_buy,
        stale_sell, reconcile_all, reconcile_shared, request_outcomes, request_counters, request_times, handler_metrics, fetch_outcomes, fetch_worklist,
        landed_states, fetch_frontier, frontier_calls, fetch_budget, landed_latest, request_freshness, report_by_chosen_items,
    ]
    typed = {
        "single_id": _of_type("SINGLE_ID"), "buy_only": _of_type("BUY_ONLY"), "sell_only": _of_type("SELL_ONLY"),
        "full_backfill": _of_type("FULL"),
    }
    named = {q.__name__: q for q in plain} | typed
    return {name: _configured(query) for name, query in named.items()}


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(session.configure_parsing(spark), sf_dir)
