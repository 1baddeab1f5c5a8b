"""Properties of the plans that matter at size: shuffles, pruning, join kinds."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalogue import queries
from catalogue.binding import tables
from stallkeeper import session
from stallkeeper.operators import fold, lookups, merge, parse
from stallkeeper.plans import counters, reconcile, worklist
from stallkeeper.sources import landing

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bound(spark):
    return tables(spark, SF_DIR)


def test_parsing_does_not_shuffle(bound):
    parsed = plan(parse.parse_listing_messages(bound.messages))
    # One reading of the message, and one of the small text of a counter's item.
    assert "Exchange" not in parsed and parsed.count("from_json(") == 2


def test_folding_shuffles_once_after_a_partial_aggregate(bound):
    events = parse.listing_events(parse.parse_listing_messages(bound.messages))
    text = plan(merge.first_state(fold.fold(fold.table_events(events, F.lit(1)))))
    assert len(re.findall("Exchange", text)) == 1
    assert text.index("Exchange") < text.index("partial_max_by")


def test_lookups_read_their_columns_only(bound):
    text = plan(lookups.latest_market_names(bound.listings))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"id", "item_defindex", "item_quality_id", "market_name", "updated_at"}
    assert "IsNotNull(market_name)" in text and "partial_max_by" in text


def test_reconciliation_has_equi_joins_only(spark, bound):
    plans = {}
    write = session.table_cut(spark)

    def recording(df, name):
        plans[name] = plan(df)
        return write(df, name)

    market = queries.market(spark, SF_DIR)
    steps = reconcile.prepare(bound.requests, market, reconcile.Options(True), cut=recording)
    recording(reconcile.events(steps, market.listings), "events")
    plans["worklist"] = plan(worklist.worklist(worklist.needs(steps)))
    for name, text in plans.items():
        for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
            assert unwanted not in text, (name, unwanted)
    # The requests are known to be small where they meet the large tables.
    assert "BroadcastHashJoin" in plans["answered"] or "BroadcastHashJoin" in plans["events"]


def test_landed_rows_are_filtered_before_they_are_read(spark, bound):
    """Whatever the sizes: only responses that some request needs are parsed."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for landed, key, reader in (
            (bound.snapshots, "market_name", landing.snapshot_entries),
            (bound.inventories, "steamid", landing.inventories),
            (bound.details, "listing_id", landing.details),
        ):
            text = plan(reconcile.wanted_only(landed, landed.select(key), key, reader))
            # Children are printed below: the join is under the parsing, and nothing is parsed under it.
            assert "from_json" in text and "LeftSemi" in text
            assert text.rindex("from_json") < text.index("LeftSemi"), key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_filters_on_landed_responses_do_not_reach_their_reading(bound):
    """A filter on what a body says is no reason to write its reading out again."""
    wants = {
        landing.snapshot_entries: (bound.snapshots, "state = 'ok' and has_listings and not is_null and listing.intent = 'buy'"),
        landing.inventories: (bound.inventories, "state in ('ok', 'missing') and n_items > 0"),
        landing.details: (bound.details, "state = 'ok' and payload.id is not null"),
    }
    for reader, (landed, condition) in wants.items():
        df = reader(landed).where(condition)
        optimized = df._jdf.queryExecution().optimizedPlan().toString()
        # A detail holds the text of a counter's item, which is read by itself.
        assert optimized.count("from_json(") == (2 if reader is landing.details else 1), reader.__name__
    states = landing.response_states(bound.snapshots, bound.inventories, bound.details)
    text = landing.answered(states)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 4


def test_open_calls_read_no_body(spark, bound):
    steps = queries.reconciled(spark, SF_DIR)[0]
    states = queries.landed_state_table(spark, SF_DIR)
    for df in (
        worklist.worklist(worklist.needs(steps), landing.answered(states)),
        worklist.frontier(steps, states),
        worklist.calls_to_hit(steps, states),
    ):
        text = plan(df)
        assert "from_json" not in text and "body" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_requests_for_the_same_share_their_work(spark, bound):
    """Many requests for one item make the rows of one, and the events of many."""
    one = bound.requests.where("request_id = 'r02'")
    many = one.crossJoin(spark.range(300).withColumnRenamed("id", "n")).withColumns(
        {"request_id": F.concat_ws("-", "request_id", "n"), "generation_timestamp": F.col("generation_timestamp") + F.col("n")}
    ).drop("n")
    market, found = queries.market(spark, SF_DIR), []
    for requests in (one, many):
        asked, members = reconcile.shared_work(requests, reconcile.Options(True))
        steps = reconcile.prepare(asked, market, reconcile.Options(True), cut=session.table_cut(spark))
        events = reconcile.events(steps, market.listings)
        found.append((steps.answered.count(), steps.scans.count(), steps.stored.count(), steps.verdicts.count(), events.count()))
        if requests is many:
            all_events = reconcile.for_every_request(events, members)
            assert all_events.count() == 300 * events.count()
            assert all_events.select("request_id", "generation_timestamp").distinct().count() == 300
            newest = reconcile.for_every_request(events, reconcile.newest_of(members))
            assert newest.count() == events.count()
            assert newest.select("generation_timestamp").distinct().first()[0] == many.agg(F.max("generation_timestamp")).first()[0]
            outcomes = reconcile.outcomes(steps, events, members=members)
            assert outcomes.count() == 300 and outcomes.select("updates", "deletes", "status").distinct().count() == 1
    assert found[0] == found[1] and found[0][-1] > 0
    # With a limit on age, requests made at different times are judged apart.
    apart, _ = reconcile.shared_work(many, reconcile.Options(max_age_ms=5))
    assert apart.count() == 300


def test_counters_parse_once(bound):
    text = plan(counters.feed_counters(bound.messages, parse.parse_listing_messages(bound.messages)))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and sum("value" in line.split("ReadSchema")[-1] for line in scans) == 1


def test_one_hot_listing_and_seller(spark, bound):
    """A listing with a third of all events does not change the others' result."""
    events = parse.listing_events(parse.parse_listing_messages(bound.messages))
    hot = events.where(F.col("event") == "listing-update").limit(1)
    copies = hot.crossJoin(spark.range(500).select(F.col("id").alias("n"))).select(
        "ord_time", "ord_partition", (F.col("ord_offset") + 10**6 + F.col("n")).alias("ord_offset"), "ord_pos", "id", "event",
        "generation_timestamp",
        F.col("payload").withField("id", F.lit("hot")).withField("details", F.col("n").cast("string")).alias("payload"),
    ).select(events.columns)
    plain = merge.first_state(fold.fold(fold.table_events(events, F.lit(1))))
    mixed = merge.first_state(fold.fold(fold.table_events(events.unionByName(copies), F.lit(1))))
    assert mixed.where("id = 'hot'").select("details").first()[0] == "499"
    rest = mixed.where("id <> 'hot'")
    assert rest.exceptAll(plain).count() == 0 and plain.exceptAll(rest).count() == 0
