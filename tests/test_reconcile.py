"""Reconciliation scenarios.  Each scenario is one request for its own item, and
all run in one plan, so they also show that requests do not affect each other."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import pytest
from pyspark.sql import functions as F

from stallkeeper import session
from stallkeeper.functions.ids import buy_id
from stallkeeper.plans import reconcile
from stallkeeper.schemas import LISTINGS, REQUEST_TABLE
from stallkeeper.sources import landing

STAMP = 1_700_000_000_000


@dataclass
class Case:
    """``snapshot``: (intent, seller) pairs, None for a null response, "absent" for none landed.
    ``stored``: live ids (or (id, seller)).  ``buy_details``: seller -> detail for its buy listing.
    ``items``: seller -> asset ids; ``details``: listing id -> detail.  A detail is an id, "no id" or 404."""

    kind: str | None
    snapshot: object = field(default_factory=list)
    stored: list = field(default_factory=list)
    deleted: list = field(default_factory=list)
    buy_details: dict = field(default_factory=dict)
    items: dict = field(default_factory=dict)
    details: dict = field(default_factory=dict)
    unreadable: tuple = ()
    max_size: int | None = None
    listing_id: str | None = None
    named: bool = True
    defindex: object = "own"
    quality: object = 6


def build(spark, cases: dict[str, Case]):
    listings, pages, details, inventories, requests = [], [], [], {}, []
    names = spark.createDataFrame([(n,) for n in sorted({s for c in cases.values() for s in c.buy_details})] or [("-",)], "s string")
    hashes = {}
    for number, name in enumerate(cases, start=1):
        for r in names.select("s", buy_id(F.lit(440), F.col("s"), F.lit(f"Item {number}")).alias("i")).collect():
            hashes[number, r["s"]] = r["i"]
    for number, (name, case) in enumerate(cases.items(), start=1):
        market_name = f"Item {number}" if case.named else None

        def stored_row(key, is_deleted):
            listing_id, seller = key if isinstance(key, tuple) else (key, "someone")
            row = dict.fromkeys(LISTINGS.names) | {
                "id": listing_id, "steamid": seller, "item_defindex": number, "item_quality_id": 6, "intent": "buy",
                "market_name": market_name, "is_deleted": is_deleted, "created_at": 1, "updated_at": 1}
            return tuple(row[n] for n in LISTINGS.names)

        listings += [stored_row(k, False) for k in case.stored] + [stored_row(k, True) for k in case.deleted]
        if market_name:  # a deleted row still names its item
            listings.append(stored_row(f"name_of_{number}", True))
        if case.snapshot != "absent":
            body = "null" if case.snapshot is None else json.dumps(
                {"listings": None if case.snapshot == "no list" else [
                    {"intent": i, "steamid": s, "item": {"defindex": number, "quality": 6}} for i, s in case.snapshot],
                 "appid": 440})
            pages.append((f"Item {number}", 440, 0, 200, body))

        def detail(listing_id, answer):
            body = None if answer == 404 else json.dumps(
                {"id": None if answer == "no id" else answer, "steamid": "d", "intent": "buy", "item": {"defindex": number}})
            return listing_id, 404 if answer == 404 else 200, body

        details += [detail(hashes[number, seller], answer) for seller, answer in case.buy_details.items()]
        details += [detail(listing_id, answer) for listing_id, answer in case.details.items()]
        for seller, assets in case.items.items():
            inventories.setdefault(seller, []).extend({"id": a, "defindex": number, "quality": 6} for a in assets)
        for seller in case.unreadable:
            inventories[seller] = None
        requests.append((name, case.kind, number if case.defindex == "own" else case.defindex, case.quality,
                         case.listing_id, case.max_size, STAMP))
    inventory_rows = [
        (s, 200, json.dumps({"result": {"status": 15 if i is None else 1, "items": i}})) for s, i in inventories.items()
    ]
    market = reconcile.Market(
        listings=spark.createDataFrame(listings, LISTINGS),
        snapshots=landing.snapshot_entries(
            spark.createDataFrame(pages, "market_name string, appid int, page bigint, http_status int, body string")),
        details=landing.details(spark.createDataFrame(details or [("-", 404, None)], "listing_id string, http_status int, body string")),
        inventories=landing.inventories(
            spark.createDataFrame(inventory_rows or [("-", 404, None)], "steamid string, http_status int, body string")),
    )
    return spark.createDataFrame(requests, REQUEST_TABLE), market, hashes


def run(spark, cases, **options):
    requests, market, hashes = build(spark, cases)
    cut = session.table_cut(spark)
    steps = reconcile.prepare(requests, market, reconcile.Options(**options), cut=cut)
    events = cut(reconcile.events(steps, market.listings), "events")
    outcomes = {r["request_id"]: r for r in reconcile.outcomes(steps, events).collect()}
    found = {name: [] for name in cases}
    for r in events.orderBy("request_id", "stage", "page", "pos", "id").collect():
        assert r["generation_timestamp"] == STAMP and r["payload"]["id"] == r["id"]
        found[r["request_id"]].append((r["event"].removeprefix("listing-"), r["id"]))
    return found, outcomes


BUY = [("buy", "s1"), ("sell", "s9"), ("BUY", "s2")]
SELL = [("sell", "q1"), ("buy", "q9"), ("Sell", "q2")]

CASES = {
    "buy updates and deletes": Case(
        "BUY_ONLY", BUY, stored=["b_1_x", "truth_b_1", "440_5", "a_b_c_d"], deleted=["b_2_x"],
        buy_details={"s1": "truth_b_1", "s2": "new_b_1"}),
    "buy with empty snapshot": Case("BUY_ONLY", [], stored=["buy_listing_old", "440_1"]),
    "buy with null snapshot": Case("BUY_ONLY", None, stored=["buy_listing_old2"]),
    "buy without name": Case("BUY_ONLY", "absent", stored=["c_1_x"], named=False),
    "buy with nothing stored": Case("BUY_ONLY", BUY, buy_details={"s1": "n_1_1", "s2": "n_2_1"}),
    "buy missing detail": Case("BUY_ONLY", [("buy", "s1"), ("buy", "s2"), ("buy", "s3")], stored=["d_1_x"],
                               buy_details={"s1": "d_1_y", "s2": 404, "s3": "d_1_z"}),
    "buy detail without id": Case("BUY_ONLY", [("buy", "s1"), ("buy", "s2")], stored=["e_1_x"],
                                  buy_details={"s1": "no id", "s2": "e_1_y"}),
    "buy without seller": Case("BUY_ONLY", [("buy", "s1"), ("buy", None)], stored=["f_1_x"], buy_details={"s1": "f_1_y"}),
    "sell updates and deletes": Case(
        "SELL_ONLY", SELL, stored=["440_100", "440_199", "sell_1_buy", "nounderscore"],
        items={"q1": [100], "q2": [200, 201]}, details={"440_100": "440_100", "440_200": 404, "440_201": "440_201"}),
    "sell first hit wins": Case("SELL_ONLY", [("sell", "w1")], items={"w1": [300, 301, 302]},
                                details={"440_300": 404, "440_301": "440_301", "440_302": "440_302"}),
    "sell two rows of one seller": Case("SELL_ONLY", [("sell", "w2"), ("sell", "w2")], items={"w2": [310]},
                                        details={"440_310": "440_310"}),
    "sell large inventory": Case("SELL_ONLY", [("sell", "l1"), ("sell", "l2")], max_size=2,
                                 stored=[("440_400", "l1"), ("440_499", "l2"), ("440_498", "other")],
                                 items={"l1": [400, 401, 402], "l2": [403, 404]},
                                 details={"440_403": "440_403", "440_400": "440_400"}),
    "sell no match": Case("SELL_ONLY", [("sell", "n1")], stored=["440_500"], items={"n1": []}),
    "sell missing detail": Case("SELL_ONLY", [("sell", "m1")], stored=["440_600"], items={"m1": [600]}, details={"440_600": 404}),
    "sell unreadable inventory": Case("SELL_ONLY", [("sell", "u1")], stored=[("440_700", "u1"), ("440_701", "z")], unreadable=("u1",)),
    "sell detail without id": Case("SELL_ONLY", [("sell", "v1"), ("sell", "v2"), ("sell", "v3")], stored=["440_809"],
                                   items={"v1": [800], "v2": [801], "v3": [802]},
                                   details={"440_800": "440_800", "440_801": "no id", "440_802": "440_802"}),
    "sell bad limit": Case("SELL_ONLY", SELL, max_size=0, stored=["440_850"]),
    "full": Case("FULL", [("buy", "s1"), ("sell", "x1")], stored=["g_1_x", "440_901"],
                 buy_details={"s1": "g_1_y"}, items={"x1": [900]}, details={"440_900": "440_900"}),
    "full by default": Case(None, [], stored=["h_1_x", "440_910"]),
    "full without name": Case("FULL", "absent", stored=["i_1_x"], named=False),
    "full with null snapshot": Case("FULL", None, stored=["j_1_x"]),
    "full with failing buy": Case("FULL", [("buy", "s1"), ("buy", "s2"), ("sell", "y1")], stored=["k_1_x", "440_921"],
                                  buy_details={"s1": "k_1_y", "s2": 404}, items={"y1": [920]}, details={"440_920": "440_920"}),
    "full with failing sell": Case("FULL", [("buy", "s1"), ("sell", "y2")], stored=["l_1_x", "440_931"],
                                   buy_details={"s1": "l_1_y"}, items={"y2": [930]}, details={"440_930": "no id"}),
    "full with bad limit": Case("FULL", [("buy", "s1"), ("sell", "y3")], stored=["m_1_x", "440_941"], max_size=-1,
                                buy_details={"s1": "m_1_y"}, items={"y3": [940]}, details={"440_940": "440_940"}),
    "snapshot without list": Case("BUY_ONLY", "no list", stored=["o_1_x"]),
    "no item": Case("FULL", [], stored=["p_1_x"], defindex=None),
    "bad item": Case("BUY_ONLY", [], stored=["p_2_x"], defindex=0),
    "bad quality": Case("BUY_ONLY", [], stored=["p_3_x"], quality=-1),
    "other quality": Case("BUY_ONLY", [], stored=["p_4_x"], quality=0),
    "single found": Case("SINGLE_ID", listing_id="one_1", details={"one_1": "other_id"}, stored=["one_1"]),
    "single gone": Case(None, listing_id="two_1", details={"two_1": 404}, stored=["two_1"], max_size=0),
    "single without detail id": Case("SINGLE_ID", listing_id="three_1", details={"three_1": "no id"}, stored=["three_1"]),
    "single unknown": Case("SINGLE_ID", listing_id="four_1", details={"four_1": 404}),
    "single already deleted": Case("SINGLE_ID", listing_id="five_1", details={"five_1": 404}, deleted=["five_1"]),
    "single new": Case("SINGLE_ID", listing_id="six_1", details={"six_1": "six_1"}, defindex=None, quality=None),
    "single blank": Case("SINGLE_ID", listing_id=" "),
}

U, D = "update", "delete"
EXPECTED = {
    "buy updates and deletes": ("processed", None, [(U, "truth_b_1"), (U, "new_b_1"), (D, "b_1_x")]),
    "buy with empty snapshot": ("processed", None, [(D, "buy_listing_old")]),
    "buy with null snapshot": ("processed", "null_snapshot", []),
    "buy without name": ("processed", "no_market_name", []),
    "buy with nothing stored": ("processed", None, [(U, "n_1_1"), (U, "n_2_1")]),
    "buy missing detail": ("failed", "buy_without_detail", [(U, "d_1_y")]),
    "buy detail without id": ("failed", "buy_without_detail", []),
    "buy without seller": ("failed", "buy_without_seller", []),
    "sell updates and deletes": ("processed", None, [(U, "440_100"), (U, "440_201"), (D, "440_199")]),
    "sell first hit wins": ("processed", None, [(U, "440_301")]),
    "sell two rows of one seller": ("processed", None, [(U, "440_310"), (U, "440_310")]),
    "sell large inventory": ("processed", None, [(U, "440_403"), (D, "440_498"), (D, "440_499")]),
    "sell no match": ("processed", None, [(D, "440_500")]),
    "sell missing detail": ("processed", None, [(D, "440_600")]),
    "sell unreadable inventory": ("processed", None, [(D, "440_701")]),
    "sell detail without id": ("failed", "detail_without_id", [(U, "440_800")]),
    "sell bad limit": ("failed", "refused: max_inventory_size", []),
    "full": ("processed", None, [(U, "g_1_y"), (D, "g_1_x"), (U, "440_900"), (D, "440_901")]),
    "full by default": ("processed", None, [(D, "h_1_x"), (D, "440_910")]),
    "full without name": ("failed", "no_market_name", []),
    "full with null snapshot": ("failed", "null_snapshot", []),
    "full with failing buy": ("failed", "buy_without_detail", [(U, "k_1_y")]),
    "full with failing sell": ("failed", "detail_without_id", [(U, "l_1_y"), (D, "l_1_x")]),
    "full with bad limit": ("processed", None, [(U, "m_1_y"), (D, "m_1_x")]),
    "snapshot without list": ("failed", "snapshot_without_listings", []),
    "no item": ("failed", "refused: item_defindex", []),
    "bad item": ("failed", "refused: item_defindex", []),
    "bad quality": ("failed", "refused: item_quality_id", []),
    "other quality": ("processed", "no_market_name", []),
    "single found": ("processed", None, [(U, "other_id")]),
    "single gone": ("processed", None, [(D, "two_1")]),
    "single without detail id": ("processed", None, [(D, "three_1")]),
    "single unknown": ("processed", None, []),
    "single already deleted": ("processed", None, []),
    "single new": ("processed", None, [(U, "six_1")]),
    "single blank": ("failed", "refused: listing_id", []),
}


@pytest.fixture(scope="module")
def complete(spark):
    return run(spark, CASES, assume_complete=True)


@pytest.mark.parametrize("name", EXPECTED)
def test_scenario(complete, name):
    events, outcomes = complete
    status, reason, expected = EXPECTED[name]
    assert (outcomes[name]["status"], outcomes[name]["reason"]) == (status, reason)
    assert events[name] == expected
    counted = (outcomes[name]["updates"], outcomes[name]["deletes"])
    assert counted == (sum(k == U for k, _ in expected), sum(k == D for k, _ in expected))


def test_every_scenario_has_a_result(complete):
    assert set(CASES) == set(EXPECTED) == set(complete[1])


def test_missing_buy_details_can_be_skipped(spark):
    names = ["buy missing detail", "full with failing buy"]
    events, outcomes = run(spark, {n: CASES[n] for n in names}, assume_complete=True, missing_buy_detail=reconcile.SKIP)
    assert events["buy missing detail"] == [(U, "d_1_y"), (U, "d_1_z"), (D, "d_1_x")]
    assert events["full with failing buy"] == [(U, "k_1_y"), (D, "k_1_x"), (U, "440_920"), (D, "440_921")]
    assert {o["status"] for o in outcomes.values()} == {"processed"}


def test_requests_wait_for_what_has_not_landed(spark):
    cases = {
        "snapshot": Case("FULL", "absent", stored=["a_1_x"]),
        "buy detail": Case("BUY_ONLY", [("buy", "s1")], stored=["b_1_x"]),
        "inventory": Case("SELL_ONLY", [("sell", "nobody")], stored=["440_1"]),
        "sell detail": Case("SELL_ONLY", [("sell", "t1")], stored=["440_2"], items={"t1": [20]}),
        "later sell detail": Case("SELL_ONLY", [("sell", "t2")], stored=["440_3"], items={"t2": [30, 31]}, details={"440_30": "440_30"}),
        "single": Case("SINGLE_ID", listing_id="x_1", stored=["x_1"]),
        "nothing awaited": Case("BUY_ONLY", [], stored=["c_1_x"]),
    }
    events, outcomes = run(spark, cases)
    status = {n: outcomes[n]["status"] for n in cases}
    assert status == dict.fromkeys(cases, "pending") | {"later sell detail": "processed", "nothing awaited": "processed"}
    assert events["later sell detail"] == [(U, "440_30"), (D, "440_3")]
    assert events["nothing awaited"] == [(D, "c_1_x")]
    assert all(not events[n] for n in cases if status[n] == "pending")


def test_types_can_be_added(spark):
    cases = {"own type": Case("SELL_LIKE", [("sell", "q1")], stored=["440_5"], items={"q1": [7]}, details={"440_7": "440_7"})}
    requests, market, _ = build(spark, cases)
    parts = {**reconcile.PARTS_BY_TYPE, "SELL_LIKE": ("sell",)}
    steps = reconcile.prepare(requests, market, reconcile.Options(True), parts, session.table_cut(spark))
    assert {r["id"] for r in reconcile.events(steps, market.listings).collect()} == {"440_7", "440_5"}
    refused = reconcile.prepare(requests, market, reconcile.Options(True), cut=session.table_cut(spark))
    assert refused.verdicts.first()["reason"] == "refused: unknown_type"
