"""Lookups, reports, worklist and source options."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import lookups, requests
from stallkeeper.plans import counters, reports, worklist
from stallkeeper.schemas import LISTINGS, REQUEST_TABLE
from stallkeeper.sources import feeds, landing, tables


@pytest.fixture(scope="module")
def listings(spark):
    def row(**given):
        return tuple((dict.fromkeys(LISTINGS.names) | {"is_deleted": False, "steamid": "s"} | given)[n] for n in LISTINGS.names)

    item = {"item_defindex": 190, "item_quality_id": 11, "market_name": "A"}
    rows = [
        row(id="1", **item, updated_at=10, created_at=10, intent="buy", raw_value=2.0),
        row(id="2", **item | {"market_name": "B"}, updated_at=30, created_at=1, intent="sell", is_deleted=True, raw_value=1.0),
        row(id="3", **item | {"market_name": None}, updated_at=40, created_at=35, intent="sell"),
        row(id="4", **item, updated_at=20, created_at=5, intent="sell", raw_value=1.5),
        row(id="5", item_defindex=None, item_quality_id=None, market_name="C", steamid="t", updated_at=5, created_at=5),
        row(id="6", item_defindex=5, item_quality_id=None, market_name="D", updated_at=6, created_at=6),
    ]
    return spark.createDataFrame(rows, LISTINGS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([("r", None, 190, 11, "5", None, 0), ("q", None, 5, None, "2", None, 0)], REQUEST_TABLE)


def test_lookups(listings, items):
    def got(df):
        return sorted(tuple(r) for r in df.collect())

    assert got(lookups.latest_market_names(listings.where("item_defindex = 190"))) == [(190, 11, "B")]
    assert got(lookups.live_ids(listings, items).select("id")) == [("1",), ("3",), ("4",)]
    assert got(lookups.latest_id_by_seller(listings)) == [("A", "s", "4"), ("C", "t", "5"), ("D", "s", "6")]
    newest = lookups.live_listings_for_items(listings, items, newest_first=True)
    assert [r["id"] for r in newest.collect()] == ["3", "4", "1"]
    assert got(lookups.live_listings_by_id(listings, items)) == [("5", "t", "C", 0, 0)]
    # Everything a batch of requests can look at, each row once.
    assert got(lookups.relevant_to(listings, items).select("id")) == [("1",), ("2",), ("3",), ("4",), ("5",)]


def test_reports(listings):
    assert tuple(reports.activity(listings, F.lit(3_600_030)).first())[:3] == (6, 1, 1)
    rows = [tuple(r) for r in reports.by_item(listings, [190, 266]).collect()]
    assert rows == [(190, 11, 4, 1, 3, 40)]
    assert len(reports.by_item(listings).collect()) == 3
    assert [r["id"] for r in reports.price_ladder(listings, 190, 11).collect()] == ["2", "4", "1", "3"]
    assert [r["id"] for r in reports.browse(listings, 2).collect()] == ["1", "2"]


def test_worklist_slots_match_brute_force(spark):
    needed = [(f"r{i % 3}", "detail", f"440_{i % 700}") for i in range(2100)]
    needed += [("r0", "snapshot", "Item 1"), ("r1", "snapshot", "Item 1"), ("r1", "inventory", "s 1")]
    df = spark.createDataFrame(needed, "request_id string, endpoint string, key string")
    landed = [(e, k) for _, e, k in needed if k.endswith("5")]
    rows = worklist.worklist(df, spark.createDataFrame(landed, "endpoint string, key string")).collect()
    open_keys = {(e, k) for _, e, k in needed} - set(landed)
    pace = {"snapshot": 10, "inventory": 10, "detail": 1}
    expected = {}
    for endpoint in pace:
        keys = sorted((hashlib.md5(k.encode()).hexdigest(), k) for e, k in open_keys if e == endpoint)
        expected |= {(endpoint, k): (slot, slot * pace[endpoint]) for slot, (_, k) in enumerate(keys)}
    assert {(r["endpoint"], r["key"]): (r["slot"], r["start_second"]) for r in rows} == expected
    assert {r["encoded_key"] for r in rows if r["endpoint"] == "inventory"} == {"s+1"}
    calls = {(r["request_id"], r["endpoint"]): r["calls"] for r in worklist.budget(df).collect()}
    assert calls["r0", "snapshot"] == 1 and calls["r0", "detail"] == len({k for r, e, k in needed if (r, e) == ("r0", "detail")})


def test_request_types_and_refusals(spark):
    rows = [
        ("1", None, 463, 5, None, None, 0),
        ("2", "BUY_ONLY", 463, 5, "test_id", 10, 0),
        ("3", None, None, None, "440_16525961480", None, 0),
        ("4", None, 1, 1, " ", 0, 0),
        ("5", "SELL_ONLY", 1, 0, None, None, 0),
        ("6", "SELL_ONLY", -1, 11, None, None, 0),
        ("7", "SELL_ONLY", 190, -1, None, None, 0),
        ("8", "SELL_ONLY", 190, 11, None, 0, 0),
        ("9", "SINGLE_ID", None, None, None, None, 0),
    ]
    got = requests.classify(spark.createDataFrame(rows, REQUEST_TABLE)).orderBy("request_id").collect()
    assert [r["effective_type"] for r in got] == [
        "FULL", "BUY_ONLY", "SINGLE_ID", "FULL", "SELL_ONLY", "SELL_ONLY", "SELL_ONLY", "SELL_ONLY", "SINGLE_ID",
    ]
    assert [r["refusal"] for r in got] == [
        None, None, None, None, None, "item_defindex", "item_quality_id", "max_inventory_size", "listing_id",
    ]
    flags = [(r["wants_buy"], r["wants_sell"], r["wants_single"]) for r in got]
    assert flags[:4] == [(True, True, False), (True, False, False), (False, False, True), (True, False, False)]


def test_response_classes(spark):
    codes = [200, 404, 429, 500, 503, 401, 403, 400, None]
    df = spark.createDataFrame([(c,) for c in codes], "http_status int")
    assert [r[0] for r in df.select(landing.outcome(F.col("http_status"))).collect()] == [
        "ok", "missing", "retry", "retry", "retry", "denied", "denied", "failed", "retry",
    ]
    rows = {tuple(r) for r in counters.fetch_outcomes(detail=df, snapshot=df.where("http_status = 200")).collect()}
    assert ("detail", "retry", 4) in rows and ("snapshot", "ok", 1) in rows


def test_snapshot_states(spark):
    pages = [
        ("ready", 0, 200, '{"listings":[{"steamid":"a"}],"zzz":1}'), ("ready", 1, 200, '{"listings":[]}'),
        ("null", 0, 200, "null"), ("none", 0, 200, "{}"), ("waiting", 0, 200, '{"listings":[]}'), ("waiting", 1, 429, None),
        ("garbled", 0, 200, "<html>"), ("misfit", 0, 200, '{"listings":[{"offers":"x"}]}'),
    ]
    df = spark.createDataFrame(pages, "market_name string, page bigint, http_status int, body string").withColumn("appid", F.lit(440))
    entries = landing.snapshot_entries(df)
    states = {r["market_name"]: r["snapshot_state"] for r in landing.snapshot_states(entries).collect()}
    assert states == {"ready": "ready", "null": "null", "none": "no_listings", "waiting": "pending",
                      "garbled": "pending", "misfit": "pending"}
    assert entries.where("pos is not null").count() == 1


def test_latest_response_counts(spark):
    rows = [("a", 1, 404, None), ("a", 2, 200, "{}"), ("b", 1, 200, "{}")]
    df = spark.createDataFrame(rows, "listing_id string, fetched_at bigint, http_status int, body string")
    got = {r["listing_id"]: r["http_status"] for r in landing.latest(df, "listing_id").collect()}
    assert got == {"a": 200, "b": 200}


def test_kafka_options():
    properties = feeds.consumer_properties(
        {"KAFKA_CONSUMER_MAX_POLL_RECORDS": "9", "KAFKA_CONSUMER_AUTO_OFFSET_RESET": "earliest", "KAFKA_CONSUMER_": "x", "HOME": "/"}
    )
    assert properties == {"max.poll.records": "9", "auto.offset.reset": "earliest"}
    options, refused = feeds.kafka_options(" b:9092 ", ["t1", "t2"], group="g", properties=properties, now_ms=10_000_000)
    assert refused == {"auto.offset.reset": "earliest"}
    assert options["kafka.bootstrap.servers"] == "b:9092" and options["subscribe"] == "t1,t2"
    assert options["kafka.max.poll.records"] == "9" and options["kafka.retry.backoff.ms"] == "1000"
    assert options["startingTimestamp"] == str(10_000_000 - 30 * 60_000)
    assert feeds.kafka_options("b", ["t"], start=123)[0]["startingTimestamp"] == "123"
    latest = feeds.kafka_options("b", ["t"], start=feeds.LATEST, max_offsets_per_trigger=500)[0]
    assert latest["startingOffsets"] == "latest" and "startingTimestamp" not in latest
    assert latest["maxOffsetsPerTrigger"] == "500"
    for brokers, topics in (("", ["t"]), ("b", []), ("b", [" "])):
        with pytest.raises(ValueError):
            feeds.kafka_options(brokers, topics)


def test_messages_since(spark, raw_messages, tmp_path):
    raw_messages(["a", "b", "c"]).selectExpr("cast(null as binary) as key", "*").write.parquet(str(tmp_path / "m"))
    late = feeds.since(feeds.file_batch(spark, str(tmp_path / "m")), 1)
    assert sorted(r["value"] for r in late.collect()) == ["b", "c"]
    assert "GreaterThanOrEqual(timestamp" in late._jdf.queryExecution().executedPlan().toString()


def test_listings_from_files(spark, listings, tmp_path):
    listings.write.parquet(str(tmp_path / "l"))
    read = tables.listings_from(spark, str(tmp_path / "l"), file_format="parquet")
    assert read.schema.simpleString() == LISTINGS.simpleString() and read.count() == 6


def test_database_reads_are_split_by_id_hash():
    parts = tables.hash_predicates(3)
    assert len(parts) == 3 and all(p.endswith(f"% 3 = {k}") and "id" in p for k, p in enumerate(parts))
    assert tables.hash_predicates(2, "crc32(id)") == ["crc32(id) % 2 = 0", "crc32(id) % 2 = 1"]


def test_activity_windows_are_parameters(spark, listings):
    now = F.lit(10_000_000)
    got = reports.activity(listings, now, {"lately": ("updated_at", {"days": 30}), "never": ("updated_at", {"days": -30})}).first()
    assert got["lately"] == got["total_listings"] and got["never"] == 0


def test_landed_pages(spark):
    """Newest answer of a page, one missing page leaves a snapshot open, older versions do not count."""
    rows = [
        ("a", 440, 0, 429, None, 1, 1), ("a", 440, 0, 200, '{"listings":[]}', 2, 1),
        ("b", 440, 0, 200, '{"listings":[]}', 1, 1), ("b", 440, 1, 429, None, 1, 1),
        ("c", 440, 0, 200, '{"listings":[]}', 5, 2), ("c", 440, 7, 500, None, 1, 1),
    ]
    landed = spark.createDataFrame(
        rows, "market_name string, appid int, page bigint, http_status int, body string, fetched_at bigint, snapshot_at bigint"
    )
    entries = landing.snapshot_entries(landed)
    states = {r["market_name"]: (r["snapshot_state"], r["snapshot_fetched_at"]) for r in landing.snapshot_states(entries).collect()}
    assert states == {"a": ("ready", 2), "b": ("pending", 1), "c": ("ready", 5)}
    none = spark.createDataFrame([], "steamid string, http_status int, body string")
    no_details = spark.createDataFrame([], "listing_id string, http_status int, body string")
    settled = worklist.settled(entries, landing.inventories(none), landing.details(no_details))
    assert sorted(tuple(r) for r in settled.collect()) == [("snapshot", "a"), ("snapshot", "c")]


DETAIL = "listing_id string, http_status int, body string, fetched_at bigint"
GOOD = '{"id": "x"}'


def test_batches_by_count_or_time():
    options = feeds.kafka_options("b", ["t"], min_offsets_per_trigger=feeds.BATCH_MESSAGES)[0]
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("10", "200ms")
    options = feeds.kafka_options("b", ["t"], min_offsets_per_trigger=3, max_trigger_delay="1s")[0]
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("3", "1s")
    assert not set(feeds.TRIGGERS) & set(feeds.kafka_options("b", ["t"])[0])
    with pytest.raises(ValueError):
        feeds.kafka_options("b", ["t"], max_trigger_delay="1s")


def test_request_times_merge(spark):
    """Sketches of batches merge to what all outcomes together give."""
    rows = [(f"r{i}", "FULL" if i % 3 else "BUY_ONLY", "pending" if i == 4 else "failed" if i % 5 else "processed", 1000 + i * 7 % 50, i * 13 % 101) for i in range(90)]
    rows.append(("r_none", "FULL", "failed", None, None))
    df = spark.createDataFrame(rows, "request_id string, effective_type string, status string, finished_at bigint, took_ms bigint")
    whole = counters.merged_times(counters.request_times(df)).collect()
    parts = [counters.request_times(df.where(F.xxhash64("request_id") % 3 == k), k) for k in (-2, -1, 0, 1, 2)]
    batches = parts[0]
    for part in parts[1:]:
        batches = batches.unionByName(part)
    assert sorted(map(tuple, counters.merged_times(batches).collect())) == sorted(map(tuple, whole))
    for kind, n, last, median, p95, p99 in whole:
        of = sorted(r[4] for r in rows if r[1] == kind and r[2] != "pending" and r[4] is not None)
        at = max((r for r in rows if r[1] == kind and r[2] != "pending" and r[4] is not None), key=lambda r: (r[3], r[0]))
        assert (n, last) == (len(of), at[4])
        assert [median, p95, p99] == [of[-(-len(of) * q // 100) - 1] for q in (50, 95, 99)]
    assert counters.merged_times(counters.request_times(df.limit(0))).count() == 0


def test_states_of_responses(spark):
    snapshots = spark.createDataFrame(
        [("a", 440, 0, 1, 200, '{"listings": []}'), ("a", 440, 1, 1, 429, None), ("b", 440, 0, 1, 200, "null"),
         ("c", 440, 0, 1, 200, "{}"), ("d", 440, 0, 1, 404, None), ("e", 440, 0, 1, 200, "{broken"), ("f", 570, 0, 1, 200, "{}"),
         (None, 440, 0, 1, 200, "{}")],
        "market_name string, appid int, page bigint, snapshot_at bigint, http_status int, body string",
    )
    inventory = spark.createDataFrame([("s", 200, '{"result": {"status": 1}}'), ("t", 200, "busy")], "steamid string, http_status int, body string")
    detail = spark.createDataFrame([("x", 200, GOOD, 5), ("x", 429, None, 6), ("y", 404, None, 5), ("z", 200, "null", 5)], DETAIL)
    states = landing.response_states(snapshots, inventory, detail)
    found = {(r.endpoint, r.key, r.page): r.state for r in states.collect()}
    assert found == {
        ("snapshot", "a", 0): "ok", ("snapshot", "a", 1): "retry", ("snapshot", "b", 0): "null", ("snapshot", "c", 0): "no_listings",
        ("snapshot", "d", 0): "missing", ("snapshot", "e", 0): "unreadable",
        ("inventory", "s", 0): "ok", ("inventory", "t", 0): "unreadable",
        ("detail", "x", 0): "retry", ("detail", "y", 0): "missing", ("detail", "z", 0): "missing",
    }
    assert sorted(tuple(r) for r in landing.answered(states).collect()) == [
        ("detail", "y"), ("detail", "z"), ("inventory", "s"), ("snapshot", "b"), ("snapshot", "c"),
    ]
    assert landing.response_states(snapshots.limit(0), inventory.limit(0), detail.limit(0)).count() == 0


def test_states_fold_to_the_newest(spark):
    rows = [
        ("detail", "x", 0, None, 5, "retry"), ("detail", "x", 0, None, 7, "ok"), ("detail", "x", 0, None, 6, "failed"),
        ("detail", "y", 0, None, None, "ok"), ("detail", "y", 0, None, 1, "denied"),
        ("detail", "z", 0, None, 4, "ok"), ("detail", "z", 0, None, 4, "retry"),
        ("snapshot", "m", 0, 1, 9, "ok"), ("snapshot", "m", 1, 1, 9, "retry"), ("snapshot", "m", 0, 2, 3, "ok"),
        ("snapshot", "n", 0, None, 1, "ok"), ("snapshot", "n", 1, None, 1, "ok"),
    ]
    folded = landing.fold_states(spark.createDataFrame(rows, landing.STATES))
    assert sorted(tuple(r)[:3] + (r.state,) for r in folded.collect()) == [
        ("detail", "x", 0, "ok"), ("detail", "y", 0, "denied"), ("detail", "z", 0, "ok"),
        ("snapshot", "m", 0, "ok"), ("snapshot", "n", 0, "ok"), ("snapshot", "n", 1, "ok"),
    ]
    again = landing.fold_states(folded.unionByName(folded))
    assert sorted(map(str, again.collect())) == sorted(map(str, folded.collect()))


def test_states_are_kept_as_responses_land(spark, tmp_path):
    from stallkeeper.streaming import landed

    def land(*rows):
        spark.createDataFrame(rows, DETAIL).coalesce(1).write.mode("append").parquet(str(tmp_path / "details"))
        stream = spark.readStream.schema(DETAIL).parquet(str(tmp_path / "details"))
        landed.start_states(stream, "detail", str(tmp_path / "states"), str(tmp_path / "checkpoint")).awaitTermination()
        return {r.key: r.state for r in landed.read_states(spark, str(tmp_path / "states")).collect()}

    assert land(("x", 429, None, 1), ("y", 200, GOOD, 1)) == {"x": "retry", "y": "ok"}
    assert land(("x", 200, GOOD, 2), ("z", 404, None, 2)) == {"x": "ok", "y": "ok", "z": "missing"}
    batch = spark.createDataFrame([("x", 200, GOOD, 2), ("z", 404, None, 2)], DETAIL)
    landed.write_states(batch, "detail", str(tmp_path / "states"), 1)  # replayed
    assert landed.read_states(spark, str(tmp_path / "states")).count() == 3


def test_frontier_stops_at_the_first_hit(spark):
    """Round by round, a seller's items are asked for until one has a detail; brute force says which."""
    import random
    from types import SimpleNamespace

    random.seed(6)
    items = {(f"r{r}", f"s{s}"): [f"440_{r}{s}{i}" for i in range(random.randint(0, 5))] for r in range(4) for s in range(5)}
    tries = [(request, "sell", seller, pos, key) for (request, seller), keys in items.items() for pos, key in enumerate(keys)]
    tries += [("r0", "buy", None, None, "440_s_name"), ("r1", "single", None, None, None)]
    answered = spark.createDataFrame(tries, "request_id string, part string, steamid string, item_pos int, listing_id string").cache()
    none = spark.createDataFrame([], "request_id string, market_name string, steamid string, wants_buy boolean, wants_sell boolean")
    steps = SimpleNamespace(answered=answered, located=none, scans=none)
    truth = {key: random.choice(["ok", "missing", "missing"]) for keys in items.values() for key in keys} | {"440_s_name": "ok"}
    known, calls = {}, {}
    while True:
        rows = [("detail", k, 0, None, 1, v) for k, v in known.items()] + [("detail", "440_1", 0, None, 1, "retry")]
        asked = {(r.request_id, r.key) for r in worklist.frontier(steps, spark.createDataFrame(rows, landing.STATES)).collect()}
        if not asked:
            break
        for request, key in asked:
            calls[request] = calls.get(request, 0) + 1
            assert key not in known
        known |= {key: truth[key] for _, key in asked}
    want = {"r0": 1}
    for (request, _), keys in items.items():
        hit = next((i for i, k in enumerate(keys) if truth[k] == "ok"), len(keys) - 1)
        want[request] = want.get(request, 0) + hit + 1
    assert calls == {r: n for r, n in want.items() if n}
    states = spark.createDataFrame([("detail", k, 0, None, 1, v) for k, v in truth.items()], landing.STATES)
    assert {r.request_id: r.calls for r in worklist.calls_to_hit(steps, states).collect()} == calls


def test_long_pages_are_cut_between_listings(spark):
    """Parts give the same entries, and the same states, as whole pages do."""
    def listing(i):
        return {"intent": "sell", "steamid": f"s{i}", "details": f'a "quoted" }},{{ text, é {i}', "price": i / 4, "item": {"defindex": i, "attributes": [{"x": [1, 2]}]}}

    whole = {"appid": 440, "sku": 'It"em', "createdAt": 5, "listings": [listing(i) for i in range(57)]}
    bodies = {
        "many": whole, "none": {"listings": []}, "absent": {"appid": 440, "sku": "x" * 900}, "null list": {"listings": None, "sku": "x" * 900},
        "bad listing": whole | {"listings": [listing(i) for i in range(20)] + [{"offers": "x"}]},
        "bad field": whole | {"appid": "x"}, "null listing": whole | {"listings": [None, listing(1)] * 20}, "no list": {"listings": {"a": "b" * 900}},
        "text price": whole | {"listings": [listing(i) | {"price": str(i)} for i in range(30)]},
    }
    rows = [(name, 440, k % 3, 200, json.dumps(body)) for k, (name, body) in enumerate(bodies.items())]
    rows += [("broken", 440, 0, 200, json.dumps(whole)[:-9]), ("gone", 440, 0, 404, "x" * 900), ("waits", 440, 0, None, None)]
    landed = spark.createDataFrame(rows, "market_name string, appid int, page bigint, http_status int, body string")
    plain, cut = landing.snapshot_entries(landed), landing.snapshot_entries(landed, split_chars=300)
    states = {r.market_name: r.snapshot_state for r in landing.snapshot_states(plain).collect()}
    assert states == {r.market_name: r.snapshot_state for r in landing.snapshot_states(cut).collect()}
    assert states["many"] == "ready" and states["bad listing"] == "pending" and states["bad field"] == "pending"
    ready = [name for name, state in states.items() if state == "ready"]
    columns = ["market_name", "page", "pos", F.to_json("listing").alias("listing")]

    def entries(df):
        return sorted(map(str, df.where(F.col("market_name").isin(ready) & F.col("pos").isNotNull()).select(*columns).collect()))

    assert entries(plain) == entries(cut) and len(entries(cut)) > 100
    # The parts are short, and are dealt out before their listings are read.
    parts = landing.split_pages(landed.where("market_name = 'many'"), 300)
    assert parts.count() > 20 and parts.agg(F.max(F.length("body"))).first()[0] < 700
    text = cut._jdf.queryExecution().executedPlan().toString()
    assert text.rindex("from_json") < text.index("hashpartitioning(market_name")


def test_report_follows_changes(spark):
    """Updates, deletes, revivals and moves between items, batch by batch, against the report of the whole table."""
    import random

    from stallkeeper.operators import fold, merge

    random.seed(8)
    state, report, now = merge.empty_table(spark), reports.by_item(merge.empty_table(spark)), 0
    for batch in range(6):
        rows = []
        for _ in range(25):
            now += random.randint(0, 2)
            item = {"defindex": random.choice([1, 2, 3]), "quality": {"id": random.choice([5, 6])} if random.random() < 0.8 else None}
            payload = {"id": f"l{random.randint(0, 14)}", "steamid": "s", "intent": random.choice(["buy", "sell"]), "item": item}
            rows.append({"event": random.choice(["listing-update"] * 2 + ["listing-delete"]), "payload": payload})
        texts = [(json.dumps({"data": [r]}), "listings", 0, 100 * batch + k, now) for k, r in enumerate(rows)]
        raw = spark.createDataFrame(texts, "value string, topic string, partition int, offset bigint, at bigint")
        raw = raw.selectExpr("value", "topic", "partition", "offset", "timestamp_millis(at) as timestamp")
        from stallkeeper.operators import parse

        events = parse.listing_events(parse.parse_listing_messages(raw))
        changes = spark.createDataFrame(fold.fold(fold.table_events(events, F.col("ord_time"))).collect(), fold.fold(fold.table_events(events, F.col("ord_time"))).schema)
        after = merge.merge(state, changes)
        report = reports.by_item_after(report, reports.item_deltas(state, changes), after)
        state = spark.createDataFrame(after.collect(), LISTINGS)
        report = spark.createDataFrame(report.collect(), report.schema)
        want = {tuple(r) for r in reports.by_item(state).collect()}
        assert {tuple(r) for r in report.collect()} == want
    assert len(want) > 4
