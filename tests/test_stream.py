"""The streaming job on file sources: restarts, requests and waiting."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from stallkeeper.plans import counters, reconcile
from stallkeeper.schemas import RAW_MESSAGE
from stallkeeper.sources import feeds, landing
from stallkeeper.streaming.job import Job
from stallkeeper.streaming.requests import RequestJob
from stallkeeper.streaming.table import ListingTable


def update(i, details="d", **item):
    payload = {"id": i, "steamid": "s", "intent": "sell", "details": details,
               "item": {"defindex": 5, "marketName": "Item 5", "quality": {"id": 6}, **item}}
    return {"event": "listing-update", "payload": payload}


def delete(i):
    return {"event": "listing-delete", "payload": {"id": i, "steamid": "s"}}


class Log:
    """Appends files of messages to a folder, in the log's shape."""

    def __init__(self, spark, path):
        self.spark, self.path, self.next = spark, path, 0

    def append(self, *texts, topic="listings"):
        rows = []
        for text in texts:
            rows.append((None, text, topic, 0, self.next, self.next))
            self.next += 1
        df = self.spark.createDataFrame(rows, "key binary, value string, topic string, partition int, offset bigint, at bigint")
        shaped = df.withColumn("timestamp", F.timestamp_millis("at")).select(*RAW_MESSAGE.names)
        shaped.coalesce(1).write.mode("append").parquet(self.path)


def run(spark, job, log, checkpoint):
    stream = feeds.file_stream(spark, log.path, max_files_per_trigger=1)
    job.start(stream, checkpoint, interval=None).awaitTermination()


def rows(table):
    return {r["id"]: (r["details"], r["is_deleted"]) for r in table.read().collect()}


def test_feed_alone_restarts_where_it_stopped(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job = Job(table, compact_every=2)
    log.append(json.dumps({"data": [update("440_1", "one"), update("440_2")]}), "broken")
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert rows(table) == {"440_1": ("one", False), "440_2": ("d", False)}
    log.append(json.dumps({"data": [update("440_1", "two"), delete("440_2"), delete("440_9")]}))
    log.append(json.dumps({"data": [update("440_3", "three")]}))
    run(spark, Job(ListingTable(spark, table.root, buckets=2), compact_every=2), log, str(tmp_path / "checkpoint"))
    expected = {"440_1": ("two", False), "440_2": ("d", True), "440_3": ("three", False)}
    assert rows(table) == expected
    # A replayed batch leaves the same table.
    replay = feeds.file_batch(spark, log.path).where(F.col("offset") == 3)
    job.run_batch(replay, 2)
    assert rows(table) == expected
    rejected = spark.read.parquet(f"{table.root}/rejects/*")
    assert [tuple(r) for r in rejected.select("reject_reason", "reject_preview").collect()] == [("malformed_json", "broken")]


def test_requests_wait_and_then_reconcile(spark, tmp_path):
    landed = {"snapshots": [], "inventories": [], "details": []}

    def read_landed(session):
        return (
            landing.snapshot_entries(session.createDataFrame(
                landed["snapshots"], "market_name string, appid int, page bigint, http_status int, body string")),
            landing.inventories(session.createDataFrame(landed["inventories"], "steamid string, http_status int, body string")),
            landing.details(session.createDataFrame(landed["details"], "listing_id string, http_status int, body string")),
        )

    log = Log(spark, str(tmp_path / "log"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job = Job(table, request_topic="requests", landed=read_landed)
    log.append(json.dumps({"data": [update("440_1"), update("440_2")]}))
    log.append(json.dumps({"data": {"item_defindex": 5, "item_quality_id": 6, "request_type": "SELL_ONLY"}}),
               json.dumps({"data": {"item_defindex": -5}}), topic="requests")
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert rows(table) == {"440_1": ("d", False), "440_2": ("d", False)}

    def outcomes(batch):
        return [(r["request_id"], r["status"]) for r in spark.read.parquet(f"{table.root}/outcomes/{batch:012d}").collect()]

    assert outcomes(1) == [("requests-0-1", "pending")]
    assert spark.read.parquet(f"{table.root}/request_rejects/{1:012d}").count() == 1

    # The responses land; the next batch answers the waiting request.
    landed["snapshots"].append(("Item 5", 440, 0, 200, json.dumps({"listings": [{"intent": "sell", "steamid": "q"}]})))
    landed["inventories"].append(("q", 200, json.dumps({"result": {"status": 1, "items": [{"id": 2, "defindex": 5, "quality": 6}]}})))
    detail = update("440_2", "fresh")["payload"]
    landed["details"].append(("440_2", 200, json.dumps(detail)))
    log.append(json.dumps({"data": [update("440_7", "unrelated", defindex=6)]}))
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert outcomes(2) == [("requests-0-1", "processed")]
    assert rows(table) == {"440_1": ("d", True), "440_2": ("fresh", False), "440_7": ("unrelated", False)}

    log.append(json.dumps({"data": []}))
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert spark.read.parquet(f"{table.root}/waiting/{3:012d}").count() == 0
    assert rows(table)["440_2"] == ("fresh", False)


def test_requests_survive_runs_without_landed_responses(spark, tmp_path):
    """A run that cannot reconcile, and one that fails to, lose no request and no event."""
    log = Log(spark, str(tmp_path / "log"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    checkpoint = str(tmp_path / "checkpoint")

    def failing(session):
        raise OSError("landing is away")

    log.append(json.dumps({"data": {"item_defindex": 5, "item_quality_id": 6}}), topic="requests")
    run(spark, Job(table, request_topic="requests"), log, checkpoint)
    log.append(json.dumps({"data": [update("440_1"), {"event": "listing-delete", "payload": {"steamid": "q"}}]}), "broken")
    run(spark, Job(table, request_topic="requests"), log, checkpoint)
    assert spark.read.parquet(f"{table.root}/waiting/{1:012d}").count() == 1
    assert [r["defect"] for r in spark.read.parquet(f"{table.root}/unwritable/{1:012d}").collect()] == ["no_id"]
    counted = {r["counter"]: r["value"] for r in spark.read.parquet(f"{table.root}/counters/{1:012d}").collect()}
    assert counted["listing_upserts"] == 1 and counted["messages_parsed_failed"] == 1
    rejected = spark.read.parquet(f"{table.root}/rejects/{1:012d}").first()
    assert rejected["reject_value"] == "broken"

    log.append(json.dumps({"data": [update("440_2")]}))
    run(spark, Job(table, request_topic="requests", landed=failing), log, checkpoint)
    outcome = spark.read.parquet(f"{table.root}/outcomes/{2:012d}").first()
    assert outcome["status"] == "pending" and "landing is away" in outcome["reason"]
    assert rows(table) == {"440_1": ("d", False), "440_2": ("d", False)}
    # However often: the request is not to blame and waits on.
    waiting = spark.read.parquet(f"{table.root}/waiting/{2:012d}").first()
    assert waiting["attempts"] == 0 and "landing is away" in waiting["last_error"]


SNAPSHOTS = "market_name string, appid int, page bigint, http_status int, body string"


def items_on_the_market(spark, *items):
    """Landed responses for items: one seller and one confirmed listing each."""
    snapshots, inventories, details = [], [], []
    for i in items:
        listing = {"intent": "sell", "steamid": f"q{i}"}
        snapshots.append((f"Item {i}", 440, 0, 200, json.dumps({"listings": [listing]})))
        inventories.append((f"q{i}", 200, json.dumps({"result": {"status": 1, "items": [{"id": i, "defindex": i, "quality": 6}]}})))
        found = update(f"440_{i}", "fresh", defindex=i, marketName=f"Item {i}")["payload"]
        details.append((f"440_{i}", 200, json.dumps(found)))
    frames = (
        spark.createDataFrame(snapshots, SNAPSHOTS),
        spark.createDataFrame(inventories, "steamid string, http_status int, body string"),
        spark.createDataFrame(details, "listing_id string, http_status int, body string"),
    )
    return lambda session: frames


def request(i, kind="SELL_ONLY"):
    return json.dumps({"data": {"item_defindex": i, "item_quality_id": 6, "request_type": kind}})


def failing_prepare(monkeypatch, fails):
    """Reconciliations fail when ``fails(items)`` holds of the items asked for."""
    sound, runs = reconcile.prepare, []

    def prepare(requests, *rest):
        items = sorted(r[0] for r in requests.select("item_defindex").collect())
        runs.append(items)
        if fails(items):
            raise RuntimeError(f"cannot reconcile {items}")
        return sound(requests, *rest)

    monkeypatch.setattr(reconcile, "prepare", prepare)
    return runs


def outcomes_of(spark, root, batch):
    df = spark.read.parquet(f"{root}/outcomes/{batch:012d}")
    return {r["request_id"]: (r["status"], r["reason"]) for r in df.collect()}


def test_a_request_that_fails_fails_alone(spark, tmp_path, monkeypatch):
    runs = failing_prepare(monkeypatch, lambda items: 2 in items)
    log = Log(spark, str(tmp_path / "log"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job = Job(table, request_topic="requests", landed=items_on_the_market(spark, 1, 2, 3), max_attempts=2)
    log.append(json.dumps({"data": [update(f"440_{i}", "old", defindex=i, marketName=f"Item {i}") for i in (1, 2, 3)]}))
    log.append(*[request(i) for i in (1, 2, 3)], topic="requests")
    run(spark, job, log, str(tmp_path / "checkpoint"))
    found = outcomes_of(spark, table.root, 1)
    assert [found[f"requests-0-{i}"][0] for i in (1, 2, 3)] == ["processed", "pending", "processed"]
    assert "cannot reconcile [2]" in found["requests-0-2"][1]
    assert rows(table) == {"440_1": ("fresh", False), "440_2": ("old", False), "440_3": ("fresh", False)}
    waiting = [(r.request_id, r.attempts) for r in spark.read.parquet(f"{table.root}/waiting/{1:012d}").collect()]
    assert waiting == [("requests-0-2", 1)]
    # The next batch tries again; the second failure is its last.
    log.append(request(1), topic="requests")
    run(spark, job, log, str(tmp_path / "checkpoint"))
    found = outcomes_of(spark, table.root, 2)
    assert found["requests-0-4"][0] == "processed" and found["requests-0-2"][0] == "failed"
    assert spark.read.parquet(f"{table.root}/waiting/{2:012d}").count() == 0
    assert [2] in runs and rows(table)["440_2"] == ("old", False)


def test_a_passing_error_costs_no_request(spark, tmp_path, monkeypatch):
    calls = []
    runs = failing_prepare(monkeypatch, lambda items: not calls.append(items) and len(calls) == 1)
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job = Job(table, request_topic="requests", landed=items_on_the_market(spark, 1, 2))
    log = Log(spark, str(tmp_path / "log"))
    log.append(json.dumps({"data": [update(f"440_{i}", "old", defindex=i, marketName=f"Item {i}") for i in (1, 2)]}))
    log.append(request(1), request(2), topic="requests")
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert {status for status, _ in outcomes_of(spark, table.root, 1).values()} == {"processed"}
    assert runs[0] == [1, 2] and sorted(runs[1:]) == [[1], [2]]
    assert rows(table) == {"440_1": ("fresh", False), "440_2": ("fresh", False)}


def test_an_error_of_all_requests_counts_against_none(spark, tmp_path, monkeypatch):
    runs = failing_prepare(monkeypatch, lambda items: True)
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job = Job(table, request_topic="requests", landed=items_on_the_market(spark, 1), max_attempts=1, max_runs=4)
    log = Log(spark, str(tmp_path / "log"))
    log.append(*[request(i) for i in range(1, 6)], topic="requests")
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert len(runs) == 4 and len(runs[0]) == 5
    assert {status for status, _ in outcomes_of(spark, table.root, 0).values()} == {"pending"}
    waiting = spark.read.parquet(f"{table.root}/waiting/{0:012d}").collect()
    assert len(waiting) == 5 and {r.attempts for r in waiting} == {0}
    # Once the trouble is over, all are answered.
    monkeypatch.undo()
    log.append(json.dumps({"data": []}))
    run(spark, job, log, str(tmp_path / "checkpoint"))
    assert len(outcomes_of(spark, table.root, 1)) == 5
    assert spark.read.parquet(f"{table.root}/waiting/{1:012d}").where("attempts > 0").count() == 0


def test_two_queries_on_one_table(spark, tmp_path):
    """The feed advances while a reconciliation is held; its events arrive as a second stream."""
    import threading

    held, reached = threading.Event(), threading.Event()
    market = items_on_the_market(spark, 1)

    def landed(session):
        reached.set()
        assert held.wait(120)
        return market(session)

    feed, asked = Log(spark, str(tmp_path / "feed")), Log(spark, str(tmp_path / "asked"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job, requests = Job(table, compact_every=2), RequestJob(table, landed=landed)

    def feed_once():
        stream = feeds.file_stream(spark, feed.path)
        query = job.start(stream, str(tmp_path / "c1"), interval=None, events=requests.events(spark))
        query.awaitTermination()

    feed.append(json.dumps({"data": [update("440_1", "old", defindex=1, marketName="Item 1"), update("440_9", "gone", defindex=1, marketName="Item 1")]}))
    feed_once()
    asked.append(request(1), request(7), topic="requests")
    query = requests.start(feeds.file_stream(spark, asked.path), str(tmp_path / "c2"), interval=None)
    assert reached.wait(120)
    feed.append(json.dumps({"data": [update("440_5", "while held", defindex=5)]}))
    feed_once()
    assert rows(table)["440_5"] == ("while held", False) and rows(table)["440_1"] == ("old", False)
    held.set()
    query.awaitTermination()
    assert rows(table)["440_1"] == ("old", False)  # the table has one writer
    feed_once()
    want = {"440_1": ("fresh", False), "440_5": ("while held", False), "440_9": ("gone", True)}
    assert rows(table) == want
    assert {s for s, _ in outcomes_of(spark, requests.root, 0).values()} == {"processed"}
    # A batch that is replayed after its events were published adds none.
    requests.run_batch(feeds.file_batch(spark, asked.path), 0)
    feed_once()
    assert rows(table) == want and table.last_before("changes", 10**6).endswith(f"{2:012d}")


def test_requests_read_the_base_in_part(spark, tmp_path):
    """Rows for requests: the same as from the whole table, from fewer buckets and rows."""
    from stallkeeper.operators import lookups
    from stallkeeper.schemas import REQUEST_TABLE

    log = Log(spark, str(tmp_path / "log"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=16)
    job = Job(table)
    events = [update(f"440_{i}", f"d{i}", defindex=i % 40, marketName=f"Item {i % 40}") for i in range(400)]
    log.append(json.dumps({"data": events}))
    run(spark, job, log, str(tmp_path / "checkpoint"))
    table.compact()

    def wanted(*rows):
        return spark.createDataFrame([(f"r{k}", "FULL", d, q, i, None, 1) for k, (d, q, i) in enumerate(rows)], REQUEST_TABLE)

    def check(requests):
        part, whole = table.read_for(requests), table.read()
        items = {(r.item_defindex, r.item_quality_id) for r in requests.collect()}
        ids = {r.listing_id for r in requests.collect()}
        want = [r for r in whole.collect() if (r.item_defindex, r.item_quality_id) in items or r.id in ids]
        assert sorted(part.collect()) == sorted(want) and want
        return part._jdf.queryExecution().executedPlan().toString()

    text = check(wanted((None, None, "440_3"), (None, None, "440_4"), (None, None, "missing")))
    assert "SelectedBucketsCount" in text and all(int(n) <= 3 for n in re.findall(r"SelectedBucketsCount: (\d+) out of 16", text))
    text = check(wanted((7, 6, None), (8, 6, None), (8, 5, None), (None, 6, None)))
    assert "In(item_defindex, [7,8])" in text
    # Outstanding changes: moved to a wanted item and away from it, deleted, new.
    moved = [update("440_7", "away", defindex=30), update("440_30", "moved in", defindex=7), delete("440_47"), update("440_900", "new", defindex=7)]
    log.append(json.dumps({"data": moved}))
    run(spark, job, log, str(tmp_path / "checkpoint"))
    check(wanted((7, 6, None), (None, None, "440_100"), (None, None, "440_47")))
    few = lookups.MAX_LITERALS
    try:
        lookups.MAX_LITERALS = 1
        check(wanted((7, 6, None), (8, 6, None), (None, None, "440_100"), (None, None, "440_101")))
    finally:
        lookups.MAX_LITERALS = few


def test_a_batch_replayed_after_compaction_finds_its_base(spark, tmp_path):
    log = Log(spark, str(tmp_path / "log"))
    table = ListingTable(spark, str(tmp_path / "table"), buckets=2)
    job = Job(table, compact_every=2)
    batches = []
    for k in range(4):
        log.append(json.dumps({"data": [update("440_1", f"d{k}"), delete(f"440_{k}")]}))
        batches.append(spark.read.parquet(log.path).subtract(batches[-1]) if batches else spark.read.parquet(log.path))
        job.run_batch(batches[-1].select("*"), k)
    before = rows(table)
    job.run_batch(batches[-1], 3)  # replayed: the process ended before the checkpoint was written
    job.run_batch(batches[2], 2)
    assert rows(table) == before
    with pytest.raises(ValueError):
        table.read_until(1)


def test_types_can_be_added_end_to_end(spark, raw_messages):
    from stallkeeper.operators import parse

    text = json.dumps({"data": {"item_defindex": 5, "item_quality_id": 6, "request_type": "BUYERS"}})
    raw = raw_messages([text], topic="requests")
    assert parse.parse_request_messages(raw).first()["reject_reason"] == "unknown_request_type"
    added = parse.requests(parse.parse_request_messages(raw, ("BUYERS",))).first()
    assert added["request_type"] == "BUYERS"


def test_streams_report_their_counts(spark, tmp_path, raw_messages):
    from pyspark.sql import Observation

    from stallkeeper.operators import parse

    raw = raw_messages([json.dumps({"data": [update("1"), delete("1"), {"event": "other"}]}), "broken", None])
    parsed = parse.parse_listing_messages(raw)
    seen = Observation("feed")
    parsed.observe(seen, *[m.alias(k) for k, m in counters.event_measures().items()]).write.format("noop").mode("overwrite").save()
    expected = {"messages_parsed_failed": 2, "incoming_events": 3, "listing_upserts": 1, "deleted_listings": 1, "realtime_writes": 1}
    assert seen.get == expected
    rows = {r["counter"]: r["value"] for r in counters.feed_counters(raw, parsed).collect()}
    assert rows == expected | {"messages_consumed": 3, "messages_parsed_success": 1}
