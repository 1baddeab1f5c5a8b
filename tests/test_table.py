"""Folding, merging and the batch-fed table, against event-by-event application."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stallkeeper.operators import fold, merge, parse
from stallkeeper.streaming import external
from stallkeeper.streaming.table import ListingTable


def message(*events):
    """One message from (kind, id, detail) triples."""
    data = [
        {"event": f"listing-{kind}", "payload": {"id": i, "steamid": "s", "intent": "buy", "details": d, "item": {}}}
        for kind, i, d in events
    ]
    return json.dumps({"data": data})


def changes_of(raw, touched):
    events = parse.listing_events(parse.parse_listing_messages(raw))
    return fold.fold(fold.table_events(events, touched))


def state(df):
    return {
        r["id"]: (r["details"], r["is_deleted"], r["created_at"], r["updated_at"])
        for r in df.select("id", "details", "is_deleted", "created_at", "updated_at").collect()
    }


def applied(batches):
    """What a row-at-a-time writer leaves, each batch at its own time."""
    table = {}
    for time, events in enumerate(batches):
        for kind, i, d in events:
            if kind == "update":
                created = table[i][2] if i in table else time
                table[i] = (d, False, created, time)
            elif kind == "delete" and i in table:
                table[i] = (table[i][0], True, table[i][2], time)
    return table


HISTORY = [
    [("update", "a", "a0"), ("delete", "a", None), ("update", "b", "b0"), ("delete", "ghost", None)],
    [("update", "a", "a1"), ("update", "b", "b1"), ("update", "b", "b2"), ("update", "c", "c0"), ("other", "c", None)],
    [("delete", "c", None), ("delete", "b", None), ("update", "ghost", "g0")],
    [("delete", "b", None), ("update", "c", "c1"), ("delete", "c", None)],
]


def test_merge_batch_by_batch(spark, raw_messages):
    current = merge.empty_table(spark)
    for time, events in enumerate(HISTORY):
        current = merge.merge(current, changes_of(raw_messages([message(*events)]), F.lit(time)))
    assert state(current) == applied(HISTORY)


def test_fold_of_folds_is_the_fold(spark, raw_messages):
    whole = raw_messages([message(*events) for events in HISTORY])
    at_once = merge.first_state(changes_of(whole, F.col("ord_time")))
    parts = [changes_of(whole.where(F.col("offset") == i), F.lit(i)) for i in range(len(HISTORY))]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    assert state(at_once) == state(merge.first_state(fold.refold(union))) == applied(HISTORY)


EVENT = st.tuples(st.sampled_from(["update", "delete", "other"]), st.sampled_from("abcd"), st.text("xyz", min_size=1, max_size=3))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(EVENT, min_size=1, max_size=8), min_size=1, max_size=4), st.data())
def test_any_split_into_batches_gives_the_same_table(spark, raw_messages, batches, data):
    raw = raw_messages([message(*events) for events in batches])
    expected = applied(batches)
    assert state(merge.first_state(changes_of(raw, F.col("ord_time")))) == expected
    at = data.draw(st.integers(0, len(batches)))
    current = merge.first_state(changes_of(raw.where(F.col("offset") < at), F.col("ord_time")))
    later = changes_of(raw.where(F.col("offset") >= at), F.col("ord_time"))
    assert state(merge.merge(current, later)) == expected


def test_order_is_time_then_place_in_the_log(spark):
    rows = [("late", 1, 0, 5), ("first", 0, 9, 1), ("early", 0, 8, 1), ("tie", 1, 1, 5)]
    texts = [(message(("update", "a", d)), "t", p, o, at) for d, p, o, at in rows]
    raw = spark.createDataFrame(texts, "value string, topic string, partition int, offset bigint, at bigint").selectExpr(
        "value", "topic", "partition", "offset", "timestamp_millis(at) timestamp"
    )
    assert state(merge.first_state(changes_of(raw, F.lit(0))))["a"][0] == "tie"


def test_table_appends_replays_and_compacts(spark, raw_messages, tmp_path):
    table = ListingTable(spark, str(tmp_path / "table"), buckets=4)
    assert table.read().count() == 0
    assert table.compact() == -1
    for time, events in enumerate(HISTORY):
        changes = changes_of(raw_messages([message(*events)]), F.lit(time))
        table.append(changes, time)
        table.append(changes, time)  # a replay overwrites itself
        assert state(table.read()) == applied(HISTORY[: time + 1])
        if time in (1, 2):
            assert table.compact() == time
            assert state(table.read()) == applied(HISTORY[: time + 1])
    assert state(table.read_until(3)) == applied(HISTORY[:3])
    assert table.outstanding(3) is None


def test_compaction_shuffles_only_the_changes(spark, raw_messages, tmp_path):
    table = ListingTable(spark, str(tmp_path / "table"), buckets=4)
    for time, events in enumerate(HISTORY[:2]):
        table.append(changes_of(raw_messages([message(*events)]), F.lit(time)), time)
        if time == 0:
            table.compact()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.read()._jdf.queryExecution().sparkPlan().toString()
        executed = table.read()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in executed or "Bucketed: true" in plan
    base_side = [line for line in executed.splitlines() if "Exchange hashpartitioning" in line]
    assert len(base_side) == 1  # the refold of the changes


def connect_to(folder):
    """Opens stand-ins for a database connection: one file per transaction."""

    class FileConnection:
        def __init__(self):
            self.pending = []

        def cursor(self):
            return self

        def executemany(self, sql, rows):
            self.pending += [[sql.split()[0], *row] for row in rows]

        def commit(self):
            import json
            import uuid

            with open(f"{folder}/{uuid.uuid4().hex}.json", "w") as out:
                json.dump(self.pending, out)
            self.pending = []

        def rollback(self):
            self.pending = []

        def close(self):
            assert not self.pending

    return lambda: FileConnection()


def test_external_upserts_are_keyed_transactions(spark, raw_messages, tmp_path):
    changes = changes_of(raw_messages([message(*e) for e in HISTORY]), F.lit(0))
    folder = str(tmp_path)
    external.write_changes(changes, connect_to(folder), "listings", batch_size=2, writers=3)
    written = [row for path in tmp_path.glob("*.json") for row in json.loads(path.read_text())]
    assert all(len(json.loads(p.read_text())) <= 4 for p in tmp_path.glob("*.json"))
    final = applied(HISTORY)
    upserts = {row[1]: row for row in written if row[0] == "insert"}
    deleted = {row[1] for row in written if row[0] == "update"}
    assert set(upserts) == set(final)
    assert deleted == {i for i, row in final.items() if row[1]}
    details = 1 + 1 + external.FIELD_NAMES.index("details")
    assert {i: row[details] for i, row in upserts.items()} == {i: row[0] for i, row in final.items()}


def test_external_statements():
    sql = external.upsert_sql("listings")
    assert sql.count("%s") == 33 and "created_at" not in sql and "steamid = excluded.steamid" in sql
    assert external.delete_sql("listings", "?") == "update listings set is_deleted = true where id = ?"
