import json

import pytest
from pyspark.sql import functions as F

from stallkeeper.operators import fold, parse, route
from stallkeeper.functions import wire
from stallkeeper.functions.rows import listing_fields
from stallkeeper.schemas import LISTING_UPDATE


def envelope(*payloads, **extra):
    data = [{"id": f"e{i}", "event": "listing-update", "payload": p} for i, p in enumerate(payloads)]
    return json.dumps({"data": data, "messageId": "m", "source": "feed", **extra})


REJECTED = {
    "word for a number": (envelope({"appid": "word"}), "bad_field"),
    "number too large": (envelope({"count": 3_000_000_000}), "bad_field"),
    "boolean for a number": (envelope({"appid": True}), "bad_field"),
    "boolean for a fraction": (envelope({"currencies": {"metal": True}}), "bad_field"),
    "object for a text": (envelope({"details": {"a": 1}}), "bad_field"),
    "array for a text": (envelope({"details": ["a"]}), "bad_field"),
    "number for an object": (envelope({"item": 5}), "bad_field"),
    "object for a list": (envelope({"item": {"spells": {}}}), "bad_field"),
    "number in a list of objects": (envelope({"item": {"spells": [5]}}), "bad_field"),
    "word inside a list": (envelope({"item": {"spells": [{"defindex": "x"}]}}), "bad_field"),
    "object in a list of texts": (envelope({"item": {"class": ["a", {}]}}), "bad_field"),
    "word in a counter": (envelope({"item": {"strangeParts": [{"killEater": {"id": "x"}}]}}), "bad_field"),
    "word in a counter's item": (
        envelope({"item": {"strangeParts": [{"killEater": {"id": 1, "item": {"defindex": "x"}}}]}}),
        "bad_field",
    ),
    "word in a list of a counter's item": (
        envelope({"item": {"strangeParts": [{"killEater": {"item": {"spells": [{"defindex": "x"}]}}}]}}),
        "bad_field",
    ),
    "number for a counter's item": (envelope({"item": {"strangeParts": [{"killEater": {"item": 5}}]}}), "bad_field"),
    "single quotes": ("{'data':[{'id':'e0','event':'listing-update'}]}", "malformed_json"),
    "bare NaN": ('{"data":[{"id":"e0","payload":{"currencies":{"metal":NaN}}}]}', "malformed_json"),
    "bare infinity": ('{"data":[{"id":"e0","payload":{"currencies":{"metal":-Infinity}}}]}', "malformed_json"),
    "number for a price": (envelope({"item": {"price": 5}}), "bad_field"),
    "word for a boolean": (envelope({"user": {"premium": "yes"}}), "bad_field"),
    "fraction for a boolean": (envelope({"user": {"premium": 0.5}}), "bad_field"),
    "deep price": (envelope({"value": {"steam": {"usd": "x"}}}), "bad_field"),
    "one bad event of two": (envelope({"appid": 440}, {"appid": "x"}), "bad_field"),
    "element not an object": ('{"data":[5]}', "bad_field"),
    "no data": ('{"messageId":"m"}', "no_data"),
    "null data": ('{"data":null}', "no_data"),
    "object data": ('{"data":{}}', "data_not_an_array"),
    "text data": ('{"data":"[]"}', "data_not_an_array"),
    "bad envelope field": ('{"data":[],"messageId":{}}', "bad_envelope_field"),
    "array document": ("[]", "not_an_object"),
    "null document": ("null", "null_document"),
    "truncated": ('{"data":[', "malformed_json"),
    "not json": ("hello", "malformed_json"),
    "empty": ("", "blank"),
    "blank": (" \n", "blank"),
    "missing": (None, "no_value"),
}

ACCEPTED = {
    "quoted number": envelope({"appid": "440"}),
    "fraction for an integer": envelope({"appid": 440.7}),
    "empty text for a number": envelope({"appid": "", "currencies": {"metal": "null"}}),
    "number for a text": envelope({"details": 12}),
    "text that looks like a list": envelope({"details": "[BUY] {now}"}),
    "price as an array": envelope({"item": {"price": [{"raw": 1}]}}),
    "numeric boolean": envelope({"user": {"premium": 1, "online": "TRUE", "banned": "false"}}),
    "anything in an opaque field": envelope({"user": {"role": {"a": [1]}, "bans": 5}, "item": {"tag": [1]}}),
    "sound counter's item": envelope(
        {"item": {"strangeParts": [{"killEater": {"id": 1, "item": {"defindex": "7", "tag": [1], "price": {"steam": {"raw": 1}}}}}]}}
    ),
    "counter's item in a counter's item": envelope(
        {"item": {"strangeParts": [{"killEater": {"item": {"strangeParts": [{"killEater": {"item": {"defindex": "x"}}}]}}}]}}
    ),
    "quoted NaN": envelope({"currencies": {"metal": "NaN"}}),
    "unknown fields": envelope({"zzz": {"appid": "word"}}, other=[1]),
    "null element": '{"data":[null,{"id":"e0","event":"listing-update"}]}',
    "repeated key": '{"data":[{"id":"x","id":"e0","event":"listing-update"}]}',
    "text after the document": envelope({}) + " junk",
}


@pytest.fixture(scope="module")
def parsed(spark, raw_messages):
    texts = [t for t, _ in REJECTED.values()] + list(ACCEPTED.values())
    rows = parse.parse_listing_messages(raw_messages(texts)).collect()
    names = list(REJECTED) + list(ACCEPTED)
    by_name = {name: [] for name in names}
    for row in rows:
        by_name[names[row["offset"]]].append(row)
    return by_name


@pytest.mark.parametrize("name", REJECTED)
def test_rejected_message(parsed, name):
    (row,) = parsed[name]
    assert row["reject_reason"] == REJECTED[name][1]
    assert row["update"] is None


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted_message(parsed, name):
    (row,) = parsed[name]
    assert row["reject_reason"] is None
    assert row["update"]["id"] == "e0"


def test_coercions(parsed):
    def payload(name):
        return parsed[name][0]["update"]["payload"]

    assert payload("quoted number")["appid"] == 440
    assert payload("fraction for an integer")["appid"] == 440
    assert payload("empty text for a number")["appid"] is None
    assert payload("number for a text")["details"] == "12"
    assert payload("price as an array")["item"]["price"] is None
    assert [payload("numeric boolean")["user"][k] for k in ("premium", "online", "banned")] == [True, True, False]
    assert json.loads(payload("anything in an opaque field")["user"]["role"]) == {"a": [1]}


def test_events_keep_order_and_route(spark, raw_messages):
    data = [
        {"id": "a", "event": "listing-update", "payload": {"id": "1"}},
        {"id": "b", "event": "listing-delete", "payload": {"id": "2"}},
        {"id": "c", "event": "client-limited"},
        {"id": "d"},
    ]
    parsed = parse.parse_listing_messages(raw_messages([json.dumps({"data": data}), json.dumps({"data": []})]))
    events = parse.listing_events(parsed)
    assert [r["id"] for r in events.orderBy("ord_pos").collect()] == ["a", "b", "c", "d"]
    assert [r["id"] for r in route.updates(events).collect()] == ["a"]
    assert [r["id"] for r in route.deletes(events).collect()] == ["b"]
    assert parse.rejects(parsed).count() == 0


FULL_PAYLOAD = {
    "id": "440_55_feed", "steamid": "55", "appid": 440,
    "currencies": {"keys": 3, "metal": 0.25}, "value": {"raw": 150.25, "short": "about 3", "long": "3 and a quarter"},
    "details": "for my shelf", "listedAt": 1000000001, "bumpedAt": 1000000002, "intent": "buy", "count": 1, "status": "open",
    "item": {
        "defindex": 321, "marketName": "Paper Crown", "quality": {"id": 14, "name": "Odd", "color": "#010203"},
        "particle": {"id": 9, "name": "Mist", "type": "slow"}, "tradable": True, "craftable": False,
        "strangeParts": [
            {"score": 4, "killEater": {"id": 41, "name": "y", "item": {"defindex": 17}}},
            {"score": 5, "killEater": {"id": 42}}, {"score": 6, "killEater": {}}, {"score": 7},
        ],
        "spells": [{"id": "wind"}, {"id": " "}, {"id": None}, {"name": "no id"}, {"id": "rain"}],
        "paint": {"id": 77, "name": "Slate", "color": "#0A0B0C"}, "paintSecondaryHex": "#0D0E0F",
        "price": {"suggested": {"raw": 8.5, "updatedAt": 12}}, "origin": None,
    },
    "userAgent": {"client": "robot", "lastPulse": 3}, "user": {
        "name": "keeper", "premium": True, "online": False, "banned": False, "tradeOfferUrl": "https://example.test/offer"},
}


def test_all_columns_of_a_row(spark, raw_messages):
    bare = {"id": "440_1", "steamid": "7", "intent": "sell", "item": {"quality": {}, "strangeParts": [], "paint": {}}, "value": {}}
    events = parse.listing_events(parse.parse_listing_messages(raw_messages([envelope(FULL_PAYLOAD, bare)])))
    full, minimal = [
        r["f"].asDict() for r in events.orderBy("ord_pos").select(listing_fields(F.col("payload")).alias("f")).collect()
    ]
    assert full == {
        "steamid": "55", "item_defindex": 321, "item_quality_id": 14, "intent": "buy", "appid": 440,
        "metal": 0.25, "keys": 3, "raw_value": 150.25, "short_value": "about 3", "long_value": "3 and a quarter",
        "details": "for my shelf", "listed_at": 1000000001000, "market_name": "Paper Crown", "status": "open",
        "user_agent_client": "robot", "user_name": "keeper", "user_premium": True, "user_online": False,
        "user_banned": False, "user_trade_offer_url": "https://example.test/offer", "item_tradable": True,
        "item_craftable": False, "item_quality_color": "#010203", "item_particle_name": "Mist",
        "item_particle_type": "slow", "bumped_at": 1000000002000, "spell_ids": ["wind", "rain"],
        "strange_part_ids": ["41", "42", "0"], "paint_id": 77, "paint_name": "Slate",
        "paint_color": "#0A0B0C", "paint_secondary_hex": "#0D0E0F",
    }
    expected = {name: None for name in full} | {
        "steamid": "7", "intent": "sell", "item_defindex": 0, "item_quality_id": 0, "appid": 0, "raw_value": 0.0,
        "listed_at": 0, "bumped_at": 0, "paint_id": 0,
    }
    assert minimal == expected


def test_updates_that_cannot_become_rows(spark, raw_messages):
    whole = {"id": "1", "steamid": "s", "intent": "buy", "item": {}}
    broken = [{k: v for k, v in whole.items() if k != missing} for missing in whole]
    events = parse.listing_events(parse.parse_listing_messages(raw_messages([envelope(whole, *broken)])))
    assert fold.table_events(events, F.lit(1)).count() == 1
    left_out = {r["defect"] for r in fold.unwritable(events).collect()}
    assert left_out == {"no_id", "no_seller", "no_intent", "no_item"}


def test_round_trip(spark, raw_messages):
    events = parse.listing_events(parse.parse_listing_messages(raw_messages([envelope(FULL_PAYLOAD)])))
    update = F.struct(*LISTING_UPDATE.names)
    text = events.select(update.alias("u"), parse.to_json(update).alias("j"))
    again = wire.Reader(LISTING_UPDATE).read(text, "j", "v")
    row = again.first()
    assert row["u"].asDict(True) == row["v"].asDict(True)
    # A counter's item, text by now, is read by itself: the document needs no second reading.
    assert row["v_fit"] == wire.SOUND


def test_a_counters_item_costs_no_second_reading(spark, raw_messages):
    """Its text is checked alone; what is wrong with it still rejects the message."""
    def counter(item):
        return envelope({"id": "1", "item": {"strangeParts": [{"score": 1, "killEater": {"id": 2, "item": item}}, {"score": 3}]}})

    items = {
        "plain": ({"defindex": 7, "name": "x", "tradable": True, "class": ["a"], "quality": {"id": 5}}, wire.SOUND),
        "opaque": ({"tag": {"a": [1]}, "strangeParts": [{"killEater": {"item": {"defindex": "x"}}}]}, wire.SOUND),
        "coerced": ({"defindex": "7", "level": 2.5}, wire.ODD),
        "list for a price": ({"price": []}, wire.ODD),
        "text": (json.dumps({"defindex": 7}), wire.SOUND),
        "any text": ("words", wire.ODD),
        "word": ({"defindex": "x"}, wire.BAD),
        "object for a text": ({"name": {"a": 1}}, wire.BAD),
        "word in a list": ({"spells": [{"defindex": "x"}]}, wire.BAD),
        "list": ([1], wire.BAD),
        "null": (None, wire.SOUND),
    }
    read = parse._read(raw_messages([counter(i) for i, _ in items.values()]), ["offset"], parse._FEED)
    found = {r["offset"]: r["document_fit"] for r in read.collect()}
    assert {name: found[k] for k, name in enumerate(items)} == {name: fit for name, (_, fit) in items.items()}


def test_requests(spark, raw_messages):
    def request(**data):
        return json.dumps({"data": data, "timestamp": "t", "messageId": "msg-123", "source": "tool"})

    cases = [
        (request(item_defindex=463, item_quality_id=5), None),
        (request(item_defindex=463, item_quality_id=5, request_type="BUY_ONLY", listing_id="x", max_inventory_size=10), None),
        (request(item_defindex="463", item_quality_id=5, request_type=2), None),
        (request(listing_id="440_1"), None),
        (request(item_defindex=0), "item_defindex_not_positive"),
        (request(item_defindex=-1), "item_defindex_not_positive"),
        (request(item_defindex=1, item_quality_id=0), "item_quality_id_not_positive"),
        (request(request_type="INVENTORY_FILTERED"), "unknown_request_type"),
        (request(item_defindex="word"), "bad_field"),
        ('{"data":null}', "no_data"),
        ('{"data":[]}', "bad_field"),
        ("", "blank"),
        (None, "no_value"),
        ("{", "malformed_json"),
    ]
    parsed = parse.parse_request_messages(raw_messages([c[0] for c in cases], topic="requests"))
    rows = {r["offset"]: r for r in parsed.collect()}
    assert [rows[i]["reject_reason"] for i in range(len(cases))] == [c[1] for c in cases]
    assert tuple(rows[0]["request"]) == (463, 5, None, None, None)
    assert tuple(rows[1]["request"]) == (463, 5, "BUY_ONLY", "x", 10)
    assert tuple(rows[2]["request"])[:3] == (463, 5, "SELL_ONLY")
    accepted = parse.requests(parsed).orderBy("request_id")
    assert [r["request_id"] for r in accepted.collect()] == [f"requests-0-{i}" for i in range(4)]


def test_price_shapes(spark):
    rows = [('{"p":{"raw":1}}',), ('{"p":[{"raw":1},{"raw":2}]}',), ('{"p":5}',), ("{}",), ('{"p":{"steam":{"raw":3}}}',)]
    docs = spark.createDataFrame(rows, "t string").select(wire.parse(F.col("t")).alias("d"))
    got = docs.select(parse.price_list(F.col("d"), "$.p").alias("l"), parse.item_price(F.col("d"), "$.p").alias("o")).collect()
    assert [len(r["l"]) for r in got] == [1, 2, 0, 0, 1]
    assert [r["o"] is not None for r in got] == [True, False, False, False, True]
    assert got[4]["o"]["steam"]["raw"] == 3.0


def test_odd_elements_alone_are_checked(spark, raw_messages):
    """A list with one odd element is usable or not by that element, wherever it stands."""
    sound, cut = '{"id":"a","payload":{"appid":440}}', '{"id":"b","payload":{"appid":440.7}}'
    lost, inner = '{"id":"c","payload":{"appid":"440.7"}}', '{"id":"d","payload":{"item":{"spells":[{"id":{}}]}}}'
    lists = [[sound, cut], [cut, "null", sound], [sound, cut, lost], [lost, sound], [sound, "7"], [cut, inner], ["null", cut]]
    texts = ['{"data":[%s]}' % ",".join(elements) for elements in lists]
    texts += ['{"source":1.5,"data":[%s]}' % cut, '{"source":[1],"data":[%s]}' % cut, '{"data":null,"source":{}}']
    parsed = parse.parse_listing_messages(raw_messages(texts))
    found = parsed.groupBy("offset").agg(
        F.max("reject_reason").alias("why"), F.array_sort(F.collect_list("update.payload.appid")).alias("appids")
    )
    rows = {r.offset: (r.why, r.appids) for r in found.collect()}
    assert rows == {
        0: (None, [440, 440]), 1: (None, [440, 440]), 2: ("bad_field", []), 3: ("bad_field", []), 4: ("bad_field", []),
        5: ("bad_field", []), 6: (None, [440]), 7: (None, [440]), 8: ("bad_envelope_field", []), 9: ("bad_envelope_field", []),
    }
    # The elements that lost nothing are left out before any is looked at.
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with(try_variant_get(" in plan
