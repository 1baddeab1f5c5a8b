from pyspark.sql import functions as F

from stallkeeper.functions import ids, text, times


def test_known_identifiers(spark):
    rows = [
        ("sell", "12345678901234567890", None, None),
        ("buy", None, "76561199229477354", "Mann Co. Supply Crate Key"),
        ("BUY", None, "76561198421717954", "Strange Medi-Mask"),
        ("invalid", "1", "2", "3"),
        ("sell", None, None, None),
        ("sell", "  ", None, None),
        ("buy", None, None, "Item"),
        ("buy", None, "7656", None),
        (None, "1", "2", "3"),
    ]
    df = spark.createDataFrame(rows, "intent string, asset string, seller string, name string")
    args = F.col("intent"), F.lit(440), F.col("asset"), F.col("seller"), F.col("name")
    got = [tuple(r) for r in df.select(ids.listing_id(*args), ids.listing_id_error(*args)).collect()]
    assert got == [
        ("440_12345678901234567890", None),
        ("440_76561199229477354_d9f847ff5dfcf78576a9fca04cbf6c07", None),
        ("440_76561198421717954_a947cc644014a2d0a8f0f7a9dc5def69", None),
        (None, "unknown_intent"),
        (None, "blank_asset"),
        (None, "blank_asset"),
        (None, "blank_seller"),
        (None, "blank_market_name"),
        (None, "unknown_intent"),
    ]


def test_side_follows_from_underscores(spark):
    rows = [("440_1",), ("440_1_a",), ("x",), ("a_b_c_d",), (None,), ("buy_listing_old",)]
    got = spark.createDataFrame(rows, "id string").select(ids.is_buy_id(F.col("id")), ids.is_sell_id(F.col("id")))
    assert [tuple(r) for r in got.collect()] == [
        (False, True), (True, False), (False, False), (False, False), (False, False), (True, False),
    ]


def test_times(spark):
    rows = [(0,), (1703068200120,), (1703068200123,)]
    got = spark.createDataFrame(rows, "ms bigint").select(
        times.iso_local(F.col("ms")), times.iso_to_ms(times.iso_local(F.col("ms")))
    )
    assert [tuple(r) for r in got.collect()] == [
        ("1970-01-01T00:00:00", 0),
        ("2023-12-20T10:30:00.12", 1703068200120),
        ("2023-12-20T10:30:00.123", 1703068200123),
    ]
    texts = [("2023-12-20T10:30:00",), ("2023-12-20T10:30:00Z",), ("2023-12-20T10:30:00+01:00",), ("no",)]
    got = spark.createDataFrame(texts, "t string").select(times.iso_to_ms(F.col("t")))
    assert [r[0] for r in got.collect()] == [1703068200000, 1703068200000, 1703064600000, None]
    back = spark.range(1).select(
        times.ms_ago(F.lit(10**12), minutes=1), times.ms_ago(F.lit(10**12), hours=1), times.ms_ago(F.lit(10**12), days=1)
    )
    assert tuple(back.first()) == (10**12 - 60_000, 10**12 - 3_600_000, 10**12 - 86_400_000)
    now = spark.range(1).select(times.now_ms(), times.ms_ago(minutes=5)).first()
    assert now[0] - now[1] == 300_000


def test_bodies_are_cleaned(spark):
    rows = [
        ('\x01junk{"result":{"status":1}}tail\x7f',),
        ('{"a":1}',),
        ("no braces at all",),
        ("} reversed {",),
        ("",),
        (None,),
        ('  {"a":\x02 "b c"}\n',),
    ]
    got = spark.createDataFrame(rows, "b string").select(text.clean_json_body(F.col("b")))
    assert [r[0] for r in got.collect()] == ['{"result":{"status":1}}', '{"a":1}', None, None, None, None, '{"a": "b c"}']


def test_preview_and_encoding(spark):
    row = spark.createDataFrame([("a\x01b" + "x" * 600, "Mann Co. Key & more")], "p string, u string").select(
        text.preview(F.col("p")), text.url_encoded(F.col("u"))
    ).first()
    assert len(row[0]) == 500 and row[0].startswith("a�bx")
    assert row[1] == "Mann+Co.+Key+%26+more"
