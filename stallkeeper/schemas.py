"""Wire types of the JSON messages and the column contract of the listings table.

Field names and types below are fixed values of the wire format and of the
target table.  Everything else in the package is generated from them: the typed
extraction, the whole-message validity check and the row flattening.
"""

from __future__ import annotations

from pyspark.sql import types as T

APPID = 440
UPDATE_EVENT = "listing-update"
DELETE_EVENT = "listing-delete"
REQUEST_TYPES = ("FULL", "BUY_ONLY", "SELL_ONLY", "SINGLE_ID")

# A JSON array is tolerated (and read as null) where this object is expected.
ARRAY_READS_AS_NULL = "arrayReadsAsNull"
# Any JSON is tolerated here; nothing reads it, so it is kept as text.
OPAQUE = "opaque"
# Kept as text like the opaque, but its fields must fit the named type.
CHECKED_AS = "checkedAs"

_SCALARS = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "texts": T.ArrayType(T.StringType()),
    "opaque": T.StringType(),
}


def record(scalars: str, *nested: T.StructField) -> T.StructType:
    """Struct of ``name type`` pairs, followed by nested fields."""
    fields = []
    for pair in scalars.split(","):
        name, kind = pair.split()
        fields.append(T.StructField(name, _SCALARS[kind], True, {OPAQUE: True} if kind == "opaque" else None))
    return T.StructType([*fields, *nested])


def part(name: str, dtype: T.DataType, **marks: bool) -> T.StructField:
    return T.StructField(name, dtype, True, marks)


def parts(name: str, element: T.DataType) -> T.StructField:
    return T.StructField(name, T.ArrayType(element))


PRICE = record(
    "currency string, short string, long string, raw double, value double, valueHigh double, usd double, "
    "updatedAt bigint, difference double"
)
_PRICES = (part("steam", PRICE), part("community", PRICE), part("suggested", PRICE))
ITEM_PRICE = T.StructType(list(_PRICES))

ITEM = record(
    "appid int, baseName string, defindex int, id string, imageUrl string, marketName string, name string, "
    "originalId string, summary string, level int, slot string, paintSecondaryHex string, tradable boolean, "
    "craftable boolean, priceindex string, tag opaque, class texts",
    part("origin", record("id int, name string")),
    part("quality", record("id int, name string, color string")),
    part("price", ITEM_PRICE, arrayReadsAsNull=True),
    parts("equipped", record("class int, slot int")),
    # A counter's item repeats the whole item.  It is kept as text and checked one level down; a counter's
    # item within it is not looked at.
    parts(
        "strangeParts",
        record("score int", part("killEater", record("id int, name string", part("item", T.StringType(), opaque=True, checkedAs="item")))),
    ),
    parts("spells", record("id string, spellId string, name string, type string, defindex int, color string")),
    part("particle", record("id int, name string, shortName string, imageUrl string, type string")),
    part("style", record("name string")),
    part("paint", record("id int, name string, color string")),
)

CHECKED_TYPES = {"item": ITEM}

PAYLOAD = record(
    "id string, steamid string, appid int, tradeOffersPreferred boolean, buyoutOnly boolean, details string, "
    "listedAt bigint, bumpedAt bigint, intent string, count int, status string, source string",
    part("currencies", record("metal double, keys bigint")),
    part("value", record("raw double, short string, long string", *_PRICES)),
    part("item", ITEM),
    part("userAgent", record("client string, lastPulse bigint")),
    part(
        "user",
        record(
            "id string, name string, avatar string, avatarFull string, premium boolean, online boolean, "
            "banned boolean, customNameStyle string, style string, role opaque, tradeOfferUrl string, bans opaque"
        ),
    ),
)

LISTING_UPDATE = record("id string, event string, generation_timestamp bigint", part("payload", PAYLOAD))

# Fields of both envelopes besides `data`.
ENVELOPE = record("timestamp string, messageId string, source string")

REQUEST = record(
    "item_defindex int, item_quality_id int, request_type string, listing_id string, max_inventory_size int"
)

SNAPSHOT_LISTING = record(
    "steamid string, offers int, buyout int, details string, intent string, timestamp bigint, price double, bump bigint",
    part("item", record("defindex int, quality int, attributes opaque, quantity string")),
    part("currencies", record("keys bigint, metal double")),
    part("userAgent", record("lastPulse bigint, client string")),
)
SNAPSHOT = record("appid int, sku string, createdAt bigint", parts("listings", SNAPSHOT_LISTING))

INVENTORY_ITEM = record(
    "id bigint, original_id bigint, defindex int, level int, quality int, inventory bigint, quantity int, origin int, "
    "flag_cannot_trade boolean, flag_cannot_craft boolean",
    parts("attributes", record("defindex int, value string, float_value float")),
)
INVENTORY = T.StructType([part("result", record("status int", parts("items", INVENTORY_ITEM)))])

# Listings table: key first, then the fields an upsert replaces, then bookkeeping.
LISTING_FIELDS = record(
    "steamid string, item_defindex int, item_quality_id int, intent string, appid int, metal double, keys bigint, "
    "raw_value double, short_value string, long_value string, details string, listed_at bigint, market_name string, "
    "status string, user_agent_client string, user_name string, user_premium boolean, user_online boolean, "
    "user_banned boolean, user_trade_offer_url string, item_tradable boolean, item_craftable boolean, "
    "item_quality_color string, item_particle_name string, item_particle_type string, bumped_at bigint, "
    "spell_ids texts, strange_part_ids texts, paint_id int, paint_name string, paint_color string, "
    "paint_secondary_hex string"
)
LISTINGS = T.StructType(
    [
        *record("id string").fields,
        *LISTING_FIELDS.fields,
        *record("is_deleted boolean, created_at bigint, updated_at bigint").fields,
    ]
)

# Shape of a message as a log source delivers it.
RAW_MESSAGE = record(
    "key binary, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

REQUEST_TABLE = record(
    "request_id string, request_type string, item_defindex int, item_quality_id int, listing_id string, "
    "max_inventory_size int, generation_timestamp bigint"
)
