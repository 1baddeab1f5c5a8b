"""Messages to events and requests, with the unusable ones kept apart.

Both parsers are one pass over the messages without a shuffle.  They return one
row per event (or request) and one row per rejected message; the two are told
apart by ``reject_reason``, so a caller that needs both sides reads the source
once.  ``reject_reason`` depends on the generator's output on purpose: a filter
on it then stays above the generator and the JSON is not read a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeeper.functions import wire
from stallkeeper.functions.text import nonblank, preview
from stallkeeper.functions.wire import Reader
from stallkeeper.schemas import (
    ENVELOPE,
    ITEM_PRICE,
    LISTING_UPDATE,
    PRICE,
    REQUEST,
    REQUEST_TYPES,
    part,
)

_FEED = Reader(T.StructType([*ENVELOPE.fields, part("data", T.ArrayType(LISTING_UPDATE))]))
_REQUESTS = Reader(T.StructType([*ENVELOPE.fields, part("data", REQUEST)]))

SOURCE_COLUMNS = ("topic", "partition", "offset", "timestamp")


def _coordinates(raw: DataFrame) -> list[str]:
    return [c for c in SOURCE_COLUMNS if c in raw.columns]


def _read(raw: DataFrame, coordinates: list[str], reader: Reader) -> DataFrame:
    text = raw.select(*coordinates, F.col("value").cast("string").alias("value"))
    return reader.read(text, "value", "document")


def _envelope_reason() -> Column:
    """Reject reason from the envelope alone; null when it is sound."""
    value, variant, fit = F.col("value"), F.col("document_variant"), F.col("document_fit")
    bad_envelope = F.expr(wire.misfit("document_variant", ENVELOPE))
    return F.when(
        fit == wire.BAD,
        F.when(bad_envelope, "bad_envelope_field").when(~F.expr(wire.present("document_variant", "$.data")), "no_data"),
    ).otherwise(
        F.when(fit.isNotNull(), F.when(F.col("document.data").isNull(), "no_data"))
        .when(value.isNull(), "no_value")
        .when(~nonblank(value), "blank")
        .when(variant.isNull(), "malformed_json")
        .when(F.is_variant_null(variant), "null_document")
        .otherwise("not_an_object")
    )


def _is_list(path: str) -> Column:
    return F.expr(f"schema_of_variant(try_variant_get(document_variant, '{path}', 'variant')) like 'ARRAY%'")


def _exploded(checked: DataFrame, coordinates: list[str], items: str, item: str) -> DataFrame:
    rows = checked.select(
        *coordinates, "value", "reason", F.posexplode_outer(F.when(F.col("reason").isNull(), F.col(items))).alias("pos", item)
    )
    reason = F.when(F.col("pos").isNull(), F.col("reason"))
    return rows.select(
        *coordinates,
        "pos",
        item,
        reason.alias("reject_reason"),
        F.when(reason.isNotNull(), preview(F.col("value"))).alias("reject_preview"),
        F.when(reason.isNotNull(), F.col("value")).alias("reject_value"),
    ).where(F.col(item).isNotNull() | F.col("reject_reason").isNotNull())


def parse_listing_messages(raw: DataFrame) -> DataFrame:
    """Rows ``coordinates, pos, update, reject_reason, reject_preview, reject_value``.

    An event has ``update`` set; a null array element yields nothing; a message
    with any unreadable part yields one reject row and no event.
    """
    coordinates = _coordinates(raw)
    read = _read(raw, coordinates, _FEED)
    data_reason = F.when(F.col("document_fit") == wire.BAD, F.when(_is_list("$.data"), "bad_field").otherwise("data_not_an_array"))
    checked = read.withColumn("reason", F.coalesce(_envelope_reason(), data_reason)).withColumn(
        "updates", F.col("document.data")
    )
    return _exploded(checked, coordinates, "updates", "update")


def listing_events(parsed: DataFrame) -> DataFrame:
    """Events in source order terms: ``ord_*`` places an event among all others."""
    kept = parsed.where(F.col("update").isNotNull())
    return kept.select(*source_order(), "update.*")


def source_order() -> list[Column]:
    """Arrival order columns of a parsed message row."""
    return [
        F.unix_millis("timestamp").alias("ord_time"),
        F.col("partition").cast("int").alias("ord_partition"),
        F.col("offset").cast("bigint").alias("ord_offset"),
        F.col("pos").cast("bigint").alias("ord_pos"),
    ]


def rejects(parsed: DataFrame) -> DataFrame:
    """Rejected messages with their reason, a printable preview and the whole text, to be replayed."""
    return parsed.where(F.col("reject_reason").isNotNull()).select(
        *_coordinates(parsed), "reject_reason", "reject_preview", "reject_value"
    )


def parse_request_messages(raw: DataFrame, added_types: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``coordinates, pos, request, reject_reason, reject_preview, reject_value``.

    ``added_types``: names of request types besides the built-in ones.
    """
    coordinates = _coordinates(raw)
    read = _read(raw, coordinates, _REQUESTS)
    data, fit = F.col("document.data"), F.col("document_fit")
    kind = request_type(data["request_type"], added_types)
    data_reason = (
        F.when(fit == wire.BAD, "bad_field")
        .when(data["request_type"].isNotNull() & kind.isNull(), "unknown_request_type")
        .when(data["item_defindex"] <= 0, "item_defindex_not_positive")
        .when(data["item_quality_id"] <= 0, "item_quality_id_not_positive")
    )
    checked = read.select(
        "*",
        F.array(data.withField("request_type", kind)).alias("requests"),
        F.coalesce(_envelope_reason(), data_reason).alias("reason"),
    )
    return _exploded(checked, coordinates, "requests", "request")


def request_type(given: Column, added_types: tuple[str, ...] = ()) -> Column:
    """Known type by its name, a built-in one also by its ordinal; null otherwise."""
    by_ordinal = F.element_at(
        F.array(*[F.lit(t) for t in REQUEST_TYPES]),
        F.when(given.rlike("^[0-3]$"), given.cast("int") + 1),
    )
    return F.when(given.isin(*REQUEST_TYPES, *added_types), given).when(given.rlike("^[0-3]$"), by_ordinal)


def requests(parsed: DataFrame) -> DataFrame:
    """Accepted requests, identified by where they were read."""
    kept = parsed.where(F.col("request").isNotNull())
    return kept.select(
        F.concat_ws("-", "topic", F.col("partition").cast("string"), F.col("offset").cast("string")).alias(
            "request_id"
        ),
        F.unix_millis("timestamp").alias("requested_at"),
        "request.*",
    )


def item_price(document: Column, path: str) -> Column:
    """Price object at ``path``; an array in its place reads as null."""
    return wire.read(document, path, ITEM_PRICE)


def price_list(document: Column, path: str) -> Column:
    """Prices at ``path`` as a list: an array as it is, an object alone, anything else empty."""
    one = wire.read(document, path, PRICE)
    return F.coalesce(
        wire.read(document, path, T.ArrayType(PRICE)),
        F.when(one.isNotNull(), F.array(one)),
        F.array().cast(T.ArrayType(PRICE)),
    )


def to_json(value: Column) -> Column:
    """JSON text of a parsed event, payload or request."""
    return F.to_json(value)
