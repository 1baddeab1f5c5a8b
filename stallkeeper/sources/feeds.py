"""Message sources: a Kafka topic, or files in the same shape.

The Kafka builders only assemble options; Spark's connector does the rest and
keeps offsets in the query's checkpoint.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeeper.schemas import RAW_MESSAGE

# How far back an unset start lies, the prefix of consumer
# settings given as environment variables, and the consumer defaults.
DEFAULT_START_MINUTES = 30
CONSUMER_PREFIX = "KAFKA_CONSUMER_"
CONSUMER_DEFAULTS = {
    "reconnect.backoff.ms": "1000",
    "reconnect.backoff.max.ms": "32000",
    "retry.backoff.ms": "1000",
    "request.timeout.ms": "30000",
    "connections.max.idle.ms": "300000",
    "session.timeout.ms": "30000",
    "heartbeat.interval.ms": "10000",
    "max.poll.interval.ms": "300000",
    "fetch.min.bytes": "1",
    "fetch.max.wait.ms": "500",
    "max.poll.records": "500",
}
# Settings Spark's source owns and refuses.
OWNED_BY_SPARK = (
    "auto.offset.reset",
    "enable.auto.commit",
    "auto.commit.interval.ms",
    "key.deserializer",
    "value.deserializer",
    "interceptor.classes",
    "bootstrap.servers",
    "group.id",
)
LATEST = "latest"
# Options that say when a batch of a stream starts and how much it takes.
TRIGGERS = ("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay")
# An upsert batch ends with so many messages or so much later, whichever is first.
BATCH_MESSAGES, BATCH_DELAY = 10, "200ms"


def consumer_properties(environment: Mapping[str, str]) -> dict[str, str]:
    """``KAFKA_CONSUMER_A_B=v`` becomes ``a.b=v``."""
    return {
        name[len(CONSUMER_PREFIX) :].lower().replace("_", "."): value
        for name, value in environment.items()
        if name.startswith(CONSUMER_PREFIX) and len(name) > len(CONSUMER_PREFIX)
    }


def kafka_options(
    brokers: str,
    topics: list[str],
    *,
    group: str | None = None,
    start: int | str | None = None,
    properties: Mapping[str, str] | None = None,
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
    max_trigger_delay: str | None = None,
    now_ms: int | None = None,
) -> tuple[dict[str, str], dict[str, str]]:
    """Reader options, and the given consumer properties Spark does not accept.

    ``start`` is ``"latest"``, epoch milliseconds, or unset for thirty minutes
    ago.  Given properties beat the defaults.  With ``min_offsets_per_trigger`` a
    batch starts as soon as so many messages are there, or ``max_trigger_delay``
    (:data:`BATCH_DELAY` when unset) after the last one; start the query with an
    interval of zero then.
    """
    if max_trigger_delay is not None and min_offsets_per_trigger is None:
        raise ValueError("max_trigger_delay needs min_offsets_per_trigger")
    for name, value in (("brokers", brokers), *(("topic", t) for t in topics or [""])):
        if not value or not value.strip():
            raise ValueError(f"{name} must be given")
    given = dict(properties or {})
    refused = {k: v for k, v in given.items() if k in OWNED_BY_SPARK}
    accepted = {**CONSUMER_DEFAULTS, **{k: v for k, v in given.items() if k not in refused}}
    options = {f"kafka.{k}": v for k, v in accepted.items()}
    options["kafka.bootstrap.servers"] = brokers.strip()
    options["subscribe"] = ",".join(t.strip() for t in topics)
    if group:
        options["kafka.group.id"] = group.strip()
    if start == LATEST:
        options["startingOffsets"] = LATEST
    else:
        moment = int(time.time() * 1000) if now_ms is None else now_ms
        options["startingTimestamp"] = str(
            moment - DEFAULT_START_MINUTES * 60_000 if start is None else int(start)
        )
        # A partition without a message that recent starts at its end.
        options["startingOffsetsByTimestampStrategy"] = "latest"
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_offsets_per_trigger is not None:
        options["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
        options["maxTriggerDelay"] = max_trigger_delay or BATCH_DELAY
    return options, refused


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages of the subscribed topics, with their place in the log."""
    reader = spark.readStream.format("kafka").options(**options)
    return in_message_shape(reader.load())


def kafka_batch(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """What the topics hold now, for a bounded run."""
    kept = {k: v for k, v in options.items() if k not in TRIGGERS and v != LATEST}
    return in_message_shape(spark.read.format("kafka").options(**kept).load())


def file_stream(
    spark: SparkSession, path: str, *, file_format: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages landed as files in the log's shape."""
    reader = spark.readStream.schema(RAW_MESSAGE).format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return in_message_shape(reader.load(path))


def file_batch(spark: SparkSession, path: str, *, file_format: str = "parquet") -> DataFrame:
    return in_message_shape(spark.read.schema(RAW_MESSAGE).format(file_format).load(path))


def since(messages: DataFrame, start_ms: int | Column) -> DataFrame:
    """Messages from a moment on; reaches the file scan as a filter."""
    moment = F.lit(start_ms) if isinstance(start_ms, int) else start_ms
    return messages.where(F.col("timestamp") >= F.timestamp_millis(moment))


def in_message_shape(df: DataFrame) -> DataFrame:
    return df.select("topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value"))
