"""Counts of what was read, written, fetched and reconciled, as rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.functions.ids import is_buy_id
from stallkeeper.operators.route import origin
from stallkeeper.plans.reconcile import Steps
from stallkeeper.schemas import DELETE_EVENT, UPDATE_EVENT
from stallkeeper.sources.landing import outcome


def event_measures() -> dict[str, Column]:
    """Named aggregates over parsed message rows; usable in a batch or in ``observe``."""
    event, stamp = F.col("update.event"), F.col("update.generation_timestamp")
    return {
        "messages_parsed_failed": F.count("reject_reason"),
        "incoming_events": F.count("update"),
        "listing_upserts": F.count_if(event == UPDATE_EVENT),
        "deleted_listings": F.count_if(event == DELETE_EVENT),
        "realtime_writes": F.count_if((event == UPDATE_EVENT) & (origin(stamp) == "realtime")),
    }


def observed(parsed: DataFrame, name: str = "feed") -> DataFrame:
    """Same rows, counted on the way, for whoever listens to the query's progress."""
    return parsed.observe(name, *[measure.alias(key) for key, measure in event_measures().items()])


def batch_counters(parsed: DataFrame, batch_id: int) -> DataFrame:
    """(batch, counter, value) rows of one micro-batch of the feed."""
    counted = _as_rows(parsed.agg(*[m.alias(k) for k, m in event_measures().items()]))
    return counted.select(F.lit(batch_id).cast("bigint").alias("batch"), "counter", "value")


def _as_rows(one_row: DataFrame) -> DataFrame:
    return one_row.unpivot([], one_row.columns, "counter", "value")


def feed_counters(raw: DataFrame, parsed: DataFrame) -> DataFrame:
    """(counter, value) rows of a batch of messages.

    Every message counts once as consumed, and once as parsed or failed.
    """
    consumed = raw.agg(F.count("*").alias("messages_consumed"))
    counted = parsed.agg(*[m.alias(k) for k, m in event_measures().items()])
    # Two rows made one: the messages are scanned for their number and parsed once.
    both = consumed.unionByName(counted, allowMissingColumns=True)
    counts = both.agg(*[F.max(c).alias(c) for c in both.columns])
    succeeded = F.col("messages_consumed") - F.col("messages_parsed_failed")
    return _as_rows(counts.withColumn("messages_parsed_success", succeeded))


def write_origins(events: DataFrame) -> DataFrame:
    """Writes per origin and kind."""
    return (
        events.where(F.col("event").isin(UPDATE_EVENT, DELETE_EVENT))
        .groupBy(origin(F.col("generation_timestamp")).alias("origin"), "event")
        .agg(F.count("*").alias("writes"))
    )


def request_counters(outcomes: DataFrame, refused_messages: DataFrame | None = None) -> DataFrame:
    """(counter, value) rows: requests consumed, processed, failed and pending."""
    measures = {
        "requests_consumed": F.count("*"),
        "requests_processed": F.count_if(F.col("status") == "processed"),
        "requests_failed": F.count_if(F.col("status") == "failed"),
        "requests_pending": F.count_if(F.col("status") == "pending"),
    }
    rows = _as_rows(outcomes.agg(*[m.alias(k) for k, m in measures.items()]))
    if refused_messages is not None:
        rows = rows.unionByName(_as_rows(refused_messages.agg(F.count("*").alias("request_messages_rejected"))))
    return rows


QUANTILES = {"median_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def request_times(outcomes: DataFrame, batch_id: int | None = None) -> DataFrame:
    """How long requests took, per type: ``batch, effective_type, requests, last_ms, last_at, times``.

    ``outcomes`` has ``took_ms`` (null while a request is pending) and ``finished_at``.  ``times`` is a
    sketch of fixed size that merges with those of other batches, see :func:`merged_times`; ``last_ms``
    is the time of the request that ended last.
    """
    ended = outcomes.where(F.col("took_ms").isNotNull() & (F.col("status") != "pending"))
    last = F.struct("finished_at", "request_id")
    return ended.groupBy("effective_type").agg(
        F.count("*").alias("requests"),
        F.max_by("took_ms", last).alias("last_ms"),
        F.max("finished_at").alias("last_at"),
        F.kll_sketch_agg_bigint("took_ms").alias("times"),
    ).select(F.lit(batch_id).cast("bigint").alias("batch"), "effective_type", "requests", "last_ms", "last_at", "times")


def merged_times(times: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Times of all batches together, from rows of :func:`request_times`: requests, the last time, quantiles."""
    merged = times.groupBy("effective_type").agg(
        F.sum("requests").alias("requests"),
        F.max_by("last_ms", F.struct("last_at", "batch")).alias("last_ms"),
        F.kll_merge_agg_bigint("times").alias("times"),
    )
    points = [
        F.kll_sketch_get_quantile_bigint("times", F.lit(q)).alias(name) for name, q in (quantiles or QUANTILES).items()
    ]
    return merged.select("effective_type", "requests", "last_ms", *points)


def fetch_outcomes(**landed: DataFrame) -> DataFrame:
    """Responses per endpoint and outcome; pass one landing table per endpoint."""
    rows = [
        df.select(F.lit(endpoint).alias("endpoint"), outcome(F.col("http_status")).alias("outcome"))
        for endpoint, df in landed.items()
    ]
    return reduce(DataFrame.unionByName, rows).groupBy("endpoint", "outcome").agg(F.count("*").alias("responses"))


def handler_counters(steps: Steps, reconciled: DataFrame) -> DataFrame:
    """Per request type: requests, scans, skipped sellers, ids built, stale and updated listings."""
    kinds = steps.verdicts.select("request_id", "effective_type")
    per_request = [
        kinds.select("request_id", F.lit("requests").alias("counter")),
        steps.scans.select("request_id", F.lit("inventory_scans").alias("counter")),
        steps.scans.where(F.col("skip_reason") == "inventory_size").select(
            "request_id", F.lit("sellers_filtered").alias("counter")
        ),
        steps.answered.where((F.col("part") == "buy") & is_buy_id(F.col("listing_id"))).select(
            "request_id", F.lit("ids_generated").alias("counter")
        ),
        reconciled.select(
            "request_id",
            F.when(F.col("event") == DELETE_EVENT, "stale_detected").otherwise("listings_updated").alias("counter"),
        ),
    ]
    counted = reduce(DataFrame.unionByName, per_request).groupBy("request_id", "counter").count()
    return (
        counted.join(kinds, "request_id")
        .groupBy("effective_type", "counter")
        .agg(F.sum("count").alias("value"))
    )
