"""What has been answered, kept up to date as responses land.

Each micro-batch of an endpoint reads its own bodies once and leaves one narrow row per response below its
own id, so a replayed batch overwrites what it wrote.  Reading folds those rows; no body is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stallkeeper.sources import landing

# Argument of `landing.response_states` for each endpoint.
ENDPOINTS = {"snapshot": "snapshots", "inventory": "inventory", "detail": "detail"}


def write_states(batch: DataFrame, endpoint: str, root: str, batch_id: int) -> None:
    """States of one batch of newly landed responses; again is the same as once."""
    states = landing.response_states(**{ENDPOINTS[endpoint]: batch})
    states.write.mode("overwrite").parquet(f"{root}/{endpoint}/{batch_id:012d}")


def start_states(
    landed: DataFrame, endpoint: str, root: str, checkpoint: str, *, interval: str | None = None
) -> StreamingQuery:
    """Follow a stream of landed responses; without an interval it takes what is there and stops."""
    writer = landed.writeStream.foreachBatch(lambda batch, batch_id: write_states(batch, endpoint, root, batch_id))
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def read_states(spark: SparkSession, root: str) -> DataFrame:
    """The newest state per (endpoint, key, page) of all batches so far."""
    return landing.fold_states(spark.read.schema(landing.STATES).parquet(f"{root}/*/*"))
