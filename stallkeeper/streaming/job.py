"""The running job: messages in, table changes out.

One query reads the feed and, if configured, the request topic, as one union.
Each micro-batch parses both, reconciles the requests it holds (and those that
still wait), and folds feed and reconciliation events together into one set of
changes.  Everything a batch writes is keyed by its id, so a batch replayed
after a failure leaves the same result: changes, rejects, changes that cannot
be written, counters, and of requests their outcomes and those that wait.

Requests may also run in a query of their own, so that the feed never waits for
them: see `streaming.requests.RequestJob`, whose events `Job.start` takes as a
second stream.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stallkeeper.functions.times import now_ms
from stallkeeper.operators import fold, parse, route
from stallkeeper.operators.requests import PARTS_BY_TYPE
from stallkeeper.plans import counters, reconcile
from stallkeeper.schemas import RAW_MESSAGE
from stallkeeper.session import stored
from stallkeeper.streaming.requests import MAX_ATTEMPTS, MAX_RUNS, Landed, Requests, event_column
from stallkeeper.streaming.table import ListingTable

# Fixed value: flush interval of the upserts.
DEFAULT_INTERVAL = "200 milliseconds"


@dataclass
class Job:
    """``request_topic`` and ``landed`` unset: the feed runs alone."""

    table: ListingTable
    request_topic: str | None = None
    landed: Landed | None = None
    options: reconcile.Options = field(default_factory=reconcile.Options)
    parts_by_type: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(PARTS_BY_TYPE))
    touched_at: Column | None = None  # write time of an event; the batch's time when unset
    compact_every: int | None = None
    max_attempts: int = MAX_ATTEMPTS  # of a request that cannot be reconciled
    max_runs: int = MAX_RUNS  # reconciliations in one batch, to tell such requests apart

    def start(
        self,
        messages: DataFrame,
        checkpoint: str,
        *,
        interval: str | None = DEFAULT_INTERVAL,
        name: str | None = None,
        events: DataFrame | None = None,
    ) -> StreamingQuery:
        """Start the query; without an interval it takes what is there and stops.

        ``events``: a stream of events that reconciliations elsewhere arrive at.
        """
        if events is not None:
            shaped = [F.lit(None).cast(RAW_MESSAGE[c].dataType).alias(c) for c in messages.columns]
            reconciled = events.select(*shaped, event_column(events))
            messages = messages.select("*", event_column()).unionByName(reconciled)
        writer = messages.writeStream.foreachBatch(self.run_batch).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch."""
        if self.compact_every and batch_id and batch_id % self.compact_every == 0:
            self.table.compact(before_batch=batch_id)
        from_elsewhere = None
        if "reconciled" in batch.columns:
            from_elsewhere = batch.where(F.col("reconciled").isNotNull()).select("reconciled.*")
            batch = batch.where(F.col("reconciled").isNull()).drop("reconciled")
        is_request = F.lit(False) if self.request_topic is None else F.col("topic") == self.request_topic
        parsed = parse.parse_listing_messages(batch.where(~is_request))
        # Parsed once; executors that are lost recompute from the source.
        parsed = counters.observed(parsed, f"feed_{batch_id}").persist()
        try:
            live = parse.listing_events(parsed)
            events = route.union_events(live, self._requested(batch.where(is_request), batch_id))
            if from_elsewhere is not None:
                events = route.union_events(events, from_elsewhere)
            moment = now_ms() if self.touched_at is None else self.touched_at
            self.table.append(fold.fold(fold.table_events(events, moment)), batch_id)
            self._write(parse.rejects(parsed), "rejects", batch_id)
            self._write(fold.unwritable(live), "unwritable", batch_id)
            self._write(counters.batch_counters(parsed, batch_id), "counters", batch_id)
        finally:
            parsed.unpersist()
            self.table.drop(self._path("steps", batch_id))

    def _requested(self, messages: DataFrame, batch_id: int) -> DataFrame | None:
        """Events of this batch's requests and of those that still wait."""
        if self.request_topic is None:
            return None
        requests = Requests(
            self.table, self.table.root, self.landed, self.options, self.parts_by_type, self.max_attempts, self.max_runs
        )
        return requests.run(messages, batch_id, before_batch=batch_id)

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.table.root}/{kind}/{batch_id:012d}"

    def _write(self, df: DataFrame, kind: str, batch_id: int) -> None:
        stored(df, self._path(kind, batch_id))
