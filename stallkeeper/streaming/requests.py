"""Requests of a running job: reconciled together, failing alone.

:class:`Requests` takes the request messages of a batch and those that still wait, and reconciles them as
one plan.  Where that fails, halves of them are tried, down to the one request that cannot be reconciled;
the others are answered.  A request that fails is tried again with later batches, so many times, before
it has failed for good; an error that no request can be told to cause counts against none.  What a batch
leaves (``outcomes``, ``waiting``, ``request_rejects``, ``request_times``) is keyed by its id.

:class:`RequestJob` runs requests in a streaming query of their own, with a start and checkpoint of its own.
It does not write the table: the events it arrives at are files that the feed's query reads as a second
stream, so the table has one writer, and the feed goes on while a reconciliation takes its time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stallkeeper.functions.times import now_ms
from stallkeeper.operators import parse
from stallkeeper.operators.requests import PARTS_BY_TYPE
from stallkeeper.plans import counters, reconcile
from stallkeeper.schemas import LISTING_UPDATE, REQUEST_TABLE, REQUEST_TYPES, record
from stallkeeper.session import Cut, stored, table_cut
from stallkeeper.streaming.table import ListingTable

# Reads the landed responses: (snapshots, inventories, details), raw or as
# `sources.landing` gives them.
Landed = Callable[[SparkSession], tuple[DataFrame, DataFrame, DataFrame]]

# A request that waits, how often it has failed, and the last error.
WAITING = T.StructType([*REQUEST_TABLE.fields, *record("attempts int, last_error string").fields])

# Events as `reconcile.ordered_events` gives them.
EVENTS = T.StructType(
    [
        *record("ord_time bigint, ord_partition int, ord_offset bigint, ord_pos bigint").fields,
        *[LISTING_UPDATE[name] for name in ("id", "event", "payload", "generation_timestamp")],
    ]
)

MAX_ATTEMPTS = 5
# Reconciliations that one batch may try before it leaves the rest for the next.
MAX_RUNS = 32
# Requests are told apart by a hash of so many bits.
HASH_BITS = 31
ERROR_CHARS = 2000


@dataclass(frozen=True)
class Answered:
    """What one reconciliation leads to; its parts are stored."""

    outcomes: DataFrame
    waiting: DataFrame
    events: DataFrame


@dataclass
class Requests:
    """``landed`` unset: requests wait.  Everything is written below ``root``."""

    table: ListingTable
    root: str
    landed: Landed | None = None
    options: reconcile.Options = field(default_factory=reconcile.Options)
    parts_by_type: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(PARTS_BY_TYPE))
    max_attempts: int = MAX_ATTEMPTS
    max_runs: int = MAX_RUNS

    def run(self, messages: DataFrame, batch_id: int, before_batch: int | None = None) -> DataFrame | None:
        """Events of this batch's requests and of those that still wait; none if there are none.

        ``before_batch``: the table is read as it was before that batch, else as it is.
        """
        cut = table_cut(self.table.spark, self.path("steps", batch_id))
        types = tuple(t for t in self.parts_by_type if t not in REQUEST_TYPES)
        parsed = parse.parse_request_messages(messages, types)
        self._write(parse.rejects(parsed), "request_rejects", batch_id)
        fresh = parse.requests(parsed).withColumn("generation_timestamp", F.col("requested_at"))
        fresh = fresh.select(*REQUEST_TABLE.names, F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("last_error"))
        requests = cut(fresh.unionByName(self._waiting(batch_id)), "requests")
        if self.landed is None or requests.isEmpty():
            self._write(requests, "waiting", batch_id)
            return None
        try:
            responses = self.landed(self.table.spark)
        except Exception as error:
            # Not the fault of any request: all wait, and nothing counts against them.
            waiting = _marked(requests, error, counts=False)
            self._write(reconcile.pending_outcomes(waiting, "last_error"), "outcomes", batch_id)
            self._write(waiting, "waiting", batch_id)
            return None
        return self._isolated(requests, responses, batch_id, before_batch)

    def _isolated(
        self, requests: DataFrame, responses: tuple[DataFrame, ...], batch_id: int, before_batch: int | None
    ) -> DataFrame | None:
        """Reconcile all; where that fails, halves by the requests' hashes, until a failing part is one request."""
        hashed = F.xxhash64("request_id").bitwiseAND((1 << HASH_BITS) - 1)
        done: list[Answered] = []
        alone: list[tuple[DataFrame, Exception]] = []
        left: list[tuple[DataFrame, Exception | None]] = []
        # Parts to look at: hashes from and to, and the error that all of it has failed with already.
        parts: list[tuple[int, int, Exception | None]] = [(0, 1 << HASH_BITS, None)]
        runs = 0
        while parts:
            low, high, error = parts.pop()
            part = requests.where(hashed.between(low, high - 1))
            if part.isEmpty():
                continue
            if error is None and runs == self.max_runs:
                left.append((part, None))
                continue
            if error is None:
                runs += 1
                try:
                    cut = table_cut(self.table.spark, self.path(f"steps/{batch_id:012d}/run_{runs}"))
                    done.append(self._reconciled(part, responses, before_batch, cut))
                    continue
                except Exception as raised:
                    error = raised
            if high - low == 1 or part.limit(2).count() == 1:
                alone.append((part, error))
                continue
            middle = (low + high) // 2
            halves = [(low, middle), (middle, high)]
            both = [not requests.where(hashed.between(a, b - 1)).isEmpty() for a, b in halves]
            # A half that holds all of it has failed just now.
            parts += [(a, b, None if all(both) else error) for a, b in halves]
        return self._settled(done, alone, left, batch_id, was_alone=runs == 1)

    def _settled(self, done, alone, left, batch_id: int, was_alone: bool) -> DataFrame | None:
        # Where nothing at all succeeded, the requests are not to blame, but for one that ran by itself.
        counts = bool(done) or was_alone
        failed = [_marked(part, error, counts) for part, error in alone]
        waiting = [a.waiting for a in done] + [_marked(part, error, False) for part, error in left]
        outcomes = [a.outcomes for a in done] + [reconcile.pending_outcomes(w, "last_error") for w in waiting[len(done) :]]
        for part in failed:
            ends = F.col("attempts") >= self.max_attempts
            waiting.append(part.where(~ends))
            outcomes.append(reconcile.pending_outcomes(part.where(~ends), "last_error"))
            outcomes.append(reconcile.failed_outcomes(part.where(ends), F.col("last_error")))
        ended = stored(reduce(DataFrame.unionByName, outcomes), self.path("outcomes", batch_id))
        self._write(counters.request_times(ended, batch_id), "request_times", batch_id)
        self._write(reduce(DataFrame.unionByName, waiting), "waiting", batch_id)
        return reduce(DataFrame.unionByName, [a.events for a in done]) if done else None

    def _reconciled(self, requests: DataFrame, responses: tuple[DataFrame, ...], before_batch: int | None, cut: Cut) -> Answered:
        listings = cut(self.table.read_for(requests, before_batch), "listings")
        snapshots, inventories, details = responses
        market = reconcile.Market(listings, snapshots, details, inventories)
        asked, members = reconcile.shared_work(requests.select(*REQUEST_TABLE.names), self.options)
        asked, members = cut(asked, "asked"), cut(members, "members")
        steps = reconcile.prepare(asked, market, self.options, self.parts_by_type, cut)
        events = cut(reconcile.events(steps, listings), "events")
        outcomes = cut(reconcile.outcomes(steps, events, now_ms(), members), "outcomes")
        pending = outcomes.where(F.col("status") == "pending").select("request_id")
        waiting = cut(requests.join(pending, "request_id", "left_semi").select(*WAITING.names), "waiting")
        written = reconcile.for_every_request(events, reconcile.newest_of(members))
        return Answered(outcomes, waiting, reconcile.ordered_events(written))

    def _waiting(self, batch_id: int) -> DataFrame:
        """Requests that were still open after the last batch that looked at requests."""
        spark, path = self.table.spark, self.table.last_before("waiting", batch_id, self.root)
        if path is None:
            return spark.createDataFrame([], WAITING)
        waiting = spark.read.schema(WAITING).parquet(path)
        return waiting.withColumn("attempts", F.coalesce("attempts", F.lit(0)))

    def path(self, kind: str, batch_id: int | None = None) -> str:
        return f"{self.root}/{kind}" if batch_id is None else f"{self.root}/{kind}/{batch_id:012d}"

    def _write(self, df: DataFrame, kind: str, batch_id: int) -> None:
        stored(df, self.path(kind, batch_id))


def _marked(requests: DataFrame, error: Exception | None, counts: bool) -> DataFrame:
    """The requests with the error noted, and one attempt more where it counts."""
    text = F.col("last_error") if error is None else F.lit(f"{type(error).__name__}: {error}"[:ERROR_CHARS])
    return requests.select(
        *REQUEST_TABLE.names, (F.col("attempts") + int(counts)).cast("int").alias("attempts"), text.alias("last_error")
    )


@dataclass
class RequestJob:
    """Requests in a query of their own; the feed's query reads ``events`` (see ``Job.start``)."""

    table: ListingTable
    landed: Landed | None = None
    options: reconcile.Options = field(default_factory=reconcile.Options)
    parts_by_type: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(PARTS_BY_TYPE))
    max_attempts: int = MAX_ATTEMPTS
    max_runs: int = MAX_RUNS

    @property
    def root(self) -> str:
        return f"{self.table.root}/requests"

    def start(self, messages: DataFrame, checkpoint: str, *, interval: str | None = "1 second", name: str | None = None) -> StreamingQuery:
        """Start the query; without an interval it takes what is there and stops."""
        writer = messages.writeStream.foreachBatch(self.run_batch).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Reconcile one batch and publish its events, once: a batch that is replayed after that does nothing."""
        if self.table.is_published("events", batch_id, self.root):
            return
        requests = Requests(
            self.table, self.root, self.landed, self.options, self.parts_by_type, self.max_attempts, self.max_runs
        )
        try:
            events = requests.run(batch, batch_id)
            if events is None:
                events = self.table.spark.createDataFrame([], EVENTS)
            # One task's files appear together or not at all, and the marker after the last.
            stored(events.select(*EVENTS.names), requests.path("events", batch_id))
        finally:
            self.table.drop(requests.path("steps", batch_id))

    def events(self, spark: SparkSession) -> DataFrame:
        """The stream of events that this query's batches publish."""
        # A stream needs its folder to be there.
        self.table.make(f"{self.root}/events/none")
        return spark.readStream.schema(EVENTS).parquet(f"{self.root}/events/*")


def event_column(events: DataFrame | None = None) -> Column:
    """Events as one column, to be unioned with messages; null for the messages themselves."""
    held = F.struct(*EVENTS.names) if events is not None else F.lit(None)
    return held.cast(EVENTS).alias("reconciled")
