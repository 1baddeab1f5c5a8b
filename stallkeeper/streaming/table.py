"""A listings table in a shared folder, fed by micro-batches.

A batch appends its folded changes under its own id: the cost is that of the
batch, not of the table, and a replayed batch overwrites what it wrote before.
Readers fold the outstanding changes and merge them with the last base.
:meth:`compact` merges them into a new base, named after the last batch it
holds.  Bases are bucketed by ``id``, so reading and compacting shuffle the
changes only, and sorted by item, so a read for few items leaves out row groups,
one for named listings whole buckets.  Spark's own ``_SUCCESS`` marker publishes
a write.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallkeeper.operators import fold, lookups, merge
from stallkeeper.schemas import LISTING_FIELDS, LISTINGS, record

_ORDER = record("ord_time bigint, ord_partition int, ord_offset bigint, ord_pos bigint")
CHANGES = (
    T.StructType()
    .add("batch", T.LongType())
    .add("id", T.StringType())
    .add("fields", LISTING_FIELDS)
    .add("update_order", _ORDER)
    .add("ends_live", T.BooleanType())
    .add("event_order", _ORDER)
    .add("first_update_at", T.LongType())
    .add("touched_at", T.LongType())
)


@dataclass(frozen=True)
class ListingTable:
    spark: SparkSession
    root: str
    buckets: int = 200

    def append(self, changes: DataFrame, batch_id: int) -> None:
        """Write one batch's folded changes; again is the same as once."""
        numbered = changes.withColumn("batch", F.lit(batch_id).cast("bigint"))
        numbered.select(*CHANGES.names).write.mode("overwrite").parquet(self._changes_path(batch_id))

    def read(self) -> DataFrame:
        """Current state."""
        return self.read_until(None)

    def read_for(self, requests: DataFrame, before_batch: int | None = None) -> DataFrame:
        """Rows that requests can look at, as `lookups.relevant_to` finds them; the base is read in part.

        Of the base are needed the rows of the items and those named, and rows that outstanding changes
        move to one of the items.
        """
        base, changes = self._parts(before_batch)
        if base is None or changes is None:
            return lookups.relevant_to(self._merged(base, changes), requests)
        items = requests.select(*lookups.ITEM_KEY).distinct().dropna()
        now_of = changes.select("id", *[F.col(f"fields.{c}") for c in lookups.ITEM_KEY])
        moved = now_of.join(items, list(lookups.ITEM_KEY), "left_semi").select(F.col("id").alias("listing_id"))
        names = requests.select("listing_id").unionByName(moved)
        wanted = requests.select(*lookups.ITEM_KEY).withColumn("listing_id", F.lit(None).cast("string"))
        none = [F.lit(None).cast("int").alias(c) for c in lookups.ITEM_KEY]
        wanted = wanted.unionByName(names.select(*none, "listing_id"))
        return lookups.relevant_to(self._merged(lookups.relevant_to(base, wanted), changes), requests)

    def read_until(self, before_batch: int | None) -> DataFrame:
        """State as it was before a batch; a base that is younger is an error."""
        return self._merged(*self._parts(before_batch))

    def _parts(self, before_batch: int | None) -> tuple[DataFrame | None, DataFrame | None]:
        """The base, and the folded changes after it."""
        base_id, base = self._base()
        if before_batch is not None and base_id >= before_batch:
            raise ValueError(f"the base holds batch {base_id} already, the state before {before_batch} is gone")
        changes = self.outstanding(base_id, before_batch)
        return base, None if changes is None else fold.refold(changes, "batch")

    def _merged(self, base: DataFrame | None, changes: DataFrame | None) -> DataFrame:
        if base is None:
            return merge.first_state(changes) if changes is not None else merge.empty_table(self.spark)
        return merge.merge(base, changes) if changes is not None else base

    def outstanding(self, base_id: int, before_batch: int | None = None) -> DataFrame | None:
        """Changes of published batches after a base."""
        batches = [
            b for b in self._published_batches() if b > base_id and (before_batch is None or b < before_batch)
        ]
        if not batches:
            return None
        return self.spark.read.schema(CHANGES).parquet(*[self._changes_path(b) for b in batches])

    def compact(self, before_batch: int | None = None) -> int:
        """Merge what is outstanding into a new base; returns its last batch.

        With ``before_batch`` only what earlier batches wrote: a batch that is
        replayed then still finds a base without its own changes.  Run it from the writing query, or while none is running.  Earlier bases
        and changes stay for readers that started on them.
        """
        base_id, base = self._base()
        pending = [
            b for b in self._published_batches() if b > base_id and (before_batch is None or b < before_batch)
        ]
        if not pending:
            return base_id
        last = max(pending)
        state = self.read_until(last + 1)
        if base is None:
            # One task per bucket, as a join with a bucketed base gives anyway.
            state = state.repartition(self.buckets, "id")
        (
            state.write.mode("overwrite")
            .format("parquet")
            .bucketBy(self.buckets, "id")
            .sortBy(*lookups.ITEM_KEY, "id")
            .option("path", f"{self.root}/base/{last:012d}-{self.buckets}")
            .saveAsTable(f"stallkeeper_base_{uuid.uuid4().hex}")
        )
        return last

    def _base(self) -> tuple[int, DataFrame | None]:
        """Last batch the newest base holds, and the base."""
        bases = self._published("base")
        if not bases:
            return -1, None
        newest = bases[-1]
        last, buckets = (int(part) for part in newest.split("-"))
        # The catalog entry only tells Spark the bucketing; there is one for each base.
        name = f"stallkeeper_base_{hashlib.md5(f'{self.root}/{newest}'.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LISTINGS.fields)
        self.spark.sql(
            f"create table if not exists {name} ({columns}) using parquet "
            f"clustered by (id) sorted by ({', '.join(lookups.ITEM_KEY)}, id) into {buckets} buckets location '{self.root}/base/{newest}'"
        )
        return last, self.spark.table(name)

    def _changes_path(self, batch_id: int) -> str:
        return f"{self.root}/changes/{batch_id:012d}"

    def _published(self, kind: str, root: str | None = None) -> list[str]:
        """Names of finished writes below the root, oldest first; one listing call."""
        fs, marks = self._file_system(f"{root or self.root}/{kind}/*/_SUCCESS")
        return sorted(status.getPath().getParent().getName() for status in fs.globStatus(marks) or [])

    def _published_batches(self) -> list[int]:
        return [int(name) for name in self._published("changes")]

    def last_before(self, kind: str, batch_id: int, root: str | None = None) -> str | None:
        """Folder that the nearest earlier batch has written, if any."""
        earlier = [name for name in self._published(kind, root) if int(name) < batch_id]
        return f"{root or self.root}/{kind}/{earlier[-1]}" if earlier else None

    def is_published(self, kind: str, batch_id: int, root: str | None = None) -> bool:
        """The batch has finished writing this."""
        fs, mark = self._file_system(f"{root or self.root}/{kind}/{batch_id:012d}/_SUCCESS")
        return fs.exists(mark)

    def make(self, path: str) -> None:
        """Create a folder."""
        fs, hadoop_path = self._file_system(path)
        fs.mkdirs(hadoop_path)

    def drop(self, path: str) -> None:
        """Delete scratch data below the root."""
        fs, hadoop_path = self._file_system(path)
        fs.delete(hadoop_path, True)

    def _file_system(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path
