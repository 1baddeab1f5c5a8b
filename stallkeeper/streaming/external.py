"""Writing changes to a database outside Spark.

Spark's JDBC writer only appends, so a keyed upsert goes through any DB-API
connection a partition can open.  Rows are grouped and sorted by key, so that
no two tasks touch one key and locks are taken in one order; each batch is one
transaction.  A failed task is run again by Spark, and the statements are
idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row

from stallkeeper.schemas import LISTING_FIELDS

# Rows per transaction.
DEFAULT_BATCH = 10

FIELD_NAMES = [f.name for f in LISTING_FIELDS.fields]


def upsert_sql(table: str, mark: str = "%s") -> str:
    """Insert, or replace all fields and revive."""
    columns = ["id", *FIELD_NAMES, "is_deleted"]
    values = ", ".join([mark] * (len(columns) - 1) + ["false"])
    replaced = ", ".join(f"{c} = excluded.{c}" for c in columns[1:])
    return f"insert into {table} ({', '.join(columns)}) values ({values}) on conflict (id) do update set {replaced}"


def delete_sql(table: str, mark: str = "%s") -> str:
    """Mark as deleted; an unknown key changes nothing."""
    return f"update {table} set is_deleted = true where id = {mark}"


def _chunks(rows: Iterable[Row], size: int) -> Iterator[list[Row]]:
    iterator = iter(rows)
    while chunk := list(islice(iterator, size)):
        yield chunk


def write_changes(
    changes: DataFrame,
    connect: Callable[[], object],
    table: str,
    *,
    batch_size: int = DEFAULT_BATCH,
    mark: str = "%s",
    writers: int | None = None,
) -> None:
    """Apply folded changes: upserts first, then the deletes that end a listing.

    ``writers`` bounds the tasks, and with them the connections; unset, there
    are as many as shuffle partitions.
    """
    upsert, delete = upsert_sql(table, mark), delete_sql(table, mark)

    def write_partition(rows: Iterator[Row]) -> None:
        connection = connect()
        try:
            for chunk in _chunks(rows, batch_size):
                updated = [(r["id"], *r["fields"]) for r in chunk if r["fields"] is not None]
                deleted = [(r["id"],) for r in chunk if not r["ends_live"]]
                try:
                    cursor = connection.cursor()
                    if updated:
                        cursor.executemany(upsert, updated)
                    if deleted:
                        cursor.executemany(delete, deleted)
                    connection.commit()
                except Exception:
                    connection.rollback()
                    raise
        finally:
            connection.close()

    rows = changes.select("id", "fields", "ends_live")
    keyed = rows.repartition("id") if writers is None else rows.repartition(writers, "id")
    keyed.sortWithinPartitions("id").foreachPartition(write_partition)
