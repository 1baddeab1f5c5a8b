"""Scans of a listings table kept elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeeper.schemas import LISTINGS


def listings_from(spark: SparkSession, source: str, *, file_format: str | None = None, **options: str) -> DataFrame:
    """Listings from a catalog table, or from files when a format is given."""
    df = spark.read.format(file_format).options(**options).load(source) if file_format else spark.table(source)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in LISTINGS.fields])


# A number from 0 up for a listing's id, as PostgreSQL computes it.
ID_HASH = "(hashtext(id) & 2147483647)"


def hash_predicates(partitions: int, id_hash: str = ID_HASH) -> list[str]:
    """Conditions that split a table into parts of about the same size, whatever its values."""
    return [f"{id_hash} % {partitions} = {k}" for k in range(partitions)]


def listings_from_jdbc(
    spark: SparkSession, url: str, table: str, *, partitions: int = 1, id_hash: str = ID_HASH, **options: str
) -> DataFrame:
    """Listings from a database, read by as many tasks as ``partitions``, each a share of the ids' hashes.

    Filters and the column list are passed on to the database.
    """
    if partitions > 1:
        return spark.read.jdbc(url, table, predicates=hash_predicates(partitions, id_hash), properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
