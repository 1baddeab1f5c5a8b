"""From raw documents to encoded training text, in five stages.

Each stage works on all documents that the one before it kept.  Its result is written as Parquet in the
shared folder and read again, so every stage starts from a stored table and lost executors cost no more
than the stage at hand.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeeper import session
from stallkeeper.llm import bpe, decontamination, line_dedup, near_duplicates, quality

# Least quality score of a document that stays.
QUALITY_LINE = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality.scored(docs, quality.train(docs, labels))
    return scored.where(F.col("score") >= QUALITY_LINE).select("row.*")


def _with_texts(docs: DataFrame, row: str, text: Column) -> list[Column]:
    """The columns of ``docs`` from a struct, with another text; ``n_chars`` follows it."""
    changed = {"text": text, "n_chars": F.length(text)}
    return [changed.get(c, F.col(f"{row}.`{c}`")).cast(kind).alias(c) for c, kind in docs.dtypes]


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that another document with a smaller id holds."""
    rest = F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row")
    kept = line_dedup.drop_shared_lines(docs.select("doc_id", "text", rest))
    return kept.select(*_with_texts(docs, "row", F.col("text")))


def keep_one_of_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates; of rows that repeat, one."""
    found = near_duplicates.near_duplicates(docs).where("keeper").select("doc_id", "version")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("id"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("of_version"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("of_version") == F.col("version"))
    return rows.join(found, same, "left_semi").dropDuplicates(["id", "of_version"]).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items; passages of items are cut out of those that stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    kept = decontamination.contamination(docs, benchmark, clean=True).where(~F.col("contaminated"))
    return kept.select(*_with_texts(docs, "row", F.coalesce("cleaned", "row.text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's tokens, their number, and the text that they decode to."""
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_duplicates", keep_one_of_class),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

# A trained classifier and a tokenizer's merges are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, over the whole ``documents`` table."""
    session.configure(spark)
    folder = f"{session.shared_dir(spark)}/cuts/{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = session.stored(stage(spark, docs, sf_dir), f"{folder}/{name}")
        # The table before has served its purpose.
        if before:
            session.drop(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
