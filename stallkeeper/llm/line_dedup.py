"""Drop lines that several documents share, keeping them in one document.

Each line becomes a 128-bit hash of its normalised form.  One aggregation, combined before its
shuffle, finds the hashes held by several documents, so a line of a third of all documents arrives
as one row per map task.  Only those hashes meet the lines again; only positions to drop meet the
documents again.  Documents are shuffled once, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import lower_ascii
from stallkeeper.session import Cut, table_cut

# What is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """Normalised form under which lines are the same."""
    return F.btrim(lower_ascii(line), F.lit(BLANKS))


def lines_of(text: Column) -> Column:
    """Lines of a text; null and empty are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 10,
    min_docs: int = 2,
    cut: Cut | None = None,
) -> DataFrame:
    """All columns of ``docs`` with shared lines cut out of the text, and ``n_lines``, ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs`` documents loses all its
    lines except those of the smallest document id that holds it.  Columns of ``docs`` named
    ``n_lines`` or ``n_dropped`` are replaced.

    - Null text: one empty line, text becomes empty; an empty text stays.
    - Null id: the row passes through and its lines count nowhere.
    - Rows with the same id are one document; each is rewritten by itself.
    - No rows: no rows.
    """
    cut = cut or table_cut(docs.sparkSession)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    doc, text = F.col("row").getField(id_col), F.coalesce(F.col("row").getField(text_col), F.lit(""))
    marked = rows.select("row", doc.alias("doc"), F.xxhash64(text).alias("version"), lines_of(text).alias("lines"))

    lines = marked.where("doc is not null").select("doc", "version", F.posexplode("lines").alias("at", "line"))
    keys = lines.select("doc", "version", "at", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    hashed = keys.select("doc", "version", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))

    # Several documents hold a key just when its smallest and largest id differ.
    shared = F.min("doc") < F.max("doc") if min_docs == 2 else F.count_distinct("doc") >= min_docs
    repeated = hashed.groupBy("h1", "h2").agg(F.min("doc").alias("holder"), shared.alias("shared"))
    repeated = cut(repeated.where("shared").drop("shared"), "repeated_lines")

    drops = (
        hashed.join(repeated, ["h1", "h2"])
        .where("doc <> holder")
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_set("at")).alias("drops"))
    )
    # What stays lies between one dropped position and the next.
    kept = F.expr(
        """flatten(transform(sequence(0, size(drops)), i -> slice(lines,
               if(i = 0, 0, drops[i - 1] + 1) + 1,
               if(i = size(drops), size(lines), drops[i]) - if(i = 0, 0, drops[i - 1] + 1))))"""
    )
    joined = marked.join(drops, ["doc", "version"], "left").select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(kept, "\n")).alias("kept"),
    )
    columns = [
        F.col("kept" if c == text_col else f"row.`{c}`").alias(c)
        for c in docs.columns
        if c not in ("n_lines", "n_dropped")
    ]
    return joined.select(*columns, "n_lines", "n_dropped")
