"""Find secrets: known forms by pattern, and random-looking strings by two character Markov models.

One model is trained on labelled random strings (values found by the known forms, and digests made from
document ids), the other on ordinary identifiers of a bounded sample of documents.  A candidate string is
a secret if its mean log-likelihood ratio per character pair passes a limit.  DataFrame functions only:
texts are read once for the scan and never shuffled; of documents with findings, pieces are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeeper.session import Cut, table_cut

# The known forms.  Each is (kind, pattern, group that is measured, its least length).
FORMS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 4, 6),
    ("access", r"AKIA[A-Z0-9]+", 2, 20),
    ("hex", r"[0-9a-f]+", 2, 24),
]
RANDOM = "random"
# Strings that the models judge: this long at least, in characters of codes and identifiers.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
# Ordinary identifiers, the other labelled sample.
IDENTIFIER = r"(?<![A-Za-z0-9+/_-])[A-Za-z][A-Za-z_-]{5,}(?![A-Za-z0-9+/_-])"
# Most documents, about, whose identifiers and ids the models are trained on.
SAMPLE_DOCS = 5_000
# Least mean log-likelihood ratio of a character pair.
LIMIT = 0.5
# Weight of a character's overall chance in its chance after another.
BACK = 5.0
# Character codes that candidates are made of lie in this range.
FIRST, CODES = 43, 80

SPAN = "struct<start:int,kind:int,end:int>"


def _tiles(text: Column, kind: int, pattern: str, group: int, likely: str) -> Column:
    """Matches from left to right as (kind, at, gap before, size, size of the measured group).

    Each match is read together with the text before it, from where the last one ended, so the pieces tile
    the text and their lengths give the places.
    """
    whole = rf"(?s)\G(.*?)({pattern})"
    parts = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(whole), F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, F.lit(whole), F.lit(2)).alias("match"),
        F.regexp_extract_all(text, F.lit(whole), F.lit(group)).alias("measured"),
    )
    tiles = F.transform(
        parts,
        lambda p, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("at"),
            F.length(p["gap"]).alias("gap"),
            F.length(p["match"]).alias("size"),
            F.length(p["measured"]).alias("measured"),
            p["measured"].alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,at:int,gap:int,size:int,measured:int,value:string>>")
    return F.when(F.rlike(text, F.lit(likely)), tiles).otherwise(none)


def _found(rows: DataFrame) -> DataFrame:
    """(id, version, kind, start, end, value) of every match that is long enough."""
    text = F.col("text")
    # Only texts in which some match is long enough are taken apart.
    likely = [FORMS[0][1][:-2] + "{6,})", r"AKIA[A-Z0-9]{16,}", r"[0-9a-f]{24,}"]
    kinds = [_tiles(text, k, form[1], form[2], likely[k]) for k, form in enumerate(FORMS)]
    kinds.append(_tiles(text, len(FORMS), CANDIDATE, 2, CANDIDATE))
    least = F.element_at(F.array(*[F.lit(form[3]) for form in FORMS], F.lit(0)), F.col("kind") + 1)
    pieces = rows.select("id", "version", F.explode(F.flatten(F.array(*kinds))).alias("t")).select("id", "version", "t.*")
    before = Window.partitionBy("id", "version", "kind").orderBy("at")
    return (
        pieces.distinct()  # rows that repeat are taken apart once
        .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before).cast("int"))
        .where(F.col("measured") >= least)
        .select("id", "version", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "value")
    )


def _pairs(text: Column) -> Column:
    """The number of each pair of neighbouring characters."""
    codes = F.transform(F.split(text, ""), lambda c: F.ascii(c) - FIRST)
    n = F.greatest(F.size(codes) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, 1, n), F.slice(codes, 2, n), lambda a, b: a * CODES + b)


def log_ratios(secrets: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character pair under the two models, from columns named ``value``.

    Each model is the chance of a character after another, smoothed towards the character's chance after
    any; the table's size is fixed.
    """
    both = secrets.select(F.lit(0).alias("model"), "value").unionByName(ordinary.select(F.lit(1).alias("model"), "value"))
    counted = both.select("model", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("model", "pair").agg(F.count("*").alias("n"))
    counts = {(r["model"], r["pair"]): r["n"] for r in counted.collect()}
    chances = []
    for model in (0, 1):
        table = [[counts.get((model, a * CODES + b), 0) for b in range(CODES)] for a in range(CODES)]
        total = sum(map(sum, table))
        after = [(sum(row[b] for row in table) + 1) / (total + CODES) for b in range(CODES)]
        chances.append([(n + BACK * after[b]) / (sum(row) + BACK) for row in table for b, n in enumerate(row)])
    return [math.log(secret / word) for secret, word in zip(*chances, strict=True)]


def ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of a candidate's character pairs."""
    # A constant that the optimizer folds into one array.
    held = F.split(F.lit(",".join(f"{x:.4f}" for x in ratios)), ",").cast("array<double>")
    total = F.aggregate(_pairs(value), F.lit(0.0), lambda s, pair: s + F.get(held, pair))
    return total / F.greatest(F.length(value) - 1, F.lit(1))


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: float = LIMIT,
    sample_docs: int = SAMPLE_DOCS,
    cut: Cut | None = None,
) -> DataFrame:
    """(id, spans) of every row of ``docs``: array of (start, kind, end) in order, kinds numbered.

    Kinds 0, 1, 2 are ``assign``, ``access`` and ``hex``, leftmost and non-overlapping for each kind; 3 is
    ``random``, a string that the models take for a secret and that no other span overlaps.  Places are
    code points, the end exclusive.

    Null or empty text: no spans.  Null ids are carried; repeated rows get the same spans each; no rows give
    no rows; other columns of ``docs`` are not looked at.
    """
    cut = cut or table_cut(docs.sparkSession)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), text.alias("text")).withColumn("version", F.xxhash64("text"))
    found = cut(_found(rows), "secret_matches")

    total = docs.count()
    share = min(1.0, sample_docs / max(total, 1))
    sample = rows.where(F.pmod(F.xxhash64("version", "id"), F.lit(1 << 31)) < int(share * (1 << 31)))
    words = sample.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    digest = F.sha2(F.concat_ws(":", F.col("id").cast("string"), F.col("version").cast("string")), 256)
    made = sample.select(F.explode(F.array(digest, F.regexp_replace(F.base64(F.unhex(digest)), "=", ""))).alias("value"))
    known = found.where(F.col("kind") < len(FORMS)).select(F.regexp_replace("value", "[.=]", "").alias("value"))
    ratios = log_ratios(known.unionByName(made), words)

    judged = found.where((F.col("kind") < len(FORMS)) | (ratio(F.col("value"), ratios) >= limit))
    spans = judged.groupBy("id", "version").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < len(FORMS))
    kept = F.filter(
        "all",
        lambda s: (s["kind"] < len(FORMS)) | ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    spans = spans.select(F.col("id").alias("of"), F.col("version").alias("of_version"), kept.alias("spans"))
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version"))
    joined = rows.select("id", "version").join(spans, same, "left")
    return joined.select(F.col("id").alias(id_col), F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def spans_text(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(form[0]) for form in FORMS], F.lit(RANDOM))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
