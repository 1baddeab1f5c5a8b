"""Document fingerprints as invertible Bloom lookup sketches of paragraph digests.

A text is cut into pieces at line and clause ends; the digests of its pieces are summed into a few cells.
The cells of two versions subtract: pieces that both hold cancel out, and peeling cells with one digest
left recovers the rest.  If peeling stops early, the pair is tried again with twice the cells.  Sketches
of many documents are built, subtracted and peeled in the same array operations.

Documents are compared with the next one in descending id.  They are shuffled once, by ranges of the id
cut at its quantiles; each range also receives the first document of the following range, so no
task sees more than a range and no order over all documents is needed.
"""

from __future__ import annotations

import base64
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import slices

# Cells of the smallest sketch, which is the fingerprint; each digest is added to one cell of each third.
CELLS = 24
HASHES = 3
# Cells for each digest of a pair beyond which larger sketches are not tried.
HOPELESS = 8
BYTES_AT_ONCE = 1_000_000
# Documents of one id range, and most ranges.
RANGE_ROWS = 2_000
RANGES = 20_000

# Pieces end with a line or clause end; a stretch without one is cut after 200 characters.
PIECE = re.compile(r"[^\n.!?;,|]{1,200}[\n.!?;,| ]*|[\n.!?;,|]+")
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def digests(text: str) -> list[int]:
    """Distinct 64-bit digests of a text's pieces; a repeated piece counts once more under a digest of its own."""
    pieces = PIECE.findall(text)
    digest = xxhash.xxh3_64_intdigest
    if len(set(pieces)) == len(pieces):
        return [digest(p) for p in pieces]
    seen: dict[str, int] = {}
    out = []
    for piece in pieces:
        seen[piece] = count = seen.get(piece, -1) + 1
        # Not the count as a seed: short pieces with seeds that differ a little can have equal digests.
        out.append((digest(piece) + count * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return out


def _check(keys: np.ndarray) -> np.ndarray:
    mixed = (keys ^ (keys >> np.uint64(29))) * MIX[3]
    return (mixed ^ (mixed >> np.uint64(32))) & np.uint64(0xFFFFFFFF)


def _cells(keys: np.ndarray, third: int) -> np.ndarray:
    """The cells of each digest, one row for each third of the sketch."""
    mixed = [((keys * m) ^ (keys >> np.uint64(31))) * m >> np.uint64(33) for m in MIX[:HASHES]]
    return np.stack([(x % np.uint64(third)).astype(np.int64) + k * third for k, x in enumerate(mixed)])


class Sketches:
    """Sketches of several sets of digests, one in each row."""

    def __init__(self, sets: list[np.ndarray], cells: int):
        shape = len(sets), cells
        self.counts = np.zeros(shape, np.int64)
        self.keys, self.checks = np.zeros(shape, np.uint64), np.zeros(shape, np.uint64)
        self.third = cells // HASHES
        if sets:
            rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            self._add(rows, np.concatenate(sets), np.ones(len(rows), np.int64))

    def _add(self, rows: np.ndarray, keys: np.ndarray, signs: np.ndarray) -> None:
        checks = _check(keys)
        for cells in _cells(keys, self.third):
            np.add.at(self.counts, (rows, cells), signs)
            np.bitwise_xor.at(self.keys, (rows, cells), keys)
            np.bitwise_xor.at(self.checks, (rows, cells), checks)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches([], 0)
        out.counts, out.third = self.counts - other.counts, self.third
        out.keys, out.checks = self.keys ^ other.keys, self.checks ^ other.checks
        return out

    def peel(self) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Which rows peel down to nothing, and the (rows, digests, signs) recovered in each round."""
        rounds = []
        active = np.arange(len(self.counts))
        while len(active):
            single = (np.abs(self.counts[active]) == 1) & (self.checks[active] == _check(self.keys[active]))
            at, cells = np.nonzero(single)
            rows = active[at]
            if not len(rows):
                break
            keys, signs = self.keys[rows, cells], self.counts[rows, cells]
            order = np.lexsort((keys, rows))
            rows, keys, signs = rows[order], keys[order], signs[order]
            new = np.r_[True, (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])]
            rows, keys, signs = rows[new], keys[new], signs[new]
            self._add(rows, keys, -signs)
            rounds.append((rows, keys, signs))
            active = np.unique(rows)
        empty = (self.counts == 0) & (self.keys == 0) & (self.checks == 0)
        return empty.all(axis=1), rounds

    def texts(self, sizes: list[int]) -> list[str]:
        """Each sketch as text: the number of digests, then the cells."""
        packed = np.zeros(self.counts.shape, np.dtype([("n", "<i4"), ("key", "<u8"), ("check", "<u4")]))
        packed["n"], packed["key"], packed["check"] = self.counts, self.keys, self.checks
        return [f"{size}:{base64.b64encode(row.tobytes()).decode()}" for size, row in zip(sizes, packed, strict=True)]


def differing(old: list[np.ndarray], new: list[np.ndarray]) -> np.ndarray:
    """How many digests of each pair only one of the two holds, from subtracted and peeled sketches."""
    out = np.zeros(len(old), np.int64)
    sizes = np.array([[len(a), len(b)] for a, b in zip(old, new, strict=True)], np.int64).reshape(-1, 2)
    # Sets differ by at least the difference of their sizes, so smaller sketches need not be tried.
    least = 1.5 * np.abs(sizes[:, 0] - sizes[:, 1])
    cells, todo = CELLS, np.arange(len(old))
    while len(todo):
        # Sketches that large can fail only if two digests share all cells; then the sets are compared.
        hopeless = cells > HOPELESS * np.maximum(sizes[todo].sum(axis=1), CELLS)
        for i in todo[hopeless]:
            out[i] = len(np.setxor1d(old[i], new[i]))
        todo = todo[~hopeless]
        ready = least[todo] <= cells
        now, todo = todo[ready], todo[~ready]
        if len(now):
            a, b = ([side[i] for i in now] for side in (old, new))
            done, rounds = Sketches(a, cells).minus(Sketches(b, cells)).peel()
            for rows, _, _ in rounds:
                np.add.at(out, now[rows], 1)
            again = now[~done]
            out[again] = 0
            todo = np.r_[todo, again]
        cells *= 2
    return out


def likeness(old: list[np.ndarray], new: list[np.ndarray]) -> np.ndarray:
    """Share of pieces in common: 1 for equal sets (two empty ones too), 0 for none."""
    d = differing(old, new)
    total = np.array([len(a) + len(b) for a, b in zip(old, new, strict=True)], np.int64)
    return np.where(total == 0, 1.0, (total - d) / np.maximum(total + d, 1))


def compared(texts: list[str], following: list[str]) -> tuple[list[str], list[str], list[str], list[float], list[float]]:
    """Edited texts, fingerprints of texts and edited texts, and likeness to the edited and the next text."""
    edited = []
    for text, after in zip(texts, following, strict=True):
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + after[:cut])
    own, changed, others = ([np.array(digests(t), np.uint64) for t in side] for side in (texts, edited, following))
    prints = [Sketches(side, CELLS).texts([len(s) for s in side]) for side in (own, changed)]
    return edited, *prints, likeness(own, changed).tolist(), likeness(own, others).tolist()


def _ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, in order; each range ends with guards that only serve as the next row."""
    held: list[tuple[object, bool, str]] = []
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for start, end in slices([n or 0 for n in sizes], BYTES_AT_ONCE):
            ids, guards, texts = (batch.column(c).slice(start, end - start).to_pylist() for c in ("id", "guard", "text"))
            rows = [*held, *((i, g, t or "") for i, g, t in zip(ids, guards, texts, strict=True))]
            held = rows[-1:]
            pairs = [(row, after[2]) for row, after in zip(rows, rows[1:], strict=False) if not row[1]]
            if pairs:
                columns = compared([r[2] for r, _ in pairs], [after for _, after in pairs])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r, _ in pairs], batch.column("id").type),
                        pa.array([len(r[2]) for r, _ in pairs], pa.int64()),
                        *map(pa.array, columns),
                    ],
                    ["id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
                )


def neighbour_fingerprints(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_rows: int = RANGE_ROWS,
    ranges: int = RANGES,
) -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next) of every row of ``docs``.

    The id is a number.  The next document is the one with the next smaller id, after the last the first;
    rows with the same id follow one another by their text, null first, and null ids come last.  A null
    text counts as empty.  The only document is its own next one.  No rows give no rows; other columns
    of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(
        docs[id_col].alias("id"),
        docs[text_col].alias("text"),
        F.coalesce(docs[id_col].cast("double"), F.lit(-math.inf)).alias("place"),
    )
    # Range ends at the quantiles of the id; as many numbers as ranges reach the driver.
    total = rows.count()
    n = min(ranges, -(-total // range_rows))
    ends = rows.where("id is not null").approxQuantile("place", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    splits = [-math.inf, *sorted({e for e in ends if math.isfinite(e)}), math.inf]
    if len(splits) > 2:
        rows = Bucketizer(splits=splits, inputCol="place", outputCol="range").transform(rows)
    else:
        rows = rows.withColumn("range", F.lit(0.0))

    firsts = sorted(rows.groupBy("range").agg(F.max("id").alias("id")).collect(), reverse=True)
    kind = rows.schema["id"].dataType.simpleString()
    after = [*firsts[1:], *firsts[:1]]
    guards = spark.createDataFrame(
        [(r["range"], g["id"]) for r, g in zip(firsts, after, strict=True)], f"for_range double, first {kind}"
    )
    # One small row for each range.
    guard_rows = rows.join(F.broadcast(guards), F.col("id").eqNullSafe(F.col("first"))).select(
        F.col("for_range").alias("range"), F.lit(True).alias("guard"), "id", "text"
    )
    ordered = (
        rows.select("range", F.lit(False).alias("guard"), "id", "text")
        .unionByName(guard_rows)
        .repartition("range")
        .sortWithinPartitions("range", "guard", F.desc_nulls_last("id"), F.asc_nulls_first("text"))
    )
    schema = (
        f"id {kind}, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return ordered.select("id", "guard", "text").mapInArrow(_ranged, schema).withColumnRenamed("id", id_col)
