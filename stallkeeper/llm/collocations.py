"""Phrases whose words belong together, counted exactly over all texts.

An n-gram that occurs often enough must be found among all that occur, without a table of them all.
The first pass deals hashes of n-grams to hash partitions and keeps one Misra-Gries summary for each.
Partitions are as many as it takes for a summary's counters to outnumber its mass divided by the
threshold, so what it loses of any count stays below the threshold and every frequent n-gram survives;
the summary knows its loss, and grows rather than lose more.  Tasks combine hashes before they deal
them, so a common phrase arrives as one entry per task.  The second pass counts n-grams by their words.
A bitmap of fixed size lets only n-grams pass that may have survived; what passes by chance is counted
too, and falls to the threshold.  The counts of the parts of a phrase meet it by joins.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallkeeper.llm.text import slices
from stallkeeper.session import Cut, table_cut

# Occurrences of a candidate, share in a longer one that drops it, what a score is counted
# in, and ranks reported.
THRESHOLD = 10
INSIDE = (50, 100)
SCALE = 1_000_000
TOP = 2000
MAX_WORDS = 3

# Counters of a summary, hashes that a task combines, and bits of the bitmap.
COUNTERS = 1 << 21
HELD_HASHES = 2_000_000
BITMAP_BITS = 27
# Words counted at once and bytes cut into words at once; together they hold fewer than 2^21 different words.
WORDS_AT_ONCE = 1 << 19
BYTES_AT_ONCE = 2 << 20
ID_BITS = 21
# Each language's phrases are ranked in so many parts first.
SALTS = 32

# On UTF-8 bytes: A-Z to small letters, blanks to spaces, what ends a piece to full stops.
_BYTES = bytes(
    0x2E if chr(b) in ".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
BORDER = b"."
_BETWEEN = re.compile(rb"[ \t.,;:!?\n\x0b\x0c\r]")
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Words:
    """Words of one language, numbered, until there are enough to count.

    ``carried`` words at the front were counted with what came before; they only begin n-grams.
    """

    def __init__(self, carried: list[bytes] = ()) -> None:
        self.numbers = _Numbers({BORDER: 0})
        self.carried = len(carried)
        self.parts = [self._numbered(list(carried))]
        self.size = 0

    def _numbered(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))

    def add(self, words: list[bytes]) -> None:
        self.parts.append(self._numbered(words))
        self.size += len(words)

    def counted(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For n = 1, 2, 3: distinct n-grams as an array of word numbers (n columns), and their counts."""
        x, own = np.concatenate(self.parts), self.carried
        self.parts = [x]
        word = x > 0
        singles = np.bincount(x[own:], minlength=1)
        singles[0] = 0
        found = np.flatnonzero(singles)
        yield found[:, None], singles[found]
        inside = word
        packed = x
        for n in range(2, MAX_WORDS + 1):
            inside = inside[:-1] & word[n - 1 :]
            packed = packed[:-1] << ID_BITS | x[n - 1 :]
            # An n-gram belongs to the slice in which it ends.
            start = max(own - n + 1, 0)
            keys, counts = np.unique(packed[start:][inside[start:]], return_counts=True)
            columns = np.empty((len(keys), n), np.int32)
            for k in range(n):
                columns[:, k] = keys >> ID_BITS * (n - 1 - k) & ((1 << ID_BITS) - 1)
            yield columns, counts


def text_slices(text: bytes, most: int = BYTES_AT_ONCE) -> Iterator[list[bytes]]:
    """Words of a text with a border where a piece ends, cut into slices between words."""
    start = 0
    while start < len(text):
        end = start + most
        if end < len(text):
            found = _BETWEEN.search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end].translate(_BYTES).replace(b".", b" . ").split()
        start = end


def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """Words of all texts by language, a bounded number at a time; nothing is counted twice or torn."""
    held: dict[str, Words] = defaultdict(Words)
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for a, b in slices([n or 0 for n in sizes], BYTES_AT_ONCE):
            part = batch.slice(a, b - a)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                before: list[bytes] = []
                for k, words in enumerate(text_slices(text or b"")):
                    if k:
                        # The text goes on: what is held is counted, and its last words are carried over.
                        yield lang, held.pop(lang)
                        held[lang] = Words(before)
                    held[lang].add(words)
                    before = (before + words)[1 - MAX_WORDS :]
                held[lang].add([BORDER])
            if sum(w.size for w in held.values()) > WORDS_AT_ONCE:
                while held:
                    yield held.popitem()
    while held:
        yield held.popitem()


def mixed(x: np.ndarray) -> np.ndarray:
    """A finishing step of 64-bit hashes: every bit depends on all."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def ngram_hashes(lang: str, words: Words, columns: np.ndarray) -> np.ndarray:
    """Hashes of n-grams of a language, the same in every task."""
    of_word = np.fromiter(map(xxhash.xxh3_64_intdigest, words.numbers), np.uint64, len(words.numbers))
    out = np.full(len(columns), xxhash.xxh3_64_intdigest(lang, columns.shape[1]), np.uint64)
    for k in range(columns.shape[1]):
        out = mixed(out * _MIX[0] + of_word[columns[:, k]])
    return out


# ---- first pass


def combined(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sums of their counts."""
    return combined_parts([(hashes, counts)])


def combined_parts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """:func:`combined` of several; empties the list, so that no array is held longer than it is needed."""
    hashes, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    parts.clear()
    if not len(hashes):
        return hashes, counts
    order = np.argsort(hashes)
    hashes = hashes[order]
    counts = counts[order]
    del order
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    first = np.flatnonzero(new)
    return hashes[first], np.add.reduceat(counts, first)


class Summary:
    """Misra-Gries counters of a stream of (hash, count); summaries merge by adding one to another.

    ``lost`` is the most that any count is too low by.  It stays below ``threshold``: where the next
    reduction would lose more, the summary grows instead.
    """

    def __init__(self, counters: int, threshold: int) -> None:
        self.most, self.threshold, self.lost = counters, threshold, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._n_new = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray, lost: int = 0) -> None:
        """Merge counters that are too low by ``lost`` at most."""
        self.lost += lost
        self._new.append((hashes, counts))
        self._n_new += len(hashes)
        if self._n_new > self.most:
            self._settle()

    def _settle(self) -> None:
        self._new.append((self.hashes, self.counts))
        self.hashes = self.counts = None
        self.hashes, self.counts = combined_parts(self._new)
        self._n_new = 0
        if len(self.counts) > self.most:
            # The largest counter beyond the room: all give as much, those without rest go.
            least = int(np.partition(self.counts, len(self.counts) - self.most - 1)[len(self.counts) - self.most - 1])
            if self.lost + least < self.threshold:
                self.lost += least
                left = self.counts > least
                self.hashes, self.counts = self.hashes[left], self.counts[left] - least
            else:
                self.most = 2 * len(self.counts)

    def survivors(self) -> np.ndarray:
        """Hashes whose count may reach the threshold, in order."""
        self._settle()
        return self.hashes[self.counts + self.lost >= self.threshold]


def packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes and their counts, byte plane by byte plane: the first ones hardly change."""
    planes = hashes.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.compress(planes, 1)


def unpacked(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(content), np.uint8).reshape(2, 8, -1)
    hashes, counts = (np.ascontiguousarray(p.T).view(">u8").ravel() for p in planes)
    return hashes.astype(np.uint64), counts.astype(np.int64)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition of each hash: equal ranges of all hashes, in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _dealt(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to (part, content): the task's n-grams of each hash partition."""

    def deal(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        hashes, counts = combined_parts(held)
        part = part_of(hashes, parts)
        borders = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for start in range(0, len(borders) - 1, 256):
            ranges = list(zip(borders[start:], borders[start + 1 : start + 257], strict=False))
            ranges = [(a, b) for a, b in ranges if a < b]
            contents = pa.array([packed(hashes[a:b], counts[a:b]) for a, b in ranges], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(part[[a for a, _ in ranges]]), contents], ["part", "content"])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for lang, words in words_of(batches):
            for columns, counts in words.counted():
                held.append((ngram_hashes(lang, words, columns), counts))
                n += len(counts)
            del words, columns, counts
            if n > HELD_HASHES:
                yield from deal(held)
                n = 0
        if n:
            yield from deal(held)

    return dealt


def _surviving(counters: int, threshold: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by part to (first, content): a stretch of the bitmap from byte ``first`` on."""

    def stretch(summary: Summary) -> pa.RecordBatch:
        bit = np.unique((summary.survivors() >> np.uint64(64 - bits)).astype(np.int64))
        first = int(bit[0]) >> 3 if len(bit) else 0
        held = np.zeros((int(bit[-1]) >> 3) - first + 1 if len(bit) else 0, np.uint8)
        np.bitwise_or.at(held, (bit >> 3) - first, (1 << (bit & 7)).astype(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([held.tobytes()], pa.binary())], ["first", "content"])

    def surviving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, at = None, None
        for batch in batches:
            for part, content in zip(batch.column("part").to_pylist(), batch.column("content"), strict=True):
                if part != at and summary is not None:
                    yield stretch(summary)
                if part != at:
                    summary, at = Summary(counters, threshold), part
                summary.add(*unpacked(content.as_py()))
        if summary is not None:
            yield stretch(summary)

    return surviving


# ---- second pass


def _recounted(bitmap: np.ndarray, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, size, phrase, n) of n-grams that the bitmap lets pass; size 0 has the number of words."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in words_of(batches):
            spelt = list(words.numbers)
            total = 0
            for columns, counts in words.counted():
                size = columns.shape[1]
                total += int(counts.sum()) if size == 1 else 0
                bit = ngram_hashes(lang, words, columns) >> np.uint64(64 - bits)
                passed = bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1
                phrases = [b" ".join([spelt[i] for i in row]) for row in columns[passed].tolist()]
                yield _rows(lang, size, phrases, counts[passed])
            yield _rows(lang, 0, [b""], np.array([total], np.int64))

    def _rows(lang: str, size: int, phrases: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
        n = len(phrases)
        columns = {
            "lang": pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int32))),
            "size": pa.array(np.full(n, size, np.int32)),
            "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
            "n": pa.array(counts, pa.int64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return counted


def frequent_ngrams(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    counters: int = COUNTERS,
    bitmap_bits: int = BITMAP_BITS,
    cut: Cut | None = None,
) -> DataFrame:
    """(lang, size, phrase, n) of every n-gram of 1 to 3 words that occurs ``threshold`` times or more.

    ``docs`` has ``lang`` and ``text``, the text as bytes.  Size 0 has the number of words of a language.
    """
    spark, cut = docs.sparkSession, cut or table_cut(docs.sparkSession)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    # A word takes two bytes at least, so this is more than the mass; counters outnumber its share by a half.
    mass = MAX_WORDS * total // 2
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-3 * mass // (2 * threshold * counters)))
    dealt = docs.mapInArrow(_dealt(parts), "part bigint, content binary")
    dealt = dealt.repartition("part").sortWithinPartitions("part")
    found = cut(dealt.mapInArrow(_surviving(counters, threshold, bitmap_bits), "first bigint, content binary"), "survivors")

    # The bitmap has the same size whatever the data; its stretches hardly overlap.
    bitmap = np.zeros(1 << (bitmap_bits - 3), np.uint8)
    for r in found.where(F.length("content") > 0).toLocalIterator():
        bitmap[r.first : r.first + len(r.content)] |= np.frombuffer(r.content, np.uint8)
    sent = spark.sparkContext.broadcast(bitmap)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _recounted(sent.value, bitmap_bits)(batches)

    counts = docs.mapInArrow(counted, "lang string, size int, phrase string, n bigint")
    counts = counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return counts.where((F.col("size") == 0) | (F.col("n") >= threshold))


# ---- phrases


def _joined(words: str, start: str, length: str) -> Column:
    return F.expr(f"array_join(slice({words}, {start}, {length}), ' ')")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    inside: tuple[int, int] = INSIDE,
    top: int = TOP,
    counters: int = COUNTERS,
    cut: Cut | None = None,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of 2 and 3 words.

    A phrase occurs ``a`` times in all; cut after its first words, the parts occur ``l`` and ``r`` times,
    and the cut's score is floor(10**6 * a * a / (l * r)).  The lowest counts, of equal ones the shortest
    first part.  A phrase goes whose words lie in a longer candidate that occurs at least ``inside`` as
    often.  ``n`` is the number of words of the language.

    - Null lang is ``und``, as is a lang of that name; null and empty texts have no words.
    - A row is a document: repeated rows count each.  No rows or no frequent phrase: no rows.
    - Very long texts are counted slice by slice, no n-gram torn.
    - Equal scores: more occurrences first, then byte order.  Other columns are not looked at.
    """
    cut = cut or table_cut(docs.sparkSession)
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(lang, docs[text_col].cast("binary").alias("text"))
    counts = cut(frequent_ngrams(rows, threshold, counters, cut=cut), "frequent_ngrams")

    parts = counts.where(F.col("size") > 0).select("lang", F.col("phrase").alias("part"), F.col("n").alias("n_part"))
    words = counts.where(F.col("size") > 1).select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = words.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _joined("words", "1", "k").alias("left"), _joined("words", "k + 1", "size").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        of = parts.select("lang", F.col("part").alias(side), F.col("n_part").alias(name))
        cuts = cuts.join(of, ["lang", side])
    # Products of two counts take up to 38 digits.
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r")}
    above = (wide["a"] * wide["a"] * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)")
    cuts = cuts.withColumns({"above": above, "below": (wide["l"] * wide["r"]).cast("decimal(38,0)")})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("at")
    )

    # What a phrase may lie in: the shorter phrases of every candidate, each with its most frequent one.
    starts = "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(words, i, n), ' '))))"
    longer = words.where(F.col("size") > 2).select("lang", F.explode(F.expr(starts)).alias("phrase"), F.col("a").alias("longer"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * inside[1] < F.col("a") * inside[0])
    )
    kept = kept.select("lang", "phrase", "a", "at.*")

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    few = few.where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = counts.where(F.col("size") == 0).select("lang", F.col("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
