"""Find passages of benchmark items in documents with a generalised suffix automaton.

The automaton holds every run of words of the items.  A document's words stream through it; the state
and the matched length after each word tell which windows end there and which items hold them.  Runs of
words that no item holds side by side cannot contain a window and are skipped in array operations.

Documents pass once per block of the benchmark, without a shuffle.  A block has a bounded number of
words, is sent to every executor, and its automaton is built once per task process; a benchmark of
several blocks writes the findings between them, so one automaton is in memory at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import carried, carried_texts, slices, word_bytes
from stallkeeper.session import Cut, table_cut

WINDOW = 13
# Least share of words inside windows that makes a document contaminated.
SHARE = (1, 20)
# Most words of the benchmark in one automaton; bounds what is sent to executors.
BLOCK_WORDS = 200_000
BYTES_AT_ONCE = 4_000_000
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
# The same on characters, for Spark.
IN_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

Item = tuple[str, str]


class Automaton:
    """Suffix automaton of several word sequences; states know the items of their windows."""

    def __init__(self, items: list[Item], window: int):
        self.window = window
        self.ids: dict[bytes, int] = {}
        texts = [(name, [self.ids.setdefault(w, len(self.ids) + 1) for w in word_bytes(text.encode())]) for name, text in items]
        texts = [(name, words) for name, words in texts if words]
        self.length, self.link, self.next = [0], [-1], [{}]
        for _, words in texts:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.shortest = min((min(len(words), window) for _, words in texts), default=0)

        n = len(self.length)
        # The state of a state's suffix of one window: its topmost ancestor that is still that long.
        self.top = [0] * n
        by_length = sorted(range(n), key=self.length.__getitem__)
        for s in by_length[1:]:
            up = self.link[s]
            self.top[s] = self.top[up] if self.length[up] >= window else s
        self.items_of: list[set[str] | None] = [None] * n
        self.short: list[tuple[int, set[str]] | None] = [None] * n
        for name, words in texts:
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    self._add(self.top[state], name)
            if len(words) < window:
                length, names = self.short[state] or (len(words), set())
                self.short[state] = length, names | {name}
        # The nearest state on the way to the root, this one included, that ends a short item.
        self.short_at = [-1] * n
        for s in by_length[1:]:
            self.short_at[s] = s if self.short[s] else self.short_at[self.link[s]]
        self._pairs(texts)

    def _extend(self, last: int, word: int) -> int:
        length, link, following = self.length, self.link, self.next
        if word in following[last]:
            target = following[last][word]
            return target if length[target] == length[last] + 1 else self._clone(last, word, target)
        new = len(length)
        length.append(length[last] + 1)
        link.append(0)
        following.append({})
        p = last
        while p >= 0 and word not in following[p]:
            following[p][word] = new
            p = link[p]
        if p >= 0:
            target = following[p][word]
            link[new] = target if length[target] == length[p] + 1 else self._clone(p, word, target)
        return new

    def _clone(self, p: int, word: int, target: int) -> int:
        copy = len(self.length)
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[target])
        self.next.append(dict(self.next[target]))
        self.link[target] = copy
        while p >= 0 and self.next[p].get(word) == target:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _add(self, state: int, name: str) -> None:
        held = self.items_of[state]
        if held is None:
            self.items_of[state] = {name}
        else:
            held.add(name)

    def _pairs(self, texts: list[tuple[str, list[int]]]) -> None:
        """A hashed table of the word pairs that stand side by side in some item."""
        pairs = {(a, b) for _, words in texts for a, b in zip(words, words[1:], strict=False)}
        self.bits = max(12, (8 * len(pairs)).bit_length())
        self.beside = np.zeros(1 << self.bits, dtype=bool)
        if pairs:
            left, right = np.array(list(pairs), dtype=np.uint64).T
            self.beside[self._hash(left, right)] = True

    def _hash(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        mixed = (left << np.uint64(32) | right) * np.uint64(0x9E3779B97F4A7C15)
        return mixed >> np.uint64(64 - self.bits)

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of known words, each pair of neighbours known, long enough for the shortest window."""
        known = ids > 0
        beside = known[:-1] & known[1:]
        at = np.flatnonzero(beside)
        beside[at] = self.beside[self._hash(ids[at].astype(np.uint64), ids[at + 1].astype(np.uint64))]
        starts = np.flatnonzero(known & np.r_[True, ~beside])
        ends = np.flatnonzero(known & np.r_[~beside, True]) + 1
        keep = ends - starts >= self.shortest
        return zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)

    def hits(self, ids: list[int], start: int) -> Iterator[tuple[int, int, set[str]]]:
        """(first word, end, items) of each window in a stretch of words that begins at ``start``."""
        following, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, word in enumerate(ids, start + 1):
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            if matched >= window:
                yield i - window, i, self.items_of[self.top[state]]
            short = self.short_at[state]
            while short > 0:
                size, names = self.short[short]
                if size <= matched:
                    yield i - size, i, names
                short = self.short_at[link[short]]

    def scan(self, texts: list[list[bytes]]) -> list[tuple[list[tuple[int, int]], set[str]]]:
        """Spans of hit words, joined where they touch, and items, for each list of words."""
        sizes = [len(words) + 1 for words in texts]
        ids = np.zeros(sum(sizes), dtype=np.int64)
        offset, offsets = 0, []
        for words, size in zip(texts, sizes, strict=True):
            ids[offset : offset + size - 1] = np.fromiter(map(self.ids.get, words, repeat(0)), np.int64, size - 1)
            offsets.append(offset)
            offset += size
        found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in texts]
        if not self.shortest or not len(ids):
            return found
        firsts = np.array(offsets)
        for start, end in self.runs(ids):
            row = int(np.searchsorted(firsts, start, side="right")) - 1
            spans, names = found[row]
            for a, b, items in self.hits(ids[start:end].tolist(), start - offsets[row]):
                spans.append((a, b))
                names |= items
        return [(joined(spans), names) for spans, names in found]


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the given spans of words, from the first byte of each to its last."""
    words = [m.span() for m in WORD.finditer(text)]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at : words[a][0]])
        at = words[b - 1][1]
    return b"".join([*out, text[at:]])


_built: dict[tuple[int, int], Automaton] = {}


def _automaton(block: Broadcast, window: int) -> Automaton:
    key = block._jbroadcast.id() if getattr(block, "_jbroadcast", None) else id(block.value), window
    if key not in _built:
        _built.clear()
        _built[key] = Automaton(block.value, window)
    return _built[key]


SPANS = "array<struct<start:int,end:int>>"


def _cleaned(text: bytes | None, spans: list[dict[str, int]], least: int) -> bytes | None:
    """The text without spans of at least so many words; null if there are none."""
    long = [(s["start"], s["end"]) for s in spans if s["end"] - s["start"] >= least]
    return without_spans(text, long) if text and long else None


def _pass(block: Broadcast, window: int, text_col: str, clean: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(block, window)
        for batch in batches:
            texts = carried_texts(batch, text_col)
            sizes = pc.binary_length(texts).to_pylist()
            for start, end in slices([n or 0 for n in sizes], BYTES_AT_ONCE):
                part = batch.slice(start, end - start)
                words = [word_bytes(t) for t in texts.slice(start, end - start).to_pylist()]
                before = zip(part.column("spans").to_pylist(), part.column("items").to_pylist(), strict=True)
                spans, items = [], []
                for (new, names), (old, listed) in zip(automaton.scan(words), before, strict=True):
                    spans.append([{"start": a, "end": b} for a, b in joined([(s["start"], s["end"]) for s in old] + new)])
                    items.append(sorted(names | set(listed)))
                found = {
                    "n_words": pa.array([len(w) for w in words], pa.int64()),
                    "spans": pa.array(spans, span_type),
                    "items": pa.array(items, pa.list_(pa.string())),
                }
                if clean:
                    own = texts.slice(start, end - start).to_pylist()
                    found["cleaned"] = pa.array([_cleaned(t, s, window) for t, s in zip(own, spans, strict=True)], pa.binary())
                # What came is passed on as it is, with the findings so far.
                came = [c for c in part.schema.names if c not in found]
                columns = [part.column(c) for c in came] + list(found.values())
                yield pa.RecordBatch.from_arrays(columns, [*came, *found])

    return scanned


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> list[DataFrame]:
    """Items as (name, text), dealt by hash into blocks of about ``block_words`` words."""
    items = benchmark.select(benchmark[item_col].cast("string").alias("name"), benchmark[text_col].alias("text"))
    items = items.where("name is not null and text is not null").distinct()
    # By the rule for words, so that no item can hold more of them than were counted.
    words = items.select(F.coalesce(F.sum(F.regexp_count("text", F.lit(IN_WORDS))), F.lit(0))).first()[0]
    blocks = max(1, -(-words // block_words))
    return [items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k) for k in range(blocks)]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    carry: list[str] | None = None,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    share: tuple[int, int] = SHARE,
    block_words: int = BLOCK_WORDS,
    clean: bool = False,
    cut: Cut | None = None,
) -> DataFrame:
    """(row, n_words, n_hit, spans, items, contaminated) of every row of ``docs``.

    With ``clean`` also ``cleaned``: the text without the spans of at least ``window`` words (those of shorter
    items stay), null where there are none.  ``block_words`` bounds a block of the benchmark, but for a
    single longer item, which is a block.

    ``row`` is a struct of the columns to ``carry`` (all by default), so no name can clash.  A window is
    ``window`` consecutive words of an item, or the whole of a shorter item.  ``spans`` are the word
    spans (from 0, end exclusive) inside windows, ``items`` the sorted ids (as strings) of items whose
    windows occur.  ``contaminated``: hit, and at least ``share`` of the words are.

    - Null or empty text: no words, not contaminated.
    - Items with a null id or text, or without words, have no windows; repeated items count once.
    - An empty benchmark contaminates nothing; no rows give no rows; repeated rows are judged each.
    """
    spark = docs.sparkSession
    rows = carried(docs, carry, text_col)
    came = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    schema = f"{came}, n_words bigint, spans {SPANS}, items array<string>" + ", cleaned binary" * clean
    none = [F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items")]
    found = rows.select("*", *none)
    blocks = item_blocks(benchmark, item_col, item_text_col, block_words)
    for k, items in enumerate(blocks):
        if k:
            cut = cut or table_cut(spark)
            found = cut(found, f"block_{k}").drop("n_words", "cleaned")
        # One block of items on the driver, its size bounded above.
        block = spark.sparkContext.broadcast([(r.name, r.text) for r in items.collect()])
        found = found.mapInArrow(_pass(block, window, text_col, clean), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    cleaned = [F.col("cleaned").cast("string").alias("cleaned")] if clean else []
    out = found.select("row", "n_words", n_hit.alias("n_hit"), "spans", "items", *cleaned)
    return out.select("*", _contaminated(share).alias("contaminated"))


def _contaminated(share: tuple[int, int]) -> Column:
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share[1] >= F.col("n_words") * share[0])
