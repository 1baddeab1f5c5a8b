"""Byte-pair encoding and decoding of words with marked ends, equal to the public library's.

Merging a word keeps a segment tree over the ranks of its adjacent pairs.  The root holds the lowest
rank with the leftmost place; a merge changes three leaves and their paths to the root, so a word of
n bytes takes O(n log n) however long it is.  Words repeat, so each task remembers the words it has
merged, up to a bound.  The job is one narrow pass: no shuffle, nothing gathered.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import has_newer, lower_as_library, newer_characters, slices

NO_PAIR = 1 << 62
PLACE_BITS = 32
PLACE = (1 << PLACE_BITS) - 1
FAN = 16

# Words remembered by one task, twice, and characters of text worked on at once.
REMEMBERED = 300_000
CHARS_AT_ONCE = 4_000_000

# White space as Unicode defines it; Python's own class has four control characters more.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def merge_ranked(symbols: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Apply the lowest-ranked pair, leftmost first, until none is left.

    ``merges`` maps ``left << 32 | right`` to (rank, symbol of the merged pair).  The segment tree's
    leaves are rank and place of each pair in one number; a node is the least of up to FAN below it.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    symbols, find = list(symbols), merges.get
    leaves = [NO_PAIR] * (n - 1)
    for i in range(n - 1):
        found = find(symbols[i] << 32 | symbols[i + 1])
        if found:
            leaves[i] = found[0] << PLACE_BITS | i
    levels = [leaves]
    while len(levels[-1]) > FAN:
        below = levels[-1]
        levels.append([min(below[k : k + FAN]) for k in range(0, len(below), FAN)])
    top = levels[-1]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    while (root := min(top)) != NO_PAIR:
        i = root & PLACE
        j = after[i]
        symbols[i] = find(symbols[i] << 32 | symbols[j])[1]
        symbols[j] = -1
        k, h = after[j], before[i]
        after[i] = k
        touched = [i]
        leaves[i] = NO_PAIR
        if k < n:
            before[k] = i
            leaves[j] = NO_PAIR
            touched.append(j)
            if found := find(symbols[i] << 32 | symbols[k]):
                leaves[i] = found[0] << PLACE_BITS | i
        if h >= 0:
            found = find(symbols[h] << 32 | symbols[i])
            leaves[h] = found[0] << PLACE_BITS | h if found else NO_PAIR
            touched.append(h)
        for below, level in zip(levels, levels[1:], strict=False):
            touched = list({place // FAN for place in touched})
            for place in touched:
                level[place] = min(below[place * FAN : place * FAN + FAN])
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """Ids, merges and special strings of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        end = model["end_of_word_suffix"] or ""
        self.merges = {ids[a] << 32 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + end] for c in letters]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.tokens = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split if self.special else None
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        # The word pattern that the vocabulary file names, and the same for ASCII.
        contractions = "'s|'t|'re|'ve|'m|'ll|'d"
        self.words_any = regex.compile(rf"{contractions}|\p{{L}}+|\p{{N}}|[^{SPACES}\p{{L}}\p{{N}}]+").findall
        self.words_ascii = re.compile(rf"{contractions}|[a-z]+|[0-9]|[^\t-\r a-z0-9]+").findall
        # The same where a text holds letters that are too new for the library: they belong to no class.
        newer = newer_characters()
        self.words_newer = regex.compile(
            rf"{contractions}|(?:(?![{newer}])\p{{L}})+|(?![{newer}])\p{{N}}|(?:[^{SPACES}\p{{L}}\p{{N}}]|[{newer}])+"
        ).findall

    def words(self, text: str) -> list[str]:
        """Words of a text without special strings: composed, lower-cased, white space dropped."""
        if text.isascii():
            return self.words_ascii(text.lower())
        plain = lower_as_library(unicodedata.normalize("NFC", text))
        return (self.words_newer if has_newer(plain) else self.words_any)(plain)

    def word_ids(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        return merge_ranked([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]], self.merges)

    def encode(self, text: str) -> list[int]:
        parts = self.split_special(text) if self.split_special else [text]
        if len(parts) > 1:
            return list(chain.from_iterable([self.special[p]] if i % 2 else self._plain(p) for i, p in enumerate(parts)))
        return self._plain(text)

    def _plain(self, text: str) -> list[int]:
        words = self.words(text)
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older.get
        for word in set(words).difference(known):
            known[word] = older(word) or self.word_ids(word)
        return list(chain.from_iterable(map(known.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by a space; ids that are not in the vocabulary are left out."""
        return " ".join([t for t in map(self.tokens.get, ids) if t is not None])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _batches(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, end in slices([len(t or "") for t in texts], CHARS_AT_ONCE):
                rows = [vocab.encode(t or "") for t in texts[start:end]]
                ends = np.cumsum([0, *map(len, rows)], dtype=np.int64)
                flat = np.fromiter(chain.from_iterable(rows), dtype=np.int32, count=int(ends[-1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(start, end - start),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)),
                        pa.array([vocab.decode(ids) for ids in rows], pa.string()),
                    ],
                    ["id", "ids", "decoded"],
                )

    return encoded


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded) of every row of ``docs``; the id column keeps its name.

    ``vocab_path`` is a vocabulary file that every executor can open.  A null or empty text, or one of
    white space alone, has no ids and decodes to the empty text.  A null id is carried; rows that repeat
    are encoded each; no rows give no rows.  Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_batches(vocab_path), f"id {kind}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")
