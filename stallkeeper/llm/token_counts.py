"""Count a tokenizer's tokens by merging many pre-tokens at once in ragged arrays.

The distinct new pre-tokens of a batch lie end to end in one array.  In each round every sequence
applies its own lowest-ranked pair, all sequences in the same few array operations; finished
sequences leave.  Ranks are looked up again only beside a merge.  A pair is applied at all its places
at once only where no pair with the merged symbol ranks lower, so the outcome is that of merging one
place at a time.  One narrow pass: no shuffle, nothing gathered.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.bpe import SPACES, byte_letters
from stallkeeper.llm.text import has_newer, newer_characters, slices

NO_RANK = np.int64(1 << 40)

# Pre-tokens remembered by one task, twice, characters of text and bytes of new pre-tokens worked on at once.
REMEMBERED = 500_000
CHARS_AT_ONCE = 4_000_000
BYTES_AT_ONCE = 2_000_000


class PairRanks:
    """Ranks of adjacent symbols as sorted arrays."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int], symbols: int):
        self.symbols = symbols
        left, right = (np.array([p[k] for p in pairs], dtype=np.int64) for k in (0, 1))
        keys = left * symbols + right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array(merged, dtype=np.int64)
        # The lowest rank of any pair that a symbol takes part in.
        lowest = np.full(symbols, NO_RANK)
        np.minimum.at(lowest, left, np.arange(len(pairs)))
        np.minimum.at(lowest, right, np.arange(len(pairs)))
        self.at_once = lowest[self.merged] > np.arange(len(pairs))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.symbols + right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.ranks[place], NO_RANK)


def merged_lengths(symbols: np.ndarray, lengths: np.ndarray, pairs: PairRanks) -> np.ndarray:
    """How many symbols each sequence ends with; sequences lie end to end and none is empty."""
    counts = np.zeros(len(lengths), dtype=np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    symbols = symbols.astype(np.int64)
    rank = np.full(len(symbols), NO_RANK)
    inner = np.flatnonzero(owner[:-1] == owner[1:])
    rank[inner] = pairs.of(symbols[inner], symbols[inner + 1])
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        sizes = np.diff(np.r_[starts, len(symbols)])
        best = np.minimum.reduceat(rank, starts)
        done = best == NO_RANK
        if done.any():
            counts[owner[starts[done]]] = sizes[done]
            stay = np.repeat(~done, sizes)
            symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
            if not len(symbols):
                break
            best, sizes = best[~done], sizes[~done]
            starts = np.cumsum(np.r_[0, sizes[:-1]])
        places = np.flatnonzero(rank == np.repeat(best, sizes))
        # Where places touch, as in aaa, every second one counts from the left.
        begins = np.r_[True, np.diff(places) != 1]
        run = places[np.flatnonzero(begins)][np.cumsum(begins) - 1]
        places = places[(places - run) % 2 == 0]
        # Only the first place of a sequence if the merged symbol may form a lower pair.
        first = np.r_[True, owner[places[1:]] != owner[places[:-1]]]
        places = places[first | pairs.at_once[rank[places]]]

        symbols[places] = pairs.merged[rank[places]]
        stay = np.ones(len(symbols), dtype=bool)
        stay[places + 1] = False
        place = np.cumsum(stay)[places] - 1
        symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
        changed = np.unique(np.r_[place, place[place > 0] - 1])
        rank[changed] = NO_RANK
        changed = changed[changed + 1 < len(symbols)]
        changed = changed[owner[changed] == owner[changed + 1]]
        rank[changed] = pairs.of(symbols[changed], symbols[changed + 1])
    return counts


class Counter:
    """Counts tokens of texts under a byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids: dict[str, int] = content["model"]["vocab"]
        named = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.first = np.array([ids[c] for c in byte_letters()], dtype=np.int64)
        self.pairs = PairRanks([(ids[a], ids[b]) for a, b in named], [ids[a + b] for a, b in named], max(ids.values()) + 1)
        special = [re.escape(t["content"]) for t in content["added_tokens"]]
        self.split_special = re.compile("|".join(special)).split if special else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}
        # The pattern that byte-level vocabularies of this kind split text by, and the same for ASCII.
        contractions = "'s|'t|'re|'ve|'m|'ll|'d"
        self.split_any = regex.compile(
            rf"{contractions}| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACES}\p{{L}}\p{{N}}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
        ).findall
        self.split_ascii = re.compile(
            rf"{contractions}| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
        ).findall

        # The same where a text holds letters that are too new for the library: they belong to no class.
        newer = newer_characters()
        self.split_newer = regex.compile(
            rf"{contractions}| ?(?:(?![{newer}])\p{{L}})+| ?(?:(?![{newer}])\p{{N}})+"
            rf"| ?(?:[^{SPACES}\p{{L}}\p{{N}}]|[{newer}])+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
        ).findall

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.split_ascii(text)
        return (self.split_newer if has_newer(text) else self.split_any)(text)

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special strings stand between them."""
        parts = self.split_special(text) if self.split_special else [text]
        tokens: list[str] = []
        for part in parts:
            tokens += self.split(part)
        return tokens, len(parts) - 1

    def learn(self, new: list[str]) -> None:
        data = [t.encode("utf-8") for t in new]
        for start, end in slices([len(d) for d in data], BYTES_AT_ONCE):
            lengths = np.array([len(d) for d in data[start:end]], dtype=np.int64)
            symbols = self.first[np.frombuffer(b"".join(data[start:end]), dtype=np.uint8)]
            self.known.update(zip(new[start:end], merged_lengths(symbols, lengths, self.pairs).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pre_tokens(t) for t in texts]
        distinct = set().union(*[tokens for tokens, _ in split])
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        missing = distinct.difference(self.known)
        again = missing.intersection(self.older)
        self.known.update((token, self.older[token]) for token in again)
        if new := list(missing - again):
            self.learn(new)
        of = self.known.__getitem__
        return [sum(map(of, tokens)) + specials for tokens, specials in split]


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def _batches(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts: list[int] = []
            for start, end in slices([len(t or "") for t in texts], CHARS_AT_ONCE):
                counts += tokens.count([t or "" for t in texts[start:end]])
            columns = [batch.column("id"), batch.column("n_bytes"), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "n_tokens"])

    return counted


def count_tokens(
    docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``; the id column keeps its name.

    ``vocab_path`` is a vocabulary file that every executor can open.  ``over_limit``: more than ``limit``
    tokens.  A null or empty text has 0 bytes and 0 tokens; a null id is carried; rows that repeat are
    counted each; no rows give no rows.  Other columns of ``docs`` are not looked at.
    """
    rows = docs.select(
        docs[id_col].alias("id"),
        docs[text_col].alias("text"),
        F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long").alias("n_bytes"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(_batches(vocab_path), f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
