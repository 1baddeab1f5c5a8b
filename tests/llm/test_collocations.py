"""Phrases against plain counting; summaries against their guarantee."""

from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from stallkeeper.llm import collocations as col

SCHEMA = "doc_id bigint, text string, lang string"


def plain(rows, threshold=10, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + n])) for i in range(len(words) - n + 1))
    out = {}
    for (lang, words), a in counts.items():
        if len(words) == 1 or a < threshold:
            continue
        longer = [b for (of, w), b in counts.items() if of == lang and len(w) > len(words) and b >= threshold and words in {w[:2], w[1:]}]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), a, left, right))
    return sorted(
        (lang, k + 1, phrase.decode(), a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for k, (score, _, phrase, a, left, right) in enumerate(sorted(found)[:top])
    )


def made(seed, n):
    random.seed(seed)
    words = ["New York City", "new york", "of the", "é Straße", "中 文", "x y z", "\x01 b", *"abcdefgh"]
    ends = [". ", ", ", " ", "\t", "\n", "; ", "  ", "\x0b", "!? "]
    rows = []
    for i in range(n):
        text = "".join(random.choice(words) + random.choice(ends) for _ in range(random.randint(0, 25)))
        rows.append((i, text, random.choice(["en", "en", "und", None, ""])))
    return rows


ODD = [
    (1, None, "en"), (1, None, None), (2, "", "en"), (None, "...,,;;", "xx"), (3, "one", "xx"),
    (4, "very long text, " * 30_000, "yy"), (5, "tie a tie b " * 10, "zz"), (5, "tie a tie b " * 10, "zz"), (6, "w" * 100_000, "yy"),
]


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, small, monkeypatch):
    if small:
        # Every bound is met: chunks, slices within texts, flushes, full summaries, a full bitmap.
        for name, value in (("WORDS_AT_ONCE", 300), ("BYTES_AT_ONCE", 70), ("HELD_HASHES", 200), ("SALTS", 3)):
            monkeypatch.setattr(col, name, value)
        monkeypatch.setattr(col.text_slices, "__defaults__", (70,))
    rows = made(small, 300) + (ODD if not small else [r for r in ODD if len(r[1] or "") < 1000] + [(7, "no blanks" * 50, "en")])
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as phrase", "2 as n", "'x' as size")
    found = col.collocations(docs, top=20, counters=400 if small else col.COUNTERS)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, top=20)


def test_empty_and_rare(spark):
    assert col.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert col.collocations(spark.createDataFrame([(1, "a b c", "en"), (2, None, None)], SCHEMA)).count() == 0


def test_every_frequent_hash_survives():
    random.seed(2)
    for counters in (20, 60):
        stream = [random.choice([*range(5)] * 4 + [*range(400)]) for _ in range(4000)]
        want = {h for h, n in Counter(stream).items() if n >= 10}
        halves = []
        for part in (stream[:1500], stream[1500:]):
            summary = col.Summary(counters, 10)
            for i in range(0, len(part), 50):
                summary.add(*col.combined(np.array(part[i : i + 50], np.uint64), np.ones(len(part[i : i + 50]), np.int64)))
            summary.survivors()
            assert summary.lost < 10
            halves.append(summary)
        # What summaries of two halves lose adds up, so merged ones must keep below it too.
        merged = col.Summary(counters, 10**6)
        for half in halves:
            merged.add(half.hashes, half.counts, half.lost)
        merged.survivors()
        exact = Counter(stream)
        held = dict(zip(merged.hashes.tolist(), merged.counts.tolist(), strict=True))
        assert all(n - merged.lost <= held.get(h, 0) <= n for h, n in exact.items())
        whole = col.Summary(counters, 10)
        for i in range(0, len(stream), 50):
            whole.add(*col.combined(np.array(stream[i : i + 50], np.uint64), np.ones(50, np.int64)))
        assert want <= set(whole.survivors().tolist())


def test_summary_with_room_loses_what_it_may():
    # Mass 3000 at threshold 10 needs more than 300 counters.
    stream = np.arange(3000, dtype=np.uint64) % np.uint64(290)
    summary = col.Summary(310, 10)
    for i in range(0, 3000, 100):
        summary.add(*col.combined(stream[i : i + 100], np.ones(100, np.int64)))
    assert len(summary.survivors()) == 290 and summary.most == 310


def test_packing():
    random.seed(4)
    hashes = np.unique(np.array([random.getrandbits(64) for _ in range(1000)], np.uint64))
    counts = np.array([random.randrange(1, 10**12) for _ in hashes], np.int64)
    back = col.unpacked(col.packed(hashes, counts))
    assert (back[0] == hashes).all() and (back[1] == counts).all()
    parts = col.part_of(hashes, 7)
    assert (np.diff(parts) >= 0).all() and set(parts.tolist()) == set(range(7))


def test_slices_tear_nothing():
    text = "One two.three,four five\tsix\nseven " * 30
    whole = [w for words in col.text_slices(text.encode()) for w in words]
    for most in (1, 5, 64):
        assert [w for words in col.text_slices(text.encode(), most) for w in words] == whole


def test_a_summary_holds_no_array_twice_while_it_combines():
    """Its peak is a small multiple of what it sorts: the parts go before the sorted copies come."""
    n = 200_000
    rng = np.random.default_rng(1)
    parts = [(rng.integers(0, 2**63, n, dtype=np.uint64), np.ones(n, np.int64)) for _ in range(5)]
    summary = col.Summary(5 * n, 10)
    tracemalloc.start()
    for hashes, counts in parts:
        summary.add(hashes.copy(), counts.copy())
    del hashes, counts
    assert len(summary.survivors()) == 0 and len(summary.counts) == 5 * n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2.8 * 5 * n * 16
