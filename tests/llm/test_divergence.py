"""Divergence of sources against plain arithmetic, and transducers against sorted lists."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stallkeeper.llm import divergence
from stallkeeper.llm.text import Bytes, cut_texts
from stallkeeper.llm.transducer import Builder, Transducer

SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain(rows, min_docs=3, top=200):
    """The whole result in plain integers."""
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source in rows]
    in_docs, counts = Counter(), defaultdict(Counter)
    for lang, source, terms in docs:
        in_docs.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, source in counts:
        kept = sorted((t for (of, t), n in in_docs.items() if of == lang and n >= min_docs), key=str.encode)
        sources = [s for of, s in counts if of == lang]
        whole = Counter()
        for s in sources:
            whole.update(counts[lang, s])

        def chance(held, term, kept=kept):
            return 1 + 10**9 * (held[term] + 1) // (sum(held[t] for t in kept) + len(kept))

        mine = {t: chance(counts[lang, source], t) for t in kept}
        pairs, terms = [], []
        for other in sources:
            if other != source:
                theirs = {t: chance(counts[lang, other], t) for t in kept}
                pairs.append((-sum((mine[t] - theirs[t]) ** 2 // theirs[t] for t in kept), other.encode(), other))
        for t in kept:
            q = chance(whole, t)
            if counts[lang, source][t] and mine[t] > q:
                terms.append((-((mine[t] - q) ** 2 // q), t.encode(), t))
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            out += [(lang, source, part, item, -value, k + 1) for k, (value, _, item) in enumerate(sorted(found)[:most])]
    return sorted(out)


def made(seed, n):
    random.seed(seed)
    words = ["the", "The", "naïve", "Ärger", "über", "中文", "a1b", "x_y", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9))]
    rows = []
    for i in range(n):
        source = random.choice(["hot"] * 5 + ["b", "c", "é", "", None])
        text = " ".join(random.choices(words, k=random.randint(0, 30)))
        rows.append((i, text, random.choice(["en", "en", "de", None]), source))
    return rows


ODD = [
    (1, None, "en", "a"), (1, None, "en", "a"), (2, "", None, None), (None, "rare words only", "xx", "a"),
    (3, "other words", "xx", "b"), (4, "alone", "yy", "a"), (5, "same same " * 40_000, "zz", "a"),
    (6, "same day", "zz", "b"), (7, "Same, day", "zz", "c"), (7, "Same, day", "zz", "c"), (8, "x" * 100_000, "zz", "c"),
]


@pytest.mark.parametrize("run_terms", [7, 50_000])
def test_divergence(spark, run_terms, monkeypatch):
    monkeypatch.setattr(divergence, "BYTES_AT_ONCE", 500)
    monkeypatch.setattr(divergence, "BLOCK", 5)
    rows = made(run_terms, 250) + ODD
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as term", "2 as n", "'x' as rank", "3 as `group`")
    found = divergence.source_divergence(docs, top=6, run_terms=run_terms)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows, top=6)


def test_ties_and_empty_tables(spark):
    # Equal counts all over: every rank is a tie.
    rows = [(i, "a b c d ä z", "en", s) for i, s in enumerate("qp" * 3)] + [(9, "b a", "en", "r")]
    found = divergence.source_divergence(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)
    assert divergence.source_divergence(spark.createDataFrame([], SCHEMA)).count() == 0
    few = [(1, "too rare", "en", "p"), (2, None, "en", "q")]
    found = divergence.source_divergence(spark.createDataFrame(few, SCHEMA))
    assert sorted(tuple(r) for r in found.collect()) == [("en", "p", "pair", "q", 0, 1), ("en", "q", "pair", "p", 0, 1)]


def test_chances_of_large_counts():
    random.seed(5)
    for _ in range(200):
        total = random.randrange(1, 10 ** random.randrange(1, 16))
        counts = [random.randrange(total) for _ in range(4)] + [0, total - 1]
        want = [1 + 10**9 * (c + 1) // total for c in counts]
        assert divergence.scaled(np.array(counts, np.int64), total).tolist() == want
    p, q = np.array([10**9 + 1, 1, 5]), np.array([1, 10**9 + 1, 5])
    assert divergence.diverged(p, q).tolist() == [10**18, 10**18 // (10**9 + 1), 0]


def states(terms):
    """States of the smallest automaton of these terms: different sets of endings."""
    ends = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            ends[t[:i]].add(t[i:])
    return len({frozenset(e) for e in ends.values()}) or 1


def test_cutting_into_words():
    random.seed(9)
    rule = Bytes(lambda b: b not in b" \t", b".\n")
    texts = ["".join(random.choices("aB \t.\n\x00\x01é中", k=random.randint(0, 12))).encode() for _ in range(400)] + [None, b"", b" ", b"A"]
    for held in (pa.array(texts, pa.binary()), pa.array([b"xx", *texts], pa.binary()).slice(1)):
        cut = cut_texts(held, rule)
        got = [[] for _ in texts]
        for number, doc, piece in zip(cut.number, cut.doc, cut.piece, strict=True):
            got[doc].append((cut.words[number].as_py(), piece))
        for text, words in zip(texts, got, strict=True):
            pieces = [re.findall(rb"[^ \t]+", p.translate(bytes(rule.lower))) for p in re.split(rb"[.\n]", text or b"")]
            assert [w for w, _ in words] == [w for p in pieces for w in p]
            ends = [k for k, p in enumerate(pieces) for _ in p]
            assert [a == b for a, b in zip(ends, ends[1:])] == [a[1] == b[1] for a, b in zip(words, words[1:])]
        assert len({p for words in got for _, p in words}) == len({(d, p) for d, words in enumerate(got) for _, p in words})
    assert len(cut_texts(pa.array([], pa.binary()), rule).number) == 0


def test_transducer():
    random.seed(7)
    for letters, n in ((b"ab", 40), (b"abc\xff\x80", 300), (b"a", 5)):
        terms = sorted({bytes(random.choices(letters, k=random.randint(0, 7))) for _ in range(n)})
        builder = Builder()
        for t in terms:
            builder.add(t)
        known = Transducer(builder.finish())
        assert [known.ordinal(t) for t in terms] == list(range(len(terms)))
        others = {bytes(random.choices(letters, k=random.randint(0, 9))) for _ in range(300)} - set(terms)
        assert all(known.ordinal(t) == -1 for t in others)
        assert len(known.ends) == states(terms)  # minimal
        data = b"".join(terms)
        stops = np.cumsum([len(t) for t in terms])
        starts = stops - [len(t) for t in terms]
        assert known.ordinals(np.frombuffer(data, np.uint8), starts, stops).tolist() == list(range(len(terms)))
    empty = Transducer(Builder().finish())
    assert empty.ordinal(b"") == empty.ordinal(b"a") == -1
    builder = Builder()
    builder.add(b"b")
    for t in (b"a", b"b"):
        with pytest.raises(ValueError):
            builder.add(t)
