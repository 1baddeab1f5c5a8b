"""Edge cases and plain versions of the training-text operators."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from plain_versions import contamination, line_dedup, near_duplicates, secret_spans, sha, url_verdicts, words
from tokenizers import Tokenizer

from stallkeeper.llm import bpe, decontamination, fingerprints, licenses, quality, secrets, token_counts, url_filters
from stallkeeper.llm import line_dedup as lines
from stallkeeper.llm import near_duplicates as near
from stallkeeper.llm.text import word_bytes

SCHEMA = "doc_id bigint, text string"
LONG = "Ordinary words, again and again. " * 4000


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, other alphabets."""
    rows = [
        (5, "A shared line of text\nshort\nown line of five\n"),
        (5, "A shared line of text\nshort\nown line of five\n"),
        (3, "  a SHARED line of text\t\nshort\n\nÄ own line of three"),
        (9, "a shared line of text\na shared line of text"),
        (None, "a shared line of text\nx"),
        (7, None),
        (8, ""),
        (11, "ΟΔΟΣ  naïve 中文 😀 <|endoftext|> it's"),
        (12, LONG),
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_lines(spark, docs):
    rows, df = docs
    want = sorted(line_dedup(rows), key=str)
    got = lines.drop_shared_lines(df.selectExpr("*", "1 as n_lines", "'x' as row", "2 as h1"))
    assert got.columns == ["doc_id", "text", "row", "h1", "n_lines", "n_dropped"]
    assert sorted([(r.text, r.n_lines, r.n_dropped) for r in got.collect()], key=str) == want
    assert lines.drop_shared_lines(df.limit(0)).count() == 0


def test_lines_in_three_documents(spark, docs):
    got = {r.doc_id: r.n_dropped for r in lines.drop_shared_lines(docs[1], min_docs=3).collect()}
    assert got[5] == 1 and got[9] == 2 and got[3] == 0
    assert all(r.n_dropped == 0 for r in lines.drop_shared_lines(docs[1], min_docs=4).collect())


def test_encoding(docs):
    rows, df = docs
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want = sorted((library.encode(t or "", add_special_tokens=False).ids for _, t in rows))
    got = bpe.encode_decode(df.selectExpr("*", "1 as id", "2 as ids"), path).collect()
    assert sorted(list(r.ids) for r in got) == want
    assert all(r.decoded == library.decode(list(r.ids), skip_special_tokens=False) for r in got)
    assert bpe.encode_decode(df.limit(0), path).count() == 0


def code_points():
    return [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]


def test_encoding_of_every_code_point():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, vocab = Tokenizer.from_file(path), bpe.vocabulary(path)
    texts = [f"a{c} {c}1{c}a" for c in code_points()]
    for start in range(0, len(texts), 50_000):
        part = texts[start : start + 50_000]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert [t for t, ids in zip(part, want, strict=True) if vocab.encode(t) != ids] == []


def test_pre_tokens_of_every_code_point():
    path = public_tokenizers.path("byte_bpe_50k.json")
    split, counter = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str, token_counts.Counter(path)
    points = code_points()
    for start in range(0, len(points), 64):
        text = "x".join(f"a{c} {c}1 1{c}a's{c}  {c}" for c in points[start : start + 64])
        assert counter.pre_tokens(text)[0] == [text[a:b] for _, (a, b) in split(text)], hex(ord(points[start]))


@pytest.fixture(scope="module")
def odd_texts():
    random.seed(1)
    letters = [chr(c) for c in [*range(0x250), 0x3A3, 0x3C3, 0x130, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x2167, 0xB2, 0x301]]
    common = [*"the ing '  \nLLa12", "'s", "<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(random.choice(letters if random.random() < 0.5 else common) for _ in range(random.randint(0, 60))) for _ in range(2000)]
    return [*texts, "a" * 5000, "ab" * 3000, "=" * 4000, "", " \n "]


def test_encoding_of_odd_texts(odd_texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(odd_texts, add_special_tokens=False)]
    assert [bpe.vocabulary(path).encode(t) for t in odd_texts] == want


def test_memory_of_words_is_bounded(monkeypatch, odd_texts):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    path = public_tokenizers.path("word_bpe_49k.json")
    vocab = bpe.Vocabulary(path)
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(odd_texts[:200], add_special_tokens=False)]
    assert [vocab.encode(t) for t in odd_texts[:200]] == want


def test_counts_of_odd_texts(monkeypatch, odd_texts):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(odd_texts, add_special_tokens=False)]
    counter = token_counts.Counter(path)
    assert [n for k in range(0, len(odd_texts), 100) for n in counter.count(odd_texts[k : k + 100])] == want


def test_lower_pairs_of_a_merged_symbol_go_first():
    # Symbol 3 is 0+1 and takes part in a pair that ranks lower than the one that makes it.
    pairs = token_counts.PairRanks([(3, 0), (0, 1)], [4, 3], 5)
    symbols = np.array([0, 1, 0, 1])
    # 0 1 0 1 -> 3 0 1 -> 4 1: merging both places at once would end with 3 3.
    assert token_counts.merged_lengths(symbols, np.array([4]), pairs).tolist() == [2]


def test_counts(docs):
    rows, df = docs
    got = token_counts.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted(r.n_bytes for r in got) == sorted(len((t or "").encode()) for _, t in rows)
    assert {r.doc_id: r.over_limit for r in got}[12] is True
    assert {r.doc_id: r.n_tokens for r in got}[7] == 0


def test_decontamination(spark, docs):
    rows, df = docs
    items = [(1, "own line of five"), (2, "words again and again ordinary words again and again ordinary words again and again"), (2, None), (None, "short"), (4, "...")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = contamination([t for _, t in rows], [i for i in items if i[0] is not None])
    for block_words in (200_000, 5):  # one block, and several
        got = decontamination.contamination(
            df.selectExpr("*", "1 as spans", "2 as n_words"), bench, block_words=block_words
        ).collect()
        assert all(set(r.row.asDict()) == {"doc_id", "text", "spans", "n_words"} for r in got)
        by_text = {r.row.text: (r.n_words, r.n_hit, set(r["items"])) for r in got}
        assert [by_text[t] for _, t in rows] == want
        assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    assert decontamination.contamination(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.contamination(df.limit(0), bench).count() == 0


def test_automaton_on_random_words():
    random.seed(3)
    for _ in range(200):
        letters, window = "abcdef"[: random.choice([2, 3, 6])], random.choice([1, 2, 3, 5])
        make = lambda n: " ".join(random.choice(letters) for _ in range(n))  # noqa: B023, E731
        items = [(str(i), make(random.randint(0, 9))) for i in range(random.randint(0, 6))]
        texts = [make(random.randint(0, 30)) for _ in range(8)]
        found = decontamination.Automaton(items, window).scan([word_bytes(t.encode()) for t in texts])
        got = [(len(words(t)), sum(b - a for a, b in spans), names) for t, (spans, names) in zip(texts, found, strict=True)]
        assert got == contamination(texts, items, window)


def test_spans_are_cut_out():
    text = "Keep, one two THREE. four".encode()
    assert decontamination.without_spans(text, [(1, 3)]) == b"Keep,  THREE. four"


def test_cleaned_texts(spark):
    """Long spans are cut out in the same pass, over several blocks too; short items' spans stay."""
    long = " ".join(f"w{i}" for i in range(20))
    items = [("a", long), ("b", "tiny item"), ("c", ",".join(f"v{i}" for i in range(15)))]
    texts = [f"Before, {long}! after tiny item.", "nothing here", None, "", f"x {long} y v0 v1 v2 v3 v4 v5 v6 v7 v8 v9 v10 v11 v12 v13 v14. z", "tiny item"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).selectExpr("*", "1 as cleaned", "2 as spans")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    for words_each in (10**6, 12):
        found = decontamination.contamination(df, benchmark, clean=True, block_words=words_each).collect()
        got = {r.row.doc_id: r.cleaned for r in found}
        assert got == {0: "Before, ! after tiny item.", 1: None, 2: None, 3: None, 4: "x  y . z", 5: None}
    # Words joined by commas count as words, so blocks stay as small as they should be.
    assert len(decontamination.item_blocks(benchmark, "item_id", "text", 12)) == 4


def test_fingerprints(spark, docs):
    rows, df = docs
    got = fingerprints.neighbour_fingerprints(df.selectExpr("*", "1 as range", "2 as guard"), range_rows=3).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        cut = len(text) // 3
        want.append((doc, len(text), sha(text[: len(text) - cut] + after[:cut])))
    assert sorted(((r.doc_id, r.n_chars, sha(r.edited)) for r in got), key=str) == sorted(want, key=str)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    alone = fingerprints.neighbour_fingerprints(df.where("doc_id = 12")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert fingerprints.neighbour_fingerprints(df.limit(0)).count() == 0


def test_sketches_recover_what_differs():
    random.seed(2)
    for _ in range(60):
        pieces = [f"piece {random.randint(0, 300)}. " for _ in range(random.randint(0, 400))]
        other = [p for p in pieces if random.random() < random.choice([0.2, 0.9, 1])] + ["more. "] * random.randint(0, 3)
        a, b = (np.array(fingerprints.digests("".join(x)), np.uint64) for x in (pieces, other))
        assert fingerprints.differing([a], [b])[0] == len(np.setxor1d(a, b))
    # Short pieces that repeat have digests of their own.
    many = fingerprints.digests("!.?.,.!;" * 500)
    assert len(set(many)) == len(many)


def test_peeling_names_the_digests():
    a, b = np.array([1, 2, 3], np.uint64) * np.uint64(7919), np.array([2, 3, 9], np.uint64) * np.uint64(7919)
    done, rounds = fingerprints.Sketches([a], 24).minus(fingerprints.Sketches([b], 24)).peel()
    assert done.all()
    assert {(int(k) // 7919, int(s)) for _, keys, signs in rounds for k, s in zip(keys, signs, strict=True)} == {(1, 1), (9, -1)}


def test_quality(spark, docs):
    rows, df = docs
    random.seed(4)
    good = ["The quick fox ran home. It slept well all night. " + " ".join(random.choices("abcdefgh", k=9)) for _ in range(300)]
    bad = ["buy | now | $$$ | click | " * random.randint(1, 5) + random.choice("abc") for _ in range(100)]
    texts = [(i, t) for i, t in enumerate(good + bad)]
    labels = [(i, int(i < 300)) for i, _ in texts] + [(0, 1), (1, None), (None, 1)]
    made = spark.createDataFrame(texts, SCHEMA)
    model = quality.train(made, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    scores = {r.row.doc_id: r.score for r in quality.scored(made, model, carry=["doc_id"]).collect()}
    unseen = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((scores[i] >= 0.5) == (i < 300) for i in unseen)

    got = quality.scored(df.selectExpr("*", "1 as score", "2 as row"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {(r.row.doc_id, r.row.text): r.score for r in got}
    assert by_id[(7, None)] == by_id[(8, "")]
    assert quality.scored(df.limit(0), model).count() == 0


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.scored(docs[1], quality.train(docs[1], none)).collect()} == {0.5}
    ones = spark.createDataFrame([(5, 1), (9, 1)], "doc_id bigint, quality int")
    scores = {r.score for r in quality.scored(docs[1], quality.train(docs[1], ones)).collect()}
    assert len(scores) == 1 and 0.5 < scores.pop() < 1


def test_pair_terms_equal_the_sum_over_pairs():
    draw = np.random.default_rng(0)
    model = quality.Model(0.3, draw.normal(size=9), draw.normal(size=(9, quality.RANK)), np.zeros((0, 0)))
    columns, values = np.array([1, 4, 8]), np.array([0.5, 2.0, 1.0])
    raw, _ = model._raw(np.zeros(3, int), columns, values, 1)
    want = 0.3 + model.weights[columns] @ values
    for i in range(3):
        for j in range(i + 1, 3):
            want += model.vectors[columns[i]] @ model.vectors[columns[j]] * values[i] * values[j]
    assert raw[0] == pytest.approx(want)


def group_texts(seed=5):
    """Copies, near copies in chains and stars, and texts that share a passage."""
    random.seed(seed)
    make = lambda n: [f"w{random.randint(0, 5000)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        base = make(random.randint(3, 150))
        for _ in range(random.randint(1, 6)):
            copy = list(base)
            for _ in range(random.randint(0, 5)):
                copy[random.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    passage = make(60)
    texts += [" ".join(make(60) + passage + make(60)) for _ in range(20)]
    hot = make(200)
    for k in range(40):
        copy = list(hot)
        copy[k * 3] = f"other{k}"
        texts.append(" ".join(copy))
    return [*texts, "", None, "...", "one two", "One, two!", "one two three", *texts[:5]]


def test_near_duplicates(monkeypatch, spark):
    rows = [(100 - i, t) for i, t in enumerate(group_texts())] + [(1000, LONG), (1001, LONG + "more")]
    want = near_duplicates(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as node", "2 as version")
    for bucket, group in ((2048, 1024), (7, 9)):  # whole groups, and groups in many blocks
        monkeypatch.setattr(near, "BUCKET_BLOCK", bucket)
        monkeypatch.setattr(near, "GROUP_BLOCK", group)
        found = near.near_duplicates(df).collect()
        assert {r.doc_id: (r.class_id, r.n_links) for r in found} == want
        assert sorted(r.doc_id for r in found if r.keeper) == sorted({c for c, _ in want.values()})


def test_near_duplicates_of_odd_rows(spark, docs):
    rows, df = docs
    found = near.near_duplicates(df).collect()
    assert len(found) == len(rows)
    links = {(r.doc_id, r.n_links) for r in found}
    assert (5, 1) in links and (7, 1) in links and (8, 1) in links
    assert {r.class_id for r in found if r.doc_id in (7, 8)} == {7}
    assert {r.class_id for r in found if r.doc_id is None} == {None}
    assert near.near_duplicates(df.limit(0)).count() == 0


def test_fewest_matches_keeps_pairs_at_the_threshold():
    fewest = near.fewest_matches(0.8)
    assert fewest[near.STEP] < 0.8 * near.STEP and fewest[-1] > 0.4 * near.HASHES
    assert all(a <= b for a, b in zip(fewest, fewest[1:], strict=False))


def test_components(spark):
    random.seed(6)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    from stallkeeper.session import table_cut

    got = near.connected(spark.createDataFrame(edges, "a bigint, b bigint"), table_cut(spark), "test").collect()
    met = {x for e in edges for x in e if e[0] != e[1]}
    assert {r.node: r.component for r in got} == {x: root(x) for x in met}


def test_licenses(spark, docs):
    texts = {
        1: "Released under the MIT License. Under the, MIT license",
        2: "Apache License, Version 2.0 and cc-by-nc",
        3: "Redistribution and use in source or other forms, with or without any modification, are permitted",
        4: "no notice of any kind",
        5: None,
        6: "x " * 3000 + "under the mit license " + "y " * 3000,
        7: "cc by nc cc by nc",
    }
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    got = {r.doc_id: r for r in licenses.scan_licenses(df.selectExpr("*", "1 as id", "2 as words", "3 as best")).collect()}
    assert got[1].base_labels == ["mit"] and (got[1].n_base, got[1].first_word, got[1].last_word) == (2, 1, 5)
    assert got[2].base_labels == ["apache-2", "cc-by-nc"] and got[2].score == 1.0
    assert got[3].base_labels == [] and got[3].labels == ["bsd"] and got[3].score == pytest.approx(12 / 13)
    assert got[4].labels == [] and got[4].score == 0.0 and got[4].first_word is None
    assert got[5].n_words == 0 and got[5].labels == []
    assert got[6].first_word == 3000
    assert got[7].n_base == 2 and got[7].last_word == 3
    assert licenses.scan_licenses(docs[1]).count() == len(docs[0])
    assert licenses.scan_licenses(df.limit(0)).count() == 0
    nameless = spark.createDataFrame([(None, texts[1]), (None, texts[1]), (None, texts[3]), (1, texts[3]), (1, texts[3])], SCHEMA)
    assert sorted((r.doc_id or 0, r.labels) for r in licenses.scan_licenses(nameless).collect()) == [
        (0, ["bsd"]), (0, ["mit"]), (0, ["mit"]), (1, ["bsd"]), (1, ["bsd"]),
    ]
    assert {r.score for r in licenses.scan_licenses(df, phrases={}, templates=[("none", "...")]).collect()} == {0.0}


def test_licenses_told_apart(spark):
    """Notices that share most of their words have one label each; the bodies of licenses are found in long texts."""
    around = "words of another kind " * 200
    bodies = [(label, text) for label, text in licenses.TEMPLATES if len(text.split()) > 32]
    texts = {
        "licensed under the GNU General Public License, version 3": ["gpl-3"],
        "licensed under the GNU Lesser General Public License, version 3": ["lgpl"],
        "licensed under the GNU Lesser General Public License": ["lgpl"],
        "licensed under a Creative Commons Attribution 4.0 International License": ["cc-by"],
        "licensed under a Creative Commons Attribution ShareAlike 4.0 International License": ["cc-by-sa"],
        "licensed under the GNU General": [],
    }
    texts |= {f"{around}{text.upper()}. {around}": [label] for label, text in bodies}
    # A fifth of the words may be missing, no more.
    texts |= {" ".join(bodies[0][1].split()[:-12]): [bodies[0][0]], " ".join(bodies[0][1].split()[:30]): []}
    rows = list(enumerate(texts))
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {text: got[k] for k, text in rows} == texts
    long = [("long", " ".join(f"w{i}" for i in range(300)))]
    df = spark.createDataFrame([(1, "x " * 777 + long[0][1]), (2, "x " * 777 + " ".join(long[0][1].split()[:200]))], SCHEMA)
    assert [r.labels for r in licenses.scan_licenses(df, templates=long).orderBy("doc_id").collect()] == [["long"], []]


def test_secrets(spark, docs):
    random.seed(5)
    parts = [*"abcdef0189", "token", "secret=", "passWD: ", "api_key", "apikey", "=", ":", '"', " ", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "😀", "\n", "."]
    texts = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 40)))) for i in range(800)]
    texts += [(801, "z" * 100_000 + " token=abcdefg1"), (802, "key x9Kd83jfQmZpLw02Vb7NcR5tQ8 here"), (803, None), (None, "AKIA" + "A1" * 8)]
    texts += [(804, "the_ordinary_identifier_of_a_function and unconstitutionalities")]
    ordinary = [(1000 + i, "the ordinary identifier of a function names some constitutional_value and other words") for i in range(200)]
    df = spark.createDataFrame(texts + ordinary, SCHEMA).selectExpr("*", "1 as id", "2 as kind")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.scan_secrets(df).collect()}
    for doc, text in texts:
        assert [s for s in got[doc] if s[1] < 3] == secret_spans(text)
        base = secret_spans(text)
        assert all(not (a < end and start < b) for start, kind, end in got[doc] if kind == 3 for a, _, b in base)
    assert got[802] == [(4, 3, 30)]
    assert got[804] == []
    assert secrets.scan_secrets(docs[1]).count() == len(docs[0])
    assert secrets.scan_secrets(df.limit(0)).count() == 0


def test_urls(spark):
    random.seed(8)
    hosts = ["a.example.net", "example.com", "x.example.com", "free-bets.example.com", "b.org", "NET", "c.org"]
    paths = ["", "/", "/en/{}", "/de/{}.html", "/fr/a/{}", "/fr/b/c/d/e/{}", "/deadbeef12/{}", "/slug-{}/x"]
    urls = [
        random.choice(["http", "https"]) + "://" + random.choice(hosts) + random.choice(paths).format(random.randint(0, 99)) + random.choice(["", "?q=/en/", "#top"])
        for _ in range(1500)
    ]
    urls += [f"http://b.org/w{chr(97 + k % 26)}{chr(97 + k // 26)}/p" for k in range(120)] + [None, "", "no scheme/en", "://", "a://b://c"]
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    # Rare branches, deep paths, segments that look like wildcards, and rows that repeat.
    urls += [f"http://d.org/{random.choice('abcdefgh') * 2}/{random.choice('uvw')}/{'z/' * random.randint(0, 7)}{random.choice('mn')}" for _ in range(300)]
    urls += ["http://d.org/*/x", "http://d.org/*0/x", "http://d.org//*0/x"] + urls[:40]
    labels = [None if random.random() < 0.7 else len(u or "") % 3 == 0 for u in urls]
    rows = [(None if i % 50 == 7 else i, u, label) for i, (u, label) in enumerate(zip(urls, labels, strict=True))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, known boolean").selectExpr("*", "1 as host", "2 as n")
    for label_col, known in (("known", labels), (None, None)):
        found = url_filters.judge_urls(df, rules, label_col=label_col).collect()
        want = url_verdicts(urls, rules, known)
        got = {r.page_id: r for r in found if r.page_id is not None}
        for i in got:
            assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want[i][:4]
            assert got[i].purity == pytest.approx(want[i][4]) and got[i].template == want[i][5]
        nameless = [(r.host, r.path, r.verdict) for r in found if r.page_id is None]
        assert sorted(nameless) == sorted((w[0], w[1], w[3]) for i, w in enumerate(want) if i % 50 == 7)
        assert len({t for *_, t in want}) > (10 if known else 3) and any("/*" in t for *_, t in want)
    assert url_filters.judge_urls(df.limit(0), rules).count() == 0


def test_urls_of_rare_branches(spark):
    """Branches with few of a large host's urls are judged by their own labels, and do not hide in one another."""
    rules = {"h.com/de/": "block", "i.com/zz/": "block"}
    urls = [f"http://h.com/en/{k}" for k in range(9800)] + [f"http://h.com/de/{k}" for k in range(150)]
    urls += [f"http://h.com/fr/{k}" for k in range(50)]
    # More branches than a fiftieth of the host each would allow, one of them bad.
    urls += [f"http://i.com/{a}{b}/{k}" for a in "abcdefgh" for b in "abcdefghijklm" for k in range(20)]
    urls += [f"http://i.com/zz/{k}" for k in range(20)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = [(urls[r.page_id], r) for r in url_filters.judge_urls(df, rules).collect()]
    purity = {(r.host, url.split("/")[3]): r.purity for url, r in got}
    assert len(got) == len(urls)
    assert all(r.verdict == ("block" if r.rule else "allow") for _, r in got)
    assert purity["h.com", "de"] > 0.9 and purity["h.com", "fr"] < 0.1 and purity["h.com", "en"] < 0.1
    assert purity["i.com", "zz"] > 0.7 and purity["i.com", "aa"] < 0.1


def test_urls_of_deep_templates(spark):
    """Templates that differ only far down are judged apart, after any number of shared segments."""
    rules = {"h.com/a/b/c/d/bad/": "block", "i.com/a/b/c/d/e/f/g/bad/": "block"}
    urls = [f"http://{host}{kind}/{k}" for k in range(60) for host in ("h.com/a/b/c/d/", "i.com/a/b/c/d/e/f/g/") for kind in ("bad", "good")]
    urls += [f"http://j.com/{'x/' * 300}{k}" for k in range(3)] + ["http://k.com/a/b", "http://k.com"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = [(urls[r.page_id], r) for r in url_filters.judge_urls(df, rules).collect()]
    assert len(got) == len(urls)
    for url, r in got:
        assert r.verdict == ("block" if "/bad/" in url else "allow")
        if "/bad/" in url:
            assert r.purity > 0.9 and "/bad" in r.template
        if "/good/" in url:
            assert r.purity < 0.3 and "/good" in r.template
    # Where nothing can differ, no level is looked at.
    assert {r.template for url, r in got if "j.com" in url} == {""}


def test_urls_of_a_host_with_many_segments(spark):
    """Children without number are one list of a few bins; bad and good ones become two templates."""
    rules = {f"h.com/bad{chr(97 + i)}": "block" for i in range(20)}
    urls = [f"http://h.com/bad{chr(97 + i % 20)}{chr(97 + i // 20 % 26)}{chr(97 + i // 520)}/x" for i in range(3000)]
    urls += [f"http://h.com/ok{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}/x" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = [(urls[r.page_id], r) for r in url_filters.judge_urls(df, rules).collect()]
    assert {("/bad" in url, r.verdict) for url, r in got} == {(True, "block"), (False, "allow")}
    assert len({r.template for _, r in got}) == 2 and max(r.purity for u, r in got if "/ok" in u) < 0.1


def test_signatures_of_long_texts():
    """Unrelated long texts match in about one of 256 signature values, so their pairs are dropped; near ones stay."""
    random.seed(21)
    word = lambda: "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    texts = [[word() for _ in range(2000)] for _ in range(12)]
    texts += [[word() if k in (500, 900) else w for k, w in enumerate(t)] for t in texts]
    columns = [pa.array(range(24)), pa.array(range(24)), pa.array([" ".join(t).encode() for t in texts], pa.binary())]
    signed = pa.Table.from_batches(near._signed(iter([pa.RecordBatch.from_arrays(columns, ["id", "version", "text"])])))
    values = [np.frombuffer(s, np.uint8) for s in signed.column("signature").to_pylist()]
    unrelated = [(values[a] == values[b]).mean() for a in range(12) for b in range(a)]
    assert np.mean(unrelated) < 3 / 256
    fewest = near.fewest_matches(0.8)
    assert all((values[a][:32] == values[b][:32]).sum() < fewest[32] for a in range(12) for b in range(a))
    assert all((values[a] == values[a + 12]).sum() >= fewest[near.HASHES] for a in range(12))
