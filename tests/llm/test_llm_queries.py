"""Registered queries against SQL or plain versions, over a whole small table."""

from __future__ import annotations

import os

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from plain_versions import contamination, line_dedup, near_duplicates, secret_spans, sha, url_verdicts, words
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from check_oracles import TABLES, rows_of
from stallkeeper.llm import queries, quality, secrets

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def texts():
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] for r in table}


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: entry.queries()[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = entry.queries()[name](spark, SF_DIR)
    cursor = con.execute(entry.oracle_sql()[name])
    want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_operator_is_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names


def test_urls(run):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet", columns=["page_id", "url"]).to_pylist()
    want = url_verdicts([p["url"] for p in pages], queries.URL_RULES)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.template) for r in run("op2_url_filters")}
    assert got == {p["page_id"]: (*w[:4], w[5]) for p, w in zip(pages, want, strict=True)}


def test_fingerprints(run, texts):
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in run("op3_fingerprints")}
    assert set(rows) == set(texts)
    for doc, after in zip(order, order[1:] + order[:1], strict=True):
        text = texts[doc]
        cut = len(text) // 3
        assert rows[doc].n_chars == len(text)
        assert rows[doc].edited_sha256 == sha(text[: len(text) - cut] + texts[after][:cut])
    prints = {}
    assert all(prints.setdefault(texts[d], r.fingerprint) == r.fingerprint for d, r in rows.items())
    nearer = sum(r.near_edited > r.near_next for r in rows.values())
    assert nearer >= 0.95 * len(rows)


def test_encoding(run, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in run("op4_bpe"):
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_counts(run, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in run("op10_token_counts"):
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_quality_on_held_out_rows(spark):
    sf = SF_DIR.replace("sf0.001", "sf0.01")
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = [r for r in entry.queries()["op6_quality"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    good = [r.score for r in rows if labels[r.doc_id] == 1]
    bad = [r.score for r in rows if labels[r.doc_id] == 0]
    assert good and bad
    assert sum(g > b for g in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def test_near_duplicates(run, texts):
    got = {r.doc_id: (r.class_id, r.n_links) for r in run("op7_near_duplicates")}
    assert got == near_duplicates(list(texts.items()))


def test_secrets(run, texts):
    names = [form[0] for form in secrets.FORMS]
    for r in run("op9_secrets"):
        spans = secret_spans(texts[r.doc_id])
        assert r.base_sha256 == sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert {f"{names[k]}:{a}:{b}" for a, k, b in spans} <= set(r.spans.split(","))


def test_pipeline(spark, texts, tmp_path):
    """Every stage on its own input against the plain versions."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / name))
        held[name] = docs, spark.read.parquet(str(tmp_path / name))
        docs = held[name][1]
        if name != "bpe":
            assert docs.columns == columns

    def rows(name, side):
        return {r.doc_id: r.text for r in held[name][side].collect()}

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    given = held["quality"][0]
    scored = quality.scored(given, quality.train(given, labels.select("doc_id", "quality")))
    accepted = {r.row.doc_id for r in scored.collect() if r.score >= corpus_pipeline.QUALITY_LINE}
    assert set(rows("quality", 1)) == accepted
    before = list(rows("line_dedup", 0).items())
    assert rows("line_dedup", 1) == {d: x[0] for (d, _), x in zip(before, line_dedup(before), strict=True)}
    assert all(r.n_chars == len(r.text) for r in held["line_dedup"][1].collect())
    classes = near_duplicates(list(rows("near_duplicates", 0).items()))
    assert set(rows("near_duplicates", 1)) == {c for c, _ in classes.values()}
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()]
    before = rows("decontamination", 0)
    found = dict(zip(before, contamination(list(before.values()), items), strict=True))
    after = rows("decontamination", 1)
    assert set(after) == {d for d, (n, hit, _) in found.items() if not (hit and 20 * hit >= n)}
    # What stays holds no window of 13 words any more; where there was none, the text is as it was.
    again = dict(zip(after, contamination(list(after.values()), [i for i in items if len(words(i[1])) >= 13]), strict=True))
    assert not any(hit for _, hit, _ in again.values())
    assert all(after[d] == before[d] for d in after if not found[d][1])
    assert all(r.n_chars == len(r.text) for r in held["decontamination"][1].collect())
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before = rows("bpe", 0)
    got = {r.doc_id: list(r.ids) for r in held["bpe"][1].collect()}
    assert got == {d: library.encode(t, add_special_tokens=False).ids for d, t in before.items()}


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and empty tables pass every stage."""
    odd = [(1, "some text", None, None, None), (1, "some text", None, None, None), (None, None, "en", "s", 4), (2, "", "en", "s", 0)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(1, "benchmark words " * 9)], "item_id int, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for name, rows, want in (("odd", odd, 2), ("none", [], 0)):
        # Columns of one's own pass through the stages, whatever their names.
        own = {"n_lines": "7", "n_dropped": "'x'", "row": "8", "spans": "9", "cleaned": "'y'", "score": "0.5"}
        docs = spark.createDataFrame(rows, schema).withColumns({c: F.expr(v) for c, v in own.items()})
        for stage_name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / name / stage_name)
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            if stage_name != "bpe":
                assert docs.columns[5:] == list(own)
                assert {tuple(map(str, r)) for r in docs.select(*own).collect()} <= {("7", "x", "8", "9", "y", "0.5")}
        assert docs.count() == want
