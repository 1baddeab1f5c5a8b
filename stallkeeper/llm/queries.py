"""Queries of the training-text operators over the given tables, and SQL where it can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallkeeper import session
from stallkeeper.llm import (
    bpe,
    collocations,
    decontamination,
    divergence,
    fingerprints,
    licenses,
    line_dedup,
    near_duplicates,
    quality,
    secrets,
    token_counts,
    url_filters,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    session.configure(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shared by documents are dropped from all but one of them."""
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents
), keyed as (
    select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key
    from lines
), repeated as (
    select key, min(doc_id) as holder from keyed where length(key) >= 10
    group by key having count(distinct doc_id) >= 2
), judged as (
    select k.*, r.key is not null and r.holder <> k.doc_id as dropped
    from keyed k left join repeated r on k.key = r.key
)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from judged group by doc_id
"""


# The rules that the query is stated with.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every url."""
    return url_filters.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how near they and the next document are."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return fingerprints.neighbour_fingerprints(docs).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded with a word vocabulary."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every text inside windows of benchmark items."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


# Texts that score at least this much are predicted to have label 1.
QUALITY_LINE = 0.3


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every text, learnt from labels of other rows than the held-out ones."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.scored(docs, model, carry=["doc_id"]).select(
        "row.doc_id",
        quality.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_LINE).cast("int").alias("predicted"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, copies and number of links of every document."""
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "class_id", "copy_id", "n_links")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every text."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.scan_licenses(docs).withColumns(
        {"base_labels": F.array_join("base_labels", ","), "labels": F.array_join("labels", ",")}
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of secrets in every text."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.FORMS))

    def of(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{form[0]}") for k, form in enumerate(secrets.FORMS)],
        F.sha2(secrets.spans_text(base), 256).alias("base_sha256"),
        secrets.spans_text(F.col("spans")).alias("spans"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text under a byte-level vocabulary."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to archives and read back; a record that does not read back well is an error."""
    folder = f"{session.shared_dir(spark)}/cuts/{uuid.uuid4().hex}/archives"
    warc.write_archives(table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    records = warc.read_archives(spark, folder, payload=False)

    def sound(column: str) -> Column:
        return F.when(F.col("error").isNull(), F.col(column)).otherwise(F.raise_error(F.col("error")))

    return records.select(
        warc.record_ids("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        sound("record_type").alias("record_type"),
        warc.record_ids("refers_to").cast("long").alias("refers_to"),
    )


OP11_SQL = """
with payloads as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), judged as (
    select *, min(page_id) over (partition by payload_digest) as kept from payloads
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> kept then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> kept then kept end as refers_to
from judged
"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of every language diverge, and in which terms."""
    return divergence.source_divergence(table(spark, sf_dir, "documents", "lang", "source", "text"))


OP12_SQL = r"""
with docs as (
    select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
), words as (
    select doc, lang, source, unnest(terms) as term from docs
), kept as (
    select lang, term, count(*)::hugeint as total from words group by lang, term having count(distinct doc) >= 3
), grouped as (
    select distinct lang, source from docs
), counted as (
    select w.lang, w.source, w.term, count(*)::hugeint as n
    from words w join kept k on w.lang = k.lang and w.term = k.term group by all
), lang_totals as (
    select lang, sum(total)::hugeint as n, count(*)::hugeint as v from kept group by lang
), totals as (
    select g.lang, g.source, coalesce(sum(c.n), 0)::hugeint as n, t.v
    from grouped g join lang_totals t on g.lang = t.lang
    left join counted c on g.lang = c.lang and g.source = c.source group by g.lang, g.source, t.v
), chances as (
    select t.lang, t.source, k.term, coalesce(c.n, 0) as n,
           1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (t.n + t.v) as p,
           1 + (1000000000::hugeint * (k.total + 1)) // (l.n + l.v) as whole
    from totals t join kept k on t.lang = k.lang join lang_totals l on t.lang = l.lang
    left join counted c on t.lang = c.lang and t.source = c.source and k.term = c.term
), sums as (
    select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
    from chances a join chances b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
    from grouped a join grouped b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
), terms as (
    select lang, source, 'term' as part, term as item, (((p - whole) * (p - whole)) // whole)::bigint as value
    from chances where n > 0 and p > whole
)
select * from (
    select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
    from (select * from pairs union all select * from terms)
) where part = 'pair' or rank <= 200
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases of two and three words that belong together, by language."""
    return collocations.collocations(table(spark, sf_dir, "documents", "lang", "text"))


OP13_SQL = r"""
with pieces as (
    select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words
    from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]')) as piece from documents)
), grams as (
    select lang, size, array_to_string(list_slice(words, i, i + size - 1), ' ') as phrase
    from (select lang, words, size, unnest(range(1, len(words) - size + 2)) as i
          from pieces, (values (1), (2), (3)) t(size) where len(words) >= size)
), counts as (
    select lang, size, phrase, count(*) as n from grams group by all having count(*) >= 10
), totals as (
    select lang, count(*) as n from grams where size = 1 group by lang
), candidates as (
    select lang, size, phrase, n as a, string_split(phrase, ' ') as words from counts where size > 1
), cuts as (
    select lang, phrase, a, k, array_to_string(list_slice(words, 1, k), ' ') as head,
           array_to_string(list_slice(words, k + 1, size), ' ') as tail
    from (select *, unnest(range(1, size)) as k from candidates)
), scores as (
    select c.lang, c.phrase, c.a, c.k, h.n as l, t.n as r,
           ((1000000::hugeint * c.a * c.a) // (h.n::hugeint * t.n))::bigint as score
    from cuts c join counts h on h.lang = c.lang and h.phrase = c.head join counts t on t.lang = c.lang and t.phrase = c.tail
), scored as (
    select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_phrases as (
    select lang, phrase, max(a) as longer
    from (select lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) as phrase
          from candidates where size = 3) group by lang, phrase
), kept as (
    select s.* from scored s left join inner_phrases i on s.lang = i.lang and s.phrase = i.phrase
    where i.longer is null or 100 * i.longer < 50 * s.a
)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, k.phrase) as rank,
       k.phrase, a, l, r, t.n, score
from kept k join totals t on k.lang = t.lang qualify rank <= 2000
"""


# Words by the rule that operators 5 and 8 share, as a SQL expression of a column.
WORDS_SQL = r"""regexp_extract_all(
    translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5_SQL = f"""
with docs as (
    select doc_id, {WORDS_SQL.format("text")} as words from documents
), items as (
    select cast(item_id as varchar) as item, {WORDS_SQL.format("text")} as words from benchmark
), starts as (
    select item, words, least(len(words), 13) as size, unnest(range(1, len(words) - least(len(words), 13) + 2)) as i
    from items where len(words) > 0
), windows as (
    select distinct item, size, array_to_string(list_slice(words, i, i + size - 1), ' ') as win from starts
), sizes as (
    select distinct size from windows
), places as (
    select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i
    from docs, sizes where len(words) >= size
), found as (
    select p.doc_id, p.i, p.size, w.item
    from (select *, array_to_string(list_slice(words, i, i + size - 1), ' ') as win from places) p
    join windows w on p.win = w.win and p.size = w.size
), hit as (
    select doc_id, count(distinct pos) as n_hit
    from (select doc_id, unnest(range(i, i + size)) as pos from found) group by doc_id
), named as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names
    from (select distinct doc_id, item from found) group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
       sha256(coalesce(n.names, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.words) as contaminated
from docs d left join hit h on d.doc_id = h.doc_id left join named n on d.doc_id = n.doc_id
"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)


def _sql(value) -> str:
    """A literal of texts, numbers and lists of them."""
    return f"[{', '.join(map(_sql, value))}]" if isinstance(value, (list, tuple)) else repr(value)


_TEMPLATES = licenses.judged_templates(licenses.TEMPLATES, licenses.THRESHOLD, licenses.BLOCK)
_TEMPLATE_ROWS = ",\n".join(
    f"({k}, {_sql(t.label)}, {_sql(t.words)}, {t.need}, {t.block}, {_sql(t.apart)}::varchar[][], {_sql(t.yields_to)}::int[])"
    for k, t in enumerate(_TEMPLATES)
)

OP8_SQL = f"""
with docs as (
    select doc_id, {WORDS_SQL.format("text")} as words from documents
), phrases as (
    select label, string_split(phrase, ' ') as phrase from (values {_values(list(licenses.PHRASES.items()))}) t(phrase, label)
), places as (
    select doc_id, label, i - 1 as pos
    from (select doc_id, words, label, phrase, unnest(range(1, len(words) - len(phrase) + 2)) as i
          from docs, phrases where len(words) >= len(phrase))
    where list_slice(words, i, i + len(phrase) - 1) = phrase
), base as (
    select doc_id, count(*) as n_base, min(pos) as first_word, max(pos) as last_word from places group by doc_id
), templates as (
    select * from (values {_TEMPLATE_ROWS}) t(template, label, words, need, length, apart, yields_to)
), blocks as (
    select doc_id, length, i, list_slice(words, i, i + length - 1) as words
    from (select doc_id, words, length, unnest(range(1, len(words) + 1, length // 2)) as i
          from docs, (select distinct length from templates))
), found as (
    select b.doc_id, b.length, b.i, t.template, t.label, t.yields_to, len(list_intersect(b.words, t.words)) / len(t.words) as share
    from blocks b join templates t on b.length = t.length
    where len(list_intersect(b.words, t.words)) >= t.need
      and len(list_filter(t.apart, lambda x: not list_has_any(x, b.words))) = 0
), matched as (
    select doc_id, label, max(share) as best from found f
    where not exists (from found g where g.doc_id = f.doc_id and g.length = f.length and g.i = f.i and list_contains(f.yields_to, g.template))
    group by doc_id, label
), based as (
    select doc_id, string_agg(label, ',' order by label) as labels from (select distinct doc_id, label from places) group by doc_id
), every as (
    select doc_id, string_agg(label, ',' order by label) as labels
    from (select doc_id, label from places union select doc_id, label from matched) group by doc_id
)
select d.doc_id, len(d.words) as n_words, coalesce(b.n_base, 0) as n_base, b.first_word, b.last_word,
       coalesce(n.labels, '') as base_labels, coalesce(e.labels, '') as labels,
       case when b.n_base > 0 then 1.0::double else coalesce((select max(best) from matched m where m.doc_id = d.doc_id), 0.0) end as score
from docs d left join base b on d.doc_id = b.doc_id left join based n on d.doc_id = n.doc_id left join every e on d.doc_id = e.doc_id
"""


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_url_filters": op2_url_filters,
    "op3_fingerprints": op3_fingerprints,
    "op4_bpe": op4_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_licenses": op8_licenses,
    "op9_secrets": op9_secrets,
    "op10_token_counts": op10_token_counts,
    "op11_warc": op11_warc,
    "op12_source_divergence": op12_source_divergence,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op5_decontamination": OP5_SQL,
    "op8_licenses": OP8_SQL,
    "op11_warc": OP11_SQL,
    "op12_source_divergence": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
