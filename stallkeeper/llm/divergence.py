"""How far the sources of a language diverge in their words, over a vocabulary of transducers.

The first pass over the texts counts in how many documents a term is.  The terms that stay are sorted
over all tasks, and every run of so many becomes a minimal acyclic transducer; runs are numbered one
after the other, so ordinals follow the order of terms.  The second pass counts the terms of each text
again: they are dealt to the run they would belong to, and stream through its transducer, which drops
those not kept and turns the others into ordinals.  Tasks combine counts first, so a term or a source
with a third of all words arrives as one row per task and source.  From there on all is integers:
blocks of ordinals become dense tables of terms and sources, whose sums of divergence are merged.

On the driver are one row per source and one per run of the vocabulary, no terms.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallkeeper.llm.text import Bytes, CutTexts, cut_texts, slices
from stallkeeper.llm.transducer import Builder, Transducer
from stallkeeper.session import Cut, table_cut

# What p is counted in, documents that a kept term is in, and ranks reported.
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200

# A run of the vocabulary: so many terms, or so many bytes of them.
RUN_TERMS, RUN_BYTES = 50_000, 4 << 20
# Rows of a run are dealt to so many tasks, each with the run's transducer.
SALTS = 4
# Texts cut into terms at once; their counts are combined before they are passed on.
BYTES_AT_ONCE = 6 << 20
# Cells of a dense table, and its ordinals at most; cells of summed divergences held.
CELLS, BLOCK, HELD_CELLS = 1 << 20, 4096, 4 << 20

# On UTF-8 bytes: ASCII letters and all that is beyond ASCII belong to terms.
TERMS = Bytes(lambda b: 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, CutTexts]]:
    """Rows, a bounded part of their texts at a time, and the terms of these texts."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for start, end in slices([n or 0 for n in sizes], BYTES_AT_ONCE):
            part = batch.slice(start, end - start)
            yield part, cut_texts(part.column("text"), TERMS)


def _numbered(values: pa.Array) -> tuple[list, np.ndarray]:
    """Distinct values, and the place of each row's among them."""
    coded = values.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def _columns(rows: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(rows.values()), list(rows))


# ---- the vocabulary


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, n): documents among some of the task's that hold a term."""
    for part, cut in _cut(batches):
        size = len(cut.words)
        in_docs = np.unique(cut.doc * size + cut.number)
        langs, of_doc = _numbered(part.column("lang"))
        keys, counts = np.unique(of_doc[in_docs // size] * size + in_docs % size, return_counts=True) if size else (in_docs, in_docs)
        yield _columns(
            {
                "lang": pa.array(langs, pa.string()).take(pa.array(keys // max(size, 1))),
                "term": cut.words.take(pa.array(keys % max(size, 1))).cast(pa.string()),
                "n": pa.array(counts, pa.int64()),
            }
        )


def _runs(run_terms: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted (lang, term) to runs: lang, first, terms and their transducer."""

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms, size = None, [], 0

        def run() -> pa.RecordBatch:
            builder = Builder()
            for term in terms:
                builder.add(term.encode())
            return _columns(
                {
                    "lang": pa.array([lang], pa.string()),
                    "first": pa.array(terms[:1], pa.string()),
                    "terms": pa.array([terms], pa.list_(pa.string())),
                    "transducer": pa.array([builder.finish()], pa.binary()),
                }
            )

        for batch in batches:
            for new, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                if terms and (new != lang or len(terms) == run_terms or size > RUN_BYTES):
                    yield run()
                    terms, size = [], 0
                lang = new
                terms.append(term)
                size += len(term)
        if terms:
            yield run()

    return built


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS, run_terms: int = RUN_TERMS) -> DataFrame:
    """Runs of the kept terms, from (lang, text) with texts as bytes: lang, first, terms, transducer."""
    counted = docs.mapInArrow(_document_counts, "lang string, term string, n bigint")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    ordered = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    return ordered.mapInArrow(_runs(run_terms), "lang string, first string, terms array<string>, transducer binary")


# ---- recounting


def _packed(columns: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = _columns(columns)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(content: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(content).read_next_batch()


def _group_counts(
    group_of: dict[tuple[str, str], int], runs_of: dict[str, tuple[int, list[bytes]]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(run, salt, terms, counts): terms of some texts, dealt to the run that they would be in.

    ``terms`` has each term once, ``counts`` its number there with a group and its occurrences.
    """

    def of_lang(lang: str, words: pa.Array, word: np.ndarray, group: np.ndarray, n: np.ndarray, turn: int) -> Iterator[tuple]:
        """Rows for the counts of one language, sorted by word."""
        start, firsts = runs_of[lang]
        used, place = np.unique(word, return_inverse=True)
        terms = words.take(pa.array(used))
        # Terms before the first run belong to none; they are not kept.
        run = np.array([bisect_right(firsts, t) for t in terms.to_pylist()], np.int64) - 1
        order = np.argsort(run, kind="stable")
        ranked = np.empty(len(order), np.int64)
        ranked[order] = np.arange(len(order))
        place = ranked[place]
        by_place = np.argsort(place, kind="stable")
        place, group, n = place[by_place], group[by_place], n[by_place]
        run, terms = run[order], terms.take(pa.array(order))
        for a, b in _borders(run):
            if run[a] >= 0:
                c, d = np.searchsorted(place, [a, b])
                counts = {"term": pa.array((place[c:d] - a).astype(np.int32)), "group": pa.array(group[c:d].astype(np.int32)), "n": pa.array(n[c:d])}
                yield start + int(run[a]), turn % SALTS, _packed({"term": terms.slice(a, b - a)}), _packed(counts)

    # Groups are sorted by language, so a language's are next to each other.
    members: dict[str, list[int]] = {}
    for (lang, _), group in group_of.items():
        if lang in runs_of:
            members.setdefault(lang, []).append(group)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for turn, (part, cut) in enumerate(_cut(batches)):
            size = max(len(cut.words), 1)
            names = zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)
            of_doc = np.array([group_of[name] for name in names], np.int64)
            keys, counts = np.unique(of_doc[cut.doc] * size + cut.number, return_counts=True)
            rows = []
            for lang, groups in members.items():
                a, b = np.searchsorted(keys, [groups[0] * size, (groups[-1] + 1) * size])
                if a < b:
                    rows += of_lang(lang, cut.words, keys[a:b] % size, keys[a:b] // size, counts[a:b], turn)
            run, salt, terms, packed = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield _columns(
                {
                    "run": pa.array(run, pa.int32()),
                    "salt": pa.array(salt, pa.int32()),
                    "terms": pa.array(terms, pa.binary()),
                    "counts": pa.array(packed, pa.binary()),
                    "transducer": pa.nulls(len(run), pa.binary()),
                }
            )

    return counted


def _through(starts: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a run, its transducer first, to (group, ord, n) of the terms that it knows."""

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_run = None, None
        for batch in batches:
            for run, transducer, terms, counts in zip(*[batch.column(c) for c in ("run", "transducer", "terms", "counts")], strict=True):
                if transducer.is_valid:
                    known, known_run = Transducer(transducer.as_py()), run.as_py()
                    continue
                assert known_run == run.as_py(), "a run without its transducer"
                words = _unpacked(terms.as_py()).column("term")
                offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
                data = np.frombuffer(words.buffers()[2], np.uint8)
                held = _unpacked(counts.as_py())
                places = known.ordinals(data, offsets[:-1], offsets[1:])[held.column("term").to_numpy()]
                kept = pa.array(places >= 0)
                rows = {"group": held.column("group"), "ord": pa.array(places + starts[known_run]), "n": held.column("n")}
                yield _columns(rows).filter(kept)

    return streamed


def _borders(*keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with equal keys."""
    changes = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
    borders = [0, *changes.tolist(), len(keys[0])]
    yield from ((a, b) for a, b in zip(borders, borders[1:], strict=False) if a < b)


def recounted(docs: DataFrame, runs: DataFrame, groups: list[tuple[str, str]], index: list[tuple]) -> DataFrame:
    """(group, ord, n) of every kept term in every group, from (lang, source, text).

    ``index`` lists (run, lang, first, start): the runs in order, and the ordinal each starts with.
    """
    spark = docs.sparkSession
    runs_of: dict[str, tuple[int, list[bytes]]] = {}
    for run, lang, first, _ in index:
        runs_of.setdefault(lang, (run, []))[1].append(first.encode())
    schema = "run int, salt int, terms binary, counts binary, transducer binary"
    counts = docs.mapInArrow(_group_counts({g: k for k, g in enumerate(groups)}, runs_of), schema)
    numbered = spark.createDataFrame([(r, lang, first) for r, lang, first, _ in index], "run int, lang string, first string")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    held = runs.select("lang", "first", "transducer").join(numbered, ["lang", "first"])
    none = [F.lit(None).cast("binary").alias(c) for c in ("terms", "counts")]
    dealt = counts.unionByName(held.select("run", salts, *none, "transducer"))
    dealt = dealt.repartition("run", "salt").sortWithinPartitions("run", "salt", F.col("transducer").isNull())
    found = dealt.mapInArrow(_through([start for *_, start in index]), "group int, ord bigint, n bigint")
    return found.groupBy("group", "ord").agg(F.sum("n").alias("n"))


# ---- divergence


def scaled(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact for totals below 9 * 10**15: three digits at a time."""
    rest, out = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        digits = rest // total
        out, rest = out * 1000 + digits, rest - digits * total
    return out + 1


def diverged(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); p and q are below 10**9 + 2, so the square is exact."""
    d = p - q
    return d * d // q


def _blocks(
    lang_of: list[int], groups_of: list[list[int]], totals: list[int], lang_totals: list[int], block: int, top: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts sorted by (lang, block) to sums of divergence (pair) and leading terms (not pair)."""
    place_of = {g: k for members in groups_of for k, g in enumerate(members)}

    def out(group, item, value, pair: bool) -> pa.RecordBatch:
        n = len(item)
        return _columns(
            {
                "group": pa.array(np.broadcast_to(np.asarray(group, np.int32), n)),
                "item": pa.array(np.asarray(item, np.int64)),
                "value": pa.array(value, pa.int64()),
                "pair": pa.array([pair] * n, pa.bool_()),
            }
        )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # by group: summed divergence from each group of its language

        def flushed() -> Iterator[pa.RecordBatch]:
            for group, values in sums.items():
                yield out(group, groups_of[lang_of[group]], values, True)
            sums.clear()

        def settled(lang: int, group: np.ndarray, item: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            members = groups_of[lang]
            items, row = np.unique(item, return_inverse=True)
            column = np.array([place_of[g] for g in group.tolist()])
            counts = np.zeros((len(items), len(members)), np.int64)
            counts[row, column] = n
            p = np.stack([scaled(counts[:, k], totals[g]) for k, g in enumerate(members)], axis=1)
            whole = scaled(counts.sum(axis=1), lang_totals[lang])
            for k, g in enumerate(members):
                values = diverged(p[:, k : k + 1], p).sum(axis=0)
                sums[g] = sums[g] + values if g in sums else values
                if len(sums) * len(members) > HELD_CELLS:
                    yield from flushed()
                typical = np.flatnonzero((counts[:, k] > 0) & (p[:, k] > whole))
                values = diverged(p[typical, k], whole[typical])
                # Within a block, what is not among the first cannot be among them in the whole.
                first = np.lexsort((items[typical], -values))[:top]
                if len(first):
                    yield out(g, items[typical][first], values[first], False)

        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("lang", "block", "group", "ord", "n")]
            for a, b in _borders(columns[0], columns[1]):
                new = columns[0][a], columns[1][a]
                if held and new != key:
                    yield from settled(int(key[0]), *[np.concatenate(x) for x in zip(*held, strict=True)])
                    held = []
                key = new
                held.append([c[a:b] for c in columns[2:]])
        if held:
            yield from settled(int(key[0]), *[np.concatenate(x) for x in zip(*held, strict=True)])
        yield from flushed()

    return summed


def source_divergence(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    run_terms: int = RUN_TERMS,
    cut: Cut | None = None,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others, and in which terms.

    With p = 1 + floor(10**9 * (count + 1) / (N + V)) of a kept term in a source or in the language, part
    ``pair`` has floor((p - q)^2 / q) summed over the V kept terms for every other source of the
    language, and part ``term`` that of the source's terms with p above the language's, the ``top`` first.

    - Null lang, source and text are empty; an empty lang or source is a group like others.
    - A row is a document: repeated rows count each.  No rows: no rows.
    - A language without kept terms has pairs of value 0 and no terms; one with one source has no pairs.
    - Ties: the item that is smaller in byte order first.  Other columns are not looked at.

    The sources are collected to the driver; the result has a row for every pair of a language's.
    """
    spark, cut = docs.sparkSession, cut or table_cut(docs.sparkSession)
    lang, source = (F.coalesce(docs[c].cast("string"), F.lit("")) for c in (lang_col, source_col))
    rows = docs.select(lang.alias("lang"), source.alias("source"), docs[text_col].cast("binary").alias("text"))
    groups = sorted(((r.lang, r.source) for r in rows.select("lang", "source").distinct().collect()), key=_in_bytes)

    runs = cut(vocabulary(rows.select("lang", "text"), min_docs, run_terms), "vocabulary")
    sizes = runs.select("lang", "first", F.size("terms").alias("n")).collect()
    index, start, kept = [], 0, Counter()
    for run, r in enumerate(sorted(sizes, key=lambda r: _in_bytes((r.lang, r.first)))):
        index.append((run, r.lang, r.first, start))
        start += r.n
        kept[r.lang] += r.n
    counts = cut(recounted(rows, runs, groups, index), "recounted")

    langs = sorted({lang for lang, _ in groups}, key=str.encode)
    lang_of = [langs.index(lang) for lang, _ in groups]
    groups_of = [[g for g, k in enumerate(lang_of) if k == lang] for lang in range(len(langs))]
    n_of = {r.group: r.n for r in counts.groupBy("group").agg(F.sum("n").alias("n")).collect()}
    n_kept = [kept[lang] for lang in langs]
    # A language without kept terms has no blocks, so what its totals are does not matter.
    totals = [n_of.get(g, 0) + n_kept[lang_of[g]] for g in range(len(groups))]
    lang_totals = [sum(n_of.get(g, 0) for g in members) + n_kept[k] for k, members in enumerate(groups_of)]
    widest = max(map(len, groups_of), default=1)
    block = max(1, min(BLOCK, CELLS // widest))

    group_schema = "group int, lang string, source string, lang_no int"
    named = spark.createDataFrame([(g, *x, lang_of[g]) for g, x in enumerate(groups)], group_schema)
    lang_no = F.get(F.lit(lang_of).cast("array<int>"), F.col("group"))
    blocked = counts.select(lang_no.alias("lang"), F.expr(f"ord div {block}").alias("block"), "group", "ord", "n")
    blocked = blocked.repartition("lang", "block").sortWithinPartitions("lang", "block")
    summed = _blocks(lang_of, groups_of, totals, lang_totals, block, top)
    found = cut(blocked.mapInArrow(summed, "group int, item bigint, value bigint, pair boolean"), "divergence")
    return _pairs(named, found).unionByName(_leading(named, found, runs, index, spark, top))


def _in_bytes(names: tuple[str, str]) -> tuple[bytes, bytes]:
    return names[0].encode(), names[1].encode()


def _pairs(named: DataFrame, found: DataFrame) -> DataFrame:
    sums = found.where("pair").groupBy("group", "item").agg(F.sum("value").alias("value"))
    other = named.select(F.col("group").alias("item"), F.col("source").alias("other"), "lang_no")
    every = named.join(other, "lang_no").where("group <> item").join(sums, ["group", "item"], "left")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return every.select("lang", "source", "item", "other", F.coalesce("value", F.lit(0)).alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", F.row_number().over(order).alias("rank")
    )


def _leading(named: DataFrame, found: DataFrame, runs: DataFrame, index: list[tuple], spark: SparkSession, top: int) -> DataFrame:
    """The first terms of each source; ordinals break ties, and become terms at the end."""
    order = Window.partitionBy("group").orderBy(F.desc("value"), "item")
    first = found.where("not pair").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    starts = spark.createDataFrame([(lang, first, start) for _, lang, first, start in index], "lang string, first string, start bigint")
    words = runs.select("lang", "first", F.posexplode("terms").alias("at", "term")).join(starts, ["lang", "first"])
    words = words.select((F.col("start") + F.col("at")).alias("item"), "term")
    return first.join(words, "item").join(named, "group").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )
