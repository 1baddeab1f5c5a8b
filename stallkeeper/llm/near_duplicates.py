"""Near-duplicate documents: an n-gram Jaccard join with Bayesian pruning of MinHash candidates.

1. Each text becomes its set of word shingles, a MinHash signature and band hashes.  Texts with equal sets
   are one node from here on, however many copies there are.
2. Nodes that share a band meet in its bucket.  Pairs are compared a few signature values at a time and
   dropped once the posterior chance of reaching the threshold falls below a tolerance.  Of what survives,
   edges that connect the same nodes are left out.
3. Connected nodes form components.  Within a component every pair is verified on whole shingle sets.
   Links are counted where they are found; only sums and connecting edges leave a task.

Buckets and components are cut into blocks, and each pair of blocks is a task's unit of work, so no task
holds a whole hot group and no row is written for a pair.  Steps are cut into tables in the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import slices, word_bytes
from stallkeeper.session import Cut, table_cut

SHINGLE = 5
# Similarity that makes a link, as a fraction: exact in whole numbers.
THRESHOLD = (4, 5)
# A pair at the threshold shares no band with a chance of (1 - 0.8 ** 4) ** 32, or 5 in 10 ** 8.
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
# Signature values compared at a time, and the posterior chance below which a pair is dropped.
STEP = 16
TOLERANCE = 1e-9
# Nodes of a bucket's or a component's block.
BUCKET_BLOCK = 2048
GROUP_BLOCK = 1024
COLUMNS_AT_ONCE = 4096
BYTES_AT_ONCE = 1_000_000
REMEMBERED = 500_000

_draw = np.random.default_rng(20)
MULTIPLY = _draw.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
FLIP = _draw.integers(0, 1 << 63, HASHES, dtype=np.uint64)
PLACE = _draw.integers(1, 1 << 63, SHINGLE + BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = digest = xxhash.xxh3_64_intdigest(word)
        return digest


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted hashes of the runs of five words; a text of fewer words, but not none, is one run."""
    words = word_bytes(text)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - SHINGLE + 1, 1)
    sums = np.full(n, min(len(words), SHINGLE), np.uint64)
    for k in range(min(len(words), SHINGLE)):
        sums += hashes[k : k + n] * PLACE[k]
    return np.unique(_mixed(sums))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least values of the set under each hash; the empty set has the largest."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = (shingles[at : at + 512, None] ^ FLIP) * MULTIPLY
        np.minimum(least, part.min(axis=0), out=least)
    return least


def bands(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, BAND_ROWS) * PLACE[SHINGLE:]
    return _mixed(rows.sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        for start, end in slices([n or 0 for n in sizes], BYTES_AT_ONCE):
            if len(_words) > REMEMBERED:
                _words.clear()
            part = batch.slice(start, end - start)
            sets = [shingle_set(t) for t in part.column("text").to_pylist()]
            least = [signature(s) for s in sets]
            spots = np.concatenate([bands(x) for x in least]) if least else np.zeros(0, np.int64)
            # Nodes without words meet nothing.
            ends = np.cumsum([0, *(BANDS if len(s) else 0 for s in sets)], dtype=np.int32)
            spots = spots[np.repeat([len(s) > 0 for s in sets], BANDS)]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("version"),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    # Mixed first: the top bits of a least value are nearly always 0.
                    pa.array([(_mixed(x) & np.uint64(0xFF)).astype(np.uint8).tobytes() for x in least], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(spots)),
                ],
                ["id", "version", "node", "signature", "bands"],
            )


def fewest_matches(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """For each number of compared values, the fewest matches that keep a pair.

    With a flat prior the posterior chance that a pair matches at least as often as one at the threshold is
    the chance of at most that many matches in one more trial at the threshold.
    """
    # Signature values are kept as one byte, which also match by chance, once in 256.
    p = threshold + (1 - threshold) / 256
    out = [0]
    for n in range(1, HASHES + 1):
        chance, m = 0.0, 0
        while True:
            chance += math.comb(n + 1, m) * p**m * (1 - p) ** (n + 1 - m)
            if chance >= tolerance:
                break
            m += 1
        out.append(m)
    return out


def whole_groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``key``, in tables that end where a group ends."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        last = len(held) - _run(held, key)
        if last:
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None and len(held):
        yield held


def _codes(table: pa.Table, key: list[str]) -> np.ndarray:
    """Number of each row's group, counted from 0."""
    new = np.zeros(len(table), bool)
    for name in key:
        column = table.column(name).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
        new[1:] |= pc.not_equal(column.slice(1), column.slice(0, max(len(column) - 1, 0))).to_numpy(zero_copy_only=False)
    return np.cumsum(new)


def _run(table: pa.Table, key: list[str]) -> int:
    """Length of the last group."""
    codes = _codes(table, key)
    return int((codes == codes[-1]).sum()) if len(codes) else 0


class _Forest:
    """Disjoint sets over row numbers; the root is the smallest row."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def join(self, left: np.ndarray, right: np.ndarray) -> None:
        parent = self.parent
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
        self.flatten()

    def flatten(self) -> None:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return
            self.parent = up


BUCKET_KEY = ["band", "low", "high"]


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges that connect what the pairs surviving in each bucket connect."""
    fewest = fewest_matches(THRESHOLD[0] / THRESHOLD[1])
    for table in whole_groups(batches, BUCKET_KEY):
        group = _codes(table, BUCKET_KEY)
        block = table.column("block").to_numpy()
        apart = table.column("low").to_numpy() != table.column("high").to_numpy()
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, HASHES)
        forest = _Forest(len(group))
        left, step = np.arange(len(group)), 0
        while True:
            step += 1
            left = left[left + step < len(group)]
            left = left[group[left] == group[left + step]]
            if not len(left):
                break
            # Blocks that differ are paired across; pairs already connected need no comparison.
            a = left[~apart[left] | (block[left] != block[left + step])]
            a = a[forest.parent[a] != forest.parent[a + step]]
            matches = np.zeros(len(a), np.int64)
            for at in range(0, HASHES, STEP):
                if not len(a):
                    break
                matches += (values[a, at : at + STEP] == values[a + step, at : at + STEP]).sum(axis=1)
                keep = matches >= fewest[at + STEP]
                a, matches = a[keep], matches[keep]
            if len(a):
                forest.join(a, a + step)
        child = np.flatnonzero(forest.parent != np.arange(len(group)))
        nodes = table.column("node").combine_chunks()
        if len(child):
            yield pa.RecordBatch.from_arrays(
                [_take(nodes, child), _take(nodes, forest.parent[child])], ["a", "b"]
            )


def _take(column: pa.Array | pa.ChunkedArray, at: np.ndarray) -> pa.Array:
    taken = column.take(pa.array(at))
    return pa.concat_arrays(taken.chunks) if isinstance(taken, pa.ChunkedArray) else taken


GROUP_KEY = ["component", "low", "high"]


def linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs of sets reach the threshold, from exact sizes of their intersections."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    column = np.cumsum(first) - 1
    # A shingle that one set alone holds is in no intersection.
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1 if len(column) else column
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS_AT_ONCE):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS_AT_ONCE])
        held = np.zeros((len(sets), min(COLUMNS_AT_ONCE, int(column[hi - 1]) - at + 1)), np.float32)
        held[owner[lo:hi], column[lo:hi] - at] = 1
        common += held @ held.T
    both = common.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    out = both * THRESHOLD[1] >= union * THRESHOLD[0]
    np.fill_diagonal(out, False)
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, documents linked in this pair of blocks, smallest node connected here)."""
    for table in whole_groups(batches, GROUP_KEY):
        codes = _codes(table, GROUP_KEY)
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        for start, end in zip(starts, [*starts[1:], len(codes)], strict=True):
            rows = table.slice(start, end - start).to_pylist()
            rows = list({r["node"]: r for r in rows}.values())  # a row that repeats is the same node
            if len(_words) > REMEMBERED:
                _words.clear()
            link = linked([shingle_set(r["text"]) for r in rows])
            block = np.array([r["block"] for r in rows])
            if rows[0]["low"] != rows[0]["high"]:
                link &= block[:, None] != block[None, :]
            copies = np.array([r["copies"] for r in rows], np.int64)
            forest = _Forest(len(rows))
            a, b = np.nonzero(np.triu(link))
            for row in np.unique(a):  # one row's links at a time, those that still connect something
                to = b[a == row]
                to = to[forest.parent[to] != forest.parent[row]]
                forest.join(np.full(len(to), row), to)
            nodes = [r["node"] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.binary()),
                    pa.array(link @ copies, pa.int64()),
                    pa.array([nodes[k] for k in forest.parent], pa.binary()),
                ],
                ["node", "linked", "root"],
            )


def connected(edges: DataFrame, cut: Cut, name: str) -> DataFrame:
    """(node, component) of every node on an edge (a, b); the component is its smallest node.

    Labels spread along edges and then jump to the label's own label, so paths shorten fast.  Nothing is
    collected but whether a round changed anything.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    # A node keeps its edge to the smallest neighbour below it; the others below it are tied to that one instead.
    # Nodes of a large class mostly share those, so few edges are left to go around.
    nearest = edges.join(edges.groupBy("a").agg(F.min("b").alias("least")), "a")
    tied = nearest.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    edges = nearest.select("a", F.col("least").alias("b")).union(tied).distinct()
    both = cut(edges.union(edges.select("b", "a")), f"{name}_edges")
    labels = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = cut(labels.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), f"{name}_0")
    for round_number in range(1, 1_000):
        spread = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy("b").agg(F.min("component").alias("near"))
        nearer = labels.join(spread.withColumnRenamed("b", "node"), "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("near")
        )
        above = labels.select(F.col("node").alias("near"), F.col("component").alias("top"))
        jumped = nearer.join(above, "near").select("node", "before", F.least("near", "top").alias("component"))
        jumped = cut(jumped, f"{name}_{round_number}")
        labels = jumped.select("node", "component")
        if jumped.where("before <> component").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def _blocks(rows: DataFrame, size: Column, block: int, node: Column) -> DataFrame:
    """Each row once for each pair of blocks that its own block is in."""
    n = F.ceil(size / block).cast("int")
    own = F.pmod(F.xxhash64(node), n).cast("int")
    return (
        rows.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .drop("other")
    )


def _in_groups(rows: DataFrame, key: list[str], work: Callable, schema: str) -> DataFrame:
    """Groups one after another, each in the order of its nodes: buckets of one class then agree on its root."""
    return rows.repartition(*key).sortWithinPartitions(*key, "node").mapInArrow(work, schema)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: Cut | None = None
) -> DataFrame:
    """(id, version, class_id, copy_id, n_links, keeper) of every row of ``docs``.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more;
    those with equal sets are copies.  ``class_id`` is the smallest id connected by links, ``copy_id`` the
    smallest of the copies, ``n_links`` the number of other rows linked to this one.  ``version`` is
    xxhash64 of the text; ``keeper`` is true for the class's first (id, version).

    - Null or empty texts, and those without words, are copies of one another and linked to nothing else.
    - Null ids are carried: such rows have links, but name a class only if it has no other id (then null).
    - Rows that repeat are copies; no rows give no rows; other columns of ``docs`` are not looked at.
    """
    cut = cut or table_cut(docs.sparkSession)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), F.xxhash64(text).alias("version"), text.cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = rows.mapInArrow(
        _signed, f"id {kind}, version bigint, node binary, signature binary, bands array<bigint>"
    )
    signed = cut(signed, "signed")

    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "version"))
    nodes = cut(
        signed.groupBy("node").agg(
            first.alias("first"),
            F.count("*").alias("copies"),
            F.first("signature").alias("signature"),
            F.first("bands").alias("bands"),
        ),
        "nodes",
    )

    spots = nodes.select("node", F.explode("bands").alias("band"))
    shared = cut(spots.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    met = spots.join(shared, "band").join(nodes.select("node", "signature"), "node")
    met = _blocks(met, F.col("size"), BUCKET_BLOCK, F.col("node")).select(*BUCKET_KEY, "block", "node", "signature")
    edges = cut(_in_groups(met, BUCKET_KEY, _pruned, "a binary, b binary").distinct(), "edges")
    components = connected(edges, cut, "near")

    sizes = cut(components.groupBy("component").agg(F.count("*").alias("size")), "sizes")
    wanted = components.join(sizes, "component").join(nodes.select("node", "first", "copies"), "node")
    wanted = cut(wanted.select("component", "size", "node", "copies", "first.id", "first.version"), "wanted")
    # Merged at every size: what is wanted grows with the corpus.
    chosen = rows.join(
        wanted.withColumnsRenamed({"id": "of", "version": "of_version"}).hint("merge"),
        F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version")),
    )
    chosen = _blocks(chosen, F.col("size"), GROUP_BLOCK, F.col("node"))
    chosen = chosen.select(*GROUP_KEY, "block", "node", "copies", "text")
    found = cut(_in_groups(chosen, GROUP_KEY, _verified, "node binary, linked bigint, root binary"), "links")
    roots = connected(found.select(F.col("node").alias("a"), F.col("root").alias("b")), cut, "linked")
    degrees = found.groupBy("node").agg(F.sum("linked").alias("linked"))

    named = (
        nodes.select("node", "first", "copies")
        .join(degrees, "node", "left")
        .join(roots, "node", "left")
        .select(
            "node",
            F.coalesce("component", "node").alias("root"),
            F.col("first.id").alias("copy_id"),
            "first",
            (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        )
    )
    heads = named.groupBy("root").agg(F.min("first").alias("head"))
    named = cut(named.join(heads, "root").select("node", "copy_id", "head", "n_links"), "classes")
    own = F.struct(F.col("id").isNull().alias("unnamed"), "id", "version")
    return signed.select("id", "version", "node").join(named, "node").select(
        F.col("id").alias(id_col),
        "version",
        F.col("head.id").alias("class_id"),
        "copy_id",
        "n_links",
        own.eqNullSafe(F.col("head")).alias("keeper"),
    )
