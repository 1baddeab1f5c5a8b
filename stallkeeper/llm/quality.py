"""Quality scores from a factorisation machine over hashed words and the structure of a text.

The score is a constant, a weight for each feature and, for each pair of features, the product of their
low-rank vectors.  Half of (square of the sum less sum of the squares) gives all pair terms at once, so
scoring takes time linear in the number of features.  Features are hashed words (weights by their
counts, of length one together) and one indicator for the quantile bin of each structure number.

The model is fitted in one task on a bounded, hash-chosen sample of labelled rows; its size is fixed by
the parameters.  Scoring is one narrow pass over whole texts.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import carried, carried_texts, slices, word_bytes

# Size of the model: word buckets, length of the pair vectors, bins of each structure number.
BUCKETS = 1 << 16
RANK = 8
BINS = 16
# Most labelled rows that the model is fitted on.
MAX_TRAIN = 10_000
EPOCHS = 6
BATCH = 64
RATE = 0.1
PULL = 1e-5
BYTES_AT_ONCE = 3_000_000
REMEMBERED = 200_000

# Kinds of bytes whose shares are structure numbers.
KINDS = [
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t\r\n",
    b".,;:!?'\"-",
    b"#$%&*+=@^~_`\\/<>{}[]()",
    b"|",
    bytes(range(0x80, 0x100)),
]
KIND_OF = np.stack([np.isin(np.arange(256), np.frombuffer(k, np.uint8)) for k in KINDS], axis=1).astype(np.float64)
STATS = len(KINDS) + 9


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = bucket = zlib.crc32(word) % BUCKETS
        return bucket


_buckets = _Buckets()


class Features:
    """Word entries of several texts, row after row, and a table of their structure numbers."""

    def __init__(self, texts: list[bytes | None]):
        if len(_buckets) > REMEMBERED:
            _buckets.clear()
        words = [word_bytes(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        flat = np.fromiter((b for row in words for b in map(_buckets.__getitem__, row)), np.int64, int(sizes.sum()))
        keys, counts = np.unique(np.repeat(np.arange(len(texts)), sizes) * BUCKETS + flat, return_counts=True)
        self.rows, self.buckets = keys // BUCKETS, keys % BUCKETS
        weights = 1 + np.log(counts)
        length = np.sqrt(np.bincount(self.rows, weights * weights, len(texts)))
        self.values = (weights / length[self.rows] if len(keys) else weights).astype(np.float32)
        distinct = np.bincount(self.rows, minlength=len(texts))
        most = np.zeros(len(texts))
        np.maximum.at(most, self.rows, counts)
        ends = np.cumsum(sizes)[:-1]
        twice = np.r_[False, flat[1:] == flat[:-1]]
        twice[ends[ends < len(flat)]] = False
        doubled = np.bincount(np.repeat(np.arange(len(texts)), sizes), twice[: len(flat)], len(texts))
        self.stats = np.array(
            [self._structure(t or b"", *x) for t, *x in zip(texts, sizes, distinct, most, doubled, strict=True)]
        ).reshape(len(texts), STATS)

    @staticmethod
    def _structure(text: bytes, n_words: int, distinct: int, most: float, doubled: float) -> np.ndarray:
        size = max(len(text), 1)
        lines = text.split(b"\n")
        shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ KIND_OF / size
        words = max(n_words, 1)
        others = [
            np.log1p(len(text)),
            np.log1p(n_words),
            np.log1p(len(lines)),
            1 - len(set(lines)) / len(lines),
            len(text) / len(lines),
            distinct / words,
            most / words,
            doubled / words,
            size / words,
        ]
        return np.r_[shares, others]


class Model:
    """Weights of the machine; ``edges`` are the bin limits of the structure numbers."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray, edges: np.ndarray):
        self.bias, self.weights, self.vectors, self.edges = bias, weights, vectors, edges

    def entries(self, features: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) of words and of structure bins, ordered by row."""
        n = len(features.stats)
        bins = np.stack(
            [np.searchsorted(self.edges[k], features.stats[:, k], side="right") for k in range(STATS)], axis=1
        ).reshape(n, STATS)
        bins = BUCKETS + np.arange(STATS) * BINS + bins
        rows = np.r_[features.rows, np.repeat(np.arange(n), STATS)]
        order = np.argsort(rows, kind="stable")
        columns = np.r_[features.buckets, bins.ravel()].astype(np.int32)
        values = np.r_[features.values, np.ones(n * STATS, np.float32)]
        return rows[order], columns[order], values[order]

    def score(self, features: Features) -> np.ndarray:
        rows, columns, values = self.entries(features)
        return _chance(self._raw(rows, columns, values, len(features.stats))[0])

    def _raw(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores and the summed vectors; every row has entries and rows are in order."""
        if not n:
            return np.zeros(0), np.zeros((0, RANK))
        starts = np.searchsorted(rows, np.arange(n))
        scaled = self.vectors[columns] * values[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), starts)
        linear = np.add.reduceat(self.weights[columns] * values, starts)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(
            out,
            bias=np.float64(self.bias),
            weights=self.weights.astype(np.float32),
            vectors=self.vectors.astype(np.float32),
            edges=self.edges,
        )
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Model:
        held = np.load(io.BytesIO(data))
        weights, vectors = held["weights"].astype(np.float64), held["vectors"].astype(np.float64)
        return Model(float(held["bias"]), weights, vectors, held["edges"])


def _chance(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fitted(texts: list[bytes | None], labels: np.ndarray) -> Model:
    """A model of 0/1 labels; with one class or no rows it is the smoothed share of label 1."""
    # Features of a few texts at a time: only their entries are kept.
    parts = [Features(texts[a:b]) for a, b in slices([len(t or b"") for t in texts], BYTES_AT_ONCE)]
    stats = np.concatenate([p.stats for p in parts]) if parts else np.zeros((0, STATS))
    size = BUCKETS + STATS * BINS
    draw = np.random.default_rng(7)
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(stats, cuts, axis=0).T if len(texts) else np.zeros((STATS, BINS - 1))
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, RANK)), edges)
    if len(set(labels.tolist())) < 2:
        return model
    model.vectors = draw.normal(0, 0.05, (size, RANK))
    entries = [model.entries(p) for p in parts]
    columns, values = (np.concatenate([e[k] for e in entries]) for k in (1, 2))
    sizes = [np.bincount(e[0], minlength=len(p.stats)) for e, p in zip(entries, parts, strict=True)]
    starts = np.r_[0, np.cumsum(np.concatenate(sizes))]
    del parts, entries
    seen_bias, seen_w, seen_v = 1e-2, np.full(size, 1e-2), np.full((size, RANK), 1e-2)
    for _ in range(EPOCHS):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = np.sort(order[at : at + BATCH])
            part = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            local = np.repeat(np.arange(len(chosen)), starts[chosen + 1] - starts[chosen])
            c, x = columns[part], values[part]
            raw, sums = model._raw(local, c, x, len(chosen))
            error = (_chance(raw) - labels[chosen]) / len(chosen)
            by_feature = np.argsort(c, kind="stable")
            c, x, local = c[by_feature], x[by_feature], local[by_feature]
            first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
            touched = c[first]
            scaled = error[local] * x
            grad_w = np.add.reduceat(scaled, first) + PULL * model.weights[touched]
            pairs = scaled[:, None] * (sums[local] - model.vectors[c] * x[:, None])
            grad_v = np.add.reduceat(pairs, first, axis=0) + PULL * model.vectors[touched]
            seen_w[touched] += grad_w * grad_w
            seen_v[touched] += grad_v * grad_v
            seen_bias += error.sum() ** 2
            model.weights[touched] -= RATE * grad_w / np.sqrt(seen_w[touched])
            model.vectors[touched] -= RATE * grad_v / np.sqrt(seen_v[touched])
            model.bias -= RATE * error.sum() / np.sqrt(seen_bias)
    return model


def held_out(doc_id: Column) -> Column:
    """One row in five, by a checksum of its id, is kept from fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_train: int = MAX_TRAIN,
) -> bytes:
    """A fitted model's bytes, of a size that the parameters fix.

    Of the labelled rows that are not held out, about ``max_train`` at most are taken, by a hash of the id.
    Null ids and labels are left out; of a row labelled twice the larger label counts.
    """
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    total = known.count()
    share = min(1.0, max_train / max(total, 1))
    known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < int(share * (1 << 31)))
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("binary").alias("text"))
    sample = texts.join(known, "id")

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(text=[t or b"" for t in rows["text"]]).sort_values(["id", "text"])
        return pd.DataFrame({"model": [fitted(rows["text"].tolist(), rows["label"].to_numpy(np.float64)).dump()]})

    found = sample.groupBy().applyInPandas(fit, "model binary").collect()
    return bytes(found[0].model) if found else fitted([], np.zeros(0)).dump()


def _scores(model: Broadcast, text_col: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = Model.load(model.value)
    for batch in batches:
        texts = carried_texts(batch, text_col)
        sizes = pc.binary_length(texts).to_pylist()
        for start, end in slices([n or 0 for n in sizes], BYTES_AT_ONCE):
            scores = machine.score(Features(texts.slice(start, end - start).to_pylist()))
            rows = batch.column("row").slice(start, end - start)
            yield pa.RecordBatch.from_arrays([rows, pa.array(scores)], ["row", "score"])


def scored(docs: DataFrame, model: bytes, carry: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """(row, score) of every row of ``docs``: the likelihood of label 1, from 0 to 1.

    ``row`` is a struct of the columns to ``carry`` (all by default), so no name can clash.  A null text
    scores as the empty one, by its structure alone; repeated rows score the same; no rows give no rows.
    """
    rows = carried(docs, carry, text_col)
    kind = rows.schema["row"].dataType.simpleString()
    held = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(lambda batches: _scores(held, text_col, batches), f"row {kind}, score double")
