"""Quality classifier on random-indexing word vectors (operator 5).

Words are runs of letters and digits, and runs of other signs.  Every word hash owns a sparse random index vector.  A
word's vector, kept in one of BUCKETS rows, sums the index vectors of its neighbours over all documents plus its own;
rows are scaled to unit length.  A document is the mean of its words' vectors beside their spread, and nothing else.  A
two-layer network in numpy is trained on these, and a temperature found on a part of the training rows kept from
training calibrates its probabilities.

The classifier is fitted on at most ``most`` labelled rows (those whose hashed ids come first); everything else covers
every row.  Only the model (a fixed size, about 10 MB) is broadcast, and only the word sums (a fixed size, summed by
slices of buckets before) and the bounded sample's pooled vectors reach the driver.

Defined cases: null and empty texts are scored as documents without words; labels outside 0 and 1, and null ones, are
ignored; several labels of one document each count as a row; without labels of both classes every score is the share of
label 1 among them (0.5 without any); an empty table gives an empty result; labels, lang, source and doc_id are
never inputs of a score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .shared import dropped, spread, stored, table

#: Rows of the word table, and the length of its vectors.
BUCKETS, DIM = 1 << 15, 64
#: Words on either side that count as neighbours.
NEAR = 2
#: Labelled rows that the classifier is fitted on at most.
MOST = 6000
#: Words of a document that are pooled at once.
CHUNK = 1 << 14
#: Weight of the squared weights in training.
PENALTY = 3e-3
#: Rows in which a task's sums are shuffled.
SLICES = 64


def _pieces(column: pa.Array) -> Iterator[tuple]:
    """Slices of a text column: (first row, rows, bytes, own offsets, word starts, ends, rows, hashes)."""
    buf, off = tk.flat(column)
    hasher = tk.Hasher()
    for a, b in tk.slices(off):
        text, own = buf[off[a] : off[b]], off[a : b + 1] - off[a]
        starts, ends, rows = tk.kind_spans(text, own)
        yield a, b - a, text, own, starts, ends, rows, hasher.spans(text, starts, ends)


def _index_vectors(buckets: np.ndarray) -> np.ndarray:
    """Sparse ternary vectors (8 of DIM entries) that belong to bucket numbers."""
    h = tk.mix(buckets.astype(np.uint64) + np.uint64(0x5151))
    out = np.zeros((len(buckets), DIM), np.float32)
    at = np.arange(len(buckets))
    for _ in range(8):
        h = tk.mix(h + np.uint64(0x9E37))
        out[at, (h & np.uint64(DIM - 1)).astype(np.int64)] += np.where(h >> np.uint64(63), 1, -1)
    return out


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sums of neighbours' index vectors, as a compressed row for each slice of buckets."""
    index = _index_vectors(np.arange(BUCKETS)).astype(np.int8)
    total = np.zeros((BUCKETS, DIM), np.int64)
    for b in batches:
        for _, _, _, _, _, _, rows, hashes in _pieces(b.column("text")):
            w = _bucket(hashes)
            for lo in range(0, len(w), CHUNK):
                hi, first = min(lo + CHUNK, len(w)), max(0, lo - NEAR)
                v, r = index[w[first : hi + NEAR]], rows[first : hi + NEAR]
                near = np.zeros_like(v)
                for step in range(1, NEAR + 1):
                    same = (r[step:] == r[:-step])[:, None]
                    near[:-step] += v[step:] * same
                    near[step:] += v[:-step] * same
                order = np.argsort(w[lo:hi].astype(np.uint16), kind="stable")
                at, starts = np.unique(w[lo:hi][order], return_index=True)
                total[at] += np.add.reduceat(near[lo - first : hi - first][order], starts, axis=0, dtype=np.int64)
    yield from _sliced({k: x for k, x in enumerate(total.reshape(SLICES, -1)) if x.any()})


def _sliced(sums: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if sums:
        packed = [zlib.compress(x.tobytes(), 1) for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["slice", "sums"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each slice that the partition has rows of."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, x in zip(b.column("slice").to_pylist(), b.column("sums").to_pylist(), strict=True):
            sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(x), np.int64)
    yield from _sliced(sums)


def word_table(docs: DataFrame) -> np.ndarray:
    """The vectors of all buckets over all of ``docs(text)``."""
    total = np.zeros((SLICES, BUCKETS // SLICES * DIM))
    parts = "slice int, sums binary"
    for r in docs.select("text").mapInArrow(_sums, parts).repartition("slice").mapInArrow(_merged, parts).collect():  # SLICES rows at most
        total[r["slice"]] = np.frombuffer(zlib.decompress(r["sums"]), np.int64)
    total = total.reshape(BUCKETS, DIM)
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1)
    total += _index_vectors(np.arange(BUCKETS)) / math.sqrt(8)
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(column: pa.Array, words: np.ndarray) -> np.ndarray:
    """For each text the mean and the spread of its words' vectors: 2 * DIM figures, 0 without words."""
    out = np.zeros((len(column), 2 * DIM), np.float32)
    for a, n, _, _, _, _, rows, hashes in _pieces(column):
        w = _bucket(hashes)
        edges = np.searchsorted(rows, np.arange(n + 1))
        for i in np.flatnonzero(np.diff(edges)):
            lo, hi = edges[i], edges[i + 1]
            at, times = np.unique(w[lo:hi], return_counts=True)
            total, square = np.zeros(DIM), np.zeros(DIM)
            for k in range(0, len(at), CHUNK):
                v, t = words[at[k : k + CHUNK]].astype(np.float64), times[k : k + CHUNK].astype(np.float64)
                total += t @ v
                square += t @ (v * v)
            mean = total / (hi - lo)
            out[a + i, :DIM] = mean
            out[a + i, DIM:] = np.sqrt(np.maximum(square / (hi - lo) - mean * mean, 0))
    return out


def gradients(p: list[np.ndarray], z: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """The gradients of the mean log loss, with half of PENALTY times the squared weights, of a network ``p``."""
    a = np.maximum(z @ p[0] + p[1], 0)
    d = (1 / (1 + np.exp(-np.clip(a @ p[2] + p[3][0], -50, 50))) - y) / len(y)
    back = np.outer(d, p[2]) * (a > 0)
    return [z.T @ back + PENALTY * p[0], back.sum(0), a.T @ d + PENALTY * p[2], np.array([d.sum()])]


def best_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The divisor of ``logit``, of those tried, under which labels ``y`` are most likely."""
    losses = [(np.mean(np.logaddexp(0, np.where(y == 1, -1, 1) * logit / t)), t) for t in np.geomspace(0.25, 8, 41)]
    return float(min(losses)[1])


class Network:
    """Two layers with ReLU between, trained by Adam on standardised inputs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 48, epochs: int = 60, seed: int = 7) -> None:
        self.temperature, self.constant = 1.0, None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        r = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        order = r.permutation(len(y))
        held = max(1, len(y) // 5)
        tune, fit = order[:held], order[held:]
        if y[fit].min() == y[fit].max():
            fit = tune = order
        z = (x - self.mean) / self.scale
        p = [r.normal(0, math.sqrt(2 / z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden), r.normal(0, math.sqrt(2 / hidden), hidden), np.zeros(1)]
        m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
        for _ in range(epochs):
            r.shuffle(fit)
            for k in range(0, len(fit), 64):
                i = fit[k : k + 64]
                step += 1
                for j, g in enumerate(gradients(p, z[i], y[i])):
                    m[j] += 0.1 * (g - m[j])
                    v[j] += 0.001 * (g * g - v[j])
                    p[j] = p[j] - 0.003 * (m[j] / (1 - 0.9**step)) / (np.sqrt(v[j] / (1 - 0.999**step)) + 1e-8)
        self.p = p
        self.temperature = best_temperature(self._logit(x[tune]), y[tune])

    def _logit(self, x: np.ndarray) -> np.ndarray:
        a = np.maximum((x - self.mean) / self.scale @ self.p[0] + self.p[1], 0)
        return a @ self.p[2] + self.p[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logit(x) / self.temperature, -50, 50)))


class Model:
    """The word table, the network and the broadcast of both."""

    def __init__(self, spark: SparkSession, words: np.ndarray, net: Network) -> None:
        self.words, self.net = words, net
        self.shared = spark.sparkContext.broadcast((words, net))

    def scored(self, docs: DataFrame, column: str = "score") -> DataFrame:
        """``docs`` with the probability of label 1 in ``column``."""
        shared = self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, net = shared.value
            for b in batches:
                score = net.score(pooled(b.column("text"), words)).astype(np.float64)
                yield b.append_column(pa.field(column, pa.float64()), pa.array(score))

        schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
        return docs.mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    """Whether the row belongs to the fold that labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Model:
    """A model of ``labels(doc_id, quality)`` over ``docs(doc_id, text)``, from rows outside the held-out fold."""
    spark = docs.sparkSession
    chosen = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .where(~held_out())
        .select("doc_id", F.col("quality").cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(most)
    )
    # at most ``most`` ids and labels: 16 bytes each
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample, path = stored(texts.select("text", "label"), "quality-sample")
    words = word_table(docs)
    shared = spark.sparkContext.broadcast(words)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pooled(b.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), b.column("label")], names=["x", "label"])

    rows = sample.mapInArrow(pool, "x binary, label double").collect()  # at most ``most`` rows of 512 bytes
    dropped(spark, path)
    rows.sort(key=lambda r: (bytes(r["x"]), r["label"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(-1, 2 * DIM)
    net = Network(x.astype(np.float64), np.array([r["label"] for r in rows]))
    return Model(spark, words, net)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    scored = fit(docs, table(spark, sf_dir, "labels")).scored(docs)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
