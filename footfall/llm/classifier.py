"""Quality classifier: random indexing, pooling, a two-layer network.

Random indexing.  Words are hashed to ``VOCABULARY`` ids.  Each id has a fixed sparse index
vector (``ONES`` entries +1 or -1 in ``DIM``, from a seed).  A word's vector is the sum of the
index vectors of the words up to ``REACH`` places away, over all occurrences in all documents
(integer sums, combined before the shuffle, so reruns agree), scaled to length 1, plus its own
index vector.

A document's features are the mean and the spread of its words' vectors, its length and its
share of distinct words.  A network with one hidden layer is fitted with numpy on at most
``LABELLED_ROWS`` labelled documents outside the held-out fold (chosen by a hash of the id; a
documented bound), less a fifth that sets the temperature of its probabilities.  Features come
from the text alone.

What is sent to the driver has fixed sizes: ``VOCABULARY`` vectors and the labelled rows'
features.

Defined results: null text is the empty text, with all features 0 and a score like any other;
rows of one id and text score alike; without usable labels, or with one class only, the score
is the labelled share of 1 (0.5 without labels).
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, written

VOCABULARY, DIM, ONES, REACH = 1 << 14, 32, 4, 2
LABELLED_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 256, 0.01, 1e-4
THRESHOLD = 0.3
FOLDS = 5
FEATURES = 2 * DIM + 2


def index_vectors(seed: int = 11) -> np.ndarray:
    """The fixed index vector of each word id."""
    rng = np.random.default_rng(seed)
    out = np.zeros((VOCABULARY, DIM), np.int8)
    for _ in range(ONES):
        out[np.arange(VOCABULARY), rng.integers(0, DIM, VOCABULARY)] += rng.choice(
            np.array([-1, 1], np.int8), VOCABULARY)
    return out


def word_ids(text: bytes) -> np.ndarray:
    mask, crc = VOCABULARY - 1, zlib.crc32
    return np.array([crc(w) & mask for w in text.split()], np.int32)


def context_sums(ids: np.ndarray, index: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out[w]`` the index vectors around each occurrence of ``w`` in one text."""
    if len(ids) < 2:
        return
    own, near = index[ids], np.zeros((len(ids), DIM), np.int16)
    for d in range(1, min(REACH, len(ids) - 1) + 1):
        near[d:] += own[:-d]
        near[:-d] += own[d:]
    order = np.argsort(ids, kind="stable")
    at = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
    out[ids[order[at]]] += np.add.reduceat(near[order], at, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vectors of all word ids over all of ``docs``."""
    names = [f"v{i}" for i in range(DIM)]

    def run(batches):
        index, sums = index_vectors(), np.zeros((VOCABULARY, DIM), np.int64)
        for b in batches:
            for text in text_bytes(b.column(0)):
                context_sums(word_ids(text), index, sums)
        rows = np.flatnonzero(sums.any(axis=1))
        for at in range(0, len(rows), 4096):
            part = rows[at:at + 4096]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), *(pa.array(sums[part, i]) for i in range(DIM))], ["word", *names])

    found = (docs.select("text").mapInArrow(run, "word int, " + ", ".join(f"{n} long" for n in names))
             .groupBy("word").agg(*[F.sum(n).alias(n) for n in names]).toPandas())
    out = index_vectors().astype(np.float32) / np.float32(np.sqrt(ONES))
    if len(found):
        sums = found[names].to_numpy(np.float64)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        out[found["word"].to_numpy()] += (sums / np.maximum(size, 1)).astype(np.float32)
    return out


def features(text: bytes, vectors: np.ndarray) -> np.ndarray:
    ids, out = word_ids(text), np.zeros(FEATURES, np.float32)
    if len(ids):
        v = vectors[ids]
        out[:DIM], out[DIM:2 * DIM] = v.mean(axis=0), v.std(axis=0)
        out[-2:] = np.log1p(len(ids)), len(np.unique(ids)) / len(ids)
    return out


@dataclass
class Network:
    """``sigmoid((tanh(x W1 + b1) W2 + b2) / temperature)`` on standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2)[:, 0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x.astype(np.float64)) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def constant(share: float) -> Network:
    p = min(max(share, 1e-3), 1 - 1e-3)
    return Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, 1)), np.zeros(1), np.zeros((1, 1)),
                   np.array([np.log(p / (1 - p))]))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Fit on four fifths of the rows (Adam, fixed seed), set the temperature on the rest."""
    if len(y) < 20 or y.min() == y.max():
        return constant(float(y.mean()) if len(y) else 0.5)
    rng, x = np.random.default_rng(seed), x.astype(np.float64)
    order = rng.permutation(len(y))
    held, used = order[:len(y) // 5], order[len(y) // 5:]
    net = Network(x[used].mean(axis=0), x[used].std(axis=0) + 1e-6, rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)),
                  np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 1)), np.zeros(1))
    params = [net.w1, net.b1, net.w2, net.b2]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    xs = (x - net.mean) / net.scale
    for epoch in range(EPOCHS):
        rng.shuffle(used)
        rate = RATE * (1 - epoch / EPOCHS)
        for at in range(0, len(used), BATCH):
            rows = used[at:at + BATCH]
            h = np.tanh(xs[rows] @ net.w1 + net.b1)
            d = (_sigmoid((h @ net.w2 + net.b2)[:, 0]) - y[rows])[:, None] / len(rows)
            back = d @ net.w2.T * (1 - h * h)
            step += 1
            for i, g in enumerate((xs[rows].T @ back, back.sum(0), h.T @ d, d.sum(0))):
                g = g + DECAY * params[i]
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.001 * (g * g - v[i])
                params[i] -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    z, target = net.logits(x[held]), y[held]

    def loss(t: float) -> float:
        return float(np.logaddexp(0, np.where(target > 0, -z, z) / t).mean())

    net.temperature = min(np.geomspace(0.25, 16, 97), key=loss)
    return net


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")), F.lit(0)) % FOLDS == 0


def _with_vectors(docs: DataFrame, keep: list[str], out: str, schema: str, vectors: np.ndarray, net: Network | None):
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        table = shared.value
        for b in batches:
            x = np.array([features(t, table) for t in text_bytes(b.column(len(keep)))], np.float32).reshape(-1, FEATURES)
            values = pa.array(net.probabilities(x)) if net else pa.array(list(x), pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), values], [*keep, out])

    fields = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep), f"{out} {schema}"])
    return docs.select(*keep, "text").mapInArrow(run, fields)


def train(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors over all of ``docs`` and the network fitted outside the held-out fold, on ``rows`` labelled
    ids, by a hash of the id; of several texts of one id the smallest."""
    vectors = word_vectors(docs)
    usable = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").alias("_y"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    sample = (docs.select("doc_id", "text").join(F.broadcast(written(usable, "labelled")), F.col("doc_id") == F.col("_id"))
              .groupBy("doc_id", "_y").agg(F.min("text").alias("text")))
    found = (_with_vectors(sample, ["doc_id", "_y"], "x", "array<float>", vectors, None)
             .toPandas().sort_values("doc_id", kind="stable"))
    x = np.array(found["x"].tolist(), np.float32).reshape(-1, FEATURES)
    return vectors, fit(x, found["_y"].to_numpy(np.float64))


def score(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    scored = _with_vectors(docs, ["doc_id"], "score", "double", vectors, net)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
