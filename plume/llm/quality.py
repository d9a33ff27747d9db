"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated.

1. Tokens are runs of word characters and runs of other signs, as written, hashed to ``BUCKETS`` buckets.  Each
   bucket has a fixed index vector of ``DIM`` places with ``SPARSE`` entries of +1 or -1.  A bucket's context
   vector adds up the index vectors of the tokens at most ``REACH`` places away, over all documents (whole
   numbers, so the sum is the same in any order).  The table has a fixed size, whatever the input.
2. A document's features are the mean of its tokens' context vectors (each scaled to length 1), the mean's
   length, the share of distinct buckets and the logarithm of its number of tokens.
3. A network with one hidden layer is trained in numpy on at most ``SAMPLE`` labelled rows (those with the
   smallest hash of their id), and its probabilities are calibrated by a temperature on a fifth of them.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append, map_arrow, table

BUCKETS = 1 << 13
DIM, SPARSE, REACH = 32, 4, 2
SAMPLE = 20_000
HIDDEN, EPOCHS, RATE, SEED = 24, 40, 0.01, 10
THRESHOLD = 0.3
PART = 1 << 17

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE: dict = {}


def buckets(text: str | None) -> np.ndarray:
    """Buckets of all tokens of a whole text, in order."""
    if len(_CACHE) > 300_000:  # only speed: the hash gives the same again
        _CACHE.clear()
    seen, out = _CACHE, []
    for t in _TOKEN.findall(text or ""):
        b = seen.get(t)
        if b is None:
            b = seen[t] = zlib.crc32(t.encode("utf-8", "surrogatepass")) % BUCKETS
        out.append(b)
    return np.array(out, np.int64)


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = np.zeros((BUCKETS, DIM), np.int32)
    for row in out:
        row[rng.choice(DIM, SPARSE, replace=False)] = rng.choice([-1, 1], SPARSE)
    return out


def context_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vectors of all buckets over all documents, each scaled to length 1 (rows of zeros stay).

    Every task adds up its own table before the shuffle; the driver gets ``BUCKETS`` rows.
    """
    names = [f"c{i}" for i in range(DIM)]

    def run(batches):
        index, total = index_vectors(), np.zeros((BUCKETS, DIM), np.int64)

        def add(b, first, last):  # of the tokens first to last, with the neighbours of all of ``b``
            near = np.zeros((len(b), DIM), np.int32)
            for o in range(1, REACH + 1):
                near[o:] += index[b[:-o]]
                near[:-o] += index[b[o:]]
            b, near = b[first:last], near[first:last]
            order = np.argsort(b, kind="stable")
            at = np.flatnonzero(np.concatenate(([True], np.diff(b[order]) > 0)))
            total[b[order[at]]] += np.add.reduceat(near[order], at, axis=0)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                b = buckets(t)
                for i in range(0, len(b), PART):  # a very long text in parts, each with its neighbours' ends
                    before = min(i, REACH)
                    part = b[i - before:i + PART + REACH]
                    add(part, before, before + min(PART, len(b) - i))
        used = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, i]) for i in range(DIM)]],
                                         ["bucket", *names])
    parts = map_arrow(docs.select(F.col(text).cast("string").alias("t")), run,
                      "bucket long, " + ", ".join(f"{n} long" for n in names))
    rows = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).collect()
    out = np.zeros((BUCKETS, DIM))
    for r in rows:
        out[r["bucket"]] = r[1:]
    return (out / np.maximum(1e-9, np.linalg.norm(out, axis=1, keepdims=True))).astype(np.float32)


def features(text: str | None, context: np.ndarray) -> np.ndarray:
    """Pooled vector of a whole text; zeros without tokens."""
    b = buckets(text)
    if not len(b):
        return np.zeros(DIM + 3, np.float32)
    distinct, n = np.unique(b, return_counts=True)
    mean = (n @ context[distinct]) / len(b)
    return np.concatenate((mean, [np.linalg.norm(mean), len(distinct) / len(b), np.log1p(len(b)) / 10])).astype(np.float32)


class Network:
    """Two layers (tanh, logistic) with standardised inputs and a temperature; a constant without two classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.rate = float(y.mean()) if len(y) else 0.5
        self.fitted = len(np.unique(y)) == 2
        if not self.fitted:
            return
        held = np.arange(len(y)) % 5 == 4
        if len(np.unique(y[~held])) < 2:
            held[:] = False
        self.mean, self.std = x[~held].mean(0), x[~held].std(0) + 1e-6
        rng = np.random.default_rng(SEED)
        p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        xs, ys = (x[~held] - self.mean) / self.std, y[~held]
        for _ in range(EPOCHS):
            order = rng.permutation(len(ys))
            for i in range(0, len(ys), 256):
                xb, yb = xs[order[i:i + 256]], ys[order[i:i + 256]]
                h = np.tanh(xb @ p[0] + p[1])
                d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - yb) / len(yb)
                dh = np.outer(d, p[2]) * (1 - h * h)
                grads = [xb.T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.p, self.temperature = p, 1.0
        if held.any():
            z = self.logit(x[held])
            def loss(t):
                return np.logaddexp(0, np.where(y[held] == 1, -z, z) / t).mean()
            self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.std @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.rate)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, context: np.ndarray, sample: int = SAMPLE,
          label: str = "quality") -> Network:
    """Network from the labelled rows of ``docs`` (ids and labels not null), at most ``sample`` of them.

    Ids labelled twice teach twice; labels without a document teach nothing.
    """
    some = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label) > 0).cast("int").alias("y"))
            .withColumn("h", F.xxhash64("doc_id", F.lit(SEED))).orderBy("h", "doc_id", "y").limit(sample))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(some), "doc_id"))
    got = append(rows.select("h", "doc_id", "y", "text"), "text", "x array<float>",
                 lambda: lambda ts: [[features(t, context).tolist() for t in ts]], drop=("text",)).collect()
    got.sort(key=lambda r: (r["h"], r["doc_id"], r["y"], r["x"]))
    x = np.array([r["x"] for r in got], np.float64).reshape(len(got), DIM + 3)
    return Network(x, np.array([r["y"] for r in got], np.int64))


def score(docs: DataFrame, context: np.ndarray, net: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) for every row; null and empty texts are scored as texts without tokens."""
    def make():
        return lambda ts: [net(np.array([features(t, context) for t in ts]).reshape(len(ts), DIM + 3)).tolist()]
    return append(docs, text, "score double", make)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op10_quality_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out ids are never read into the training."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    context = context_table(docs)
    scored = score(docs.withColumn("held_out", held_out()), context, train(docs, labels, context))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
