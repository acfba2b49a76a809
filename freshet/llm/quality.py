"""Quality classifier: random-indexing word vectors pooled per document, two numpy layers.

1. Tokens are runs of letters and digits or runs of other visible characters (case and
   punctuation are signals of quality, so both are kept), hashed into ``BUCKETS``. Each
   bucket has a fixed sparse ternary index vector. Over *all* documents, a bucket's context
   vector adds up the index vectors of its neighbours one and two places away. Tasks add up
   their own part in integers and emit one row a bucket; Spark sums the rows (sums of
   integers, so the result doesn't depend on the order).
2. A document is pooled: the means of its tokens' index and normalised context vectors, its
   length and its share of distinct tokens.
3. A network of two layers (tanh, then a logistic unit) is fitted in numpy on at most
   ``SAMPLE`` labelled documents that are not held out (the smallest hashes of the id: the
   documented bound of the sample). A fifth of them is kept apart for the temperature
   that calibrates the probabilities.
4. All pooled vectors are scored; the texts are read twice in all.

Defined cases: NULL or empty texts pool to zeros and get a score like any other. Without
labels of both kinds every score is the labels' mean (0.5 without any). Repeated rows get
equal scores; repeated labels weigh as often as they occur. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import as_bytes, chunks_of, crc_mod, int_lists, smallest_hashes, stored, table

BUCKETS = 1 << 14
DIM = 32
NONZERO = 4
NEIGHBOURS = 2
SAMPLE = 20_000
HIDDEN = 32
EPOCHS = 30
HELD_OUT = 3, 1
CHUNK_BYTES = 1 << 20
_MEMO = 200_000

_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
_RNG = np.random.default_rng(11)
PLACE = np.argsort(_RNG.random((BUCKETS, DIM)), axis=1)[:, :NONZERO].astype(np.int64)  # where the index vectors are not 0
SIGN = _RNG.choice(np.array([-1.0, 1.0]), (BUCKETS, NONZERO))


class _Bucket(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        self[token] = b = xxhash.xxh3_64_intdigest(token) & (BUCKETS - 1)
        return b


def token_buckets(texts: list[bytes | None], memo: _Bucket) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every token, number of tokens of each text)."""
    tokens = [_TOKEN.findall(t) if t else [] for t in texts]
    counts = np.array([len(t) for t in tokens], np.int64)
    return np.fromiter((b for t in tokens for b in map(memo.__getitem__, t)), np.int64, int(counts.sum())), counts


def context_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Summed index vectors of the neighbours of each bucket, over all documents (buckets x dim)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, total = _Bucket(), np.zeros(BUCKETS * DIM)
        for batch in batches:
            texts = as_bytes(batch.column(0))
            for a, b in chunks_of(texts, CHUNK_BYTES):
                ids, counts = token_buckets(texts[a:b], memo)
                doc = np.repeat(np.arange(b - a), counts)
                for gap in range(1, NEIGHBOURS + 1):
                    same = doc[gap:] == doc[:-gap]
                    left, right = ids[:-gap][same], ids[gap:][same]
                    for k in range(NONZERO):
                        for at, of in ((left, right), (right, left)):
                            total += np.bincount(at * DIM + PLACE[of, k], SIGN[of, k], BUCKETS * DIM)
        rows = total.reshape(BUCKETS, DIM).astype(np.int64)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), int_lists(rows[some].ravel(), np.full(len(some), DIM), pa.int64())],
                                         names=["bucket", "v"])

    sums = docs.select(F.col(text).alias("t")).mapInArrow(run, "bucket int, v array<bigint>").groupBy("bucket").agg(
        *[F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(DIM)])
    out = np.zeros((BUCKETS, DIM))
    for r in sums.collect():  # at most BUCKETS rows
        out[r[0]] = r[1:]
    return out


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Index vector beside the normalised context vector of each bucket."""
    index = np.zeros((BUCKETS, DIM))
    np.put_along_axis(index, PLACE, SIGN, axis=1)
    size = np.linalg.norm(context, axis=1, keepdims=True)
    return np.hstack([index, context / np.maximum(size, 1)]).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: means of its tokens' vectors, length, share of distinct tokens."""
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Bucket()
        for batch in batches:
            texts = as_bytes(batch.column(2))
            out = np.zeros((len(texts), 2 * DIM + 2), np.float32)
            for a, b in chunks_of(texts, CHUNK_BYTES // 4):
                ids, counts = token_buckets(texts[a:b], memo)
                doc_of = np.repeat(np.arange(b - a), counts)
                kinds, times = np.unique(doc_of * BUCKETS + ids, return_counts=True)
                at = kinds // BUCKETS
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                if len(starts):
                    rows = at[starts]
                    weighed = held.value[kinds % BUCKETS] * times[:, None].astype(np.float32)
                    out[a + rows, :-2] = np.add.reduceat(weighed, starts, axis=0, dtype=np.float64) / counts[rows, None]
                    out[a + rows, -1] = np.diff(starts, append=len(at)) / counts[rows]
                out[a:b, -2] = np.log1p(counts) / 10
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), int_lists(out.ravel(), np.full(len(out), out.shape[1]), pa.float32())],
                names=["doc_id", "held_out", "v"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), (crc_mod(doc, HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), F.col(text).alias("t")) \
        .mapInArrow(run, "doc_id long, held_out boolean, v array<float>")


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def constant(width: int, share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 3) -> Network:
    """Two layers by Adam on the cross-entropy, then the temperature on a fifth kept apart."""
    if len(y) < 10 or y.min() == y.max():
        return constant(x.shape[1], float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart, train = order[:len(y) // 5], order[len(y) // 5:]
    net = Network(x[train].mean(axis=0), x[train].std(axis=0) + 1e-3, rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
                  np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), 0.0)
    par = [net.w1, net.b1, net.w2, np.zeros(1)]
    one, two, step = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par], 0
    z = (x - net.mean) / net.scale
    for epoch in range(epochs):
        order = rng.permutation(train)
        for a in range(0, len(order), 64):
            at = order[a:a + 64]
            h = np.tanh(z[at] @ par[0] + par[1])
            d = (1 / (1 + np.exp(-(h @ par[2] + par[3]))) - y[at]) / len(at)
            back = np.outer(d, par[2]) * (1 - h * h)
            grads = [z[at].T @ back + 1e-4 * par[0], back.sum(axis=0), h.T @ d + 1e-4 * par[2], np.array([d.sum()])]
            step += 1
            for p, g, m, v in zip(par, grads, one, two, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (1 - epoch / epochs) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = par[0], par[1], par[2], float(par[3][0])
    logits = net.logit(x[apart])

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - y[apart] * logits / t))

    net.temperature = min(np.geomspace(0.5, 10, 60).tolist(), key=loss)
    return net


def sample(pool: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` labelled vectors that are not held out: the smallest hashes of the id."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("double").alias("y")).filter(
        F.col("y").isin(0.0, 1.0) & F.col("id").isNotNull() & (crc_mod("id", HELD_OUT[0]) != HELD_OUT[1]))
    chosen = smallest_hashes(known.withColumn("all", F.lit(1)), "all", F.lit(most)).select("id")
    # at most ``most`` ids, each with one label (the smaller of two) and one of its documents' vectors
    known = known.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("y").alias("y"))
    rows = (pool.join(F.broadcast(known), F.col("doc_id") == F.col("id")).groupBy("doc_id")
            .agg(F.min("y").alias("y"), F.min("v").alias("v")).select("doc_id", "y", "v").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["y"], r["v"]))
    if not rows:
        return np.zeros((0, 2 * DIM + 2)), np.zeros(0)
    return np.array([r["v"] for r in rows], np.float64), np.array([r["y"] for r in rows])


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> DataFrame:
    pool = stored(pooled(docs, word_vectors(context_vectors(docs))), "pooled")
    net = fit(*sample(pool, labels, label, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy().reshape(b.num_rows, -1)
            s = net.score(x.astype(np.float64)) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return pool.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
