"""Toxicity: a linear-chain conditional random field tags spans; its marginals score documents.

* Words are runs of ASCII letters, digits and non-ASCII characters, lower-cased (A-Z). A
  chain is a line of the text (a longer line is cut every ``CHAIN`` words). States: ok, toxic.
* Labels are per document, so token labels are derived from the sample: in a toxic
  document the words are toxic whose rate among toxic documents exceeds that among
  others by ``LOG_ODDS`` (and that at least ``LEAST`` and one in 200 toxic documents hold); others are ok.
* Emissions are a bias and weights hashed from the word, its head and its tail; with
  transitions they are fitted in numpy by stochastic gradients of the chain's likelihood
  (expected minus observed counts, by forward-backward). The bias makes ok the prior. Words that a
  single sampled document holds share one weight in place of theirs, which thus learns what unseen words are,
  and unseen words get it when texts are scored.
* With two states forward and backward messages are one odds ratio each, so all chains of
  a batch advance together, one word a step. Marginals aggregate to the document: the largest
  logit, the expected number of toxic words and their share (both over the marginals of FLOOR or more: many near-zeros
  of a long text are no evidence) go through a logistic fit whose weights are kept from falling below 0, so more
  evidence never lowers a score. It is fitted on marginals of documents that their field was not fitted on (FOLDS parts of
  the sample, each scored by the field of the others). Words with a marginal of one half or more are the offending offsets.

Sample: at most ``TOXIC`` toxic and ``CLEAN`` other labelled documents that are not held out,
of at most ``SAMPLE_CHARS`` characters (the smallest hashes of the id). That is the
documented bound of what the fit sees; scoring covers whole texts of all documents.

Defined cases: NULL or empty texts have no words and get the score of none. Without labels of
both kinds every score is the labels' mean (0 without any). Repeated rows get equal
scores. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import as_bytes, chunks_of, crc_mod, smallest_hashes, table

BUCKETS = 1 << 17
CHAIN = 128
TOXIC, CLEAN = 1_500, 2_500
SAMPLE_CHARS = 20_000
LOG_ODDS = 2.0
LEAST = 3
EPOCHS = 8
FLOOR = 0.1
FOLDS = 3
LEAST_LOGIT = float(np.log(0.01 / 0.99))
UNSEEN, BIAS, NOTHING = BUCKETS, BUCKETS + 1, BUCKETS + 2  # weights of words outside the sample and of every word; NOTHING's stays 0
STEPS = 240  # gradient steps at least: a small sample takes more passes
HELD_OUT = 4, 2
THRESHOLD = 0.3
CHUNK_BYTES = 1 << 20
_MEMO = 200_000

_LOWER = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x0A if b == 0x0A else 0x20
               for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def chains(text: bytes | None) -> list[list[bytes]]:
    """The words of each line, cut every CHAIN words; their concatenation is the text's words."""
    out = []
    for line in (text or b"").translate(_LOWER).split(b"\n"):
        w = line.split()
        out += [w] if 0 < len(w) <= CHAIN else [w[k:k + CHAIN] for k in range(0, len(w), CHAIN)]
    return out


def feature_buckets(word: bytes) -> tuple[int, int, int]:
    h = xxhash.xxh3_64_intdigest
    return h(b"w" + word) % BUCKETS, h(b"h" + word[:4]) % BUCKETS, h(b"t" + word[-4:]) % BUCKETS


class Layout:
    """Chains side by side: which chains are still open at each step, and where their words are."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        sizes = lengths[self.order]
        self.open = [int(np.searchsorted(-sizes, -t, side="left")) for t in range(int(sizes.max(initial=0)) + 1)]  # chains longer than t

    def at(self, t: int) -> np.ndarray:
        return self.starts[:self.open[t]] + t

    @property
    def steps(self) -> int:
        return len(self.open) - 1


def forward_backward(x: np.ndarray, lay: Layout, move: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Odds of toxic against ok from the left (with the word) and from the right (without it).

    x: exp(emission) of each word; move[i, j]: exp(weight) of going from i to j.
    """
    left, right = np.empty_like(x), np.ones_like(x)
    for t in range(lay.steps):
        at = lay.at(t)
        if t == 0:
            left[at] = x[at] * start
        else:
            r = left[at - 1]
            left[at] = x[at] * (move[0, 1] + r * move[1, 1]) / (move[0, 0] + r * move[1, 0])
    for t in range(lay.steps - 2, -1, -1):
        at = lay.at(t + 1)
        s = x[at] * right[at]
        right[at - 1] = (move[1, 0] + move[1, 1] * s) / (move[0, 0] + move[0, 1] * s)
    return left, right


@dataclass
class Field:
    """Weights of the random field and of the document score."""
    weight: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS + 3))
    seen: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, bool))
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0
    document: np.ndarray = field(default_factory=lambda: np.zeros(4))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(3))
    scale: np.ndarray = field(default_factory=lambda: np.ones(3))

    def marginals(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        left, right = forward_backward(x, Layout(lengths), np.exp(self.move), float(np.exp(self.start)))
        odds = left * right
        return odds / (1 + odds)

    def score(self, stats: np.ndarray) -> np.ndarray:
        z = (stats - self.mean) / self.scale @ self.document[:3] + self.document[3]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class _Emission(dict):
    """exp(emission) of a word, remembered; emptied when full."""

    def __init__(self, model: Field):
        super().__init__()
        self.weight, self.seen = model.weight, model.seen

    def __missing__(self, word: bytes) -> float:
        if len(self) >= _MEMO:
            self.clear()
        own, head, tail = feature_buckets(word)
        known = self.weight[own] + self.weight[head] + self.weight[tail] if self.seen[own] else self.weight[UNSEEN]
        total = known + self.weight[BIAS]
        self[word] = x = float(np.exp(np.clip(total, -20, 20)))
        return x


def document_stats(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Largest logit, log of the expected number of toxic words and their (smoothed) share, of each document.

    The logit is cut at that of a hundredth: how sure a clean word is makes no difference.
    """
    out = np.full((len(counts), 3), [LEAST_LOGIT, np.log(1e-3), 0.0])
    some = np.flatnonzero(counts)
    if len(some):
        starts = (np.cumsum(counts) - counts)[some]
        top = np.clip(np.maximum.reduceat(p, starts), 1e-2, 1 - 1e-6)
        total = np.add.reduceat(np.where(p >= FLOOR, p, 0.0), starts)
        out[some] = np.stack([np.log(top / (1 - top)), np.log(total + 1e-3), total / (counts[some] + 10)], axis=1)
    return out


def train_rows(docs: DataFrame, labels: DataFrame, label: str, toxic: int = TOXIC, clean: int = CLEAN) -> list:
    """The bounded sample: (text, label)."""
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1))
    able = docs.filter((crc_mod("doc_id", HELD_OUT[0]) != HELD_OUT[1]) & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
                       & (F.length("text") <= SAMPLE_CHARS))
    ids = known.filter((crc_mod("id", HELD_OUT[0]) != HELD_OUT[1]) & F.col("id").isNotNull())
    chosen = smallest_hashes(ids, "y", F.when(F.col("y") == 1, toxic).otherwise(clean))
    # at most toxic + clean rows: small enough to send to every task, so no text is shuffled
    # repeated rows of an id are one document: its smallest text
    rows = able.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
    return sorted((r["text"].encode(), r["y"]) for r in rows.collect())


def _field(texts: list[list[bytes]], chain_lengths: list[np.ndarray], y: np.ndarray, seed: int) -> Field:
    """The random field of one set of labelled documents."""
    out = Field()
    bad, good = Counter(), Counter()
    for words, label in zip(texts, y.tolist(), strict=True):
        (bad if label else good).update(set(words))
    n_bad, n_good = int(y.sum()), int(len(y) - y.sum())
    least = max(LEAST, n_bad // 200)
    toxic = {w for w, n in bad.items() if n >= least and np.log((n + 0.5) / (n_bad + 1)) - np.log((good[w] + 0.5) / (n_good + 1)) >= LOG_ODDS}
    buckets = {}
    for w in {w for words in texts for w in words}:
        own, head, tail = feature_buckets(w)
        common = bad[w] + good[w] > 1
        out.seen[own] |= common
        buckets[w] = (own, head, tail, BIAS) if common else (UNSEEN, NOTHING, NOTHING, BIAS)
    docs = []
    for words, label, lengths in zip(texts, y.tolist(), chain_lengths, strict=True):
        f = np.array([buckets[w] for w in words], np.int64).reshape(-1, 4)
        docs.append((f, np.array([bool(label) and w in toxic for w in words], float), lengths))
    rng = np.random.default_rng(seed)
    seen, seen_move = np.full(BUCKETS + 3, 1e-2), np.full((2, 2), 1.0)
    for _ in range(max(EPOCHS, -(-STEPS // -(-len(docs) // 128)))):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), 128):
            part = [docs[k] for k in order[a:a + 128]]
            f, tags, lengths = (np.concatenate([d[k] for d in part]) for k in range(3))
            if not len(f):
                continue
            x, move = np.exp(np.clip(out.weight[f].sum(axis=1), -20, 20)), np.exp(out.move)
            left, right = forward_backward(x, Layout(lengths), move, float(np.exp(out.start)))
            p = left * right / (1 + left * right)
            g = np.bincount(f.ravel(), np.repeat(p - tags, 4), BUCKETS + 3) / 8 + 1e-4 * out.weight
            g[NOTHING] = 0
            last = np.cumsum(lengths) - 1
            inner = np.ones(len(x), bool)
            inner[last[last >= 0]] = False
            k = np.flatnonzero(inner)
            s = x[k + 1] * right[k + 1]
            pair = np.stack([np.full(len(k), move[0, 0]), move[0, 1] * s, left[k] * move[1, 0], left[k] * move[1, 1] * s])
            expected = (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)
            t0, t1 = tags[k].astype(int), tags[k + 1].astype(int)
            g_move = (expected - np.bincount(2 * t0 + t1, minlength=4).reshape(2, 2)) / 128 + 1e-3 * out.move
            first = (last - lengths + 1)[lengths > 0]
            seen += g * g
            seen_move += g_move * g_move
            out.weight -= 0.5 * g / np.sqrt(seen)
            out.move -= 0.2 * g_move / np.sqrt(seen_move)
            out.start -= 0.2 * float((p[first] - tags[first]).mean())
    return out


def _stats(model: Field, texts: list[list[bytes]], chain_lengths: list[np.ndarray]) -> np.ndarray:
    emission = _Emission(model)
    x = np.array([emission[w] for words in texts for w in words], float)
    lengths = np.concatenate([*chain_lengths, np.empty(0, np.int64)])
    return document_stats(model.marginals(x, lengths), np.array([len(w) for w in texts], np.int64))


def fit(rows: list, seed: int = 9) -> Field:
    y = np.array([r[1] for r in rows])
    if not len(y) or y.min() == y.max():
        out, share = Field(), float(y.mean()) if len(y) else 0.0
        out.document[3] = 40.0 if share == 1 else -40.0
        return out
    cut = [chains(r[0]) for r in rows]
    texts, lengths = [[w for c in cs for w in c] for cs in cut], [np.array([len(c) for c in cs], np.int64) for cs in cut]
    out = _field(texts, lengths, y, seed)
    fold = np.empty(len(y), int)
    for label in (0, 1):  # every part holds its share of both kinds
        of = np.flatnonzero(y == label)
        fold[of] = np.random.default_rng(seed + 1).permutation(len(of)) % FOLDS
    stats = np.empty((len(y), 3))
    for k in range(FOLDS):
        apart, rest = np.flatnonzero(fold == k).tolist(), np.flatnonzero(fold != k).tolist()
        part = _field([texts[i] for i in rest], [lengths[i] for i in rest], y[rest], seed)
        stats[apart] = _stats(part, [texts[i] for i in apart], [lengths[i] for i in apart])
    out.mean, out.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    z = np.hstack([(stats - out.mean) / out.scale, np.ones((len(y), 1))])
    use = [0, 1, 2, 3]
    for _ in range(50):  # Newton steps of the ridge logistic fit; a weight that turns negative is dropped
        q = 1 / (1 + np.exp(-np.clip(z @ out.document, -40, 40)))
        hess = (z[:, use] * (q * (1 - q))[:, None]).T @ z[:, use] + 1e-1 * np.eye(len(use))
        step = np.zeros(4)
        step[use] = np.linalg.solve(hess, z[:, use].T @ (q - y) + 1e-1 * out.document[use])
        out.document = out.document - step
        for k in (0, 1, 2):
            if k in use and out.document[k] < 0 and len(use) > 2:
                use.remove(k)
                out.document[:] = 0
    return out


def offsets(text: bytes, hit: np.ndarray) -> list[dict]:
    """Code point spans of the words numbered in ``hit`` (ascending)."""
    want, out, seen, at = set(hit.tolist()), [], 0, 0
    for k, m in enumerate(_WORD.finditer(text)):
        if k in want:
            at += len(text[seen:m.start()].decode())
            end = at + len(m[0].decode())
            out.append({"start": at, "end": end})
            seen, at = m.end(), end
    return out


def tag(docs: DataFrame, model: Field, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: score, predicted, and the offending spans."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, emission = held.value, _Emission(held.value)
        for batch in batches:
            texts, score, spans = as_bytes(batch.column(2)), [], []
            for a, b in chunks_of(texts, CHUNK_BYTES):
                lines = [chains(t) for t in texts[a:b]]
                lengths = np.array([len(c) for cs in lines for c in cs], np.int64)
                counts = np.array([sum(map(len, cs)) for cs in lines], np.int64)
                x = np.fromiter((e for cs in lines for c in cs for e in map(emission.__getitem__, c)), np.float64, int(counts.sum()))
                p = at.marginals(x, lengths)
                score.append(at.score(document_stats(p, counts)))
                begin = np.cumsum(counts) - counts
                for k, t in enumerate(texts[a:b]):
                    hit = np.flatnonzero(p[begin[k]:begin[k] + counts[k]] >= 0.5)
                    spans.append(offsets(t, hit) if len(hit) else [])
            s = np.concatenate(score) if score else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32), pa.int32()),
                 pa.array(spans, pa.list_(pa.struct({"start": pa.int64(), "end": pa.int64()})))], names=["doc_id", "held_out", "score", "predicted", "spans"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), (crc_mod(doc, HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), F.col(text).alias("t")) \
        .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:bigint,end:bigint>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tag(docs, fit(train_rows(docs, table(spark, sf_dir, "labels"), "toxic")))
