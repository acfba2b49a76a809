"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased (A-Z), all bytes but letters are blanks, and runs of blanks count as
one, so that the byte 3- and 4-grams are subwords with word ends marked. Each is hashed
into one of ``BUCKETS`` embeddings; their average over the whole text goes through a
linear softmax. Embeddings and softmax are trained together by stochastic gradient
descent in numpy on ``PER_LANG`` documents a language (the smallest hashes of the id among
rows with a non-NULL lang that are not held out: the documented bound of the sample;
whole texts). A fifth of the sample is kept apart to fit the temperature and the rejection
threshold: the largest one, up to ``MOST``, that turns away at most ``FALSE_REJECTS`` of them.

As everything after the hash is linear, a document is scored by averaging rows of the
(buckets x languages) product; a batch is one gather and one segmented sum.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0 and rejected.
Without any usable training row all are. Ties between languages go to the first by name.
Repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import as_bytes, chunks_of, crc_mod, ready, release, smallest_hashes, table

BUCKETS = 1 << 15
DIM = 16
PER_LANG = 500
EPOCHS = 8
FALSE_REJECTS = 0.001
MOST = 0.5
CHUNK_BYTES = 1 << 20
HELD_OUT = 5

_LETTERS = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def subwords(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every subword, first subword of each text); bucket ``BUCKETS`` is the null one."""
    clean = [b" " + b" ".join((t or b"").translate(_LETTERS).split()) + b"   " for t in texts]
    ends = np.cumsum([len(c) for c in clean])
    raw = np.frombuffer(b"".join(clean) + b"   ", np.uint8).astype(np.uint32)
    n = int(ends[-1])
    three = raw[:n] | raw[1:n + 1] << 8 | raw[2:n + 2] << 16
    four = three | raw[3:n + 3] << 24
    out = np.empty((n, 2), np.int32)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    out[:, 0] = (three * np.uint32(0x9E3779B1)) >> shift
    out[:, 1] = ((four ^ four >> np.uint32(15)) * np.uint32(0x85EBCA77)) >> shift
    for back in (1, 2, 3):  # grams that would reach past the closing blank
        out[ends - back] = BUCKETS
    return out.ravel(), 2 * (ends - np.array([len(c) for c in clean]))


@dataclass
class LangModel:
    langs: list[str]
    table: np.ndarray  # (buckets + 1) x languages, over the temperature; the last column counts subwords
    bias: np.ndarray
    threshold: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.langs)))
        for a, b in chunks_of(texts, CHUNK_BYTES):
            grams, starts = subwords(texts[a:b])
            total = np.add.reduceat(self.table[grams], starts, axis=0, dtype=np.float64)
            z = total[:, :-1] / np.maximum(total[:, -1:], 1) + self.bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[a:b] = z / z.sum(axis=1, keepdims=True)
        return out

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, calibrated probability, rejected) of each text."""
        known = np.array([has_letter(t) for t in texts], bool) & bool(self.langs)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        p = self.scores(texts)
        best = p.argmax(axis=1)
        score = np.where(known, p.max(axis=1), 0.0)
        return ([self.langs[k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist(), strict=True)], score,
                ~known | (score < self.threshold))


def train_rows(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """The bounded sample: whole texts of ``per_lang`` documents a language, none held out."""
    able = docs.select(F.col("doc_id").alias("id"), F.col("lang").cast("string").alias("lang"), "text") \
        .filter(F.col("lang").isNotNull() & (crc_mod("id", HELD_OUT) != 0) & F.col("text").isNotNull())
    chosen = smallest_hashes(able, "lang", F.lit(per_lang)).select(F.col("id").alias("chosen"), F.col("lang").alias("as"))
    # at most per_lang rows a language: small enough to send to every task, so no text is shuffled
    # repeated rows of an id are one document: its smallest text
    return (able.join(F.broadcast(chosen), (F.col("id") == F.col("chosen")) & (F.col("lang") == F.col("as")))
            .groupBy("id", "lang").agg(F.min("text").alias("text")).select("id", "lang", "text"))


def features(rows: DataFrame) -> DataFrame:
    """Distinct buckets and counts of each training text, as bytes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, grams, counts = as_bytes(b.column(2)), [], []
            for t in texts:
                g, n = np.unique(subwords([t])[0], return_counts=True)
                keep = g < BUCKETS
                grams.append(g[keep].astype(np.int32).tobytes())
                counts.append(n[keep].astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(pa.string()), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["id", "lang", "grams", "counts"])

    return rows.select(F.col("id").cast("string").alias("id"), "lang", "text").mapInArrow(count, "id string, lang string, grams binary, counts binary")


def fit(docs: DataFrame, per_lang: int = PER_LANG, seed: int = 5) -> LangModel:
    rows = [r for r in features(train_rows(docs, per_lang)).collect() if r["grams"]]  # bounded by per_lang a language
    rows.sort(key=lambda r: (r["lang"], r["id"], bytes(r["grams"]), bytes(r["counts"])))
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return LangModel([], np.zeros((BUCKETS + 1, 1)), np.zeros(0), 1.0)
    grams = [np.frombuffer(r["grams"], np.int32) for r in rows]
    parts = [np.frombuffer(r["counts"], np.int32).astype(np.float32) for r in rows]
    parts = [c / c.sum() for c in parts]
    y = np.array([langs.index(r["lang"]) for r in rows])
    rng = np.random.default_rng(seed)
    apart = rng.permutation(len(rows)) % 5 == 0 if len(rows) >= 10 else np.zeros(len(rows), bool)
    train = np.flatnonzero(~apart)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)

    def vector(k: int) -> np.ndarray:
        return parts[k] @ emb[grams[k]]

    for epoch in range(EPOCHS):
        rate = 2.0 * (1 - epoch / EPOCHS)
        for k in rng.permutation(train).tolist():
            x = vector(k)
            z = x @ w + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[k]] -= 1
            # the gradient of an average spreads over its subwords; scaled so that frequent ones move
            emb[grams[k]] -= rate * np.outer(parts[k], w @ p) * 20
            w -= rate * 0.1 * np.outer(x, p)
            bias -= rate * 0.01 * p
    held = np.flatnonzero(apart) if apart.any() else train
    z = np.stack([vector(k) @ w + bias for k in held.tolist()]).astype(np.float64)

    def loss(t: float) -> float:
        q = z / t
        q -= q.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(held)), y[held]]))

    temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)
    q = np.exp((z - z.max(axis=1, keepdims=True)) / temperature)
    sure = np.sort((q / q.sum(axis=1, keepdims=True)).max(axis=1))
    threshold = min(MOST, float(sure[int(FALSE_REJECTS * len(sure))]))
    full = np.zeros((BUCKETS + 1, len(langs) + 1), np.float32)
    full[:-1, :-1] = emb @ w / temperature
    full[:-1, -1] = 1
    return LangModel(langs, full, (bias / temperature).astype(np.float64), threshold)


def identify(docs: DataFrame, model: LangModel, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: lang_pred, score (calibrated probability) and rejected."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score, rejected = held.value.predict(as_bytes(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                                             names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), (crc_mod(doc, HELD_OUT) == 0).alias("held_out"), F.col(text).alias("t")) \
        .mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents whose language is not rejected, with all their columns."""
    release(ready(spark))
    held, at = spark.sparkContext.broadcast(fit(docs)), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(~held.value.predict(as_bytes(b.column(at)))[2]))

    return docs.mapInArrow(keep, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
