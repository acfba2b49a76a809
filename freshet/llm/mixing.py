"""Mixing sources to target weights: packed blocks, drawn shards, permuted indices, one join.

1. Size. A document's size is its number of words ``[^\\x20\\x09-\\x0D]+``. Targets share
   ``share`` times all words by the weights 3, 1, 2, repeating over the sources in code
   point order (NULL last); a target stops at ``cap`` times its source's size, the excess
   being reshared by weight. Only one row a source reaches the driver.
2. Pack. Within a source the documents are laid end to end, by segment (hash of the id)
   and id, and cut into blocks of ``block_words`` words. A document's place comes from a
   two-level prefix sum (segment totals, then inside a segment), so a hot source is
   never ordered in one task.
3. Draw. Output shards hold ``shard_slots`` block slots. How many slots of a shard go to
   each source is a multinomial draw conditioned on the sources' quotas, made by halving
   the range of shards (multivariate hypergeometric at each node, seeded by the node);
   every task finds its own shards' counts on the way down and nothing is sequential.
4. Map. The i-th slot of a source takes block ``P(i mod blocks)`` of epoch
   ``i div blocks``, P being a keyed pseudorandom permutation of the source's block
   indices (Feistel network with cycle walking). The last slot of a source is shortened so
   that its taken words equal its rounded target. As a target is at most ``cap`` times
   the size, no block, and so no document, is taken more often than that.
5. Join slots and document pieces by (source, block) and sum per document.

All draws depend on (seed, source, block, shard) alone, so reruns and retried tasks agree.

Defined cases: NULL or empty text has size 0 and takes 0. NULL sources form one source,
last in order. Repeated rows are laid out one after another and mixed on their own. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import ready, release, split64, stored, table

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
BLOCK_WORDS = 2_048
SHARD_SLOTS = 1_024
WORD = r"[^\x20\x09-\x0D]+"
_EXACT_DRAW = 1_000_000_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, cap: float = CAP) -> list[float]:
    """Water-filling: shares by weight, each stopped at ``cap`` times its size, excess reshared."""
    out = [0.0] * len(sizes)
    left, open_ = share * sum(sizes), list(range(len(sizes)))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > cap * sizes[i]]
        for i in full or open_:
            out[i] = cap * sizes[i] if full else unit * weights[i]
        if not full:
            break
        left = max(0.0, left - sum(out[i] for i in full))
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _round_keys(seed: int, source: int, epoch: np.ndarray | int, rounds: int = 4) -> list[np.ndarray]:
    base = np.asarray(epoch, np.uint64) + np.uint64((seed * 1_000_003 + source * 8_191) & (2**63 - 1))
    return [split64(np.array(base + np.uint64(0x9E3779B97F4A7C15 * (r + 1) & (2**64 - 1)), np.uint64, ndmin=1)) for r in range(rounds)]


def permute(index: np.ndarray, n: int, seed: int, source: int, epoch: np.ndarray | int, back: bool = False) -> np.ndarray:
    """Keyed pseudorandom permutation of 0..n-1 (``back``: its inverse)."""
    x = np.asarray(index, np.uint64).copy()
    if n <= 1:
        return x.astype(np.int64)
    half = np.uint64(max(1, (int(n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = [np.broadcast_to(k, x.shape) for k in _round_keys(seed, source, epoch)]
    todo = np.ones(len(x), bool)
    while todo.any():  # walk until the value is below n again; under 4 steps on average
        v = x[todo]
        left, right = v >> half, v & mask
        for k in (keys[::-1] if back else keys):
            if back:
                left, right = right ^ (split64((left + k[todo]).copy()) & mask), left
            else:
                left, right = right, left ^ (split64((right + k[todo]).copy()) & mask)
        x[todo] = (left << half) | right
        todo = x >= np.uint64(n)
    return x.astype(np.int64)


@dataclass
class Quota:
    """One source's part of the mix, in words and block slots."""
    size: int
    target: float
    blocks: int
    slots: int
    cut: int  # words of the last slot

    @classmethod
    def of(cls, source: int, size: int, target: float, block_words: int, seed: int) -> Quota:
        blocks = -(-size // block_words)
        words = round(target)
        if not size or not words:
            return cls(size, target, blocks, 0, 0)
        epochs, rest = divmod(words, size)
        if not rest:
            return cls(size, target, blocks, epochs * blocks, 0)
        short = size - (blocks - 1) * block_words
        at = int(permute(np.array([blocks - 1]), blocks, seed, source, epochs, back=True)[0])
        before = lambda k: k * block_words - (block_words - short) * (at < k)
        k = rest // block_words
        while before(k) < rest:
            k += 1
        return cls(size, target, blocks, epochs * blocks + k, rest - before(k - 1))


def draw(count: np.ndarray, room: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``room`` slots, drawn from all without replacement, are of each source.

    The sources are drawn one after another, each from those left. The generator's exact draw
    ends at ``_EXACT_DRAW`` slots; from there on the normal law of the same mean and variance stands
    for it (rounded, kept within what is possible), which it then differs from by less than 1e-4.
    """
    total, out = int(count.sum()), np.zeros_like(count)
    for i, c in enumerate(count.tolist()):
        rest = total - c
        low, high = max(0, room - rest), min(c, room)
        if low == high:
            x = low
        elif total < _EXACT_DRAW:
            x = int(rng.hypergeometric(c, rest, room))
        else:
            share = c / total
            spread = math.sqrt(room * share * (rest / total) * ((total - room) / (total - 1)))
            x = min(max(round(rng.normal(room * share, spread)), low), high)
        out[i], room, total = x, room - x, rest
    return out


def shard_counts(totals: np.ndarray, shards: int, shard_slots: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, slots) of each source in one shard, found by halving the range of shards."""
    lo, hi, first, count = 0, shards, np.zeros_like(totals), totals.copy()
    while hi - lo > 1:
        mid = (lo + hi) // 2
        room = min((mid - lo) * shard_slots, int(count.sum()))
        left = draw(count, room, np.random.default_rng([seed, lo, hi]))
        if shard < mid:
            hi, count = mid, left
        else:
            lo, first, count = mid, first + left, count - left
    return first, count


def slots(spark: SparkSession, quotas: list[Quota], seed: int, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """One row a block slot: shard, slot, source (index), block, epoch, words (NULL: the whole block)."""
    totals = np.array([q.slots for q in quotas], np.int64)
    shards = max(1, -(-int(totals.sum()) // shard_slots))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column(0).to_pylist():
                first, count = shard_counts(totals, shards, shard_slots, shard, seed)
                out = []
                for s in np.flatnonzero(count).tolist():
                    q, i = quotas[s], first[s] + np.arange(count[s])
                    epoch = i // q.blocks
                    block = permute(i % q.blocks, q.blocks, seed, s, epoch)
                    cut = np.where((i == q.slots - 1) & (q.cut > 0), q.cut, -1)
                    out.append((np.full(len(i), s), block, epoch, cut))
                if out:
                    s, block, epoch, cut = (np.concatenate(x) for x in zip(*out, strict=True))
                    place = permute(np.arange(len(s)), len(s), seed, -1 - shard % 4096, 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(s), shard)), pa.array(place), pa.array(s), pa.array(block), pa.array(epoch),
                         pa.array(cut, mask=cut < 0)], names=["shard", "slot", "source_index", "block", "epoch", "words"])

    return spark.range(0, shards, 1, max(1, min(shards, 4 * spark.sparkContext.defaultParallelism))).mapInArrow(
        fill, "shard long, slot long, source_index long, block long, epoch long, words long")


@dataclass
class Mix:
    placed: DataFrame  # one row a document: its place in its source's word sequence
    pieces: DataFrame  # document pieces by (source_index, block)
    slots: DataFrame
    block_words: int

    def blocks(self) -> DataFrame:
        """The mix itself: what each slot of each shard holds, as word ranges of documents."""
        at = self.slots.join(self.pieces, ["source_index", "block"])
        stop = F.least("till", F.coalesce("words", F.lit(self.block_words)))
        return at.filter(F.col("from") < stop).select(
            "shard", "slot", "source", "doc_id", (F.col("block") * self.block_words + F.col("from") - F.col("start")).alias("word_from"),
            (F.col("block") * self.block_words + stop - F.col("start")).alias("word_to"))

    def taken(self) -> DataFrame:
        """Per document: size, source_size, target and the words the mix takes of it."""
        times = self.slots.groupBy("source_index", "block").agg(
            F.sum(F.when(F.col("words").isNull(), 1).otherwise(0)).alias("whole"), F.max("words").alias("cut"))
        part = F.coalesce(F.col("whole"), F.lit(0)) * (F.col("till") - F.col("from")) + F.greatest(
            F.least("till", F.coalesce("cut", F.lit(0))) - F.col("from"), F.lit(0))
        keep = ["doc_id", "size", "source", "source_index", "start", "source_size", "target"]
        some = (self.pieces.join(times, ["source_index", "block"], "left")
                .groupBy(*keep).agg(F.sum(part).cast("long").alias("taken")))
        none = self.placed.filter("size = 0").select(*keep, F.lit(0).cast("long").alias("taken"))
        return some.unionByName(none).drop("start", "source_index")


def mix(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        share: float = SHARE, cap: float = CAP, block_words: int = BLOCK_WORDS, seed: int = 17) -> Mix:
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sized = stored(docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size")), "sized")
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()  # one row a source
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["size"]) for r in rows]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share, cap)
    quotas = [Quota.of(i, n, t, block_words, seed) for i, (n, t) in enumerate(zip(sizes, goal, strict=True))]
    sources = spark.createDataFrame(
        [(r["source"], i, sizes[i], float(goal[i])) for i, r in enumerate(rows)],
        "name string, source_index long, source_size long, target double")
    n_segments = 1 + math.isqrt(sum(r["n"] for r in rows))  # as many segments as documents in one
    cut = sized.withColumn("segment", F.pmod(F.xxhash64("doc_id"), F.lit(n_segments)))
    ahead = Window.partitionBy("name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (cut.groupBy(F.col("source").alias("name"), F.col("segment").alias("part")).agg(F.sum("size").alias("words"))
               .withColumn("offset", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
               .join(sources.withColumnRenamed("name", "named"), F.col("name").eqNullSafe(F.col("named")))
               .drop("words", "named"))
    inside = Window.partitionBy("source", "segment").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (cut.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, F.col("source").eqNullSafe(F.col("name")) & (F.col("segment") == F.col("part")))
              .select("doc_id", "source", "size", "source_index", "source_size", "target",
                      (F.col("offset") + F.col("inner")).alias("start")))
    pieces = (placed.filter("size > 0")
              .withColumn("block", F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")))
              .withColumn("from", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
              .withColumn("till", F.least(F.col("start") + F.col("size") - F.col("block") * block_words, F.lit(block_words))))
    return Mix(placed, pieces, slots(spark, quotas, seed), block_words)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline's last stage: every remaining document with the words that the mix takes of it."""
    release(ready(spark))
    return mix(docs).taken()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).taken().drop("source")
