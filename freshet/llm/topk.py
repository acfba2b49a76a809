"""Exact top-k inner product search by columnar branch and bound.

Vectors are turned into integers floor(scale * x). The queries are taken in blocks of about
``QUERY_BLOCK`` (a fixed bound on what is broadcast); every block meets all candidates.
A task keeps its candidates in vertical layout (one row of the matrix per dimension) and
adds up scores ``DIM_BLOCK`` dimensions at a time. After each step a candidate's score can
still grow by at most |rest of the query| * |rest of the candidate| (Cauchy-Schwarz on
the remaining mass); candidates whose bound is below the k-th best score of every query
of the group are compacted away, so later steps run over the survivors only. Dimensions
go by falling mass of the group's queries, which tightens the bounds early. Each task
emits its own k best a query, and a ranked window with a partial limit merges them.

Scores are exact: sums stay below 2**24 in float32 or 2**53 in float64, which is
checked against the vectors' largest components; beyond that Python integers are used.

Defined cases: vectors that are NULL or hold NULL or non-finite components, and rows
without an id, take no part. Exact repeats of a row count once; other rows with the
query's id are its own and skipped. Vectors of another length than the query's are no
candidates for it. Ties go to the smaller id. Empty tables give no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import ready, stored, table

QUERY_BLOCK = 4_096
QUERY_GROUP = 64
CANDIDATES = 8_192
DIM_BLOCK = 16


def integer_vectors(df: DataFrame, scale: int = 64, vec_id: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of the usable vectors, exact repeats once."""
    x = F.transform(F.col(vec), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (df.filter(F.col(vec).isNotNull() & F.col(vec_id).isNotNull() & ~bad)
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
            .dropDuplicates(["vec_id", "v"]))


class _Best:
    """Running k best of a group of queries of one length."""

    def __init__(self, numbers: list[int], ids: np.ndarray, matrix: np.ndarray, k: int):
        self.numbers, self.ids, self.k = numbers, ids, k
        self.order = np.argsort(-np.abs(matrix.astype(np.float64)).sum(axis=0), kind="stable")
        self.q = matrix[:, self.order]
        self.rest = _remaining(self.q.T).T
        self.floor = np.full(len(ids), -np.inf)
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in numbers]

    def add(self, ids: np.ndarray, columns: np.ndarray) -> None:
        exact = self.q.shape[1] * float(np.abs(self.q).max(initial=0)) * float(np.abs(columns).max(initial=0))
        kind = np.float32 if exact < 2**24 else np.float64 if exact < 2**53 else object
        c = columns[self.order]
        rest, alive = _remaining(c), np.arange(len(ids))
        q, c = self.q.astype(kind), c.astype(kind)
        part = np.zeros((len(q), len(ids)), kind)
        for d in range(0, len(c), DIM_BLOCK):
            part += q[:, d:d + DIM_BLOCK] @ c[d:d + DIM_BLOCK][:, alive] if len(alive) < len(ids) else q[:, d:d + DIM_BLOCK] @ c[d:d + DIM_BLOCK]
            e = min(d + DIM_BLOCK, len(c))
            upper = part + np.outer(self.rest[:, e], rest[e, alive])
            keep = (upper >= self.floor[:, None]).any(axis=0)
            if keep.mean() < 0.8:  # compaction
                alive, part = alive[keep], part[:, keep]
        ids = ids[alive]
        for j, number in enumerate(self.numbers):
            good = np.flatnonzero((part[j] >= self.floor[j]) & (ids != self.ids[j]))
            if len(good):
                score, other = self.found[j]
                score = np.concatenate([score, part[j][good].astype(np.int64)])
                other = np.concatenate([other, ids[good]])
                top = np.lexsort((other, -score))[:self.k]
                self.found[j] = score[top], other[top]
                if len(top) == self.k:
                    self.floor[j] = float(score[top[-1]]) * (1 - 1e-12) - 1e-6 if kind is object else float(score[top[-1]])


def _remaining(columns: np.ndarray) -> np.ndarray:
    """Norm of what is left from each dimension on (rounded up), with a zero row at the end."""
    squares = np.cumsum((columns.astype(np.float64) ** 2)[::-1], axis=0)[::-1]
    return np.vstack([np.sqrt(squares) * (1 + 1e-9), np.zeros((1, columns.shape[1]))])


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def search_block(candidates: DataFrame, block, k: int) -> DataFrame:
    """Each task's k best candidates for every query of a broadcast block [(query_id, number, vector)]."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list] = {}
        for query_id, number, v in block.value:
            by_length.setdefault(len(v), []).append((query_id, number, v))
        groups: dict[int, list[_Best]] = {}
        for n, rows in by_length.items():
            for a in range(0, len(rows), QUERY_GROUP):
                part = rows[a:a + QUERY_GROUP]
                groups.setdefault(n, []).append(_Best([r[1] for r in part], np.array([r[0] for r in part]),
                                                      np.array([r[2] for r in part], np.int64).reshape(len(part), n), k))
        waiting: dict[int, list] = {}

        def flush(n: int) -> None:
            ids = np.concatenate([w[0] for w in waiting[n]])
            columns = np.ascontiguousarray(np.concatenate([w[1] for w in waiting.pop(n)]).T)
            for g in groups[n]:
                g.add(ids, columns)

        for b in batches:
            ids, (flat, lengths) = b.column(0).to_numpy(), _rows(b.column(1))
            starts = np.cumsum(lengths) - lengths
            for n in np.unique(lengths).tolist():
                if n in groups:
                    at = np.flatnonzero(lengths == n)
                    waiting.setdefault(n, []).append((ids[at], flat[starts[at][:, None] + np.arange(n)]))
                    if sum(len(w[0]) for w in waiting[n]) >= CANDIDATES:
                        flush(n)
        for n in list(waiting):
            flush(n)
        for gs in groups.values():
            for g in gs:
                sizes = [len(s) for s, _ in g.found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(g.ids, sizes), pa.int64()), pa.array(np.repeat(np.array(g.numbers), sizes), pa.int64()),
                     pa.array(np.concatenate([o for _, o in g.found]), pa.int64()), pa.array(np.concatenate([s for s, _ in g.found]), pa.int64())],
                    names=["query_id", "number", "vec_id", "score"])

    return candidates.select("vec_id", "v").mapInArrow(run, "query_id long, number long, vec_id long, score long")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) over integer vectors (vec_id, v)."""
    spark = candidates.sparkSession
    n_blocks = max(1, -(-queries.count() // query_block))
    part, found = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)), None
    for number in range(n_blocks):  # one block at a time is held by the driver and the executors; its results are stored
        rows = sorted((r[0], list(r[1])) for r in queries.filter(part == number).select("vec_id", "v").collect())  # bounded by query_block
        block = spark.sparkContext.broadcast([(i, n, v) for n, (i, v) in enumerate(rows)])
        here = stored(search_block(candidates, block, k), "best")
        block.destroy()
        found = here if found is None else found.unionByName(here)
    best = Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    vectors = stored(integer_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"))


ORACLE = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""
