"""Vector code compression: integer product quantisation, assigned in the Walsh-Hadamard domain.

Components become integers floor(scale * x). Vectors are cut into ``parts`` equal consecutive parts;
each part position has a codebook of at most ``entries`` entries, which starts as that part of the
vectors of the smallest ids. A round assigns every part to its nearest entry (squared Euclidean
distance, ties to the lower index) and replaces each entry by floor(sum / count) of its parts.

Assignment, all in integers: parts and entries are zero-padded to a power of two n and go through the
integer Walsh-Hadamard transform, rows in sequency order (by sign changes, so the coefficients
that usually differ most come first). The transform keeps distances up to the factor n, so the squared
differences, added coefficient by coefficient, grow towards n times the squared distance. After the
first coefficients one promising entry a part is finished; every entry whose partial sum
exceeds that distance is eliminated, and what is left is compacted after each further
coefficient. An entry is dropped only when its sum is already larger than a reached one, so
distances and ties are exact. Numbers are int64 where a bound on the sums shows that they fit, else Python integers.

Spark does the passes: each round is one scan of the table with the codebooks (entries x dimensions
numbers, however many rows) broadcast; a task emits one partial sum an entry, which are added by
(part, entry). Only codebooks reach the driver. No vector is shuffled or stored.

Defined cases: vectors that are NULL or hold NULL or non-finite components are dropped. Shorter vectors
count as zero-padded to the longest kept one, and that to a multiple of ``parts``; empty ones are all zeros. The codebooks
start from distinct ids, NULL last; an id with several vectors starts with its smallest one. Repeated rows each
count and are each returned. Fewer ids than ``entries`` give fewer entries. An error beyond a long is NULL, and so
is the sum over its label. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
ROWS = 2_048  # rows a step, so that a step's table of partial sums stays small
FIRST = 2  # coefficients of all entries before the first elimination
LONG = 2**63 - 1


def usable(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, v, label) of the vectors without NULL or non-finite components, as doubles."""
    x = F.transform(F.col(vec), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.filter(F.col(vec).isNotNull() & ~bad).select(F.col(vec_id).alias("vec_id"), x.alias("v"), F.col(label).alias("label"))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64 where it fits, else Python integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if not len(y) or np.abs(y).max() < 2**62:
        return y.astype(np.int64)
    return np.array([math.floor(a * scale) if abs(a) < 2**52 else int(a) * scale for a in x.tolist()], object)


def hadamard(n: int) -> np.ndarray:
    """The n x n Walsh-Hadamard matrix (n a power of two), rows by their number of sign changes."""
    w = np.ones((1, 1), np.int64)
    while len(w) < n:
        w = np.block([[w, w], [w, -w]])
    return w[np.argsort((np.diff(w, axis=1) != 0).sum(axis=1), kind="stable")]


def transform(x: np.ndarray) -> np.ndarray:
    """Rows zero-padded to a power of two and transformed; squared distances grow by that power."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    padded = np.zeros((len(x), n), x.dtype)
    padded[:, :x.shape[1]] = x
    return padded @ hadamard(n).astype(x.dtype)


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The same arrays as int64 if every sum of an assignment fits, else as Python integers."""
    n = 1 << max(0, arrays[0].shape[1] - 1).bit_length()
    most = sum(max((abs(int(a.min())), abs(int(a.max()))), default=0) if a.size else 0 for a in arrays)
    kind = np.int64 if n * n * n * most * most < LONG else object  # n coefficients of at most n * most, squared and added
    return [a.astype(kind) for a in arrays]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry to each row; ties go to the lower index."""
    if not len(x):
        return np.empty(0, np.int64), np.empty(0, x.dtype)
    x, entries = _exact(x, entries)
    a, b = transform(x), transform(entries)
    n = a.shape[1]
    part = np.zeros((len(a), len(b)), a.dtype)
    for k in range(min(FIRST, n)):
        part += (a[:, k, None] - b[None, :, k]) ** 2
    guess = part.argmin(axis=1)
    bound = part[np.arange(len(a)), guess] + ((a[:, FIRST:] - b[guess, FIRST:]) ** 2).sum(axis=1)
    row, entry = np.nonzero(part <= bound[:, None])
    part = part[row, entry]
    for k in range(FIRST, n):
        part = part + (a[row, k] - b[entry, k]) ** 2
        keep = part <= bound[row]
        row, entry, part = row[keep], entry[keep], part[keep]
    # every row still has its guess; rows and entries ascend, so the first of the smallest is the lowest index
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    best = np.minimum.reduceat(part, starts)
    at = np.flatnonzero(part == best[row])
    at = at[np.r_[True, row[at][1:] != row[at][:-1]]]
    return entry[at], best // n


def _blocks(batch: pa.RecordBatch, column: int, width: int, scale: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer rows of ``width``) of a batch's list column, zero-padded."""
    v = batch.column(column)
    ends = v.offsets.to_numpy()
    flat = v.values.to_numpy(zero_copy_only=False)
    for start in range(0, len(v), ROWS):
        stop = min(start + ROWS, len(v))
        lengths = np.diff(ends[start:stop + 1])
        numbers = whole(flat[ends[start]:ends[stop]], scale)
        if (lengths == width).all():
            yield start, numbers.reshape(-1, width)
        else:
            out = np.zeros((stop - start, width), numbers.dtype)
            out[np.arange(width)[None, :] < lengths[:, None]] = numbers
            yield start, out


def _assign(block: np.ndarray, codebooks: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    length = block.shape[1] // len(codebooks)
    for p, entries in enumerate(codebooks):
        x = block[:, p * length:(p + 1) * length]
        yield p, x, *nearest(x, entries)


def first_codebooks(vectors: DataFrame, width: int, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """The parts of the vectors of the smallest ids (at most ``entries`` rows reach the driver)."""
    ids = vectors.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries)
    mine = vectors.join(F.broadcast(ids.withColumnRenamed("vec_id", "i")), F.col("vec_id").eqNullSafe(F.col("i")))
    rows = mine.groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(F.asc_nulls_last("vec_id")).collect()
    padded = [np.pad(np.asarray(r["v"], float), (0, width - len(r["v"]))) for r in rows]
    first = whole(np.concatenate(padded), scale).reshape(len(rows), width)
    return [first[:, p * (width // parts):(p + 1) * (width // parts)] for p in range(parts)]


def updated(vectors: DataFrame, codebooks: list[np.ndarray], scale: int) -> list[np.ndarray]:
    """Each entry replaced by the floored mean of its parts; entries without parts stay."""
    sent = vectors.sparkSession.sparkContext.broadcast(codebooks)
    width = sum(c.shape[1] for c in codebooks)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        count = [np.zeros(len(c), np.int64) for c in books]
        total = [np.zeros(c.shape, object) for c in books]  # Python integers: exact for any number of rows
        for b in batches:
            for _, block in _blocks(b, 0, width, scale):
                for p, x, entry, _ in _assign(block, books):
                    count[p] += np.bincount(entry, minlength=len(books[p]))
                    x = x if x.dtype == object or np.abs(x).max() < 2**50 else x.astype(object)
                    here = np.zeros(total[p].shape, x.dtype)
                    np.add.at(here, entry, x)
                    total[p] += here.astype(object)
        rows = [(p, e, int(n), ",".join(map(str, total[p][e].tolist()))) for p, c in enumerate(count) for e, n in enumerate(c) if n]
        yield pa.RecordBatch.from_pylist([dict(zip(("p", "e", "n", "s"), r, strict=True)) for r in rows], schema=kind)

    kind = pa.schema([("p", pa.int32()), ("e", pa.int32()), ("n", pa.int64()), ("s", pa.string())])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        total = [sum(column) for column in zip(*([int(x) for x in s.split(",")] for s in rows["s"]), strict=True)]
        n = int(rows["n"].sum())
        return pd.DataFrame([(rows["p"].iloc[0], rows["e"].iloc[0], ",".join(str(t // n) for t in total))], columns=["p", "e", "s"])

    # one row a task and entry goes in, one an entry comes out
    means = (vectors.select("v").mapInArrow(sums, "p int, e int, n long, s string")
             .groupBy("p", "e").applyInPandas(added, "p int, e int, s string").collect())
    sent.destroy()
    books = [[list(map(int, e)) for e in c.tolist()] for c in codebooks]
    for r in means:
        books[r["p"]][r["e"]] = [int(x) for x in r["s"].split(",")]
    return [_narrow(b) for b in books]


def _narrow(entries: list[list[int]]) -> np.ndarray:
    most = max((abs(x) for e in entries for x in e), default=0)
    return np.array(entries, np.int64 if most < 2**62 else object).reshape(len(entries), -1)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list[np.ndarray]:
    """One codebook (entries x part length) a part position; none where the table is empty."""
    longest = vectors.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return []
    width = max(1, -(-longest // parts)) * parts
    codebooks = first_codebooks(vectors, width, parts, entries, scale)
    for _ in range(rounds):
        codebooks = updated(vectors, codebooks, scale)
    return codebooks


def encode(vectors: DataFrame, codebooks: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error): one byte a part as two hex digits, and the squared distance to what it stands for."""
    spark, width = vectors.sparkSession, sum(c.shape[1] for c in codebooks)
    if any(len(c) > 256 for c in codebooks):
        raise ValueError("a code holds one byte a part: at most 256 entries")
    sent = spark.sparkContext.broadcast(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, errors = [], []
            for _, block in _blocks(b, 2, width, scale):
                code, error = np.zeros((len(block), len(sent.value)), np.uint8), np.zeros(len(block), object)
                for p, _, entry, far in _assign(block, sent.value):
                    code[:, p], error = entry, error + far.astype(object)
                codes += [bytes(c).hex() for c in code]
                errors += [e if e <= LONG else None for e in map(int, error)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    return vectors.select("vec_id", "label", "v").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decode(code: str, codebooks: list[np.ndarray]) -> list[int]:
    """The integer vector a code stands for."""
    return [int(x) for entries, e in zip(codebooks, bytes.fromhex(code), strict=True) for x in entries[e].tolist()]


def digest_of(codebooks: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for c in codebooks for x in c.reshape(-1).tolist()).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"))
    codebooks = train(vectors)
    coded = stored(encode(vectors, codebooks), "codes") if codebooks else encode(vectors, codebooks)
    label_sum = F.when(F.count("*") == F.count("error"), F.try_sum(F.col("error").cast("decimal(38,0)")))
    # one row a label: broadcast below the planner's threshold; beyond it AQE splits a hot label
    by_label = coded.groupBy("label").agg(label_sum.try_cast("bigint").alias("label_error")).withColumnRenamed("label", "of")
    out = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest_of(codebooks)).alias("codebooks_sha256"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds over (row, part, position) rows; every part meets its own codebook only."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
dist{r} AS (SELECT x.r, x.p, b.e, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN book{r} b ON b.p = x.p AND b.j = x.j GROUP BY x.r, x.p, b.e),
near{r} AS (SELECT r, p, arg_min(e, d * {entries} + e) AS e, min(d) AS d FROM dist{r} GROUP BY r, p)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (SELECT x.p, n.e, x.j, sum(x.v) AS s, count(*) AS c FROM x JOIN near{r} n ON n.r = x.r AND n.p = x.p GROUP BY x.p, n.e, x.j),
book{r + 1} AS (SELECT b.p, b.e, b.j, coalesce((m.s - ((m.s % m.c) + m.c) % m.c) // m.c, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m USING (p, e, j))""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, [CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS v, row_number() OVER (ORDER BY vec_id) AS r
  FROM embeddings WHERE embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
x AS (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS j, v[i] AS v
  FROM (SELECT r, v, len(v) // {parts} AS w, unnest(range(1, len(v) + 1)) AS i FROM kept)),
book0 AS (SELECT x.p, x.r - 1 AS e, x.j, x.v FROM x WHERE x.r <= {entries}),{','.join(steps)},
coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', n.e), '' ORDER BY n.p) AS code, CAST(sum(n.d) AS BIGINT) AS error
  FROM kept k JOIN near{rounds} n ON n.r = k.r GROUP BY k.r, k.vec_id, k.label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


ORACLE = _oracle()
