"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A document's set holds its distinct ``shingle``-word shingles (words
``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; fewer words: the whole sequence as
one). Documents link when 100 * intersection >= ``percent`` * union, on the full sets.

1. One pass signs every document: set size, a 128-bit hash of the set, and ``SYMBOLS`` = 60
   minima of which ``b`` = 16 bits each are kept. Documents of equal sets
   fall into one class (a partially aggregated min); classes go on, copies do not.
2. Signatures are split into chunks. By the pigeonhole principle two signatures at Hamming
   distance <= radius = chunks * (ERRORS + 1) - 1 have a chunk with at most ERRORS = 1
   wrong symbol; enumerating the place of that error (every chunk with one symbol left
   out is a key) finds *all* such pairs. ``layout`` takes the longest chunks whose radius
   loses at most MOST_LOST of the links right at ``percent`` (a binomial tail) and refuses a
   ``percent`` that none of them serves (below 65). At 0.80 and 0.85: 15 chunks of 4, radius 29,
   a loss of 2.1e-7 and 2.1e-10 of the border links; more similar links are lost far less often.
3. Keys held by one class are dropped. The other buckets are first joined by one pivot each
   (the smallest class), not by all pairs: where all members are near one text this costs
   one comparison a member and already connects them.
4. Only pairs from *different* components can still add anything. Buckets that still span
   several, with fewer than ``LARGE_BUCKET`` members, are joined with themselves. Larger ones
   are cut into blocks of ``BLOCK_CLASSES``; block pairs are compared in numpy and hand on a pair
   only if sizes, signatures and an exact bound allow a link: with the shingles dealt into
   ``GROUPS`` groups, the sum of the smaller counts of each group is never below the overlap.
   In the buckets of the first chunks each class first hands on its ``BEST`` nearest pairs, which
   connects most of a group; what is then still apart is compared in full, in all buckets. Every pair of a bucket is thus compared, bounded away or already connected.
5. Pairs within the radius are confirmed on the full sets of the texts; components are
   merged by min-label propagation with shortcuts over the links.

Nothing is capped: of the pairs that could join two components only those beyond the radius are
left out, with the probability above; other links of a group may still connect theirs.

Defined cases: NULL, empty or blank texts have no shingles and link with nothing. Rows
with a NULL doc_id stay alone (component NULL, kept; the pipeline's stage groups them as all others).
Repeated rows are exact copies with the same id and give equal results. Empty tables give no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from math import comb
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import as_bytes, ready, release, split64, stored, table, text_key

SYMBOLS = 60
ERRORS = 1
LAYOUTS = ((12, 5), (15, 4), (20, 3))  # (chunks, symbols a chunk); SYMBOLS keys a class in each
MOST_LOST = 1e-6
SHINGLE = 5
PERCENT = 80
LARGE_BUCKET = 32
BLOCK_CLASSES = 2_048
GROUPS = 512
BEST = 4
FIRST_CHUNKS = 3
CHUNK_BITS = 5
LINKS_A_FILE = 1_000_000
_BLOCK = 2_048
_CACHE = 200_000



class Layout(NamedTuple):
    chunks: int
    width: int
    radius: int


def lost(percent: int, radius: int) -> float:
    """Probability that a pair at exactly this similarity differs in more than ``radius`` symbols."""
    s = percent / 100
    return sum(comb(SYMBOLS, k) * (1 - s) ** k * s ** (SYMBOLS - k) for k in range(radius + 1, SYMBOLS + 1))


def layout(percent: int) -> Layout:
    """The longest chunks whose radius loses at most MOST_LOST of the links at ``percent``."""
    for chunks, width in LAYOUTS:
        radius = chunks * (ERRORS + 1) - 1
        if lost(percent, radius) <= MOST_LOST:
            return Layout(chunks, width, radius)
    raise ValueError(f"signatures of {SYMBOLS} symbols can't find the links of {percent} percent similarity: "
                     f"a radius of {radius} would lose {lost(percent, radius):.1e} of them")


CHUNKS, WIDTH, RADIUS = layout(PERCENT)

_RNG = np.random.default_rng(20_240_229)
_MULTIPLY = _RNG.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _RNG.integers(0, 2**63, SYMBOLS, dtype=np.uint64)


class _WordHash(dict):
    """64-bit hash of a word, remembered; emptied when full, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: bytes | None, width: int, words: _WordHash) -> np.ndarray:
    """Distinct 64-bit shingle hashes of a text, sorted."""
    w = text.lower().split() if text else []
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    n = max(1, len(w) - width + 1)
    out = np.full(n, len(w) if len(w) < width else width, np.uint64)
    for k in range(min(width, len(w))):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= h[k:k + n]
        out ^= out >> np.uint64(29)
    return np.unique(split64(out))


def signature(h: np.ndarray) -> np.ndarray:
    """The low 16 bits of each of the minima."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(h), _BLOCK):
        np.minimum(low, ((h[None, a:a + _BLOCK] ^ _FLIP[:, None]) * _MULTIPLY[:, None]).min(axis=1), out=low)
    return low.astype(np.uint16)


def sign(docs: DataFrame, shingle: int = SHINGLE, doc: str = "doc_id", text: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHash()
        for b in batches:
            n, one, two, sig = [], [], [], []
            for t in as_bytes(b.column(2)):
                h = shingle_hashes(t, shingle, words)
                n.append(len(h))
                one.append(h.sum(dtype=np.uint64).astype(np.int64) if len(h) else None)
                two.append(np.bitwise_xor.reduce(h * (h >> np.uint64(7) | np.uint64(1))).astype(np.int64) if len(h) else None)
                sig.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                 pa.array(sig, pa.binary())], names=["doc_id", "row_key", "n_shingles", "h1", "h2", "signature"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), text_key(text).alias("row_key"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, row_key long, n_shingles long, h1 long, h2 long, signature binary")


def chunk_keys(classes: DataFrame, shape: Layout) -> DataFrame:
    """(bucket key, class): every chunk with each one of its symbols left out; a key's low CHUNK_BITS bits are its chunk."""
    chunks, width = shape.chunks, shape.width
    low = np.uint64((1 << CHUNK_BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, chunks, width).astype(np.uint64)
            keys = np.empty((len(sig), chunks, width), np.uint64)
            for out in range(width):
                k = np.broadcast_to(np.arange(chunks, dtype=np.uint64) * np.uint64(width) + np.uint64(out + 1), (len(sig), chunks)).copy()
                split64(k)
                packed = np.zeros_like(k)
                for j in range(width):
                    if j != out:
                        packed = packed << np.uint64(16) | sig[:, :, j]
                keys[:, :, out] = (split64(packed) ^ k) & ~low | np.arange(chunks, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(b.column(0).to_numpy(), SYMBOLS))], names=["key", "c"])

    return classes.select("c", "signature").mapInArrow(run, "key long, c long")


def sketches(texts: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(c, n, signature, counts): a class's shingles counted by group (one byte each; 255 says 'or more')."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHash()
        for b in batches:
            counts = []
            for t in as_bytes(b.column(1)):
                by = np.bincount((shingle_hashes(t, shingle, words) >> np.uint64(20)).astype(np.int64) % GROUPS, minlength=GROUPS)
                counts.append(np.minimum(by, 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(counts, pa.binary())], names=["c", "counts"])

    return texts.select("c", "text").mapInArrow(run, "c long, counts binary").join(classes.select("c", "n", "signature"), "c")


def block_pairs(members: DataFrame, sketch: DataFrame, percent: int, radius: int, best: int | None) -> DataFrame:
    """Pairs of different components that large buckets hand on: each class's ``best`` nearest, or all.

    ``members``: (key, c, label, size). A bucket of more than BLOCK_CLASSES classes is cut into
    blocks by hash, and each class goes to every pair of blocks that holds its own.
    """
    def compare(rows: pa.Table) -> pa.Table:
        own, i, j = rows["own"].to_numpy(), rows["i"][0].as_py(), rows["j"][0].as_py()
        c, label, n = (rows[k].to_numpy() for k in ("c", "label", "n"))
        sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint16).reshape(len(c), -1)
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8).reshape(len(c), -1)
        loose = (counts == 255).any(axis=1)
        left, right, values = np.flatnonzero(own == i), np.flatnonzero(own == j), np.unique(label, return_counts=True)
        if i == j:  # inside a block: from the members of the smaller components
            left = np.flatnonzero(label != values[0][values[1].argmax()])
        out_c, out_p = [], []
        for x in left.tolist():
            y = right[label[right] != label[x]]
            y = y[np.minimum(n[y], n[x]) * 100 >= np.maximum(n[y], n[x]) * percent]
            far = (sig[y] != sig[x]).sum(axis=1)
            y, far = y[far <= radius], far[far <= radius]
            both = np.minimum(counts[y], counts[x]).sum(axis=1, dtype=np.int64)
            ok = loose[y] | loose[x] | (100 * both >= percent * (n[y] + n[x] - both))
            y = y[ok] if best is None else y[ok][np.argsort(far[ok], kind="stable")[:best]]
            out_c.append(np.full(len(y), c[x]))
            out_p.append(c[y])
        return pa.table({"c": np.concatenate([*out_c, np.empty(0, np.int64)]), "p": np.concatenate([*out_p, np.empty(0, np.int64)])})

    blocks = F.ceil(F.col("size") / BLOCK_CLASSES).cast("int")
    own = F.pmod(F.xxhash64("c"), blocks).cast("int")
    rows = members.select("key", "c", "label", "size")
    whole = rows.filter(F.col("size") <= BLOCK_CLASSES).select("*", *[F.lit(0).alias(x) for x in ("own", "with", "i", "j")])
    dealt = (rows.filter(F.col("size") > BLOCK_CLASSES).withColumn("own", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("i", F.least("own", "with")).withColumn("j", F.greatest("own", "with")))
    return (whole.unionByName(dealt).join(sketch, "c").select("key", "i", "j", "own", "c", "label", "n", "signature", "counts")
            .groupBy("key", "i", "j").applyInArrow(compare, "c long, p long").distinct())


def within_radius(pairs: DataFrame, classes: DataFrame, percent: int, radius: int) -> DataFrame:
    """The pairs whose sizes allow a link and whose signatures differ in at most ``radius`` symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint16).reshape(-1, SYMBOLS) for k in (2, 3))
            near = pa.array((x != y).sum(axis=1) <= radius)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(near), b.column(1).filter(near)], names=["c", "p"])

    left = classes.select("c", F.col("n").alias("n1"), F.col("signature").alias("s1"))
    right = classes.select(F.col("c").alias("p"), F.col("n").alias("n2"), F.col("signature").alias("s2"))
    return (pairs.join(left, "c").join(right, "p").filter(F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent)
            .select("c", "p", "s1", "s2").mapInArrow(run, "c long, p long").distinct())


def shingle_set(text: bytes, width: int) -> frozenset:
    w = text.lower().split()
    return frozenset(zip(*(w[k:] for k in range(width)))) if len(w) >= width else frozenset([tuple(w)] if w else [])


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets meet the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: OrderedDict[bytes, frozenset] = OrderedDict()  # the last few pivots: rows come sorted by pivot

        def pivot_set(t: bytes) -> frozenset:
            if t not in seen:
                if len(seen) >= 4:
                    seen.popitem(last=False)
                seen[t] = shingle_set(t, shingle)
            return seen[t]

        for b in batches:
            keep = []
            for x, y in zip(as_bytes(b.column(2)), as_bytes(b.column(3)), strict=True):
                s, t = shingle_set(x, shingle), pivot_set(y)
                both = len(s & t)
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            ok = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], names=["c", "p"])

    return (pairs.join(texts.select("c", F.col("text").alias("t1")), "c")
            .join(texts.select(F.col("c").alias("p"), F.col("text").alias("t2")), "p")
            .select("c", "p", "t1", "t2").mapInArrow(run, "c long, p long").distinct())


def components(links: DataFrame) -> DataFrame:
    """(c, label): the smallest node reachable from each node of ``links`` (c, p)."""
    both = stored(links.select("c", "p").union(links.select("p", "c")).filter("c <> p").distinct(), "links")
    files = 1 + both.count() // LINKS_A_FILE  # labels are narrow: as many files as they need, not one a shuffle partition
    label = stored(both.groupBy("c").agg(F.least(F.col("c"), F.min("p")).alias("label")).coalesce(files), "labels")
    while True:
        near = both.join(label.select(F.col("c").alias("p"), F.col("label").alias("via")), "p").groupBy("c").agg(F.min("via").alias("via"))
        low = label.join(near, "c").select("c", F.col("label").alias("old"), F.least("label", "via").alias("low"))
        hop = label.select(F.col("c").alias("low"), F.col("label").alias("further"))
        step = stored(low.join(hop, "low", "left").select("c", "old", F.least("low", F.coalesce("further", "low")).alias("label")).coalesce(files), "labels")
        label = step.select("c", "label")
        if step.filter("label <> old").isEmpty():
            return label


def set_classes(signed: DataFrame) -> DataFrame:
    """(doc_id, row_key, n, signature, h1, h2): one row per distinct set, with its first document."""
    return signed.filter("n_shingles > 0").groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "row_key")).alias("first"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")).select(
        "first.doc_id", "first.row_key", "n", "signature", "h1", "h2")


def linked(docs: DataFrame, classes: DataFrame, shingle: int, percent: int, doc: str, text: str) -> DataFrame:
    """(c, label): the smallest ``c`` reachable from each class that has a link; ``classes`` has a key ``c``."""
    spark, shape = docs.sparkSession, layout(percent)
    keys = chunk_keys(classes, shape)
    # each of the next steps shuffles as much as all keys or texts: none keeps its files while the next one runs
    shared = stored(keys.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("key", "lo"), "shared")
    release(spark)
    members = stored(keys.join(shared, "key"), "members")
    release(spark, shared)
    needed = members.select("c").distinct().join(classes.select("c", F.col("doc_id").alias("d"), F.col("row_key").alias("k")), "c")
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), text_key(text).alias("row_key"), F.col(text).alias("text"))
    texts = stored(rows.join(needed, rows["doc_id"].eqNullSafe(needed["d"]) & (rows["row_key"] == needed["k"]))
                   .groupBy("c", "row_key").agg(F.first("text").alias("text")).select("c", "text"), "texts")
    release(spark)
    links = spark.createDataFrame([], "c long, p long")

    def apart(members: DataFrame, label: DataFrame) -> DataFrame:
        """(key, c, label, size) of the buckets that still span several components; closed ones never open again."""
        now = members.join(label, "c", "left").select("key", "c", F.coalesce("label", "c").alias("label"))
        open_ = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).filter("lo < hi")
        return stored(now.join(open_.select("key", "size"), "key"), "open")

    def merged(pairs: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        near = stored(within_radius(pairs, classes, percent, shape.radius), "pairs")
        found = links.unionByName(stored(confirmed(near, texts, shingle, percent), "found"))
        label = components(found)
        release(spark, near)
        return found, label

    links, label = merged(members.filter("c <> lo").select("c", F.col("lo").alias("p")).distinct(), links)
    now = apart(members.select("key", "c"), label)
    release(spark, members, label)  # buckets of one component are done: what follows reads the open ones
    sketch = stored(sketches(texts.join(now.select("c").distinct(), "c", "left_semi"), classes, shingle), "sketches")
    small, large = now.filter(F.col("size") < LARGE_BUCKET), now.filter(F.col("size") >= LARGE_BUCKET)
    other = small.select("key", F.col("c").alias("p"), F.col("label").alias("at"))
    pairs = small.join(other, "key").filter("c < p AND label <> at").select("c", "p").distinct()
    first = large.filter(F.col("key").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)) < FIRST_CHUNKS)
    links, label = merged(pairs.unionByName(block_pairs(first, sketch, percent, shape.radius, BEST)).distinct(), links)
    still = apart(now.select("key", "c"), label)
    large = still.filter(F.col("size") >= LARGE_BUCKET)
    if not large.isEmpty():
        old, (links, label) = label, merged(block_pairs(large, sketch, percent, shape.radius, None), links)
        release(spark, old)
    release(spark, now, still, sketch, texts, links)
    return label


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_shingles, component_id (smallest id reachable), kept (is that one)."""
    layout(percent)
    signed = stored(sign(docs, shingle, doc, text), "signed")
    classes = stored(set_classes(signed.filter("doc_id IS NOT NULL")).withColumn("c", F.col("doc_id")), "classes")
    label = linked(docs, classes, shingle, percent, doc, text)
    of = classes.select("h1", "h2", "c").join(label, "c", "left").select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.coalesce("label", "c").alias("component"))
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return signed.join(of, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left").select(
        "doc_id", "row_key", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each near-duplicate group (5-word shingles, 0.8), with all its columns.

    The classes of equal sets have keys of their own here, so rows without an id and different
    texts of one id belong to groups as all others do. Of a group the smallest (id, text hash) stays,
    no id last, and one of equal rows. Texts without shingles link with nothing: equal rows of them are
    reduced to one by their id, those without an id all stay.
    """
    release(ready(spark))
    signed = stored(sign(docs), "signed")
    classes = stored(set_classes(signed).withColumn("c", F.monotonically_increasing_id()), "classes")
    label = linked(docs, classes, SHINGLE, PERCENT, "doc_id", "text")
    of = classes.select("h1", "h2", "c").join(label, "c", "left").select("h1", "h2", F.coalesce("label", "c").alias("component"))
    each = signed.groupBy("doc_id", "row_key", "n_shingles", "h1", "h2").agg(F.count("*").alias("rows"))
    members = stored(each.filter("n_shingles > 0").join(of, ["h1", "h2"])
                     .select("component", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key").alias("row"), "rows"), "groups")
    first = members.groupBy("component").agg(F.min("row").alias("first"))
    bare = each.filter("n_shingles = 0 AND doc_id IS NOT NULL").select("doc_id", "row_key", F.lit(True).alias("stays"), "rows")
    known = members.join(first, "component").select("row.doc_id", "row.row_key", (F.col("row") == F.col("first")).alias("stays"), "rows").unionByName(bare)
    touched = stored(known.filter("NOT stays OR rows > 1").select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), "stays"), "touched")

    release(spark, signed, classes, members, label)  # ``touched`` is all that the last join reads beside the documents

    def at(rows: DataFrame):
        return F.col("doc_id").cast("long").eqNullSafe(rows["__id"]) & (text_key() == rows["__key"])

    out = docs.join(touched, at(touched), "left_anti")
    repeated = touched.filter("stays")
    if repeated.isEmpty():
        return out
    equal = Window.partitionBy(F.col("doc_id").cast("long"), text_key()).orderBy(F.xxhash64(*docs.columns))
    return out.unionByName(docs.join(repeated, at(repeated), "left_semi").withColumn("__n", F.row_number().over(equal)).filter("__n = 1").drop("__n"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85).drop("row_key")


ORACLE = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS s FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingle a JOIN shingle b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN size p ON p.doc_id = a.doc_id JOIN size q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS r FROM doc
  UNION SELECT reach.doc_id, link.y FROM reach JOIN link ON link.x = reach.r)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM doc d LEFT JOIN size USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
