"""Benchmark decontamination over a distributed positional inverted index.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are
lower-cased. A benchmark item is cut into windows of ``width`` consecutive words
(an item of fewer words, but not none, is one window).

1. The (item, window) rows are dealt into blocks of about ``BLOCK_WINDOWS`` rows.
   One block at a time is broadcast, so what is broadcast has a fixed bound however
   large the benchmark grows; every block meets all documents.
2. ``positional_index`` stores, sharded by document, the postings of the block's
   terms: per document the sorted term ids, their counts and their positions.
3. Corpus counts of the terms come from the stored index. Each window is then
   looked up from its rarest term: the rarest list gives candidate starts
   (position - offset), and the other terms' lists, from rare to common, are
   intersected with them after the same adjustment. What remains after all terms
   is an exact occurrence; the texts are not read again. With ``slop`` the windows
   are matched by proximity instead: all distinct terms within ``width + slop`` words.
4. Spans of all blocks are merged per document in one small aggregate.

Nothing is shuffled but the rows of documents with a match and one narrow row a
document, so neither a hot source nor a passage that a third of the documents
share makes a hot task.

Defined cases: NULL and empty texts have no words and are never contaminated. A
NULL ``item_id`` still hits words, but isn't listed or counted. Repeated rows each
get their own, equal result. Empty tables give empty or clean results. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import as_bytes, int_lists, ready, release, same_row, stored, table, text_key

WIDTH = 13
BLOCK_WINDOWS = 50_000

# word bytes map to themselves (A-Z to a-z), all others to a blank
_KEEP = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
              for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_KEEP).split() if text else []


def item_windows(benchmark: DataFrame, width: int = WIDTH, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, window) rows; the window is its words joined by blanks."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items, windows = [], []
            for i, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1)), strict=True):
                w = words_of(t)
                for s in range(max(1, len(w) - width + 1) if w else 0):
                    items.append(i)
                    windows.append(b" ".join(w[s:s + width]).decode())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.string())],
                                             names=["item", "window"])

    return (benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
            .mapInArrow(cut, "item string, window string").distinct())


class Block:
    """A bounded block of windows: term ids, padded term matrix, and the items of each window."""

    def __init__(self, rows: list[tuple[str | None, str]]):
        windows = sorted({w for _, w in rows})
        number = {w: k for k, w in enumerate(windows)}
        split = [w.encode().split(b" ") for w in windows]
        self.terms = {t: k for k, t in enumerate(sorted({t for w in split for t in w}))}
        self.length = np.array([len(w) for w in split], np.int64)
        self.words = np.full((len(windows), int(self.length.max(initial=1))), -1, np.int64)
        for k, w in enumerate(split):
            self.words[k, :len(w)] = [self.terms[t] for t in w]
        self.items: list[list[str]] = [[] for _ in windows]
        for i, w in rows:
            if i is not None:
                self.items[number[w]].append(i)

    def rank(self, counts: np.ndarray) -> None:
        """Order each window's offsets from its rarest to its commonest term."""
        by = np.where(self.words >= 0, counts[self.words], np.iinfo(np.int64).max)
        self.order = np.argsort(by, axis=1, kind="stable")
        anchor = np.take_along_axis(self.words, self.order[:, :1], 1)[:, 0]
        self.by_anchor = np.argsort(anchor, kind="stable")
        self.first = np.searchsorted(anchor[self.by_anchor], np.arange(len(self.terms) + 1))


def positional_index(docs: DataFrame, block, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings of the block's terms, one row a document (``block``: a broadcast ``Block``)."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = block.value.terms
        v = max(len(number), 1)
        for b in batches:
            n_words, tokens = [], []
            for t in as_bytes(b.column(2)):
                w = words_of(t)
                n_words.append(len(w))
                tokens.append(np.fromiter(map(number.get, w, repeat(-1)), np.int32, len(w)))
            counts = np.array(n_words, np.int64)
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
            row = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
            known = flat >= 0
            code, place = row[known] * v + flat[known], place[known]
            order = np.argsort(code, kind="stable")  # positions stay ascending within a list
            code, place = code[order], place[order]
            starts = np.flatnonzero(np.diff(code, prepend=-1))
            head = code[starts]
            lists = np.bincount(head // v, minlength=len(counts))
            places = np.bincount(code // v, minlength=len(counts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(counts, pa.int64()),
                 int_lists((head % v).astype(np.int32), lists, pa.int32()),
                 int_lists(np.diff(starts, append=len(code)).astype(np.int32), lists, pa.int32()),
                 int_lists(place.astype(np.int32), places, pa.int32())],
                names=["doc_id", "row_key", "n_words", "terms", "counts", "positions"])

    return (docs.select(F.col(doc).cast("long").alias("doc_id"), text_key(text).alias("row_key"), F.col(text).alias("t"))
            .mapInArrow(build, "doc_id long, row_key long, n_words long, terms array<int>, counts array<int>, "
                               "positions array<int>"))


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Occurrences of each of the block's terms in the corpus."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            t, c = (x.flatten().to_numpy(zero_copy_only=False) for x in b.columns)
            total += np.bincount(t, weights=c, minlength=n_terms).astype(np.int64)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k], pa.int64())], names=["term", "n"])

    out = np.zeros(n_terms, np.int64)
    rows = index.select("terms", "counts").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in rows.collect():  # at most the block's terms
        out[term] = n
    return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), lengths


def phrases(block: Block, n_words: np.ndarray, terms: pa.Array, counts: pa.Array, positions: pa.Array):
    """(row, window, start) of every exact occurrence, by offset-adjusted intersection."""
    term, per_row = _flat(terms)
    count, _ = _flat(counts)
    place, _ = _flat(positions)
    v = max(len(block.terms), 1)
    row = np.repeat(np.arange(len(per_row)), per_row)
    key = row * v + term
    span = int(n_words.max(initial=0)) + 1
    posting = np.repeat(np.arange(len(key)), count) * span + place
    begin = np.cumsum(count) - count
    # rarest lists: every posting of an anchor term meets the windows anchored there
    n_anchored = block.first[term + 1] - block.first[term]
    lists = np.flatnonzero(n_anchored)
    reps = count[lists]
    entry = np.repeat(lists, reps)
    at = np.repeat(begin[lists], reps) + np.arange(len(entry)) - np.repeat(np.cumsum(reps) - reps, reps)
    fan = n_anchored[entry]
    cand = np.repeat(np.arange(len(entry)), fan)
    nth = np.arange(len(cand)) - np.repeat(np.cumsum(fan) - fan, fan)
    window = block.by_anchor[block.first[term[entry[cand]]] + nth]
    start = place[at[cand]] - block.order[window, 0]
    doc = row[entry[cand]]
    ok = (start >= 0) & (start + block.length[window] <= n_words[doc])
    doc, window, start = doc[ok], window[ok], start[ok]
    for step in range(1, block.words.shape[1]):  # then the next rarer lists, on what is left
        open_ = step < block.length[window]
        off = block.order[window, step]
        want = doc * v + np.where(open_, block.words[window, off], 0)
        e = np.minimum(np.searchsorted(key, want), max(len(key) - 1, 0))
        code = e * span + start + off
        p = np.minimum(np.searchsorted(posting, code), max(len(posting) - 1, 0))
        ok = ~open_ | ((key[e] == want) & (posting[p] == code)) if len(key) else ~open_
        doc, window, start = doc[ok], window[ok], start[ok]
    return doc, window, start


def proximities(block: Block, slop: int, terms: pa.Array, counts: pa.Array, positions: pa.Array):
    """(row, window, start, end): shortest spans holding all distinct terms within length + slop words."""
    for row, (ts, cs, ps) in enumerate(zip(terms.to_pylist(), counts.to_pylist(), positions.to_pylist(), strict=True)):
        cuts = np.cumsum(cs)
        lists = {t: ps[e - c:e] for t, c, e in zip(ts, cs, cuts.tolist(), strict=True)}
        for t in ts:
            for w in block.by_anchor[block.first[t]:block.first[t + 1]].tolist():
                need = set(block.words[w, :block.length[w]].tolist())
                if not need <= lists.keys():
                    continue
                merged = sorted((p, x) for x in need for p in lists[x])
                last: dict[int, int] = {}
                for p, x in merged:
                    last[x] = p
                    if len(last) == len(need) and p - (s := min(last.values())) < block.length[w] + slop:
                        yield row, w, s, p + 1


def search(index: DataFrame, block, slop: int | None = None) -> DataFrame:
    """One row for each document with a match: its merged word spans and the items found."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = block.value
        for b in batches:
            found: dict[int, tuple[list, set]] = {}
            if slop is None:
                doc, window, start = phrases(at, b.column(2).to_numpy(), *b.columns[3:])
                hits = zip(doc.tolist(), window.tolist(), start.tolist(), (start + at.length[window]).tolist(), strict=True)
            else:
                hits = proximities(at, slop, *b.columns[3:])
            for d, w, s, e in hits:
                spans, seen = found.setdefault(d, ([], set()))
                spans.append((s, e))
                seen.add(w)
            ids, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = {"doc_id": [], "row_key": [], "spans": [], "items": []}
            for d, (spans, seen) in found.items():
                merged: list[list[int]] = []
                for s, e in sorted(spans):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                out["doc_id"].append(ids[d])
                out["row_key"].append(keys[d])
                out["spans"].append([{"s": s, "e": e} for s, e in merged])
                out["items"].append(sorted({i for w in seen for i in at.items[w]}))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema(
                {"doc_id": pa.int64(), "row_key": pa.int64(),
                 "spans": pa.list_(pa.struct({"s": pa.int32(), "e": pa.int32()})), "items": pa.list_(pa.string())}))

    return index.mapInArrow(find, "doc_id long, row_key long, spans array<struct<s:int,e:int>>, items array<string>")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, slop: int | None = None,
                  share: int = 20, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: n_words, n_hit, the found items (sorted) and whether it is contaminated.

    contaminated: n_hit > 0 and share * n_hit >= n_words.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark, width), "windows")
    n_blocks = max(1, -(-windows.count() // block_windows))
    part = F.pmod(F.xxhash64("window", "item"), F.lit(n_blocks))
    base, found = None, None
    for k in range(n_blocks):
        # one block at a time is held by the driver and the executors (bounded by block_windows); its hits are stored
        block = Block([tuple(r) for r in windows.filter(part == k).collect()])
        terms = spark.sparkContext.broadcast(block)
        index = stored(positional_index(docs, terms), "postings")
        terms.destroy()
        block.rank(term_counts(index, max(len(block.terms), 1)))
        ranked = spark.sparkContext.broadcast(block)
        hits = stored(search(index, ranked, slop), "hits")
        ranked.destroy()
        found = hits if found is None else found.unionByName(hits)
        if base is None:
            base = index.select("doc_id", "row_key", "n_words")
        else:
            release(spark, index)
    hit = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["reach"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(a["reach"], x["e"].cast("long")).alias("reach")),
        lambda a: a["n"])
    merged = found.groupBy("doc_id", "row_key").agg(
        hit.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.coalesce(merged["n_hit"], F.lit(0).cast("long"))
    return base.join(merged, same_row(base, merged, "doc_id", "row_key"), "left").select(
        base["doc_id"], base["row_key"], base["n_words"], n_hit.alias("n_hit"),
        F.coalesce(merged["items"], F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * share >= base["n_words"])).alias("contaminated"))


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated, with all their columns."""
    release(ready(spark))
    bad = decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("contaminated") \
        .select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).distinct()
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(bad["__id"]) & (text_key() == bad["__key"]), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


ORACLE = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM item WHERE len(w) > 0)),
doc_window AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM doc, (SELECT DISTINCT n FROM item_window) WHERE len(w) >= n)),
hit AS (SELECT d.doc_id, d.s, d.n, i.item_id FROM doc_window d JOIN item_window i ON d.n = i.n AND d.win = i.win),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""
