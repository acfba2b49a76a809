"""Token counts without materialising ids: pieces once a pre-token, times its frequency.

A byte-level BPE never joins characters of two pre-tokens, so a text's count is the sum
over its distinct pre-tokens of (frequency in the text) * (pieces of the pre-token).

1. ``piece_table``: every task counts its pre-tokens and hands on its ``LOCAL_HEAD``
   commonest; summed up, the ``HEAD`` commonest of the corpus are counted once each by the
   library. That table has a fixed bound (a parameter), so it can be broadcast. What
   is in it changes the time only, never a count.
2. ``count_tokens`` builds each document's pre-token frequencies, joins them with the
   table, and sums. Pre-tokens beyond the table are counted once per task and kept in a
   bounded memo. Joining those by a shuffle instead would move a row for every
   (document, rare pre-token), more than the texts themselves.

Special strings inside texts are cut out first, as the library's default does, and are
one token each. Pre-tokens are found by the byte-level pattern; a text with characters
on which two regular expression libraries could disagree (beyond the Latin blocks,
or the separators 1C-1F) is split by the tokenizer's own pre-tokenizer.

Defined cases: NULL is empty: 0 bytes, 0 tokens. Repeated rows give equal rows. Very
long texts are one document like any other. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import as_bytes, table

HEAD = 1 << 18
LOCAL_HEAD = 1 << 15
LOCAL_MOST = 300_000
MEMO = 200_000
LIMIT = 1_024
NAME = "byte_bpe_50k.json"

# fixed value: the byte-level pre-token pattern
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_UNUSUAL = re.compile(rb"[\x1c-\x1f\xc9-\xff]")


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class PreTokens:
    """Splits texts as a byte-level tokenizer file does, and counts the pieces of pre-tokens."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        specials = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None

    def of(self, text: bytes) -> tuple[list[str], int]:
        """(pre-tokens, special tokens) of a text."""
        s = text.decode()
        parts = self.special.split(s) if self.special else [s]
        if _UNUSUAL.search(text):
            own = self.tokenizer.pre_tokenizer.pre_tokenize_str
            return [p[a:b] for p in parts if p for _, (a, b) in own(p)], len(parts) - 1
        if len(parts) == 1:
            return PATTERN.findall(s), 0
        return [t for p in parts for t in PATTERN.findall(p)], len(parts) - 1

    def pieces(self, tokens: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]


def piece_table(docs: DataFrame, path: str, text: str = "text", head: int = HEAD) -> DataFrame:
    """(pre-token, pieces) of the ``head`` commonest pre-tokens of the corpus, each counted once."""
    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = PreTokens(path), Counter()
        for b in batches:
            for t in as_bytes(b.column(0)):
                if t:
                    seen.update(split.of(t)[0])
                    if len(seen) > LOCAL_MOST:
                        seen = Counter(dict(seen.most_common(LOCAL_MOST // 2)))
        top = [(p, n) for p, n in seen.most_common(LOCAL_HEAD) if len(p) <= 64]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["token", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = PreTokens(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(split.pieces(b.column(0).to_pylist()), pa.int32())], names=["token", "pieces"])

    sums = docs.select(F.col(text).alias("t")).mapInArrow(common, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return sums.orderBy(F.desc("n"), "token").limit(head).select("token").mapInArrow(count, "token string, pieces int")


def count_tokens(docs: DataFrame, path: str, doc: str = "doc_id", text: str = "text", limit: int = LIMIT, head: int = HEAD) -> DataFrame:
    """Per document: n_bytes (UTF-8), n_tokens, over_limit."""
    pieces = docs.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in piece_table(docs, path, text, head).collect()})  # at most head rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known, memo = PreTokens(path), pieces.value, {}
        for b in batches:
            texts = as_bytes(b.column(1))
            n_bytes, n_tokens = [len(t) if t else 0 for t in texts], []
            for t in texts:
                tokens, total = split.of(t) if t else ([], 0)
                frequency = Counter(tokens)
                new = [p for p in frequency if p not in known and p not in memo]
                if len(memo) + len(new) > MEMO:
                    memo = {}
                    new = [p for p in frequency if p not in known]
                memo.update(zip(new, split.pieces(new), strict=True))
                n_tokens.append(total + sum(n * (known.get(p) or memo[p]) for p, n in frequency.items()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), str(public_tokenizers.path(NAME)))
