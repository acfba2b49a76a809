"""Secret scanning with built-in functions only: three patterns and sliding-window entropy.

Kinds, in order: ``assign`` (a password-like name, a separator and a value of 8+
characters), ``access`` (AKIA and 12+ capitals or digits), ``hex`` (runs of 32+ lowercase
hex digits) and ``entropy``. For the last, candidates are runs of 20+ characters of
``[A-Za-z0-9+/_=-]``. A candidate's class is the narrowest of hex, alphanumeric and
base64 that holds it; a window of ``WINDOW`` characters slides over it while the sum of
c * log2(c) over the window's character counts is corrected for the one character that
enters and the one that leaves, so a step costs the same for any window. A candidate is
reported when its best window reaches its class's entropy. Suppressed (the allow list):
candidates without a digit or without a letter, UUIDs, plain lower-case words joined by
separators, and values that name themselves as examples.

Positions come from the text between matches: ``split`` and ``regexp_extract_all`` by one
pattern alternate, and a running sum of their lengths per document and kind gives code
point offsets in time linear in the matches, also for a text with millions of them.

Only (id, lengths) rows are shuffled, never a text; there is no Python on the path.

Defined cases: NULL text is empty. Repeated rows give equal rows, each once per
repetition. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import table, text_key

# fixed values: the patterns of the three base kinds, and which group must have how many characters
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
NAMED = r"(?i)password|passwd|secret|token|api_?key"
ASSIGN_LEAST = 8

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
CLASSES = (("^[0-9a-fA-F]+$", 2.9), ("^[A-Za-z0-9]+$", 3.6), ("", 3.7))
ALLOWED = (r"^[^0-9]*$", r"^[^A-Za-z]*$", r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
           r"^[a-z]++(?:[-_/][a-z]++)*+[-_/]?[0-9]{1,4}$", r"(?i)example|sample|placeholder|changeme")
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
KINDS = ("assign", "access", "hex", "entropy")


def best_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits a character) of any window of the string, in time linear in its length.

    The moves (entering and leaving character) pair the characters with themselves ``window`` places
    later, as whole arrays; a step reads its own move and the window's counts, never the candidate.
    """
    chars = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    leaving = F.concat(F.array_repeat(F.lit(-1), window), chars)
    moves = F.slice(F.arrays_zip(chars.alias("new"), leaving.alias("old")), F.lit(1), F.length(value))
    part = lambda c: F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))
    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"), F.lit(0).alias("i"))

    def step(a: Column, x: Column) -> Column:
        new, old, i = x["new"], x["old"], a["i"] + 1
        up = F.element_at(a["n"], new + 1)
        entered = a["s"] + part(up + 1) - part(up)
        down = F.element_at(a["n"], F.greatest(old, F.lit(0)) + 1) + F.when(new == old, 1).otherwise(0)
        s = F.when(old >= 0, entered + part(down - 1) - part(down)).otherwise(entered)
        counts = F.transform(a["n"], lambda c, k: c + F.when(k == new, 1).otherwise(0) - F.when(k == old, 1).otherwise(0))
        h = F.log2(F.lit(float(window))) - s / F.lit(float(window))
        return F.struct(counts.alias("n"), s.alias("s"), F.when(i >= window, F.greatest(a["best"], h)).otherwise(a["best"]).alias("best"), i.alias("i"))

    return F.aggregate(moves, start, step, lambda a: a["best"])


def is_random(value: Column) -> Column:
    """Whether a candidate is reported: high entropy for its class, and not on the allow list."""
    least = F.lit(CLASSES[-1][1])
    for pattern, bits in CLASSES[-2::-1]:
        least = F.when(value.rlike(pattern), F.lit(bits)).otherwise(least)
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    return F.when(allowed, F.lit(False)).otherwise(best_entropy(value) >= least)


def _pieces(text: Column, pattern: str, kind: int, wanted: Column, keep) -> Column:
    """For each match: kind, its number, the length of the text before it, its own, and whether it stays."""
    matches, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    found = F.transform(F.arrays_zip(matches.alias("m"), F.slice(gaps, 1, F.size(matches)).alias("g")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), keep(x["m"]).alias("keep")))
    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,len:int,keep:boolean>>")
    return F.when(wanted, found).otherwise(empty)


def find_secrets(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its spans, as (start, kind number, end) by start and kind, code points, end exclusive."""
    t = F.coalesce(F.col("t"), F.lit(""))
    yes = lambda m: F.lit(True)
    long_value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST
    pieces = F.concat(
        _pieces(t, ASSIGN, 0, t.rlike(NAMED), long_value), _pieces(t, ACCESS, 1, t.contains("AKIA"), yes),
        _pieces(t, HEX, 2, t.rlike(HEX), yes), _pieces(t, CANDIDATE, 3, t.rlike(CANDIDATE), is_random))
    rows = (docs.select(F.col(doc).cast("long").alias("doc_id"), text_key(text).alias("row_key"), F.col(text).alias("t"))
            .select("doc_id", "row_key", F.explode_outer(pieces).alias("x")).select("doc_id", "row_key", "x.*")
            .repartition("doc_id", "row_key"))
    once = rows.groupBy("doc_id", "row_key", "kind", "i").agg(
        F.first("gap").alias("gap"), F.first("len").alias("len"), F.first("keep").alias("keep"), F.count("*").alias("copies"))
    before = Window.partitionBy("doc_id", "row_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = once.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before))
    span = F.when(F.col("keep"), F.struct((F.col("end") - F.col("len")).alias("start"), "kind", "end"))
    return (placed.groupBy("doc_id", "row_key").agg(F.max("copies").alias("copies"), F.array_sort(F.collect_list(span)).alias("spans"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(span_text(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _oracle() -> str:
    """The same spans in DuckDB: the text between matches gives positions, ``entropy`` each window's entropy."""
    patterns = (ASSIGN, ACCESS, HEX.removeprefix("(?<![0-9a-f])"), CANDIDATE.removeprefix("(?<![A-Za-z0-9+/_=-])"))
    found = "\nUNION ALL ".join(
        f"SELECT doc_id, {k} AS k, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS v, unnest(g[:len(m)]) AS gap FROM "
        f"(SELECT doc_id, regexp_extract_all(x, {_sql(p)}) AS m, string_split_regex(x, {_sql(p)}) AS g FROM doc)" for k, p in enumerate(patterns))
    least = " ".join(f"WHEN regexp_matches(v, {_sql(p)}) THEN {bits}" for p, bits in CLASSES[:-1])
    plain = [p.replace("++", "+").replace("*+", "*") for p in ALLOWED]  # possessive, for Java's stack, matches the same here
    allowed = " OR ".join(f"regexp_matches(v, {_sql(p)})" for p in plain)
    names = ", ".join(f"'{n}'" for n in KINDS)
    return f"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
found AS ({found}),
placed AS (
  SELECT doc_id, k, v, sum(len(gap) + len(v)) OVER (PARTITION BY doc_id, k ORDER BY i) AS till FROM found),
kept AS (
  SELECT doc_id, k, CAST(till - len(v) AS BIGINT) AS start, CAST(till AS BIGINT) AS till FROM placed
  WHERE CASE k WHEN 0 THEN len(regexp_extract(v, {_sql(ASSIGN)}, 2)) >= {ASSIGN_LEAST}
        WHEN 3 THEN NOT ({allowed}) AND list_max([list_aggregate(string_split(v[s:s + {WINDOW - 1}], ''), 'entropy')
                                                  FOR s IN range(1, len(v) - {WINDOW - 2})])
                    >= CASE {least} ELSE {CLASSES[-1][1]} END
        ELSE true END),
named AS (SELECT *, ([{names}])[k + 1] || ':' || start || ':' || till AS span FROM kept)
SELECT d.doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
       count(*) FILTER (WHERE k = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, k) FILTER (WHERE k < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, k), '') AS spans
FROM doc d LEFT JOIN named USING (doc_id) GROUP BY d.doc_id
"""


ORACLE = _oracle()
