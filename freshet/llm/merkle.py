"""Merkle manifest of a dataset: one tree a group, one tree over the groups' roots, proofs, verification.

A digest is lower-case hex SHA-256, H(x, y, ...) that of its concatenated inputs. A leaf is H of
a row's fields, each ``-`` if NULL, else its UTF-8 byte count, ``:`` and its value. A group's
leaves ascend by id; while several nodes remain, every ``arity`` consecutive ones (the last run
may be shorter, even one node) become their H. What remains, a lone leaf itself, is the
group's subroot. The subroots, by group (NULL first, else UTF-8 bytewise), give the root likewise.

1. ``leaves`` reads the table once and stores ids and digests; texts go no further.
2. ``positions`` numbers rows globally: range partitioning on a total order, then the offset of
   each partition (one row a partition). Rows of one group, or of one repeated id, spread
   over as many partitions as they need.
3. Sibling-shift self-joins: every level equijoins its nodes with the computed index of each sibling
   (index XOR 1 for binary trees; slot + 1, ... modulo ``arity`` otherwise); slot-zero rows emit the
   parents, which are the next level. Keys (tree, index) are unique, so no level has a hot key,
   and all groups' trees go up together. Every level is stored: a lost executor costs parts of one level.
4. ``prove`` goes down again: a node's path is its own siblings followed by its parent's path, so the
   join at each level is on the parent's index. A leaf's path has log(n) digests.
5. ``folded`` recomputes the root from a leaf and its path; a leaf that was tampered with gives another root.

Defined cases: rows without an id come first in their group, rows of equal ids go by leaf, equal
leaves in any order (they are interchangeable). NULL fields count as ``-``; '' is ``0:``. An empty
table has no nodes and no root. One group, or one row, is its own subroot and root. Other columns are ignored.
Only the root, the number of trees and the size of the largest reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshet.llm.common import stored, table

ARITY = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 7
STORE_EVERY = 4


def digest(*parts: Column) -> Column:
    """H of hex digests or of texts, as lower-case hex."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _hex(packed: Column) -> Column:
    return F.lower(F.hex(packed))


def leaves(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", doc: str = "doc_id",
           tampered: dict[str, Column] | None = None) -> DataFrame:
    """(id, grp, leaf, seen, row), digests packed to 32 bytes: ``seen`` is the leaf with the ``tampered`` columns."""
    changed = tampered or {}
    leaf = digest(*[field(F.col(c)) for c in fields])
    seen = digest(*[field(changed.get(c, F.col(c))) for c in fields])
    return docs.select(F.col(doc).alias("id"), F.col(group).alias("grp"), F.unhex(leaf).alias("leaf"),
                       F.unhex(seen).alias("seen"), F.monotonically_increasing_id().alias("row"))


def positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` stored with ``part`` and ``pos``: the place of each in the total ``order`` (NULLs first), from 0.

    ``order`` must tell all rows apart but for interchangeable ones. No task sorts more than its range.
    """
    columns = [F.asc_nulls_first(c) for c in order]
    dealt = rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
    dealt = stored(dealt.withColumn("seq", F.monotonically_increasing_id()), "ordered")
    dealt = dealt.withColumn("part", F.shiftright("seq", 33))
    starts = dealt.groupBy("part").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = starts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return dealt.join(starts, "part").withColumn("pos", F.col("seq") + F.col("shift")).drop("seq", "shift")


def forest(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, trees) of ``leaves``: (tree, idx, size, d, id, seen) and (grp, tree, size), trees numbered by group."""
    placed = positions(rows, ["grp", "id", "leaf", "row"])
    runs = placed.groupBy("part", "grp").agg(F.min("pos").alias("low"), F.count("*").alias("n"))
    groups = runs.groupBy("grp").agg(F.min("low").alias("first"), F.sum("n").alias("size"))
    trees = stored(positions(groups, ["grp"]).select("grp", F.col("pos").alias("tree"), "first", "size"), "trees")
    at = runs.select("part", "grp").alias("r").join(trees.alias("t"), F.col("r.grp").eqNullSafe(F.col("t.grp"))).select(
        F.col("part").alias("of_part"), F.col("r.grp").alias("of_grp"), "tree", "first", "size")
    nodes = placed.join(at, (F.col("part") == F.col("of_part")) & F.col("grp").eqNullSafe(F.col("of_grp")))
    return (nodes.select("tree", (F.col("pos") - F.col("first")).alias("idx"), "size", F.col("leaf").alias("d"), "id", "seen"),
            trees.select("grp", "tree", "size"))


def with_siblings(nodes: DataFrame, arity: int = ARITY) -> DataFrame:
    """Nodes with the packed digests of their run's other nodes, left and right of them in order."""
    slot, run = F.pmod("idx", F.lit(arity)), F.floor(F.col("idx") / arity) * arity
    out = nodes
    for offset in range(1, arity):
        index = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else run + F.pmod(slot + F.lit(offset), F.lit(arity))
        other = nodes.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("d").alias(f"s{offset}"))
        out = out.withColumn("at", index).join(other, (F.col("tree") == F.col("t")) & (F.col("at") == F.col("i")), "left").drop("t", "i", "at")
    # from slot j, the siblings at shifts 1, 2, ... stand right of the node up to the last slot, the others left of it
    def joined(shifts: dict[int, range]) -> str:
        parts = {j: ", ".join(f"coalesce(s{o}, X'')" for o in r) or "X''" for j, r in shifts.items()}
        return f"CASE pmod(idx, {arity}) " + " ".join(f"WHEN {j} THEN concat({p})" for j, p in parts.items()) + " END"

    left = F.expr(joined({j: range(arity - j, arity) for j in range(arity)})).alias("left")
    right = F.expr(joined({j: range(1, arity - j) for j in range(arity)})).alias("right")
    return out.select(*nodes.columns, left, right)


def parents(level: DataFrame, arity: int = ARITY) -> DataFrame:
    """The next level: slot-zero rows emit H of their run."""
    return (level.filter((F.pmod("idx", F.lit(arity)) == 0) & (F.col("size") > 1))
            .select("tree", F.floor(F.col("idx") / arity).cast("long").alias("idx"),
                    F.ceil(F.col("size") / arity).cast("long").alias("size"),
                    F.unhex(digest(_hex(F.col("d")), _hex(F.col("right")))).alias("d")))


def build(nodes: DataFrame, largest: int, arity: int = ARITY) -> list[DataFrame]:
    """All levels, leaves first, each (tree, idx, size, d, left, right, ...) and stored; a tree ends where size is 1."""
    level = stored(with_siblings(nodes, arity), "level")
    levels = [level]
    while largest > 1:
        largest = -(-largest // arity)
        level = stored(with_siblings(parents(level, arity), arity), "level")
        levels.append(level)
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, d, height): the last node of every tree and its level."""
    tops = [x.filter("size = 1").select("tree", "d", F.lit(k).alias("height")) for k, x in enumerate(levels)]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def prove(levels: list[DataFrame], above: DataFrame, arity: int = ARITY) -> DataFrame:
    """Leaves with ``path`` (from the leaf on) and the columns of ``above``: (tree, height, path, ...) of every subroot."""
    extra = [c for c in above.columns if c not in ("tree", "height", "path")]
    step = F.struct(F.col("left"), F.col("right"))
    down = None
    for k in range(len(levels) - 1, -1, -1):
        own = [c for c in levels[k].columns if c not in ("size", "left", "right")]
        up = above.filter(F.col("height") == k).select(F.col("tree").alias("t"), F.lit(-1).cast("long").alias("i"), F.col("path").alias("rest"), *extra)
        if down is not None:
            up = up.unionByName(down.select(F.col("tree").alias("t"), F.col("idx").alias("i"), F.col("path").alias("rest"), *extra))
        last = F.col("size") == 1
        level = levels[k].withColumn("up", F.when(last, -1).otherwise(F.floor(F.col("idx") / arity)).cast("long"))
        here = level.join(up, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("i"))).select(
            *own, F.when(last, F.col("rest")).otherwise(F.concat(F.array(step), F.col("rest"))).alias("path"), *extra)
        down = stored(here, "paths") if k and k % STORE_EVERY == 0 else here
    return down


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its path give."""
    return F.aggregate(path, leaf, lambda acc, step: digest(_hex(step["left"]), acc, _hex(step["right"])))


def proof_digest(path: Column) -> Column:
    """H of all siblings on the path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(_hex(step["left"]), _hex(step["right"]))), "").cast("binary"), 256)


class Manifest(NamedTuple):
    """``trees``: (grp, tree, size, subroot); ``proofs``: a row a leaf; ``root``; ``levels`` of the groups and ``upper`` ones."""

    trees: DataFrame
    proofs: DataFrame
    root: str | None
    levels: list[DataFrame]
    upper: list[DataFrame]

    def nodes(self) -> DataFrame:
        """(tree, level, idx, digest) of every node; the tree over the subroots is -1."""
        parts = [x.select("tree", F.lit(k).alias("level"), "idx", _hex(F.col("d")).alias("digest"))
                 for levels in (self.levels, self.upper) for k, x in enumerate(levels)]
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out


def manifest(rows: DataFrame, arity: int = ARITY) -> Manifest:
    """The manifest of ``leaves``; ``proofs`` has (id, leaf, seen, subroot, path), path leading to the root."""
    if arity < 2:
        raise ValueError("a tree needs an arity of two or more")
    nodes, trees = forest(stored(rows, "leaves"))
    largest, count = trees.agg(F.max("size"), F.count("*")).first()
    levels = build(nodes, largest or 0, arity)
    subroots = stored(roots(levels), "subroots")
    top = subroots.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(count).cast("long").alias("size"), "d", F.col("height").alias("h"))
    upper = build(top, count, arity)
    last = roots(upper).first()
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    start = upper[0].sparkSession.range(1).select(F.lit(-1).cast("long").alias("tree"), F.lit(len(upper) - 1).alias("height"), none.alias("path"))
    over = prove(upper, start, arity)
    over = stored(over.select(F.col("idx").alias("tree"), F.col("h").alias("height"), "path", F.col("d").alias("subroot")), "over")
    proofs = prove(levels, over, arity).select("id", F.col("d").alias("leaf"), "seen", "subroot", "path")
    trees = trees.join(subroots.select("tree", _hex(F.col("d")).alias("subroot")), "tree").select("grp", "tree", "size", "subroot")
    return Manifest(trees, proofs, bytes(last["d"]).hex() if last else None, levels, upper)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_MODULUS == 0
    bad = F.when(hit, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    made = manifest(leaves(table(spark, sf_dir, "documents"), tampered={"n_chars": bad}))
    out = made.proofs.select(F.col("id").alias("doc_id"), _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                             F.lit(made.root).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                             folded(_hex(F.col("seen")), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 (reflected, polynomial 0xEDB88320) of the id's digits, eight steps a byte, then the trees as recursion by level
ORACLE = """
WITH RECURSIVE src AS (
  SELECT doc_id, lang, source, n_chars, text, xor(list_reduce(
    list_prepend(4294967295, flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
    lambda r, b: CASE WHEN b >= 0 THEN xor(CAST(r AS BIGINT), CAST(b AS BIGINT))
                      ELSE xor(r >> 1, (r & 1) * 3988292384) END), 4294967295) AS crc
  FROM (SELECT doc_id, lang, source, n_chars, text FROM documents)),
leaf AS (
  SELECT doc_id, lang, sha256(f1 || f2 || f3 || coalesce(octet_length(encode(CAST(n AS VARCHAR))) || ':' || n, '-') || f5) AS leaf,
    sha256(f1 || f2 || f3 || coalesce(octet_length(encode(CAST(m AS VARCHAR))) || ':' || m, '-') || f5) AS seen
  FROM (SELECT doc_id, lang, n_chars AS n, CASE WHEN crc % 7 = 0 THEN CAST(n_chars AS BIGINT) + 1 ELSE n_chars END AS m,
          coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') AS f1,
          coalesce(octet_length(encode(source)) || ':' || source, '-') AS f2,
          coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS f3,
          coalesce(octet_length(encode(text)) || ':' || text, '-') AS f5 FROM src)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS size,
    dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree FROM leaf),
node AS (
  SELECT tree, 0 AS lvl, idx, size, leaf AS d FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (any_value(size) + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM node
  WHERE size > 1 GROUP BY tree, lvl, idx // 2),
top AS (
  SELECT 0 AS lvl, tree AS idx, count(*) OVER () AS size, d FROM node WHERE size = 1
  UNION ALL
  SELECT lvl + 1, idx // 2, (any_value(size) + 1) // 2, sha256(string_agg(d, '' ORDER BY idx)) FROM top
  WHERE size > 1 GROUP BY lvl, idx // 2),
inner_walk AS (
  SELECT tree, idx AS leaf_idx, 0 AS lvl, idx, size, '' AS proof, seen AS acc FROM placed
  UNION ALL
  SELECT w.tree, leaf_idx, w.lvl + 1, w.idx // 2, (w.size + 1) // 2, proof || coalesce(s.d, ''),
    sha256(CASE WHEN w.idx % 2 = 1 THEN s.d || acc ELSE acc || coalesce(s.d, '') END)
  FROM inner_walk w LEFT JOIN node s ON s.tree = w.tree AND s.lvl = w.lvl AND s.idx = xor(w.idx, 1) WHERE w.size > 1),
walk AS (
  SELECT tree, leaf_idx, 0 AS lvl, tree AS idx, (SELECT max(size) FROM top) AS size, proof, acc FROM inner_walk WHERE size = 1
  UNION ALL
  SELECT w.tree, leaf_idx, w.lvl + 1, w.idx // 2, (w.size + 1) // 2, proof || coalesce(s.d, ''),
    sha256(CASE WHEN w.idx % 2 = 1 THEN s.d || acc ELSE acc || coalesce(s.d, '') END)
  FROM walk w LEFT JOIN top s ON s.lvl = w.lvl AND s.idx = xor(w.idx, 1) WHERE w.size > 1)
SELECT p.doc_id, p.leaf, n.d AS subroot, r.d AS root, sha256(w.proof) AS proof_sha256, w.acc AS folded_root, w.acc = r.d AS verified
FROM placed p JOIN walk w ON w.tree = p.tree AND w.leaf_idx = p.idx AND w.size = 1
JOIN node n ON n.tree = p.tree AND n.size = 1 JOIN top r ON r.size = 1
"""
