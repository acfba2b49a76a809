"""Embedding near-duplicates by an exact metric range join, within equal labels.

Two vectors of one label link when their cosine, in double precision, is at least ``cosine``. On unit
vectors that is a Euclidean distance of at most t = sqrt(2 - 2 cosine), which is a metric.

1. Vectors of equal label and equal components fall into one class with a count; classes go on, copies don't.
2. Pivots partition: a group (at first the classes of a label and length) takes one pivot per ``CELL``
   members, at most ``PIVOTS``, by smallest hashes. A member's home cell is its nearest pivot j and the
   ring floor(d / t) of its distance d to it.
3. The triangle inequality sets what is replicated: a vector can only link with homes of the cell (j, ring) if
   its distance to j is at most t beyond either end of the ring, and if d(x, j) <= min d(x, .) + 2 t (each home
   is nearer to j than to any other pivot). It is copied to those cells alone, and of two cells one side only, so
   every pair meets in exactly one cell. Tight clusters thus stay in inner rings, away from all others.
4. Cells with more than ``CELL`` homes are partitioned again by pivots of their own, while that makes fewer copies
   than cutting the cell into blocks would; then cells of more than ``BLOCK`` homes or replicas are cut into block pairs.
5. Cells join independently, in numpy: homes with homes and homes with replicas. A cell hands on
   the number of links of each member, weighted by copies, and one edge a member to the smallest
   class it is connected with in the cell, never the pairs. Components are merged over those edges.

All links are found: bounds are widened by ``MARGIN``, far above the rounding of distances, and only cells
without homes are dropped. Where vectors have no metric structure (independent directions in many dimensions) no
triangle bound holds any pair apart; then the work is that of comparing the label's vectors in blocks.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components, a NULL label, or
a NULL id link with nothing (component: their id). Only vectors of equal length are compared. Exact repeats of a
row are one vector and give equal results; other vectors of an id are vectors of their own. Empty tables give
no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from freshet.llm.common import stored, table
from freshet.llm.neardup import components

COSINE = 0.93
CELL = 1_024
PIVOTS = 32
BLOCK = 2_048
DEALT = 4_096  # members a task compares with the pivots of their group
STEP = 512
MARGIN = 1e-7


def classes_of(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (vec_id, label, h1, h2), and a class a distinct usable (label, vector): (c, label, h1, h2, w, low, v)."""
    wide = not (isinstance(df.schema[vec].dataType, ArrayType) and isinstance(df.schema[vec].dataType.elementType, FloatType))
    x = F.col(vec).cast("array<double>") if wide else F.col(vec)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    good = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vec).isNotNull() & ~bad & F.exists(x, lambda c: c != 0)
    good = F.coalesce(good, F.lit(False))
    rows = df.select(F.col(vec_id).alias("vec_id"), F.when(good, F.col(label)).alias("label"), F.when(good, F.xxhash64(x)).alias("h1"),
                     F.when(good, F.xxhash64(F.lit(1), x)).alias("h2"), F.when(good, x).alias("v"))
    keys, used = ["label", "h1", "h2"], rows.filter("h1 IS NOT NULL")
    counted = used.select(*keys, "vec_id").distinct().groupBy(*keys).agg(F.count("*").alias("w"), F.min("vec_id").alias("low"))
    held = used.groupBy(*keys).agg(F.first("v").alias("v")).select(F.col("label").alias("l"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "v")
    classes = counted.join(held, (F.col("label") == F.col("l")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")))
    return rows.drop("v"), classes.select(F.monotonically_increasing_id().alias("c"), *keys, "w", "low", "v")


def packed(classes: DataFrame) -> DataFrame:
    """(cell, c, w, home, v): every class a home of its label's and length's cell, the vector as bytes."""
    kind = "<f4" if isinstance(classes.schema["v"].dataType.elementType, FloatType) else "<f8"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column(3)
            ends, flat = v.offsets.to_numpy(), v.values.to_numpy(zero_copy_only=False).astype(kind)
            out = [flat[x:y].tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([True] * len(out)), pa.array(out, pa.binary())],
                                             names=["cell", "c", "w", "home", "v"])

    return classes.select(F.concat(F.size("v").cast("string"), F.lit(":"), F.col("label").cast("string")).alias("cell"), "c", "w", "v").mapInArrow(
        run, "cell string, c long, w long, home boolean, v binary")


def unit(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """Rows of one length, scaled by their largest component first so that no square leaves the range."""
    x = np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def _pair_rule(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether members of cell ``own`` are the ones copied to cell ``other``: for two cells, one of them."""
    return np.where((own + other) % 2 == 1, own < other, own > other)


def partition(members: DataFrame, sizes: DataFrame, t: float, kind: str) -> DataFrame:
    """The cells of ``members`` (cell, c, w, home, v) dealt to cells of their own pivots: (parent, cell, c, w, home, v).

    ``sizes``: (cell, homes, others). A cell's members are dealt to tasks of about DEALT; each gets the cell's pivots.
    """
    rings = math.floor(2 / t) + 1

    def assign(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        columns = {"parent": pa.string(), "sub": pa.int32(), "c": pa.int64(), "w": pa.int64(), "home": pa.bool_(), "v": pa.binary()}
        if not left.num_rows or not right.num_rows:
            return pa.table({k: pa.array([], x) for k, x in columns.items()})
        pivots = unit(right.sort_by("pivot")["at"], kind)
        at, to, home = [], [], []
        for a in range(0, left.num_rows, STEP):
            d = distances(unit(left["v"].slice(a, STEP), kind), pivots)
            near = d.argmin(axis=1)
            ring = np.minimum(np.floor(d / t).astype(int), rings - 1)
            own = np.where(left["home"].slice(a, STEP).to_numpy(), near * rings + ring[np.arange(len(d)), near], -1)
            reach = d <= d.min(axis=1, keepdims=True) + 2 * t + MARGIN
            for r in range(rings):
                low, high = r * t, (r + 1) * t if r < rings - 1 else 3.0
                x, j = np.nonzero(reach & (d >= low - t - MARGIN) & (d <= high + t + MARGIN))
                cell = j * rings + r
                mine = own[x] == cell
                ok = mine | (own[x] < 0) | _pair_rule(own[x], cell)
                at.append(x[ok] + a)
                to.append(cell[ok])
                home.append(mine[ok])
        at, to, home = np.concatenate(at), np.concatenate(to), np.concatenate(home)
        rows = left.take(pa.array(at))
        return pa.table({"parent": rows["cell"], "sub": pa.array(to, pa.int32()), "c": rows["c"], "w": rows["w"], "home": pa.array(home), "v": rows["v"]})

    deals = F.ceil((F.col("homes") + F.col("others")) / DEALT).cast("int")
    wanted = F.least(F.greatest(F.ceil(F.col("homes") / CELL), F.lit(2)), F.lit(PIVOTS)).cast("int")
    shape = sizes.select(F.col("cell").alias("of"), "homes", deals.alias("deals"), wanted.alias("wanted"))
    rows = members.join(shape, F.col("cell") == F.col("of"))
    # the homes of the smallest hashes; the constant limit is applied in each map task first, so no task orders a hot cell
    smallest = Window.partitionBy("cell").orderBy("h", "c")
    pivots = (rows.filter("home").select("cell", "c", "v", "wanted", "deals", F.xxhash64("c", F.lit(7)).alias("h"))
              .withColumn("r", F.row_number().over(smallest)).filter(F.col("r") <= PIVOTS).filter(F.col("r") <= F.col("wanted")))
    pivots = pivots.select(F.col("cell").alias("pivots_of"), F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("pivots_at"),
                           F.col("c").alias("pivot"), F.col("v").alias("at"))
    dealt = rows.select("cell", F.pmod(F.xxhash64("c"), F.col("deals")).cast("int").alias("deal"), "c", "w", "home", "v")
    out = dealt.groupBy("cell", "deal").cogroup(pivots.groupBy("pivots_of", "pivots_at")).applyInArrow(
        assign, "parent string, sub int, c long, w long, home boolean, v binary")
    return out.select("parent", F.concat(F.col("sub").cast("string"), F.lit("/"), F.col("parent")).alias("cell"), "c", "w", "home", "v")


def cell_sizes(members: DataFrame) -> DataFrame:
    return members.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("others"))


def _blocks(n: str):
    return F.ceil(F.col(n) / BLOCK)


def cells(members: DataFrame, t: float, kind: str) -> DataFrame:
    """``members`` dealt to cells, all with homes, by rounds of ``partition``."""
    done, todo = None, members
    first = True
    while True:
        sizes = stored(cell_sizes(todo).filter("homes > 0"), "sizes")
        if sizes.filter(F.col("homes") > CELL).isEmpty():
            break
        split = stored(partition(todo, sizes.filter(F.col("homes") > CELL), t, kind), "cells")
        keys = split.select("cell", "parent").distinct()
        made = cell_sizes(split).filter("homes > 0").join(keys, "cell").groupBy("parent").agg(
            F.sum(F.col("homes") + F.col("others")).alias("copies"), F.max("homes").alias("most"))
        cost = F.col("homes") * (_blocks("homes") + _blocks("others")) + F.col("others") * _blocks("homes")
        # the first round always counts; later ones where pivots copy less than blocks of the cell would
        pays = (F.col("copies") < cost) & (F.col("most") < F.col("homes")) if not first else F.col("most") < F.col("homes")
        better = stored(sizes.join(made, F.col("cell") == F.col("parent")).filter(pays).select(F.col("cell").alias("p")), "better")
        kept = todo.join(better, F.col("cell") == F.col("p"), "left_anti").join(sizes.select(F.col("cell").alias("k")), F.col("cell") == F.col("k"), "left_semi")
        done = kept if done is None else done.unionByName(kept)
        todo = split.join(better, F.col("parent") == F.col("p"), "left_semi").select(*members.columns)
        first = False
    live = todo.join(sizes.select(F.col("cell").alias("k")), F.col("cell") == F.col("k"), "left_semi")
    return live if done is None else done.unionByName(live)


def merged(label: np.ndarray, near: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Smallest label of each connected set of rows ``x`` and columns ``y`` of the links ``near``, into ``label``."""
    while True:
        before = label.copy()
        low = np.where(near, label[y][None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        label[x] = np.minimum(label[x], low)
        low = np.where(near, label[x][:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max)
        label[y] = np.minimum(label[y], low)
        label[:] = label[label]
        if (label == before).all():
            return


def joined(members: DataFrame, cosine: float, kind: str) -> DataFrame:
    """(c, links, p): of each cell's members with links there, their number and the smallest class they reach in the cell."""
    def compare(rows: pa.Table) -> pa.Table:
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        rows = rows.sort_by("c")
        own, home, c, w = rows["own"].to_numpy(), rows["home"].to_numpy(), rows["c"].to_numpy(), rows["w"].to_numpy()
        u = unit(rows["v"], kind)
        left = np.flatnonzero(home & (own == i))
        right = np.flatnonzero(home & (own == j)) if j >= 0 else np.flatnonzero(~home)
        near = np.empty((len(left), len(right)), bool)
        for a in range(0, len(left), STEP):
            near[a:a + STEP] = u[left[a:a + STEP]] @ u[right].T >= cosine
        if i == j:
            np.fill_diagonal(near, False)
        links = np.zeros(len(c), np.int64)
        links[left] = near @ w[right]
        if i != j:
            links[right] += w[left] @ near
        x, y = near.any(axis=1), near.any(axis=0)
        label = np.arange(len(c))
        merged(label, near[x][:, y], left[x], right[y])
        out = np.flatnonzero(links)
        return pa.table({"c": c[out], "links": links[out], "p": c[label[out]]})

    sizes = cell_sizes(members).select(F.col("cell").alias("of"), _blocks("homes").cast("int").alias("hb"), _blocks("others").cast("int").alias("ob"))
    rows = members.join(sizes, F.col("cell") == F.col("of"))
    deal = F.xxhash64("c", F.lit(3))
    own = F.when(F.col("home"), F.pmod(deal, F.col("hb"))).otherwise(-1 - F.pmod(deal, F.greatest("ob", F.lit(1)))).cast("int")
    # home blocks meet each other (i <= j) and, as i, the blocks of replicas (j = -1 - block)
    blocks = F.sequence(F.lit(0), F.col("hb") - 1)
    homes = F.transform(blocks, lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    across = F.when(F.col("ob") > 0, F.transform(F.sequence(F.lit(1), F.greatest("ob", F.lit(1))), lambda k: F.struct(F.col("own").alias("i"), (-k).alias("j"))))
    homes = F.concat(homes, F.coalesce(across, F.array().cast("array<struct<i:int,j:int>>")))
    others = F.transform(blocks, lambda k: F.struct(k.alias("i"), F.col("own").alias("j")))
    met = rows.withColumn("own", own).withColumn("ij", F.explode(F.when(F.col("home"), homes).otherwise(others)))
    return (met.select("cell", "ij.i", "ij.j", "own", "c", "w", "home", "v")
            .groupBy("cell", "i", "j").applyInArrow(compare, "c long, links long, p long"))


def near_duplicates(df: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id (smallest id reachable), kept (is that one)."""
    if not 0 < cosine < 1:
        raise ValueError("the cosine must be between 0 and 1")
    rows, classes = classes_of(df, vec_id, vec, label)
    classes = stored(classes, "classes")
    kind = "<f4" if isinstance(classes.schema["v"].dataType.elementType, FloatType) else "<f8"
    t = math.sqrt(2 - 2 * cosine) + MARGIN
    members = cells(stored(packed(classes), "members"), t, kind)
    found = stored(joined(members, cosine, kind), "found")
    reach = components(found.select("c", "p").distinct()).select(F.col("c").alias("r"), F.col("label").alias("component"))
    links = found.groupBy("c").agg(F.sum("links").alias("links")).withColumnRenamed("c", "k")
    each = (classes.drop("v").join(links, F.col("c") == F.col("k"), "left").join(reach, F.col("c") == F.col("r"), "left")
            .select("label", "h1", "h2", "low", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                    F.coalesce("component", "c").alias("component")))
    each = stored(each, "linked")
    lowest = each.groupBy("component").agg(F.min("low").alias("component_id"))
    each = each.join(lowest, "component").select(F.col("label").alias("l"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n_links", "component_id")
    out = rows.join(each, (F.col("label") == F.col("l")) & (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, * FROM (
    SELECT DISTINCT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0)),
link AS (
  SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (SELECT r, r AS s FROM v UNION SELECT reach.r, link.y FROM reach JOIN link ON link.x = reach.s),
each AS (
  SELECT v.r, v.vec_id, v.label, v.e, min(w.vec_id) AS component_id FROM v JOIN reach ON reach.r = v.r JOIN v w ON w.r = reach.s
  GROUP BY ALL)
SELECT d.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, d.vec_id) AS component_id,
  coalesce(d.vec_id = component_id, TRUE) AS kept
FROM embeddings d LEFT JOIN each ON each.vec_id = d.vec_id AND each.label = d.label AND each.e = [CAST(x AS DOUBLE) FOR x IN d.embedding]
LEFT JOIN (SELECT x, count(*) AS n FROM link GROUP BY x) ON x = each.r
"""
