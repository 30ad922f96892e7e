"""Exact embedding near-duplicates by dual traversal of cover trees.

Equal vectors of one label are one representative with a count.  Vectors are
scaled to length 1, where cosine >= c means distance <= sqrt(2 - 2c).  The
upper levels of the tree are Spark tables: a node with more than ``CELL`` rows
is split among up to ``FAN`` of its own vectors, each row going to the nearest;
a node keeps its centre and covering radius.  Pairs of nodes whose centres are
further apart than both radii and the threshold distance are pruned.  Each
remaining pair of nodes is one bounded task, in which both sides become a local
cover tree of nested levels with halving radii, whatever the number of children; the
dual traversal goes down both trees, prunes pairs of nodes by their covering
radii, takes those that must be linked whole, and settles single rows by their
product in double precision.

A task returns link counts and a spanning forest, never all pairs, so a dense
cluster of n vectors costs O(n) rows a task.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing and are components of
their own; vectors of different lengths don't link; rows with equal ids count
as vectors of their own, and a row with a null id too: it has the smallest id of
its component, or null if it is alone there; other columns aren't read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .components import connected

#: Rows of a node that one task takes; bounds its memory.
CELL = 4096
#: Children of a node in a Spark level.
FAN = 64
#: Spark levels at most; nodes that are still larger are cut by hash.
LEVELS = 6
#: Bounds are widened by this, far above the rounding errors of distances that
#: are taken from products.
SLACK = 1e-6


class Node:
    """A node of a local cover tree: its children are at least half its radius
    apart, and each row is within that of its child's centre; the first child has
    the node's own centre.  Levels at which nothing is split are left out."""

    __slots__ = ("center", "radius", "rows", "children")

    def __init__(self, x: np.ndarray, rows: np.ndarray, center: int):
        apart = np.linalg.norm(x[rows] - x[center], axis=1)
        self.center, self.rows, self.radius, self.children = center, rows, float(apart.max()), []
        if len(rows) == 1 or self.radius == 0:
            return
        # The centre, then whichever row is first among those not yet covered.
        left, half = np.concatenate([[center], rows[rows != center]]), self.radius / 2
        while len(left):
            inside = np.linalg.norm(x[left] - x[left[0]], axis=1) <= half
            self.children.append(Node(x, left[inside], int(left[0])))
            left = left[~inside]

    def depth(self) -> int:
        return 1 + max((c.depth() for c in self.children), default=0)


def stars(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among n rows reduced to (row, smallest row reachable)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    out = np.nonzero(label != np.arange(n))[0]
    return out, label[out]


def dual(x: np.ndarray, weight: np.ndarray, cos: float, left: Node, right: Node | None, seen: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight linked to each row, spanning forest a, b).  right None: within left.
    seen: gets how many pairs of nodes were visited, pruned and linked whole."""
    reach = math.sqrt(max(0.0, 2 - 2 * cos))
    total = np.zeros(len(x), np.int64)
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    seen = {} if seen is None else seen

    def whole(p: Node, q: Node) -> None:
        total[p.rows] += weight[q.rows].sum()
        if p is q:
            total[p.rows] -= weight[p.rows]
        else:
            total[q.rows] += weight[p.rows].sum()
            a.append(q.rows)
            b.append(np.full(len(q.rows), p.rows[0]))
        a.append(p.rows)
        b.append(np.full(len(p.rows), q.rows[0]))

    def pairs(ps: list[Node], qs: list[Node], own: bool) -> list[tuple[Node, Node]]:
        """Which pairs of nodes are left to descend: all distances of centres at
        once, then the bounds; single rows are settled here."""
        c, d = (np.array([n.center for n in ns]) for ns in (ps, qs))
        r, s = (np.array([n.radius for n in ns]) for ns in (ps, qs))
        one, two = (np.array([len(n.rows) == 1 for n in ns]) for ns in (ps, qs))
        out = []
        for at in range(0, len(ps), 512):
            k = slice(at, at + 512)
            dots = x[c[k]] @ x[d].T
            apart, wide = np.sqrt(np.maximum(0.0, 2 - 2 * dots)), r[k][:, None] + s
            asked = np.arange(len(qs)) > np.arange(len(ps))[k][:, None] if own else np.ones(dots.shape, bool)
            far, near = asked & (apart - wide > reach + SLACK), asked & (apart + wide < reach - SLACK)
            single = asked & one[k][:, None] & two
            for name, what in (("visited", asked), ("pruned", far), ("whole", near & ~single)):
                seen[name] = seen.get(name, 0) + int(what.sum())
            i, j = np.nonzero(single & (dots >= cos))
            i, j = c[k][i], d[j]
            np.add.at(total, i, weight[j])
            np.add.at(total, j, weight[i])
            if len(i):
                a.append(i)
                b.append(j)
            for i, j in zip(*np.nonzero(near & ~single), strict=True):
                whole(ps[at + i], qs[j])
            out += [(ps[at + i], qs[j]) for i, j in zip(*np.nonzero(asked & ~far & ~near & ~single), strict=True)]
        return out

    todo = [(left, left)] if right is None else pairs([left], [right], False)
    while todo:
        p, q = todo.pop()
        if p is q:
            if 2 * p.radius < reach - SLACK:
                whole(p, p)
            elif p.children:
                todo += pairs(p.children, p.children, True) + [(c, c) for c in p.children if len(c.rows) > 1]
            else:  # equal rows, but for rounding
                whole(p, p)
        elif p.children and (not q.children or p.radius >= q.radius):
            todo += pairs(p.children, [q], False)
        elif q.children:
            todo += pairs([p], q.children, False)
        elif x[p.center] @ x[q.center] >= cos:
            whole(p, q)
    if not a:
        return total, np.array([], np.int64), np.array([], np.int64)
    return (total, *stars(np.concatenate(a), np.concatenate(b), len(x)))


def _task(cos: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "rep"], kind="stable")
        x, weight = np.stack(pdf["unit"].to_numpy()), pdf["mult"].to_numpy()
        sides = [np.nonzero(pdf["side"].to_numpy() == s)[0] for s in (0, 1)]
        trees = [Node(x, rows, int(rows[0])) if len(rows) else None for rows in sides]
        if trees[0] is None or (trees[1] is None and int(pdf["b"].iloc[0]) != int(pdf["a"].iloc[0])):
            return pd.DataFrame({"rep": [], "other": [], "n": []}).astype({"rep": "int64", "other": "Int64", "n": "int64"})
        total, i, j = dual(x, weight, cos, trees[0], trees[1])
        rep = pdf["rep"].to_numpy()
        counted = np.nonzero(total)[0]
        return pd.DataFrame({
            "rep": np.concatenate([rep[counted], rep[i]]),
            "other": pd.array([None] * len(counted) + rep[j].tolist(), dtype="Int64"),
            "n": np.concatenate([total[counted], np.zeros(len(i), np.int64)]),
        })

    return run


def _nearest(rows: pd.DataFrame, centers: pd.DataFrame) -> pd.DataFrame:
    """Rows of one part of a node, each with the slot of the nearest centre."""
    c, x = np.stack(centers["center"].to_numpy()), np.stack(rows["unit"].to_numpy())
    at = (x @ c.T).argmax(1)
    return rows.assign(slot=centers["slot"].to_numpy()[at])[["rep", "mult", "unit", "cell", "slot"]]


def units(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label, vec and unit (null where the row can link with nothing)."""
    v = F.col("vec")
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    scaled = F.transform(v, lambda e: e.cast("double") / F.col("_most"))
    norm = F.sqrt(F.aggregate("_scaled", F.lit(0.0), lambda s, e: s + e * e))
    good = F.col("label").isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda e: e != 0)
    return (
        df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
        .withColumn("_good", F.coalesce(good, F.lit(False)))
        # In a column of its own, else it would be taken for each component.
        .withColumn("_most", F.when(F.col("_good"), F.array_max(F.transform(v, lambda o: F.abs(o.cast("double"))))))
        .withColumn("_scaled", F.when(F.col("_good"), scaled))
        .withColumn("_norm", norm)
        .select("vec_id", "label", "vec", F.transform("_scaled", lambda e: e / F.col("_norm")).alias("unit"))
    )


def _cells(reps: DataFrame) -> DataFrame:
    """rep, mult, unit and cell: nodes of at most about CELL rows."""
    rows = written(reps.select("rep", "mult", "unit", F.xxhash64("label", F.size("unit")).alias("cell")), "cells")
    for _ in range(LEVELS):
        sizes = rows.groupBy("cell").count().filter(F.col("count") > CELL)
        large = written(sizes.select("cell", F.least(F.lit(FAN), F.ceil(F.col("count") * 2 / CELL).cast("int")).alias("fan"), F.ceil(F.col("count") / CELL).cast("int").alias("parts")), "large-nodes")
        if large.isEmpty():
            return rows
        draw = F.xxhash64("rep", F.lit("draw"))
        chosen = rows.join(large, "cell").withColumn("slot", F.pmod(draw, F.col("fan")))
        centers = written(chosen.groupBy("cell", "slot", "parts").agg(F.min_by("unit", F.struct(draw, F.col("rep"))).alias("center")), "centers")
        parted = chosen.select("rep", "mult", "unit", "cell", F.pmod(F.xxhash64("rep", F.lit("part")), F.col("parts")).alias("part"))
        spread = centers.select("cell", "slot", "center", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"))
        split = parted.groupBy("cell", "part").cogroup(spread.groupBy("cell", "part")).applyInPandas(_nearest, "rep long, mult long, unit array<double>, cell long, slot long")
        stay = rows.join(large, "cell", "left_anti")
        rows = written(stay.unionByName(split.select("rep", "mult", "unit", F.xxhash64("cell", "slot").alias("cell"))), "cells")
    return rows.join(rows.groupBy("cell").count(), "cell").select("rep", "mult", "unit", F.xxhash64("cell", F.pmod(F.xxhash64("rep", F.lit("cut")), F.ceil(F.col("count") / CELL))).alias("cell"))


def links(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = written(units(df, id_col, vec_col, label_col), "units")
    able = rows.filter("unit is not null").withColumn("rep", F.xxhash64("label", "vec"))
    grouped = able.groupBy("label", "vec").agg(F.min("vec_id").alias("first"), F.count("*").alias("mult"), F.first("unit").alias("unit"))
    reps = written(grouped.select(F.xxhash64("label", "vec").alias("rep"), "label", "first", "mult", "unit"), "representatives")
    cells = written(_cells(reps), "nodes")
    center = cells.groupBy("cell").agg(F.min_by("unit", "rep").alias("center"))
    distance = lambda p, q: F.sqrt(F.aggregate(F.zip_with(p, q, lambda s, t: (s - t) * (s - t)), F.lit(0.0), lambda s, e: s + e))
    label_of = cells.join(reps.select("rep", "label", F.size("unit").alias("dim")), "rep")
    nodes = written(label_of.join(center, "cell").groupBy("cell", "label", "dim").agg(F.first("center").alias("center"), F.max(distance(F.col("unit"), F.col("center"))).alias("radius")), "node-bounds")
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    p, q = nodes.alias("p"), nodes.alias("q")
    close = (F.col("p.cell") == F.col("q.cell")) | (distance(F.col("p.center"), F.col("q.center")) - F.col("p.radius") - F.col("q.radius") <= reach)
    pairs = written(p.join(q, [F.col("p.label") == F.col("q.label"), F.col("p.dim") == F.col("q.dim"), F.col("p.cell") <= F.col("q.cell")]).filter(close).select(F.col("p.cell").alias("a"), F.col("q.cell").alias("b")), "node-pairs")
    first = pairs.join(cells, F.col("a") == F.col("cell")).select("a", "b", F.lit(0).alias("side"), "rep", "mult", "unit")
    second = pairs.filter("a != b").join(cells, F.col("b") == F.col("cell")).select("a", "b", F.lit(1).alias("side"), "rep", "mult", "unit")
    found = written(first.unionByName(second).groupBy("a", "b").applyInPandas(_task(threshold), "rep long, other long, n long"), "links")
    counts = found.filter("other is null").groupBy("rep").agg(F.sum("n").alias("n"))
    roots = connected(found.filter("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    classed = reps.select("rep", "first", "mult").join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    classed = classed.select("rep", "first", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    least = classed.groupBy("root").agg(F.min("first").alias("component_id"))
    of_rep = classed.join(least, "root").select("rep", "n_links", "component_id")
    linked = able.select("vec_id", "rep").join(of_rep, "rep").select("vec_id", "n_links", "component_id")
    alone = rows.filter("unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op8_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
pairs AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, p.y FROM reach r JOIN pairs p ON p.x = r.y)
SELECT vec_id, (SELECT count(*) FROM pairs p WHERE p.x = v.vec_id) AS n_links, c AS component_id, vec_id = c AS kept FROM v JOIN (SELECT x, min(y) AS c FROM reach GROUP BY 1) ON x = vec_id"""
