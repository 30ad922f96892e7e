"""Connected components by alternating large-star and small-star rounds.

Each round is two grouped minima and two joins; no group is ever gathered, so
a component of any size spreads over all tasks.  Rounds are written to the
shared folder, which cuts the lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _signature(e: DataFrame):
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge to another node.

    ``edges`` has two long columns a and b; direction, repeats and loops don't
    matter, rows with a null end are left out.  root is the smallest node of
    the component; the row of the root itself is included.
    """
    e = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = written(e, "edges")
    before = _signature(e)
    while before[0]:
        after = written(_small_star(_large_star(e)), "edges")
        now = _signature(after)
        dropped(e)
        e = after
        if now == before:
            break
        before = now
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
