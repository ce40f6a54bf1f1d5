"""Distributed union-find: connected components by alternating large and small stars.

In a large star every node links its greater neighbours to its least one; in a small star every node
links its lesser neighbours, and itself, to the least of them.  Both keep components and turn each
into a star around its least node in a number of rounds that is logarithmic in practice.  A round is
two aggregations and two joins; it is written to the shared folder and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import forget, written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` (root = least node) for every node of ``a, b`` links, of any orderable type.

    Self links and nulls are left out; with no link left the result is empty.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = _mark(now)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        forget(now)
        before, now, mark = mark, new, _mark(new)
        if before == mark:
            break
    else:
        raise RuntimeError("components have not settled")
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``node, root`` after further ``a, b`` links: only the graph of the roots that they touch is solved."""
    at = roots.select("node", "root")
    lifted = links.join(at.toDF("a", "ra"), "a", "left").join(at.toDF("b", "rb"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    over = written(connected_components(lifted).toDF("root", "over"), "links-over")
    again = roots.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root"))
    alone = over.select(F.col("root").alias("node"), F.col("over").alias("root")).join(at.select("node"), "node", "left_anti")
    return again.unionByName(alone)
