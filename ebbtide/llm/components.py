"""Connected components of a link table, without collecting it.

Alternates two steps until one star a component is left: every node's larger
neighbours, and then its smaller ones, are linked to its smallest neighbour, so
that stars form around the smallest nodes. Minima are aggregated before they are
shuffled and joined back, so a hub with many links is split like any other
skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import drop_stored, stored


def _toward(edges: DataFrame) -> DataFrame:
    """Edges as (u, v) with u > v, once each."""
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node has one edge up at most, and only to nodes without one."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = per.agg(F.max("up").alias("most"), F.max(F.least(F.col("up"), F.lit(1)) * F.col("down")).alias("inner")).first()
    return row.most is None or (row.most <= 1 and row.inner == 0)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node of the component."""
    edges = stored(_toward(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    while not _is_forest(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionAll(least.select("u", F.col("m").alias("v"))).filter("u > v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(_toward(small.unionAll(least.select("u", F.col("m").alias("v")))), "edges")
        drop_stored(edges)
        edges = after
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
