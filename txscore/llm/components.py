"""Connected components of a link table, as Spark joins and grouped minima.

Alternating large-star and small-star rounds: every round replaces the links of a node
by links to the smallest node next to it, until all that is left is one star for each
component. A round is two grouped minima (with map-side combine) joined back to the
links; a node with very many links is one side of an equi-join that adaptive execution
splits. Each round is cut from its lineage with a reliable ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pairs(df: DataFrame) -> DataFrame:
    """Links as (u, v) with u > v, once each."""
    return (df.where("a is not null and b is not null and a <> b")
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())


def _star(both: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each node (the larger ones, or itself and the smaller ones)
    to the smallest node of its neighbourhood."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    if larger:
        least = least.withColumn("m", F.least("u", "m"))
        links = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        links = both.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        links = links.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return _pairs(links)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has a link; component: the smallest node
    reachable. Nodes may be of any type with an order."""
    now = _pairs(links.select(F.col(a).alias("a"), F.col(b).alias("b"))).checkpoint()
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        grown = _star(both, larger=True)
        now = _star(grown, larger=False).checkpoint()
        # stars are stable: neither the number of links nor their ends change any more
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                      F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
