"""Connected components by alternating large-star and small-star.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).  Every round is
two joins of the edge table; rounds end when no edge changes, however many that takes (a
logarithmic number of them, by the paper).  Edges stay in tables: no
link and no component reaches the driver, only a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("__u"), F.least("m", "u").alias("m"))
    # a partial aggregate and a join, not a window: AQE can split the rows of a hot node
    return both.filter(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("__u")).select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "__u")
    others = down.join(least, F.col("u") == F.col("__u")).filter(F.col("v") > F.col("m")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    return others.union(least.select(F.col("m").alias("a"), F.col("__u").alias("b"))).distinct()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node, component (smallest node reachable) for every node of the edges (a, b).

    Direction, repeats and loops do not matter; edges with a null end are ignored; no
    edges give no rows.  The result is a durable table.
    """
    keep = Durable(edges.sparkSession, "components")
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = keep.save(edges.filter(F.col("a") != F.col("b")).select(low.alias("a"), high.alias("b")).distinct(), edges.count() if rows is None else rows)

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    last, seen = None, mark(now)
    while seen[0] and seen != last:
        after = keep.save(_small_star(_large_star(now)), seen[0])  # a round adds no edge
        keep.drop(now)
        now, last, seen = after, seen, mark(after)
    # stars now: each node but the centres has one edge, to the smallest node
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
