"""Connected components of an edge table, by minimum labels and pointer jumping.

Labels are tables in the shared scratch folder, never on the driver.  A vertex of any degree is
safe: labels meet at a vertex in a partial aggregation, and joins are plain equi-joins that
adaptive execution splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(v, c): each vertex of `edges` (a, b) and the smallest vertex that it can reach."""
    both = scratch.save(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = scratch.save(both.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("c")), "labels")
    while True:
        near = both.join(labels, both.b == labels.v).groupBy("a").agg(F.min("c").alias("m"))
        lower = labels.join(near, labels.v == near.a).select("v", "c", F.least("c", "m").alias("n"))
        up = labels.select(F.col("v").alias("p"), F.col("c").alias("pc"))
        moved = lower.join(up, lower.n == up.p).select("v", F.least("n", "pc").alias("c"), (F.least("n", "pc") < F.col("c")).alias("moved"))
        new = scratch.save(moved, "labels")
        scratch.drop(labels)
        labels = new.select("v", "c")
        labels._cairn_path = new._cairn_path
        if not new.filter("moved").limit(1).count():
            scratch.drop(both)
            return labels
