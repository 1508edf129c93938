"""Connected components of links between numbered vertices, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def components(links: DataFrame) -> DataFrame:
    """vertex and component (the smallest vertex reachable) of every vertex in
    ``links`` (a, b). Alternates large-star and small-star steps until nothing
    changes; each step's edges are written to the shared folder."""
    edges = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(),
        "edges",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(
            moved.unionByName(lowest.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges"
        )
        sums = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == state or not sums[0]:
            break
        state = sums
    roots = edges.select(F.col("b").alias("vertex")).distinct()
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).unionByName(
        roots.select("vertex", F.col("vertex").alias("component"))
    )
