"""Connected components by alternating large-star and small-star steps.

Each step is an aggregation (with map-side combine) and an equi-join, so a node with very
many neighbours is never gathered in one place, and each step's edges are written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicewright.llm._store import written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # (written, so that the join can split the edges of a node that has very many)
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    hung = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node of ``edges``; root is the component's smallest node.
    Loops and repeated edges do no harm; an edge with a null end is ignored."""
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        digest = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if digest == before or not digest[0]:
            break
        before = digest
        edges = written(_small_star(_large_star(edges)).distinct(), "edges")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
