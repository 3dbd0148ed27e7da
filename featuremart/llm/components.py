"""Connected components of a large graph by alternating star contraction.

Each round joins every edge with the smallest neighbour of its node and
stores the new edges in the shared folder, so that a lost executor repeats
one round at most. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featuremart.llm.text import stored

# edges of one stored file; rounds over few edges then cost few tasks
EDGES_PER_FILE = 100_000


def _smallest(edges: DataFrame, files: int) -> DataFrame:
    """(u, m): the smallest among a node and its neighbours, in a table of its
    own so that the join below can split a node with very many edges."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return stored(low, "cc-min", files)


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one edge, to a node that has none of its own."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("out")), F.struct(F.col("v").alias("n"), F.lit(0).alias("out")))).alias("x"))
    each = ends.groupBy("x.n").agg(F.sum("x.out").alias("out"), F.count("*").alias("all"))
    return each.where("out > 1 or (out = 1 and all > 1)").limit(1).count() == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b); component
    is the smallest node reachable. Loops, repeated edges and edges with a
    null end are allowed and add nothing."""
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = stored(e, "cc-edges")
    files = 1 + e.count() // EDGES_PER_FILE
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: larger neighbours move to the smallest neighbour
        large = both.join(_smallest(both, files), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "cc-large", files)
        # small star: smaller neighbours and the node itself move to the smallest
        low = _smallest(large, files)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = stored(small.where("u <> v").distinct(), "cc-edges", files)
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
