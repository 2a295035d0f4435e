"""Connected components of an edge table, by alternating star operations.

Large-star and small-star steps (each a minimum by node, taken with map-side
partials, and a join back) turn every component into a star around its
smallest node. Each step's edges are written to the shared folder, so lineage
stays short and a lost executor costs running tasks only. A step never adds edges, so
the number of the step before sizes its tasks (EDGES each, and a task for each
core at least), instead of a tiny file for each shuffle partition. Nothing but
two numbers a step reaches the driver.

Defined results: self-loops and edges with a null end are ignored; repeated
edges count once; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Edges that a task writes, about.
EDGES = 1 << 18


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for each node of the edges (src, dst) the smallest node it reaches."""
    edges = common.written(edges.select("src", "dst").where("src is not null and dst is not null and src <> dst")
                           .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
                           .distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        tasks = max(edges.sparkSession.sparkContext.defaultParallelism, -(-before[0] // EDGES))
        # large star: greater neighbours of a node move to the least node around it
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min("dst").alias("m")).select(
            F.col("src").alias("u"), F.least("src", "m").alias("m"))
        edges = common.written(
            both.where("dst > src").join(least, F.col("src") == F.col("u"))
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).distinct().coalesce(tasks), "large")
        # small star: smaller neighbours and the node itself move to the least of them
        least = edges.groupBy("src").agg(F.min("dst").alias("m")).withColumnRenamed("src", "u")
        moved = edges.join(least, F.col("src") == F.col("u")).where("dst <> m").select(
            F.col("dst").alias("src"), F.col("m").alias("dst"))
        edges = common.written(
            moved.unionByName(least.select(F.col("u").alias("src"), F.col("m").alias("dst"))).distinct().coalesce(tasks), "small")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
            .unionByName(edges.select(F.col("dst").alias("node"), F.col("dst").alias("component"))).distinct())
