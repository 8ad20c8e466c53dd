"""Connected components by alternating large-star and small-star rounds.

Edges only ever move; nothing is collected.  Each round is written to the
shared folder, so lineage stays short.  Joins meet one row per node, and a node
with very many edges is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civitas.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component: smallest node reached) for every node of (a, b) edges.

    Loops, repeated and null edges do not count.
    """
    now = stage(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.filter("u != m").select("u", F.col("m").alias("v")))
            .filter("u != v").distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(
            small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct(),
            "edges",
        )
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free sum of an edge set."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)
