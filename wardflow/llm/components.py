"""Connected components of a link table, by contraction.

In each round every node points to the node of lowest hash among itself and its
neighbours (another hash each round, so that chains in id order shrink as fast
as others), pointers are followed once more, and links are rewritten to the
nodes pointed to. Each round is a few joins and map-side combined aggregations
over what is left; its tables are written, and only whether links remain
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.scratch import stored


def connected_components(links: DataFrame, name: str = "links") -> DataFrame:
    """``node, component`` (the smallest node) for every node of ``links`` (``a``, ``b``: long)."""
    edges = stored(links.select("a", "b").filter("a <> b").distinct(), f"{name}-edges")
    both = edges.union(edges.select("b", "a"))
    members = both.select(F.col("a").alias("node")).distinct().withColumn("at", F.col("node"))
    step = 0
    while not edges.isEmpty():
        step += 1
        both = edges.union(edges.select("b", "a"))
        near = both.union(edges.select("a", F.col("a").alias("b"))).union(edges.select("b", F.col("b").alias("b2")))
        first = stored(near.groupBy("a").agg(F.min_by("b", F.xxhash64("b", F.lit(step))).alias("p")), f"{name}-first")
        second = first.select(F.col("a").alias("p"), F.col("p").alias("pp"))
        point = stored(first.join(second, "p").select(F.col("a").alias("n"), F.col("pp")), f"{name}-point")
        members = stored(members.join(point, members["at"] == point["n"], "left")
                         .select("node", F.coalesce("pp", "at").alias("at")), f"{name}-members")
        left = edges.join(point, edges["a"] == point["n"]).select(F.col("pp").alias("a"), "b")
        left = left.join(point, left["b"] == point["n"]).select("a", F.col("pp").alias("b"))
        edges = stored(left.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct(), f"{name}-edges")
    least = members.groupBy("at").agg(F.min("node").alias("component"))
    return members.join(least, "at").select("node", "component")
