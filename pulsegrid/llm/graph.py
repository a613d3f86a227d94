"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``: the smallest node that it reaches.

    Every node points to its smallest neighbour if that is smaller; pointers are followed to their
    ends by doubling, edges are drawn between the ends and the round repeats until none is left.
    Pointers only fall, so the ends are the smallest nodes seen so far. All steps are joins and
    sums; each result is written to the shared folder.
    """
    both = edges.where("a != b").select("a", "b")
    left = staged(both.unionAll(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = None
    while not left.isEmpty():
        point = left.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("to"))
        point = staged(point, "points")
        while True:
            ends = point.select(F.col("node").alias("to"), F.col("to").alias("end"))
            further = staged(point.join(ends, "to").select("node", F.col("end").alias("to"), "to"
                                                           ).toDF("node", "to", "was"), "points")
            moved = not further.where("to != was").isEmpty()
            discard(point)
            point = further.drop("was")
            if not moved:
                break
        if labels is None:
            labels = point.withColumnRenamed("to", "component")
        else:
            ends = point.select(F.col("node").alias("component"), F.col("to").alias("end"))
            labels = staged(labels.join(ends, "component", "left").select(
                "node", F.coalesce("end", "component").alias("component")), "labels")
        name = [point.select(F.col("node").alias(x), F.col("to").alias(f"{x}_end")) for x in "ab"]
        after = staged(left.join(name[0], "a").join(name[1], "b").where("a_end != b_end").select(
            F.col("a_end").alias("a"), F.col("b_end").alias("b")).distinct(), "edges")
        discard(left)
        left = after
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
