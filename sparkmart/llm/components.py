"""Connected components of an edge table, by Spark joins: the smallest node that each can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import Work


def components(work: Work, edges: DataFrame) -> DataFrame:
    """node, component for every node of the edges (a, b).

    Every node points at a smaller one of its component. A round takes the smallest pointer among
    a node's neighbours, hands it to the node and to what the node pointed at, and then lets every
    pointer skip one step, so chains halve. Minima are partial before the shuffle: a node with very
    many edges is one row a task. Each round is written, which cuts its lineage.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = work.stored(both.where("a <> b").distinct(), "edges")
    pointer = work.stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).withColumnRenamed("a", "node"), "pointers")
    while True:
        of_neighbour = pointer.select(F.col("node").alias("b"), "to")
        smallest = both.join(of_neighbour, "b").groupBy("a").agg(F.min("to").alias("least"))
        offers = pointer.join(smallest, pointer["node"] == smallest["a"]).select("node", "to", F.least("to", "least").alias("least"))
        offers = offers.select("node", "least").union(offers.select(F.col("to").alias("node"), "least"))
        taken = work.stored(offers.groupBy("node").agg(F.min("least").alias("to")), "pointers")
        step = taken.select(F.col("node").alias("to"), F.col("to").alias("next"))
        new = work.stored(taken.join(step, "to").select("node", F.col("next").alias("to")), "pointers")
        before = pointer.withColumnRenamed("to", "before")
        moved = new.join(before, "node").where("to <> before").limit(1).count()
        pointer = new
        if not moved:
            return pointer.withColumnRenamed("to", "component")
