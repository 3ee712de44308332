"""Connected components of a graph given as edges between long ids, without gathering any group in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest id that the node reaches), for every node that has an edge.

    edges: columns a and b.  Every round, a node takes the smallest root among its own and its neighbours', and then
    that root's root, which halves long chains; each round is written to the checkpoint folder.
    """
    both = edges.where("a <> b").select("a", "b")
    both = checkpointed(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    state = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")))
    for _ in range(most_rounds):
        near = both.join(state, both["b"] == state["node"]).groupBy("a").agg(F.min("root").alias("near"))
        hopped = state.join(near, state["node"] == near["a"], "left").select("node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        roots = state.select(F.col("node").alias("via"), F.col("root").alias("next"))
        new = checkpointed(hopped.join(roots, "via", "left").select("node", "old", F.least("via", "next").alias("root")))
        settled = new.where("root < old").isEmpty()
        state = new.select("node", "root")
        if settled:
            return state
    raise RuntimeError(f"components have not settled in {most_rounds} rounds")
