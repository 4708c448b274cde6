"""Connected components of a link table, by repeated joins; no link or label ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from assayspark.session import settle


def components(links: DataFrame, left: str = "a", right: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, component: the smallest node that each linked node can reach.

    Each round hands every node the smallest label among its neighbours and then that label's own label, so stars end
    after one round and chains after about the logarithm of their length. Rounds are written to the shared folder.
    Links from a node to itself and repeated links change nothing; no links give no rows.
    """
    both = links.select(F.col(left).alias("node"), F.col(right).alias("near")).where("node <> near")
    both = settle(both.unionByName(both.select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct(), "links")
    labels = settle(both.groupBy("node").agg(F.least("node", F.min("near")).alias("component")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("node").alias("near"), "component"), "near").groupBy("node").agg(F.min("component").alias("seen"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "seen").alias("component"))
        own = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        after = lower.join(own, "component").select("node", "old", F.least("component", "root").alias("component"))
        after = settle(after, "labels")
        if after.where("old <> component").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
