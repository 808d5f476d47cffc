"""Connected components of a graph of links, by labels that shrink to the smallest id of their component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweave.llm.common import kept_at


def components(links: DataFrame, path: str) -> DataFrame:
    """node, root for every node of ``links`` (columns a, b); root is the smallest node it is linked with.

    A round takes the smallest label among a node and its neighbours, then the label of that label, so a star is done
    in one round and a chain in about the logarithm of its length. Each round is written, so none depends on an earlier
    plan. A node with very many links is only ever a minimum of partial minima; the joins on nodes are equality
    joins with one label a node, whose hot nodes the planner splits.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b")
    edges = kept_at(both.distinct(), f"{path}/edges")
    first = edges.groupBy("a").agg(F.min("b").alias("least"))
    labels = kept_at(first.select(F.col("a").alias("node"), F.least("a", "least").alias("root")), f"{path}/labels-0")
    for step in range(1, 200):
        near = edges.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("root").alias("near")
        )
        lower = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        moved = lower.join(jump, "low", "left").select(
            "node", F.least("low", F.coalesce("far", "low")).alias("root"), F.col("root").alias("was")
        )
        moved = kept_at(moved, f"{path}/labels-{step}")
        labels = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")
