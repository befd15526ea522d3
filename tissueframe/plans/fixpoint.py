"""Iterate a DataFrame to a fixed point with lineage cuts in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..session import cut


def label_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Smallest node of each connected component: ``(node, root)``.

    ``edges(u, v)`` is undirected.  Each round takes the smallest label of the
    neighbours and then jumps to that label's own label, so long chains close in
    few rounds.  Only nodes that have an edge appear in the result.
    """
    both = cut(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
               .where("u <> v").distinct())
    if both.isEmpty():
        return both.select(F.col("u").alias("node"), F.col("v").alias("root"))
    labels = cut(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root"))
                 .select(F.col("u").alias("node"), "root"))
    for _ in range(max_rounds):
        near = (both.join(labels.select(F.col("node").alias("v"), F.col("root").alias("nr")), "v")
                .groupBy("u").agg(F.min("nr").alias("nr")))
        step = (labels.join(near.withColumnRenamed("u", "node"), "node", "left")
                .select("node", "root", F.least("root", F.coalesce("nr", "root")).alias("low")))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        nxt = cut(step.join(jump, "low", "left")
                  .select("node", F.least("low", F.coalesce("far", "low")).alias("new"), "root"))
        moved = nxt.where("new <> root").limit(1).count()
        labels = nxt.select("node", F.col("new").alias("root"))
        if not moved:
            return labels
    raise RuntimeError("component labelling did not settle")


def until_stable(state: DataFrame, step: Callable[[DataFrame], DataFrame],
                 open_rows: Callable[[DataFrame], DataFrame], max_rounds: int = 1000) -> DataFrame:
    """Apply ``step`` while ``open_rows(state)`` is not empty."""
    state = cut(state)
    for _ in range(max_rounds):
        if not open_rows(state).limit(1).count():
            return state
        state = cut(step(state))
    raise RuntimeError("rounds did not settle")
