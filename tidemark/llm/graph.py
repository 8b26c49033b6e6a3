"""Connected components by contraction, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import settled


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, component: for every node of `edges` the smallest node that it reaches.

    Every round each node joins the neighbour that comes first in an order drawn anew by hashing, and the
    edges between the merged nodes go on to the next round, so about log(nodes) rounds suffice whatever the
    shape of the graph. A node's choice is an aggregate with partial sums before the shuffle; the edges of
    many copies of one pair collapse with distinct(). No component is ever gathered in one task.
    Null ends and loops are ignored. An empty table gives an empty result.
    """
    live = settled(
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a is not null and b is not null and a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    steps: list[DataFrame] = []
    for turn in range(most_rounds):
        if live.isEmpty():
            break
        order = lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("o"), c.alias("id"))
        both = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("old")).agg(F.min(order(F.col("b"))).alias("first"))
        step = settled(step.select("old", F.least(F.col("first"), order(F.col("old")))["id"].alias("new")))
        steps.append(step)
        left, right = step.toDF("a", "na"), step.toDF("b", "nb")
        live = settled(
            live.join(left, "a").join(right, "b").where("na != nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b"))
            .distinct()
        )
    else:
        if not live.isEmpty():
            raise RuntimeError(f"edges are left after {most_rounds} rounds of contraction")
    if not steps:
        return live.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = steps[0].toDF("node", "root")
    for step in steps[1:]:
        found = found.join(step.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    found = settled(found)
    names = found.groupBy("root").agg(F.min("node").alias("component"))
    return found.join(names, "root").select("node", "component")
