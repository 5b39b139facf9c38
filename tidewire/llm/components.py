"""Connected components by rounds of contraction, each stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .steps import store


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); nodes of one component share a root.

    In each round every node joins the neighbour of most links (or stays if it
    has most itself; a hash that changes with the round decides ties), and links
    are carried over to what their ends joined.  A hub with any number of links
    is resolved at once; paths shrink by a fraction each round.  Aggregates
    combine before the shuffle; joins on a hub's key can be split.
    """
    edges = store(links.select("a", "b").filter("a <> b").distinct(), "links")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        k = len(steps)
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.col("links"), F.xxhash64("node", F.lit(k)).alias("tie"), F.col("node"))
        degree = both.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("links")).select("node", rank.alias("rank"))
        around = both.join(degree, both["b"] == degree["node"]).groupBy("a").agg(F.max("rank").alias("best"))
        step = store(
            degree.join(around, F.col("node") == F.col("a"))
            .select("node", F.greatest("rank", "best").getField("node").alias("root")), "joined")
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        ends = edges.join(left, "a").join(right, "b").filter("ra <> rb")
        edges = store(ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return store(found, "components")
