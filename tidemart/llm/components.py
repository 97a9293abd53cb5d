"""Connected components of a link table by min-label hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored


def components(links: DataFrame, path: str) -> DataFrame:
    """node, label (smallest node reachable) for every node of ``links`` (a, b).

    Each round gives a node the smallest label among its neighbours and then follows
    labels once; both steps are joins and partial minima, so a node with very many
    links is spread over tasks. Rounds are tables under ``path``; their number is
    about the logarithm of the longest chain of links.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where("a <> b").distinct(), f"{path}/links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")), f"{path}/labels-0")
    turn = 0
    while True:
        turn += 1
        # the smallest label next to a node, offered to the node and to its present label
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        seen = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "m").alias("m"))
        offers = seen.select("node", F.col("m").alias("label")).unionByName(
            seen.where("m < label").select(F.col("label").alias("node"), F.col("m").alias("label")))
        hooked = stored(offers.groupBy("node").agg(F.min("label").alias("label")), f"{path}/hooked-{turn}")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = stored(hooked.join(up, "label").select("node", F.col("up").alias("label")), f"{path}/labels-{turn}")
        changed = jumped.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").limit(1).count()
        labels = jumped
        if not changed:
            return labels
