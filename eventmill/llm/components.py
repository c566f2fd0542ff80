"""Connected components of nodes that share buckets, by minimum labels passed through the buckets and shortcuts between labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm import text as T


def components(members: DataFrame) -> DataFrame:
    """node, label (the smallest node of its component) for rows (node, bucket).

    A round sends every node the smallest label in its buckets, then replaces each label by that label's own. Buckets of any
    size cost a partial minimum and a join that adaptive execution splits (with a stored table, as it cannot split one with an aggregate); rounds grow with the logarithm of the longest chain.
    """
    members = T.written(members.select("node", "bucket").distinct(), "members")
    labels = T.written(members.groupBy("node").agg(F.col("node").alias("label")), "labels")
    while True:
        lowest = T.written(members.join(labels, "node").groupBy("bucket").agg(F.min("label").alias("label")), "lowest")
        heard = members.join(lowest, "bucket").groupBy("node").agg(F.min("label").alias("heard"))
        jumps = labels.select(F.col("node").alias("heard"), F.col("label").alias("label2"))
        closer = heard.join(jumps, "heard").select("node", F.least("heard", "label2").alias("label"))
        old = labels.withColumnRenamed("label", "old")
        following = T.written(closer.join(old, "node"), "labels")
        if following.where("label <> old").isEmpty():
            return following.select("node", "label")
        labels = following.select("node", "label")
