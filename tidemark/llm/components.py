"""Connected components by minimum labels and pointer jumping over settled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for every node of an edge (a, b), the smallest node it can reach.

    A round takes the least label of the neighbours, pre-aggregated by node, and then the label's own label.  Labels
    only fall, and jumping halves long chains, so rounds are few; each one's labels are settled in the shared folder.
    """
    with common.released() as keep:
        both = common.settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
        labels = common.settled(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")))
        while True:
            near = both.join(labels, F.col("a") == F.col("node")).groupBy("b").agg(F.min("label").alias("near"))
            lower = labels.join(near, F.col("node") == F.col("b")).select("node", F.least("label", "near").alias("to"), "label")
            own = lower.select(F.col("node").alias("at"), F.col("to").alias("next"))
            jumped = common.settled(lower.join(own, F.col("to") == F.col("at")).select("node", F.least("to", "next").alias("label"), (F.least("to", "next") < F.col("label")).alias("fell")))
            labels = jumped.select("node", "label")
            if not jumped.filter("fell").limit(1).count():
                break
        keep.append(jumped)
    labels._settled_at = jumped._settled_at
    return labels
