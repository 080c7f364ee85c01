"""Classes that links make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packhorse.llm.common import stored


def smallest_reachable(links: DataFrame) -> DataFrame:
    """Per member of the links (a, b): `set` and `class`, the smallest member that links reach.

    Every node takes the smallest label of its neighbours, then the label of its
    label, until nothing changes; each round is stored. Labels halve the way to
    the smallest member, so rounds grow with the logarithm of a chain's length.
    """
    both = stored(
        links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = both.groupBy(F.col("a").alias("set")).agg(F.least(F.min("b"), F.first("a")).alias("class"))
    labels = stored(labels, "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["set"])
            .groupBy("a").agg(F.min("class").alias("near"))
        )
        lower = labels.join(near, labels["set"] == near["a"]).select(
            "set", F.least("class", "near").alias("class"), F.col("class").alias("old")
        )
        lower = stored(lower, "lower")
        up = lower.select(F.col("set").alias("up"), F.col("class").alias("top"))
        jumped = lower.join(up, F.col("class") == F.col("up")).select("set", F.least("class", "top").alias("class"), "old")
        jumped = stored(jumped, "labels")
        labels = jumped.select("set", "class")
        if jumped.filter("class != old").limit(1).count() == 0:
            return labels
