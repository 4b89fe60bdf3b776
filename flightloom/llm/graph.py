"""Connected components of an undirected graph, by the smallest reachable vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.llm.common import stored


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """v, root for every vertex of ``edges`` (a, b): the smallest vertex it is connected to.

    Labels spread along edges and are then replaced by the label of their label, so rounds
    grow with the logarithm of a chain's length. Each round is a stored table; the driver
    sees only the number of labels that changed. A vertex with very many edges is a hot key
    of a join that feeds a partial minimum, which AQE can split.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    both = stored(
        pairs.select("a", "b").union(pairs.select(F.col("b"), F.col("a"))).distinct(), f"{label}-edges"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select(
            "v", F.least("v", "m").alias("root")
        ),
        f"{label}-0",
    )
    step = 0
    while True:
        step += 1
        offered = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("root").alias("offer"))
        spread = labels.join(offered, labels["v"] == offered["a"]).select(
            "v", "root", F.least("root", "offer").alias("near")
        )
        spread = stored(spread, f"{label}-{step}s")
        over = spread.select(F.col("v").alias("via"), F.col("near").alias("far"))
        jumped = spread.join(over, spread["near"] == over["via"], "left").select(
            "v", F.col("root").alias("before"), F.least("near", F.coalesce("far", "near")).alias("root")
        )
        jumped = stored(jumped, f"{label}-{step}")
        labels = jumped.select("v", "root")
        if jumped.where(F.col("before") != F.col("root")).isEmpty():
            return labels
