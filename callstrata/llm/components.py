"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b); nodes of one component share a root.

    Each round points every node at the neighbour (or itself) that is least in a fresh order,
    follows the pointers a few steps and replaces each link by the link of its ends' targets.
    Components shrink by a constant share per round, so rounds grow with the logarithm of the
    longest path. Only minima are gathered per node, which combine before the shuffle; each round
    is stored in the shared folder. Self links and repeated links are harmless; no links give no rows.
    """
    rng = np.random.default_rng(11)
    edges = stored(links.select("a", "b").where(F.col("a") != F.col("b")))
    labels = None
    while not edges.isEmpty():
        order = F.lit(int(rng.integers(-(1 << 63), 1 << 63)))
        both = edges.union(edges.select("b", "a"))
        up = stored(
            both.groupBy("a").agg(F.min(F.col("b").bitwiseXOR(order)).alias("best"))
            .select(F.col("a").alias("node"),
                    F.least(F.col("best"), F.col("a").bitwiseXOR(order)).bitwiseXOR(order).alias("to"))
        )
        for _ in range(2):
            further = up.select(F.col("node").alias("to"), F.col("to").alias("next"))
            up = up.join(further, "to").select("node", F.col("next").alias("to"))
        up = stored(up)
        left = up.select(F.col("node").alias("a"), F.col("to").alias("x"))
        right = up.select(F.col("node").alias("b"), F.col("to").alias("y"))
        edges = stored(
            edges.join(left, "a").join(right, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        if labels is None:
            labels = up.withColumnRenamed("to", "root")
        else:
            step = up.select(F.col("node").alias("root"), F.col("to").alias("next"))
            labels = stored(
                labels.join(step, "root", "left")
                .select("node", F.coalesce("next", "root").alias("root"))
            )
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
