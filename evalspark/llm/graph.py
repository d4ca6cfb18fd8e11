"""Connected components of a graph given as links, by repeated contraction.

Each round every node hooks to the node of the smallest hash among itself and
its neighbours, and links are rewritten to those nodes; equal ends vanish. The
node of the smallest hash in a component is never hooked elsewhere, so the
rounds end with one node for each component. Hash order makes the number of
rounds logarithmic in practice, for chains as well as for stars. Nothing but
the count of open links reaches the driver, and each round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) to (id, component_id): the smallest id reachable. Nodes without a link to another don't appear."""
    hashed = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    clean = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = cut(clean.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while edges.take(1):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = cut(both.groupBy("a").agg(F.min(hashed("b")).alias("m")).select(F.col("a").alias("id"), F.least("m", hashed("a"))["id"].alias("to")))
        ends = edges.join(hooks.withColumnRenamed("id", "a").withColumnRenamed("to", "ta"), "a").join(hooks.withColumnRenamed("id", "b").withColumnRenamed("to", "tb"), "b")
        edges = cut(ends.where("ta != tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        if labels is None:
            labels = hooks
        else:
            moved = hooks.select(F.col("id").alias("old"), F.col("to").alias("new"))
            labels = cut(labels.join(moved, labels["to"] == moved["old"], "left").select("id", F.coalesce("new", "to").alias("to")))
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    smallest = labels.groupBy("to").agg(F.min("id").alias("component_id"))
    return labels.join(smallest, "to").select("id", "component_id")
