"""Connected components of a graph of pairs, by labels that spread in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from traceops.llm.storage import BROADCAST_ROWS, checkpointed, freed, sized


def components(pairs: DataFrame) -> DataFrame:
    """node, component (its smallest node) for the nodes of `pairs` (a, b), a checkpointed table.

    Each round gives every node the smallest of itself and its neighbours and then what that one was given, so that long
    chains shrink. Pairs are renamed by it; those within one node go, and the next round has the rest. So it ends with the last pair, and
    no round only finds that nothing changes. Tables are checkpointed and deleted as soon as they are of no more use; nothing but numbers
    of rows comes to the driver. Repeated pairs, pairs in both directions and loops are fine; no pairs give no rows.
    """
    edges, labels, tables = pairs.select("a", "b"), None, []
    while True:
        up = checkpointed(edges.union(edges.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up")))
        count = up.count()
        step = up.join(sized(up.select(F.col("node").alias("up"), F.col("up").alias("top")), count), "up").select("node", "top")
        if count > BROADCAST_ROWS:  # else it is looked up in the broadcast table each time
            step = checkpointed(step)
            freed(up)
            up = step
        one = sized(step.select(F.col("node").alias("a"), F.col("top").alias("top_a")), count)
        two = sized(step.select(F.col("node").alias("b"), F.col("top").alias("top_b")), count)
        rest = checkpointed(edges.join(one, "a").join(two, "b").filter("top_a != top_b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b")))
        if labels is None:
            labels = step.withColumnRenamed("top", "component")
        else:
            named = sized(step.withColumnRenamed("node", "component"), count)
            labels = labels.join(named, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        tables += [up, rest]
        if not rest.limit(1).count():
            break
        if count > BROADCAST_ROWS and len(tables) > 2:
            labels = checkpointed(labels)
            freed(*tables[:-1])
            tables = [labels, rest]
        edges = rest
    labels = checkpointed(labels)
    freed(*tables)
    return labels
