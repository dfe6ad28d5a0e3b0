"""Connected components of a link table, as joins and aggregates.

Every node hooks to its smallest neighbour, hooks are shortened by pointer
jumping, and the links are rewritten to the hooks' ends, until none is left.
A component's smallest node never hooks away, so it becomes the label. Tables
between rounds are written to the shared folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitrend.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; ``component`` is
    the smallest node reachable."""
    links = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    label = None
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("h")), "hooks")
        while True:
            up = hook.select(F.col("a").alias("h"), F.col("h").alias("up"))
            jumped = materialize(hook.join(up, "h").select("a", F.col("up").alias("h"),
                                                           (F.col("up") != F.col("h")).alias("moved")), "hooks")
            moved = not jumped.where("moved").isEmpty()
            hook = jumped.select("a", "h")
            if not moved:
                break
        label = hook.select(F.col("a").alias("node"), F.col("h").alias("component")) if label is None else \
            label.join(hook, F.col("component") == F.col("a"), "left").select(
                "node", F.coalesce("h", "component").alias("component"))
        to_a = hook.select("a", F.col("h").alias("ha"))
        to_b = hook.select(F.col("a").alias("b"), F.col("h").alias("hb"))
        links = materialize(links.join(to_a, "a").join(to_b, "b").where("ha <> hb")
                            .select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b"))
                            .distinct(), "links")
        if links.isEmpty():
            return label
