"""Connected components of a link table, by hooking and pointer jumping in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in ``links(a, b)``: the smallest id reachable.

    Each round hooks every node to its smallest neighbour, shortens the paths, and keeps only
    links between different trees, in tables below the shared folder. Stars end in two
    rounds, and a chain shrinks to less than half its length in each. A hub costs one row
    per neighbour and is pre-aggregated by ``min`` before its shuffle.
    """
    open_links = stored(
        links.select("a", "b").where("a <> b").distinct(), "component-links"
    )
    both = open_links.select("a").union(open_links.select("b")).distinct()
    labels = both.select(F.col("a").alias("id"), F.col("a").alias("component"))
    while not open_links.isEmpty():
        two_way = open_links.union(open_links.select("b", "a"))
        hooks = stored(
            two_way.groupBy("a").agg(F.least("a", F.min("b")).alias("up")), "component-hooks"
        )
        for _ in range(2):
            above = hooks.select(F.col("a").alias("mid"), F.col("up").alias("top"))
            hooks = hooks.join(above, F.col("up") == F.col("mid")).select(
                "a", F.col("top").alias("up")
            )
        hooks = stored(hooks, "component-hooks")
        labels = stored(
            labels.join(hooks, F.col("component") == F.col("a"), "left").select(
                "id", F.coalesce("up", "component").alias("component")
            ),
            "component-labels",
        )
        first = hooks.select("a", F.col("up").alias("new_a"))
        second = hooks.select(F.col("a").alias("b"), F.col("up").alias("new_b"))
        open_links = stored(
            open_links.join(first, "a")
            .join(second, "b")
            .where("new_a <> new_b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
            .distinct(),
            "component-links",
        )
    return labels
