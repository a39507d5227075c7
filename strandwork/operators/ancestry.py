"""First matching ancestor, in depth-first order of the parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

MAX_DEPTH = 8


def first_ancestor(seeds: DataFrame, edges: DataFrame, hits: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(id, hit) of the first ancestor of each seed that hits names.

    seeds: id. edges: id, parent, ordinal (order of a node's parents). hits:
    node, hit. A hit ends its branch; branches follow the order of parents, the
    first of them being depth 0, and end beyond ``max_depth`` or at a node they
    already hold. Seeds that find nothing have no row.

    One join per level, over the branches still open; found branches are set
    aside and the least path of each seed wins, which is depth-first order.
    """
    named = hits.select(F.col("node").alias("at"), "hit")
    step = edges.select(F.col("id").alias("at"), F.col("parent").alias("next"), F.format_string("%06d", "ordinal").alias("o"))
    front = seeds.select("id", F.col("id").alias("at"), F.lit("").alias("path"), F.array("id").alias("seen"))
    found: DataFrame | None = None
    for _ in range(max_depth + 1):
        grown = front.join(step, "at").filter(~F.array_contains("seen", F.col("next"))).select(
            "id", F.col("next").alias("at"), F.concat("path", "o").alias("path"), F.array_append("seen", F.col("next")).alias("seen")
        )
        level = materialise(grown.join(named, "at", "left"), "level")
        new = level.filter("hit IS NOT NULL").select("id", "path", "hit")
        found = new if found is None else found.unionByName(new)
        front = level.filter("hit IS NULL").drop("hit")
        if front.isEmpty():
            break
    return found.groupBy("id").agg(F.min_by("hit", "path").alias("hit"))
