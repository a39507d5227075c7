"""Everything that links lead to, each visited once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise


def reachable(links: DataFrame, seeds: DataFrame, carry: str | None = None) -> DataFrame:
    """(id) of the seeds and of every id that links (id, to) lead to from them; circles end by themselves.

    carry: a column of the seeds by which they are followed apart, so that the
    result is (id, carry). One join per step, over what the last step found
    new; seeds that no link names stay in the result. Nulls are ignored.
    """
    keys = ["id", carry] if carry else ["id"]
    step = links.select("id", "to").filter("id IS NOT NULL AND to IS NOT NULL").distinct()
    front = materialise(seeds.select(*keys).filter("id IS NOT NULL").distinct(), "reached")
    parts = [front]
    while True:
        seen = parts[0]
        for more in parts[1:]:
            seen = seen.unionByName(more)
        grown = front.join(step, "id").select(F.col("to").alias("id"), *keys[1:]).distinct()
        front = materialise(grown.join(seen, keys, "left_anti"), "reached")
        if front.isEmpty():
            discard(front)
            return seen
        parts.append(front)
