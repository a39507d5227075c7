"""Connected classes of a relation given by pairs.

Labels are the smallest id reached so far. A round lets every node take the
least label of its neighbours and then of its label's label, so that distances
shrink by doubling; rounds go on until no label changes. Pairs and labels stay
in tables of the shared folder, nothing is collected, and a class of any size
is rows, never a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialise


def connected_classes(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, class_id, n_links) of every id that is in a pair; class_id is the smallest id of its class.

    Null ends and pairs of an id with itself are ignored, repeated pairs count
    once. An empty relation has no classes.
    """
    whole = pairs.select(F.col(a).alias("p"), F.col(b).alias("q")).filter("p IS NOT NULL AND q IS NOT NULL AND p <> q")
    clean = whole.select(F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y")).distinct()
    both = materialise(clean.select(F.explode(F.array(F.struct(F.col("x").alias("id"), F.col("y").alias("to")), F.struct(F.col("y").alias("id"), F.col("x").alias("to")))).alias("p")).select("p.*"), "links")
    degree = both.groupBy("id").agg(F.count("*").alias("n_links"), F.least(F.col("id"), F.min("to")).alias("label"))
    state = materialise(degree, "labels")
    while True:
        near = both.join(state.select(F.col("id").alias("to"), "label"), "to").groupBy("id").agg(F.min("label").alias("near"))
        step = state.join(near, "id").select("id", "n_links", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        own = state.select(F.col("id").alias("label"), F.col("label").alias("root"))
        now = materialise(step.join(own, "label").select("id", "n_links", "was", F.least("label", "root").alias("label")), "labels")
        changed = not now.filter("was <> label").isEmpty()
        discard(state)
        state = now
        if not changed:
            return state.select("id", F.col("label").alias("class_id"), "n_links")
