"""Relational operators with explicit order: no result depends on partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_distinct(c: Column, sep: str) -> Column:
    """Distinct non-null values in order, joined; null for a group without any.

    Sets combine on the map side and several such aggregates share one pass.
    """
    values = F.collect_set(c)
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), sep))


def best_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], carry: Sequence[str] | None = None) -> DataFrame:
    """The row of each group that is greatest by ``order``, as one aggregation.

    Unlike a window over the group this combines on the map side, so a group
    that holds a third of all rows does not end in one task. order must end
    with something unique.
    """
    names = list(carry) if carry is not None else [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*names), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col("__best")[n].alias(n) for n in names])


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    names = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*names), F.col(ordinal))
    return df.groupBy(*keys).agg(best.alias("__best")).select(*keys, *[F.col("__best")[n].alias(n) for n in names])


def last_wins(build: DataFrame, key: str, ordinal: str) -> DataFrame:
    """A build side as a dictionary filled row by row leaves it."""
    return best_per_group(build, [key], [F.col(ordinal)])


def any_key_join(left: DataFrame, right: DataFrame, left_key: Column, right_keys: Sequence[Column], how: str = "inner") -> DataFrame:
    """left ⋈ right where left_key equals any of right_keys, as one hash join.

    The right side is exploded to one row per distinct key, so that a row that
    fits by two keys joins once; a disjunction would be a nested loop.
    """
    keys = F.explode(F.array_distinct(F.array(*right_keys))).alias("__k")
    exploded = right.select("*", keys).filter("__k IS NOT NULL")
    return left.withColumn("__l", left_key).join(exploded, F.col("__l") == F.col("__k"), how).drop("__l", "__k")


def tiered_lookup(probe: DataFrame, keys: Sequence[Column], build: DataFrame, key: str, tier: str, ordinal: str, row: str) -> DataFrame:
    """Every probe row with the build row it finds first, if any.

    keys are tried in order; of the build rows of a key the lowest (tier,
    ordinal) counts. row identifies the probe rows.
    """
    tries = F.posexplode(F.array(*keys)).alias("__try", "__k")
    index = build.groupBy(key).agg(F.min_by(F.struct(*[c for c in build.columns if c != key]), F.struct(tier, ordinal)).alias("__hit"))
    hits = probe.select(row, tries).join(index, F.col("__k") == index[key]).groupBy(row).agg(F.min_by("__hit", "__try").alias("__hit"))
    names = [c for c in build.columns if c != key]
    return probe.join(hits, row, "left").select(*[probe[c] for c in probe.columns], *[F.col("__hit")[n].alias(n) for n in names])


def pivot_left(base: DataFrame, facts: DataFrame, key: str, by: str, value: str, values: Sequence[str], prefix: str) -> DataFrame:
    """base with one column per value of ``by``, in one pass over facts instead of one join per value."""
    wide = facts.groupBy(key).agg(*[F.min(F.when(F.col(by) == v, F.col(value))).alias(f"{prefix}{v.lower()}") for v in values])
    return base.join(wide, key, "left")


def union_all(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def missing_both_ways(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys only one of two tables has."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right")))
