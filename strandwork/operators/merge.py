"""Insert-ignore, upsert and constraint checks by snapshot.

A merge gives the next snapshot of a table; ``plans.store`` writes it and
makes it the live one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import keep_first


def deduplicated(new: DataFrame, keys: Sequence[str], ordinal: str | None = None) -> DataFrame:
    """One row per key: the first by ordinal or, without one, the least by all its columns; never an arbitrary one."""
    if ordinal:
        return keep_first(new, keys, ordinal).select(*new.columns)
    rest = [c for c in new.columns if c not in keys]
    if not rest:
        return new.distinct()
    least = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__least"))
    return least.select(*keys, *[F.col("__least")[c].alias(c) for c in rest]).select(*new.columns)


def insert_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str], ordinal: str | None = None) -> DataFrame:
    """existing and the rows of new whose key it has not; of equal keys in new the first counts."""
    fresh = deduplicated(new, keys, ordinal).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str], ordinal: str | None = None) -> DataFrame:
    """existing with the rows of new in place of those of equal key."""
    fresh = deduplicated(new, keys, ordinal)
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(fresh, allowMissingColumns=True)


def widen(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with the columns it has not, empty."""
    return df.select("*", *[F.lit("").alias(c) for c in columns if c not in df.columns])


def update_column(df: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """Keyed update of one column; rows without a change keep their value, of several changes of a key the greatest counts."""
    return df.join(changes.groupBy(key).agg(F.max(column).alias("__new")), key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")


def violations(df: DataFrame, table: str, unique: Sequence[Sequence[str]] = (), not_null: Sequence[str] = (), parents: dict[str, tuple[DataFrame, str]] | None = None, allowed: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """(table_name, rule, n_rows): rows that break a declared constraint; no row for rules that hold."""
    found = []
    tell = lambda rule, rows: rows.agg(F.count("*").alias("n_rows")).select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "n_rows")
    for keys in unique:
        found.append(tell(f"unique {','.join(keys)}", df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")))
    for c in not_null:
        found.append(tell(f"not null {c}", df.filter(F.col(c).isNull())))
    for c, (parent, key) in (parents or {}).items():
        found.append(tell(f"foreign key {c}", df.filter(F.col(c).isNotNull()).join(parent.select(F.col(key).alias(c)).distinct(), c, "left_anti")))
    for c, values in (allowed or {}).items():
        found.append(tell(f"check {c}", df.filter(~F.col(c).isin(list(values)))))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.filter("n_rows > 0")
