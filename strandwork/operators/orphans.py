"""References to records that do not exist.

Keys are dictionary-encoded as integers, the codes of one key range and period
form one compressed bitmap, and orphans are the bits of the references that are
not set in the bitmap of the parents known by then.

Shuffles: one aggregation by key (with map-side combine, so a key that holds a
third of all rows arrives as a handful of rows), one by key range, and the join
that leads the surviving (key, period) pairs back to their rows. AQE splits the
row side of that join where one key is hot; the survivor side is unique.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 16
SPARSE = 4096  # a container with fewer codes is kept as a sorted array
NO_PERIOD = -1


@dataclass(frozen=True)
class Link:
    """Rows of ``child`` refer by ``key`` to ``parent_key`` of ``parent``.

    withdrawn marks parent rows that count as gone. A row is identified by
    ``row_key``. Null keys are no reference. Extra columns are not read.
    """

    name: str
    child: DataFrame
    row_key: Column
    key: Column
    loaded_at: Column
    parent: DataFrame
    parent_key: Column
    parent_loaded_at: Column
    withdrawn: Column | None = None


class Bits:
    """Set of 16-bit codes: sorted array when sparse, packed bits when dense."""

    def __init__(self, codes: np.ndarray):
        self.dense = len(codes) >= SPARSE
        if self.dense:
            flags = np.zeros(1 << RANGE_BITS, np.uint8)
            flags[codes] = 1
            self.data = np.packbits(flags)
        else:
            self.data = np.unique(codes.astype(np.uint16))

    def and_not(self, other: "Bits | None") -> np.ndarray:
        """Codes set here and not in other."""
        if other is None:
            return self.codes()
        if self.dense and other.dense:
            return np.flatnonzero(np.unpackbits(self.data & ~other.data))
        mine = self.codes()
        if other.dense:
            return mine[(other.data[mine >> 3] >> (7 - (mine & 7))) & 1 == 0]
        return np.setdiff1d(mine, other.data, assume_unique=True).astype(np.int64)

    def codes(self) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(self.data)) if self.dense else self.data.astype(np.int64)


def _survivors(pdf: pd.DataFrame) -> pd.DataFrame:
    """Orphan (key, period) pairs of one key range."""
    codes = pdf.code.to_numpy()
    first = pdf.parent_period.to_numpy(dtype=np.float64, na_value=np.nan)
    lives = (pdf.has_parent & ~pdf.withdrawn).to_numpy(dtype=bool)
    # a parent without any date is known from the start
    since = np.where(np.isnan(first), -np.inf, first)
    order = pdf.periods.to_numpy()
    counts = np.fromiter((len(x) for x in order), np.int64, len(order))
    periods = np.concatenate(order) if counts.sum() else np.zeros(0, np.int64)
    refs = np.repeat(codes, counts)
    at = np.full(1 << RANGE_BITS, -1, np.int64)
    at[codes] = np.arange(len(codes))
    out = []
    for period in np.unique(periods):
        known = Bits(codes[lives & ((since < period) | (period == NO_PERIOD))])
        left = Bits(refs[periods == period]).and_not(known)
        if len(left):
            out.append((at[left], np.full(len(left), period)))
    if not out:  # no rows, but columns of the right types
        out.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
    rows = np.concatenate([r for r, _ in out])
    hit, period = pdf.iloc[rows], np.concatenate([p for _, p in out])
    reason = np.where(
        ~hit.has_parent, "missing", np.where(hit.withdrawn, "withdrawn", np.where(since[rows] > period, "later", "check"))
    )
    return pd.DataFrame(
        {"link": hit.link.array, "key": hit.key.array, "period": period, "reason": reason, "first_at": hit.first_at.array}
    )


def _period(ts: Column) -> Column:
    return F.coalesce(F.year(ts) * 12 + F.month(ts) - 1, F.lit(NO_PERIOD)).cast("long")


def orphan_references(links: list[Link]) -> DataFrame:
    """One row (ref_table, row_key, period, loaded_at, reason) per orphan reference.

    reason: ``missing`` no parent has the key, ``withdrawn`` every hope of it is
    marked so, ``later`` the earliest parent was loaded after the row. A row or
    parent without loaded_at is never ``later``. Rows without a key are no
    references; rows repeated in the child come out as often as they went in;
    an empty parent makes every reference ``missing``.
    """
    refs = reduce(
        DataFrame.unionByName,
        [
            x.child.select(F.lit(x.name).alias("link"), x.row_key.cast("string").alias("row_key"), x.key.alias("key"), x.loaded_at.cast("timestamp").alias("loaded_at"))
            for x in links
        ],
    ).filter("key IS NOT NULL").withColumn("period", _period(F.col("loaded_at")))
    parents = reduce(
        DataFrame.unionByName,
        [
            x.parent.select(
                F.lit(x.name).alias("link"),
                x.parent_key.alias("key"),
                x.parent_loaded_at.cast("timestamp").alias("first_at"),
                F.coalesce(x.withdrawn if x.withdrawn is not None else F.lit(False), F.lit(False)).alias("withdrawn"),
            )
            for x in links
        ],
    ).filter("key IS NOT NULL")
    spark = refs.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    facts = (
        refs.select("link", "key", "period", F.lit(None).cast("timestamp").alias("first_at"), F.lit(False).alias("withdrawn"), F.lit(False).alias("has_parent"))
        .unionByName(parents.select("*", F.lit(None).cast("long").alias("period"), F.lit(True).alias("has_parent")))
        .groupBy("link", "key")
        .agg(F.collect_set("period").alias("periods"), F.min("first_at").alias("first_at"), F.max("withdrawn").alias("withdrawn"), F.max("has_parent").alias("has_parent"))
    )
    # The dictionary: codes are dense within a slot of keys, in key order.
    slot = Window.partitionBy("link", "slot").orderBy("key")
    coded = (
        facts.withColumn("slot", F.pmod(F.xxhash64("key"), F.lit(slots)))
        .withColumn("n", F.row_number().over(slot).cast("long") - 1)
        .withColumn("range", F.shiftright("n", RANGE_BITS))
        .withColumn("code", F.col("n").bitwiseAND((1 << RANGE_BITS) - 1))
        .withColumn("parent_period", F.when(F.col("first_at").isNotNull(), _period(F.col("first_at"))))
    )
    left = coded.groupBy("link", "slot", "range").applyInPandas(
        _survivors, "link string, key string, period long, reason string, first_at timestamp"
    )
    return (
        refs.join(left, ["link", "key", "period"])
        .filter((F.col("reason") != "check") | (F.col("first_at") > F.col("loaded_at")))
        .select(
            F.col("link").alias("ref_table"),
            "row_key",
            F.when(F.col("period") >= 0, F.format_string("%04d-%02d", (F.col("period") / 12).cast("int"), (F.col("period") % 12 + 1).cast("int"))).alias("period"),
            "loaded_at",
            F.when(F.col("reason") == "check", "later").otherwise(F.col("reason")).alias("reason"),
        )
    )


def orphan_report(links: list[Link]) -> DataFrame:
    """Orphans per table, period and reason."""
    return orphan_references(links).groupBy("ref_table", "period", "reason").agg(F.count("*").alias("n_rows"))
