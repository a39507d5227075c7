"""Content addresses and surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_id(c: Column, prefix: str, chars: int = 10) -> Column:
    """prefix and the first hex digits of the MD5 of the upper-cased text."""
    return F.concat(F.lit(prefix), F.substring(F.md5(F.upper(c)), 1, chars))


def padded_id(n: Column, prefix: str, width: int = 6) -> Column:
    """prefix and the number, zeros before it up to ``width`` digits; longer numbers are kept whole."""
    text = n.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def last_number(df: DataFrame | None, column: str) -> int:
    """The greatest number at the end of the ids of a column, 0 if there is none."""
    if df is None:
        return 0
    return df.agg(F.max(F.regexp_extract(F.col(column).cast("string"), r"(\d+)$", 1).try_cast("long"))).first()[0] or 0


def assign_numbers(found: DataFrame, key: str, stored: DataFrame | None, last: int, chars: int = 3, name: str = "n") -> DataFrame:
    """(key, n) of every key found: the stored number of a known key, the next free ones, from ``last`` + 1 on, for the others.

    stored: key and n. New keys are numbered in their own order, so that the
    same load gives the same numbers.
    """
    keys = found.select(key).distinct()
    fresh = keys if stored is None else keys.join(stored.select(key), key, "left_anti")
    numbered = number_rows(fresh, key, chars, name).withColumn(name, F.col(name) + last)
    return numbered if stored is None else keys.join(stored.select(key, name), key).unionByName(numbered)


def number_rows(df: DataFrame, key: str, chars: int = 3, name: str = "n") -> DataFrame:
    """Numbers rows from 1 in the order of ``key``, without one task that orders all.

    Rows are counted per prefix of the key (16^3 prefixes of a hex key), the
    counts alone are added up in order, and each prefix is numbered by itself.
    Keys must be unique for the numbers to be the same in every run.
    """
    keyed = df.withColumn("__p", F.substring(F.col(key), 1, chars))
    counts = keyed.groupBy("__p").agg(F.count("*").alias("__c"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__p", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__o"))
    within = Window.partitionBy("__p").orderBy(key)
    return keyed.withColumn(name, F.row_number().over(within)).join(offsets, "__p").withColumn(name, F.col(name) + F.col("__o")).drop("__p", "__o")
