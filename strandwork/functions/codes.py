"""Delimited lists of codes, as arrays inside and text at the edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import split_clean, strip

# Fixed value: categories of therapeutic codes, the preferred first.
CATEGORIES = ("J", "Q", "P", "D", "A", "L", "B", "C", "G", "H", "M", "N", "R", "S", "V")
LEAF = r"\b(Q?[A-Z]\d{2}[A-Z]{2}\d{2})\b"


def category_rank(code: Column) -> Column:
    """Place of a code's category, from 1; unknown ones come last."""
    place = F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), F.substring(code, 1, 1))
    return F.when(place == 0, F.lit(len(CATEGORIES) + 1)).otherwise(place)


def _codes(c: Column) -> Column:
    return F.array_distinct(F.filter(split_clean(c, ","), lambda x: F.upper(x) != "NA"))


def sort_codes(c: Column) -> Column:
    """Distinct codes of a comma list, by category; within one in their own order."""
    keyed = F.transform(_codes(c), lambda x, i: F.struct(category_rank(x).alias("r"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def sort_codes_text(c: Column) -> Column:
    return F.array_join(sort_codes(c), ",")


def clean_list(c: Column) -> Column:
    """Distinct entries of a comma list in their own order, without NA."""
    return F.array_join(_codes(c), ",")


def clean_group(c: Column) -> Column:
    t = strip(c)
    return F.when(F.upper(t) != "NA", F.nullif(t, F.lit("")))


def combination_key(c: Column) -> Column:
    """Names of a combination as a key that knows no order; null for fewer than two."""
    names = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.lower(c), r"\s*[/+&]\s*"), strip), lambda x: x != "")))
    return F.when(F.size(names) >= 2, F.array_join(names, "\u0001"))


def last_leaf_code(c: Column) -> Column:
    """The last full code named in a text."""
    return F.try_element_at(F.regexp_extract_all(c, F.lit(LEAF), 1), F.lit(-1))


def dotted_version(c: Column) -> Column:
    """1.2.3 as one number to the base 1000."""
    return F.aggregate(F.split(c, r"\."), F.lit(0).cast("long"), lambda a, x: a * 1000 + F.coalesce(x.try_cast("long"), F.lit(0)))


def href_code(href: Column, pattern: str) -> Column:
    """The ``code`` a link asks for, in capitals, or null where it has none that fits the pattern."""
    code = F.upper(F.trim(F.regexp_extract(href, r"\?code=([^&]*)", 1)))
    return F.when(code.rlike(pattern) & (code != ""), code)
