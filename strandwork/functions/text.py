"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that stand for "no value" (compared in lower case).
NO_VALUE = (
    "na", "n/a", "n.a.", "n.a", "nan", "nil", "none", "null", "unknown", "unk",
    "not available", "not applicable", "not known", "no value", "missing",
    "undefined", "unspecified",
)
BLANK = r"[\s\p{Z}\x{FEFF}]"


def strip(c: Column) -> Column:
    """Cuts outer blanks of every kind (``trim`` knows only the space)."""
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def squeeze(c: Column) -> Column:
    """Outer blanks cut, runs of blanks made one space."""
    return F.regexp_replace(strip(c), f"{BLANK}+", " ")


def filled(c: Column) -> Column:
    """The stripped text, or null where it is blank or stands for "no value"."""
    t = strip(c)
    return F.when(~F.lower(t).isin(*NO_VALUE) & ~t.rlike(r"^[\p{P}\p{S}\s\p{Z}]*$"), t)


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def default_if_blank(c: Column, value: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(value))


def first_filled(*cols: Column) -> Column:
    """First argument that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def is_true(c: Column) -> Column:
    return F.coalesce(c == F.lit("True"), F.lit(False))


def normalise_name(c: Column, *spellings: dict[str, str]) -> Column:
    """Strip, lower case, collapse blanks, then apply each spelling map in turn."""
    out = F.lower(squeeze(c))
    for names in spellings:
        if names:
            pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
            out = F.coalesce(F.try_element_at(pairs, out), out)
    return out


def split_literal(c: Column, sep: str) -> Column:
    """Pieces between literal separators; the empty string has none."""
    quoted = "".join("\\" + ch if not ch.isalnum() and not ch.isspace() else ch for ch in sep)
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, quoted, -1))


def split_clean(c: Column, sep: str, lower: bool = False) -> Column:
    """Stripped non-empty pieces."""
    parts = F.transform(split_literal(c, sep), lambda x: F.lower(strip(x)) if lower else strip(x))
    return F.filter(parts, lambda x: x != "")


def ontology_key(c: Column) -> Column:
    """Digits of an ``ARO:…`` accession, whatever its spelling or trailing remark.

    A filled value without digits keeps its upper-case text, so that it still
    counts as a reference (to nothing). No value gives null.
    """
    t = filled(c)
    digits = F.regexp_extract(t, r"^(?i:ARO)?[\s:_]*([0-9]+)", 1)
    return F.when(digits != "", digits).otherwise(F.upper(t))


def protein_key(c: Column) -> Column:
    return F.upper(filled(c))


def url_quote(c: Column) -> Column:
    """Percent-encoding of a path piece: letters, digits and ``_.-~/`` stay as they are."""
    out = F.url_encode(c)
    for coded, plain in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return out
