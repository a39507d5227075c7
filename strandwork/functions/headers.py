"""Fields of FASTA headers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as an accession inside a header.
ACCESSION = r"^[A-Z]{1,2}_?[0-9]{5,9}(\..*)?$"  # whatever follows a dot is the version


def _part(parts: Column, i: int, least: int) -> Column:
    return F.when(F.size(parts) >= least, F.get(parts, F.lit(i)))


def card_fields(header: Column) -> Column:
    """struct(source_acc, aro_accession, gene_name) of ``gb|acc|strand|range|ARO:n|name [organism]``.

    Fields a header is too short for are null, and so is an ontology field that
    does not begin with ``ARO:``.
    """
    p = F.split(header, r"\|", -1)
    term = F.trim(_part(p, 4, 5))
    name = F.regexp_replace(F.trim(_part(p, 5, 6)), r"\s+\[.*$", "")
    return F.struct(
        F.trim(_part(p, 1, 2)).alias("source_acc"), F.when(term.startswith("ARO:"), term).alias("aro_accession"), F.nullif(name, F.lit("")).alias("gene_name")
    )


def ncbi_accession(header: Column) -> Column:
    """The first word, up to its colon."""
    return F.substring_index(F.element_at(F.split(F.trim(header), r"\s+"), 1), ":", 1)


def resfinder_fields(header: Column, strict: bool = False) -> Column:
    """struct(source_acc, allele, gene_name) of ``gene_number_accession``.

    The accession is sought from the right among single pieces and, where none
    fits, pairs of pieces at the same place; the first piece never is one. The
    pieces before it are the allele, the first of them the gene. Without an
    accession the last piece takes its place. Trailing blanks are cut unless
    ``strict``, which keeps them, as a byte-wise reader does.
    """
    h = header if strict else F.rtrim(header)
    p = F.split(h, "_", -1)
    n = F.size(p)
    places = F.when(n > 1, F.sequence(n - 1, F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    one = lambda i: F.get(p, i).rlike(ACCESSION)
    two = lambda i: (i >= 2) & F.concat_ws("_", F.get(p, i - 1), F.get(p, i)).rlike(ACCESSION)
    at = F.get(F.filter(places, lambda i: one(i) | two(i)), F.lit(0))
    start = F.when(at.isNull(), n - 1).when(one(at), at).otherwise(at - 1)
    acc = F.when(at.isNull(), F.get(p, n - 1)).when(one(at), F.get(p, at)).otherwise(F.concat_ws("_", F.get(p, at - 1), F.get(p, at)))
    return F.struct(acc.alias("source_acc"), F.array_join(F.slice(p, 1, start), "_").alias("allele"), F.get(p, F.lit(0)).alias("gene_name"))


def versionless(accession: Column) -> Column:
    return F.substring_index(accession, ".", 1)
