"""Best representative of each duplicate group.

One aggregation per table: the survivor of a group is the maximum of a
composite struct, and so is every attribute of its golden record. Maxima
combine on the map side, so a group that holds a third of all rows costs one
row per task; no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, protein_key, squeeze

DESCRIPTIVE = (
    "gene_name", "product_name", "drug_class", "resistance_mechanism", "gene_family",
    "refseq_protein", "genbank_nucleotide", "pmid", "notes",
)
GOLDEN = (*DESCRIPTIVE, "original_header", "source_acc", "aro_accession", "refseq_nucleotide", "genbank_protein", "amr_class", "amr_subclass", "scope", "allele")
#: Sources from the most to the least trusted; others come last.
TRUST = ("CARD", "NCBI", "RESFINDER")


def survivors(df: DataFrame, group: Column, *best: Column, least: int = 2) -> DataFrame:
    """(group_id, survivor) of every group of ``least`` rows or more.

    survivor is the struct (b0, b1, …) of the ``best`` columns that is the
    greatest of the group, compared from left to right; nulls are the smallest,
    so ties end with the last column, which should be unique. Rows repeated in
    full count as rows but change no maximum. Rows of a null group are left
    out; an empty table has no groups. Other columns are not read.
    """
    key = F.struct(*[c.alias(f"b{i}") for i, c in enumerate(best)])
    return (
        df.select(group.alias("group_id"), key.alias("k")).filter("group_id IS NOT NULL")
        .groupBy("group_id").agg(F.max("k").alias("survivor"), F.count("*").alias("n_rows"))
        .filter(F.col("n_rows") >= least)
    )


def golden_records(
    df: DataFrame, group: str, attributes: Sequence[str], source: str = "source", updated: str = "loaded_at", trust: Sequence[str] = TRUST
) -> DataFrame:
    """One row per group, every attribute the best value that any of its rows has.

    Best is, in this order: filled rather than not, of the more trusted source,
    of the latest row, and at last the greatest text, so that no tie is left to
    chance. An attribute no row has filled is null. n_rows counts the rows.
    Rows of a null group are left out. Columns not named are not read.
    """
    ranks = reduce(lambda c, i: c.when(F.upper(F.trim(F.col(source))) == trust[i], len(trust) - i), range(len(trust)), F).otherwise(0)
    base = df.filter(F.col(group).isNotNull()).select(
        F.col(group).alias("__group"), ranks.alias("__rank"), F.col(updated).alias("__at"), *[filled(F.col(a).cast("string")).alias(a) for a in attributes]
    )
    best = [
        F.max(F.struct(F.col(a).isNotNull().alias("has"), F.when(F.col(a).isNotNull(), F.col("__rank")).alias("rank"), F.col("__at").alias("at"), F.col(a).alias("value")))["value"].alias(a)
        for a in attributes
    ]
    return base.groupBy(F.col("__group").alias(group)).agg(F.count("*").alias("n_rows"), *best)


def cluster_survivors(gene: DataFrame) -> DataFrame:
    """(group_id, survivor_id): the gene_id of the best row of each cluster with two rows or more.

    Most filled descriptive fields, then the longest header (a null one has
    length 0), then the latest loaded_at, then the smallest gene_id.
    """
    n = reduce(lambda a, b: a + b, [filled(F.col(c)).isNotNull().cast("int") for c in DESCRIPTIVE])
    header = F.coalesce(F.length(squeeze(F.col("original_header"))), F.lit(0))
    best = survivors(gene, F.col("cluster_id"), n, header, F.unix_micros(F.col("loaded_at").cast("timestamp")), -F.col("gene_id"))
    return best.select("group_id", (-F.col("survivor.b3")).cast("string").alias("survivor_id"))


def protein_survivors(sequence: DataFrame, protein: DataFrame) -> DataFrame:
    """(group_id, survivor_id): of the sequences of each protein the longest, if equal the greatest jrc_id.

    Sequences refer to proteins without regard to case and outer blanks; those
    that refer to none of the table are left out, as are proteins with fewer
    than two sequences. A null sequence has length 0. A protein row written
    twice comes out once.
    """
    length = F.coalesce(F.length(F.trim(F.col("sequence"))), F.lit(0))
    best = survivors(sequence, protein_key(F.col("protein_id")), length, F.col("jrc_id"))
    named = protein.select("protein_id", protein_key(F.col("protein_id")).alias("group_id")).filter("group_id IS NOT NULL").distinct()
    return best.join(named, "group_id").select(F.col("protein_id").alias("group_id"), F.col("survivor.b1").alias("survivor_id"))
