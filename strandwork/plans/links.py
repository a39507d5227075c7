"""Evidence that links sequences to classes and drugs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import any_key_join, join_distinct, union_all


def card_classes(gene: DataFrame, gene_class: DataFrame) -> DataFrame:
    rows = gene.filter("source = 'CARD' AND aro_accession IS NOT NULL").select("jrc_id", "aro_accession")
    return rows.join(gene_class.select("aro_accession", "canonical_class"), "aro_accession").select("jrc_id", "canonical_class", F.lit("CARD").alias("evidence_source"))


def ncbi_linked_classes(gene: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    tokens = links.filter("canonical_class_token <> ''").select("gene_name", F.col("canonical_class_token").alias("canonical_name")).distinct()
    rows = gene.filter("source = 'NCBI'").select("jrc_id", "gene_name").join(tokens.join(classes.select("canonical_name"), "canonical_name"), "gene_name")
    return rows.select("jrc_id", F.col("canonical_name").alias("canonical_class"), F.lit("NCBI").alias("evidence_source"))


def ncbi_listed_classes(gene: DataFrame, classes: DataFrame) -> DataFrame:
    token = F.explode(F.filter(F.split("amr_class", "/"), lambda x: x != ""))
    rows = gene.filter("source = 'NCBI' AND amr_class IS NOT NULL").select("jrc_id", token.alias("token")).withColumn("k", F.upper(F.trim("token")))
    named = classes.select(F.upper("ncbi_alias").alias("k"), F.col("canonical_name").alias("canonical_class"))
    return rows.join(named, "k").select("jrc_id", "canonical_class", F.lit("NCBI").alias("evidence_source"))


def resfinder_classes(gene: DataFrame, classes: DataFrame) -> DataFrame:
    rows = gene.filter("source = 'RESFINDER' AND drug_class IS NOT NULL").select("jrc_id", "drug_class")
    named = classes.select(F.col("canonical_name").alias("canonical_class"), F.col("resfinder_alias").alias("alias"))
    found = any_key_join(rows, named, F.lower("drug_class"), [F.lower("alias"), F.lower("canonical_class")])
    return found.select("jrc_id", "canonical_class", F.lit("RESFINDER").alias("evidence_source"))


def sequence_classes(gene: DataFrame, gene_class: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """(jrc_id, canonical_class, evidence_sources), all paths in one aggregation that also removes repeats."""
    raw = union_all(card_classes(gene, gene_class), ncbi_linked_classes(gene, links, classes), ncbi_listed_classes(gene, classes), resfinder_classes(gene, classes))
    return raw.groupBy("jrc_id", "canonical_class").agg(join_distinct(F.col("evidence_source"), "|").alias("evidence_sources"))


def sequence_drugs(gene: DataFrame, links: DataFrame, drugs: DataFrame) -> DataFrame:
    tokens = links.filter("canonical_drug_token <> ''").select("gene_name", F.col("canonical_drug_token").alias("canonical_drug")).distinct()
    known = tokens.join(drugs.select(F.col("canonical_name").alias("canonical_drug")), "canonical_drug", "left_semi")
    rows = gene.filter("source = 'NCBI'").select("jrc_id", "gene_name").join(known, "gene_name")
    return rows.select("jrc_id", "canonical_drug").distinct().withColumn("evidence_sources", F.lit("NCBI"))
