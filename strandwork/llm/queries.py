"""Queries of the operators for training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.components import connected_classes
from ..session import table
from .canonical import build_dictionaries, canonicalise, report
from .mixing import Mixture
from .oracles import ORACLES  # noqa: F401
from .neardup import NearDuplicates
from .packing import fill_report, pack
from .sentences import split_sentences, train
from .survivorship import GOLDEN, cluster_survivors, golden_records, protein_survivors
from .tokens import count_tokens


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    clusters = cluster_survivors(table(spark, sf, "gene")).select(F.lit("cluster").alias("group_kind"), "*")
    proteins = protein_survivors(table(spark, sf, "sequence"), table(spark, sf, "protein")).select(F.lit("protein").alias("group_kind"), "*")
    return clusters.unionByName(proteins)


def p3_golden(spark: SparkSession, sf: str) -> DataFrame:
    return golden_records(table(spark, sf, "gene"), "cluster_id", GOLDEN)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = NearDuplicates(table(spark, sf, "sequence"), "jrc_id", "sequence").pairs()
    return pairs.select(F.col("key_a").alias("jrc_id_a"), F.col("key_b").alias("jrc_id_b"))


def p5_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One row per entry: its class and how many entries it is linked to; one without links is a class of its own."""
    linked = connected_classes(p5_found(spark, sf), "jrc_id_a", "jrc_id_b").withColumnRenamed("id", "jrc_id")
    every = table(spark, sf, "sequence").select("jrc_id").filter("jrc_id IS NOT NULL").distinct()
    out = every.join(linked, "jrc_id", "left")
    return out.select("jrc_id", F.coalesce("class_id", "jrc_id").alias("class_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _canonical(spark: SparkSession, sf: str) -> DataFrame:
    return canonicalise(table(spark, sf, "gene"), "gene_id", ["drug_class", "amr_subclass"], build_dictionaries(table(spark, sf, "class_mapping")), single=["amr_subclass"])


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return _canonical(spark, sf).select("gene_id", "field_name", "canonical_name")


def p6_misses(spark: SparkSession, sf: str) -> DataFrame:
    return report(_canonical(spark, sf))


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    return count_tokens(table(spark, sf, "documents"), {"doc_id": F.col("doc_id"), "source": F.col("source")}, "text")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return pack(_sizes(spark, sf))


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    return fill_report(pack(_sizes(spark, sf)))


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return Mixture(_sizes(spark, sf), table(spark, sf, "mix_target")).mixed()


def p9_report(spark: SparkSession, sf: str) -> DataFrame:
    return Mixture(_sizes(spark, sf), table(spark, sf, "mix_target")).report()


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return split_sentences(docs, "doc_id", "text", train(docs))


QUERIES = {f.__name__: f for f in (p3_found, p3_golden, p5_found, p5_groups, p6_found, p6_misses, p8_containers, p8_report, p9_mixture, p9_report, p10_found)}

