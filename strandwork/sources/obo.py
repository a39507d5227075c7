"""Ontology files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import numbered


def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """(id, name, is_a, relationships, is_obsolete): one row per ``[Term]`` stanza with an id.

    is_a is an array in file order; relationships an array of (type, target).
    Only ``ARO:`` targets count. Of stanzas with the same id the last counts.
    """
    text = numbered(spark, path, "\n\n").select(F.col("line_no").alias("n"), F.regexp_replace("value", r"[ \t\r]+(?=\n|$)", "").alias("v"))
    term = text.filter(F.col("v").rlike(r"(?m)^\[Term\]$")).withColumn("v", F.regexp_replace("v", r"(?ms)^\[Typedef\]$.*", ""))
    types = F.regexp_extract_all("v", F.lit(r"(?m)^relationship: (\S+) ARO:\d+"), 1)
    targets = F.regexp_extract_all("v", F.lit(r"(?m)^relationship: \S+ (ARO:\d+)"), 1)
    rows = term.select(
        "n",
        F.regexp_extract("v", r"(?m)^id: (.*)$", 1).alias("id"),
        F.regexp_extract("v", r"(?m)^name: (.*)$", 1).alias("name"),
        F.regexp_extract_all("v", F.lit(r"(?m)^is_a: (ARO:\d+)"), 1).alias("is_a"),
        F.zip_with(types, targets, lambda a, b: F.struct(a.alias("type"), b.alias("target"))).alias("relationships"),
        F.col("v").rlike(r"(?m)^is_obsolete: true$").alias("is_obsolete"),
    ).filter("id <> ''")
    return rows.groupBy("id").agg(F.max_by(F.struct("name", "is_a", "relationships", "is_obsolete"), "n").alias("t")).select("id", "t.*")


MODEL = "struct<ARO_category: map<string, struct<category_aro_class_name: string, category_aro_accession: string, category_aro_name: string>>>"


def read_nested_classes(spark: SparkSession, path: str) -> DataFrame:
    """(aro_accession, name) of all drug classes named anywhere in a nested document of models.

    One row per name; of several accessions of a name the last in the document
    counts, and of several names of an accession each has its row.
    """
    text = spark.read.text(path, wholetext=True)
    # values that are no models, such as a version, are texts that hold no such struct
    parts = text.select(F.posexplode(F.map_values(F.from_json("value", "map<string, string>"))).alias("m_no", "part"))
    models = parts.select("m_no", F.from_json("part", MODEL).alias("m"))
    classes = models.select("m_no", F.posexplode(F.map_values("m.ARO_category")).alias("c_no", "c")).filter("c.category_aro_class_name = 'Drug Class'")
    last = F.max_by("c.category_aro_accession", F.struct("m_no", "c_no"))
    return classes.groupBy(F.col("c.category_aro_name").alias("name")).agg(last.alias("aro_accession")).select("aro_accession", "name")
