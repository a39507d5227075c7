"""FASTA files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .lines import files_of, numbered

SCHEMA = "file string, record_no long, header string, sequence string"


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, record_no, header, sequence) of every record with a sequence.

    A file splits at record starts, so a large one is read by many tasks.
    record_no grows with the place of the record, over several files in the
    order of their names (it is not dense). The header keeps trailing blanks;
    sequence lines are joined without blanks and upper-cased; text before the
    first record is dropped.
    """
    raw = numbered(spark, path, "\n>").withColumn("value", F.regexp_replace("value", r"\r\n?", "\n"))
    # the first piece of a file begins with its own mark, or is text before any record
    kept = raw.filter(~F.col("head") | F.col("value").startswith(">"))
    body = kept.withColumn("value", F.when(F.col("head"), F.expr("substring(value, 2)")).otherwise(F.col("value"))).select(
        "file", F.col("line_no").alias("record_no"),
        F.substring_index("value", "\n", 1).alias("header"),
        F.upper(F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n?", ""), r"\s+", "")).alias("sequence"),
    )
    return body.filter(F.length("sequence") > 0)


def read_fasta_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """All sources in the order given, with columns source and source_rank; missing files are left out."""
    out = None
    for rank, (source, path) in enumerate(paths.items()):
        if not files_of(spark, path):
            continue
        one = read_fasta(spark, path).select(F.lit(source).alias("source"), F.lit(rank).alias("source_rank"), "*")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], f"source string, source_rank int, {SCHEMA}")
