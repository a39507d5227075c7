"""Tab-separated and JSON-lines files, and their sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from .lines import first_line, numbered, put_text


def _lines(spark: SparkSession, path: str, header: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    rows = numbered(spark, path).select("line_no", F.regexp_replace("value", "\r$", "").alias("value"))
    if header is not None:
        return rows, list(header)
    first = (first_line(spark, path) or "").rstrip("\r")
    return rows.filter(F.col("value") != first), first.split("\t") if first else []  # every file may begin with the header


def read_raw(spark: SparkSession, path: str, header: Sequence[str] | None = None) -> DataFrame:
    """Cells by tabs alone, quotes being ordinary characters; rows with too few cells are dropped."""
    rows, names = _lines(spark, path, header)
    cells = rows.select("line_no", F.split("value", "\t", -1).alias("c")).filter(F.size("c") >= len(names))
    return cells.select("line_no", *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_padded(spark: SparkSession, path: str, header: Sequence[str] | None = None, least: int = 2) -> DataFrame:
    """Like ``read_raw``, but only rows under ``least`` cells are dropped; missing cells are null."""
    rows, names = _lines(spark, path, header)
    cells = rows.select("line_no", F.split("value", "\t", -1).alias("c")).filter(F.size("c") >= least)
    return cells.select("line_no", *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_quoted(spark: SparkSession, path: str, schema: T.StructType | str | None = None, place: str | None = None) -> DataFrame:
    """Tab-separated with a header and CSV quoting; empty cells are empty strings, not null.

    place: name of a column that tells the order of the rows (a quoted cell may
    hold line breaks, so a file is read by one task, from its start to its end).
    """
    reader = spark.read.option("sep", "\t").option("header", True).option("escape", '"').option("multiLine", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if place:
        df = df.select(F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")).alias(place), "*")
    return df.fillna("", text)


def read_ragged_classes(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, class_raw, place, drug): classes with any number of drugs.

    Blank lines, comments, the header and entries under development are
    skipped; the second cell is a placeholder.
    """
    rows = numbered(spark, path).select("line_no", strip(F.col("value")).alias("value"))
    cells = rows.filter((F.col("value") != "") & ~F.col("value").startswith("#")).select("line_no", F.split("value", "\t", -1).alias("c"))
    named = cells.withColumn("class_raw", strip(F.get("c", F.lit(0)))).filter(~F.col("class_raw").isin("Class", "UNDER_DEVELOPMENT"))
    drugs = F.slice("c", F.lit(3), F.greatest(F.size("c") - 2, F.lit(0)))
    return named.select("line_no", "class_raw", F.posexplode(drugs).alias("place", "drug")).withColumn("drug", strip(F.col("drug"))).filter("drug <> ''")


REPORT = (
    "productName string, geneFamily string, allele string, class string, subclass string, type string, subtype string, scope string, "
    "refseqNucleotide struct<accessionVersion:string>, refseqProtein struct<accessionVersion:string>, "
    "genbankNucleotide struct<accessionVersion:string>, genbankProtein struct<accessionVersion:string>"
)


def read_json_lines(spark: SparkSession, path: str, schema: str = REPORT, strict: bool = False) -> DataFrame:
    """line_no and the fields of JSON lines; bad lines are dropped, or fail the read if ``strict``. Blank lines do not count."""
    rows = numbered(spark, path).filter(F.col("value").rlike(r"\S"))
    if strict:
        parsed = rows.select("line_no", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("v"))
    else:
        bad = "__bad"
        parsed = rows.select("line_no", F.from_json("value", f"{schema}, {bad} string", {"columnNameOfCorruptRecord": bad}).alias("v"))
        parsed = parsed.filter(f"v IS NOT NULL AND v.{bad} IS NULL").withColumn("v", F.col("v").dropFields(bad))
    return parsed.select("line_no", "v.*")


def read_landed(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """Responses of services landed as one JSON object {key: fields}; an unreadable file is an empty table."""
    text = spark.read.text(path, wholetext=True)
    parsed = text.select(F.from_json("value", f"map<string, struct<{', '.join(f'{n}:{t}' for n, t in (x.split() for x in schema.split(', ')))}>>").alias("m"))
    return parsed.filter("m IS NOT NULL").select(F.explode("m").alias(key, "v")).select(key, "v.*")


def save_landed(df: DataFrame, path: str, key: str) -> None:
    """Writes responses as the JSON object that ``read_landed`` reads, put in place by one move.

    For a cache of service responses, which is as small as the list of names
    it was asked for; rows without a key are left out, the last row in order of
    all fields counts where a key occurs twice.
    """
    fields = [c for c in df.columns if c != key]
    one = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*fields)).alias("v"))
    whole = one.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "v"))))).alias("value"))
    text = whole.first().value or "{}"
    put_text(df.sparkSession, path, text)


def write_table(df: DataFrame, path: str, columns: Sequence[str], distinct: bool = False) -> None:
    """One tab-separated file with a header; columns not named are left out. For vocabularies, which are small."""
    out = df.select(*columns)
    (out.distinct().orderBy(*columns) if distinct else out).coalesce(1).write.mode("overwrite").option("sep", "\t").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_export(df: DataFrame, path: str, null: str) -> None:
    """Tab-separated export without quoting, written by all tasks; null is how a missing value reads."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit(null)).alias(c) for c in df.columns])
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
