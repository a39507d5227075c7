"""From FASTA records to sequences, clusters, metadata and proteins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codon import translate
from ..functions.headers import card_fields, ncbi_accession, resfinder_fields, versionless
from ..functions.ids import content_id, last_number, number_rows, padded_id
from ..functions.text import first_filled
from ..operators.relational import best_per_group, last_wins, union_all

SOURCES = ("RESFINDER", "CARD", "NCBI")
#: Columns of the gene table that come from metadata.
DESCRIPTIVE = (
    "gene_name", "product_name", "drug_class", "resistance_mechanism", "gene_family", "aro_accession", "refseq_protein",
    "refseq_nucleotide", "genbank_protein", "genbank_nucleotide", "amr_class", "amr_subclass", "scope", "allele", "ncbi_type",
    "ncbi_subtype", "pmid", "notes", "required_gene", "card_short_name", "card_cvterm_id", "card_model_id", "card_model_sequence_id",
)


def _shaped(df: DataFrame) -> DataFrame:
    base = ["source", "source_rank", "file", "record_no", "header", "sequence", "source_acc"]
    return df.select(*base, *[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in DESCRIPTIVE])


def card_records(fasta: DataFrame, index: DataFrame) -> DataFrame:
    """CARD records with the row of the index for their accession.

    index: line_no and the columns of the index file. It is keyed by accession
    with and without version; of several rows of a key the last counts.
    """
    acc = F.col("DNA Accession")
    keyed = union_all(index.withColumn("key", acc), index.withColumn("key", versionless(acc))).filter("key <> ''")
    meta = last_wins(keyed, "key", "line_no")
    rows = fasta.withColumn("h", card_fields(F.col("header"))).withColumn("source_acc", F.col("h.source_acc"))
    out = rows.join(meta, rows.source_acc == meta["key"], "left")
    name = first_filled(F.col("h.gene_name"), F.col("ARO Name"))
    return _shaped(out.select(
        *[rows[c] for c in ("source", "source_rank", "file", "record_no", "header", "sequence", "source_acc")],
        name.alias("gene_name"), name.alias("allele"), first_filled(F.col("Model Name"), F.col("ARO Name")).alias("product_name"),
        F.col("Drug Class").alias("drug_class"), F.col("Resistance Mechanism").alias("resistance_mechanism"), F.col("AMR Gene Family").alias("gene_family"),
        first_filled(F.col("h.aro_accession"), F.col("ARO Accession")).alias("aro_accession"), F.col("Protein Accession").alias("refseq_protein"),
        F.col("DNA Accession").alias("genbank_nucleotide"), F.col("CARD Short Name").alias("card_short_name"), F.col("CVTERM ID").alias("card_cvterm_id"),
        F.col("Model ID").alias("card_model_id"), F.col("Model Sequence ID").alias("card_model_sequence_id"),
    ))


def ncbi_records(fasta: DataFrame, report: DataFrame) -> DataFrame:
    """NCBI records with their report row: by accession as written, else without its version.

    report: line_no and the fields of the report; of several rows of an accession the last counts.
    """
    fields = ("refseqNucleotide", "refseqProtein", "genbankNucleotide", "genbankProtein")
    nucleotides = [F.col(f"{f}.accessionVersion") for f in ("refseqNucleotide", "genbankNucleotide")]
    keyed = report.select("*", F.explode(F.array_distinct(F.array(*nucleotides, *[versionless(c) for c in nucleotides]))).alias("key")).filter("key <> ''")
    meta = last_wins(keyed, "key", "line_no")
    rows = fasta.withColumn("source_acc", ncbi_accession(F.col("header"))).withColumn("bare", versionless(F.col("source_acc")))
    names = [c for c in meta.columns if c != "key"]
    exact = meta.select(F.col("key").alias("source_acc"), F.struct(*names).alias("m1"))
    bare = meta.select(F.col("key").alias("bare"), F.struct(*names).alias("m2"))
    out = rows.join(exact, "source_acc", "left").join(bare, "bare", "left").withColumn("m", F.coalesce("m1", "m2"))
    name = first_filled(F.col("m.allele"), F.col("m.geneFamily"))
    return _shaped(out.select(
        "source", "source_rank", "file", "record_no", "header", "sequence", "source_acc", name.alias("gene_name"), name.alias("allele"),
        F.col("m.productName").alias("product_name"), F.col("m.geneFamily").alias("gene_family"), F.col("m.class").alias("amr_class"),
        F.col("m.subclass").alias("amr_subclass"), F.col("m.type").alias("ncbi_type"), F.col("m.subtype").alias("ncbi_subtype"), F.col("m.scope").alias("scope"),
        *[F.col(f"m.{f}.accessionVersion").alias(n) for f, n in zip(fields, ("refseq_nucleotide", "refseq_protein", "genbank_nucleotide", "genbank_protein"))],
    ))


def resfinder_records(fasta: DataFrame, phenotypes: DataFrame, strict: bool = False) -> DataFrame:
    """ResFinder records with their phenotype row, by the whole header.

    Trailing blanks of a header are cut before it is looked up; ``strict``
    keeps them, whereupon such headers find nothing.
    """
    key = F.col("header") if strict else F.rtrim("header")
    keyed = phenotypes.withColumnRenamed("Gene_accession no.", "__header")  # a dot in a name reads as a field
    last = last_wins(keyed.filter("__header <> ''"), "__header", "line_no")
    rows = fasta.withColumn("h", resfinder_fields(F.col("header"), strict)).withColumn("__key", key)
    out = rows.join(last, F.col("__key") == F.col("__header"), "left")
    return _shaped(out.select(
        *[rows[c] for c in ("source", "source_rank", "file", "record_no", "header", "sequence")], F.col("h.source_acc").alias("source_acc"),
        F.col("h.gene_name").alias("gene_name"), F.col("h.allele").alias("allele"), F.col("h.source_acc").alias("genbank_nucleotide"),
        F.col("Class").alias("drug_class"), F.col("Mechanism of resistance").alias("resistance_mechanism"), F.col("Phenotype").alias("product_name"),
        F.col("PMID").alias("pmid"), F.col("Notes").alias("notes"), F.col("Required_gene").alias("required_gene"),
    ))


def gene_table(records: DataFrame, prefix: str = "SEQ", chars: int = 10) -> DataFrame:
    return records.withColumn("jrc_id", content_id(F.col("sequence"), prefix, chars)).withColumnRenamed("header", "original_header")


def exact_clusters(genes: DataFrame) -> DataFrame:
    """(jrc_id, sequence, original_header, source): one row per distinct sequence.

    The longest header represents it; of equals the first, in the order of
    sources and records.
    """
    return best_per_group(
        genes, ["jrc_id"], [F.length("original_header"), -F.col("source_rank"), -F.col("record_no")], ["sequence", "original_header", "source"]
    )


def cluster_ids(sequences: DataFrame, known: DataFrame | None = None, prefix: str = "CLU", chars: int = 6) -> DataFrame:
    """(cluster_id, representative_jrc) of every sequence: known clusters keep their id, new ones are numbered after the greatest.

    New ids follow the order of the sequence ids, so that they do not depend on
    the order of the records. chars: letters of a sequence id up to and with
    three of its hex digits.
    """
    keys = sequences.select(F.col("jrc_id").alias("representative_jrc")).distinct()
    fresh = keys if known is None else keys.join(known.select("representative_jrc"), "representative_jrc", "left_anti")
    new = number_rows(fresh, "representative_jrc", chars).select(padded_id(F.col("n") + last_number(known, "cluster_id"), prefix).alias("cluster_id"), "representative_jrc")
    return new if known is None else known.select("cluster_id", "representative_jrc").join(keys, "representative_jrc", "left_semi").unionByName(new)


def sequence_metadata(genes: DataFrame, order: str = "record_no") -> DataFrame:
    """Best record of each (jrc_id, source): the longest header, of equals the first."""
    carry = [c for c in DESCRIPTIVE if c in genes.columns]
    return best_per_group(genes, ["jrc_id", "source"], [F.coalesce(F.length("original_header"), F.lit(-1)), -F.col(order)], carry)


def translations(sequences: DataFrame) -> DataFrame:
    """(jrc_id, n, protein_sequence, protein_md5) of the sequences that translate; n is the length of the sequence."""
    made = sequences.select("jrc_id", F.length("sequence").alias("n"), translate(F.col("sequence")).alias("protein_sequence"))
    return made.filter("protein_sequence IS NOT NULL").withColumn("protein_md5", F.md5("protein_sequence"))


def protein_clusters(sequences: DataFrame, prefix: str = "PRT", tie: str = "max", known: DataFrame | None = None, chars: int = 6) -> tuple[DataFrame, DataFrame]:
    """(proteins, jrc_id → protein_id) of the sequences that translate.

    A protein is represented by its longest sequence; of equals by the greatest
    jrc_id, or the smallest with ``tie="min"``. Ids follow the order of the
    proteins' smallest jrc_id. known: stored proteins; these keep their id and
    are not among the proteins given back, which are numbered after them.
    """
    made = translations(sequences)
    top = F.max_by("jrc_id", F.struct("n", "jrc_id")) if tie == "max" else F.min_by("jrc_id", F.struct(-F.col("n"), F.col("jrc_id")))
    groups = made.groupBy("protein_md5").agg(
        F.first("protein_sequence").alias("protein_sequence"), F.min("jrc_id").alias("first_jrc"), top.alias("representative_jrc"), F.count("*").alias("n_variants")
    )
    fresh = groups if known is None else new_proteins(groups, known)
    proteins = number_rows(fresh, "first_jrc", chars).withColumn("protein_id", padded_id(F.col("n") + last_number(known, "protein_id"), prefix))
    proteins = proteins.select("protein_id", "protein_md5", "protein_sequence", F.length("protein_sequence").alias("protein_length"), "representative_jrc", "n_variants")
    ids = proteins.select("protein_md5", "protein_id")
    ids = ids if known is None else ids.unionByName(known.select("protein_md5", "protein_id"))
    return proteins, made.select("jrc_id", "protein_md5").join(ids, "protein_md5").select("jrc_id", "protein_id")


def new_proteins(found: DataFrame, known: DataFrame) -> DataFrame:
    """Proteins whose hash is not known yet."""
    return found.join(known.select("protein_md5"), "protein_md5", "left_anti")
