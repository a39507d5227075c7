"""Whole runs: ingest, vocabulary, proteins, links and exports, as tables under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import assign_numbers, last_number
from ..operators.merge import update_column, violations
from ..operators.relational import union_all
from ..sources import read_fasta_sources, read_json_lines, read_padded, read_quoted, read_raw, write_export
from ..sources.lines import files_of
from ..sources.tables import REPORT
from .links import sequence_classes, sequence_drugs
from .records import card_records, cluster_ids, exact_clusters, gene_table, ncbi_records, protein_clusters, resfinder_records, sequence_metadata, translations
from .store import Store
from .vocabulary import LOADS, vocabulary_rows

SOURCE_CHECK = {"source": ("CARD", "NCBI", "RESFINDER")}
ID_PREFIX, ID_CHARS = "SEQ", 10


def ingest(spark: SparkSession, fasta: dict[str, str], card_index: str | None = None, ncbi_report: str | None = None, phenotypes: str | None = None, prefix: str = ID_PREFIX, chars: int = ID_CHARS) -> dict[str, DataFrame]:
    """Lazy tables gene, sequence and sequence_metadata of FASTA files and their side files; files that are not there give nothing.

    They carry no surrogate ids: ``store_ingest`` gives these, as they continue
    after the stored ones. chars: hex digits of a sequence id; ten are enough
    for a million sequences, large collections take more.
    """
    raw = read_fasta_sources(spark, fasta)
    index_names = ("DNA Accession", "Protein Accession", "ARO Accession", "ARO Name", "Model Name", "CARD Short Name", "CVTERM ID", "Model ID", "Model Sequence ID", "AMR Gene Family", "Resistance Mechanism", "Drug Class")
    none = lambda names: spark.createDataFrame([], ", ".join(["line_no long", *[f"`{n}` string" for n in names]]))
    index = read_raw(spark, card_index) if card_index else none(index_names)
    phenotype = read_padded(spark, phenotypes) if phenotypes else none(("Gene_accession no.", "Class", "Phenotype", "PMID", "Mechanism of resistance", "Notes", "Required_gene"))
    report = read_json_lines(spark, ncbi_report) if ncbi_report else spark.createDataFrame([], f"line_no long, {REPORT}")
    records = union_all(
        card_records(raw.filter("source = 'CARD'"), index), ncbi_records(raw.filter("source = 'NCBI'"), report), resfinder_records(raw.filter("source = 'RESFINDER'"), phenotype)
    )
    gene = gene_table(records, prefix, chars)
    sequence = exact_clusters(gene).select("jrc_id", F.md5("sequence").alias("sequence_md5"), "sequence", F.length("sequence").alias("sequence_length"))
    return {"gene": gene.drop("sequence"), "sequence": sequence, "sequence_metadata": sequence_metadata(gene.withColumn("place", F.col("record_no")), "place")}


def store_ingest(store: Store, tables: dict[str, DataFrame], prefix: str = ID_PREFIX) -> None:
    """Sequences and clusters are only added, metadata replaced, genes replaced by source, all in one transaction.

    Ids of known sequences, clusters and gene records stay, and so does their
    loaded_at; new ones are numbered after the greatest. A second run of the
    same load changes nothing. A gene record is known by its source, place,
    header and sequence.
    """
    now = F.current_timestamp()
    with store.transaction():
        store.merge("sequence", tables["sequence"].withColumn("loaded_at", now), ["jrc_id"], replace=False)
        cluster = store.merge("cluster", cluster_ids(tables["sequence"], store.read("cluster"), chars=len(prefix) + 3), ["representative_jrc"], replace=False)
        store.merge("sequence_metadata", tables["sequence_metadata"], ["jrc_id", "source"], replace=True)
        key = F.md5(F.concat_ws("\u0001", "source", F.col("record_no").cast("string"), "original_header", "jrc_id"))
        new = tables["gene"].join(cluster.select(F.col("representative_jrc").alias("jrc_id"), "cluster_id"), "jrc_id").withColumn("__key", key)
        old = store.read("gene")
        known = None if old is None else old.select(key.alias("__key"), "gene_id", "loaded_at")
        ids = assign_numbers(new, "__key", known, last_number(old, "gene_id"), name="gene_id")
        new = new.join(ids, "__key")
        if old is None:
            store.put("gene", new.drop("__key").withColumn("loaded_at", now))
            return
        seen = known.select("__key", F.col("loaded_at").alias("__at"))
        new = new.join(seen, "__key", "left").withColumn("loaded_at", F.coalesce("__at", now)).drop("__key", "__at")
        store.put("gene", union_all(old.join(new.select("source").distinct(), "source", "left_anti").select(*old.columns), new))


def store_proteins(store: Store) -> None:
    """Translates the sequences without a protein; stored proteins are found by their hash and keep their id."""
    sequence, known = store.read("sequence"), store.read("protein")
    base = sequence if "protein_id" in sequence.columns else sequence.withColumn("protein_id", F.lit(None).cast("string"))
    todo = base.filter("protein_id IS NULL")
    with store.transaction():
        found = protein_clusters(todo, known=known)[0].drop("n_variants").withColumn("loaded_at", F.current_timestamp())
        stored = store.put("protein", found if known is None else union_all(known, found))
        members = translations(todo).select("jrc_id", "protein_md5").join(stored.select("protein_md5", "protein_id"), "protein_md5")
        store.put("sequence", update_column(base, members, "jrc_id", "protein_id"))


def store_links(store: Store) -> None:
    """Builds both link tables anew."""
    gene, classes = store.read("gene"), store.read("drug_class")
    links, drugs = store.read("gene_drug_link"), store.read("drug")
    with store.transaction():
        store.put("sequence_drug_class", sequence_classes(gene, store.read("card_gene_class"), links, classes))
        store.put("sequence_drug", sequence_drugs(gene, links, drugs))


def load_vocabulary(store: Store, files: dict[str, str], append_links: bool = False, links: bool = True) -> None:
    """Loads the vocabulary tables that files names (``plans.vocabulary.LOADS``) in one transaction, then the links of sequences.

    Missing files leave their table as it is. Rows are upserted by key, aliases
    only added; gene links have no key: they are replaced, or with
    ``append_links`` added to. Links of sequences are built anew if there are
    genes, unless ``links`` is off.
    """
    with store.transaction():
        for name, rule in LOADS.items():
            if name not in files or not files_of(store.spark, files[name]):
                continue
            rows = vocabulary_rows(read_quoted(store.spark, files[name], place="line_no"), rule)
            if rule.keys:
                store.merge(name, rows, rule.keys, replace=rule.replace, ordinal=None)
            elif append_links:
                store.append(name, rows)
            else:
                store.put(name, rows)
        if links and store.read("gene") is not None and all(store.read(n) is not None for n in ("drug_class", "drug", "card_gene_class", "gene_drug_link")):
            store_links(store)


def run_summary(store: Store) -> DataFrame:
    """(table_name, n_rows) of all stored tables."""
    return union_all(*[store.read(n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in store.names()])


def validate(store: Store) -> DataFrame:
    """Broken constraints of the stored tables."""
    sequence, gene, cluster = store.read("sequence"), store.read("gene"), store.read("cluster")
    found = [
        violations(sequence, "sequence", [["jrc_id"], ["sequence_md5"]], ["sequence"]),
        violations(gene, "gene", [["gene_id"]], parents={"jrc_id": (sequence, "jrc_id"), "cluster_id": (cluster, "cluster_id")}, allowed=SOURCE_CHECK),
        violations(cluster, "cluster", [["cluster_id"], ["representative_jrc"]], parents={"representative_jrc": (sequence, "jrc_id")}),
    ]
    protein = store.read("protein")
    if protein is not None:
        found.append(violations(protein, "protein", [["protein_id"], ["protein_md5"]], ["protein_sequence"], parents={"representative_jrc": (sequence, "jrc_id")}))
        found.append(violations(sequence, "sequence", parents={"protein_id": (protein, "protein_id")}))
    return union_all(*found)


def export(df: DataFrame, path: str, kind: str = "gene") -> None:
    """Tab-separated export; a missing value reads NULL for genes and is empty for proteins."""
    write_export(df, path, "NULL" if kind == "gene" else "")
