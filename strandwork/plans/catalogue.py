"""The canned queries over the catalogue, each with the SQL it must agree with.

Tables that the data do not hold are derived from those it does: metadata from
the best record per sequence and source, links and class members from the
packed class fields of NCBI rows. The SQL derives them in its own way (``VIEWS``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ancestry import first_ancestor
from ..operators.relational import join_distinct, pivot_left
from ..session import table
from .links import card_classes, ncbi_linked_classes, ncbi_listed_classes, resfinder_classes, sequence_classes, sequence_drugs
from .records import DESCRIPTIVE, protein_clusters, sequence_metadata
from .vocabulary import SOURCE_SPELLING, SPELLING, class_lookup, normalise, tokens


class Catalogue:
    """Lazy tables of one data folder."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return table(self.spark, self.sf, name)

    @cached_property
    def metadata(self) -> DataFrame:
        return sequence_metadata(self.gene, "gene_id")

    @cached_property
    def gene_drug_link(self) -> DataFrame:
        rows = self.gene.filter("source = 'NCBI' AND gene_name IS NOT NULL").select("gene_name", "amr_class", "amr_subclass")
        subs = tokens(F.col("amr_subclass"))
        drug = F.when(F.size(subs) > 0, subs).otherwise(F.array(F.lit("")))
        one = rows.withColumn("canonical_class_token", F.explode(tokens(F.col("amr_class"))))
        return one.select("gene_name", F.col("amr_class").alias("ncbi_class_raw"), "canonical_class_token", F.explode(drug).alias("canonical_drug_token"))

    @cached_property
    def member(self) -> DataFrame:
        """(canonical_drug, canonical_class) by single-class rows and the aliases of classes."""
        named = class_lookup(self.class_mapping, "ncbi_alias", "canonical_name", tokens=True)
        single = self.gene_drug_link.filter(~F.col("ncbi_class_raw").contains("/") & (F.col("canonical_drug_token") != ""))
        return single.join(named, F.col("canonical_class_token") == F.col("key")).select(F.col("canonical_drug_token").alias("canonical_drug"), "canonical_class").distinct()

    @cached_property
    def sequence_class(self) -> DataFrame:
        return sequence_classes(self.gene, self.card_gene_class, self.gene_drug_link, self.class_mapping)

    @cached_property
    def sequence_drug(self) -> DataFrame:
        return sequence_drugs(self.gene, self.gene_drug_link, self.drug_canonical)

    @cached_property
    def drug(self) -> DataFrame:
        code = F.trim("atc_code")
        return self.drug_canonical.withColumn("atc_group1", F.nullif(F.substring(code, 1, 1), F.lit(""))).withColumn("atc_group2", F.nullif(F.substring(code, 1, 3), F.lit("")))

    def one_sequence(self) -> DataFrame:
        """The sequence that the point queries ask for: the one of most classes, of equals the first."""
        n = self.sequence_class.groupBy("jrc_id").agg(F.count("*").alias("n"))
        return n.agg(F.min_by("jrc_id", F.struct(-F.col("n"), F.col("jrc_id"))).alias("jrc_id"))

    def one_class(self) -> DataFrame:
        """The class that the lookups ask for: the one of most genes, of equals the first."""
        n = self.card_gene_class.groupBy("canonical_class").agg(F.count("*").alias("n"))
        return n.agg(F.min_by("canonical_class", F.struct(-F.col("n"), F.col("canonical_class"))).alias("canonical_class"))

    def one_group(self) -> DataFrame:
        """The group of codes that the lookups ask for: the one of most drugs, of equals the first."""
        n = self.drug.filter("atc_group1 IS NOT NULL").groupBy("atc_group1").agg(F.count("*").alias("n"))
        return n.agg(F.min_by("atc_group1", F.struct(-F.col("n"), F.col("atc_group1"))).alias("atc_group1"))


VIEWS = f"""
WITH toks AS (
  SELECT gene_name, amr_class AS ncbi_class_raw, amr_subclass,
    list_filter(list_transform(string_split(coalesce(amr_class, ''), '/'), lambda x: regexp_replace(trim(lower(x), E' \\t\\n\\r'), '\\s+', ' ', 'g')), lambda x: x <> '') AS cls,
    list_filter(list_transform(string_split(coalesce(amr_subclass, ''), '/'), lambda x: regexp_replace(trim(lower(x), E' \\t\\n\\r'), '\\s+', ' ', 'g')), lambda x: x <> '') AS subs
  FROM gene WHERE source = 'NCBI' AND gene_name IS NOT NULL),
gdl AS (SELECT gene_name, ncbi_class_raw, c AS canonical_class_token, unnest(CASE WHEN len(subs) > 0 THEN subs ELSE [''] END) AS canonical_drug_token
  FROM (SELECT gene_name, ncbi_class_raw, subs, unnest(cls) AS c FROM toks)),
alias AS (SELECT key, max(canonical_class) AS canonical_class FROM (
    SELECT trim(unnest(string_split(lower(ncbi_alias), '/'))) AS key, trim(canonical_name) AS canonical_class FROM class_mapping) WHERE key <> '' GROUP BY key),
member AS (SELECT DISTINCT canonical_drug_token AS canonical_drug, canonical_class FROM gdl JOIN alias ON canonical_class_token = key
  WHERE ncbi_class_raw NOT LIKE '%/%' AND canonical_drug_token <> ''),
ev_card AS (SELECT g.jrc_id, c.canonical_class, 'CARD' AS e FROM gene g JOIN card_gene_class c ON g.aro_accession = c.aro_accession WHERE g.source = 'CARD'),
ev_ncbi_a AS (SELECT DISTINCT g.jrc_id, d.canonical_name AS canonical_class, 'NCBI' AS e FROM gene g JOIN (SELECT DISTINCT gene_name, canonical_class_token FROM gdl WHERE canonical_class_token <> '') l ON g.gene_name = l.gene_name
  JOIN class_mapping d ON l.canonical_class_token = d.canonical_name WHERE g.source = 'NCBI'),
ev_ncbi_b AS (SELECT g.jrc_id, d.canonical_name AS canonical_class, 'NCBI' AS e FROM (SELECT jrc_id, unnest(string_split(amr_class, '/')) AS token FROM gene WHERE source = 'NCBI' AND amr_class IS NOT NULL) g
  JOIN class_mapping d ON upper(trim(g.token)) = upper(d.ncbi_alias) WHERE g.token <> ''),
ev_res AS (SELECT DISTINCT g.jrc_id, d.canonical_name AS canonical_class, 'RESFINDER' AS e FROM gene g JOIN class_mapping d
  ON lower(g.drug_class) = lower(d.resfinder_alias) OR lower(g.drug_class) = lower(d.canonical_name) WHERE g.source = 'RESFINDER'),
sdc AS (SELECT jrc_id, canonical_class, string_agg(DISTINCT e, '|' ORDER BY e) AS evidence_sources FROM (
  SELECT * FROM ev_card UNION SELECT * FROM ev_ncbi_a UNION SELECT * FROM ev_ncbi_b UNION SELECT * FROM ev_res) GROUP BY 1, 2),
sd AS (SELECT DISTINCT g.jrc_id, d.canonical_name AS canonical_drug, 'NCBI' AS evidence_sources FROM gene g
  JOIN (SELECT DISTINCT gene_name, canonical_drug_token FROM gdl WHERE canonical_drug_token <> '') l ON g.gene_name = l.gene_name
  JOIN drug_canonical d ON l.canonical_drug_token = d.canonical_name WHERE g.source = 'NCBI'),
meta AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY jrc_id, source ORDER BY coalesce(length(original_header), -1) DESC, gene_id) AS rn FROM gene) WHERE rn = 1),
drug AS (SELECT *, nullif(substr(trim(atc_code), 1, 1), '') AS atc_group1, nullif(substr(trim(atc_code), 1, 3), '') AS atc_group2 FROM drug_canonical),
one_class AS (SELECT arg_min(canonical_class, {{'a': -n, 'b': canonical_class}}) AS canonical_class FROM (SELECT canonical_class, count(*) AS n FROM card_gene_class GROUP BY 1)),
one_group AS (SELECT arg_min(atc_group1, {{'a': -n, 'b': atc_group1}}) AS atc_group1 FROM (SELECT atc_group1, count(*) AS n FROM drug WHERE atc_group1 IS NOT NULL GROUP BY 1)),
one AS (SELECT arg_min(jrc_id, {{'a': -n, 'b': jrc_id}}) AS jrc_id FROM (SELECT jrc_id, count(*) AS n FROM sdc GROUP BY 1))
"""

META_COLUMNS = ", ".join(f"meta.{c}" for c in DESCRIPTIVE)
QUERIES, ORACLES = {}, {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf: f(Catalogue(spark, sf))
        ORACLES[f.__name__] = VIEWS + sql
        return f

    return put


@query("SELECT source, count(*) AS n_rows FROM gene GROUP BY source")
def q01_rows_per_source(c):
    return c.gene.groupBy("source").agg(F.count("*").alias("n_rows"))


@query("""SELECT count(DISTINCT jrc_id) AS total_sequences, count(DISTINCT jrc_id) FILTER (WHERE jrc_id IN (SELECT jrc_id FROM sdc)) AS seqs_with_class,
count(DISTINCT jrc_id) FILTER (WHERE jrc_id IN (SELECT jrc_id FROM sd)) AS seqs_with_drug FROM sequence""")
def q02_coverage(c):
    has_class = c.sequence_class.select("jrc_id").distinct().withColumn("c", F.lit(1))
    has_drug = c.sequence_drug.select("jrc_id").distinct().withColumn("d", F.lit(1))
    rows = c.sequence.select("jrc_id").distinct().join(has_class, "jrc_id", "left").join(has_drug, "jrc_id", "left")
    return rows.agg(F.count("jrc_id").alias("total_sequences"), F.count(F.when(F.col("c") == 1, F.col("jrc_id"))).alias("seqs_with_class"), F.count(F.when(F.col("d") == 1, F.col("jrc_id"))).alias("seqs_with_drug"))


@query("SELECT source, drug_class, count(*) AS n_sequences FROM meta WHERE drug_class IS NOT NULL GROUP BY source, drug_class")
def q03_classes_per_source(c):
    return c.metadata.filter("drug_class IS NOT NULL").groupBy("source", "drug_class").agg(F.count("*").alias("n_sequences")).orderBy("source", F.desc("n_sequences"), "drug_class")


@query("SELECT canonical_class, evidence_sources FROM sdc WHERE jrc_id = (SELECT jrc_id FROM one)")
def q04_classes_of_sequence(c):
    return c.sequence_class.join(F.broadcast(c.one_sequence()), "jrc_id").select("canonical_class", "evidence_sources").orderBy("canonical_class")


@query("SELECT canonical_drug, evidence_sources FROM sd WHERE jrc_id = (SELECT min(jrc_id) FROM sd)")
def q05_drugs_of_sequence(c):
    first = c.sequence_drug.agg(F.min("jrc_id").alias("jrc_id"))
    return c.sequence_drug.join(F.broadcast(first), "jrc_id").select("canonical_drug", "evidence_sources")


GENES = ["jrc_id", "gene_name", "source", "card_short_name", "gene_family", "resistance_mechanism", "evidence_sources"]


@query("""SELECT DISTINCT g.jrc_id, g.gene_name, g.source, g.card_short_name, g.gene_family, g.resistance_mechanism, sd.evidence_sources
FROM sd JOIN gene g ON g.jrc_id = sd.jrc_id WHERE sd.canonical_drug = (SELECT min(canonical_drug) FROM sd)
UNION SELECT DISTINCT g.jrc_id, g.gene_name, g.source, g.card_short_name, g.gene_family, g.resistance_mechanism, sdc.evidence_sources
FROM sdc JOIN member m ON m.canonical_class = sdc.canonical_class JOIN gene g ON g.jrc_id = sdc.jrc_id WHERE m.canonical_drug = (SELECT min(canonical_drug) FROM sd)""")
def q06_genes_for_drug(c):
    wanted = c.sequence_drug.agg(F.min("canonical_drug").alias("canonical_drug"))
    direct = c.sequence_drug.join(F.broadcast(wanted), "canonical_drug").select("jrc_id", "evidence_sources")
    classes = c.member.join(F.broadcast(wanted), "canonical_drug").select("canonical_class")
    by_class = c.sequence_class.join(classes, "canonical_class").select("jrc_id", "evidence_sources")
    # one pass over gene for both ways
    return direct.union(by_class).distinct().join(c.gene, "jrc_id").select(GENES).distinct().orderBy(F.col("gene_name").asc_nulls_last(), "source")


@query(f"SELECT meta.jrc_id, meta.source, {META_COLUMNS} FROM meta WHERE jrc_id = (SELECT jrc_id FROM one)")
def q07_metadata_of_sequence(c):
    return c.metadata.join(F.broadcast(c.one_sequence()), "jrc_id").select("jrc_id", "source", *DESCRIPTIVE)


@query("""SELECT s.jrc_id, count(DISTINCT g.source) AS n_sources, string_agg(DISTINCT g.source, '|' ORDER BY g.source) AS sources FROM sequence s JOIN gene g USING (jrc_id)
GROUP BY s.jrc_id HAVING count(DISTINCT g.source) > 1""")
def q08_shared_between_sources(c):
    rows = c.gene.select("jrc_id", "source").join(c.sequence.select("jrc_id"), "jrc_id", "left_semi")
    return rows.groupBy("jrc_id").agg(F.size(F.collect_set("source")).cast("long").alias("n_sources"), join_distinct(F.col("source"), "|").alias("sources")).filter("n_sources > 1")


@query("""SELECT p.protein_id, p.protein_sequence, c.cluster_id, c.representative_jrc, s.sequence AS representative_sequence FROM protein p
JOIN sequence s ON s.jrc_id = p.representative_jrc JOIN cluster c ON c.representative_jrc = p.representative_jrc""")
def q09_protein_clusters(c):
    s = c.sequence.select(F.col("jrc_id").alias("representative_jrc"), F.col("sequence").alias("representative_sequence"))
    rows = c.protein.select("protein_id", "protein_sequence", "representative_jrc").join(c.cluster, "representative_jrc").join(s, "representative_jrc")
    return rows.select("protein_id", "protein_sequence", "cluster_id", "representative_jrc", "representative_sequence").orderBy("protein_id")


@query("""SELECT c.cluster_id, c.representative_jrc AS jrc_id, s.sequence_length,
string_agg(DISTINCT g.gene_name, ' / ' ORDER BY g.gene_name) AS gene_names, string_agg(DISTINCT g.source, ' | ' ORDER BY g.source) AS sources,
string_agg(DISTINCT sd.canonical_drug, ', ' ORDER BY sd.canonical_drug) AS linked_drugs, string_agg(DISTINCT sdc.canonical_class, ' | ' ORDER BY sdc.canonical_class) AS drug_classes,
string_agg(DISTINCT d.atc_group1, ' | ' ORDER BY d.atc_group1) AS atc_groups1, string_agg(DISTINCT d.atc_group2, ' | ' ORDER BY d.atc_group2) AS atc_groups2, s.sequence
FROM cluster c JOIN sequence s ON s.jrc_id = c.representative_jrc LEFT JOIN gene g ON g.jrc_id = c.representative_jrc LEFT JOIN sd ON sd.jrc_id = c.representative_jrc
LEFT JOIN sdc ON sdc.jrc_id = c.representative_jrc LEFT JOIN drug d ON d.canonical_name = sd.canonical_drug GROUP BY c.cluster_id, c.representative_jrc, s.sequence_length, s.sequence""")
def q10_cluster_report(c):
    # every branch is aggregated before it is joined, so that nothing fans out
    g = c.gene.groupBy("jrc_id").agg(join_distinct(F.col("gene_name"), " / ").alias("gene_names"), join_distinct(F.col("source"), " | ").alias("sources"))
    drug = c.drug.select(F.col("canonical_name").alias("canonical_drug"), "atc_group1", "atc_group2")
    d = c.sequence_drug.join(drug, "canonical_drug", "left").groupBy("jrc_id").agg(
        join_distinct(F.col("canonical_drug"), ", ").alias("linked_drugs"), join_distinct(F.col("atc_group1"), " | ").alias("atc_groups1"), join_distinct(F.col("atc_group2"), " | ").alias("atc_groups2")
    )
    k = c.sequence_class.groupBy("jrc_id").agg(join_distinct(F.col("canonical_class"), " | ").alias("drug_classes"))
    rows = c.cluster.withColumnRenamed("representative_jrc", "jrc_id").join(c.sequence.select("jrc_id", "sequence_length", "sequence"), "jrc_id")
    rows = rows.join(g, "jrc_id", "left").join(d, "jrc_id", "left").join(k, "jrc_id", "left")
    return rows.select("cluster_id", "jrc_id", "sequence_length", "gene_names", "sources", "linked_drugs", "drug_classes", "atc_groups1", "atc_groups2", "sequence").orderBy("cluster_id")


@query(f"""SELECT DISTINCT sdc.jrc_id, g.gene_name, sdc.canonical_class, d.canonical_name AS drug, d.atc_code, sdc.evidence_sources FROM sdc JOIN gene g ON g.jrc_id = sdc.jrc_id
LEFT JOIN member m ON m.canonical_class = sdc.canonical_class LEFT JOIN drug d ON d.canonical_name = m.canonical_drug WHERE sdc.canonical_class = (SELECT canonical_class FROM one_class)
ORDER BY g.gene_name NULLS LAST, drug NULLS LAST, sdc.jrc_id, d.atc_code NULLS LAST, sdc.evidence_sources LIMIT 20""")
def q11_full_picture(c):
    wanted = F.broadcast(c.one_class())  # one row
    m = c.member.join(wanted, "canonical_class", "left_semi").join(c.drug.select(F.col("canonical_name").alias("canonical_drug"), F.col("canonical_name").alias("drug"), "atc_code"), "canonical_drug", "left").drop("canonical_drug")
    rows = c.sequence_class.join(wanted, "canonical_class", "left_semi").join(c.gene.select("jrc_id", "gene_name").distinct(), "jrc_id")
    # all rows have the same drugs, so the first 20 answers come from the first 20 rows
    first = rows.orderBy(F.col("gene_name").asc_nulls_last(), "jrc_id", "evidence_sources").limit(20).join(m, "canonical_class", "left")
    last = [F.col(x).asc_nulls_last() for x in ("gene_name", "drug", "jrc_id", "atc_code", "evidence_sources")]
    return first.select("jrc_id", "gene_name", "canonical_class", "drug", "atc_code", "evidence_sources").distinct().orderBy(*last).limit(20)


@query(f"SELECT gene_name, card_short_name, gene_family, resistance_mechanism FROM card_gene_class WHERE canonical_class = (SELECT canonical_class FROM one_class)")
def q12_genes_for_class(c):
    rows = c.card_gene_class.join(F.broadcast(c.one_class()), "canonical_class", "left_semi")
    return rows.select("gene_name", "card_short_name", "gene_family", "resistance_mechanism").orderBy(F.col("gene_family").asc_nulls_last(), F.col("gene_name").asc_nulls_last())


@query("""SELECT m.canonical_drug, d.canonical_name AS drug_class, d.aro_accession, d.category, 'ncbi' AS evidence_source FROM member m JOIN class_mapping d ON d.canonical_name = m.canonical_class
WHERE m.canonical_drug = (SELECT min(canonical_drug) FROM member)""")
def q13_classes_of_drug(c):
    first = c.member.agg(F.min("canonical_drug").alias("canonical_drug"))
    named = c.class_mapping.select(F.col("canonical_name").alias("canonical_class"), "aro_accession", "category")
    return c.member.join(F.broadcast(first), "canonical_drug").join(named, "canonical_class").select("canonical_drug", F.col("canonical_class").alias("drug_class"), "aro_accession", "category", F.lit("ncbi").alias("evidence_source"))


@query(f"SELECT d.canonical_name, d.atc_code, d.pubchem_cid, d.inchikey, d.chebi_id FROM drug d JOIN member m ON m.canonical_drug = d.canonical_name WHERE m.canonical_class = (SELECT canonical_class FROM one_class)")
def q14_drugs_in_class(c):
    m = c.member.join(F.broadcast(c.one_class()), "canonical_class", "left_semi").select(F.col("canonical_drug").alias("canonical_name"))
    return c.drug.join(m, "canonical_name").select("canonical_name", "atc_code", "pubchem_cid", "inchikey", "chebi_id").orderBy("canonical_name")


@query(f"SELECT canonical_name, atc_code, atc_group1, atc_group2, pubchem_cid, inchikey, chebi_id FROM drug WHERE atc_group1 = (SELECT atc_group1 FROM one_group)")
def q15_drugs_in_group(c):
    rows = c.drug.join(F.broadcast(c.one_group()), "atc_group1", "left_semi")
    return rows.select("canonical_name", "atc_code", "atc_group1", "atc_group2", "pubchem_cid", "inchikey", "chebi_id").orderBy("atc_group2", "canonical_name")


@query("""SELECT count(*) AS total_proteins, cast(sum(n) AS BIGINT) AS sequences_with_protein, cast(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS sequences_in_synonymous_group, max(n) AS max_synonymous_variants
FROM (SELECT p.protein_id, count(s.jrc_id) AS n FROM protein p JOIN sequence s USING (protein_id) GROUP BY 1)""")
def q16_protein_summary(c):
    n = c.sequence.join(c.protein.select("protein_id"), "protein_id").groupBy("protein_id").agg(F.count("jrc_id").alias("n"))
    return n.agg(F.count("*").alias("total_proteins"), F.sum("n").alias("sequences_with_protein"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("sequences_in_synonymous_group"), F.max("n").alias("max_synonymous_variants"))


@query("""SELECT s.jrc_id, s.sequence_length, p.protein_id, p.protein_length FROM sequence s JOIN protein p ON p.protein_id = s.protein_id
WHERE p.protein_id = (SELECT arg_min(protein_id, {'a': -n, 'b': protein_id}) FROM (SELECT protein_id, count(*) AS n FROM sequence WHERE protein_id IN (SELECT protein_id FROM protein) GROUP BY 1))""")
def q17_same_protein(c):
    p = c.protein.select("protein_id", "protein_length")
    n = c.sequence.join(p, "protein_id", "left_semi").groupBy("protein_id").agg(F.count("*").alias("n"))
    most = n.agg(F.min_by("protein_id", F.struct(-F.col("n"), F.col("protein_id"))).alias("protein_id"))
    return c.sequence.join(F.broadcast(most), "protein_id").join(p, "protein_id").select("jrc_id", "sequence_length", "protein_id", "protein_length").orderBy(F.desc("sequence_length"), "jrc_id")


@query("SELECT count(*) AS n_sequences FROM sequence WHERE protein_id IS NULL")
def q18_without_protein(c):
    return c.sequence.filter("protein_id IS NULL").agg(F.count("*").alias("n_sequences"))


EXPORT = ("RESFINDER", "CARD", "NCBI")
PIVOT = ", ".join(f"{s.lower()}.gene_name AS gene_name_{s.lower()}" for s in EXPORT)
PIVOT_JOIN = " ".join(f"LEFT JOIN meta {s.lower()} ON {s.lower()}.jrc_id = c.representative_jrc AND {s.lower()}.source = '{s}'" for s in EXPORT)


@query(f"""SELECT c.cluster_id, c.representative_jrc, s.sequence AS representative_sequence, p.protein_id, p.protein_sequence, {PIVOT} FROM cluster c
JOIN sequence s ON s.jrc_id = c.representative_jrc LEFT JOIN protein p ON p.protein_id = s.protein_id {PIVOT_JOIN}""")
def x01_gene_clusters(c):
    s = c.sequence.select(F.col("jrc_id").alias("representative_jrc"), F.col("sequence").alias("representative_sequence"), "protein_id")
    p = c.protein.select(F.col("protein_id").alias("own"), "protein_id", "protein_sequence")
    rows = c.cluster.join(s.withColumnRenamed("protein_id", "own"), "representative_jrc").join(p, "own", "left").drop("own")
    facts = c.metadata.select(F.col("jrc_id").alias("representative_jrc"), "source", "gene_name")
    return pivot_left(rows, facts, "representative_jrc", "source", "gene_name", EXPORT, "gene_name_").orderBy("cluster_id")


@query(f"""SELECT p.protein_id, p.protein_sequence, c.cluster_id, c.representative_jrc, s.sequence AS representative_sequence, {PIVOT} FROM protein p
JOIN sequence s ON s.jrc_id = p.representative_jrc JOIN cluster c ON c.representative_jrc = p.representative_jrc {PIVOT_JOIN}""")
def x02_protein_clusters(c):
    facts = c.metadata.select(F.col("jrc_id").alias("representative_jrc"), "source", "gene_name")
    return pivot_left(q09_protein_clusters(c), facts, "representative_jrc", "source", "gene_name", EXPORT, "gene_name_").orderBy("protein_id")


@query("SELECT DISTINCT * FROM ev_card")
def l1_card_classes(c):
    return card_classes(c.gene, c.card_gene_class).withColumnRenamed("evidence_source", "e").distinct()


@query("SELECT DISTINCT * FROM ev_ncbi_a")
def l2_ncbi_linked_classes(c):
    return ncbi_linked_classes(c.gene, c.gene_drug_link, c.class_mapping).withColumnRenamed("evidence_source", "e").distinct()


@query("SELECT DISTINCT * FROM ev_ncbi_b")
def l3_ncbi_listed_classes(c):
    return ncbi_listed_classes(c.gene, c.class_mapping).withColumnRenamed("evidence_source", "e").distinct()


@query("SELECT DISTINCT * FROM ev_res")
def l4_resfinder_classes(c):
    return resfinder_classes(c.gene, c.class_mapping).withColumnRenamed("evidence_source", "e").distinct()


@query("SELECT * FROM sdc")
def l5_sequence_classes(c):
    return c.sequence_class


@query("SELECT * FROM sd")
def l6_sequence_drugs(c):
    return c.sequence_drug


@query(f"SELECT meta.jrc_id, meta.source, {META_COLUMNS} FROM meta")
def sequence_metadata_best(c):
    return c.metadata.select("jrc_id", "source", *DESCRIPTIVE)


CODON_SQL = """, cut AS (SELECT jrc_id, upper(CASE WHEN right(upper(sequence), 3) IN ('TAA', 'TAG', 'TGA') THEN left(sequence, length(sequence) - 3) ELSE sequence END) AS s, length(sequence) AS n FROM sequence),
codons AS (SELECT jrc_id, n, list_transform(range(1, length(s) + 1, 3), lambda i: substr(s, i, 3)) AS cs FROM cut WHERE length(s) > 0 AND length(s) % 3 = 0 AND NOT regexp_matches(s, '[^ACGT]')),
amino AS (SELECT jrc_id, n, list_transform(cs, lambda x: substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG',
  CAST((instr('TCAG', substr(x, 1, 1)) - 1) * 16 + (instr('TCAG', substr(x, 2, 1)) - 1) * 4 + instr('TCAG', substr(x, 3, 1)) AS INTEGER), 1)) AS a, cs[1] AS first FROM codons),
made AS (SELECT jrc_id, n, CASE WHEN first IN ('GTG', 'TTG', 'CTG', 'ATT', 'ATC', 'ATA') THEN 'M' ELSE a[1] END || array_to_string(a[2:], '') AS protein_sequence FROM amino WHERE NOT list_contains(a, '*'))
SELECT md5(protein_sequence) AS protein_md5, length(protein_sequence) AS protein_length, arg_max(jrc_id, {'a': n, 'b': jrc_id}) AS representative_jrc, count(*) AS n_variants FROM made GROUP BY protein_sequence"""


@query(CODON_SQL)
def protein_translation_clusters(c):
    return protein_clusters(c.sequence)[0].select("protein_md5", F.col("protein_length").cast("long").alias("protein_length"), "representative_jrc", "n_variants")


def _case(column: str, names: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + f" ELSE {column} END"


@query(f""", n AS (SELECT regexp_replace(trim(lower(canonical_name), E' \\t\\n\\r'), '\\s+', ' ', 'g') AS name FROM drug_canonical), a AS (SELECT {_case('name', SPELLING)} AS name FROM n),
b AS (SELECT {_case('name', SOURCE_SPELLING)} AS name FROM a) SELECT name, count(*) AS n_rows FROM b GROUP BY name""")
def normalised_names(c):
    return c.drug_canonical.select(normalise(F.col("canonical_name")).alias("name")).groupBy("name").agg(F.count("*").alias("n_rows"))


ARO = "CASE WHEN regexp_extract({0}, '[0-9]+') <> '' THEN 'ARO:' || regexp_extract({0}, '[0-9]+') END"


@query(f""", e AS (SELECT id, parent, row_number() OVER (PARTITION BY id ORDER BY parent) - 1 AS o FROM (SELECT DISTINCT id, {ARO.format('is_a')} AS parent FROM aro_term) WHERE parent IS NOT NULL),
h AS (SELECT min(canonical_name) AS hit, {ARO.format('aro_accession')} AS node FROM class_mapping GROUP BY 2 HAVING node IS NOT NULL),
seed AS (SELECT DISTINCT id FROM aro_term WHERE id NOT IN (SELECT node FROM h)),
w AS (WITH RECURSIVE r AS (SELECT e.id, e.parent AS at, [o] AS path, [e.id, e.parent] AS seen, 0 AS d FROM e JOIN seed USING (id) WHERE e.parent <> e.id
  UNION ALL SELECT r.id, e.parent, list_append(path, o), list_append(seen, e.parent), d + 1 FROM r JOIN e ON e.id = r.at WHERE d < 8 AND NOT list_contains(seen, e.parent) AND r.at NOT IN (SELECT node FROM h)) SELECT * FROM r)
SELECT w.id, arg_min(h.hit, w.path) AS hit FROM w JOIN h ON h.node = w.at GROUP BY w.id""")
def term_classes(c):
    """The class above each term, in depth-first order over terms with several parents and circles."""
    key = lambda x: F.when(F.regexp_extract(x, "[0-9]+", 0) != "", F.concat(F.lit("ARO:"), F.regexp_extract(x, "[0-9]+", 0)))
    parents = c.aro_term.select("id", key("is_a").alias("parent")).filter("parent IS NOT NULL").groupBy("id").agg(F.array_sort(F.collect_set("parent")).alias("p"))
    edges = parents.select("id", F.posexplode("p").alias("ordinal", "parent"))
    hits = c.class_mapping.select(key("aro_accession").alias("node"), "canonical_name").filter("node IS NOT NULL").groupBy("node").agg(F.min("canonical_name").alias("hit"))
    seeds = c.aro_term.select("id").distinct().join(hits.select(F.col("node").alias("id")), "id", "left_anti")
    return first_ancestor(seeds, edges, hits)
