"""The core's queries for orphans, hierarchies, packed fields and bad rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ontology_key, protein_key
from ..operators.badrows import bad_headers, good_rows, parse_records
from ..operators.hierarchy import Hierarchy
from ..operators.multivalue import explode_packed
from ..operators.orphans import Link, orphan_references, orphan_report
from ..session import table


def catalogue_links(spark: SparkSession, sf: str) -> list[Link]:
    gene, cgc, term, seq, prot = (table(spark, sf, t) for t in ("gene", "card_gene_class", "aro_term", "sequence", "protein"))
    aro, at = ontology_key(F.col("aro_accession")), F.col("loaded_at")
    class_key = F.concat(F.coalesce("aro_accession", F.lit("")), F.lit("|"), F.coalesce("canonical_class", F.lit("")))
    return [
        Link("gene", gene, F.col("gene_id"), aro, at, cgc, aro, at),
        Link("card_gene_class", cgc, class_key, aro, at, term, ontology_key(F.col("id")), at, F.col("is_obsolete")),
        Link("sequence", seq, F.col("jrc_id"), protein_key(F.col("protein_id")), at, prot, protein_key(F.col("protein_id")), at),
    ]


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_references(catalogue_links(spark, sf)).select("ref_table", "row_key").distinct()


def p1_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_report(catalogue_links(spark, sf))


def term_hierarchy(spark: SparkSession, sf: str) -> Hierarchy:
    """Terms and their links to parents that are in the table, compared by digits."""
    rows = table(spark, sf, "aro_term").select("id", ontology_key(F.col("id")).alias("key"), ontology_key(F.col("is_a")).alias("up"))
    terms = rows.filter("id IS NOT NULL").select("id", "key").distinct()
    edges = rows.filter("up IS NOT NULL").select("id", "up").distinct()
    parents = terms.select(F.col("id").alias("parent"), F.col("key").alias("up"))
    return Hierarchy(terms, edges.join(parents, "up").select("id", "parent"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    tree = term_hierarchy(spark, sf)
    return tree.reach().unionByName(tree.circles().select("id", F.lit("CYCLE").alias("root_id")))


def p2_paths(spark: SparkSession, sf: str) -> DataFrame:
    return term_hierarchy(spark, sf).paths()


def p2_descendants(spark: SparkSession, sf: str) -> DataFrame:
    return term_hierarchy(spark, sf).ancestors().select(
        F.col("ancestor_id").alias("id"), F.col("id").alias("descendant_id"), "distance"
    )


def p2_terms(spark: SparkSession, sf: str) -> DataFrame:
    return term_hierarchy(spark, sf).summary()


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    genes = explode_packed(table(spark, sf, "gene"), "gene", "gene_id", ["amr_class", "amr_subclass"])
    drugs = explode_packed(table(spark, sf, "drug_canonical"), "drug_canonical", "canonical_name", ["atc_code", "components"])
    # keys are unique in both tables, positions within a field: rows are distinct as they come
    return genes.unionByName(drugs)


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    raw = parse_records(table(spark, sf, "raw_record")).filter("reason IS NOT NULL").select(F.lit("raw_record").alias("table_name"), F.col("raw_id").alias("row_key"), "reason")
    gene = bad_headers(table(spark, sf, "gene")).select(F.lit("gene").alias("table_name"), F.col("gene_id").alias("row_key"), "reason")
    return raw.unionByName(gene)


def p7_loaded(spark: SparkSession, sf: str) -> DataFrame:
    return parse_records(table(spark, sf, "raw_record")).filter("reason IS NULL").drop("reason", "raw_line")


def p7_genes(spark: SparkSession, sf: str) -> DataFrame:
    """The gene rows that load; all others are in p7_found."""
    return good_rows(table(spark, sf, "gene")).withColumn("loaded_us", F.unix_micros(F.col("loaded_at").cast("timestamp"))).drop("loaded_at")


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p2_found, p2_paths, p2_descendants, p2_terms, p4_found, p7_found, p7_loaded, p7_genes)}
VOID = "('', 'na', 'n/a', 'n.a.', 'none', 'null', 'nan', 'nil', 'unknown', 'not available', 'not applicable')"


def _void(c: str) -> str:
    t = f"lower(regexp_replace({c}, '^\\s+|\\s+$', '', 'g'))"
    return f"({c} IS NULL OR {t} IN {VOID} OR regexp_full_match({t}, '[^\\p{{L}}\\p{{N}}]*'))"


def _aro(c: str) -> str:
    return f"(CASE WHEN {_void(c)} THEN NULL ELSE regexp_extract({c}, '[0-9]+') END)"


def _protein(c: str) -> str:
    return f"(CASE WHEN {_void(c)} THEN NULL ELSE upper(regexp_replace({c}, '^\\s+|\\s+$', '', 'g')) END)"


P1 = f"""WITH pg AS (SELECT {_aro('aro_accession')} k, min(loaded_at) f FROM card_gene_class GROUP BY 1),
pt AS (SELECT {_aro('id')} k, min(loaded_at) f, bool_or(is_obsolete) o FROM aro_term GROUP BY 1),
pp AS (SELECT {_protein('protein_id')} k, min(loaded_at) f FROM protein GROUP BY 1),
orphans AS (
SELECT 'gene' AS ref_table, gene_id::VARCHAR AS row_key, loaded_at, CASE WHEN pg.k IS NULL THEN 'missing' ELSE 'later' END AS reason
  FROM (SELECT *, {_aro('aro_accession')} k FROM gene) g LEFT JOIN pg USING (k) WHERE g.k IS NOT NULL AND (pg.k IS NULL OR f > loaded_at)
UNION ALL SELECT 'card_gene_class', aro_accession || '|' || canonical_class, loaded_at, CASE WHEN pt.k IS NULL THEN 'missing' WHEN o THEN 'withdrawn' ELSE 'later' END
  FROM (SELECT *, {_aro('aro_accession')} k FROM card_gene_class) g LEFT JOIN pt USING (k) WHERE g.k IS NOT NULL AND (pt.k IS NULL OR o OR f > loaded_at)
UNION ALL SELECT 'sequence', jrc_id, loaded_at, CASE WHEN pp.k IS NULL THEN 'missing' ELSE 'later' END
  FROM (SELECT *, {_protein('protein_id')} k FROM sequence) g LEFT JOIN pp USING (k) WHERE g.k IS NOT NULL AND (pp.k IS NULL OR f > loaded_at))
"""
P2 = f"""WITH RECURSIVE node AS (SELECT DISTINCT id, {_aro('id')} k FROM aro_term),
edge AS (SELECT DISTINCT a.id, n.id AS parent FROM aro_term a JOIN node n ON n.k = {_aro('a.is_a')}),
up AS (SELECT id, parent FROM edge UNION SELECT up.id, edge.parent FROM up JOIN edge ON edge.id = up.parent),
root AS (SELECT id FROM node WHERE id NOT IN (SELECT id FROM edge))
"""
ITEM = r"""[ \t]*"(?:[^"]|"")*"|(?:[0-9]+(?:,[0-9]+)+-|[^;,/|&+\n\r])+"""


def _values(table: str, key: str, field: str) -> str:
    return f"""SELECT '{table}' AS table_name, {key}::VARCHAR AS row_key, '{field}' AS field_name, generate_subscripts(items, 1)::INTEGER AS pos, unnest(items) AS item FROM (
  SELECT {key}, list_filter(list_transform(regexp_extract_all({field}, '{ITEM}'),
    lambda x: trim(replace(regexp_replace(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), '^"(.*)"$', '\\1', 's'), '""', '"'))), lambda x: NOT {_void('x')}) AS items
  FROM {table} WHERE NOT {_void(field)}) WHERE len(items) >= 2"""


FIELD = '("(?:[^"]|"")*"|[^"\\t][^\\t]*|)'
ACC = "([A-Z]{1,6}|[A-Z]{2}_[A-Z]{0,6})[0-9]{5,9}(\\.[0-9]+)?"
WHOLE = "^" + "\\t".join([FIELD] * 6) + "$"
SIX = ", ".join(f"regexp_extract(l, '{WHOLE}', {i})" for i in range(1, 7))
P7 = f"""WITH r AS (SELECT raw_id, coalesce(raw_line, '') AS l FROM raw_record),
f AS (SELECT raw_id, l, regexp_full_match(l, '{FIELD}(\\t{FIELD})*') AS closed, regexp_full_match(l, '{FIELD}(\\t{FIELD}){{5}}') AS six,
  list_transform(range(1, 7), lambda i: 0) AS z FROM r),
v AS (SELECT raw_id, closed, six, list_transform([{SIX}],
  lambda x: CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END) AS p FROM f),
raw AS (SELECT raw_id, CASE WHEN NOT closed THEN 'quoting' WHEN NOT six THEN 'columns'
  WHEN p[1] NOT IN ('CARD', 'NCBI', 'RESFINDER') OR NOT (p[3] = '' OR regexp_full_match(p[3], '{ACC}')) OR NOT regexp_full_match(p[5], '0*[1-9][0-9]*')
    OR NOT regexp_full_match(p[6], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') OR try_cast(p[6] AS DATE) IS NULL THEN 'value' END AS reason FROM v),
g AS (SELECT gene_id, source, source_acc, regexp_replace(original_header, '^\\s+|\\s+$', '', 'g') AS h FROM gene),
u AS (SELECT gene_id, source, source_acc, h, h LIKE '"%' AND NOT regexp_full_match(h, '"(?:[^"]|"")*"') AS open,
  CASE WHEN h LIKE '"%' THEN trim(replace(h[2:-2], '""', '"')) ELSE h END AS t FROM g),
w AS (SELECT *, string_split(t, '|') AS bar, string_split(t, ' ')[1] AS word,
  string_split(regexp_replace(t, '_([A-Z]{{2}})_([^_]*)$', '_\\1~\\2'), '_') AS us FROM u),
gene_bad AS (SELECT gene_id, CASE WHEN open THEN 'quoting'
  WHEN source = 'CARD' AND len(bar) <> 6 OR source = 'NCBI' AND NOT contains(word, ':') OR source = 'RESFINDER' AND len(us) <> 3 THEN 'columns'
  WHEN source = 'CARD' AND NOT regexp_full_match(t, 'gb\\|{ACC}\\|[+-]\\|[0-9]+-[0-9]+\\|ARO:[0-9]+\\|.*\\S.*')
    OR source = 'NCBI' AND NOT regexp_full_match(t, '{ACC}:c?[0-9]+-[0-9]+ .*\\S.*')
    OR source = 'RESFINDER' AND NOT (us[1] <> '' AND regexp_full_match(us[2], '[0-9]+') AND regexp_full_match(replace(us[3], '~', '_'), '{ACC}'))
    OR NOT {_void('source_acc')} AND NOT regexp_full_match(regexp_replace(source_acc, '^\\s+|\\s+$', '', 'g'), '{ACC}') THEN 'value' END AS reason FROM w)
"""
P7_FOUND = """SELECT 'raw_record' AS table_name, raw_id AS row_key, reason FROM raw WHERE reason IS NOT NULL
UNION ALL SELECT 'gene', gene_id, reason FROM gene_bad WHERE reason IS NOT NULL"""

ORACLES = {
    "p1_found": P1 + "SELECT DISTINCT ref_table, row_key FROM orphans",
    "p1_report": P1 + "SELECT ref_table, strftime(loaded_at AT TIME ZONE 'UTC', '%Y-%m') AS period, reason, count(*) AS n_rows FROM orphans GROUP BY ALL",
    "p2_found": P2 + "SELECT up.id, root.id AS root_id FROM up JOIN root ON root.id = up.parent UNION SELECT id, id FROM root UNION SELECT id, 'CYCLE' FROM up WHERE id = parent",
    "p4_found": " UNION ALL ".join(_values(t, k, f) for t, k, f in (("gene", "gene_id", "amr_class"), ("gene", "gene_id", "amr_subclass"), ("drug_canonical", "canonical_name", "atc_code"), ("drug_canonical", "canonical_name", "components"))),
    "p7_found": P7 + P7_FOUND,
    "p7_genes": P7 + "SELECT gene.* EXCLUDE (loaded_at), epoch_us(loaded_at) AS loaded_us FROM gene JOIN gene_bad USING (gene_id) WHERE reason IS NULL",
}
