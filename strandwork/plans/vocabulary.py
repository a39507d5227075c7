"""Drugs, their aliases and their membership of classes, from several sources."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, default_if_blank, first_filled, normalise_name, split_literal, strip
from ..operators.ancestry import MAX_DEPTH, first_ancestor
from ..operators.relational import join_distinct, keep_first, last_wins, union_all

# Spellings that the sources use for one name, first and second pass.
SPELLING = {
    "amoxycillin": "amoxicillin", "sulphamethoxazole": "sulfamethoxazole", "cephuroxime": "cefuroxime",
    "rifampin": "rifampicin", "para-aminosalicyclic acid": "para-aminosalicylic acid",
}
SOURCE_SPELLING = {"hyrgomycin b": "hygromycin b", "kasugamicin": "kasugamycin", "rifampin": "rifampicin", "methicillin": "meticillin"}
# Names with a context of their own, in the order in which contexts apply.
CONTEXTS = {
    "research_tool": ("g418",),
    "non_therapeutic": ("bleomycin",),
    "inhibitor": ("clavulanic acid", "tazobactam", "avibactam", "sulbactam", "taniborbactam", "xeruborbactam", "relebactam"),
    "biocide": ("triclosan", "quaternary ammonium"),
    "veterinary": (
        "narasin", "salinomycin", "maduramicin", "tylosin", "tiamulin", "avilamycin", "thiostrepton", "virginiamycin",
        "virginiamycin m", "virginiamycin s", "pristinamycin ia", "pristinamycin iia", "ostreogrycin", "carbomycin",
    ),
    "antituberculosis": (
        "isoniazid", "pyrazinamide", "ethambutol", "rifampicin", "ethionamide", "prothionamide", "para-aminosalicylic acid",
        "delamanid", "bedaquiline", "capreomycin", "viomycin", "clofazimine", "cycloserine", "d-cycloserine",
    ),
}
# Entries of the short name list that are classes.
CLASS_MOLECULES = ("aminoglycosides", "beta-lactams", "fluoroquinolones", "macrolides", "sulfonamides", "aminocoumarin", "multiple antibiotics")


def normalise(c: Column) -> Column:
    return normalise_name(c, SPELLING, SOURCE_SPELLING)


def context_of(name: Column) -> Column:
    out = None
    for context, names in CONTEXTS.items():
        test = name.isin(*names)
        out = F.when(test, context) if out is None else out.when(test, context)
    return out.otherwise("clinical")


def class_lookup(mapping: DataFrame, alias: str, ordinal: str = "line_no", tokens: bool = False) -> DataFrame:
    """(key, canonical_class) of an alias column in lower case; of several classes of an alias the last counts."""
    parts = split_literal(F.lower(F.col(alias)), "/") if tokens else F.array(F.lower(F.col(alias)))
    rows = mapping.select(F.col(ordinal), F.trim("canonical_name").alias("canonical_class"), F.explode(parts).alias("key"))
    return last_wins(rows.withColumn("key", strip(F.col("key"))).filter("key <> ''"), "key", ordinal).select("key", "canonical_class")


def resfinder_drugs(classes: DataFrame) -> DataFrame:
    """Drugs of the ragged class list: each entry, then the components of a combination (by ``+``)."""
    whole = classes.withColumn("is_combination", F.col("drug").contains("+")).withColumn("canonical_name", normalise(F.col("drug")))
    parts = F.when(F.col("is_combination"), F.transform(split_literal(F.col("drug"), "+"), normalise)).otherwise(F.array().cast("array<string>"))
    whole = whole.withColumn("components", parts)
    base = whole.select("line_no", "place", F.lit(0).alias("part"), "canonical_name", F.col("drug").alias("source_name"), "class_raw", "is_combination", "components")
    pieces = whole.filter("is_combination").select("line_no", "place", F.posexplode("components").alias("part", "canonical_name"), "class_raw")
    pieces = pieces.select(
        "line_no", "place", (F.col("part") + 1).alias("part"), "canonical_name", F.col("canonical_name").alias("source_name"), "class_raw",
        F.lit(False).alias("is_combination"), F.array().cast("array<string>").alias("components"),
    )
    out = base.unionByName(pieces).withColumn("context", F.when(F.col("is_combination"), "clinical").otherwise(context_of(F.col("canonical_name"))))
    return out.withColumn("source", F.lit("resfinder")).withColumn("ordinal", F.struct("line_no", "place", "part"))


def card_drugs(names: DataFrame, class_abbreviations: DataFrame) -> DataFrame:
    """Drugs of the short name list; the first entry of an abbreviation counts, even if it is then left out as a class."""
    first = keep_first(names.select("line_no", strip(F.col("AAC Abbreviation")).alias("card_abbrev"), strip(F.col("Molecule")).alias("molecule")), ["card_abbrev"], "line_no")
    drugs = first.join(class_abbreviations, "card_abbrev", "left_anti").withColumn("canonical_name", normalise(F.col("molecule")))
    drugs = drugs.filter(~F.col("canonical_name").isin(*CLASS_MOLECULES)).withColumn("is_combination", F.col("molecule").contains(" & "))
    parts = F.when(F.col("is_combination"), F.transform(split_literal(F.col("molecule"), " & "), normalise)).otherwise(F.array().cast("array<string>"))
    return drugs.select(
        F.struct(F.col("line_no"), F.lit(0).alias("place"), F.lit(0).alias("part")).alias("ordinal"), "canonical_name", F.col("molecule").alias("source_name"), "card_abbrev",
        "is_combination", parts.alias("components"), F.when(F.col("is_combination"), "clinical").otherwise(context_of(F.col("canonical_name"))).alias("context"), F.lit("card").alias("source"),
    )


def tokens(c: Column) -> Column:
    """Normalised pieces of a slash list."""
    return F.transform(F.filter(split_literal(F.coalesce(c, F.lit("")), "/"), lambda x: strip(x) != ""), normalise)


def gene_links(report: DataFrame) -> DataFrame:
    """Class × drug tokens of each report row; a row without drugs links to the empty token."""
    drug = F.when(F.size("subs") > 0, F.col("subs")).otherwise(F.array(F.lit("")))
    rows = report.withColumn("classes", tokens(F.col("class"))).withColumn("subs", tokens(F.col("subclass")))
    links = rows.withColumn("canonical_class_token", F.explode("classes")).withColumn("canonical_drug_token", F.explode(drug))
    accession = F.coalesce(first_filled(F.col("refseqProtein.accessionVersion"), F.col("refseqNucleotide.accessionVersion")), F.lit(""))
    return links.select(
        F.coalesce("geneFamily", F.lit("")).alias("gene_name"), accession.alias("accession"), F.col("type").alias("element_type"),
        F.col("class").alias("ncbi_class_raw"), F.col("subclass").alias("ncbi_subclass_raw"), "canonical_class_token", "canonical_drug_token",
    )


def ncbi_drugs(report: DataFrame) -> DataFrame:
    rows = report.select(F.col("line_no").alias("n"), F.posexplode(tokens(F.col("subclass"))).alias("place", "canonical_name"))
    return rows.select(
        F.struct(F.col("n").alias("line_no"), "place", F.lit(0).alias("part")).alias("ordinal"), "canonical_name", F.col("canonical_name").alias("source_name"),
        F.lit(False).alias("is_combination"), F.array().cast("array<string>").alias("components"), context_of(F.col("canonical_name")).alias("context"), F.lit("ncbi").alias("source"),
    )


def merge_drugs(*sources: DataFrame) -> DataFrame:
    """One row per name, folded over the sources in the order given.

    is_combination and components come from the first mention, context from the
    first that is not clinical, card_abbrev from the first that has one;
    sources are joined in order.
    """
    wanted = ("ordinal", "canonical_name", "is_combination", "components", "context", "card_abbrev", "source")
    parts = []
    for rank, s in enumerate(sources):
        s = s if "card_abbrev" in s.columns else s.withColumn("card_abbrev", F.lit(None).cast("string"))
        o = F.struct(F.lit(rank).alias("rank"), F.col("ordinal.line_no").alias("a"), F.col("ordinal.place").cast("long").alias("b"), F.col("ordinal.part").cast("long").alias("c"))
        parts.append(s.withColumn("ordinal", o).select(*wanted))
    return union_all(*parts).groupBy("canonical_name").agg(
        F.min_by("is_combination", "ordinal").alias("is_combination"),
        F.array_join(F.min_by("components", "ordinal"), "|").alias("components"),
        F.coalesce(F.min_by(F.when(F.col("context") != "clinical", F.col("context")), F.when(F.col("context") != "clinical", F.col("ordinal"))), F.lit("clinical")).alias("context"),
        F.coalesce(F.min_by("card_abbrev", F.when(blank_to_null(F.col("card_abbrev")).isNotNull(), F.col("ordinal"))), F.lit("")).alias("card_abbrev"),
        F.array_join(F.array_sort(F.collect_set("source")), "|").alias("sources"),
    ).orderBy("canonical_name")


def class_members(mapping: DataFrame, resfinder: DataFrame, links: DataFrame, curated: DataFrame, ontology: DataFrame | None = None) -> DataFrame:
    """(canonical_drug, canonical_class, aro_accession, category, source), the first source of a pair counting.

    Sources in order: the class list and the components of its combinations,
    single-class report rows, curated pairs, and pairs of the ontology.
    """
    by_alias = class_lookup(mapping, "resfinder_alias")
    listed = resfinder.join(by_alias, F.lower("class_raw") == F.col("key"))
    own = listed.select(F.lit(0).alias("rank"), F.col("canonical_name").alias("canonical_drug"), "canonical_class", F.lit("resfinder").alias("source"))
    parts = listed.select(F.lit(1).alias("rank"), F.explode("components").alias("canonical_drug"), "canonical_class", F.lit("resfinder_combination_component").alias("source"))
    by_token = class_lookup(mapping, "ncbi_alias", tokens=True)
    single = links.filter(~F.col("ncbi_class_raw").contains("/") & (F.col("canonical_drug_token") != ""))
    ncbi = single.join(by_token, F.col("canonical_class_token") == F.col("key")).select(F.lit(2).alias("rank"), F.col("canonical_drug_token").alias("canonical_drug"), "canonical_class", F.lit("ncbi").alias("source"))
    hand = curated.select(F.lit(3).alias("rank"), strip(F.col("canonical_drug")).alias("canonical_drug"), strip(F.col("canonical_class")).alias("canonical_class"), F.lit("curated").alias("source")).filter("canonical_drug <> '' AND canonical_class <> ''")
    every = [own, parts.filter("canonical_drug <> ''"), ncbi, hand]
    if ontology is not None:
        every.append(ontology.select(F.lit(4).alias("rank"), "canonical_drug", "canonical_class", F.lit("aro_obo").alias("source")))
    first = keep_first(union_all(*every).dropDuplicates(), ["canonical_drug", "canonical_class"], "rank")
    named = mapping.select(F.trim("canonical_name").alias("canonical_class"), "aro_accession", "category").dropDuplicates(["canonical_class"])
    out = first.join(named, "canonical_class", "left").fillna("", ["aro_accession", "category"])
    return out.select("canonical_drug", "canonical_class", "aro_accession", "category", "source").orderBy("canonical_class", "canonical_drug")


def class_targets(terms: DataFrame, mapping: DataFrame) -> DataFrame:
    """(node, hit): accessions of canonical classes, terms of the ontology or not, and terms with the name of one.

    mapping: line_no, canonical_name, aro_accession. An accession counts before
    a name; of several classes of either the last counts.
    """
    named = mapping.select("line_no", strip(F.col("canonical_name")).alias("hit"), strip(F.coalesce("aro_accession", F.lit(""))).alias("node"))
    by_id = last_wins(named.filter("node <> ''"), "node", "line_no").select("node", "hit", F.lit(0).alias("way"))
    by_name = last_wins(named.withColumn("low", F.lower("hit")), "low", "line_no").select("low", "hit")
    found = terms.select(F.col("id").alias("node"), F.lower("name").alias("low")).join(by_name, "low").select("node", "hit", F.lit(1).alias("way"))
    return by_id.unionByName(found).groupBy("node").agg(F.min_by("hit", F.struct("way", "hit")).alias("hit"))


def ontology_edges(terms: DataFrame) -> DataFrame:
    return terms.select("id", F.posexplode("is_a").alias("ordinal", "parent"))


def ontology_drugs(terms: DataFrame, mapping: DataFrame) -> DataFrame:
    """(canonical_drug, drug_aro_accession, canonical_class, class_aro_accession, source): live named terms that are no class themselves, with the class above them."""
    targets = class_targets(terms, mapping)
    live = terms.filter(~F.col("is_obsolete") & (F.size("is_a") > 0) & (F.trim("name") != ""))
    seeds = live.join(targets, terms.id == targets.node, "left_anti")
    found = first_ancestor(seeds.select("id"), ontology_edges(terms), targets)
    own = last_wins(mapping.select("line_no", strip(F.col("canonical_name")).alias("canonical_class"), strip(F.col("aro_accession")).alias("class_aro_accession")).filter("class_aro_accession <> ''"), "canonical_class", "line_no")
    named = found.join(terms.select("id", F.lower(F.trim("name")).alias("canonical_drug")), "id").withColumnRenamed("hit", "canonical_class").join(own.drop("line_no"), "canonical_class", "left")
    out = named.select("canonical_drug", F.col("id").alias("drug_aro_accession"), "canonical_class", F.coalesce("class_aro_accession", F.lit("")).alias("class_aro_accession"), F.lit("aro_obo").alias("source"))
    return out.orderBy("canonical_class", "canonical_drug")


def ontology_gene_classes(terms: DataFrame, mapping: DataFrame, relation: str = "confers_resistance_to_drug_class") -> DataFrame:
    """(aro_accession, gene_name, canonical_class, class_aro_accession, source) by a relationship to a class, or to a term below one.

    The target itself is depth 0, so its parents begin at depth 1.
    """
    targets = class_targets(terms, mapping)
    live = terms.filter(~F.col("is_obsolete") & (F.trim("name") != ""))
    links = live.select("id", F.trim("name").alias("name"), F.explode("relationships").alias("r")).filter(F.col("r.type") == relation).select("id", "name", F.col("r.target").alias("target"))
    open_ends = links.select(F.col("target").alias("id")).distinct().join(targets.select(F.col("node").alias("id")), "id", "left_anti")
    above = first_ancestor(open_ends, ontology_edges(terms), targets, MAX_DEPTH - 1).select(F.col("id").alias("target"), F.col("hit").alias("up"))
    out = links.join(targets, links.target == targets.node, "left").join(above, "target", "left").withColumn("canonical_class", F.coalesce("hit", "up"))
    rows = out.filter("canonical_class IS NOT NULL").select(F.col("id").alias("aro_accession"), F.col("name").alias("gene_name"), "canonical_class", F.col("target").alias("class_aro_accession"), F.lit("aro_obo").alias("source"))
    return rows.distinct().orderBy("gene_name", "canonical_class")


# Classes of the index that have another name in the list, and one that means none.
INDEX_CLASSES = {
    "penicillin beta-lactam": "penicillin antibiotic",
    "sulfone antibiotic": "sulphone antibiotic",
    "isoniazid-like antibiotic": "isonicotinic acid hydrazide",
    "glycylcycline": "glycylcycline",
    "disinfecting agents and antiseptics": "disinfecting agents and antiseptics",
    "antibiotic without defined classification": None,
}
# Canonical classes under the name that the nested document has for them.
DOCUMENT_CLASSES = {
    "penicillin antibiotic": "penicillin beta-lactam",
    "isonicotinic acid hydrazide": "isoniazid-like antibiotic",
    "sulphone antibiotic": "sulfone antibiotic",
}


def index_gene_classes(index: DataFrame, mapping: DataFrame, overrides: dict[str, str | None] = INDEX_CLASSES) -> tuple[DataFrame, DataFrame]:
    """(rows, unmapped counts) of the ``;`` lists of an index; an override may also drop a class (None).

    Classes that are dropped count as unmapped like unknown ones.
    """
    raw = index.select("*", F.explode(split_literal(F.col("Drug Class"), ";")).alias("raw")).withColumn("raw", strip(F.col("raw"))).filter("raw <> ''")
    low = F.lower("raw")
    renamed = F.create_map(*[F.lit(x) for k, v in overrides.items() if v for x in (k.lower(), v)]) if any(overrides.values()) else F.create_map().cast("map<string,string>")
    dropped = low.isin(*[k.lower() for k, v in overrides.items() if v is None]) if None in overrides.values() else F.lit(False)
    known = mapping.select(F.lower("canonical_name").alias("low"), F.col("canonical_name").alias("own"))
    rows = raw.withColumn("gone", dropped).withColumn("low", low).join(known, "low", "left").withColumn("canonical_class", F.when(~F.col("gone"), F.coalesce(F.try_element_at(renamed, F.col("low")), "own")))
    unmapped = rows.filter("canonical_class IS NULL").groupBy("raw").agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), "raw")
    return rows.filter("canonical_class IS NOT NULL").drop("gone", "low", "own"), unmapped


def class_mapping(curated: DataFrame, classes: DataFrame, document_names: dict[str, str] = DOCUMENT_CLASSES) -> tuple[DataFrame, DataFrame]:
    """(mapping, names without accession): a curated list of classes with the accessions of a nested document.

    curated: canonical_name and any further columns, in their order. classes:
    aro_accession (digits) and name, as ``read_nested_classes`` gives them.
    """
    names = F.create_map(*[F.lit(x) for kv in document_names.items() for x in kv]) if document_names else F.create_map().cast("map<string,string>")
    found = classes.select(F.col("name").alias("__name"), F.concat(F.lit("ARO:"), "aro_accession").alias("aro_accession"))
    rows = curated.drop("aro_accession").withColumn("__name", F.coalesce(F.try_element_at(names, F.col("canonical_name")), "canonical_name")).join(found, "__name", "left")
    rows = rows.withColumn("aro_accession", F.coalesce("aro_accession", F.lit("")))
    return rows.drop("__name"), rows.filter("aro_accession = ''").select("canonical_name", F.col("__name").alias("looked_up"))


def class_overrides(curated: DataFrame) -> DataFrame:
    """(canonical_drug, canonical_class, notes) of curated pairs, ready to be written: blanks cut, rows without either name left out, of equal pairs the first."""
    cut = [strip(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("canonical_drug", "canonical_class", "notes")]
    rows = curated.select("line_no", *cut).filter("canonical_drug <> '' AND canonical_class <> ''")
    return keep_first(rows, ["canonical_drug", "canonical_class"], "line_no").select("canonical_drug", "canonical_class", "notes").orderBy("canonical_drug", "canonical_class")


@dataclass
class Load:
    """How a vocabulary file becomes a table: its columns (new name: name in the file), the required ones, defaults and keys."""

    columns: dict[str, str]
    required: list[str]
    keys: list[str]
    replace: bool = True
    defaults: dict[str, str] = field(default_factory=dict)
    flags: list[str] = field(default_factory=list)
    kept_blank: list[str] = field(default_factory=list)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


LOADS = {
    "drug_class": Load(_same("canonical_name", "aro_accession", "category", "resfinder_alias", "ncbi_alias", "card_abbrev", "card_class_abbrev", "notes"), ["canonical_name"], ["canonical_name"]),
    "drug": Load(
        _same("canonical_name", "is_combination", "components", "context", "card_abbrev", "atc_code", "inchikey", "pubchem_cid", "chebi_id", "loinc_codes", "atc_group1", "atc_group2", "sources"),
        ["canonical_name"], ["canonical_name"], defaults={"context": "clinical"}, flags=["is_combination"],
    ),
    "drug_alias": Load(_same("canonical_name", "alias", "alias_type", "source"), ["canonical_name", "alias"], ["canonical_name", "alias", "source"], replace=False, defaults={"alias_type": "source_name"}, kept_blank=["source"]),
    "drug_class_member": Load(
        {**_same("canonical_drug", "canonical_class", "aro_accession", "category"), "evidence_source": "source"}, ["canonical_drug", "canonical_class"], ["canonical_drug", "canonical_class"], defaults={"evidence_source": "curated"}
    ),
    "gene_drug_link": Load(_same("gene_name", "accession", "element_type", "ncbi_class_raw", "ncbi_subclass_raw", "canonical_class_token", "canonical_drug_token"), [], [], kept_blank=["gene_name"]),
    "card_gene_class": Load(
        _same("aro_accession", "gene_name", "card_short_name", "gene_family", "resistance_mechanism", "drug_class_raw", "canonical_class"), ["aro_accession", "canonical_class"], ["aro_accession", "canonical_class"], kept_blank=["gene_name", "drug_class_raw"]
    ),
}


def vocabulary_rows(rows: DataFrame, rule: Load) -> DataFrame:
    """The rows of a vocabulary file as its table has them.

    rows: line_no and the columns of the file; columns that it lacks are null.
    Blank cells are null, or the default; rows without a required value are
    left out; of equal keys the first counts.
    """

    def value(name: str, source: str) -> Column:
        c = F.col(source) if source in rows.columns else F.lit(None).cast("string")
        if name in rule.flags:
            return F.coalesce(strip(c) == "True", F.lit(False))
        if name in rule.defaults:
            return default_if_blank(c, rule.defaults[name])
        return F.coalesce(strip(c), F.lit("")) if name in rule.kept_blank else blank_to_null(c)

    out = rows.select("line_no", *[value(n, s).alias(n) for n, s in rule.columns.items()])
    for name in rule.required:
        out = out.filter(F.col(name).isNotNull())
    return keep_first(out, rule.keys, "line_no").select(*rule.columns) if rule.keys else out.drop("line_no")


def cardinalities(df: DataFrame, **names: str) -> DataFrame:
    """n_rows and, under each name given, the number of distinct values of a column, in one aggregation."""
    return df.agg(F.count("*").alias("n_rows"), *[F.count_distinct(c).alias(n) for n, c in names.items()])


def drug_summary(drugs: DataFrame, members: DataFrame) -> DataFrame:
    """(n_drugs, n_combinations, n_sources, n_classified, n_classes) of a vocabulary."""
    source = drugs.select(F.explode(split_literal(F.col("sources"), "|")).alias("s")).agg(F.count_distinct("s").alias("n_sources"))
    one = drugs.agg(F.count("*").alias("n_drugs"), F.count_if(F.col("is_combination").cast("string").isin("true", "True")).alias("n_combinations"))
    classed = members.agg(F.count_distinct("canonical_drug").alias("n_classified"), F.count_distinct("canonical_class").alias("n_classes"))
    key = lambda df: df.withColumn("__one", F.lit(1))  # noqa: E731 single rows, joined by a constant
    return key(one).join(key(source), "__one").join(key(classed), "__one").drop("__one")


def entry_check(listed: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """(id, side, near): ids that only one of two lists has, with those of the other that share the allele or the accession.

    An id reads ``gene_number_accession``: its first two pieces are the allele,
    the rest the accession. Trailing blanks are cut. side is ``listed`` or
    ``found``; near joins the near matches in order, and is null without any.
    """

    def keyed(df: DataFrame) -> DataFrame:
        i = F.rtrim(F.col(key))
        allele, accession = F.regexp_extract(i, "^([^_]*_[^_]*)", 1), F.regexp_extract(i, "^[^_]*_[^_]*_(.+)$", 1)
        keys = F.array(F.struct(F.lit(0).alias("kind"), allele.alias("v")), F.struct(F.lit(1).alias("kind"), accession.alias("v")))
        return df.select(i.alias("id"), F.explode(keys).alias("k")).filter("k.v <> ''").distinct()

    def only(a: DataFrame, b: DataFrame, side: str) -> DataFrame:
        ids = a.select(F.rtrim(F.col(key)).alias("id")).distinct()
        missing = ids.join(b.select(F.rtrim(F.col(key)).alias("id")).distinct(), "id", "left_anti")
        near = keyed(missing.withColumnRenamed("id", key)).join(keyed(b).withColumnRenamed("id", "other"), "k").groupBy("id").agg(join_distinct(F.col("other"), " ").alias("near"))
        return missing.join(near, "id", "left").select("id", F.lit(side).alias("side"), "near")

    return only(listed, found, "listed").unionByName(only(found, listed, "found"))


def unclassified(drugs: DataFrame, members: DataFrame, limit: int = 30) -> DataFrame:
    """The first names, in order, of single drugs for therapy that belong to no class."""
    left = drugs.join(members.select(F.col("canonical_drug").alias("canonical_name")), "canonical_name", "left_anti")
    return left.filter(~F.col("is_combination") & ~F.col("context").isin("research_tool", "biocide")).select("canonical_name").orderBy("canonical_name").limit(limit)
