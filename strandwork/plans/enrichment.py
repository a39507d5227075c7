"""Filling identifiers of drugs from offline references and landed responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import category_rank, clean_group, clean_list, combination_key, sort_codes_text
from ..functions.text import blank_to_null, first_filled, squeeze, strip
from ..operators.merge import insert_ignore, widen
from ..operators.relational import union_all
from ..sources.landed import xml_records

NEW = ("loinc_codes", "atc_group1", "atc_group2")


def _present(c):
    t = strip(c)
    return F.when(F.upper(t) != "NA", F.nullif(t, F.lit("")))


def reference_index(reference: DataFrame) -> DataFrame:
    """(key, hit): every name, synonym and abbreviation; names count before synonyms before abbreviations, then earlier rows."""
    row = F.struct(*reference.columns)
    name = reference.select(F.lit(0).alias("tier"), "line_no", F.lit(0).alias("i"), F.col("name").alias("key"), row.alias("hit"))
    more = [
        reference.select(F.lit(t).alias("tier"), "line_no", F.posexplode(F.split(_present(F.col(c)), ",")).alias("i", "key"), row.alias("hit"))
        for t, c in ((1, "synonyms"), (2, "abbreviations"))
    ]
    keyed = union_all(name, *more).withColumn("key", F.lower(squeeze(F.col("key")))).filter("key <> ''")
    return keyed.groupBy("key").agg(F.min_by("hit", F.struct("tier", "line_no", "i")).alias("hit"))


def combination_index(reference: DataFrame) -> DataFrame:
    """(key, hit): entries named by several components, by the set of these; earlier rows count."""
    keyed = reference.select(combination_key(F.col("name")).alias("key"), "line_no", F.struct(*reference.columns).alias("hit")).filter("key IS NOT NULL")
    return keyed.groupBy("key").agg(F.min_by("hit", "line_no").alias("hit"))


def enrich_offline(drugs: DataFrame, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(drugs, new aliases). Identifiers are filled only where empty; codes and groups are replaced where the reference has any."""
    drugs = widen(drugs, NEW)
    single = reference_index(reference).select(F.col("key").alias("k1"), F.col("hit").alias("h1"))
    combined = combination_index(reference).select(F.col("key").alias("k2"), F.col("hit").alias("h2"))
    probe = drugs.withColumn("k1", F.lower(squeeze(F.col("canonical_name")))).withColumn("k2", F.when(F.col("is_combination").cast("string").isin("True", "true"), combination_key(F.col("canonical_name"))))
    found = probe.join(single, "k1", "left").join(combined, "k2", "left").withColumn("hit", F.coalesce("h1", "h2"))
    put = lambda new, old: F.coalesce(F.nullif(new, F.lit("")), F.col(old))
    changes = {
        "pubchem_cid": F.coalesce(blank_to_null(F.col("pubchem_cid")), _present(F.col("hit.cid")), F.lit("")),
        "atc_code": put(sort_codes_text(F.coalesce("hit.atc", F.lit(""))), "atc_code"),
        "loinc_codes": put(clean_list(F.coalesce("hit.loinc", F.lit(""))), "loinc_codes"),
        "atc_group1": put(clean_group(F.col("hit.atc_group1")), "atc_group1"),
        "atc_group2": put(clean_group(F.col("hit.atc_group2")), "atc_group2"),
    }
    names = F.array(
        F.struct(F.array("hit.name").alias("v"), F.lit("source_name").alias("alias_type")),
        F.struct(F.split(_present(F.col("hit.synonyms")), ",").alias("v"), F.lit("synonym").alias("alias_type")),
        F.struct(F.split(_present(F.col("hit.abbreviations")), ",").alias("v"), F.lit("abbreviation").alias("alias_type")),
    )
    aliases = found.filter("hit IS NOT NULL").select("canonical_name", F.explode(names).alias("n")).select("canonical_name", "n.alias_type", F.explode("n.v").alias("alias"))
    aliases = aliases.withColumn("alias", strip(F.col("alias"))).filter((F.col("alias") != "") & (F.lower(squeeze(F.col("alias"))) != F.lower(squeeze(F.col("canonical_name")))))
    return found.select(*[changes.get(c, F.col(c)).alias(c) for c in drugs.columns]), aliases.distinct()


def name_to_code(codes: DataFrame) -> DataFrame:
    """(name, atc_code): one code per name of the human and veterinary lists, of the preferred category."""
    return codes.groupBy(F.lower(strip(F.col("name"))).alias("name")).agg(F.min_by("atc_code", F.struct(category_rank(F.col("atc_code")), "line_no")).alias("atc_code"))


def pending(drugs: DataFrame, cache: DataFrame) -> DataFrame:
    """Single drugs for therapy that the cache of responses has not."""
    rows = drugs.filter(~F.col("is_combination").cast("string").isin("True", "true") & ~F.col("context").isin("biocide", "research_tool"))
    return rows.join(cache.select("canonical_name"), "canonical_name", "left_anti")


def codes_by_name(codes: DataFrame) -> DataFrame:
    """(name, codes): all codes of a name, in the order of the lists; either list may be empty."""
    rows = codes.select(F.lower(strip(F.col("name"))).alias("name"), F.struct("line_no", "atc_code").alias("c")).filter("name <> ''")
    return rows.groupBy("name").agg(F.transform(F.array_sort(F.collect_set("c")), lambda x: x["atc_code"]).alias("codes"))


def best_match(candidates: DataFrame, least_stars: int = 2) -> DataFrame:
    """(canonical_name, chebi_id, inchikey): the candidate of the same name and three stars, else of the same name, else of most stars, of equals the first.

    Only a candidate of the same name may have less than ``least_stars``; names
    are compared where the candidates have a chebi_name.
    """
    same = F.lower("chebi_name") == F.lower(strip(F.col("canonical_name"))) if "chebi_name" in candidates.columns else F.lit(False)
    ranked = candidates.withColumn("__same", F.coalesce(same, F.lit(False))).filter(F.col("__same") | (F.col("stars") >= least_stars))
    order = F.struct((~(F.col("__same") & (F.col("stars") == 3))).alias("a"), (~F.col("__same")).alias("b"), F.when(~F.col("__same"), -F.col("stars")).alias("c"), F.col("place"))
    return ranked.groupBy("canonical_name").agg(F.min_by(F.struct("chebi_id", "inchikey"), order).alias("b")).select("canonical_name", "b.*")


def xml_candidates(pages: DataFrame, details: DataFrame) -> DataFrame:
    """Candidates for ``best_match`` from landed search pages (key: the name sought) and landed pages of entities (key: their id)."""
    found = xml_records(pages, "ListElement", ["chebiId", "chebiAsciiName", "entityStar"]).filter("chebiId <> ''")
    keys = xml_records(details, "return", ["chebiId", "inchikey"]).groupBy("chebiId").agg(F.min_by("inchikey", "place").alias("inchikey"))
    rows = found.join(keys, "chebiId", "left")
    return rows.select(
        F.col("key").alias("canonical_name"), "place", F.coalesce(F.col("entityStar").try_cast("int"), F.lit(0)).alias("stars"),
        F.col("chebiId").alias("chebi_id"), F.col("chebiAsciiName").alias("chebi_name"), F.coalesce("inchikey", F.lit("")).alias("inchikey"),
    )


CACHED = ("chebi_id", "inchikey", "pubchem_cid", "atc_code")


def merge_cache(cache: DataFrame, landed: DataFrame, codes: DataFrame, refresh_without: str | None = None) -> DataFrame:
    """The cache of responses with what has landed since and codes filled in by name; cached names keep their response.

    refresh_without: entries with a pubchem_cid but without this field are left
    out, so that they are looked up again. Save it by ``save_landed``.
    """
    cols = ["canonical_name", *CACHED]
    kept = cache.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c != "canonical_name" else F.col(c) for c in cols])
    if refresh_without:
        kept = kept.filter(~((F.col("pubchem_cid") != "") & (F.col(refresh_without) == "")))
    by_name = name_to_code(codes).select(F.col("name").alias("__low"), F.col("atc_code").alias("__code"))

    def filled_in(rows: DataFrame, test) -> DataFrame:
        out = rows.withColumn("__low", F.lower(strip(F.col("canonical_name")))).join(by_name, "__low", "left")
        return out.withColumn("atc_code", F.coalesce(F.nullif("atc_code", F.lit("")), F.when(test, F.col("__code")), F.lit(""))).select(*cols)

    new = landed.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c != "canonical_name" else F.col(c) for c in cols])
    # the list is asked before the response, but only if the compound was found
    listed = filled_in(new.withColumn("atc_code", F.lit("")), F.col("pubchem_cid") != "")
    own = new.select("canonical_name", F.col("atc_code").alias("__own"))
    fresh = listed.join(own, "canonical_name").withColumn("atc_code", F.coalesce(first_filled(F.col("atc_code"), F.col("__own")), F.lit(""))).select(*cols)
    return insert_ignore(filled_in(kept, F.lit(True)), fresh, ["canonical_name"])


def enrich_landed(drugs: DataFrame, landed: DataFrame, codes: DataFrame, replace_all: bool = False) -> DataFrame:
    """Identifiers of landed responses: chebi_id and inchikey replace, pubchem_cid and atc_code fill; codes back-fill by name.

    With ``replace_all`` all four replace what is there wherever the response
    has a value.
    """
    r = landed.select("canonical_name", *[F.col(c).alias(f"l_{c}") for c in CACHED])
    by_name = name_to_code(codes).select(F.col("name").alias("low"), F.col("atc_code").alias("by_name"))
    out = drugs.withColumn("low", F.lower(strip(F.col("canonical_name")))).join(r, "canonical_name", "left").join(by_name, "low", "left")
    code = first_filled(F.col("l_atc_code"), F.when(F.col("l_pubchem_cid") != "", F.col("by_name")))
    changes = {
        "chebi_id": first_filled(F.col("l_chebi_id"), F.col("chebi_id")), "inchikey": first_filled(F.col("l_inchikey"), F.col("inchikey")),
        "pubchem_cid": first_filled(*[F.col(c) for c in (("l_pubchem_cid", "pubchem_cid") if replace_all else ("pubchem_cid", "l_pubchem_cid"))]),
        "atc_code": first_filled(code, F.col("atc_code")) if replace_all else first_filled(F.col("atc_code"), code),
    }
    return out.select(*[F.coalesce(changes[c], F.lit("")).alias(c) if c in changes else F.col(c) for c in drugs.columns])


def coverage(drugs: DataFrame, columns: tuple[str, ...] = ("atc_code", "inchikey", "pubchem_cid", "chebi_id")) -> DataFrame:
    return drugs.agg(F.count("*").alias("n_drugs"), *[F.count_if(blank_to_null(F.col(c)).isNotNull()).alias(f"n_{c}") for c in columns])
