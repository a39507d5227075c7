import io
import json
import urllib.error

from pyspark.sql import functions as F

from strandwork.__main__ import main
from strandwork.plans import catalogue, data_problems, driver_queries
from strandwork.plans.enrichment import best_match, codes_by_name, coverage, enrich_landed, enrich_offline, merge_cache, name_to_code, pending, xml_candidates
from strandwork.plans.pipeline import export, ingest, load_vocabulary, run_summary, store_ingest, store_links, store_proteins, validate
from strandwork.plans.store import Store
from strandwork.plans.vocabulary import (
    card_drugs, cardinalities, class_mapping, class_members, class_overrides, drug_summary, entry_check, gene_links, index_gene_classes, merge_drugs, ncbi_drugs, ontology_drugs, ontology_gene_classes, resfinder_drugs, unclassified,
)
from strandwork.sources import (
    cached_copy, code_list, fetch, land, read_code_lists, read_fasta, read_json_lines, read_landed, read_nested_classes, read_obo, read_padded, read_pages, read_panels, read_quoted,
    read_ragged_classes, read_raw, save_landed, write_table,
)
from strandwork.streaming.incremental import merge_stream, watch_parquet, windowed_counts


def rows(df):
    return {tuple(r) for r in df.collect()}


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_fasta(spark, tmp_path):
    path = put(tmp_path, "a.fsa", "junk\n>one 1 \nacg\n TT \n>two\n\n>three\nAAA\n")
    assert [(r.header, r.sequence) for r in read_fasta(spark, path).orderBy("record_no").collect()] == [("one 1 ", "ACGTT"), ("three", "AAA")]
    path = put(tmp_path, "b.fsa", ">x\r\nac\r\ngt\r\n>y\r\nt")
    assert [(r.header, r.sequence) for r in read_fasta(spark, path).orderBy("record_no").collect()] == [("x", "ACGT"), ("y", "T")]


def test_tables(spark, tmp_path):
    path = put(tmp_path, "t.tsv", 'a\tb\tc\n1\t"2\t3\n4\t5\n6\n')
    assert [(r.a, r.b, r.c) for r in read_raw(spark, path).collect()] == [("1", '"2', "3")]
    assert [(r.a, r.b, r.c) for r in read_padded(spark, path).collect()] == [("1", '"2', "3"), ("4", "5", None)]
    quoted = put(tmp_path, "q.tsv", 'a\tb\n"x ""y"""\t\n')
    assert [(r.a, r.b) for r in read_quoted(spark, quoted).collect()] == [('x "y"', "")]
    write_table(read_quoted(spark, quoted), str(tmp_path / "out"), ["b", "a"], distinct=True)
    assert [(r.a, r.b) for r in read_quoted(spark, str(tmp_path / "out")).collect()] == [('x "y"', "")]
    ragged = put(tmp_path, "r.txt", "# c\nClass\tU\tD\nPen\tUnknown Pen\tA\tB+C\n\nUNDER_DEVELOPMENT\tx\ty\n")
    assert [(r.class_raw, r.drug) for r in read_ragged_classes(spark, ragged).orderBy("place").collect()] == [("Pen", "A"), ("Pen", "B+C")]
    lines = put(tmp_path, "x.jsonl", json.dumps({"geneFamily": "f", "refseqProtein": {"accessionVersion": "P.1"}}) + "\n{bad\n")
    assert [r.refseqProtein.accessionVersion for r in read_json_lines(spark, lines).collect()] == ["P.1"]
    landed = put(tmp_path, "cache.json", json.dumps({"a": {"cid": "1"}}))
    assert rows(read_landed(spark, landed, "name", "cid string")) == {("a", "1")}
    assert read_landed(spark, put(tmp_path, "bad.json", "{oops"), "name", "cid string").count() == 0
    doc = {"1": {"ARO_category": {"2": {"category_aro_class_name": "Drug Class", "category_aro_accession": "7", "category_aro_name": "k"}, "3": {"category_aro_class_name": "Other", "category_aro_accession": "8", "category_aro_name": "n"}}}}
    doc |= {"2": {"ARO_category": {"1": {"category_aro_class_name": "Drug Class", "category_aro_accession": "9", "category_aro_name": "k"}}}, "_version": "3"}
    assert rows(read_nested_classes(spark, put(tmp_path, "card.json", json.dumps(doc)))) == {("9", "k")}


def test_places_follow_files_and_lines(spark, tmp_path):
    """Numbers grow from file to file and line to line however the files are cut into tasks."""
    folder = tmp_path / "many"
    folder.mkdir()
    for name in ("b.tsv", "a.tsv", "c d.tsv"):
        (folder / name).write_text("k\tv\n" + "".join(f"{name}{i}\t{i}\n" for i in range(400)))
    want = [f"{n}{i}" for n in ("a.tsv", "b.tsv", "c d.tsv") for i in range(400)]
    for size in ("1000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = read_raw(spark, str(folder))
            assert [r.k for r in got.orderBy("line_no").collect()] == want and got.select("line_no").distinct().count() == 1200
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


OBO = """format-version: 1.2

[Term]
id: ARO:1
name: Klass One

[Term]
id: ARO:2
name: middle
is_a: ARO:1 ! Klass One

[Term]
id: ARO:3
name: Drugine
is_a: ARO:2
is_a: XX:9

[Term]
id: ARO:4
name: gene A
relationship: confers_resistance_to_drug_class ARO:2 ! middle
is_a: ARO:9

[Term]
id: ARO:5
name: old
is_a: ARO:1
is_obsolete: true

[Typedef]
id: part_of
"""


def mapping(spark):
    data = [(0, "klass one", "ARO:1", "Pen", "PEN/PENX", "P", "a"), (1, "klass two", "", "Pen2", "TWO", "", "b"), (2, "klass three", "", "Pen2", "", "", "c")]
    return spark.createDataFrame(data, "line_no long, canonical_name string, aro_accession string, resfinder_alias string, ncbi_alias string, card_class_abbrev string, category string")


def test_ontology(spark, tmp_path):
    terms = read_obo(spark, put(tmp_path, "a.obo", OBO))
    got = {r.id: r for r in terms.collect()}
    assert set(got) == {f"ARO:{i}" for i in range(1, 6)} and got["ARO:3"].is_a == ["ARO:2"] and got["ARO:5"].is_obsolete
    m = mapping(spark)
    assert {(r.canonical_drug, r.canonical_class) for r in ontology_drugs(terms, m).collect()} == {("middle", "klass one"), ("drugine", "klass one")}
    assert rows(ontology_gene_classes(terms, m)) == {("ARO:4", "gene A", "klass one", "ARO:2", "aro_obo")}
    # an accession that is no term of the file, and the last class of an accession
    more = m.union(spark.createDataFrame([(3, "klass nine", "ARO:9", "", "", "", "c"), (4, "klass nine b", "ARO:9", "", "", "", "c")], m.schema))
    assert {(r.canonical_drug, r.canonical_class, r.class_aro_accession) for r in ontology_drugs(terms, more).collect()} >= {("gene a", "klass nine b", "ARO:9"), ("middle", "klass one", "ARO:1")}


def test_gene_classes_end_at_the_eighth_ancestor(spark):
    """The target of a relationship is depth 0, so one that has eight terms up to the class finds it, one with nine does not."""
    terms = [(f"ARO:{i}", f"t{i}", [f"ARO:{i + 1}"], [("confers_resistance_to_drug_class", f"ARO:{i}")], False) for i in range(1, 12)] + [("ARO:12", "klass", [], [], False)]
    df = spark.createDataFrame(terms, "id string, name string, is_a array<string>, relationships array<struct<type:string,target:string>>, is_obsolete boolean")
    m = spark.createDataFrame([(0, "klass", "ARO:12")], "line_no long, canonical_name string, aro_accession string")
    assert {r.class_aro_accession for r in ontology_gene_classes(df, m).collect()} == {f"ARO:{i}" for i in range(4, 12)}


def test_vocabulary(spark, tmp_path):
    m = mapping(spark)
    listed = resfinder_drugs(read_ragged_classes(spark, put(tmp_path, "r.txt", "Pen\tu\tTazobactam\tAA+BB\nPen2\tu\tCC\nNone\tu\tDD\n")))
    names = spark.createDataFrame([(0, "P", "penicillins"), (1, "CC", "cc"), (2, "CC", "again"), (3, "XY", "x & y"), (4, "MA", "Macrolides")], "line_no long, `AAC Abbreviation` string, Molecule string")
    card = card_drugs(names, spark.createDataFrame([("P",)], "card_abbrev string"))
    schema = "geneFamily string, type string, class string, subclass string, refseqProtein struct<accessionVersion:string>, refseqNucleotide struct<accessionVersion:string>"
    report = spark.createDataFrame([(0, "g1", "AMR", "PEN", "ee/FF", None, ("N.1",)), (1, "g2", "AMR", "PEN/TWO", "gg", ("P.1",), None), (2, "g3", "AMR", "TWO", None, None, None)], f"line_no long, {schema}")
    links = gene_links(report)
    assert {(r.gene_name, r.accession, r.canonical_class_token, r.canonical_drug_token) for r in links.collect()} == {
        ("g1", "N.1", "pen", "ee"), ("g1", "N.1", "pen", "ff"), ("g2", "P.1", "pen", "gg"), ("g2", "P.1", "two", "gg"), ("g3", "", "two", "")}
    merged = {r.canonical_name: r for r in merge_drugs(listed, card, ncbi_drugs(report)).collect()}
    assert merged["cc"].sources == "card|resfinder" and merged["cc"].card_abbrev == "CC" and merged["aa+bb"].components == "aa|bb"
    assert merged["tazobactam"].context == "inhibitor" and merged["x & y"].is_combination and "macrolides" not in merged
    curated = spark.createDataFrame([(" dd ", "klass two"), ("ee", "klass one"), ("", "x")], "canonical_drug string, canonical_class string")
    members = class_members(m, listed, links, curated)
    got = {(r.canonical_drug, r.canonical_class): r.source for r in members.collect()}
    assert got == {("tazobactam", "klass one"): "resfinder", ("aa+bb", "klass one"): "resfinder", ("aa", "klass one"): "resfinder", ("bb", "klass one"): "resfinder",
                   ("cc", "klass three"): "resfinder", ("ee", "klass one"): "ncbi", ("ff", "klass one"): "ncbi", ("dd", "klass two"): "curated"}
    assert [r[0] for r in unclassified(merge_drugs(listed, card, ncbi_drugs(report)), members).collect()] == ["gg"]
    index = spark.createDataFrame([("1", "Klass One; dropped;odd;Renamed")], "id string, `Drug Class` string")
    kept, odd = index_gene_classes(index, m, {"dropped": None, "renamed": "klass two"})
    assert {r.canonical_class for r in kept.collect()} == {"klass one", "klass two"} and rows(odd) == {("odd", 1), ("dropped", 1)}
    assert tuple(cardinalities(kept, n_genes="id", n_classes="canonical_class").first()) == (2, 1, 2)
    assert drug_summary(merge_drugs(listed, card, ncbi_drugs(report)), members).first().n_classified == 8
    found = spark.createDataFrame([("77", "klass one"), ("78", "klass one"), ("5", "old name")], "aro_accession string, name string")
    built, without = class_mapping(m.select("canonical_name", "aro_accession", "category"), found, {"klass three": "old name"})
    assert {(r.canonical_name, r.aro_accession) for r in built.collect()} == {("klass one", "ARO:77"), ("klass one", "ARO:78"), ("klass two", ""), ("klass three", "ARO:5")}
    assert rows(without) == {("klass two", "klass two")}
    assert rows(class_overrides(curated.withColumn("notes", F.lit(" n ")).withColumn("line_no", F.lit(1)))) == {("dd", "klass two", "n"), ("ee", "klass one", "n")}
    a = spark.createDataFrame([("aac_1_M1 ",), ("b_1_X1",), ("c_1_Y1",)], "id string")
    b = spark.createDataFrame([("aac_1_M2",), ("bb_2_X1",), ("c_1_Y1",)], "id string")
    assert rows(entry_check(a, b)) == {("aac_1_M1", "listed", "aac_1_M2"), ("b_1_X1", "listed", "bb_2_X1"), ("aac_1_M2", "found", "aac_1_M1"), ("bb_2_X1", "found", "b_1_X1")}


def test_load_vocabulary(spark, tmp_path):
    files = {
        "drug_class": put(tmp_path, "c.tsv", "canonical_name\taro_accession\tcategory\tresfinder_alias\tncbi_alias\n klass one \tARO:1\t\tPen\tPEN\nklass two\t\tb\t\t\n\tARO:3\t\t\t\nklass two\tARO:9\t\t\t\n"),
        "drug": put(tmp_path, "d.tsv", "canonical_name\tis_combination\tcontext\nx\tTrue\t\ny\tfalse\tbiocide\n"),
        "drug_alias": put(tmp_path, "a.tsv", "canonical_name\talias\tsource\nx\tX1\t\nx\t\tq\n"),
        "drug_class_member": put(tmp_path, "m.tsv", "canonical_drug\tcanonical_class\tsource\nx\tklass one\t\n"),
        "gene_drug_link": put(tmp_path, "l.tsv", "gene_name\tcanonical_class_token\tcanonical_drug_token\ng\tpen\tx\ng\tpen\tx\n"),
        "card_gene_class": put(tmp_path, "g.tsv", "aro_accession\tgene_name\tdrug_class_raw\tcanonical_class\nARO:5\tfirst\tr\tklass one\nARO:5\tsecond\tr\tklass one\nARO:6\tn\tr\t\n"),
    }
    store = Store(spark, str(tmp_path / "db"))
    for _ in range(2):
        load_vocabulary(store, files)
    assert {(r.canonical_name, r.aro_accession, r.category) for r in store.read("drug_class").collect()} == {("klass one", "ARO:1", None), ("klass two", None, "b")}
    assert {(r.canonical_name, r.is_combination, r.context, r.atc_code) for r in store.read("drug").collect()} == {("x", True, "clinical", None), ("y", False, "biocide", None)}
    assert rows(store.read("drug_alias")) == {("x", "X1", "source_name", "")}
    assert [r.evidence_source for r in store.read("drug_class_member").collect()] == ["curated"]
    assert store.read("gene_drug_link").count() == 2 and [r.gene_name for r in store.read("card_gene_class").collect()] == ["first"]
    load_vocabulary(store, {**files, "drug": str(tmp_path / "absent.tsv")}, append_links=True)
    assert store.read("gene_drug_link").count() == 4 and rows(run_summary(store)) >= {("drug", 2), ("gene_drug_link", 4)}


def test_transactions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "db"))
    one, two = spark.range(1).toDF("k"), spark.range(2).toDF("k")
    store.put("a", one)
    try:
        with store.transaction():
            store.put("a", two)
            store.put("b", two)
            assert store.read("a").count() == 2 and Store(spark, store.root).read("a").count() == 1
            raise ValueError
    except ValueError:
        pass
    assert store.read("a").count() == 1 and store.read("b") is None
    before = store.read("a")
    with store.transaction():
        store.put("a", two)
        store.put("b", store.read("a"))
    assert store.read("a").count() == store.read("b").count() == 2 and before.count() == 1


PAGE = """<html><body><a href="./?code=J">up</a><a href="./?code=J01&showdescription=no">A</a><a href='?code=J01A'>deep</a>
<table><tr><td><a href="./?code=J01&x=1">J01</a></td><td>Anti <b>bac</b></td></tr></table></body></html>"""
LEAF = """<table><tr><th>Other</th></tr><tr><td>J01AA99</td><td>no</td></tr></table>
<table><tr><th>ATC code</th><th>Name</th></tr><tr><td>J01AA01</td><td>demeclo</td><td>0.6</td><td>g</td><td>O</td></tr><tr><td>text</td></tr><tr><td>J01</td><td>Anti bac</td><td>later</td></tr></table>
<a href="?code=J01">again</a><a href="?code=zz9zz">bad</a>"""


def test_landed_pages(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for name, text in (("J.html", PAGE), ("J01.html", LEAF), ("J01A.html", "<p>nothing"), ("K.html", LEAF)):
        (folder / name).write_text(text)
    got = code_list(read_pages(spark, str(folder)), spark.createDataFrame([("j",)], "id string"))
    assert rows(got.select("atc_code", "name", "ddd")) == {("J01", "Anti bac", ""), ("J01AA01", "demeclo", "0.6")}
    write_table(got, str(tmp_path / "human"), ["atc_code", "name"])
    lists = read_code_lists(spark, [str(tmp_path / "human"), str(tmp_path / "absent")])
    assert {(r.name, tuple(r.codes)) for r in codes_by_name(lists).collect()} == {("anti bac", ("J01",)), ("demeclo", ("J01AA01",))}
    panels = put(tmp_path, "p.txt", "# c\n:Panel: A\nx\n\n:Panel: B\n:Include: A\ny\n\n:Panel: C\n:Include: B\n:Include: C\n")
    assert rows(read_panels(spark, panels)) == {("A", "x"), ("B", "x"), ("B", "y"), ("C", "x"), ("C", "y")}
    (tmp_path / "copy").mkdir()
    copy = cached_copy(spark, panels, str(tmp_path / "copy" / "p.txt"))
    put(tmp_path, "p.txt", "new")
    assert cached_copy(spark, panels, copy) == copy and (tmp_path / "copy" / "p.txt").read_text().startswith("# c")


def test_landed_xml_and_cache(spark, tmp_path):
    search = "<r xmlns='u:x'><ListElement><chebiId>C:1</chebiId><chebiAsciiName>other</chebiAsciiName><entityStar>3</entityStar></ListElement><ListElement><chebiId>C:2</chebiId><chebiAsciiName>AA</chebiAsciiName></ListElement></r>"
    pages = spark.createDataFrame([("aa", search), ("bb", "<r><broken>"), ("cc", "<r><ListElement><chebiId/></ListElement></r>")], "key string, body string")
    details = spark.createDataFrame([("C:2", "<e><return><chebiId>C:2</chebiId><inchikey>KEY</inchikey></return></e>")], "key string, body string")
    assert rows(best_match(xml_candidates(pages, details))) == {("aa", "C:2", "KEY")}
    cols = "canonical_name string, chebi_id string, inchikey string, pubchem_cid string, atc_code string"
    cache = spark.createDataFrame([("aa", "C1", "K", "5", ""), ("zz", "", "", "7", "X")], cols)
    landed = spark.createDataFrame([("bb", "", "", "", "J09"), ("cc", "", "", "8", "J09"), ("aa", "new", "", "", "")], cols)
    codes = spark.createDataFrame([(0, "AA", "J01AA01"), (1, "cc", "J01AA02"), (2, "bb", "J01AA03")], "line_no long, name string, atc_code string")
    merged = merge_cache(cache, landed, codes)
    assert {(r.canonical_name, r.chebi_id, r.atc_code) for r in merged.collect()} == {("aa", "C1", "J01AA01"), ("zz", "", "X"), ("bb", "", "J09"), ("cc", "", "J01AA02")}
    assert "zz" not in {r.canonical_name for r in merge_cache(cache, landed, codes, refresh_without="chebi_id").collect()}
    path = str(tmp_path / "cache.json")
    for _ in range(2):
        save_landed(merged, path, "canonical_name")
    assert rows(read_landed(spark, path, "canonical_name", "chebi_id string, inchikey string, pubchem_cid string, atc_code string")) == rows(merged)


def test_fetch_asks_again(spark, tmp_path):
    class Answer(io.BytesIO):
        pass

    asked, waits = [], []

    def get(url, timeout):
        asked.append(url)
        if "gone" in url or len(asked) < 3:
            raise urllib.error.HTTPError(url, 404 if "gone" in url else 503, "", {}, None)
        return Answer(b"body")

    assert fetch("u", get=get, sleep=waits.append) == b"body" and waits == [2.0, 4.0]
    assert fetch("gone", get=get, sleep=waits.append) is None and len(waits) == 2
    requests = spark.createDataFrame([("a", "file://" + put(tmp_path, "x.json", "{}")), ("b", "file:///no/such/file")], "key string, url string")
    assert rows(land(requests, pause=0, tries=1)) == {("a", "{}")}


def test_enrichment(spark):
    cols = "canonical_name string, is_combination string, context string, atc_code string, inchikey string, pubchem_cid string, chebi_id string"
    drugs = spark.createDataFrame([("aa", "False", "clinical", "", "", "", ""), ("b+a", "True", "clinical", "", "", "9", ""), ("zz", "False", "biocide", "", "", "", "")], cols)
    ref = "line_no long, name string, cid string, atc string, atc_group1 string, atc_group2 string, loinc string, synonyms string, abbreviations string"
    reference = spark.createDataFrame([(0, "other", "1", "D01AA01,J01AA01", "g1", "NA", "1-1,NA", "Aa", "NA"), (1, "AA", "2", "NA", "NA", "NA", "NA", "x , y", "NA"), (2, "A/B", "3", "J01AA02", "g", "h", "NA", "NA", "ab")], ref)
    out, aliases = enrich_offline(drugs, reference)
    got = {r.canonical_name: r for r in out.collect()}
    assert got["aa"].pubchem_cid == "2" and got["aa"].atc_code == "" and got["b+a"].pubchem_cid == "9" and got["b+a"].atc_code == "J01AA02" and got["zz"].loinc_codes == ""
    assert rows(aliases) == {("aa", "synonym", "x"), ("aa", "synonym", "y"), ("b+a", "source_name", "A/B"), ("b+a", "abbreviation", "ab")}
    codes = spark.createDataFrame([(0, "AA", "D01AA01"), (1, "aa", "J01AA01")], "line_no long, name string, atc_code string")
    assert rows(name_to_code(codes)) == {("aa", "J01AA01")}
    landed = spark.createDataFrame([("aa", "C1", "K", "5", "")], "canonical_name string, chebi_id string, inchikey string, pubchem_cid string, atc_code string")
    done = enrich_landed(drugs, landed, codes)
    assert {r.canonical_name: (r.chebi_id, r.atc_code) for r in done.collect()}["aa"] == ("C1", "J01AA01")
    assert [r.canonical_name for r in pending(drugs, landed.limit(0)).collect()] == ["aa"]
    found = spark.createDataFrame([("aa", 0, 2, "c1", "k1"), ("aa", 1, 3, "c2", "k2"), ("b", 0, 1, "c", "k")], "canonical_name string, place int, stars int, chebi_id string, inchikey string")
    assert rows(best_match(found)) == {("aa", "c2", "k2")}
    assert tuple(coverage(done).first()) == (3, 1, 1, 2, 1)


def test_ingest_twice_changes_nothing(spark, tmp_path):
    paths = {
        "RESFINDER": put(tmp_path, "r.fsa", ">demC_1_AB000001 \nATGAAATAA\n>demD_1_AB000002\nATGCCC\n"),
        "CARD": put(tmp_path, "c.fsa", ">gb|XX000001.1|+|1-9|ARO:9|demC-1 [T e] \nATGAAATAA\n>gb|XX000002|+|1-9|ARO:8|demE [T e]\natgaaa\n"),
        "NCBI": str(tmp_path / "absent.fna"),
    }
    index = put(tmp_path, "i.tsv", "DNA Accession\tProtein Accession\tARO Accession\tARO Name\tModel Name\tCARD Short Name\tCVTERM ID\tModel ID\tModel Sequence ID\tAMR Gene Family\tResistance Mechanism\tDrug Class\n" + "\t".join(["XX000001.1", "P", "ARO:9", "n", "m", "s", "1", "2", "3", "fam", "mech", "klass one"]) + "\n")
    pheno = put(tmp_path, "p.txt", "Gene_accession no.\tClass\tPhenotype\tPMID\tMechanism of resistance\tNotes\tRequired_gene\ndemC_1_AB000001\tPen\tph\t1\tmech\tn\t\n")
    tables = ingest(spark, paths, card_index=index, phenotypes=pheno)
    genes = {r.original_header: r for r in tables["gene"].collect()}
    assert len(genes) == 4 and genes["demC_1_AB000001 "].drug_class == "Pen" and genes["gb|XX000001.1|+|1-9|ARO:9|demC-1 [T e] "].gene_family == "fam"
    store = Store(spark, str(tmp_path / "db"))
    names = ("gene", "sequence", "cluster", "sequence_metadata", "protein")
    held = []
    for _ in range(2):
        store_ingest(store, ingest(spark, paths, card_index=index, phenotypes=pheno))
        store_proteins(store)
        held.append({n: rows(store.read(n)) for n in names})
    assert held[0] == held[1]
    assert [len(held[1][t]) for t in names] == [4, 3, 3, 4, 2]
    assert validate(store).count() == 0
    # another source with one known and one new sequence: known ids stay, new ones follow
    more = {"NCBI": put(tmp_path, "n.fna", ">YY000001.1:1-9 x\nATGAAATAA\n>YY000002.1:1-9 y\nATGGGGTAA\n")}
    store_ingest(store, ingest(spark, more))
    store_proteins(store)
    after = {n: rows(store.read(n)) for n in names}
    assert all(after[n] >= held[1][n] for n in ("cluster", "protein", "gene", "sequence"))
    assert sorted(r.cluster_id for r in store.read("cluster").collect()) == [f"CLU00000{i}" for i in range(1, 5)]
    assert sorted(r.gene_id for r in store.read("gene").collect()) == list(range(1, 7))
    assert len({(r.jrc_id, r.cluster_id) for r in store.read("gene").collect()}) == 4 and validate(store).count() == 0
    assert all(r.loaded_at is not None for r in store.read("gene").collect())
    m = mapping(spark)
    store.put("drug_class", m.withColumn("ncbi_alias", F.col("ncbi_alias")))
    store.put("card_gene_class", spark.createDataFrame([("ARO:9", "klass two")], "aro_accession string, canonical_class string"))
    store.put("gene_drug_link", spark.createDataFrame([], "gene_name string, canonical_class_token string, canonical_drug_token string"))
    store.put("drug", spark.createDataFrame([], "canonical_name string"))
    store_links(store)
    got = {(r.canonical_class, r.evidence_sources) for r in store.read("sequence_drug_class").collect()}
    assert got == {("klass two", "CARD"), ("klass one", "RESFINDER")}
    export(store.read("gene").select("gene_name", "pmid"), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
    assert "demE\tNULL" in text


def test_streams(spark, tmp_path):
    folder, schema = tmp_path / "in", "k int, v string, at timestamp"
    store = Store(spark, str(tmp_path / "db"))
    make = lambda data: spark.createDataFrame(data, "k int, v string").withColumn("at", F.lit("2022-01-01").cast("timestamp"))
    make([(1, "a"), (2, "b")]).write.parquet(str(folder))
    for data in ([], [(2, "B"), (3, "c")]):
        if data:
            make(data).write.mode("append").parquet(str(folder))
        merge_stream(watch_parquet(spark, str(folder), schema), store, "t", ["k"], str(tmp_path / "cp")).awaitTermination()
    assert {(r.k, r.v) for r in store.read("t").collect()} == {(1, "a"), (2, "B"), (3, "c")}
    counts = windowed_counts(watch_parquet(spark, str(folder), schema), "at", "v")
    counts.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("counts").count() == 4


def test_every_query_has_its_sql():
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)
    assert set(driver_queries.ORACLES) == set(driver_queries.QUERIES)
    assert {"p1_found", "p2_found", "p4_found", "p7_found"} <= set(data_problems.ORACLES)


def test_command_line(spark, tmp_path, capsys):
    fasta = put(tmp_path, "r.fsa", ">demC_1_AB000001\nATGAAATAA\n>demD_1_AB000002\nATGCCC\n")
    folder = tmp_path / "words"
    folder.mkdir()
    put(folder, "drug_class.tsv", "canonical_name\tresfinder_alias\nklass one\tPen\n")
    at = ["--store", str(tmp_path / "db")]
    main(["ingest", *at, "--resfinder", fasta, "--vocabulary", str(folder), "--dry-run"])
    assert "|gene" in capsys.readouterr().out and not (tmp_path / "db").exists()
    main(["ingest", *at, "--resfinder", fasta, "--vocabulary", str(folder)])
    main(["proteins", *at])
    main(["validate", *at])
    main(["export", *at, "--table", "protein", "-o", str(tmp_path / "out"), "--null", "empty"])
    store = Store(spark, str(tmp_path / "db"))
    assert store.names() == ["cluster", "drug_class", "gene", "protein", "sequence", "sequence_metadata"] and store.read("protein").count() == 2
    assert "protein_md5" in "".join(p.read_text() for p in (tmp_path / "out").glob("part*"))
