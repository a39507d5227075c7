import itertools
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandwork.functions.codes import clean_list, combination_key, dotted_version, last_leaf_code, sort_codes_text
from strandwork.functions.codon import AMINO, BASES, STARTS, STOPS, translate, translate_batch
from strandwork.functions.headers import card_fields, ncbi_accession, resfinder_fields, versionless
from strandwork.functions.ids import content_id, number_rows, padded_id
from strandwork.functions.text import filled, first_filled, ontology_key, protein_key, split_clean, split_literal, squeeze
from strandwork.plans.vocabulary import context_of, normalise


def one(spark, column, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def test_filled_knows_stand_ins(spark):
    assert one(spark, filled, " NA ", "n/a", "None", "?", "--", "", " \t", None, "not available", "x.", " a ") == [None] * 9 + ["x.", "a"]


def test_keys(spark):
    got = one(spark, ontology_key, "ARO:12", "aro:12 ", "ARO_12", "\tARO: 12 ! remark 7", "12", "unknown", "ARO:", None)
    assert got == ["12"] * 5 + [None, "ARO:", None]
    assert one(spark, protein_key, " prt1 ", "NULL") == ["PRT1", None]


def test_normalise(spark):
    assert one(spark, normalise, "  Amoxycillin ", "RIFAMPIN", "Methicillin", "A   b") == ["amoxicillin", "rifampicin", "meticillin", "a b"]
    assert one(spark, squeeze, " a \n b ") == ["a b"]


def test_splits(spark):
    assert one(spark, lambda c: split_literal(c, "|"), "a|b", "") == [["a", "b"], []]
    assert one(spark, lambda c: split_clean(c, "/", True), "A/ B//") == [["a", "b"]]


def test_codes(spark):
    assert one(spark, sort_codes_text, "D01AA01,QJ01AA01,J01AA01,NA,J01AA01", "NA") == ["J01AA01,QJ01AA01,D01AA01", ""]
    assert one(spark, clean_list, "1-1, NA,2-2,1-1") == ["1-1,2-2"]
    keys = one(spark, combination_key, "b + A/c&a", "c/a/b", "a")
    assert keys[0] == keys[1] and keys[2] is None
    assert one(spark, last_leaf_code, "x J01AA01 y QJ01AA02", "none") == ["QJ01AA02", None]
    assert one(spark, dotted_version, "1.2.3") == [1002003]


def test_contexts(spark):
    assert one(spark, context_of, "bleomycin", "tazobactam", "tylosin", "isoniazid", "x") == ["non_therapeutic", "inhibitor", "veterinary", "antituberculosis", "clinical"]


RESFINDER = [
    ("demC_1_AB000001", "AB000001", "demC_1", "demC"),
    ("demC_1_M12345", "M12345", "demC_1", "demC"),
    ("demC_1_AB000001.2", "AB000001.2", "demC_1", "demC"),
    ("demC_2_NG_050001", "NG_050001", "demC_2", "demC"),
    ("demC_1_NZ_CP000001", "CP000001", "demC_1_NZ", "demC"),
    ("demC_AB00001_x", "AB00001", "demC", "demC"),
    ("demC_1_ABCD01000001", "ABCD01000001", "demC_1", "demC"),
    ("demC", "demC", "", "demC"),
]


def test_resfinder_headers(spark):
    got = one(spark, resfinder_fields, *[r[0] for r in RESFINDER])
    assert [tuple(g) for g in got] == [r[1:] for r in RESFINDER]
    strict = one(spark, lambda c: resfinder_fields(c, True), "demC_1_AB000001 ")[0]
    assert strict.source_acc == "AB000001 "


def test_other_headers(spark):
    got = one(spark, card_fields, "gb|XX000001.1|+|10-99|ARO:9000001|demA-1 [Testus exemplum] ", "gb|XX000001.1|+|10-99|9000001|demA-1", "gb|AAA00001.1|ARO:9000001|demA-1 [T e]")
    assert tuple(got[0]) == ("XX000001.1", "ARO:9000001", "demA-1")
    assert tuple(got[1]) == ("XX000001.1", None, "demA-1")
    assert tuple(got[2]) == ("AAA00001.1", None, None)
    assert one(spark, ncbi_accession, "NG_000001.1:101-637 Product demB", "NZ_CP000001.1:c1234-567 x") == ["NG_000001.1", "NZ_CP000001.1"]
    assert one(spark, versionless, "A.1", "A") == ["A", "A"]


VECTORS = {
    "ATGAAATAA": "MK", "ATGAAA": "MK", "atgaaa": "MK", "GTGAAA": "MK", "TTGAAA": "MK", "CTGAAA": "MK", "ATTAAA": "MK", "ATCAAA": "MK", "ATAAAA": "MK",
    "AAAGTG": "KV", "ATGTAAAAA": None, "ATGAAATAATAA": None, "TAATAA": None, "TAA": None, "": None, "ATGAA": None, "AATAA": None, "ATGNAA": None, "ATGUAA": None,
}


def test_codon_vectors(spark):
    assert one(spark, translate, *VECTORS, None) == [*VECTORS.values(), None]


def test_codons_against_plain_translation():
    table = {"".join(c): a for c, a in zip(itertools.product(BASES, repeat=3), AMINO)}

    def plain(s):
        s = s[:-3] if s[-3:] in STOPS else s
        if not s or len(s) % 3:
            return None
        out = [table.get(s[i : i + 3], "*") for i in range(0, len(s), 3)]
        if s[:3] in STARTS:
            out[0] = "M"
        return None if "*" in out else "".join(out)

    rng = random.Random(1)
    texts = ["".join(rng.choices("ACGTN", (30, 30, 30, 30, 1), k=rng.randrange(0, 40))) for _ in range(500)]
    assert translate_batch(pd.Series(texts)).tolist() == [plain(t) for t in texts]


def test_ids(spark):
    assert one(spark, lambda c: content_id(c, "X"), "acgt") == one(spark, lambda c: content_id(c, "X"), "ACGT")
    assert one(spark, lambda c: padded_id(c, "C"), "7") == ["C000007"]
    rows = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("h"))
    got = [r.n for r in number_rows(rows, "h", 2).orderBy("h").collect()]
    assert got == list(range(1, 501))


@pytest.mark.parametrize("a,b,want", [("", "b", "b"), (None, "b", "b"), ("a", "b", "a"), (None, "", None)])
def test_first_filled(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(first_filled(F.col("a"), F.col("b"))).first()[0] == want
