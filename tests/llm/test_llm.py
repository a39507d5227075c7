import datetime
import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa

import pytest
from pyspark.sql import functions as F

from strandwork.llm import neardup, sentences
from strandwork.llm.canonical import UNMATCHED, build_dictionaries, build_dictionary, canonicalise, distance, report
from strandwork.llm.mixing import Mixture
from strandwork.llm.neardup import EDITS, NearDuplicates, _pack, _unpack, edit_distance, moved_distance, parse_distance, radius, signatures, within_reach
from strandwork.llm.packing import fill_report, length_buckets, pack, plan_batches
from strandwork.llm.sentences import split_sentences, split_text, train, units
from strandwork.llm.survivorship import DESCRIPTIVE, cluster_survivors, golden_records, protein_survivors
from strandwork.llm.tokens import count_tokens


def rows(df):
    return {tuple(r) for r in df.collect()}


# survivors


def genes(spark, data):
    cols = ["cluster_id", "gene_id", "source", "original_header", "loaded_at", *DESCRIPTIVE]
    schema = ", ".join(f"{c} {'long' if c == 'gene_id' else 'timestamp' if c == 'loaded_at' else 'string'}" for c in cols)
    full = [[d.get(c) for c in cols] for d in data]
    return spark.createDataFrame(full, schema)


def test_survivors(spark):
    day = lambda n: datetime.datetime(2022, 1, n)
    data = [
        dict(cluster_id="a", gene_id=1, pmid="1", original_header="x", loaded_at=day(1), source="NCBI", notes="late"),
        dict(cluster_id="a", gene_id=2, pmid="NA", notes="n", original_header="xxxx", loaded_at=day(2), source="CARD"),
        dict(cluster_id="b", gene_id=3, original_header=" a   b ", loaded_at=day(1)), dict(cluster_id="b", gene_id=4, original_header="abc", loaded_at=day(1)),
        dict(cluster_id="b", gene_id=5, original_header="abc", loaded_at=None), dict(cluster_id="c", gene_id=6), dict(cluster_id=None, gene_id=7), dict(cluster_id=None, gene_id=8),
        dict(cluster_id="d", gene_id=9), dict(cluster_id="d", gene_id=9),
    ]
    df = genes(spark, data)
    assert rows(cluster_survivors(df)) == {("a", "1"), ("b", "3"), ("d", "9")}
    gold = {r.cluster_id: r for r in golden_records(df, "cluster_id", ["pmid", "notes"]).collect()}
    assert (gold["a"].pmid, gold["a"].notes, gold["a"].n_rows) == ("1", "n", 2) and gold["c"].pmid is None and None not in gold
    assert cluster_survivors(df.limit(0)).count() == 0


def test_protein_survivors(spark):
    seq = spark.createDataFrame([("j1", "ACG", "p1"), ("j2", "TTT", " P1 "), ("j3", None, "P1"), ("j4", "A", "p2"), ("j5", "A", "NA"), ("j6", "AAAA", "gone"), ("j7", "A", "gone")], "jrc_id string, sequence string, protein_id string")
    prot = spark.createDataFrame([("P1", "clash"), ("p2", "x"), (None, "y"), ("P1", "again")], "protein_id string, sequence string")
    assert rows(protein_survivors(seq, prot)) == {("P1", "j2")}


# near-duplicates


def edited(rng, s, edits, move=False):
    s = list(s)
    for _ in range(edits):
        i = rng.randrange(len(s))
        kind = rng.randrange(3)
        if kind == 0:
            s[i] = rng.choice("ACGT")
        elif kind == 1:
            s.insert(i, rng.choice("ACGT"))
        else:
            del s[i]
    if move:
        n = len(s)
        i, k = rng.randrange(n // 4), n // 5
        block = s[i : i + k]
        del s[i : i + k]
        j = rng.randrange(n // 2, len(s))
        s[j:j] = block
    return "".join(s)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_is_exact():
    rng = random.Random(1)
    for _ in range(200):
        a = "".join(rng.choices("ACGT", k=rng.randrange(0, 40)))
        b = edited(rng, a, rng.randrange(0, 9)) if len(a) > 12 and rng.random() < 0.7 else "".join(rng.choices("ACGT", k=rng.randrange(0, 40)))
        assert edit_distance(a.encode(), b.encode()) == plain_distance(a, b)
        assert moved_distance(a.encode(), b.encode(), 50) >= 0


def test_pack_and_radius():
    rng = random.Random(2)
    for n in (1, 2, 3, 4, 5, 700):
        for extra in ("", "N"):
            t = ("".join(rng.choices("ACGT", k=n)) + extra).encode()
            assert _unpack(_pack(t)) == t
    for _ in range(200):
        a = "".join(rng.choices("ACGT", k=rng.randrange(150, 900)))
        b = edited(rng, a, int(EDITS * len(a)) - 8, rng.random() < 0.5)
        x, y = signatures([a.encode(), b.encode()])
        assert np.bitwise_count(x ^ y).sum() <= radius(np.array([max(len(a), len(b))]))[0]


def test_moved_blocks_count_once():
    rng = random.Random(3)
    hits = 0
    for _ in range(100):
        a = "".join(rng.choices("ACGT", k=rng.randrange(250, 900)))
        b = edited(rng, a, len(a) // 50, move=True)
        hits += within_reach(a.encode(), b.encode()) and within_reach(b.encode(), a.encode())
        far = edited(rng, a, len(a) // 4)
        assert not within_reach(a.encode(), far.encode())
    assert hits == 100


def test_many_small_moved_blocks():
    """Three blocks of 15 to 40 letters moved, with edits in and between them."""
    rng = random.Random(17)
    for _ in range(60):
        a = "".join(rng.choices("ACGT", k=rng.randrange(400, 900)))
        t = a
        for _ in range(3):
            i, k = rng.randrange(len(t) - 40), rng.randrange(15, 40)
            block, rest = t[i : i + k], t[:i] + t[i + k :]
            j = rng.randrange(len(rest))
            t = rest[:j] + block + rest[j:]
        b = edited(rng, t, len(a) // 100).encode()
        most = int(EDITS * max(len(a), len(b)))
        assert min(parse_distance(a.encode(), b, most), parse_distance(b, a.encode(), most)) <= most
        far = "".join(rng.choices("ACGT", k=len(a))).encode()
        assert parse_distance(a.encode(), far, most) > most
    assert parse_distance(b"ACGT", b"ACGT", 1) == 0


def collection(rng, n):
    base = ["".join(rng.choices("ACGT", k=rng.randrange(40, 700))) for _ in range(n)]
    out = {f"k{i:03}": s for i, s in enumerate(base)}
    for i in range(n // 2):
        s = base[rng.randrange(n)]
        out[f"e{i:03}"] = edited(rng, s, max(0, len(s) // 60), i % 4 == 0 and len(s) > 200)
    return out


def brute(texts):
    keys = sorted(texts)
    enc = {k: texts[k].upper().encode() for k in keys}
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if enc[a] != enc[b] and within_reach(enc[a], enc[b])}


def test_pairs_against_all_pairs(spark):
    texts = collection(random.Random(4), 120)
    data = [(k, v if i % 3 else v.lower(), "clash") for i, (k, v) in enumerate(texts.items())]
    copies = [("z1", texts["k000"], ""), ("z2", texts["k000"].lower(), ""), (None, texts["k001"], ""), ("n", None, ""), ("m", "", ""), data[0]]
    df = spark.createDataFrame(data + copies, "key string, seq string, id string")
    got = rows(NearDuplicates(df, "key", "seq").pairs())
    groups = defaultdict(set)
    for k, v, _ in data + copies:
        if k and v:
            groups[v.upper()].add(k)
    stars = {(min(g), k) for g in groups.values() for k in g if k != min(g)}
    between = brute({min(g): t for t, g in groups.items()})
    assert {("k000", "z1"), ("k000", "z2")} <= stars and got == between | stars
    assert NearDuplicates(df.limit(0), "key", "seq").pairs().count() == 0


def test_no_pair_is_left_to_chance(spark):
    """Pairs with 5 to 8 % of edits, at random and at even distances, of which no long word may be left."""
    rng = random.Random(10)
    texts, want = {}, set()
    for i in range(240):
        s = "".join(rng.choices("ACGT", k=rng.randrange(200, 1300)))
        if i % 2:
            t = "".join("ACGT"["ACGT".index(c) - 1] if k % 13 == 6 else c for k, c in enumerate(s))
        else:
            t = edited(rng, s, int(len(s) * rng.choice([0.05, 0.06, 0.07, 0.078])))
        texts |= {f"a{i:03}": s, f"b{i:03}": t}
        if within_reach(s.encode(), t.encode()):
            want.add((f"a{i:03}", f"b{i:03}"))
    assert len(want) == 240
    near = NearDuplicates(spark.createDataFrame(list(texts.items()), "key string, seq string"), "key", "seq")
    assert rows(near.pairs()) == want


def test_letters_other_than_acgt(spark):
    """Texts with another letter in every long word are compared like others."""
    rng = random.Random(13)
    texts = {}
    for i in range(20):
        s = "".join(rng.choice("NRY") if k % 10 == 3 else rng.choice("ACGT") for k in range(400))
        texts |= {f"a{i:02}": s, f"b{i:02}": edited(rng, s, 4)}
    near = NearDuplicates(spark.createDataFrame(list(texts.items()), "key string, seq string"), "key", "seq")
    want = {(f"a{i:02}", f"b{i:02}") for i in range(20)}
    assert rows(near.pairs()) == want


def test_tiles_of_the_whole_collection(spark, monkeypatch):
    rng = random.Random(11)
    x = ["".join(rng.choices("ACGT", k=rng.randrange(900, 1400))).encode() for _ in range(60)]
    x += [edited(rng, t.decode(), len(t) // 15).encode() for t in x[:30]]
    x.sort(key=len)
    want = {(i, j) for i in range(90) for j in range(i + 1, 90) if within_reach(x[i], x[j])}
    assert len(want) == 30
    for letters in (6, 7, 8):
        monkeypatch.setattr(neardup, "LETTERS_UP_TO", ((10**6, letters),))
        monkeypatch.setattr(neardup, "CELLS", 4**letters * 16)
        whole = {(int(i), int(j)) for a, b in neardup._near_cells(x, x, True) for i, j in zip(a, b)}
        halves = {(int(i), int(j) + 40) for a, b in neardup._near_cells(x[:40], x[40:], False) for i, j in zip(a, b)}
        assert want <= whole and {p for p in want if p[0] < 40 <= p[1]} <= halves
    parts = [pd.DataFrame({"part": 2, "id": np.arange(k, k + 7), "n": 300}) for k in range(0, 21, 7)]
    monkeypatch.setattr(neardup, "TILE", 5)
    out = pd.concat(neardup._number_tiles(iter(parts)))
    assert out.id.tolist() == list(range(21)) and (out.tile - (2 << 32)).tolist() == [i // 5 for i in range(21)]


def moved(rng, s, edits, moves):
    for _ in range(moves):
        i, k = rng.randrange(len(s) - 40), rng.randrange(15, 40)
        block, rest = s[i : i + k], s[:i] + s[i + k :]
        j = rng.randrange(len(rest))
        s = rest[:j] + block + rest[j:]
    return edited(rng, s, edits)


def test_pieces_miss_no_pair(monkeypatch):
    """Pairs at the limit, with moved blocks, of all lengths, in one tile and over two; long runs of one letter; splits of the counting."""
    rng = random.Random(21)
    texts, planted = [b"A" * 400, b"A" * 390, b"A" * 380 + b"C" * 10], []
    for n in range(120, 2300, 31):
        s = "".join(rng.choices("ACGTN" if n % 2 else "ACGT", k=n))
        most, moves = int(EDITS * n), rng.randrange(9)
        t = moved(rng, s, max(0, most - moves - n // 100), moves)
        assert neardup.breaks(s.encode(), t.encode()) <= neardup.damage(n) >= neardup.breaks(t.encode(), s.encode())
        planted.append((s.encode(), t.encode()))
        texts += planted[-1]
    texts = sorted({t for t in texts}, key=len)
    tile = lambda some: neardup.Tile(pa.array([str(i) for i in some]), np.array([len(texts[i]) for i in some], np.int32), pa.array([_pack(texts[i]) for i in some], pa.binary()))
    whole, low, high = tile(range(len(texts))), tile(range(70)), tile(range(70, len(texts)))
    assert [whole.text(i) for i in range(len(texts))] == texts and {k for _, _, k in whole.classes()} >= {0, 6, 8, 10}
    monkeypatch.setattr(neardup, "HITS", 50)
    want = {(j, i) for i in range(len(texts)) for j in range(i) if within_reach(texts[i], texts[j])} | {tuple(sorted(map(texts.index, p))) for p in planted}
    pairs = lambda index, probe: [(int(probe.keys[j]), int(index.keys[i])) for x, y in neardup._candidates(index, probe) for i, j in zip(x, y)]
    got = pairs(whole, whole)
    assert len(want) > 60 and want <= set(got) and len(got) == len(set(got))
    parts = pairs(low, low) + pairs(high, high) + pairs(high, low)
    assert sorted(parts) == sorted(got)


def test_relatives_beyond_the_limit_are_not_aligned(monkeypatch):
    rng = random.Random(22)
    s = "".join(rng.choices("ACGT", k=500))
    far = "".join(rng.choice("ACGT") if rng.random() < 0.3 else c for c in s)
    assert edit_distance(s.encode(), far.encode()) > 80 and edit_distance(s.encode(), far.encode(), 40) > 40
    monkeypatch.setattr(neardup, "moved_distance", None)
    assert not within_reach(s.encode(), far.encode(), True)
    assert neardup.greedy_distance(s.encode(), edited(rng, s, 8).encode(), 40) <= 40


def test_texts_are_not_shuffled_for_comparison(spark):
    """Tiles are read where they lie."""
    texts = collection(random.Random(23), 60)
    df = spark.createDataFrame(list(texts.items()), "key string, seq string")
    found = NearDuplicates(df, "key", "seq").representatives()
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == brute(texts)


# canonical names


@pytest.fixture(scope="module")
def names(spark):
    data = [("tumplyxquorine antibiotic", " Tumplyxquorine", "XIOXPION", "FQV"), ("hydroxytumplyxquorine antibiotic", None, None, "SCW"), ("drolraemoxamide inhibitor", "MALVUSBACTANE", None, "LSP"), (None, "x", None, None), ("giom agent", "Giomflymycane pathway blocker", "NA", None)]
    return spark.createDataFrame(data, "canonical_name string, resfinder_alias string, ncbi_alias string, card_class_abbrev string")


TYPED = {
    "TUMPLYXQUORINE": 0, "tümplýxqüörïne antibiotic": 0, "antibiotic, tumplyxquorine": 0, "tumplyx- quorine antib.": 0, "tumplyxqu0rine": 0, "tumlpyxquorine": 0, "tumplyx~": 0, "fqv": 0,
    "the tumplyxquorine class": 0, "hydroxytumplyxquorine": 1, "hydroxy~": 1, "SCW.": 1, "Malvusbactanes*": 2, "drolraemoxamide resistance": 2, "LSP": 2, "xioxpion ": 0, "giomflymycane": 3,
    "raexbaephenide agent": None, "antibiotic": None, "tetra": None, "zz": None,
}


def test_typed_names(spark, names):
    d = build_dictionary(names)
    order = ["tumplyxquorine antibiotic", "hydroxytumplyxquorine antibiotic", "drolraemoxamide inhibitor", "giom agent"]
    assert {t: d.look_up(t) for t in TYPED} == {t: UNMATCHED if i is None else order[i] for t, i in TYPED.items()}
    df = spark.createDataFrame([(1, "LSP", 'LSP; "x"'), (2, None, '"FQV"'), (3, "odd thing", ""), (3, "odd thing", "?")], "k long, a string, value string")
    got = canonicalise(df, "k", ["a", "value"], d, single=["value"])
    assert sorted(map(tuple, got.collect())) == [(1, "a", "LSP", order[2]), (2, "value", "FQV", order[0]), (3, "a", "odd thing", UNMATCHED), (3, "a", "odd thing", UNMATCHED)]
    assert rows(report(got)) == {("a", "odd thing", 2)}
    assert canonicalise(df.limit(0), "k", ["a"], d).count() == 0
    nothing = build_dictionary(names.limit(0))
    assert nothing.look_up("LSP") == UNMATCHED and nothing.look_up("long " * 5000) == UNMATCHED


def test_frequency_decides_between_equally_near_names(spark):
    data = [("bleomycin", "Bleomycin", "BLEOMYCIN", None), ("cleomycin", None, None, None), ("quaternary ammonium salt", None, None, None), ("dleomycix", "gleomycix", None, None), ("hleomycix", "kleomycix", None, None)]
    d = build_dictionary(spark.createDataFrame(data, "canonical_name string, resfinder_alias string, ncbi_alias string, card_class_abbrev string"))
    assert d.look_up("fleomycin") == "bleomycin" and d.look_up("fleomycix") == UNMATCHED
    assert d.look_up("quaternry amonium salt") == "quaternary ammonium salt" and d.look_up("quaternaryammonium salt") == "quaternary ammonium salt"


def test_a_list_in_blocks_is_one_list(spark, names):
    whole = build_dictionary(names)
    assert len(list(build_dictionaries(names, max_keys=3000))) == 4 and len(list(build_dictionaries(names))) == 1
    values = [*TYPED, "tumplyxquorinx", "giomfly"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(99, values[0])], "k long, a string")
    got = canonicalise(df, "k", ["a"], build_dictionaries(names, max_keys=3000))
    assert sorted((r.k, r.canonical_name) for r in got.collect()) == sorted([(i, whole.look_up(v)) for i, v in enumerate(values)] + [(99, whole.look_up(values[0]))])
    nothing = canonicalise(df, "k", ["a"], build_dictionaries(names.limit(0)))
    assert {r.canonical_name for r in nothing.collect()} == {UNMATCHED}


def test_weighted_distance():
    assert distance("abcd", "abcd", 3) == 0 and distance("abcd", "acbd", 3) == 0.7 and distance("abcd", "abbcd", 3) == 0.7
    assert distance("a", "abcdefgh", 2) == 3


# containers


def test_length_buckets_are_optimal():
    rng = np.random.default_rng(1)
    import itertools

    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 60), 9, False))
        counts = rng.integers(1, 9, 9)

        def padding(bounds):
            at = np.searchsorted(bounds, lengths)
            return int((counts * (np.array(bounds)[at] - lengths)).sum())

        best = min(padding(list(c) + [lengths[-1]]) for c in itertools.combinations(lengths[:-1], 3))
        assert padding(length_buckets(lengths, counts, 4)) == best


def test_plan_covers_every_rank():
    rng = np.random.default_rng(2)
    bounds, counts = np.sort(rng.choice(np.arange(1, 101), 30, False)), rng.integers(0, 50, 30)
    plan = plan_batches(bounds, counts, 100)
    for k, g in plan.groupby("bucket"):
        spans = sorted(zip(g.rank_from, g.rank_to))
        assert spans[0][0] == 0 and spans[-1][1] == counts[k] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_containers(spark):
    rng = random.Random(6)
    sizes = {i: rng.choice([rng.randrange(1, 120), rng.randrange(1, 400), 100, 250]) for i in range(1500)}
    data = [(k, v, "x") for k, v in sizes.items()] + [(9000, 0, "x"), (9001, None, "x"), (None, 50, "x"), (1, sizes[1], "x")]
    out = pack(spark.createDataFrame(data, "doc_id long, n_tokens long, part string"), capacity=200, buckets=40).collect()
    load = Counter()
    for r in out:
        load[r.container_id] += r.n_tokens
    assert max(load.values()) <= 200 and set(load) == set(range(len(load)))
    assert sum(load.values()) / (200 * len(load)) > 0.97
    parts = defaultdict(list)
    for r in out:
        parts[r.doc_id].append((r.part, r.first_token, r.n_tokens))
    for k, v in sizes.items():
        if k != 1:
            assert sorted(parts[k]) == [(i, i * 200, min(200, v - i * 200)) for i in range((v + 199) // 200)]
    assert len(parts[1]) == 2 * ((sizes[1] + 199) // 200) and 9000 not in parts and len(parts[None]) == 1
    assert pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


def test_fill_report_and_tokens(spark):
    docs = spark.createDataFrame([(1, "some words here"), (2, " \n"), (3, None), (4, "日本語 " * 3000), (1, "some words here")], "doc_id long, text string")
    sizes = count_tokens(docs, {"doc_id": F.col("doc_id")}, "text")
    got = sorted((r.doc_id, r.n_tokens) for r in sizes.collect())
    assert [g[0] for g in got] == [1, 1, 4] and got[0][1] == got[1][1] > 1 and got[2][1] > 3000
    r = fill_report(pack(sizes)).first()
    assert r.n_tokens == sum(g[1] for g in got) and r.fullest <= 2048


# mixtures


def mixture(spark, sizes, targets, **kw):
    s = spark.createDataFrame(sizes, "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    return Mixture(s, t, **kw)


def test_shares_and_repeats(spark):
    rng = random.Random(7)
    sizes = [(i, rng.choice(["Big ", "big", "BIG"]), rng.randrange(20, 300)) for i in range(3000)]
    sizes += [(10_000 + i, "small-one", rng.randrange(20, 300)) for i in range(200)] + [(20_000 + i, "other", 100) for i in range(50)] + [(30_000, "big", None), (30_001, None, 5)]
    m = mixture(spark, sizes, [("big", 0.7, 1), ("small_one", 0.3, 3), ("absent", 0.5, 2), ("none", None, 1)], block_tokens=512)
    got = {r.source: r for r in m.report().collect()}
    assert abs(got["big"].actual_share - 0.7) < 0.01 and abs(got["small_one"].actual_share - 0.3) < 0.01 and got["absent"].n_tokens == 0 and "none" not in got
    assert got["small_one"].most_uses == 3 and got["big"].most_uses == 1
    out = m.mixed().toPandas()
    assert out.groupby(["source", "doc_id"]).size().max() == 3 and not out.duplicated(["doc_id", "use"]).any()
    first = out.sort_values("slot").head(len(out) // 4)
    assert abs(first[first.source == "big"].n_tokens.sum() / first.n_tokens.sum() - 0.7) < 0.03  # also in every prefix
    order = out.sort_values(["slot", "position"])
    assert (order.groupby("slot").position.max() + 1 == order.groupby("slot").size()).all()


def test_empty_mixtures(spark):
    assert mixture(spark, [], [("a", 1.0, 1)]).mixed().count() == 0
    assert mixture(spark, [(1, "a", 5)], []).mixed().count() == 0
    one = mixture(spark, [(1, "a", 5), (2, "a", 5)], [("A", 0.2, None)])
    assert one.report().first().actual_share == 1.0 and one.report().first().most_uses == 1


# sentences

EN = ["The value of 1.94 ... was never repeated.", "See Fig. 3 and Tab. 4 for the series.", 'The note says "No hit. Check again!" beside it.', "Was it lost?!", "It grew vs. controls, i.e. in vitro.", "Samples came from pigs, hens etc.", "(The same holds here.)", "Isolates of X. dandaensis grew."]
DE = ["Die Probe vom 5. März 2001 war gut.", "Siehe Abb. 3 bzw. Tab. 7 im Anhang.", "Der Vermerk lautet: „Nicht gefunden. Bitte prüfen!“", "Manche Stoffe, z. B. Salz, fehlen."]
ZH = ["质粒长度约为613 kb！", "备注写着：“未找到。请再查！”并附上它。", "样品来自土壤等……其余没有保留。", "为什么没有？"]
EL = ["Γιατί λείπει το γονίδιο;", "Βλ. εικ. 9 και πίν. 2 στο παράρτημα.", "Η τιμή ανέβηκε από 1,2 σε 3,4."]
HI = ["नमूना क्र. 666 खो गया।", "यह क्यों नहीं है?", "मान बढ़ गया।"]
TH = ["ผลการทดลองยังไม่แน่นอน", "ดูรูปที่ 2 และตารางที่ 4 ในภาคผนวก", "ยีน abc ทำให้ดื้อยา"]
LANGUAGES = [(EN, " "), (DE, " "), (ZH, ""), (EL, " "), (HI, " "), (TH, " ")]


def corpus(rng, n):
    docs, truth = [], []
    for i in range(n):
        text, spans = "", []
        for _ in range(rng.randrange(1, 4)):
            sentences, gap = rng.choice(LANGUAGES)
            if rng.random() < 0.3:
                spans.append((len(text), len(text) + 7))
                text += "Notes 1\n\n"
            for k in range(rng.randrange(1, 7)):
                s = rng.choice(sentences)
                if k:
                    text += gap
                spans.append((len(text), len(text) + len(s)))
                text += s
            if rng.random() < 0.3:
                for k in range(1, 4):
                    text += "\n"
                    spans.append((len(text), len(text) + len(f"{k}. item. Two {k}")))
                    text += f"{k}. item. Two {k}"
            text += "\n \n" if rng.random() < 0.3 else "\r\n\r\n"
        docs.append((i, text))
        truth.append(spans)
    return docs, truth


def score(got, truth):
    a = {(i, s) for i, x in enumerate(got) for s in x}
    b = {(i, s) for i, x in enumerate(truth) for s in x}
    return len(a & b) / len(a), len(a & b) / len(b)


def test_sentences_on_held_out_texts(spark):
    docs, _ = corpus(random.Random(8), 500)
    model = train(spark.createDataFrame(docs, "doc_id long, text string"))
    held, truth = corpus(random.Random(9), 200)
    precision, recall = score([split_text(t, model) for _, t in held], truth)
    assert precision > 0.98 and recall > 0.98


def test_scripts_without_marks(spark):
    """Sentences that only a capital letter begins, in a script whose texts have no marks, beside one whose texts have."""
    rng = random.Random(21)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randrange(3, 8)))
    sentence = lambda letters: " ".join([word(letters).capitalize(), *[word(letters) for _ in range(rng.randrange(4, 9))]])
    docs, truth = [], []
    for i in range(300):
        marked = i % 2
        parts = [sentence("abcdefghilmnorst" if marked else "абвгдежзиклмнорст") + ("." if marked else "") for _ in range(rng.randrange(3, 7))]
        docs.append((i, "Heading Of It\n\n" * marked + " ".join(parts)))
        at, spans = 15 * marked, [(0, 13)] * marked
        for p in parts:
            spans.append((at, at + len(p)))
            at += len(p) + 1
        truth.append(spans)
    model = train(spark.createDataFrame(docs[:200], "doc_id long, text string"))
    precision, recall = score([split_text(t, model) for _, t in docs[200:]], truth[200:])
    assert precision > 0.98 and recall > 0.98


def test_model_counts_every_pair_of_contexts(spark, monkeypatch):
    """A mark after one word before many different words: each pair is rare, the word is not."""
    rng = random.Random(12)
    names = ["".join(rng.choices("abcdefghij", k=6)).capitalize() for _ in range(400)]
    docs = [(i, f"The value rose in strain {x} again. It was seen by kmx. {x} as well. Then nothing more was seen here.") for i, x in enumerate(names * 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(sentences, "LEAST", 2)
    whole = train(df)
    monkeypatch.setattr(sentences, "MAX_CELLS", 3, raising=False)
    again = train(df.repartition(7))
    assert again.ends == whole.ends and again.starts == whole.starts and again.share == whole.share
    assert {x for x in whole.words_before if x != "<s>"} - {"here ."} <= set(whole.ends) and set(names) <= set(whole.starts)
    # the same rounds over all events in one place
    b, a, n = [], [], []
    for (x, y), k in Counter((s[2], s[4]) for _, t in docs for s in sentences.Unit(t, 0, len(t)).spots).items():
        b.append(x), a.append(y), n.append(k)

    def expected(end, start, share):
        e, s = dict(zip(before.name, end)), dict(zip(after.name, start))
        odds = [e[x] / (1 - e[x]) * s[y] / (1 - s[y]) * (1 - share) / share for x, y in zip(b, a)]
        stay = pd.DataFrame({"b": b, "a": a, "p": [k * o / (1 + o) for k, o in zip(n, odds)]})
        return stay.groupby("b").p.sum()[before.name].to_numpy(), stay.groupby("a").p.sum()[after.name].to_numpy()

    cells = pd.DataFrame({"b": b, "a": a, "n": n})
    before, after = (cells.groupby(c).n.sum().rename_axis("name").reset_index().assign(sure=0) for c in ("b", "a"))
    after.loc[after.name == "The", "sure"] = len(docs)
    plain = sentences.BoundaryModel.fit(before, after, dict.fromkeys(before.name, ""), dict.fromkeys(after.name, ""), expected)
    assert plain.ends == pytest.approx(whole.ends, abs=1e-4) and plain.starts == pytest.approx(whole.starts, abs=1e-4)


def test_rare_listed_abbreviations(spark):
    """An abbreviation of the list that is too rare to be counted is not taken for any lower-case word."""
    rare = ["".join(random.Random(i).choices("bcdfgklm", k=7)) for i in range(300)]
    docs = [(i, f"It was seen here. The value rose again. More was {x}. The series was {x[::-1]}.\n\nThe strain was {x[1:]}.\n\nThe series was {x[2:]}.") for i, x in enumerate(rare)]
    model = train(spark.createDataFrame(docs, "doc_id long, text string"))
    text = "It grew in min. The value rose approx. The series ended here."
    assert model.ends["<Ll> ."] > 0.5 and not {"min .", "approx ."} & model.words_before
    assert split_text(text, model) == [(0, len(text))]


def test_sentences_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, " \n ", "c"), (3, "no mark at all", "c"), (4, "One. " * 4000, "c"), (3, "no mark at all", "c"), (5, "...!?", "c"), (6, '"open (never closed. Yes', "c")], "doc_id long, text string, start_pos string")
    model = train(docs)
    got = split_sentences(docs, "doc_id", "text", model).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.start_pos, r.end_pos))
    assert 1 not in by and 2 not in by and by[3] == [(1, 14)] * 2 and by[5] == [(1, 5)]
    empty = docs.limit(0)
    assert split_sentences(empty, "doc_id", "text", train(empty)).count() == 0
    for _, text in ((r.doc_id, r.text) for r in docs.collect() if r.text):
        spans = split_text(text, model)
        left = list(text)
        for s, e in spans:
            left[s:e] = " " * (e - s)
        assert not "".join(left).strip()  # nothing but blanks is outside of sentences


def test_units():
    text = "Head\n\nA line\ngoes on.\n- one\n- two\n\n1. x\n2. y\nday\n7. not an item"
    assert [text[s:e] for s, e, _ in units(text)] == ["Head", "A line\ngoes on.", "- one", "- two", "1. x", "2. y\nday\n7. not an item"]


def test_pieces_of_two_lengths_meet_few_texts_by_chance():
    """No more pieces are cut than must be, so they are as long as can be."""
    for n in range(230, 2300, 7):
        k = neardup.piece(n)
        price, long, short, need = neardup._cut(n, k)
        assert long + short == neardup.damage(n) + need and long * k + short * (k - 1) <= n and price == neardup._price(n, k)
    assert neardup._price(534, neardup.piece(534)) < 2.5 and neardup._price(900, neardup.piece(900)) < 1.2


def test_breaks_of_many_pairs_are_counted_together(monkeypatch):
    rng = random.Random(24)
    pairs = []
    for i in range(160):
        s = "".join(rng.choices("ACGTN" if i % 5 == 0 else "ACGT", k=rng.choice([1, 31, 63, 64, 65, 128, rng.randrange(100, 900)])))
        t = edited(rng, s, int(len(s) * rng.choice([0, 0.09, 0.2, 0.3, 0.4])))
        pairs.append((s.encode(), (t[60:100] + t[:60] + t[100:] or "A").encode()))
    want = [neardup.breaks(a, b) <= neardup.damage(max(len(a), len(b))) for a, b in pairs]
    assert 20 < sum(want) < 150
    for cells in (1, 64, 2**13):
        monkeypatch.setattr(neardup, "BREAK_CELLS", cells)
        assert neardup.few_breaks(pairs).tolist() == want
    pairs = [(a, b) for a, b in pairs if abs(len(a) - len(b)) <= int(EDITS * max(len(a), len(b)))][:60]
    assert neardup.all_within_reach(pairs).tolist() == [within_reach(a, b, True) for a, b in pairs]


def test_texts_are_packed_once(spark, monkeypatch):
    """The ranges of lengths need no sample of packed texts; equal texts share a tile, and no tile spans two ranges."""
    texts = collection(random.Random(25), 60)
    df = spark.createDataFrame([*texts.items(), *((f"z{k}", s) for k, s in texts.items())], "key string, seq string")
    plans, materialise = [], neardup.materialise
    monkeypatch.setattr(neardup, "materialise", lambda df, *a, **k: plans.append(df._jdf.queryExecution().executedPlan().toString()) or materialise(df, *a, **k))
    tiles = NearDuplicates(df, "key", "seq").tiles()
    assert len(plans) == 1 and "rangepartitioning" not in plans[0] and tiles.count() == len(set(texts.values()))
    spans = sorted((r.low, r.high) for r in tiles.groupBy("tile").agg({"n": "min"}).withColumnRenamed("min(n)", "low").join(tiles.groupBy("tile").agg({"n": "max"}).withColumnRenamed("max(n)", "high"), "tile").collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    monkeypatch.setattr(neardup, "TILE", 5)
    out = pd.concat(neardup._number_tiles(iter([pd.DataFrame({"part": [1] * 7, "id": range(7)}), pd.DataFrame({"part": [1, 1, 4, 4], "id": range(4)})])))
    assert out.tile.tolist() == [1 << 32] * 5 + [(1 << 32) + 1] * 4 + [4 << 32] * 2
