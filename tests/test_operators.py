import datetime
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandwork.operators.ancestry import first_ancestor
from strandwork.operators.badrows import assemble_records, bad_headers, good_rows, header_reason, parse_record, parse_records, read_delimited
from strandwork.operators.components import connected_classes
from strandwork.operators.hierarchy import Hierarchy
from strandwork.operators.reachable import reachable
from strandwork.operators.merge import insert_ignore, update_column, upsert, violations
from strandwork.operators.multivalue import _sequential, explode_packed, split_column
from strandwork.operators.orphans import Bits, Link, orphan_references
from strandwork.operators.relational import any_key_join, best_per_group, join_distinct, tiered_lookup
from strandwork.plans.store import Store


def day(n):
    return datetime.datetime(2022, 1, 1) + datetime.timedelta(days=n)


def rows(df):
    return {tuple(r) for r in df.collect()}


# orphans


def test_bits_agree_with_sets():
    rng = np.random.default_rng(1)
    for n, m in ((10, 20), (5000, 30), (30, 6000), (9000, 8000), (0, 5)):
        a, b = rng.choice(65536, n, False), rng.choice(65536, m, False)
        assert set(Bits(a).and_not(Bits(b)).tolist()) == set(a.tolist()) - set(b.tolist())
        assert set(Bits(a).and_not(None).tolist()) == set(a.tolist())


def link(child, parent, withdrawn=None):
    return Link("t", child, F.col("id"), F.col("key"), F.col("at"), parent, F.col("key"), F.col("at"), withdrawn)


def test_orphans_against_plain_search(spark):
    rng = random.Random(3)
    child = [(str(i), rng.choice([None, *"abcdefgh"]), rng.choice([None, day(rng.randrange(90))])) for i in range(300)]
    child += [(f"hot{i}", "a", day(i % 90)) for i in range(200)] + child[:5]
    parent = [(k, rng.choice([None, day(rng.randrange(90))]), k == "d", "x") for k in "abcdef" for _ in range(2)]
    c = spark.createDataFrame(child, "id string, key string, at timestamp")
    p = spark.createDataFrame(parent, "key string, at timestamp, gone boolean, id string")
    got = orphan_references([link(c, p, F.col("gone"))])
    first, gone = {}, {}
    for k, at, g, _ in parent:
        first[k] = min((x for x in (first.get(k), at) if x), default=None)
        gone[k] = g
    want = []
    for i, k, at in child:
        if k is None:
            continue
        if k not in first:
            want.append((i, "missing"))
        elif gone[k]:
            want.append((i, "withdrawn"))
        elif first[k] and at and first[k] > at:
            want.append((i, "later"))
    assert sorted((r.row_key, r.reason) for r in got.collect()) == sorted(want)


def test_orphans_of_empty_tables(spark):
    empty = spark.createDataFrame([], "id string, key string, at timestamp")
    some = spark.createDataFrame([("1", "a", day(0))], "id string, key string, at timestamp")
    assert orphan_references([link(empty, some)]).count() == 0
    assert [r.reason for r in orphan_references([link(some, empty)]).collect()] == ["missing"]


# hierarchies


def graph(spark, edges, nodes=()):
    names = {x for e in edges for x in e if x} | set(nodes)
    n = spark.createDataFrame([(x, "clash") for x in names], "id string, parent string")
    return Hierarchy(n, spark.createDataFrame([(*e, "clash") for e in edges], "id string, parent string, root_id string"))


def plain_reach(edges):
    up = {}
    for a, b in edges:
        up.setdefault(a, set()).add(b)
        up.setdefault(b, set())
    out = {}
    for x in up:
        seen, todo = set(), list(up[x])
        while todo:
            y = todo.pop()
            if y not in seen:
                seen.add(y)
                todo += up[y]
        out[x] = seen
    return up, out


def test_hierarchy_against_plain_walk(spark):
    rng = random.Random(5)
    edges = [(f"n{i}", f"n{rng.randrange(max(0, i - 6), i)}") for i in range(1, 60)]
    edges += [(f"n{i}", f"n{rng.randrange(i)}") for i in rng.sample(range(2, 60), 8)]
    edges += [("c1", "c2"), ("c2", "c3"), ("c3", "c1"), ("c2", "n5"), ("d", "c1"), ("e", "d"), ("s", "s")]
    edges += edges[:4]
    tree = graph(spark, edges, ["alone"])
    up, reach = plain_reach(edges)
    roots = {x for x in up if not up[x]} | {"alone"}
    want = {(x, r) for x in up for r in (reach[x] | {x}) & roots} | {("alone", "alone")}
    assert rows(tree.reach().select("id", "root_id")) == want
    assert rows(tree.circles()) == {(x,) for x in up if x in reach[x]}
    assert rows(tree.ancestors().select("id", "ancestor_id")) == {(x, y) for x in up for y in reach[x]}
    ring = {x for x in up if x in reach[x]}

    def ways(x):
        if x in ring:
            return []
        if not up.get(x):
            return [x]
        return [f"{w}/{x}" for p in up[x] if p not in ring for w in ways(p)]

    paths = tree.paths()
    assert sorted(r.path for r in paths.collect()) == sorted(w for x in [*up, "alone"] for w in ways(x))
    assert all(r.depth == r.path.count("/") and r.path.split("/")[0] == r.root_id for r in paths.collect())
    s = {r.id: r for r in tree.summary().collect()}
    assert s["c1"].in_circle and s["c1"].depth is None and s["alone"].depth == 0 and s["n0"].n_descendants == len([x for x in up if "n0" in reach[x]])


def test_tangled_circles(spark):
    """Circles that share nodes, that no single way leads round, and rings of some length."""
    rng = random.Random(9)
    edges = [(f"t{rng.randrange(14):02}", f"t{rng.randrange(14):02}") for _ in range(24)]
    edges += [(f"r{i:02}", f"r{(i + 1) % 40:02}") for i in range(40)] + [("r05", "t03"), ("low", "r07"), ("t02", "top")]
    # the ring b1 b2 b3 is followed by neither the least nor the greatest parent
    edges += [(f"b{i}", x) for i in (1, 2, 3) for x in ("a0", "z0", f"b{i % 3 + 1}")]
    tree = graph(spark, edges)
    up, reach = plain_reach(edges)
    roots = {x for x in up if not up[x]}
    assert rows(tree.reach().select("id", "root_id")) == {(x, r) for x in up for r in (reach[x] | {x}) & roots}
    assert rows(tree.circles()) == {(x,) for x in up if x in reach[x]}


def test_reachable(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("b", None)], "id string, to string")
    seeds = spark.createDataFrame([("a",), ("q",)], "id string")
    assert rows(reachable(links, seeds)) == {("a",), ("b",), ("c",), ("q",)}
    apart = seeds.withColumn("s", F.col("id")).union(spark.createDataFrame([("x", "x")], "id string, s string"))
    assert {r for r in rows(reachable(links, apart, "s")) if r[1] == "x"} == {("x", "x"), ("y", "x")}


def test_deep_chain_and_empty_graph(spark):
    tree = graph(spark, [(f"{i:03}", f"{i - 1:03}") for i in range(1, 70)])
    assert tree.reach().filter("root_id = '000'").count() == 70
    empty = spark.createDataFrame([], "id string, parent string")
    none = Hierarchy(empty, empty)
    assert none.reach().count() == 0 and none.circles().count() == 0 and none.paths().count() == 0 and none.ancestors().count() == 0


def test_first_ancestor_is_depth_first(spark):
    def run(edges, hits, seed="D"):
        e = spark.createDataFrame(edges, "id string, parent string, ordinal int")
        h = spark.createDataFrame([(x, x) for x in hits], "node string, hit string")
        return [r.hit for r in first_ancestor(spark.createDataFrame([(seed,)], "id string"), e, h).collect()]

    assert run([("D", "A", 0), ("A", "K1", 0), ("D", "K2", 1)], ["K1", "K2"]) == ["K1"]
    assert run([("D", "A", 0), ("A", "D", 0)], ["K1"]) == []
    chain = lambda n: [("D", "n1", 0), *[(f"n{i}", f"n{i + 1}", 0) for i in range(1, n)]]
    assert run(chain(9), ["n9"]) == ["n9"]
    assert run(chain(10), ["n10"]) == []


def test_connected_classes(spark):
    pairs = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("x", "y"), ("y", "x"), ("z", "z"), (None, "q")]
    got = {r.id: (r.class_id, r.n_links) for r in connected_classes(spark.createDataFrame(pairs, "a string, b string"), "a", "b").collect()}
    assert {v[0] for k, v in got.items() if k.isdigit()} == {"000"} and got["020"] == ("000", 2) and got["y"] == ("x", 1) and "z" not in got
    assert connected_classes(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


# packed values

PACKED = [
    "a; b ;c", 'x,"y, z"', '"a ""b"" c"/d', "2,4-dioxo-x, y", "3,6-a/4,7,8-b", "N/A", "n/a", "", None, " ; ;", "only", "a//b", "a\nb", '"q" r;s', 'open "x;y', "unknown;z",
    "é;中", "k12,4-x", '"";a', "a; b", "1,2-d", "?;a;b", '"a;b', "a" * 5000 + ";" + "b", '5"-x;y',
]


def test_split_against_sequential_parser():
    rng = random.Random(2)
    texts = PACKED + ["".join(rng.choices('ab"";,/ 2-\n', k=rng.randrange(0, 14))) for _ in range(3000)]
    void = {"", "na", "n/a", "none", "null", "nil", "nan", "unknown"}
    no = lambda x: x.strip().lower() in void or not any(ch.isalnum() for ch in x)
    parent, pos, items = split_column(pa.array(texts))
    got = {}
    for p, k, x in zip(parent.tolist(), pos.tolist(), items.to_pylist()):
        got.setdefault(p, []).append((k, x))
    for i, t in enumerate(texts):
        want = [] if t is None or t.strip().lower() in void else [x for x in _sequential(t, ";,/|&+\n\r") if not no(x)]
        assert got.get(i, []) == list(enumerate(want, 1)), repr(t)


def test_explode_packed(spark):
    df = spark.createDataFrame([(1, "a; b", "x"), (2, "one", None), (None, "p/q", "r,s"), (1, "a; b", "x")], "k long, f string, item string")
    got = sorted((r.row_key or "", r.field_name, r.pos, r.item) for r in explode_packed(df, "t", "k", ["f", "item"]).collect())
    assert got == sorted([("1", "f", 1, "a"), ("1", "f", 2, "b")] * 2 + [("", "f", 1, "p"), ("", "f", 2, "q"), ("", "item", 1, "r"), ("", "item", 2, "s")])
    assert explode_packed(df.limit(0), "t", "k", ["f"]).count() == 0


# rows that fail to parse

GOOD = "CARD\tgb|x\tXY123456\tg\t12\t2022-02-28"


@pytest.mark.parametrize(
    "line,reason",
    [
        (GOOD, None), (GOOD.replace("gb|x", '"a\t""b"""'), None), (GOOD.replace("gb|x", 'a "b" c'), None), (GOOD.replace("XY123456", ""), None),
        (GOOD.replace("gb|x", '"a'), "quoting"), (GOOD.replace("gb|x", '"a" b'), "quoting"), (GOOD + "\t", "columns"), ("", "columns"), (None, "columns"),
        (GOOD.replace("CARD", "CRD"), "value"), (GOOD.replace("12", "0"), "value"), (GOOD.replace("02-28", "02-30"), "value"), (GOOD.replace("12", "1,2"), "value"),
        (GOOD.replace("XY123456", "xy1"), "value"), (GOOD.replace("gb|x", "a\rb"), None), (GOOD.replace("gb|x", "z" * 300_000), None),
    ],
)
def test_records(line, reason):
    assert parse_record(line)[0] == reason


@pytest.mark.parametrize(
    "row,reason",
    [
        (("CARD", "gb|XY123456.1|+|1-9|ARO:12|n [o] ", None), None), (("CARD", "gb|XY123456.1|+|1-9|ARO:12", "NA"), "columns"),
        (("CARD", "gb|XY123456.1|*|1-9|ARO:12|n", None), "value"), (("CARD", '"gb|XY123456.1|+|1-9|ARO:12|n"', "#N/A"), "value"),
        (("CARD", '"gb|XY123456.1|+|1-9|ARO:12|n" x', None), "quoting"), (("NCBI", "QZ_AB123456.1:c1-9 d", None), None), (("NCBI", "QZ_AB123456.1 d", None), "columns"),
        (("NCBI", "QZ_AB123456.1:x d", None), "value"), (("RESFINDER", "n_1_QZ_AB123456", None), None), (("RESFINDER", "n_QZ_AB123456", None), "columns"),
        (("RESFINDER", "n_1_AB12", None), "value"), (("RESFINDER", None, None), "columns"), (("X", "n_1_AB123456", None), "value"),
    ],
)
def test_headers(row, reason):
    assert header_reason(*row) == reason


def test_parse_records_keeps_all(spark):
    df = spark.createDataFrame([(1, GOOD, "z"), (2, "x", "z"), (3, None, "z"), (1, GOOD, "z")], "raw_id long, raw_line string, reason string")
    got = parse_records(df).collect()
    assert len(got) == 4 and sum(r.reason is None for r in got) == 2 and {r.loaded_on for r in got if not r.reason} == {datetime.date(2022, 2, 28)}
    assert parse_records(df.limit(0)).count() == 0
    genes = spark.createDataFrame([(1, "CARD", "bad", None), (2, "RESFINDER", "n_1_AB123456", None)], "gene_id long, source string, original_header string, source_acc string")
    assert rows(bad_headers(genes)) == {(1, "columns")} and [r.gene_id for r in good_rows(genes).collect()] == [2]


def test_files_are_assembled_by_quotes(spark, tmp_path):
    assert list(assemble_records(iter(['a\t"b', 'c"\td', "e", '"open', "f"]))) == ['a\t"b\nc"\td', "e", '"open', "f"]
    (tmp_path / "x.tsv").write_text(GOOD.replace("gb|x", '"a\nb"') + "\n" + GOOD + "\nbad\n")
    assert sorted((r.raw_id, r.reason) for r in read_delimited(spark, str(tmp_path)).collect()) == [(1, None), (3, None), (4, "columns")]


# relational


def test_relational(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 7), (1, "c", 7), (2, "d", 1)], "g int, v string, n int")
    assert rows(best_per_group(df, ["g"], [F.col("n"), F.col("v")])) == {(1, "c", 7), (2, "d", 1)}
    assert rows(df.groupBy("g").agg(join_distinct(F.col("v"), "|"))) == {(1, "a|b|c"), (2, "d")}
    left = spark.createDataFrame([("k1",), ("k2",), (None,)], "k string")
    right = spark.createDataFrame([("k1", "k1", 1), ("k2", "k1", 2), (None, "k2", 3)], "a string, b string, v int")
    assert sorted((r.k, r.v) for r in any_key_join(left, right, F.col("k"), [F.col("a"), F.col("b")]).collect()) == [("k1", 1), ("k1", 2), ("k2", 2), ("k2", 3)]
    build = spark.createDataFrame([("x", 1, 0, "second"), ("x", 0, 1, "first"), ("y", 0, 0, "other")], "k string, t int, o int, hit string")
    probe = spark.createDataFrame([(1, "q", "x"), (2, "y", "x"), (3, "q", "q")], "i int, a string, b string")
    got = {r.i: r.hit for r in tiered_lookup(probe, [F.col("a"), F.col("b")], build, "k", "t", "o", "i").collect()}
    assert got == {1: "first", 2: "other", 3: None}


def test_merges_are_idempotent(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(insert_ignore(old, new, ["k"])) == {(1, "a"), (2, "b"), (3, "C")}
    once = upsert(old, new, ["k"])
    assert rows(once) == {(1, "a"), (2, "B"), (3, "C")} == rows(upsert(once, new, ["k"]))
    assert rows(update_column(old, new, "k", "v")) == {(1, "a"), (2, "B")}
    path = str(tmp_path / "t")
    store = Store(spark, path)
    store.put("t", old)
    assert rows(store.merge("t", new, ["k"], replace=True)) == rows(once) == rows(store.read("t"))
    dry = Store(spark, path, dry_run=True)
    assert dry.put("d", old) is old and dry.read("d") is old and Store(spark, path).read("d") is None
    bad = violations(once, "t", [["k"]], ["v"], {"k": (old, "k")}, {"v": ["a", "B", "C"]})
    assert rows(bad) == {("t", "foreign key k", 1)}
