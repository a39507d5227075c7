"""Every relational operator on the star-schema tables, with the SQL it must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import combination_key, sort_codes_text
from ..functions.codon import translate
from ..functions.ids import content_id, number_rows, padded_id
from ..functions.text import default_if_blank, is_true, normalise_name, split_clean
from ..operators.ancestry import first_ancestor
from ..operators.merge import insert_ignore, update_column, upsert, violations, widen
from ..operators.relational import any_key_join, best_per_group, join_distinct, keep_first, last_wins, missing_both_ways, pivot_left, tiered_lookup, union_all
from ..session import table

QUERIES, ORACLES = {}, {}


class Tables:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf, name)


def query(sql: str | None):
    def put(f):
        QUERIES[f.__name__] = lambda spark, sf: f(Tables(spark, sf))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


@query("SELECT 'SEQ' || substr(md5(upper(sequence)), 1, 10) AS content_id, count(*) AS n_rows, min(jrc_id) AS first_id FROM sequence GROUP BY 1")
def exact_dedup_hash_id(t):
    return t.sequence.groupBy(content_id(F.col("sequence"), "SEQ").alias("content_id")).agg(F.count("*").alias("n_rows"), F.min("jrc_id").alias("first_id"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1")
def best_per_group_order(t):
    return best_per_group(t.orders, ["o_custkey"], [F.col("o_totalprice"), -F.col("o_orderkey")], ["o_orderkey", "o_totalprice"])


@query("SELECT md5(text) AS h, count(DISTINCT lower(trim(source))) AS n_sources, string_agg(DISTINCT lower(trim(source)), '|' ORDER BY lower(trim(source))) AS sources FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(DISTINCT lower(trim(source))) > 1")
def shared_across_groups(t):
    rows = t.documents.filter("text IS NOT NULL").select(F.md5("text").alias("h"), F.lower(F.trim("source")).alias("s"))
    return rows.groupBy("h").agg(F.size(F.collect_set("s")).cast("long").alias("n_sources"), join_distinct(F.col("s"), "|").alias("sources")).filter("n_sources > 1")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def distinct_string_agg(t):
    return t.orders.groupBy("o_custkey").agg(join_distinct(F.col("o_orderpriority"), ", ").alias("priorities"))


@query("SELECT count(DISTINCT c_custkey) AS n_customers, count(DISTINCT c_custkey) FILTER (WHERE c_custkey IN (SELECT o_custkey FROM orders)) AS n_with_orders FROM customer")
def coverage_filter_distinct(t):
    has = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("x", F.lit(1))
    rows = t.customer.select("c_custkey").distinct().join(has, "c_custkey", "left")
    return rows.agg(F.count("c_custkey").alias("n_customers"), F.count(F.when(F.col("x") == 1, 1)).alias("n_with_orders"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY ALL")
def count_two_keys(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_customers, cast(sum(n) AS BIGINT) AS n_orders, cast(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS n_repeat, max(n) AS most FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def summary_nested_agg(t):
    n = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return n.agg(F.count("*").alias("n_customers"), F.sum("n").alias("n_orders"), F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("n_repeat"), F.max("n").alias("most"))


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS n_status FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 2")
def group_having(t):
    return t.orders.groupBy("o_custkey").agg(F.countDistinct("o_orderstatus").alias("n_status")).filter("n_status > 2")


@query("SELECT p.p_partkey, v.tag FROM (SELECT p_partkey, unnest(string_split(lower(p_name), ' ')) AS w FROM part) p JOIN (VALUES ('red', 'warm'), ('blue', 'cold'), ('green', 'cold'), ('small', 'size'), ('large', 'size')) v(w, tag) ON p.w = v.w WHERE p.w <> ''")
def lateral_split_join(t):
    words = t.part.select("p_partkey", F.explode(split_clean(F.col("p_name"), " ", lower=True)).alias("w"))
    tags = t.spark.createDataFrame([("red", "warm"), ("blue", "cold"), ("green", "cold"), ("small", "size"), ("large", "size")], "w string, tag string")
    return words.join(tags, "w").select("p_partkey", "tag")


@query("SELECT DISTINCT c.c_custkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey OR c.c_nationkey = n.n_regionkey")
def or_key_join(t):
    return any_key_join(t.customer.select("c_custkey", "c_nationkey"), t.nation, F.col("c_nationkey"), [F.col("n_nationkey"), F.col("n_regionkey")]).select("c_custkey", "n_name").distinct()


@query("""SELECT c.c_custkey, n.n_name, string_agg(DISTINCT o.o_orderstatus, '|' ORDER BY o.o_orderstatus) AS statuses, string_agg(DISTINCT o.o_orderpriority, '|' ORDER BY o.o_orderpriority) AS priorities
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey, n.n_name""")
def star_left_join_distinct_aggs(t):
    o = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(join_distinct(F.col("o_orderstatus"), "|").alias("statuses"), join_distinct(F.col("o_orderpriority"), "|").alias("priorities"))
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.customer.select("c_custkey", "c_nationkey").join(n, "c_nationkey", "left").join(o, "c_custkey", "left").select("c_custkey", "n_name", "statuses", "priorities")


@query("""SELECT c.c_custkey, f.p AS price_f, o.p AS price_o, p.p AS price_p FROM customer c
LEFT JOIN (SELECT o_custkey, min(o_totalprice) AS p FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.o_custkey = c.c_custkey
LEFT JOIN (SELECT o_custkey, min(o_totalprice) AS p FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT o_custkey, min(o_totalprice) AS p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) p ON p.o_custkey = c.c_custkey""")
def pivot_self_left_join(t):
    facts = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return pivot_left(t.customer.select("c_custkey"), facts, "c_custkey", "o_orderstatus", "o_totalprice", ["F", "O", "P"], "price_")


@query("""SELECT o_custkey, 'direct' AS way FROM orders WHERE o_totalprice > 400000 UNION SELECT c.c_custkey, 'nation' FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey = 1""")
def union_distinct_paths(t):
    direct = t.orders.filter("o_totalprice > 400000").select("o_custkey", F.lit("direct").alias("way"))
    nation = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).filter("n_regionkey = 1").select(F.col("c_custkey").alias("o_custkey"), F.lit("nation").alias("way"))
    return direct.union(nation).distinct()


@query("SELECT s.s_suppkey, s.s_name FROM supplier s JOIN nation n ON n.n_nationkey = (SELECT s_nationkey FROM supplier WHERE s_suppkey = 1) WHERE s.s_nationkey = n.n_nationkey")
def scalar_subquery_join(t):
    one = t.supplier.filter("s_suppkey = 1").select("s_nationkey")
    return t.supplier.join(F.broadcast(one), "s_nationkey", "left_semi").select("s_suppkey", "s_name")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join_new_keys(t):
    known = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").join(known, "c_custkey", "left_anti")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def semi_join(t):
    return t.customer.select("c_custkey", "c_mktsegment").join(t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")


@query("""WITH b AS (SELECT lower(p_type) AS k, 1 AS tier, p_partkey AS o, p_partkey AS hit FROM part UNION ALL SELECT lower(p_brand), 2, p_partkey, p_partkey FROM part),
i AS (SELECT k, arg_min(hit, {'a': tier, 'b': o}) AS hit FROM b GROUP BY k)
SELECT p.p_partkey, coalesce(x.hit, y.hit, z.hit) AS hit FROM part p LEFT JOIN i x ON x.k = lower(p.p_name) LEFT JOIN i y ON y.k = lower(p.p_type) LEFT JOIN i z ON z.k = lower(p.p_brand)""")
def tiered_lookup_part(t):
    p = t.part
    build = union_all(
        p.select(F.lower("p_type").alias("k"), F.lit(1).alias("tier"), F.col("p_partkey").alias("o"), F.col("p_partkey").alias("hit")),
        p.select(F.lower("p_brand").alias("k"), F.lit(2).alias("tier"), F.col("p_partkey").alias("o"), F.col("p_partkey").alias("hit")),
    )
    keys = [F.lower("p_name"), F.lower("p_type"), F.lower("p_brand")]
    return tiered_lookup(p.select("p_partkey", "p_name", "p_type", "p_brand"), keys, build, "k", "tier", "o", "p_partkey").select("p_partkey", "hit")


@query("SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey")
def last_wins_lookup(t):
    last = last_wins(t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderkey").alias("line_no")), "c_custkey", "line_no")
    return t.customer.select("c_custkey").join(last, "c_custkey", "left").select("c_custkey", "o_orderkey")


@query("""WITH k AS (SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(lower(p_name), ' '), lambda x: x <> ''))), '/') AS k FROM part)
SELECT p_partkey, CASE WHEN k LIKE '%/%' THEN min(p_partkey) OVER (PARTITION BY k) END AS hit FROM k""")
def set_key_join(t):
    keyed = t.part.select("p_partkey", combination_key(F.regexp_replace("p_name", " +", "/")).alias("k"))
    build = keyed.filter("k IS NOT NULL").groupBy("k").agg(F.min("p_partkey").alias("hit"))
    return keyed.join(build, "k", "left").select("p_partkey", "hit")


@query("""SELECT p_brand, array_to_string(list_transform(list_sort(list_distinct(list_transform(codes, lambda x: {'r': CASE instr('JQPDALBCGHMNRSV', x[1]) WHEN 0 THEN 16 ELSE instr('JQPDALBCGHMNRSV', x[1]) END, 'c': x}))), lambda s: s.c), ',') AS codes
FROM (SELECT p_brand, list(DISTINCT upper(substr(p_name, 1, 3)) ORDER BY upper(substr(p_name, 1, 3))) AS codes FROM part GROUP BY 1)""")
def rank_sorted_list(t):
    codes = t.part.groupBy("p_brand").agg(join_distinct(F.upper(F.substring("p_name", 1, 3)), ",").alias("c"))
    return codes.select("p_brand", sort_codes_text(F.col("c")).alias("codes"))


@query("SELECT event_type, cast(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n_rows FROM events GROUP BY ALL")
def json_extract(t):
    return t.events.groupBy("event_type", F.get_json_object("props", "$.k").try_cast("long").alias("k")).agg(F.count("*").alias("n_rows"))


@query("SELECT regexp_extract(original_header, '([A-Z]{1,2}_?[0-9]{5,9})', 1) AS acc, count(*) AS n_rows FROM gene GROUP BY 1")
def regex_extract(t):
    return t.gene.groupBy(F.regexp_extract("original_header", "([A-Z]{1,2}_?[0-9]{5,9})", 1).alias("acc")).agg(F.count("*").alias("n_rows"))


@query("SELECT md5(regexp_replace(regexp_replace(lower(p_name), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g')) AS h, count(*) AS n_rows FROM part GROUP BY 1")
def normalise_text(t):
    return t.part.groupBy(F.md5(normalise_name(F.col("p_name"))).alias("h")).agg(F.count("*").alias("n_rows"))


@query("SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'b' WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal > 9000 THEN 'rich' ELSE 'other' END AS context, count(*) AS n_rows FROM customer GROUP BY 1")
def case_classifier(t):
    context = F.when(F.col("c_mktsegment") == "BUILDING", "b").when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") > 9000, "rich").otherwise("other")
    return t.customer.groupBy(context.alias("context")).agg(F.count("*").alias("n_rows"))


NT = "substr(translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 30)"


@query(f"""WITH s AS (SELECT doc_id, {NT} AS s FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, CASE WHEN right(s, 3) IN ('TAA', 'TAG', 'TGA') THEN left(s, 27) ELSE s END AS s FROM s),
a AS (SELECT doc_id, s, list_transform(range(1, length(s) + 1, 3), lambda i: substr('FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG',
  CAST((instr('TCAG', s[i]) - 1) * 16 + (instr('TCAG', s[i + 1]) - 1) * 4 + instr('TCAG', s[i + 2]) AS INTEGER), 1)) AS a FROM c)
SELECT doc_id, CASE WHEN NOT list_contains(a, '*') THEN CASE WHEN left(s, 3) IN ('GTG', 'TTG', 'CTG', 'ATT', 'ATC', 'ATA') THEN 'M' ELSE a[1] END || array_to_string(a[2:], '') END AS protein FROM a""")
def codon_translate(t):
    nt = F.substring(F.translate(F.md5("text"), "0123456789abcdef", "ACGTACGTACGTACGT"), 1, 30)
    return t.documents.filter("text IS NOT NULL").select("doc_id", translate(nt).alias("protein"))


@query("""WITH RECURSIVE e AS (SELECT 'N' || n_nationkey AS id, 'R' || n_regionkey AS parent FROM nation UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer),
h AS (SELECT 'R' || r_regionkey AS node, r_name AS hit FROM region), w AS (SELECT id, parent, 0 AS d FROM e UNION ALL SELECT w.id, e.parent, d + 1 FROM w JOIN e ON e.id = w.parent WHERE d < 8)
SELECT w.id, h.hit FROM w JOIN h ON h.node = w.parent""")
def recursive_ancestor(t):
    n = t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("id"), F.concat(F.lit("R"), "n_regionkey").alias("parent"))
    c = t.customer.select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.concat(F.lit("N"), "c_nationkey").alias("parent"))
    edges = n.unionByName(c).withColumn("ordinal", F.lit(0))
    hits = t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("node"), F.col("r_name").alias("hit"))
    return first_ancestor(edges.select("id"), edges, hits)


@query("""SELECT l_orderkey, string_agg(DISTINCT tag, '|' ORDER BY tag) AS tags FROM (SELECT l_orderkey, 'BIG' AS tag FROM lineitem WHERE l_quantity > 45 UNION ALL SELECT l_orderkey, 'CHEAP' FROM lineitem WHERE l_discount > 0.08
UNION ALL SELECT l_orderkey, 'RETURNED' FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1""")
def evidence_union_agg(t):
    tag = lambda test, name: t.lineitem.filter(test).select("l_orderkey", F.lit(name).alias("tag"))
    rows = union_all(tag("l_quantity > 45", "BIG"), tag("l_discount > 0.08", "CHEAP"), tag("l_returnflag = 'R'", "RETURNED"))
    return rows.groupBy("l_orderkey").agg(join_distinct(F.col("tag"), "|").alias("tags"))


@query("SELECT p_brand, arg_min(p_name, p_partkey) AS first_name, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS types, min(p_size) FILTER (WHERE p_size > 10) AS small FROM part GROUP BY 1")
def merge_fold(t):
    return t.part.groupBy("p_brand").agg(F.min_by("p_name", "p_partkey").alias("first_name"), join_distinct(F.col("p_type"), "|").alias("types"), F.min(F.when(F.col("p_size") > 10, F.col("p_size"))).alias("small"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def upsert_merge(t):
    old = t.orders.select("o_orderkey", "o_orderstatus")
    return upsert(old, old.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'new' END AS o_orderstatus FROM orders")
def insert_ignore_merge(t):
    old = t.orders.select("o_orderkey", "o_orderstatus")
    return insert_ignore(old.filter("o_orderkey % 2 = 0"), old.withColumn("o_orderstatus", F.lit("new")), ["o_orderkey"])


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE o_orderpriority END AS o_orderpriority, '' AS note FROM orders")
def keyed_update(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    changes = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("done").alias("o_orderpriority"))
    return widen(update_column(rows, changes, "o_orderkey", "o_orderpriority"), ["note"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk_ordered(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("SELECT event_type, count(*) AS n_rows, count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NOT NULL) AS n_k FROM events GROUP BY 1")
def null_rates(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n_rows"), F.count(F.get_json_object("props", "$.k")).alias("n_k"))


@query("SELECT c.c_custkey, coalesce(o.o_orderstatus, '-') AS status, coalesce(nullif(trim(c.c_mktsegment), ''), 'none') AS segment, o.o_orderstatus = 'True' IS TRUE AS flag FROM customer c LEFT JOIN (SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey")
def left_join_null_fill(t):
    first = keep_first(t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus"), ["c_custkey"], "o_orderkey")
    rows = t.customer.select("c_custkey", "c_mktsegment").join(first, "c_custkey", "left")
    return rows.select("c_custkey", F.coalesce("o_orderstatus", F.lit("-")).alias("status"), default_if_blank(F.col("c_mktsegment"), "none").alias("segment"), is_true(F.col("o_orderstatus")).alias("flag"))


@query("SELECT h, 'CLU' || lpad(cast(row_number() OVER (ORDER BY h) AS VARCHAR), 6, '0') AS cluster_id FROM (SELECT DISTINCT md5(text) AS h FROM documents WHERE text IS NOT NULL)")
def surrogate_ids(t):
    rows = t.documents.filter("text IS NOT NULL").select(F.md5("text").alias("h")).distinct()
    return number_rows(rows, "h").select("h", padded_id(F.col("n"), "CLU").alias("cluster_id"))


@query("""SELECT DISTINCT protein_id AS k, 'left' AS side FROM sequence WHERE protein_id IS NOT NULL AND protein_id NOT IN (SELECT protein_id FROM protein)
UNION ALL SELECT DISTINCT protein_id, 'right' FROM protein WHERE protein_id NOT IN (SELECT protein_id FROM sequence WHERE protein_id IS NOT NULL)""")
def row_quality_anti(t):
    used = t.sequence.filter("protein_id IS NOT NULL")
    return missing_both_ways(used.select(F.col("protein_id").alias("k")), t.protein.select(F.col("protein_id").alias("k")), "k")


@query("""SELECT 'cluster' AS table_name, 'foreign key representative_jrc' AS rule, count(*) AS n_rows FROM cluster WHERE representative_jrc IS NOT NULL AND representative_jrc NOT IN (SELECT jrc_id FROM sequence) HAVING count(*) > 0
UNION ALL SELECT 'cluster', 'not null representative_jrc', count(*) FROM cluster WHERE representative_jrc IS NULL HAVING count(*) > 0
UNION ALL SELECT 'cluster', 'unique representative_jrc', count(*) FROM (SELECT representative_jrc FROM cluster GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0""")
def constraint_violations(t):
    return violations(t.cluster, "cluster", [["cluster_id"], ["representative_jrc"]], ["representative_jrc"], {"representative_jrc": (t.sequence, "jrc_id")})


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n_rows FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(t):
    rows = t.lineitem.filter("l_shipdate <= TIMESTAMP '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n_rows"))
