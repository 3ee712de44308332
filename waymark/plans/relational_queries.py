"""Filters, joins, aggregates, ranking and set operations, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.text import missing_to_null
from waymark.operators.gates import first_reason, routing_gate
from waymark.operators.relational import best_and_margin, equal_shares, keep_first, matched, paired, split_matches, stacked, top, upserted, valid_at
from waymark.plans import domain
from waymark.plans.registry import query, table

VERSIONS_SQL = "versions AS (SELECT o_custkey AS id, o_orderkey AS version, CAST(o_orderdate AS DATE) AS valid_from, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 365 END AS valid_to FROM orders)"


def versions(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("version"), day.alias("valid_from"), F.when(F.col("o_orderstatus") == "F", F.date_add(day, 365)).alias("valid_to"))


@query("f1_equality_filter", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def f1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "2-HIGH")).select("o_orderkey", "o_custkey", "o_totalprice")


@query("f2_valid_at", f"WITH {VERSIONS_SQL} SELECT id, version, CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM versions WHERE valid_from <= DATE '1998-06-30' AND (valid_to IS NULL OR valid_to >= DATE '1998-06-30')")
def f2(spark: SparkSession, d: str) -> DataFrame:
    return valid_at(versions(spark, d), "1998-06-30").select("id", "version", *[F.col(c).cast("string").alias(c) for c in ("valid_from", "valid_to")])


@query("f3_membership", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def f3(spark: SparkSession, d: str) -> DataFrame:
    rich = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(rich, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("f4_first_of_columns", "SELECT doc_id, coalesce(nullif(trim(source), 'src0'), nullif(trim(lang), ''), 'none') AS label FROM documents")
def f4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.coalesce(missing_to_null(F.col("source"), ("", "src0")), missing_to_null(F.col("lang"), ("",)), F.lit("none")).alias("label"))


@query("f5_rename_and_derive", "SELECT p_partkey AS code, upper(p_name) AS name, p_retailprice * 1.22 AS gross FROM part")
def f5(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").withColumnsRenamed({"p_partkey": "code"}).select("code", F.upper("p_name").alias("name"), (F.col("p_retailprice") * 1.22).alias("gross"))


@query("f6_routing_gate", f"WITH {domain.GATE_SQL} SELECT service_id, eligibility, CASE WHEN eligibility = 'eligible' THEN raw_node END AS node_id, CASE WHEN eligibility = 'eligible' THEN raw_snap END AS snap_distance_m, raw_node AS attachment_node_id FROM gated")
def f6(spark: SparkSession, d: str) -> DataFrame:
    return routing_gate(domain.services(spark, d)).select("service_id", "eligibility", "node_id", "snap_distance_m", "attachment_node_id")


@query(
    "f7_assignment_status",
    "SELECT n_nationkey, CASE WHEN n IS NULL THEN 'no_observation' WHEN people = 0 THEN 'observed_zero' ELSE 'assigned' END AS status FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n, sum(greatest(c_acctbal, 0)) AS people FROM customer WHERE c_nationkey % 6 <> 1 GROUP BY 1) ON c_nationkey = n_nationkey",
)
def f7(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "customer").where("c_nationkey % 6 <> 1").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum(F.greatest(F.col("c_acctbal"), F.lit(0.0))).alias("people"), F.count("*").alias("n"))
    joined = table(spark, d, "nation").join(seen, "n_nationkey", "left")
    return joined.select("n_nationkey", first_reason((F.col("n").isNull(), "no_observation"), (F.col("people") == 0, "observed_zero"), otherwise="assigned").alias("status"))


@query("f14_finite_range", "SELECT c_custkey FROM customer WHERE c_acctbal BETWEEN 0 AND 5000 AND NOT isnan(c_acctbal)")
def f14(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").where(F.col("c_acctbal").between(0, 5000) & ~F.isnan("c_acctbal")).select("c_custkey")


@query("j1_left_join_flag", "SELECT d.doc_id, quality, toxic, l.doc_id IS NOT NULL AS labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def j1(spark: SparkSession, d: str) -> DataFrame:
    return matched(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), ["doc_id"], "labelled").select("doc_id", "quality", "toxic", "labelled")


@query("j2_inner_one_to_one", "SELECT d.doc_id, lang, quality FROM documents d JOIN labels l USING (doc_id)")
def j2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id").select("doc_id", "lang", "quality")


@query(
    "j3_three_way_split",
    "SELECT c_custkey, CASE WHEN c_nationkey % 5 = 0 THEN 'not_covered' WHEN n IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS part, coalesce(n, 0) AS n_orders FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey AND c_nationkey % 5 <> 0",
)
def j3(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    covered, rest = customers.where("c_nationkey % 5 <> 0"), customers.where("c_nationkey % 5 = 0")
    orders = table(spark, d, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    hit, miss = split_matches(covered, orders, ["c_custkey"])
    named = [x.withColumn("part", F.lit(n)) for x, n in ((hit, "matched"), (miss, "unmatched"), (rest, "not_covered"))]
    return stacked(*named).select("c_custkey", "part", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query("j4_lookup_join", "SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def j4(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    joined = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select("c_custkey", "n_name", "r_name")


@query("j7_missing_attachments", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j7(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query(
    "j16_lookup_classified",
    "SELECT c_custkey, CASE WHEN n IS NULL THEN 'none' WHEN days > 1 THEN 'ambiguous' WHEN n > 1 THEN 'several' ELSE 'single' END AS status, coalesce(n, 0) AS hits FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS days FROM orders WHERE o_totalprice > 300000 GROUP BY 1) ON o_custkey = c_custkey",
)
def j16(spark: SparkSession, d: str) -> DataFrame:
    found = table(spark, d, "orders").where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_distinct("o_orderpriority").alias("days"))
    status = first_reason((F.col("n").isNull(), "none"), (F.col("days") > 1, "ambiguous"), (F.col("n") > 1, "several"), otherwise="single")
    return table(spark, d, "customer").select("c_custkey").join(found, "c_custkey", "left").select("c_custkey", status.alias("status"), F.coalesce("n", F.lit(0)).alias("hits"))


@query(
    "j18_paired_comparison",
    "SELECT coalesce(a.k, b.k) AS k, a.v AS before_v, b.v AS after_v, CASE WHEN b.k IS NULL THEN 'before' WHEN a.k IS NULL THEN 'after' ELSE 'both' END AS side FROM (SELECT s_suppkey AS k, s_acctbal AS v FROM supplier WHERE s_suppkey % 3 <> 0) a FULL JOIN (SELECT s_suppkey AS k, s_acctbal * 2 AS v FROM supplier WHERE s_suppkey % 4 <> 0) b ON a.k = b.k",
)
def j18(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"))
    return paired(s.where("k % 3 <> 0"), s.where("k % 4 <> 0").withColumn("v", F.col("v") * 2), ["k"], ["v"])


@query("j20_known_identities", "SELECT s_suppkey FROM supplier WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity >= 49 AND l_returnflag = 'R')")
def j20(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "lineitem").where("l_quantity >= 49 AND l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, d, "supplier").join(known, "s_suppkey", "left_anti").select("s_suppkey")


@query(
    "a1_shared_coordinates",
    "WITH p AS (SELECT s_suppkey, CAST(floor(s_acctbal / 500) AS BIGINT) AS place, s_nationkey FROM supplier) SELECT place, count(*) AS n, count(DISTINCT s_nationkey) AS kinds, count(*) >= 2 AND count(DISTINCT s_nationkey) >= 2 AS suspicious FROM p GROUP BY place",
)
def a1(spark: SparkSession, d: str) -> DataFrame:
    placed = table(spark, d, "supplier").withColumn("place", F.floor(F.col("s_acctbal") / 500).cast("bigint"))
    return placed.groupBy("place").agg(F.count("*").alias("n"), F.count_distinct("s_nationkey").alias("kinds")).withColumn("suspicious", (F.col("n") >= 2) & (F.col("kinds") >= 2))


@query("a2_sum_skipping_nulls", "SELECT doc_id, CAST(coalesce(quality, 0) + coalesce(toxic, 0) AS BIGINT) AS total FROM documents LEFT JOIN labels USING (doc_id)")
def a2(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return both.select("doc_id", (F.coalesce("quality", F.lit(0)) + F.coalesce("toxic", F.lit(0))).cast("bigint").alias("total"))


@query(
    "a3_establishment_rollup",
    "SELECT l_orderkey, l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, CAST(sum(l_quantity) AS BIGINT) AS quantity, CAST(min(l_shipdate) AS VARCHAR) AS first_ship, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS lines FROM lineitem GROUP BY ALL",
)
def a3(spark: SparkSession, d: str) -> DataFrame:
    first = F.date_format(F.min("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("first_ship")
    lines = F.array_join(F.array_sort(F.collect_set(F.col("l_linenumber").cast("string"))), ",").alias("lines")
    return table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.count("*").alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.sum("l_quantity").cast("bigint").alias("quantity"), first, lines)


@query("a4_sorted_distinct_list", "SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types, arg_min(p_name, p_partkey) AS first_name FROM part GROUP BY 1")
def a4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"), F.min_by("p_name", "p_partkey").alias("first_name"))


@query("a11_medians", "SELECT p_type, median(CAST(p_size AS DOUBLE)) AS median_size, (SELECT median(CAST(p_size AS DOUBLE)) FROM part) AS overall FROM part GROUP BY 1")
def a11(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part").withColumn("size", F.col("p_size").cast("double"))
    overall = part.agg(F.median("size").alias("overall"))
    return part.groupBy("p_type").agg(F.median("size").alias("median_size")).crossJoin(F.broadcast(overall))  # one row


@query(
    "a12_quantiles",
    "SELECT l_returnflag, quantile_cont(l_quantity, 0.05) AS p05, quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.9) AS p90, quantile_cont(l_quantity, 0.95) AS p95, min(l_quantity) AS low, max(l_quantity) AS high, round(avg(l_quantity), 9) AS mean FROM lineitem GROUP BY 1",
)
def a12(spark: SparkSession, d: str) -> DataFrame:
    quantiles = [F.percentile("l_quantity", q).alias(n) for n, q in (("p05", 0.05), ("p50", 0.5), ("p90", 0.9), ("p95", 0.95))]
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(*quantiles, F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.round(F.avg("l_quantity"), 9).alias("mean"))


@query("a13_value_counts", "SELECT toxic, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def a13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").groupBy("toxic").agg(F.count("*").alias("n"))


@query(
    "a14_quality_breakdown",
    f"WITH {domain.GATE_SQL} SELECT service_type, count(*) AS n, count(*) FILTER (eligibility = 'eligible') AS eligible, count(*) FILTER (eligibility = 'location_not_validated') AS not_validated, count(*) FILTER (NOT active) AS inactive, count(*) FILTER (NOT inside_footprint) AS outside FROM gated GROUP BY 1",
)
def a14(spark: SparkSession, d: str) -> DataFrame:
    of = lambda c: F.count(F.when(c, 1))
    gated = routing_gate(domain.services(spark, d))
    return gated.groupBy("service_type").agg(F.count("*").alias("n"), of(F.col("eligibility") == "eligible").alias("eligible"), of(F.col("eligibility") == "location_not_validated").alias("not_validated"), of(~F.col("active")).alias("inactive"), of(~F.col("inside_footprint")).alias("outside"))


@query("a19_worst_by_key", "SELECT l_returnflag, max(struct_pack(loss := l_extendedprice * l_discount, id := l_orderkey * 10 + l_linenumber)).loss AS loss FROM lineitem GROUP BY 1")
def a19(spark: SparkSession, d: str) -> DataFrame:
    loss = F.struct((F.col("l_extendedprice") * F.col("l_discount")).alias("loss"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.max(loss).alias("worst")).select("l_returnflag", "worst.loss")


@query("a20_ambiguous_keys", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS positions, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def a20(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_suppkey").alias("positions"), F.count("*").alias("n")).where("positions > 1")


@query("a21_single_or_mixed", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) ELSE 'mixed' END AS ownership FROM orders GROUP BY 1")
def a21(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.when(F.min("o_orderstatus") == F.max("o_orderstatus"), F.min("o_orderstatus")).otherwise("mixed").alias("ownership"))


@query("a23_conservation", "SELECT o_orderkey, round(o_totalprice, 2) AS observed, round(coalesce(s, 0), 2) AS assigned FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE abs(coalesce(s, 0) - o_totalprice) > greatest(1e-6, 1e-10 * abs(o_totalprice))")
def a23(spark: SparkSession, d: str) -> DataFrame:
    sums = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("s"))
    gap = F.abs(F.coalesce("s", F.lit(0.0)) - F.col("o_totalprice")) > F.greatest(F.lit(1e-6), 1e-10 * F.abs("o_totalprice"))
    return table(spark, d, "orders").join(sums, "o_orderkey", "left").where(gap).select("o_orderkey", F.round("o_totalprice", 2).alias("observed"), F.round(F.coalesce("s", F.lit(0.0)), 2).alias("assigned"))


@query("w1_latest_version", f"WITH {VERSIONS_SQL} SELECT id, version, CAST(valid_from AS VARCHAR) AS valid_from FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY valid_from DESC, version DESC) = 1")
def w1(spark: SparkSession, d: str) -> DataFrame:
    return keep_first(versions(spark, d), ["id"], [F.desc("valid_from"), F.desc("version")]).select("id", "version", F.col("valid_from").cast("string").alias("valid_from"))


@query("w2_count_over_key", "SELECT s_suppkey, count(*) OVER (PARTITION BY s_nationkey) AS neighbours FROM supplier")
def w2(spark: SparkSession, d: str) -> DataFrame:
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    return suppliers.join(suppliers.groupBy("s_nationkey").agg(F.count("*").alias("neighbours")), "s_nationkey").select("s_suppkey", "neighbours")


@query("w3_top_candidates", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 5")
def w3(spark: SparkSession, d: str) -> DataFrame:
    return top(table(spark, d, "lineitem"), ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")], 5).select("l_orderkey", "l_linenumber", "l_partkey", "rank")


@query(
    "w4_best_and_margin",
    "SELECT o_custkey, o_orderkey, round(o_totalprice - coalesce(second, 0), 6) AS margin FROM (SELECT *, row_number() OVER w AS rank, lead(o_totalprice) OVER w AS second FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) WHERE rank = 1",
)
def w4(spark: SparkSession, d: str) -> DataFrame:
    best = best_and_margin(table(spark, d, "orders"), ["o_custkey"], "o_totalprice", [F.col("o_orderkey")])
    return best.select("o_custkey", "o_orderkey", F.round("margin", 6).alias("margin"))


@query("w5_equal_shares", "SELECT c_custkey, 1.0::DOUBLE / count(*) OVER (PARTITION BY c_nationkey) AS share FROM customer")
def w5(spark: SparkSession, d: str) -> DataFrame:
    return equal_shares(table(spark, d, "customer"), ["c_nationkey"]).select("c_custkey", "share")


@query("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def o2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("o5_union_by_name", "SELECT 'customer' AS kind, c_custkey AS id, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, NULL FROM supplier")
def o5(spark: SparkSession, d: str) -> DataFrame:
    one = table(spark, d, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return stacked(one, table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id")))


@query("o6_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def o6(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query("o7_key_difference", "SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier")
def o7(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).subtract(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("k2_upsert", "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'new' ELSE 'old' END AS version FROM supplier UNION ALL SELECT s_suppkey + 1000000, 'new' FROM supplier WHERE s_suppkey % 4 = 0")
def k2(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"))
    changed = keys.where("id % 4 = 0")
    new = changed.unionByName(changed.withColumn("id", F.col("id") + 1000000)).withColumn("version", F.lit("new"))
    return upserted(keys.withColumn("version", F.lit("old")), new, ["id"])
