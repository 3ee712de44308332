"""Canonical services and what is decided on the way to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.gates import first_reason
from waymark.plans.registry import query, table


@query(
    "a5_area_summary",
    "SELECT c_nationkey AS area, count(*) AS n, string_agg(DISTINCT lower(c_mktsegment), ',' ORDER BY lower(c_mktsegment)) AS methods, min(c_acctbal) AS least, count(*) FILTER (c_acctbal < 0) AS negative FROM customer GROUP BY 1",
)
def a5(spark: SparkSession, d: str) -> DataFrame:
    methods = F.array_join(F.array_sort(F.collect_set(F.lower("c_mktsegment"))), ",").alias("methods")
    return table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("area")).agg(F.count("*").alias("n"), methods, F.min("c_acctbal").alias("least"), F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("negative"))


@query("a15_usable_counts", "SELECT p_brand, count(*) AS records, count(*) FILTER (p_size > 10) AS complete, count(*) FILTER (p_size > 10 AND p_type <> 'PROMO') AS usable FROM part GROUP BY 1")
def a15(spark: SparkSession, d: str) -> DataFrame:
    complete, eligible = F.col("p_size") > 10, F.col("p_type") != "PROMO"
    return table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("records"), F.count(F.when(complete, 1)).alias("complete"), F.count(F.when(complete & eligible, 1)).alias("usable"))


@query(
    "a22_merged_sites",
    "SELECT CASE WHEN s_acctbal > 3000 THEN 'at:' || CAST(CAST(floor(s_acctbal / 100) AS BIGINT) AS VARCHAR) ELSE 'code:' || CAST(s_suppkey AS VARCHAR) END AS site, count(*) AS services, min(s_name) AS name FROM supplier GROUP BY 1",
)
def a22(spark: SparkSession, d: str) -> DataFrame:
    place = F.concat(F.lit("at:"), F.floor(F.col("s_acctbal") / 100).cast("bigint").cast("string"))
    site = F.when(F.col("s_acctbal") > 3000, place).otherwise(F.concat(F.lit("code:"), F.col("s_suppkey").cast("string")))
    return table(spark, d, "supplier").groupBy(site.alias("site")).agg(F.count("*").alias("services"), F.min("s_name").alias("name"))


@query("f10_special_services", "SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'correctional' WHEN o_orderstatus = 'P' THEN 'hospital' WHEN o_totalprice < 100000 THEN 'evening' ELSE 'physical' END AS kind FROM orders")
def f10(spark: SparkSession, d: str) -> DataFrame:
    kind = first_reason((F.col("o_orderpriority") == "1-URGENT", "correctional"), (F.col("o_orderstatus") == "P", "hospital"), (F.col("o_totalprice") < 100000, "evening"), otherwise="physical")
    return table(spark, d, "orders").select("o_orderkey", kind.alias("kind"))


@query("f12_review_pattern", "SELECT p_partkey, regexp_matches(upper(p_name), '\\b(RED|BLUE)\\b') AND NOT regexp_matches(upper(p_name), '\\bRING\\b') AS review FROM part")
def f12(spark: SparkSession, d: str) -> DataFrame:
    name = F.upper("p_name")
    return table(spark, d, "part").select("p_partkey", (name.rlike(r"\b(RED|BLUE)\b") & ~name.rlike(r"\bRING\b")).alias("review"))


@query("e12_exclusion_leaks", "SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 = 0 AND s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 1)")
def e12(spark: SparkSession, d: str) -> DataFrame:
    final = table(spark, d, "lineitem").where("l_quantity = 1").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, d, "supplier").where("s_suppkey % 7 = 0").select("s_suppkey").join(final, "s_suppkey", "left_semi")


@query("s7_address_index", "SELECT l_suppkey % 50 AS street, l_partkey % 40 AS number, count(*) AS accesses, count(DISTINCT l_orderkey) AS ids FROM lineitem GROUP BY 1, 2")
def s7(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("street"), (F.col("l_partkey") % 40).alias("number")).agg(F.count("*").alias("accesses"), F.count_distinct("l_orderkey").alias("ids"))
