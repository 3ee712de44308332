"""The domain's entities, read from the driver's tables: network, origins, services, areas, registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions.geo import rectangle
from waymark.plans.registry import table

#: The same entities in SQL; a query's oracle starts with those that it needs.
EDGES_SQL = """edges AS (SELECT CAST(l_suppkey AS VARCHAR) AS src, CAST(l_partkey % (SELECT count(*) FROM supplier) AS VARCHAR) AS dst,
  l_quantity AS time_s, l_extendedprice AS length_m FROM lineitem)"""
ARCS_SQL = EDGES_SQL + """, arcs AS (SELECT src, dst, time_s, min(length_m) AS length_m FROM edges e
  WHERE time_s = (SELECT min(time_s) FROM edges f WHERE f.src = e.src AND f.dst = e.dst) GROUP BY src, dst, time_s)"""
ORIGINS_SQL = """origins AS (SELECT CAST(c_custkey AS VARCHAR) AS origin_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % (SELECT count(*) FROM supplier) AS VARCHAR) END AS node_id,
  CAST(c_custkey % 7 AS DOUBLE) AS snap_distance_m, greatest(c_acctbal, 0) AS population_total, c_nationkey AS area FROM customer)"""
SERVICES_SQL = """services AS (SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS service_id, CASE s_nationkey % 4 WHEN 0 THEN 'primary_school' WHEN 1 THEN 'pharmacy' WHEN 2 THEN 'hospital_establishment' ELSE 'preschool' END AS service_type,
  CAST(s_suppkey AS VARCHAR) AS raw_node, CAST(s_suppkey % 5 AS DOUBLE) AS raw_snap, CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE s_suppkey % 7 <> 3 END AS validated, s_suppkey % 13 <> 5 AS active,
  s_suppkey % 17 <> 2 AS boundary_verified, s_suppkey % 19 <> 4 AS inside_footprint, s_suppkey % 23 <> 6 AS snapped FROM supplier)"""
GATE_SQL = SERVICES_SQL + """, gated AS (SELECT *, CASE WHEN validated IS NULL THEN 'missing_validation_evidence' WHEN NOT validated THEN 'location_not_validated'
  WHEN NOT boundary_verified THEN 'boundary_not_verified' WHEN NOT inside_footprint THEN 'outside_operational_footprint' WHEN NOT active THEN 'service_not_active'
  WHEN NOT snapped OR raw_node IS NULL THEN 'not_snapped' ELSE 'eligible' END AS eligibility FROM services)"""
POINTS_SQL = """nodes AS (SELECT CAST(s_suppkey AS VARCHAR) AS other_id, CAST(s_suppkey * 37 % 1000 AS DOUBLE) * 10 AS ox, CAST(s_suppkey * 91 % 1000 AS DOUBLE) * 10 AS oy FROM supplier),
  places AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 29 <> 0 THEN CAST(c_custkey * 53 % 1009 AS DOUBLE) * 10 END AS x, CAST(c_custkey * 17 % 1013 AS DOUBLE) * 10 AS y FROM customer)"""
AREAS_SQL = """areas AS (SELECT n_nationkey AS area_id, n_regionkey AS parent, CAST(n_nationkey % 5 AS DOUBLE) * 2000 AS x0, CAST(floor(n_nationkey / 5) AS DOUBLE) * 2000 AS y0 FROM nation)"""


def edges(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "supplier").agg(F.count("*").alias("n"))
    node = lambda c: F.col(c).cast("string")
    rows = table(spark, d, "lineitem").crossJoin(F.broadcast(n))  # one row
    return rows.select(node("l_suppkey").alias("src"), (F.col("l_partkey") % F.col("n")).cast("string").alias("dst"), F.col("l_quantity").alias("time_s"), F.col("l_extendedprice").alias("length_m"))


def nodes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("node_id"))


def origins(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "supplier").agg(F.count("*").alias("n"))
    key = F.col("c_custkey")
    rows = table(spark, d, "customer").crossJoin(F.broadcast(n))  # one row
    return rows.select(
        key.cast("string").alias("origin_id"),
        F.when(key % 11 != 0, (key % F.col("n")).cast("string")).alias("node_id"),
        (key % 7).cast("double").alias("snap_distance_m"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("population_total"),
        F.col("c_nationkey").alias("area"),
    )


def services(spark: SparkSession, d: str) -> DataFrame:
    key, kind = F.col("s_suppkey"), F.col("s_nationkey") % 4
    return table(spark, d, "supplier").select(
        F.concat(F.lit("S"), F.lpad(key.cast("string"), 6, "0")).alias("service_id"),
        F.when(kind == 0, "primary_school").when(kind == 1, "pharmacy").when(kind == 2, "hospital_establishment").otherwise("preschool").alias("service_type"),
        key.cast("string").alias("node_id"),
        (key % 5).cast("double").alias("snap_distance_m"),
        F.when(key % 10 != 9, key % 7 != 3).alias("validated"),
        (key % 13 != 5).alias("active"),
        (key % 17 != 2).alias("boundary_verified"),
        (key % 19 != 4).alias("inside_footprint"),
        (key % 23 != 6).alias("snapped"),
    )


def network_points(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("s_suppkey")
    at = lambda k: (key * k % 1000).cast("double") * 10
    return table(spark, d, "supplier").select(key.cast("string").alias("other_id"), at(37).alias("ox"), at(91).alias("oy"))


def places(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, d, "customer").select(
        key.cast("string").alias("id"), F.when(key % 29 != 0, (key * 53 % 1009).cast("double") * 10).alias("x"), ((key * 17 % 1013).cast("double") * 10).alias("y")
    )


def areas(spark: SparkSession, d: str) -> DataFrame:
    x0, y0 = (F.col("n_nationkey") % 5).cast("double") * 2000, F.floor(F.col("n_nationkey") / 5).cast("double") * 2000
    return table(spark, d, "nation").select(F.col("n_nationkey").alias("area_id"), F.col("n_regionkey").alias("parent"), rectangle(x0, y0, x0 + 2000, y0 + 2000).alias("ring"))
