"""Resolution of names, candidates, coordinates and services, and audits, over the driver's tables with faults planted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators import spatial
from waymark.plans import access, audit, domain, resolution, scenario
from waymark.plans.network_queries import REQUEST, RESULT_SQL, inputs
from waymark.plans.registry import query, table
from waymark.plans.scalar_queries import GRADES, GRADES_SQL
from waymark.plans.spec import Scenario


def text(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


@query(
    "e1_resolved_names",
    """WITH asked AS (SELECT s_suppkey AS query_id, CASE WHEN s_suppkey % 11 = 10 THEN 'Nowhere' ELSE p_name END AS name, CASE WHEN s_suppkey % 3 = 0 THEN p_brand END AS b, CASE WHEN s_suppkey % 3 = 1 THEN p_type END AS t
      FROM supplier JOIN part ON p_partkey = s_suppkey),
    found AS (SELECT query_id, count(*) AS n, string_agg('M' || p_partkey, ',' ORDER BY 'M' || p_partkey) AS candidates FROM asked JOIN part ON lower(p_name) = lower(name) AND (b IS NULL OR b = p_brand) AND (t IS NULL OR t = p_type) GROUP BY 1)
    SELECT query_id, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unknown' END AS status, CASE WHEN n = 1 THEN candidates END AS istat_code, coalesce(candidates, '') AS candidates FROM asked LEFT JOIN found USING (query_id)""",
)
def e1(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    places = part.select(text("M", "p_partkey").alias("istat_code"), F.col("p_name").alias("name"), F.col("p_brand").alias("province_code"), F.col("p_type").alias("region_code"))
    key = F.col("s_suppkey")
    names = table(spark, d, "supplier").join(part, key == F.col("p_partkey")).select(
        key.alias("query_id"), F.when(key % 11 == 10, "Nowhere").otherwise(F.upper("p_name")).alias("name"), F.when(key % 3 == 0, F.col("p_brand")).alias("province_code"), F.when(key % 3 == 1, F.col("p_type")).alias("region_code")
    )
    return resolution.resolve_names(names, resolution.dimension(places)).withColumn("candidates", F.array_join("candidates", ","))


@query(
    "e2_demographic_violations",
    """WITH s AS (SELECT c_custkey AS section_id, c_nationkey + CASE WHEN c_custkey % 13 = 4 THEN 100 ELSE 0 END AS area_id, c_custkey % 100 AS total, CASE WHEN c_custkey % 17 = 5 THEN -1 ELSE c_custkey % 3 END AS young,
      CASE WHEN c_custkey % 10 = 0 THEN 5 ELSE 0 END + c_custkey % 100 - CASE WHEN c_custkey % 17 = 5 THEN -1 ELSE c_custkey % 3 END AS old FROM customer)
    SELECT section_id, 'negative' AS reason FROM s WHERE total < 0 OR young < 0 OR old < 0 UNION ALL SELECT section_id, 'ages_do_not_add_up' FROM s WHERE young + old <> total
    UNION ALL SELECT section_id, 'unknown_area' FROM s WHERE area_id NOT IN (SELECT n_nationkey FROM nation)""",
)
def e2(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    young = F.when(key % 17 == 5, -1).otherwise(key % 3)
    sections = table(spark, d, "customer").select(
        key.alias("section_id"), (F.col("c_nationkey") + F.when(key % 13 == 4, 100).otherwise(0)).alias("area_id"), (key % 100).alias("total"), young.alias("young"), (key % 100 - young + F.when(key % 10 == 0, 5).otherwise(0)).alias("old")
    )
    return resolution.demographic_violations(sections, "total", ("young", "old"), table(spark, d, "nation").select(F.col("n_nationkey").alias("area_id")))


@query(
    "f11_health_kinds",
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'pharmacy' WHEN 1 THEN 'hospital' WHEN 2 THEN 'pharmacy' END AS mapped, CASE p_partkey % 5 WHEN 0 THEN 'pharmacy' WHEN 1 THEN 'hospital_establishment' WHEN 3 THEN 'community_house' END AS service_type,
    CASE WHEN p_size % 7 = 0 THEN 'unresolved' WHEN p_partkey % 4 = 0 THEN 'source_coordinate' WHEN p_partkey % 4 = 1 AND p_size % 2 = 0 THEN 'address_exact' WHEN p_partkey % 4 = 2 THEN 'address_approximate' ELSE 'fallback' END AS quality FROM part""",
)
def f11(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda key, n, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % n + 1).cast("int"))
    mapped = resolution.mapped_health(pick("p_partkey", 5, "Pharmacy", None, "hospital", "cafe", None), pick("p_partkey", 5, None, " HOSPITAL", "pharmacy", None, "doctor"))
    kind = resolution.health_service_type(pick("p_partkey", 5, "pharmacy", "hospital", "clinic", "cdc", None))
    quality = resolution.geocode_quality(
        F.when(F.col("p_size") % 7 != 0, 1.0), F.lit(2.0), pick("p_partkey", 4, "Ministero", "osm", None, "osm"), pick("p_partkey", 4, "address", "Address", "street_anchor", "address"), F.when(F.col("p_partkey") % 4 == 1, pick("p_size", 2, "HIGH", "low"))
    )
    return table(spark, d, "part").select("p_partkey", mapped.alias("mapped"), kind.alias("service_type"), quality.alias("quality"))


def address_book(spark: SparkSession, d: str, key: str, name: Column) -> DataFrame:
    at = F.col("p_partkey")
    return table(spark, d, "part").select(
        at.cast("string").alias(key), F.when(F.col("p_size") % 2 == 0, "hospital").otherwise("pharmacy").alias("kind"), F.concat("p_brand", F.lit("/"), "p_type").alias("area"),
        name.alias("name"), F.concat(F.lit("Via "), "p_name", F.lit(" "), F.col("p_size").cast("string")).alias("address"), (at * 37 % 997).cast("double").alias("x"), (at * 91 % 997).cast("double").alias("y"),
    )


@query("j12_matched_sources")
def j12(spark: SparkSession, d: str) -> DataFrame:
    sources = address_book(spark, d, "source_id", F.concat(F.lit("Farmacia "), F.reverse(F.col("p_name")), F.lit(" "), "p_name"))
    metres = F.col("distance_m")
    found = resolution.matched_sources(sources, address_book(spark, d, "candidate_id", F.concat("p_name", F.lit(" farmacia"))), F.when(metres <= 50, 100.0).when(metres <= 250, 85.0).otherwise(0.0))
    return found.select("source_id", "candidate_id", F.round("score", 6).alias("score"), F.round("margin", 6).alias("margin"), "status")


@query("j14_building_candidates")
def j14(spark: SparkSession, d: str) -> DataFrame:
    buildings = address_book(spark, d, "source_id", F.concat(F.lit("Scuola "), "p_name"))
    pairs = resolution.scored(buildings, address_book(spark, d, "candidate_id", F.col("p_name")))
    score = resolution.building_score(F.col("address_score"), F.col("name_score"), F.col("distance_m"))
    return resolution.best_candidates(pairs, score, 5).select("source_id", "candidate_id", "rank", F.round("score", 6).alias("score"))


@query(
    "o3_best_geocoded",
    """WITH r AS (SELECT l_orderkey AS query_key, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'review' ELSE 'rejected' END AS status, l_linenumber % 2 = 0 AS inside, l_quantity AS address_score, l_discount AS name_score,
      CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 1 ELSE 0 END AS k FROM lineitem)
    SELECT query_key, status, inside, address_score, name_score FROM (SELECT *, row_number() OVER (PARTITION BY query_key ORDER BY k DESC, inside DESC, address_score DESC, name_score DESC) AS n FROM r) WHERE n = 1""",
)
def o3(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "A", "accepted").when(F.col("l_returnflag") == "N", "review").otherwise("rejected")
    results = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("query_key"), status.alias("status"), (F.col("l_linenumber") % 2 == 0).alias("inside"), F.col("l_quantity").alias("address_score"), F.col("l_discount").alias("name_score"), F.col("l_partkey").alias("rank")
    )
    return resolution.best_geocoded(results).drop("rank")


@query(
    "e10_street_fallback",
    """WITH r AS (SELECT l_orderkey AS query_key, CAST(l_partkey AS VARCHAR) AS street, max(l_quantity * 2) AS street_score, max(l_returnflag = 'A') AS inside, max(80 + l_discount * 100) AS road_score FROM lineitem GROUP BY 1, 2),
    n AS (SELECT *, row_number() OVER w AS rank, lead(street_score) OVER w AS second FROM r WINDOW w AS (PARTITION BY query_key ORDER BY street_score DESC, street))
    SELECT query_key, street, street_score, street_score - coalesce(second, 0) AS margin, CASE WHEN street_score >= 90 AND street_score - coalesce(second, 0) >= 8 AND inside AND road_score >= 85 THEN 'accepted' WHEN street_score >= 75 THEN 'review' ELSE 'unresolved' END AS status FROM n WHERE rank = 1""",
)
def e10(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("query_key"), F.col("l_partkey").cast("string").alias("street"))
    return resolution.street_fallback(rows.agg(F.max(F.col("l_quantity") * 2).alias("street_score"), F.max(F.col("l_returnflag") == "A").alias("inside"), F.max(80 + F.col("l_discount") * 100).alias("road_score")))


@query(
    "e11_located",
    """SELECT c_custkey AS building_id, coalesce(o.k, p.k, CASE WHEN c_custkey % 4 <> 3 THEN c_custkey END)::DOUBLE AS x, CASE WHEN o.k IS NOT NULL THEN 'osm' WHEN p.k IS NOT NULL THEN 'peer' WHEN c_custkey % 4 <> 3 THEN 'geocoder' ELSE 'unresolved' END AS coordinate_source
    FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS k FROM orders WHERE o_totalprice > 300000 GROUP BY 1) o ON o_custkey = c_custkey
    LEFT JOIN (SELECT c_nationkey, c_mktsegment, min(c_custkey) AS k FROM customer WHERE c_acctbal > 9000 GROUP BY 1, 2) p USING (c_nationkey, c_mktsegment)""",
)
def e11(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").withColumnRenamed("c_custkey", "building_id")
    at = lambda c: [F.col(c).cast("double").alias(a) for a in ("x", "y")]
    osm = table(spark, d, "orders").where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("building_id")).agg(F.min("o_orderkey").alias("k")).select("building_id", *at("k"))
    peers = customers.where("c_acctbal > 9000").groupBy("c_nationkey", "c_mktsegment").agg(F.min("building_id").alias("k"))
    peer = customers.join(peers, ["c_nationkey", "c_mktsegment"]).select("building_id", *at("k"))
    geocoder = customers.where("building_id % 4 <> 3").select("building_id", *at("building_id"))
    return resolution.located(customers.select("building_id"), ("osm", osm), ("peer", peer), ("geocoder", geocoder)).drop("y")


@query(
    "e13_health_coordinates",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN a >= 90 AND m >= 12 AND (n >= 40 OR far <= 100) THEN 'promoted' WHEN NOT s AND far <= 100 THEN 'confirmed' WHEN NOT s AND far > 250 THEN 'conflict' ELSE 'review' END AS status
    FROM (SELECT *, l_quantity * 2 AS a, l_discount * 200 AS m, l_tax * 1000 AS n, (l_partkey % 50) * 8 AS far, l_returnflag = 'R' AS s FROM lineitem)""",
)
def e13(spark: SparkSession, d: str) -> DataFrame:
    status = resolution.health_coordinate(F.col("l_quantity") * 2, F.col("l_discount") * 200, F.col("l_tax") * 1000, ((F.col("l_partkey") % 50) * 8).cast("double"), F.col("l_returnflag") == "R")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", status.alias("status"))


def relations(spark: SparkSession, d: str) -> DataFrame:
    part, n = table(spark, d, "part"), len(GRADES)
    codes = part.groupBy((F.col("p_partkey") % 97).alias("s_suppkey")).agg(F.collect_list(text("C", "p_partkey")).alias("school_codes"))
    sites = table(spark, d, "supplier").join(codes, "s_suppkey", "left").select(text("EDU", "s_suppkey").alias("site_id"), F.when(F.col("s_suppkey") % 10 != 3, F.col("school_codes")).alias("school_codes"))
    grade = F.element_at(F.array(*[F.lit(g) for g, _ in GRADES]), (F.col("p_partkey") % n + 1).cast("int"))
    registry = part.where("p_partkey % 13 <> 1").select(text("C", "p_partkey").alias("school_code"), grade.alias("grade"), F.when(F.col("p_size") % 2 == 0, "statale").otherwise("paritaria").alias("ownership"))
    return resolution.site_relations(sites, registry)


RELATIONS_SQL = f"""g(i, label, kind) AS (VALUES {GRADES_SQL}),
  r AS (SELECT 'EDU' || s_suppkey AS site_id, 'C' || p_partkey AS school_code, p_partkey % 13 <> 1 AS known, kind, label, CASE WHEN p_size % 2 = 0 THEN 'statale' ELSE 'paritaria' END AS ownership
    FROM supplier LEFT JOIN part ON p_partkey % 97 = s_suppkey AND s_suppkey % 10 <> 3 LEFT JOIN g ON p_partkey % {len(GRADES)} = i)"""


@query(
    "j19_site_relations",
    f"""WITH {RELATIONS_SQL} SELECT site_id, school_code, CASE WHEN known THEN kind END AS service_type, CASE WHEN school_code IS NULL THEN 'unresolved_no_school_code' WHEN NOT known THEN 'unresolved_registry_miss' WHEN kind IS NULL THEN 'unresolved_grade' ELSE 'classified' END AS status FROM r""",
)
def j19(spark: SparkSession, d: str) -> DataFrame:
    return relations(spark, d).select("site_id", "school_code", "service_type", "status")


@query(
    "e14_service_layer",
    f"""WITH {RELATIONS_SQL}, s AS (SELECT site_id, kind AS service_type, CASE WHEN min(ownership) = max(ownership) THEN min(ownership) ELSE 'mixed_ownership' END AS service_subtype, string_agg(school_code, ',' ORDER BY school_code) AS source_records
      FROM r WHERE known AND kind IS NOT NULL GROUP BY 1, 2 UNION ALL SELECT 'HEALTH' || s_suppkey, CASE s_nationkey % 4 WHEN 0 THEN 'pharmacy' WHEN 1 THEN 'hospital_establishment' ELSE 'community_house' END, NULL, s_name FROM supplier WHERE s_nationkey % 4 <> 3)
    SELECT site_id || '::' || service_type AS service_id, * FROM s""",
)
def e14(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("s_nationkey") % 4
    health = table(spark, d, "supplier").select(text("HEALTH", "s_suppkey").alias("site_id"), F.when(kind == 0, "pharmacy").when(kind == 1, "hospital").when(kind == 2, "cdc").otherwise("clinic").alias("subcategory"), F.col("s_name").alias("source_record"))
    return resolution.service_layer(relations(spark, d), health).withColumn("source_records", F.array_join("source_records", ","))


@query("m5_near_areas", f"WITH {domain.POINTS_SQL}, {domain.AREAS_SQL} SELECT DISTINCT id, parent AS area_id FROM places, areas WHERE x IS NOT NULL AND greatest(x0 - x, 0, x - x0 - 2000) ** 2 + greatest(y0 - y, 0, y - y0 - 2000) ** 2 <= 22500")
def m5(spark: SparkSession, d: str) -> DataFrame:
    parts = domain.areas(spark, d).select(F.col("parent").alias("area_id"), "ring")  # a region is its nations' squares
    return spatial.near_areas(domain.places(spark, d), parts, 150.0, 1000.0)


@query("e22_eligibility_counts", f"WITH {domain.GATE_SQL} SELECT service_type, eligibility, count(*) AS services, round(count(*) / sum(count(*)) OVER (PARTITION BY service_type), 9) AS share FROM gated GROUP BY 1, 2")
def e22(spark: SparkSession, d: str) -> DataFrame:
    return audit.eligibility_counts(inputs(spark, d)[1]).withColumn("share", F.round("share", 9))


@query("e22_geography_counts", f"WITH {domain.GATE_SQL} SELECT service_type, count(*) AS total, count(*) FILTER (inside_footprint) AS inside, count(*) FILTER (NOT inside_footprint) AS outside, count(*) FILTER (inside_footprint IS NULL) AS missing, count(*) FILTER (eligibility = 'eligible') AS routable FROM gated GROUP BY 1")
def e22_geography(spark: SparkSession, d: str) -> DataFrame:
    return audit.geography_counts(inputs(spark, d)[1])


@query(
    "a10_scenario_metrics",
    RESULT_SQL + " SELECT count(minutes) AS origins_reached, round(sum(target_population) FILTER (minutes IS NOT NULL), 4) AS population_reached, round(avg(minutes), 6) AS mean_min, CAST(sum(n2) AS BIGINT) AS opportunities_within_2_min, round(sum(n2 * target_population) / sum(target_population), 6) AS mean_opportunities_within_2_min FROM result",
)
def a10(spark: SparkSession, d: str) -> DataFrame:
    found = audit.scenario_metrics(access.access(*inputs(spark, d), REQUEST), REQUEST)
    return found.select("origins_reached", F.round("population_reached", 4).alias("population_reached"), F.round("mean_min", 6).alias("mean_min"), "opportunities_within_2_min", F.round("mean_opportunities_within_2_min", 6).alias("mean_opportunities_within_2_min"))


@query(
    "e20_long_deltas",
    """WITH b AS (SELECT c_nationkey AS area, count(*)::DOUBLE AS n, sum(c_custkey)::DOUBLE AS keys FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1), a AS (SELECT c_nationkey AS area, count(*)::DOUBLE AS n, sum(c_custkey)::DOUBLE AS keys FROM customer WHERE c_custkey % 3 <> 0 AND c_nationkey <> 4 GROUP BY 1),
    m AS (SELECT area, unnest(['n', 'keys']) AS metric, unnest([b.n, b.keys]) AS before, unnest([a.n, a.keys]) AS after FROM b FULL JOIN a USING (area))
    SELECT area, metric, before, after, after - before AS delta, round(CASE WHEN before <> 0 THEN (after - before) / before * 100 END, 9) AS change_percent FROM m""",
)
def e20(spark: SparkSession, d: str) -> DataFrame:
    per = lambda rows: table(spark, d, "customer").where(rows).groupBy(F.col("c_nationkey").alias("area")).agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
    found = audit.long_deltas(per("c_custkey % 2 = 0"), per("c_custkey % 3 <> 0 AND c_nationkey <> 4"), ["area"], ["n", "keys"])
    return found.withColumn("change_percent", F.round("change_percent", 9))


@query(
    "e24_unreconciled",
    "SELECT n_nationkey AS area, 'only_before' AS wrong FROM nation WHERE n_nationkey = 7 UNION ALL SELECT n_nationkey, 'minutes' FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT n_nationkey, 'people' FROM nation WHERE n_nationkey % 10 = 5 UNION ALL SELECT 99, 'only_after'",
)
def e24(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("n_nationkey")
    one = table(spark, d, "nation").select(key.alias("area"), (key * 1.5).alias("minutes"), F.when(key % 2 == 0, key).alias("people"))
    two = one.where("area <> 7").withColumns({"minutes": F.col("minutes") * (1 + 1e-12) + F.when(F.col("area") % 5 == 0, 1).otherwise(0), "people": F.when(F.col("area") % 10 == 5, 1).otherwise(F.col("people"))})
    return audit.unreconciled(one, two.unionByName(spark.sql("SELECT 99 AS area, 1.0D AS minutes, 1 AS people")), ["area"], ["minutes", "people"])


@query("e16_rising_times", "SELECT CAST(c_custkey AS VARCHAR) AS origin_id FROM customer WHERE c_custkey % 71 = 5 OR c_custkey % 67 = 6 OR c_custkey % 61 = 7")
def e16_rising(spark: SparkSession, d: str) -> DataFrame:
    key, speed = F.col("c_custkey"), F.col("speed_mps")
    rows = table(spark, d, "customer").select(key, F.explode(F.array(*[F.lit(v) for v in (0.7, 0.9, 1.1)])).alias("speed_mps"))
    fast = speed == 1.1
    minutes = F.when(fast & (key % 71 == 5), 500.0).when(fast & (key % 67 == 6), F.lit(None)).when(key % 5 != 0, 100 / speed).otherwise(F.when(key % 67 == 6, 100 / speed))
    count = F.when(fast & (key % 61 == 7), 0).otherwise(3)
    planted = rows.select(key.cast("string").alias("origin_id"), speed, F.when((key % 71 == 5) & ~fast, 100 / speed).otherwise(minutes).alias("nearest_service_time_min"), count.alias("opportunity_count_within_2_min"))
    return audit.rising_times(planted)


@query("e25_result_violations", "SELECT CAST(c_custkey AS VARCHAR) AS origin_id FROM customer WHERE c_custkey % 97 = 1 OR c_custkey % 101 = 2 OR c_custkey % 89 = 3")
def e25(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    reachable = (key % 3 != 0) | (key % 97 == 1)
    planted = table(spark, d, "customer").select(
        key.cast("string").alias("origin_id"), F.when(reachable, "reachable").otherwise("no_path").alias("reachability_status"),
        F.when(key % 97 == 1, F.lit(None)).when(key % 89 == 3, -1.0).when(reachable, (key % 50) / 10).alias("nearest_service_time_min"),
        F.when(key % 101 == 2, 9).otherwise(1).alias(access.opportunity(1)), F.lit(2).alias(access.opportunity(2)), F.lit(2).alias(access.opportunity(3)),
    )
    return access.violations(planted, REQUEST).select("origin_id")


@query("e18_invariants", "SELECT CAST(c_custkey AS VARCHAR) AS origin_id FROM customer WHERE c_custkey % 89 = 3 OR c_custkey % 83 = 4 OR c_custkey % 79 = 5")
def e18_invariants(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    before = F.when(key % 79 == 5, F.lit(None)).otherwise((key % 50).cast("double"))
    after = F.when(key % 89 == 3, (key % 50) - 1.0).when(key % 7 == 0, F.when(key % 79 == 5, 1.0)).otherwise((key % 50) + 1.0)
    planted = table(spark, d, "customer").select(
        key.cast("string").alias("origin_id"), before.alias("before_nearest_service_time_min"), after.alias("after_nearest_service_time_min"), F.when(key % 83 == 4, 1).otherwise(0).alias("delta_opportunity_count_within_1_min")
    )
    return scenario.against_supply(planted, Scenario(REQUEST, removed=frozenset(["S1"]))).select("origin_id")
