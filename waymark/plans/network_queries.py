"""Graphs, spatial joins, accessibility, scenarios and audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.functions import geo, hashes
from waymark.operators import graph, spatial
from waymark.operators.gates import routing_gate
from waymark.plans import access, demand, domain, scenario
from waymark.plans.registry import query, table
from waymark.plans.spec import AccessRequest, Scenario

REQUEST = AccessRequest("primary_school", thresholds=(1, 2, 3), off_network_mps=1.0)

#: Routes of least time, then length, to every eligible service of a type: DuckDB's keyed recursion keeps the best.
ROUTES_SQL = f"""{domain.ARCS_SQL}, {domain.ORIGINS_SQL}, {domain.GATE_SQL},
  own AS (SELECT service_id, CASE WHEN eligibility = 'eligible' THEN raw_node END AS target, raw_snap FROM gated WHERE service_type = 'primary_school'),
  costs(target, node, time_s, dist_m) USING KEY (target, node) AS (
    SELECT DISTINCT target, target AS node, 0.0::DOUBLE AS time_s, 0.0::DOUBLE AS dist_m FROM own WHERE target IS NOT NULL
    UNION
    SELECT n.target, n.node, n.best[1], n.best[2] FROM (
      SELECT c.target, a.src AS node, min([c.time_s + a.time_s, c.dist_m + a.length_m]) AS best FROM costs c JOIN arcs a ON a.dst = c.node GROUP BY 1, 2) n
    LEFT JOIN recurring.costs k ON k.target = n.target AND k.node = n.node
    WHERE k.node IS NULL OR n.best < [k.time_s, k.dist_m]),
  pairs AS (SELECT origin_id, service_id, time_s + (snap_distance_m + raw_snap) / 1.0 AS total_s, dist_m + snap_distance_m + raw_snap AS dist_m FROM origins o JOIN costs c ON o.node_id = c.node JOIN own USING (target))"""
RESULT_SQL = f"""WITH RECURSIVE {ROUTES_SQL}, best AS (SELECT origin_id, min([total_s]) AS t, count(*) FILTER (total_s <= 60) AS n1, count(*) FILTER (total_s <= 120) AS n2, count(*) FILTER (total_s <= 180) AS n3 FROM pairs GROUP BY 1),
  named AS (SELECT *, row_number() OVER (PARTITION BY origin_id ORDER BY total_s, service_id) AS rank FROM pairs),
  result AS (SELECT o.origin_id, o.area, population_total AS target_population, b.service_id AS nearest_service_id, b.total_s / 60 AS minutes, b.dist_m,
    CASE WHEN b.total_s IS NOT NULL THEN 'reachable' WHEN o.node_id IS NULL THEN 'origin_not_snapped' WHEN (SELECT count(*) FROM own) = 0 THEN 'service_unavailable' WHEN (SELECT count(target) FROM own) = 0 THEN 'service_not_snapped' ELSE 'no_path' END AS reachability_status,
    coalesce(n1, 0) AS n1, coalesce(n2, 0) AS n2, coalesce(n3, 0) AS n3
    FROM origins o LEFT JOIN (SELECT * FROM named WHERE rank = 1) b USING (origin_id) LEFT JOIN best USING (origin_id))"""


def inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return domain.origins(spark, d), routing_gate(domain.services(spark, d)), domain.edges(spark, d)


@query("g1_parallel_arcs", f"WITH {domain.ARCS_SQL} SELECT src, dst, time_s, length_m FROM arcs")
def g1(spark: SparkSession, d: str) -> DataFrame:
    return graph.strict_graph(domain.nodes(spark, d), domain.edges(spark, d))


@query("g2_bad_edges", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity > 49 THEN 'bad_weight' ELSE 'unknown_endpoint' END AS reason FROM lineitem WHERE l_quantity > 49 OR l_partkey % 10 = 7")
def g2(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_suppkey").cast("string").alias("src"), F.when((F.col("l_partkey") % 10 == 7) & (F.col("l_quantity") <= 49), "nowhere").otherwise("0").alias("dst"), F.when(F.col("l_quantity") <= 49, F.col("l_quantity")).alias("time_s"), F.lit(1.0).alias("length_m")
    )
    return graph.bad_edges(rows, domain.nodes(spark, d)).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reason")


COMPONENT_EDGES = "SELECT CAST(c_custkey AS VARCHAR) AS src, CAST(CASE WHEN c_custkey % 10 < 7 THEN c_custkey - c_custkey % 10 ELSE c_custkey END AS VARCHAR) AS dst FROM customer"


@query("g3_weak_components", f"WITH e AS ({COMPONENT_EDGES}), r AS (SELECT src AS node_id, min(src) OVER (PARTITION BY dst) AS root FROM e), s AS (SELECT root, count(*) AS component_size FROM r GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY component_size DESC, root) AS component_rank FROM s) SELECT node_id, component_rank, component_size, component_rank = 1 AS is_largest FROM r JOIN k USING (root)")
def g3(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey")
    links = table(spark, d, "customer").select(key.cast("string").alias("src"), F.when(key % 10 < 7, key - key % 10).otherwise(key).cast("string").alias("dst"))
    roots = graph.weak_components(links.select(F.col("src").alias("node_id")), links)
    return graph.ranked_components(roots)


@query("g5_lexicographic_routes", f"WITH RECURSIVE {ROUTES_SQL} SELECT target, node, time_s, round(dist_m, 4) AS dist_m FROM costs")
def g5(spark: SparkSession, d: str) -> DataFrame:
    _, services, arcs = inputs(spark, d)
    targets = services.where("service_type = 'primary_school' AND node_id IS NOT NULL").select(F.col("node_id").alias("target"))
    return graph.costs_to_targets(arcs, targets).select("target", "node", "time_s", F.round("dist_m", 4).alias("dist_m"))


@query("g4_routes_by_joins", f"WITH RECURSIVE {ROUTES_SQL} SELECT target, node, time_s, round(dist_m, 4) AS dist_m FROM costs")
def g4(spark: SparkSession, d: str) -> DataFrame:
    _, services, arcs = inputs(spark, d)
    targets = services.where("service_type = 'primary_school' AND node_id IS NOT NULL").select(F.col("node_id").alias("target")).distinct()
    return graph.relaxed(arcs, targets).select("target", "node", "time_s", F.round("dist_m", 4).alias("dist_m"))


@query("g7_reweighted", f"WITH {domain.EDGES_SQL} SELECT src, dst, round(min(length_m / 1.2), 6) AS time_s FROM edges GROUP BY 1, 2")
def g7(spark: SparkSession, d: str) -> DataFrame:
    return graph.collapsed(graph.reweighted(domain.edges(spark, d), 1.2)).select("src", "dst", F.round("time_s", 6).alias("time_s"))


@query("g8_unknown_nodes", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS node_id FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)")
def g8(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("node_id")).distinct()
    return used.join(domain.nodes(spark, d), "node_id", "left_anti")


@query("g9_clusters", "SELECT min(CAST(s_suppkey AS VARCHAR)) AS root, count(*) AS members, arg_max(CAST(s_suppkey AS VARCHAR), s_acctbal * 100000 - s_suppkey) AS representative FROM supplier GROUP BY s_suppkey - s_suppkey % 4")
def g9(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("s_suppkey")
    members = table(spark, d, "supplier").select(key.cast("string").alias("node_id"), F.col("s_acctbal").alias("score"), key.alias("position"))
    pairs = table(spark, d, "supplier").select((key - key % 4).cast("string").alias("src"), key.cast("string").alias("dst"))
    return graph.clustered(members, pairs, "score")


@query("j10_nearest_node", f"WITH {domain.POINTS_SQL} SELECT id, other_id, round(m, 6) AS distance_m FROM (SELECT id, other_id, sqrt(pow(x - ox, 2) + pow(y - oy, 2)) AS m, row_number() OVER (PARTITION BY id ORDER BY sqrt(pow(x - ox, 2) + pow(y - oy, 2)), other_id) AS rank FROM places, nodes WHERE x IS NOT NULL) WHERE rank = 1")
def j10(spark: SparkSession, d: str) -> DataFrame:
    return spatial.nearest(domain.places(spark, d), domain.network_points(spark, d), 250.0).select("id", "other_id", F.round("distance_m", 6).alias("distance_m"))


@query("j11_nearby_count", f"WITH {domain.POINTS_SQL} SELECT id, count(*) AS near, round(min(sqrt(pow(x - ox, 2) + pow(y - oy, 2))), 6) AS least_m FROM places, nodes WHERE sqrt(pow(x - ox, 2) + pow(y - oy, 2)) <= 600 GROUP BY 1")
def j11(spark: SparkSession, d: str) -> DataFrame:
    return spatial.in_range(domain.places(spark, d), domain.network_points(spark, d), 600.0).groupBy("id").agg(F.count("*").alias("near"), F.round(F.min("distance_m"), 6).alias("least_m"))


@query("j8_strictly_within", f"WITH {domain.POINTS_SQL}, {domain.AREAS_SQL} SELECT id, area_id FROM places, areas WHERE x > x0 AND x < x0 + 2000 AND y > y0 AND y < y0 + 2000")
def j8(spark: SparkSession, d: str) -> DataFrame:
    return spatial.polygons_of(domain.places(spark, d), domain.areas(spark, d), 1000.0, boundary=False).select("id", "area_id")


@query("j9_covered", f"WITH {domain.POINTS_SQL}, {domain.AREAS_SQL} SELECT DISTINCT id FROM places, areas WHERE x BETWEEN x0 AND x0 + 2000 AND y BETWEEN y0 AND y0 + 2000")
def j9(spark: SparkSession, d: str) -> DataFrame:
    return spatial.polygons_of(domain.places(spark, d), domain.areas(spark, d), 1000.0, boundary=True).select("id").distinct()


@query("m3_area_density", f"WITH {domain.AREAS_SQL} SELECT area_id, 4000000.0::DOUBLE AS area_m2, round(coalesce(n, 0) / 4.0, 6)::DOUBLE AS per_km2 FROM areas LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) ON c_nationkey = area_id")
def m3(spark: SparkSession, d: str) -> DataFrame:
    people = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("area_id")).agg(F.count("*").alias("n"))
    area = geo.ring_area(F.col("ring"))
    return domain.areas(spark, d).join(people, "area_id", "left").select("area_id", area.alias("area_m2"), F.round(F.when(area > 0, F.coalesce("n", F.lit(0)) / (area / 1e6)), 6).alias("per_km2"))


@query("m6_distance_to_area", f"WITH {domain.POINTS_SQL}, {domain.AREAS_SQL} SELECT id, round(sqrt(pow(greatest(x0 - x, 0, x - x0 - 2000), 2) + pow(greatest(y0 - y, 0, y - y0 - 2000), 2)), 6) AS metres FROM places, areas WHERE area_id = 12 AND x IS NOT NULL")
def m6(spark: SparkSession, d: str) -> DataFrame:
    one = domain.areas(spark, d).where("area_id = 12").select("ring")
    points = domain.places(spark, d).where("x IS NOT NULL")
    return points.crossJoin(F.broadcast(one)).select("id", F.round(geo.distance_to_ring(F.col("x"), F.col("y"), F.col("ring")), 6).alias("metres"))  # one row


@query("m4_interior_points", f"WITH {domain.AREAS_SQL} SELECT area_id, x0 + 1000 AS x, y0 + 1000 AS y FROM areas")
def m4(spark: SparkSession, d: str) -> DataFrame:
    return domain.areas(spark, d).select("area_id", geo.interior_point(F.col("ring")).alias("p")).select("area_id", "p.x", "p.y")


@query("e3_population_origins", f"""WITH {domain.POINTS_SQL}, {domain.AREAS_SQL}, inside AS (SELECT area_id, other_id AS node_id FROM nodes, areas WHERE ox > x0 AND ox < x0 + 2000 AND oy > y0 AND oy < y0 + 2000),
  shared AS (SELECT area_id, node_id, 1.0 / count(*) OVER (PARTITION BY area_id) AS share, 0.0 AS snap, 'nodes_inside' AS method FROM inside),
  rest AS (SELECT area_id, other_id AS node_id, 1.0 AS share, m AS snap, 'nearest_node' AS method FROM (SELECT area_id, other_id, sqrt(pow(x0 + 1000 - ox, 2) + pow(y0 + 1000 - oy, 2)) AS m, row_number() OVER (PARTITION BY area_id ORDER BY sqrt(pow(x0 + 1000 - ox, 2) + pow(y0 + 1000 - oy, 2)), other_id) AS rank FROM areas, nodes WHERE area_id NOT IN (SELECT area_id FROM inside)) WHERE rank = 1),
  seen AS (SELECT c_nationkey AS area_id, sum(greatest(c_acctbal, 0)) AS population FROM customer WHERE c_nationkey % 6 <> 1 GROUP BY 1)
  SELECT area_id, node_id, round(share, 9)::DOUBLE AS share, round(snap, 6)::DOUBLE AS snap_distance_m, method, round(population * share, 4)::DOUBLE AS population, CASE WHEN population IS NULL THEN 'no_observation' ELSE 'assigned' END AS status
  FROM (SELECT * FROM shared UNION ALL SELECT * FROM rest) LEFT JOIN seen USING (area_id)""")
def e3(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "customer").where("c_nationkey % 6 <> 1").groupBy(F.col("c_nationkey").alias("area_id")).agg(F.sum(F.greatest(F.col("c_acctbal"), F.lit(0.0))).alias("population"))
    found = demand.origins(domain.areas(spark, d).select("area_id", "ring"), seen, domain.network_points(spark, d), 1000.0, 500.0)
    return found.select("area_id", "node_id", F.round("share", 9).alias("share"), F.round("snap_distance_m", 6).alias("snap_distance_m"), "method", F.round("population", 4).alias("population"), "status")


ATTACHED_SQL = f"""WITH {domain.POINTS_SQL}, near AS (SELECT id, other_id, m FROM (SELECT id, other_id, sqrt(pow(x - ox, 2) + pow(y - oy, 2)) AS m, row_number() OVER (PARTITION BY id ORDER BY sqrt(pow(x - ox, 2) + pow(y - oy, 2)), other_id) AS rank FROM places, nodes WHERE x IS NOT NULL) WHERE rank = 1)
  SELECT id, %s AS node_id, round(m, 6) AS snap_distance_m, coalesce(m <= 400, false) AS snapped, CASE WHEN x IS NULL THEN 'missing_geometry' WHEN m > 400 THEN 'snap_outlier' ELSE 'snapped' END AS attachment_quality FROM places LEFT JOIN near USING (id)"""


@query("e4_attachments", ATTACHED_SQL.replace("%s", "CASE WHEN m <= 400 THEN other_id END"))
def e4(spark: SparkSession, d: str) -> DataFrame:
    return demand.attachments(domain.places(spark, d), domain.network_points(spark, d), 400.0, 250.0).withColumn("snap_distance_m", F.round("snap_distance_m", 6))


@query("e5_attachments_keeping_outliers", ATTACHED_SQL.replace("%s", "other_id"))
def e5(spark: SparkSession, d: str) -> DataFrame:
    return demand.attachments(domain.places(spark, d), domain.network_points(spark, d), 400.0, 250.0, keep_outliers=True).withColumn("snap_distance_m", F.round("snap_distance_m", 6))


@query("j17_origin_service_times", f"WITH RECURSIVE {ROUTES_SQL} SELECT origin_id, service_id, total_s, round(dist_m, 4) AS dist_m FROM pairs")
def j17(spark: SparkSession, d: str) -> DataFrame:
    origins, services, arcs = inputs(spark, d)
    own = services.where("service_type = 'primary_school'").withColumn("position", F.col("service_id"))
    return access.origin_service_times(origins, own, arcs, REQUEST).select("origin_id", "service_id", "total_s", F.round("dist_m", 4).alias("dist_m"))


@query("e15_accessibility", RESULT_SQL + " SELECT origin_id, target_population, nearest_service_id, round(minutes, 9) AS nearest_service_time_min, round(dist_m, 4) AS nearest_service_distance_m, reachability_status, CAST(n1 AS INTEGER) AS opportunity_count_within_1_min, CAST(n2 AS INTEGER) AS opportunity_count_within_2_min, CAST(n3 AS INTEGER) AS opportunity_count_within_3_min, n1 > 0 AS has_service_within_1_min, n2 > 0 AS has_service_within_2_min, n3 > 0 AS has_service_within_3_min FROM result")
def e15(spark: SparkSession, d: str) -> DataFrame:
    found = access.access(*inputs(spark, d), REQUEST).drop("service_count_total", "service_count_routable")
    return found.withColumns({"nearest_service_time_min": F.round("nearest_service_time_min", 9), "nearest_service_distance_m": F.round("nearest_service_distance_m", 4)})


ROLLUP = "round(sum(target_population), 4) AS population, round(coalesce(sum(target_population) FILTER (minutes IS NOT NULL), 0), 4) AS reachable_population, round(sum(target_population * minutes) / nullif(sum(target_population) FILTER (minutes IS NOT NULL), 0), 6) AS weighted_mean_min, round(coalesce(sum(target_population) FILTER (n2 > 0), 0) / nullif(sum(target_population), 0), 6) AS population_coverage_within_2_min FROM result"


def rolled(spark: SparkSession, d: str, by: list[str]) -> DataFrame:
    origins, services, arcs = inputs(spark, d)
    result = access.access(origins, services, arcs, REQUEST).join(origins.select("origin_id", "area"), "origin_id")
    rows = access.rollup(result, REQUEST, by)
    round_ = lambda c, n: F.round(c, n).alias(c)
    return rows.select(*by, round_("population", 4), round_("reachable_population", 4), round_("weighted_mean_min", 6), round_("population_coverage_within_2_min", 6))


@query("a6_area_rollup", RESULT_SQL + f" SELECT area, {ROLLUP} GROUP BY 1")
def a6(spark: SparkSession, d: str) -> DataFrame:
    return rolled(spark, d, ["area"])


@query("a7_overall_rollup", RESULT_SQL + f" SELECT {ROLLUP}")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return rolled(spark, d, [])


@query("f8_reachability", RESULT_SQL + " SELECT reachability_status, count(*) AS n FROM result GROUP BY 1")
def f8(spark: SparkSession, d: str) -> DataFrame:
    return access.access(*inputs(spark, d), REQUEST).groupBy("reachability_status").agg(F.count("*").alias("n"))


@query("a18_nearest_population", RESULT_SQL + " SELECT service_id, round(coalesce(sum(target_population), 0), 4) AS nearest_population FROM own LEFT JOIN result ON nearest_service_id = service_id WHERE target IS NOT NULL GROUP BY 1")
def a18(spark: SparkSession, d: str) -> DataFrame:
    origins, services, arcs = inputs(spark, d)
    lost = scenario.leave_one_out(origins, services, arcs, REQUEST)
    return lost.select(F.col("removed_service_id").alias("service_id"), F.round("nearest_population", 4).alias("nearest_population"))


@query("e17_leave_one_out", f"WITH RECURSIVE {ROUTES_SQL}, two AS (SELECT *, row_number() OVER w AS rank, lead(total_s) OVER w AS next_s FROM pairs WINDOW w AS (PARTITION BY origin_id ORDER BY total_s, service_id)) SELECT o.service_id AS removed_service_id, round(coalesce(sum(population_total) FILTER (next_s IS NULL), 0), 4) AS lost_population, round(coalesce(sum(population_total) FILTER (total_s <= 60 AND coalesce(next_s > 60, true)), 0), 4) AS lost_within_1_min FROM own o LEFT JOIN two t ON t.service_id = o.service_id AND rank = 1 LEFT JOIN origins USING (origin_id) WHERE target IS NOT NULL GROUP BY 1")
def e17(spark: SparkSession, d: str) -> DataFrame:
    lost = scenario.leave_one_out(*inputs(spark, d), REQUEST)
    return lost.select("removed_service_id", F.round("lost_population", 4).alias("lost_population"), F.round("lost_within_1_min", 4).alias("lost_within_1_min"))


def removal(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, Scenario]:
    origins, services, arcs = inputs(spark, d)
    small = services.select("service_id", "service_type", "node_id", "snap_distance_m")
    gone = [r["service_id"] for r in small.where("service_type = 'primary_school' AND node_id IS NOT NULL").orderBy("service_id").limit(2).collect()]
    return origins, small, arcs, Scenario(REQUEST, removed=frozenset(gone), added=(("NEW1", "1"),))


SCENARIO_SQL = RESULT_SQL.replace("own AS (SELECT", "own0 AS (SELECT").replace(
    "costs(target", "gone AS (SELECT service_id FROM own0 WHERE target IS NOT NULL ORDER BY 1 LIMIT 2), own AS (SELECT * FROM own0 WHERE service_id NOT IN (SELECT service_id FROM gone) UNION ALL SELECT 'NEW1', '1', 0.0), costs(target"
)


@query("e18_scenario", SCENARIO_SQL + " SELECT origin_id, round(minutes, 9) AS after_min, n2 AS after_count FROM result")
def e18(spark: SparkSession, d: str) -> DataFrame:
    origins, services, arcs, plan = removal(spark, d)
    after = access.access(origins, scenario.overlaid(services, plan), arcs, REQUEST)
    return after.select("origin_id", F.round("nearest_service_time_min", 9).alias("after_min"), F.col("opportunity_count_within_2_min").cast("bigint").alias("after_count"))


@query("e18_scenario_changes")
def e18_changes(spark: SparkSession, d: str) -> DataFrame:
    origins, services, arcs, plan = removal(spark, d)
    return scenario.run_scenario(origins, services, arcs, plan)[2]


@query("e16_speed_sensitivity")
def e16(spark: SparkSession, d: str) -> DataFrame:
    origins, services, _ = inputs(spark, d)
    edges = domain.edges(spark, d).withColumn("length_m", F.col("length_m") / 1000)
    found = scenario.speed_sensitivity(origins, services, edges, REQUEST, (0.9, 1.1, 1.4))
    return found.groupBy("speed_mps").agg(F.round(F.avg("nearest_service_time_min"), 6).alias("mean_min"), F.sum("opportunity_count_within_2_min").alias("opportunities"))


@query("e3_conservation", "SELECT 0 AS area_id WHERE false")
def e3_conservation(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("area_id")).agg(F.sum(F.greatest(F.col("c_acctbal"), F.lit(0.0))).alias("population"))
    parts = demand.origins(domain.areas(spark, d).select("area_id", "ring"), seen, domain.network_points(spark, d), 1000.0, 500.0)
    return demand.not_conserved(parts, seen).select("area_id")


@query("a16_proximity_coverage", f"WITH {domain.POINTS_SQL}, n AS (SELECT id, min(sqrt(pow(x - ox, 2) + pow(y - oy, 2))) AS m FROM places, nodes WHERE x IS NOT NULL GROUP BY 1) SELECT count(*) AS n, count(*) FILTER (m <= 25) AS within_25, count(*) FILTER (m <= 50) AS within_50, count(*) FILTER (m <= 100) AS within_100, count(*) FILTER (m <= 250) AS within_250 FROM n")
def a16(spark: SparkSession, d: str) -> DataFrame:
    near = spatial.nearest(domain.places(spark, d), domain.network_points(spark, d), 250.0)
    return near.agg(F.count("*").alias("n"), *[F.count(F.when(F.col("distance_m") <= m, 1)).alias(f"within_{m}") for m in (25, 50, 100, 250)])


@query("a17_unpaired", f"WITH {domain.POINTS_SQL} SELECT id FROM places WHERE x IS NOT NULL AND id NOT IN (SELECT id FROM places, nodes WHERE sqrt(pow(x - ox, 2) + pow(y - oy, 2)) <= 150)")
def a17(spark: SparkSession, d: str) -> DataFrame:
    points = domain.places(spark, d).where("x IS NOT NULL")
    return points.join(spatial.in_range(points, domain.network_points(spark, d), 150.0), "id", "left_anti").select("id")


@query("h3_table_digest", "SELECT sha256(concat_ws('|', count(*), sum(('0x' || substr(h, 1, 15))::BIGINT), sum(('0x' || substr(h, 16, 15))::BIGINT), sum(('0x' || substr(h, 31, 15))::BIGINT), sum(('0x' || substr(h, 46, 15))::BIGINT))) AS digest FROM (SELECT sha256('v' || s_suppkey || chr(31) || 'v' || s_name) AS h FROM supplier)")
def h3_table(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").agg(hashes.table_digest(table(spark, d, "supplier"), ["s_suppkey", "s_name"]).alias("digest"))
