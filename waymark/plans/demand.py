"""Population on the network: attachment of points to nodes, and shares of areas' population per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import interior_point
from waymark.operators.gates import first_reason
from waymark.operators.relational import equal_shares, stacked
from waymark.operators.spatial import nearest, polygons_of


def attachments(entities: DataFrame, nodes: DataFrame, most_m: float, start_m: float, keep_outliers: bool = False) -> DataFrame:
    """id, node_id, snap_distance_m, snapped and quality of each entity(id, x, y); one row per entity.

    An entity farther than most_m from every node is an outlier: its distance stays, and its node only if asked for.
    """
    near = nearest(entities, nodes, start_m).withColumnRenamed("id", "of_id")
    joined = entities.join(near, F.col("id") == F.col("of_id"), "left").drop("of_id")
    outlier = F.col("distance_m") > most_m
    quality = first_reason((F.col("x").isNull() | F.col("y").isNull(), "missing_geometry"), (F.col("other_id").isNull(), "no_node"), (outlier, "snap_outlier"), otherwise="snapped")
    node = F.col("other_id") if keep_outliers else F.when(~outlier, F.col("other_id"))
    return joined.select("id", node.alias("node_id"), F.col("distance_m").alias("snap_distance_m"), (quality == "snapped").alias("snapped"), quality.alias("attachment_quality"))


def origins(areas: DataFrame, observations: DataFrame, nodes: DataFrame, size: float, start_m: float) -> DataFrame:
    """Areas(area_id, ring) to origins: each area's population in equal shares on the nodes strictly inside it.

    An area without such a node goes to the node nearest to a point within it, with the distance.  Areas that have no
    observation keep a null population, and say so.
    """
    inside = polygons_of(nodes.select(F.col("other_id").alias("id"), F.col("ox").alias("x"), F.col("oy").alias("y")), areas, size, boundary=False)
    shared = equal_shares(inside.select("area_id", F.col("id").alias("node_id")), ["area_id"]).withColumns({"snap_distance_m": F.lit(0.0), "method": F.lit("nodes_inside")})
    empty = areas.join(inside.select("area_id").distinct(), "area_id", "left_anti")
    points = empty.select(F.col("area_id").alias("id"), interior_point(F.col("ring")).alias("p")).select("id", "p.x", "p.y")
    fallback = nearest(points, nodes, start_m).select(F.col("id").alias("area_id"), F.col("other_id").alias("node_id"), F.lit(1.0).alias("share"), F.col("distance_m").alias("snap_distance_m"), F.lit("nearest_node").alias("method"))
    placed = stacked(shared, fallback).join(observations.select("area_id", "population", F.lit(True).alias("observed")), "area_id", "left")
    status = first_reason((F.col("observed").isNull(), "no_observation"), otherwise="assigned")
    return placed.select("area_id", "node_id", "share", "snap_distance_m", "method", (F.col("population") * F.col("share")).alias("population"), status.alias("status"))


def not_conserved(parts: DataFrame, observations: DataFrame) -> DataFrame:
    """Areas whose parts don't add up to what was observed."""
    sums = parts.groupBy("area_id").agg(F.sum("population").alias("assigned"))
    gap = F.abs(F.coalesce("assigned", F.lit(0.0)) - F.col("population"))
    return observations.join(sums, "area_id", "left").where(gap > F.greatest(F.lit(1e-6), 1e-10 * F.abs("population")))
