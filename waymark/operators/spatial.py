"""Spatial joins by grid cell: nearest point, points within polygons, and points in range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import cell, covered, distance_to_ring, planar_m, within
from waymark.operators.graph import saved
from waymark.operators.relational import keep_first

NEAR = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]


def in_range(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Pairs at most so far apart: left(id, x, y) and right(other_id, ox, oy), in metres; each pair meets once.

    The right side is copied to its cell and the eight around it, so that a pair's one meeting place is the left cell.
    """
    around = F.explode(F.array(*[F.struct((cell(F.col("ox"), metres) + i).alias("cx"), (cell(F.col("oy"), metres) + j).alias("cy")) for i, j in NEAR])).alias("at")
    spread = right.select("*", around).select("*", "at.cx", "at.cy").drop("at")
    placed = left.withColumns({"cx": cell(F.col("x"), metres), "cy": cell(F.col("y"), metres)})
    distance = planar_m(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))
    return placed.join(spread, ["cx", "cy"]).drop("cx", "cy").withColumn("distance_m", distance).where(F.col("distance_m") <= metres)


def nearest(left: DataFrame, right: DataFrame, start_m: float) -> DataFrame:
    """The nearest right point of every left one, ties to the smallest other_id: id, other_id and distance_m.

    Points without a neighbour within start_m look again in twice the range, and so on, until the range is that of all
    points, so that each finds one; null coordinates find none.
    """
    left = left.where("x IS NOT NULL AND y IS NOT NULL").select("id", "x", "y")
    right = right.where("ox IS NOT NULL AND oy IS NOT NULL").select("other_id", "ox", "oy")
    found, metres = None, start_m
    if right.isEmpty():
        return left.select("id", F.lit(None).cast("string").alias("other_id"), F.lit(None).cast("double").alias("distance_m")).limit(0)
    ends = lambda x, y: [f(F.col(c)).alias(f"{n}{c}") for c in (x, y) for f, n in ((F.min, "low_"), (F.max, "high_"))]
    a, b = left.agg(*ends("x", "y")).first(), right.agg(*ends("ox", "oy")).first()
    if a["low_x"] is None:
        return left.select("id", F.lit(None).cast("string").alias("other_id"), F.lit(None).cast("double").alias("distance_m")).limit(0)
    whole = sum(max(a[f"high_{c}"], b[f"high_o{c}"]) - min(a[f"low_{c}"], b[f"low_o{c}"]) for c in ("x", "y"))  # no two points are farther apart
    while True:
        best = keep_first(in_range(left, right, metres), ["id"], [F.col("distance_m"), F.col("other_id")]).select("id", "other_id", "distance_m")
        best = saved(best)
        found = best if found is None else found.unionByName(best)
        left = saved(left.join(best, "id", "left_anti"))
        if metres > whole or left.isEmpty():
            return found
        metres *= 2


def polygons_of(points: DataFrame, areas: DataFrame, size: float, boundary: bool) -> DataFrame:
    """Points(id, x, y) with each area(area_id, ring) that holds them; `boundary` says whether its outline counts.

    An area is copied to the cells that its bounding box meets, a point goes to its own cell.
    """
    span = lambda low, high: F.explode(F.sequence(cell(low, size), cell(high, size)))
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    boxed = areas.select("area_id", "ring", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    spread = boxed.withColumn("cx", span(F.col("x0"), F.col("x1"))).withColumn("cy", span(F.col("y0"), F.col("y1")))
    placed = points.withColumns({"cx": cell(F.col("x"), size), "cy": cell(F.col("y"), size)})
    boxes = F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1"))
    test: Column = (covered if boundary else within)(F.col("x"), F.col("y"), F.col("ring"))
    joined = placed.join(spread, ["cx", "cy"]).where(boxes).where(test)
    return joined.select(*points.columns, "area_id")


def near_areas(points: DataFrame, parts: DataFrame, metres: float, size: float) -> DataFrame:
    """id and area_id of points(id, x, y) that are in an area or at most so far from it; each pair once.

    parts: area_id and ring; an area may have several, and a point is near it if it is near any: no union is made.
    """
    span = lambda low, high: F.explode(F.sequence(cell(low - metres, size), cell(high + metres, size)))
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    spread = parts.select("area_id", "ring", span(F.array_min(xs), F.array_max(xs)).alias("cx"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    spread = spread.withColumn("cy", span(F.col("y0"), F.col("y1"))).drop("y0", "y1")
    placed = points.where("x IS NOT NULL AND y IS NOT NULL").select("id", "x", "y", cell(F.col("x"), size).alias("cx"), cell(F.col("y"), size).alias("cy"))
    x, y, ring = F.col("x"), F.col("y"), F.col("ring")
    return placed.join(spread, ["cx", "cy"]).where(covered(x, y, ring) | (distance_to_ring(x, y, ring) <= metres)).select("id", "area_id").distinct()
