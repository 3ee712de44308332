"""Geometry as column expressions: great circles, the transverse Mercator projection, and polygons given as rings.

A ring is array<struct<x, y>>, closed or not; a polygon is an array of rings, the first one its outline.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.8
#: Fixed values of the WGS84 ellipsoid and of UTM.
SEMI_MAJOR, FLATTENING, SCALE = 6378137.0, 1 / 298.257223563, 0.9996


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    a = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing, by Krueger's series in the third flattening up to its fourth power."""
    n = FLATTENING / (2 - FLATTENING)
    rectifying = SEMI_MAJOR / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alphas = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440,
        61 * n**3 / 240 - 103 * n**4 / 140,
        49561 * n**4 / 161280,
    )
    e = math.sqrt(FLATTENING * (2 - FLATTENING))
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    tau = F.sinh(F.atanh(F.sin(phi)) - e * F.atanh(e * F.sin(phi)))
    xi, eta = F.atan2(tau, F.cos(lam)), F.asinh(F.sin(lam) / F.sqrt(tau * tau + F.pow(F.cos(lam), 2)))
    x, y = eta, xi
    for j, a in enumerate(alphas, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return SCALE * rectifying * x + 500000.0, SCALE * rectifying * y


def planar_m(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt(F.pow(x1 - x2, 2) + F.pow(y1 - y2, 2))


def cell(value: Column, size: float) -> Column:
    return F.floor(value / size).cast("bigint")


def sides(ring: Column) -> Column:
    """The segments of a ring, the closing one included."""
    nexts = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, nexts, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def ring_area(ring: Column) -> Column:
    """By the shoelace formula, without sign."""
    return F.abs(F.aggregate(sides(ring), F.lit(0.0), lambda s, e: s + e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def on_boundary(x: Column, y: Column, ring: Column) -> Column:
    def on(e: Column) -> Column:
        cross = (x - e["x1"]) * (e["y2"] - e["y1"]) - (y - e["y1"]) * (e["x2"] - e["x1"])
        within = x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        return (cross == 0) & within

    return F.exists(sides(ring), on)


def crossings_odd(x: Column, y: Column, ring: Column) -> Column:
    """Whether a ray to the right crosses the ring an odd number of times."""

    def crosses(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])

    return F.aggregate(sides(ring), F.lit(False), lambda odd, e: odd != F.coalesce(crosses(e), F.lit(False)))


def within(x: Column, y: Column, ring: Column) -> Column:
    """Strictly inside: the boundary is not."""
    return crossings_odd(x, y, ring) & ~on_boundary(x, y, ring)


def covered(x: Column, y: Column, ring: Column) -> Column:
    """Inside or on the boundary."""
    return crossings_odd(x, y, ring) | on_boundary(x, y, ring)


def distance_to_ring(x: Column, y: Column, ring: Column) -> Column:
    """To the nearest point of the outline; 0 inside."""

    def to(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        along = F.when(dx * dx + dy * dy > 0, ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / (dx * dx + dy * dy)).otherwise(0.0)
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
        return planar_m(x, y, e["x1"] + t * dx, e["y1"] + t * dy)

    return F.when(covered(x, y, ring), 0.0).otherwise(F.array_min(F.transform(sides(ring), to)))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))


def interior_point(ring: Column) -> Column:
    """A point of the polygon: halfway along its longest inner stretch at half height."""
    ys = F.transform(ring, lambda p: p["y"])
    low, high = F.array_min(ys), F.array_max(ys)
    middle = (low + high) / 2
    above, below = F.array_min(F.filter(ys, lambda v: v > middle)), F.array_max(F.filter(ys, lambda v: v <= middle))
    y = (F.coalesce(above, high) + F.coalesce(below, low)) / 2  # no corner lies on this line
    cut = F.filter(sides(ring), lambda e: (e["y1"] > y) != (e["y2"] > y))
    xs = F.array_sort(F.transform(cut, lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])))
    pairs = F.transform(F.sequence(F.lit(1), (F.size(xs) / 2).cast("int")), lambda i: F.struct((F.element_at(xs, (2 * i).cast("int")) - F.element_at(xs, (2 * i - 1).cast("int"))).alias("w"), ((F.element_at(xs, (2 * i).cast("int")) + F.element_at(xs, (2 * i - 1).cast("int"))) / 2).alias("x")))
    return F.struct(F.array_max(pairs)["x"].alias("x"), y.alias("y"))
