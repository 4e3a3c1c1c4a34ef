"""Rings, projections and tile numbers as Column expressions. A ring is array<struct<x,y>>, closed or open."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ambula.functions.walk import KX, KY


def _edges(ring: Column, value) -> Column:
    """The sum of value(p, q) over all edges of a ring, the closing one included."""
    n = F.size(ring)
    steps = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + value(F.get(ring, i), F.get(ring, F.pmod(i + 1, n).cast("int"))))


def doubled_area(ring: Column) -> Column:
    """Twice the signed area, by the shoelace rule; positive counter-clockwise."""
    return _edges(ring, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])


def centroid(ring: Column) -> Column:
    """struct<x,y>, weighted by area; the mean of the points where the area is next to nothing.

    Reckoned from the first point, since areas of buildings are tiny beside their coordinates.
    """
    first, n = F.get(ring, F.lit(0)), F.size(ring).cast("double")

    def cross(p, q):
        return (p["x"] - first["x"]) * (q["y"] - first["y"]) - (q["x"] - first["x"]) * (p["y"] - first["y"])

    area = _edges(ring, cross)

    def moment(c: str) -> Column:
        weighted = _edges(ring, lambda p, q: (p[c] + q[c] - 2 * first[c]) * cross(p, q))
        mean = F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + p[c]) / n
        return F.when(F.abs(area) <= 1e-14, mean).otherwise(first[c] + weighted / F.nullif(3 * area, F.lit(0.0)))

    return F.struct(moment("x").alias("x"), moment("y").alias("y"))


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule."""

    def crosses(p, q):
        at = (q["x"] - p["x"]) * (y - p["y"]) / F.nullif(q["y"] - p["y"], F.lit(0.0)) + p["x"]
        return F.when(((p["y"] > y) != (q["y"] > y)) & (x < at), 1.0).otherwise(0.0)

    return F.pmod(_edges(ring, crosses), F.lit(2.0)) == 1


def in_bbox(lng: Column, lat: Column, bbox: tuple[float, float, float, float] | None) -> Column:
    """Inclusive on all sides; everything without a box."""
    if bbox is None:
        return F.lit(True)
    west, south, east, north = bbox
    return F.coalesce(lng.between(west, east) & lat.between(south, north), F.lit(False))


def plane(lng: Column, lat: Column, mid_lat: float) -> tuple[Column, Column]:
    """Metres in the local plane."""
    return lng * (KX * math.cos(math.radians(mid_lat))), lat * KY


def mercator(lng: Column, lat: Column) -> tuple[Column, Column]:
    """Unit square of the web map projection, y down."""
    s = F.greatest(F.lit(-0.9999), F.least(F.lit(0.9999), F.sin(F.radians(lat))))
    return lng / 360 + 0.5, 0.5 - F.log((1 + s) / (1 - s)) / (4 * math.pi)


def tile_of(unit: Column, z: Column | int) -> Column:
    z = F.lit(z) if isinstance(z, int) else z
    n = F.shiftleft(F.lit(1), z) if isinstance(z, int) else F.pow(F.lit(2.0), z).cast("int")
    return F.greatest(F.lit(0), F.least(n - 1, F.floor(unit * n).cast("int")))


def hilbert_tile_id(z: int, x: Column, y: Column) -> Column:
    """The number of a tile in an archive: tiles of lower zooms, then the place on the Hilbert curve."""
    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"), F.lit(0).cast("bigint").alias("d"))

    def step(acc, level):
        side = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        rx, ry = acc["x"].bitwiseAND(side) > 0, acc["y"].bitwiseAND(side) > 0
        d = acc["d"] + side * side * F.when(rx & ~ry, 3).when(rx & ry, 2).when(ry, 1).otherwise(0)
        # the lower half of the curve is turned, its right side also mirrored
        mx = F.when(rx, side - 1 - acc["x"].bitwiseAND(side - 1)).otherwise(acc["x"].bitwiseAND(side - 1))
        my = F.when(rx, side - 1 - acc["y"].bitwiseAND(side - 1)).otherwise(acc["y"].bitwiseAND(side - 1))
        return F.struct(
            F.when(ry, acc["x"].bitwiseAND(side - 1)).otherwise(my).alias("x"),
            F.when(ry, acc["y"].bitwiseAND(side - 1)).otherwise(mx).alias("y"),
            d.alias("d"),
        )

    levels = F.sequence(F.lit(z - 1), F.lit(0), F.lit(-1)) if z else F.array().cast("array<int>")
    return F.lit((4**z - 1) // 3) + F.aggregate(levels, start, step, lambda acc: acc["d"])
