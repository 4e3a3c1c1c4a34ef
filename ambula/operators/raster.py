"""The raster of a city: geometry, nearest nodes, labels, borders, islands, and directions to walk."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ambula.functions.walk import KX, KY
from ambula.operators.knn import nearest_within

CELL_RADIUS_M = 250.0
BUILDING_RADIUS_M = 300.0
SITE_RADIUS_M = 200.0
#: Radii that are tried first.
STEPS_M = (30.0, 90.0)
#: Islands under this area are absorbed, in square metres.
ISLAND_M2 = 1200.0
# fixed values: dx and dy (y down) of the directions 1 to 8: N, NE, E, SE, S, SW, W, NW
DIRECTIONS = ((0, -1), (1, -1), (1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1))


@dataclass(frozen=True)
class Grid:
    west: float
    north: float
    dlng: float
    dlat: float
    w: int
    h: int

    @classmethod
    def over(cls, bbox: tuple[float, float, float, float], cell_m: float) -> Grid:
        west, south, east, north = bbox
        dlat = cell_m / KY
        dlng = cell_m / (KX * math.cos(math.radians((south + north) / 2)))
        return cls(west, north, dlng, dlat, max(1, math.ceil((east - west) / dlng)), max(1, math.ceil((north - south) / dlat)))

    @property
    def mid_lat(self) -> float:
        return self.north - self.h * self.dlat / 2

    def bbox(self) -> tuple[float, float, float, float]:
        return self.west, self.north - self.h * self.dlat, self.west + self.w * self.dlng, self.north

    def x_of(self, lng: Column) -> Column:
        """Column of a place, also outside of the grid."""
        return F.floor((lng - self.west) / self.dlng).cast("int")

    def y_of(self, lat: Column) -> Column:
        return F.floor((self.north - lat) / self.dlat).cast("int")

    def clamped(self, lng: Column, lat: Column) -> tuple[Column, Column]:
        x, y = self.x_of(lng), self.y_of(lat)
        return F.greatest(F.lit(0), F.least(F.lit(self.w - 1), x)), F.greatest(F.lit(0), F.least(F.lit(self.h - 1), y))

    def corner(self, x: Column, y: Column) -> tuple[Column, Column]:
        return self.west + x * self.dlng, self.north - y * self.dlat

    def cells(self, spark: SparkSession) -> DataFrame:
        cell = spark.range(self.w * self.h)
        return cell.select((F.col("id") / self.w).cast("int").alias("y"), (F.col("id") % self.w).cast("int").alias("x"), F.col("id").alias("cell"))


def extent(nodes: DataFrame) -> tuple[float, float, float, float]:
    return tuple(nodes.agg(F.min("lng"), F.min("lat"), F.max("lng"), F.max("lat")).first())


def build_grid(grid: Grid, nodes: DataFrame) -> DataFrame:
    """(cell, y, x, node_id): the nearest of nodes(node_id, lng, lat) to each cell's centre within 250 m, else null."""
    cells = grid.cells(nodes.sparkSession)
    lng, lat = grid.corner(F.col("x") + 0.5, F.col("y") + 0.5)
    near = nearest_within(cells.select("cell", lng.alias("lng"), lat.alias("lat")), nodes, CELL_RADIUS_M, grid.mid_lat, "cell", steps=STEPS_M)
    return cells.join(near, "cell", "left").select("cell", "y", "x", "node_id")


def label_cells(cells: DataFrame, labels: DataFrame) -> DataFrame:
    """(type_id, cell, y, x, pid): the label of each cell's node; cells without one are left out."""
    return cells.join(labels.select("type_id", "node_id", "pid"), "node_id").select("type_id", "cell", "y", "x", "pid")


def boundary_edges(labelled: DataFrame) -> DataFrame:
    """(type_id, x0, y0, x1, y1, pid, other): unit edges of cells whose neighbour has another label or none (null), the
    cell on the right of the way from (x0, y0) to (x1, y1), y down."""
    sides = [(0, -1, 0, 0, 1, 0), (1, 0, 1, 0, 1, 1), (0, 1, 1, 1, 0, 1), (-1, 0, 0, 1, 0, 0)]
    each = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(s, ("dx", "dy", "ax", "ay", "bx", "by"))]) for s in sides]))
    asked = labelled.select("type_id", "x", "y", "pid", each.alias("s")).withColumns({"nx": F.col("x") + F.col("s.dx"), "ny": F.col("y") + F.col("s.dy")})
    beside = labelled.select("type_id", F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("pid").alias("other"))
    met = asked.join(beside, ["type_id", "nx", "ny"], "left").where("other is null or other <> pid")
    return met.select("type_id", (F.col("x") + F.col("s.ax")).alias("x0"), (F.col("y") + F.col("s.ay")).alias("y0"), (F.col("x") + F.col("s.bx")).alias("x1"), (F.col("y") + F.col("s.by")).alias("y1"), "pid", "other")


def adjacency(edges: DataFrame) -> DataFrame:
    """(type_id, a, b), a < b: labels that share an edge."""
    return edges.where("other is not null").select("type_id", F.least("pid", "other").alias("a"), F.greatest("pid", "other").alias("b")).distinct()


def island_threshold(cell_m: float) -> int:
    return int(ISLAND_M2 / cell_m**2 + 0.5)


def absorb_islands(raster: np.ndarray, least: int) -> np.ndarray:
    """A raster (-1: none) whose 4-connected patches of under `least` cells have the label of their longest border.

    Patches are met in order of rows; a patch that has gone is part of its neighbour for those after it. Of equal
    borders the smaller label wins. No label is a label too. Nothing happens for least under 2.
    """
    out = raster.copy()
    if least < 2:
        return out
    h, w = out.shape
    seen = np.zeros((h, w), bool)
    for y0, x0 in np.ndindex(h, w):
        if seen[y0, x0]:
            continue
        label, patch, border = out[y0, x0], [(y0, x0)], Counter()
        seen[y0, x0] = True
        for y, x in patch:
            for ny, nx in ((y, x - 1), (y, x + 1), (y - 1, x), (y + 1, x)):
                if 0 <= ny < h and 0 <= nx < w:
                    if out[ny, nx] != label:
                        border[int(out[ny, nx])] += 1
                    elif not seen[ny, nx]:
                        seen[ny, nx] = True
                        patch.append((ny, nx))
        if len(patch) < least and border:
            out[tuple(np.array(patch).T)] = min(border, key=lambda b: (-border[b], b))
    return out


def to_raster(pdf: pd.DataFrame, grid: Grid) -> np.ndarray:
    raster = np.full((grid.h, grid.w), -1, np.int64)
    raster[pdf.y.to_numpy(), pdf.x.to_numpy()] = pdf.pid
    return raster


def absorb(labelled: DataFrame, grid: Grid, least: int) -> DataFrame:
    """absorb_islands() of each type's raster, as cells again. A raster is one city's, so a task holds one of them."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raster = absorb_islands(to_raster(pdf, grid), least)
        y, x = np.nonzero(raster >= 0)
        return pd.DataFrame({"type_id": pdf.type_id.iloc[0], "cell": y * grid.w + x, "y": y, "x": x, "pid": raster[y, x]})

    return labelled.groupBy("type_id").applyInPandas(run, "type_id string, cell long, y int, x int, pid long")


def _direction(dx: Column, dy: Column) -> Column:
    out = F.lit(0)
    for i, (a, b) in enumerate(DIRECTIONS):
        out = F.when((dx == a) & (dy == b), i + 1).otherwise(out)
    return out


def line_cells(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray):
    """Cells of 8-connected lines, all lines a step at a time: yields (step, lines, x, y, step in x, step in y).

    The first cell is met, the last is not.
    """
    x, y = x0.astype(np.int64), y0.astype(np.int64)
    dx, dy = np.abs(x1 - x), -np.abs(y1 - y)
    sx, sy = np.sign(x1 - x), np.sign(y1 - y)
    err, step = dx + dy, 0
    live = np.flatnonzero((x != x1) | (y != y1))
    while len(live):
        e2 = 2 * err[live]
        ax, ay = e2 >= dy[live], e2 <= dx[live]
        err[live] += np.where(ax, dy[live], 0) + np.where(ay, dx[live], 0)
        mx, my = np.where(ax, sx[live], 0), np.where(ay, sy[live], 0)
        yield step, live, x[live], y[live], mx, my
        x[live] += mx
        y[live] += my
        live = live[(x[live] != x1[live]) | (y[live] != y1[live])]
        step += 1


def _painted(frames):
    for f in frames:
        t0, t1 = f.t0.to_numpy(np.float32), f.t1.to_numpy(np.float32)
        x0, y0, x1, y1 = (f[c].to_numpy(np.int64) for c in ("x0", "y0", "x1", "y1"))
        total = np.maximum(np.maximum(np.abs(x1 - x0), np.abs(y1 - y0)), 1).astype(np.float32)
        codes = {d: i + 1 for i, d in enumerate(DIRECTIONS)}
        for step, live, x, y, mx, my in line_cells(x0, y0, x1, y1):
            t = t0[live] + (t1[live] - t0[live]) * (np.float32(step) / total[live])
            yield pd.DataFrame({"type_id": f.type_id.to_numpy()[live], "x": x, "y": y, "t": t, "node_id": f.node_id.to_numpy()[live], "dir": [codes[(int(a), int(b))] for a, b in zip(mx, my)]})


def direction_cells(grid: Grid, cells: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """(type_id, y, x, dir), dir 1 to 8: the way to walk from each cell; cells to stay in, or of no way, are left out.

    Each node's line to its next hop passes cells; a cell has the direction of the line that passes it at the least time,
    interpolated along the line in single precision, of equal ones the one of the smaller node. Cells of sites are
    cleared. Other cells step toward their nearest node, if that is reached, is no site and lies in another cell.
    """
    x, y = grid.clamped(F.col("lng"), F.col("lat"))
    at = nodes.select("node_id", x.alias("x"), y.alias("y"))
    placed = labels.join(at, "node_id")
    ahead = placed.select("type_id", F.col("node_id").alias("next_hop"), F.col("x").alias("x1"), F.col("y").alias("y1"), F.col("dist_ds").alias("t1"))
    lines = placed.where("next_hop is not null").join(ahead, ["type_id", "next_hop"]).select("type_id", "node_id", F.col("x").alias("x0"), F.col("y").alias("y0"), "x1", "y1", F.col("dist_ds").alias("t0"), "t1")
    passed = lines.mapInPandas(_painted, "type_id string, x int, y int, t float, node_id long, dir int")
    best = passed.groupBy("type_id", "y", "x").agg(F.min(F.struct("t", "node_id", "dir"))["dir"].alias("dir"))
    ends = placed.where("dist_ds = 0").select("type_id", "y", "x").distinct()
    painted = best.join(ends, ["type_id", "y", "x"], "left_anti")
    near = cells.where("node_id is not null").join(placed.where("dist_ds > 0").select("type_id", "node_id", F.col("x").alias("nx"), F.col("y").alias("ny")), "node_id").where("nx <> x or ny <> y")
    filled = near.select("type_id", "y", "x", _direction(F.signum(F.col("nx") - F.col("x")).cast("int"), F.signum(F.col("ny") - F.col("y")).cast("int")).alias("dir"))
    return painted.unionByName(filled.join(painted, ["type_id", "y", "x"], "left_anti"))


def sample_elevation(points: DataFrame, dem: DataFrame, key: str) -> DataFrame:
    """(key, elev): bilinear height at points(key, lng, lat) from dem(lat0, lng0, w, h, row, col, v), tiles of one degree.

    Pixel centres are at half pixels, clamped at the tile's edge; heights under -1000 and missing tiles are 0. Single
    precision, as the tiles are.
    """
    tiles = dem.select("lat0", "lng0", "w", "h").distinct()
    spots = points.withColumns({"lat0": F.floor("lat").cast("int"), "lng0": F.floor("lng").cast("int")}).join(tiles, ["lat0", "lng0"], "left")
    fx = F.greatest(F.lit(0.0), F.least((F.col("lng") - F.col("lng0")) * F.col("w") - 0.5, F.col("w") - 1.0))
    fy = F.greatest(F.lit(0.0), F.least((1 - (F.col("lat") - F.col("lat0"))) * F.col("h") - 0.5, F.col("h") - 1.0))
    spots = spots.withColumns({"fx": fx, "fy": fy})
    corners = F.explode_outer(
        F.array(*[F.struct(F.least(F.floor("fy").cast("int") + r, F.col("h") - 1).alias("row"), F.least(F.floor("fx").cast("int") + c, F.col("w") - 1).alias("col"), F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (0, 1) for c in (0, 1)])
    )
    asked = spots.select(key, "lat0", "lng0", (F.col("fx") - F.floor("fx")).cast("float").alias("ax"), (F.col("fy") - F.floor("fy")).cast("float").alias("ay"), corners.alias("p")).select("*", "p.row", "p.col", "p.r", "p.c")
    met = asked.join(dem.select("lat0", "lng0", "row", "col", "v"), ["lat0", "lng0", "row", "col"], "left")
    v = F.when(F.col("v").isNull() | (F.col("v") < -1000), F.lit(0.0)).otherwise(F.col("v")).cast("float")

    def corner(r: int, c: int) -> Column:
        return F.max(F.when((F.col("r") == r) & (F.col("c") == c), v))

    four = met.groupBy(key).agg(F.max("ax").alias("ax"), F.max("ay").alias("ay"), *[corner(r, c).alias(f"v{r}{c}") for r in (0, 1) for c in (0, 1)])
    one = F.lit(1.0).cast("float")

    def between(low: Column, high: Column, share: Column) -> Column:
        return low * (one - share) + high * share

    top, low = between(F.col("v00"), F.col("v01"), F.col("ax")), between(F.col("v10"), F.col("v11"), F.col("ax"))
    return four.select(key, F.coalesce(between(top, low, F.col("ay")), F.lit(0.0)).cast("float").alias("elev"))


def dem_tile_name(lat0: Column, lng0: Column) -> Column:
    """Name by the south-west corner, like N51_00_W001_00."""
    ns, ew = F.when(lat0 < 0, "S").otherwise("N"), F.when(lng0 < 0, "W").otherwise("E")
    return F.format_string("Copernicus_DSM_COG_10_%s%02d_00_%s%03d_00_DEM", ns, F.abs(lat0), ew, F.abs(lng0))


def building_labels(buildings: DataFrame, grid: Grid, cells: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """(type_id, building_id, pid, t): of buildings(building_id, lng, lat) with a node within 300 m its label and the seconds
    to walk; of others the label of their cell's node, not clamped, and no time."""
    near = nearest_within(buildings, nodes, BUILDING_RADIUS_M, grid.mid_lat, "building_id", steps=STEPS_M)
    t = F.floor(F.col("dist_ds") / 10) + F.floor(F.col("dist_m") / 1.39)
    timed = near.join(labels, "node_id").select("type_id", "building_id", "pid", t.cast("int").alias("t"))
    far = buildings.withColumns({"x": grid.x_of(F.col("lng")), "y": grid.y_of(F.col("lat"))})
    fallback = far.join(cells, ["x", "y"]).join(labels, "node_id").select("type_id", "building_id", "pid", F.lit(None).cast("int").alias("t"))
    return timed.unionByName(fallback.join(timed, ["type_id", "building_id"], "left_anti"))
