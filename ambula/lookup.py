"""The lookup surface: search, popups, traces, arrows, links."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ambula.functions.names import walk_text
from ambula.functions.walk import KX, KY
from ambula.operators.raster import DIRECTIONS, Grid

MAX_STEPS = 60_000


def search_sites(sites: DataFrame, text: str, n: int = 8) -> DataFrame:
    """The first n named sites, by pid, whose name holds the text, in any case; nothing for under 2 characters."""
    wanted = text.strip().lower()
    return sites.where(F.lit(len(wanted) >= 2) & F.contains(F.lower("name"), F.lit(wanted))).orderBy("pid").limit(n)


def popup_text(name: Column, type_name: Column, pid: Column, seconds: Column) -> Column:
    return F.concat(F.coalesce(name, F.concat(type_name, F.lit(" #"), pid.cast("string"))), F.lit(": "), walk_text(seconds))


def trace(grid: Grid, dirs: np.ndarray, lng: float, lat: float) -> list[tuple[float, float]] | None:
    """The way from a place along the directions, its corners cut once; None outside of the grid or under two cells."""
    x, y = math.floor((lng - grid.west) / grid.dlng), math.floor((grid.north - lat) / grid.dlat)
    cells: dict[tuple[int, int], None] = {}
    while 0 <= x < grid.w and 0 <= y < grid.h and (x, y) not in cells and len(cells) < MAX_STEPS:
        cells[x, y] = None
        if not (d := int(dirs[y, x])):
            break
        x, y = x + DIRECTIONS[d - 1][0], y + DIRECTIONS[d - 1][1]
    if len(cells) < 2:
        return None
    points = np.array([(grid.west + (cx + 0.5) * grid.dlng, grid.north - (cy + 0.5) * grid.dlat) for cx, cy in cells])
    a, b = points[:-1], points[1:]
    cut = np.stack((0.75 * a + 0.25 * b, 0.25 * a + 0.75 * b), 1).reshape(-1, 2)[1:-1]
    return [tuple(p) for p in np.concatenate((points[:1], cut, points[-1:])).tolist()]


def arrows(line: list[tuple[float, float]], zoom: float) -> list[tuple[float, float, float | None]]:
    """(lng, lat, turn) along a line at a constant gap on the screen, the first at its start; its end, without a turn, last."""
    gap = max(6.0, 10 * 156543.03 * math.cos(math.radians(line[0][1])) / 2**zoom)
    kx = KX * math.cos(math.radians(line[0][1]))
    out, run = [], gap
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        dx, dy = (bx - ax) * kx, (by - ay) * KY
        length = math.hypot(dx, dy)
        if length < 1e-9:
            continue
        run += length
        while run >= gap:
            run -= gap
            t = 1 - run / length
            if 0 <= t <= 1:
                out.append((ax + (bx - ax) * t, ay + (by - ay) * t, math.degrees(math.atan2(-dy, dx))))
    return [*out, (*line[-1], None)]


@dataclass(frozen=True)
class View:
    city: str | None = None
    type: str | None = None
    mode: str = "buildings"
    zoom: float | None = None
    lat: float | None = None
    lng: float | None = None


def parse_hash(text: str) -> View:
    """#city/type/mode/zoom/lat/lng; parts may be missing at the end, and numbers that are none are dropped."""
    parts = [*text.lstrip("#").split("/"), *[""] * 6][:6]

    def number(s: str) -> float | None:
        try:
            return float(s)
        except ValueError:
            return None

    return View(parts[0] or None, parts[1] or None, parts[2] if parts[2] in ("buildings", "areas") else "buildings", *map(number, parts[3:]))


def settle(view: View, manifest: dict) -> View:
    """The view with the first city or type of the manifest where its own are unknown."""
    cities = {c["id"]: c for c in manifest["cities"]}
    city = cities.get(view.city) or manifest["cities"][0]
    type_id = view.type if view.type in city["types"] else city["types"][0]
    return View(city["id"], type_id, view.mode, view.zoom, view.lat, view.lng)
