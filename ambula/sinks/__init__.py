"""Files that a city's run leaves behind; each is one small file of one city and type."""

from __future__ import annotations

import gzip
import json
import time
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambula.config import City, FeatureType
from ambula.functions.colour import PALETTE
from ambula.operators.raster import Grid

#: Archives over this size are not published, in bytes.
LARGEST = 99_000_000


def write_sites(path: Path, sites: DataFrame) -> None:
    rows = sites.orderBy("pid").select("pid", "name", F.round("lng", 6), F.round("lat", 6), "k").toLocalIterator()
    path.write_text(json.dumps({"sites": [list(r) for r in rows]}, ensure_ascii=False, separators=(",", ":")))


def write_dirs(path: Path, grid: Grid, dirs: DataFrame) -> None:
    raster = np.zeros((grid.h, grid.w), np.uint8)
    for y, x, d in dirs.select("y", "x", "dir").toLocalIterator():
        raster[y, x] = d
    path.write_bytes(gzip.compress(raster.tobytes(), 6, mtime=0))


def write_meta(path: Path, city: City, grid: Grid) -> dict:
    meta = {"id": city.id, "name": city.name, "bbox": [round(v, 5) for v in city.bbox or grid.bbox()], "pathGrid": {k: getattr(grid, k) for k in ("w", "h", "west", "north", "dlng", "dlat")}}
    path.write_text(json.dumps(meta, indent=2, ensure_ascii=False))
    return meta


def manifest(cities: list[City], types: list[FeatureType], out: Path, template: str | None = None) -> dict:
    """Cities that have an archive, with those of their types that have one, in the catalogue's order."""
    found = []
    for city in cities:
        have = [t.id for t in types if (out / city.id / f"{t.id}.pmtiles").exists()]
        if have:
            meta = json.loads((out / city.id / "meta.json").read_text())
            found.append({"id": city.id, "name": city.name, "bbox": meta["bbox"], "pathGrid": meta["pathGrid"], "types": have})
    return {"v": int(time.time()), "dataUrlTemplate": template, "types": [{"id": t.id, "name": t.name} for t in types], "cities": found}


def write_partitions(path: Path, shapes: DataFrame) -> int:
    """A GeoJSON feature for each catchment with polygons: pid, name, t_max, c. Returns their number."""
    n = 0
    with path.open("w") as file:
        for r in shapes.orderBy("pid").toLocalIterator():
            if r.polygons:
                rings = [[[[p.x, p.y] for p in ring] for ring in polygon] for polygon in r.polygons]
                properties = {"pid": r.pid, "name": r["name"], "t_max": r.t_max, "c": PALETTE[r.color % len(PALETTE)]}
                file.write(json.dumps({"type": "Feature", "properties": properties, "geometry": {"type": "MultiPolygon", "coordinates": rings}}, ensure_ascii=False) + "\n")
                n += 1
    return n


def clean(folder: Path, types: list[str]) -> list[str]:
    """Removes the files of types that are no longer configured; returns their names."""
    gone = [p for p in folder.iterdir() if p.suffixes and p.name != "meta.json" and p.name.split(".")[0] not in types]
    for p in gone:
        p.unlink()
    return sorted(p.name for p in gone)


def too_large(folder: Path) -> list[str]:
    return sorted(p.name for p in folder.glob("*.pmtiles") if p.stat().st_size > LARGEST)
