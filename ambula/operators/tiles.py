"""Vector tiles: features per tile within a budget, encoded, and archives of tiles."""

from __future__ import annotations

import gzip
import json
import math
import struct
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ambula.functions.geometry import doubled_area, mercator

EXTENT, BUFFER = 4096, 8
ZOOMS = range(12, 16)
TILE_BUDGET = 500_000
FEATURE_COST = 16
#: Outer rings under this doubled area, in tile units, are specks.
SPECK = 24
_INT, _TEXT, _MOVE, _LINE, _CLOSE = 4, 1, 1, 2, 7


def tiles_of_box(x0: Column, y0: Column, x1: Column, y1: Column, z: int) -> Column:
    """array<struct<x,y>> of the tiles that a box of the unit square meets, with the buffer around."""
    scale, pad = float(1 << z), BUFFER / EXTENT

    def span(a: Column, b: Column) -> Column:
        return F.sequence(F.greatest(F.lit(0), F.floor(a * scale - pad).cast("int")), F.floor(b * scale + pad).cast("int"))

    return F.flatten(F.transform(span(x0, x1), lambda tx: F.transform(span(y0, y1), lambda ty: F.struct(tx.alias("x"), ty.alias("y")))))


def within_budget(features: DataFrame, by: list[str], cost: Column, order: list[Column], budget: int = TILE_BUDGET) -> DataFrame:
    """The features of each tile, in order, up to and with the one whose cost passes the budget."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return features.withColumn("used_", F.coalesce(F.sum(cost).over(w), F.lit(0))).where(F.col("used_") <= budget).drop("used_")


def clip(ring: list[tuple[float, float]], low: float, high: float) -> list[tuple[float, float]]:
    """A ring cut to the square from low to high, side after side."""
    for axis, bound, sign in ((0, low, 1), (0, high, -1), (1, low, 1), (1, high, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            dp, dq = sign * (p[axis] - bound), sign * (q[axis] - bound)
            if dp >= 0:
                out.append(p)
            if (dp >= 0) != (dq >= 0):
                t = dp / (dp - dq)
                out.append((p[0] + (q[0] - p[0]) * t, p[1] + (q[1] - p[1]) * t))
        ring = out
    return ring if len(ring) >= 3 else []


def quantise(ring: list[tuple[float, float]]) -> list[tuple[int, int]]:
    """Rounded away from zero, without repeats, closed; empty if under 3 points are left."""
    points = [tuple(int(math.copysign(math.floor(abs(v) + 0.5), v)) for v in p) for p in ring]
    points = [p for i, p in enumerate(points) if p != points[i - 1] or len(points) == 1]
    return [*points, points[0]] if len(points) >= 3 else []


def doubled(ring: list[tuple[int, int]]) -> int:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:]))


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, data: bytes) -> bytes:
    return varint(number << 3 | 2) + varint(len(data)) + data


def _number(number: int, value: int) -> bytes:
    return varint(number << 3) + varint(value)


def polygon_commands(rings: list[list[tuple[int, int]]]) -> bytes:
    """Closed rings as the tile format's commands: move, lines, close; steps in zigzag."""
    out, x, y = bytearray(), 0, 0
    for ring in rings:
        body = ring[:-1]
        for i, (px, py) in enumerate(body):
            if i < 2:
                out += varint(_MOVE | 1 << 3 if i == 0 else _LINE | len(body) - 1 << 3)
            out += varint((px - x) << 1 if px >= x else (x - px) * 2 - 1) + varint((py - y) << 1 if py >= y else (y - py) * 2 - 1)
            x, y = px, py
        out += varint(_CLOSE | 1 << 3)
    return bytes(out)


def tile_geometry(rings, z: int, tx: int, ty: int) -> bytes | None:
    """Rings of the unit square (the shell first) as commands of a tile, or None for specks and what lies outside."""
    scale, out = float(EXTENT << z), []
    for i, ring in enumerate(rings):
        points = [(p["x"] * scale - tx * EXTENT, p["y"] * scale - ty * EXTENT) for p in ring]
        if len(points) > 1 and points[0] == points[-1]:
            points = points[:-1]
        whole = quantise(clip(points, -BUFFER, EXTENT + BUFFER)) if len(points) >= 3 else []
        if i == 0 and (len(whole) < 4 or abs(doubled(whole)) < SPECK):
            return None
        if len(whole) >= 4:
            out.append(whole if (doubled(whole) > 0) == (i == 0) else whole[::-1])
    return polygon_commands(out)


def _before(ring: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of points in order of n rings: the points of each ring, its first, and the point before each, around the ring."""
    count = np.bincount(ring, minlength=n)
    first = np.cumsum(count) - count
    before = np.arange(len(ring)) - 1
    before[first[count > 0]] = (first + count - 1)[count > 0]
    return count, first, before


def _varints(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all numbers under 2^35, and how many each has."""
    width = 1 + sum((numbers >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    start, out = np.cumsum(width) - width, np.zeros(width.sum(), np.uint8)
    for k in range(5):
        here = width > k
        out[start[here] + k] = numbers[here] >> 7 * k & 0x7F | np.where(width[here] > k + 1, 0x80, 0)
    return out, width


def batch_geometries(rings: pa.ListArray, z: np.ndarray, tx: np.ndarray, ty: np.ndarray) -> list[bytes | None]:
    """tile_geometry of each row. Only shapes that reach over a tile's edge are clipped one by one."""
    n, per, inner = len(rings), np.asarray(rings.value_lengths()), rings.flatten()
    sizes = np.asarray(inner.value_lengths())
    x, y = (np.asarray(c) for c in inner.flatten().flatten())
    owner, shell = np.repeat(np.arange(n), per), np.cumsum(per) - per
    ring = np.repeat(np.arange(len(sizes)), sizes)
    row = owner[ring]
    scale = (EXTENT << z.astype(np.int64)).astype(float)[row]
    x, y = x * scale - tx[row] * EXTENT, y * scale - ty[row] * EXTENT
    within = (x >= -BUFFER) & (x <= EXTENT + BUFFER) & (y >= -BUFFER) & (y <= EXTENT + BUFFER)
    over = (per == 0) | (np.bincount(row, ~within, n) > 0)

    last = np.cumsum(sizes)[sizes > 1] - 1
    first = last + 1 - sizes[sizes > 1]
    keep = ~over[row]
    keep[last[(x[first] == x[last]) & (y[first] == y[last])]] = False
    ring = ring[keep]
    x, y = (np.copysign(np.floor(np.abs(v[keep]) + 0.5), v[keep]).astype(np.int64) for v in (x, y))
    _, _, before = _before(ring, len(sizes))
    fresh = (x != x[before]) | (y != y[before])
    ring, x, y = ring[fresh], x[fresh], y[fresh]
    count, first, before = _before(ring, len(sizes))
    area = np.bincount(ring, x[before] * y - x * y[before], len(sizes))
    outer = np.zeros(len(sizes), bool)
    outer[shell[per > 0]] = True
    drawn = ~over
    drawn[owner[outer]] &= ((count >= 3) & (np.abs(area) >= SPECK))[outer]
    turned = (area > 0) != outer  # these start at the same point and go the other way
    place = np.arange(len(ring)) - first[ring]
    place = np.where(turned[ring], -place % count[ring], place)
    order = np.lexsort((place, ring))
    keep = ((count >= 3) & drawn[owner])[ring]
    order = order[keep]  # the order is within rings, so the mask holds for it too
    ring, place, x, y = ring[order], place[order], x[order], y[order]

    row = owner[ring]
    new = np.diff(row, prepend=-1) != 0
    drawn_rings = np.flatnonzero((count >= 3) & drawn[owner])
    length = np.zeros(len(sizes), np.int64)
    length[drawn_rings] = 2 * count[drawn_rings] + 3
    start = np.cumsum(length) - length
    numbers = np.zeros(length.sum(), np.int64)
    numbers[start[drawn_rings]] = _MOVE | 1 << 3
    numbers[start[drawn_rings] + 3] = _LINE | count[drawn_rings] - 1 << 3
    numbers[start[drawn_rings] + length[drawn_rings] - 1] = _CLOSE | 1 << 3
    for k, v in enumerate((x, y)):
        step = np.where(new, v, np.diff(v, prepend=0))
        numbers[start[ring] + np.where(place == 0, 1, 2 + 2 * place) + k] = step << 1 ^ step >> 63
    data, width = _varints(numbers)
    ends = np.cumsum(np.bincount(np.repeat(owner, length), width, n).astype(np.int64))
    whole, starts = data.tobytes(), [0, *ends.tolist()]
    out = [whole[a:b] if d else None for a, b, d in zip(starts, starts[1:], drawn.tolist())]
    clipped = np.flatnonzero(over)
    for i, shape in zip(clipped.tolist(), rings.take(pa.array(clipped)).to_pylist()):
        out[i] = tile_geometry(shape, int(z[i]), int(tx[i]), int(ty[i]))
    return out


def encode_layer(name: str, features: Iterable[tuple[bytes, dict[str, int | str | None]]], keys: list[str]) -> bytes:
    """A tile of one layer of polygons; values are kept once, in the order they are met; null values are left out."""
    values: dict[int | str, int] = {}
    body = b""
    for geometry, attributes in features:
        tags = b"".join(varint(k) + varint(values.setdefault(attributes[key], len(values))) for k, key in enumerate(keys) if attributes.get(key) is not None)
        body += _field(2, _field(2, tags) + _number(3, 3) + _field(4, geometry))
    layer = _number(15, 2) + _field(1, name.encode()) + _number(5, EXTENT) + body
    layer += b"".join(_field(3, k.encode()) for k in keys)
    layer += b"".join(_field(4, _field(_TEXT, v.encode()) if isinstance(v, str) else _number(_INT, v)) for v in values)
    return _field(3, layer)


def tile_geometries(buildings: DataFrame, zooms: Iterable[int] = ZOOMS) -> DataFrame:
    """(z, x, y, building_id, area, geom) of buildings(building_id, rings in lng and lat), shared by all types; within budget."""

    def project(rings: Column) -> Column:
        def point(p):
            x, y = mercator(p["x"], p["y"])
            return F.struct(x.alias("x"), y.alias("y"))

        return F.transform(rings, lambda ring: F.transform(ring, point))

    def edge(column: str, pick, c: str) -> Column:
        return pick(F.transform(F.get(column, F.lit(0)), lambda p: p[c]))

    flat = buildings.select("building_id", project(F.col("rings")).alias("rings")).withColumn("area", F.abs(doubled_area(F.get("rings", F.lit(0)))))
    box = [edge("rings", F.array_min, "x"), edge("rings", F.array_min, "y"), edge("rings", F.array_max, "x"), edge("rings", F.array_max, "y")]

    def at_zoom(z: int) -> Column:
        return F.transform(tiles_of_box(*box, z), lambda t: F.struct(F.lit(z).alias("z"), t["x"].alias("x"), t["y"].alias("y")))

    every = F.flatten(F.array(*map(at_zoom, zooms)))
    met = flat.withColumn("tile", F.explode(every)).select("tile.*", "building_id", "area", "rings")

    def encode(batches):
        for b in batches:
            geom = batch_geometries(b.column(5), *(np.asarray(b.column(i)) for i in range(3)))
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(geom, pa.binary())], ["z", "x", "y", "building_id", "area", "geom"])

    encoded = met.mapInArrow(encode, "z int, x int, y int, building_id long, area double, geom binary").where("geom is not null")
    return within_budget(encoded, ["z", "x", "y"], F.length("geom") + FEATURE_COST, [F.col("area").desc(), F.col("building_id")])


def building_tiles(geometries: DataFrame, attributes: DataFrame, layer: str = "buildings") -> DataFrame:
    """(type_id, z, x, y, data): gzipped tiles of building_labels (type_id, building_id, pid, t, c) over shared geometry."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["area", "building_id"], ascending=[False, True])
        rows = ((g, {"pid": int(p), "t": None if pd.isna(t) else int(t), "c": c}) for g, p, t, c in zip(pdf.geom, pdf.pid, pdf.t, pdf.c))
        data = gzip.compress(encode_layer(layer, rows, ["pid", "t", "c"]), 6, mtime=0)
        return pd.DataFrame([(*(pdf[k].iloc[0] for k in ("type_id", "z", "x", "y")), data)], columns=["type_id", "z", "x", "y", "data"])

    return geometries.join(attributes, "building_id").groupBy("type_id", "z", "x", "y").applyInPandas(run, "type_id string, z int, x int, y int, data binary")


def hilbert_id(z: int, x: int, y: int) -> int:
    """Number of a tile in an archive."""
    d = (4**z - 1) // 3
    for level in range(z - 1, -1, -1):
        side = 1 << level
        rx, ry = x >> level & 1, y >> level & 1
        d += side * side * (3 * rx ^ ry)
        x, y = x & side - 1, y & side - 1
        if not ry:
            x, y = (side - 1 - y, side - 1 - x) if rx else (y, x)
    return d


def archive_directory(tiles: list[tuple[int, int, int]]) -> bytes:
    """A directory of (id, offset, length), by id, gzipped: deltas of ids, run lengths of 1, lengths, and offsets from 1,
    or 0 where a tile follows the one before."""
    out = varint(len(tiles)) + b"".join(varint(t[0] - b) for t, b in zip(tiles, [0, *[t[0] for t in tiles]]))
    out += b"".join(varint(1) for _ in tiles) + b"".join(varint(t[2]) for t in tiles)
    for i, (_, offset, _) in enumerate(tiles):
        follows = i and offset == tiles[i - 1][1] + tiles[i - 1][2]
        out += varint(0 if follows else offset + 1)
    return gzip.compress(out, mtime=0)


def write_archive(path: str, tiles: Iterable[tuple[int, int, int, bytes]], bbox, metadata: dict | None = None) -> int:
    """Write (z, x, y, gzipped data) as one archive of format 3, clustered by id; returns the number of tiles.

    One task writes one archive: that of one city and type.
    """
    rows = sorted((hilbert_id(z, x, y), z, data) for z, x, y, data in tiles)
    places, at = [], 0
    for i, _, data in rows:
        places.append((i, at, len(data)))
        at += len(data)
    root = archive_directory(places)
    meta = gzip.compress(json.dumps(metadata or {}).encode(), mtime=0)
    zs = [z for _, z, _ in rows] or [0]
    e7 = [round(v * 1e7) for v in bbox]
    centre = [round((bbox[0] + bbox[2]) / 2 * 1e7), round((bbox[1] + bbox[3]) / 2 * 1e7)]
    head = 127
    header = b"PMTiles\x03" + struct.pack("<11Q", head, len(root), head + len(root), len(meta), head + len(root) + len(meta), 0, head + len(root) + len(meta), at, len(rows), len(rows), len(rows))
    header += struct.pack("<6B4iB2i", 1, 2, 2, 1, min(zs), max(zs), *e7, min(zs), *centre)
    with open(path, "wb") as file:
        file.write(header + root + meta)
        for _, _, data in rows:
            file.write(data)
    return len(rows)


def read_archive(path: str) -> dict[int, bytes]:
    """Tiles of an archive with a root directory only, by id, as stored."""
    with open(path, "rb") as file:
        data = file.read()
    root_at, root_n, _, _, _, _, data_at = struct.unpack("<7Q", data[8:64])
    body, at, numbers = gzip.decompress(data[root_at : root_at + root_n]), 0, []
    while at < len(body):
        n = shift = 0
        while True:
            b = body[at]
            at += 1
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                break
        numbers.append(n)
    n, tiles, last, offset = numbers[0], {}, 0, 0
    for i in range(n):
        last += numbers[1 + i]
        length, place = numbers[1 + 2 * n + i], numbers[1 + 3 * n + i]
        offset = place - 1 if place else offset
        tiles[last] = data[data_at + offset : data_at + offset + length]
        offset += length
    return tiles
