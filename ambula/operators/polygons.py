"""Catchment polygons: borders of a label raster, smoothed once for both sides, put together into shells and holes.

Points are grid corners, x right and y down; shells have a positive, holes a negative shoelace area.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ambula.functions.colour import PALETTE

Point = tuple[float, float]
EPSILON = 0.9
ROUNDS = 2
NONE = -1


def ring_area(ring: list[Point]) -> float:
    """Of a ring with or without its closing point."""
    return sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, [*ring[1:], ring[0]])) / 2


def in_ring(p: Point, ring: list[Point]) -> bool:
    inside = False
    for a, b in zip(ring, [*ring[1:], ring[0]]):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            inside = not inside
    return inside


def drop_collinear(line: list[Point], closed: bool) -> list[Point]:
    """Without points on the straight between their neighbours; open ends stay, and so does a loop that would vanish."""
    n = len(line)
    if n < 3:
        return line

    def bent(i: int) -> bool:
        a, b, c = line[i - 1], line[i], line[(i + 1) % n]
        return abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) > 1e-9

    kept = [p for i, p in enumerate(line) if (not closed and i in (0, n - 1)) or bent(i)]
    return line if closed and len(kept) < 3 else kept


def simplify(line: list[Point], epsilon: float = EPSILON) -> list[Point]:
    """Douglas-Peucker with fixed ends."""
    keep, spans = {0, len(line) - 1}, [(0, len(line) - 1)]
    while spans:
        lo, hi = spans.pop()
        (ax, ay), (bx, by) = line[lo], line[hi]
        length = math.hypot(bx - ax, by - ay)
        far, at = epsilon, None
        for i in range(lo + 1, hi):
            px, py = line[i]
            d = abs((bx - ax) * (ay - py) - (ax - px) * (by - ay)) / length if length else math.hypot(px - ax, py - ay)
            if d > far:
                far, at = d, i
        if at is not None:
            keep.add(at)
            spans += [(lo, at), (at, hi)]
    return [line[i] for i in sorted(keep)]


def chaikin(line: list[Point], closed: bool, rounds: int = ROUNDS) -> list[Point]:
    """Corner cutting at a quarter and three quarters; open ends stay."""
    for _ in range(rounds):
        if len(line) < 3:
            return line
        pairs = list(zip(line, [*line[1:], line[0]] if closed else line[1:]))
        cut = [q for a, b in pairs for q in ((0.75 * a[0] + 0.25 * b[0], 0.75 * a[1] + 0.25 * b[1]), (0.25 * a[0] + 0.75 * b[0], 0.25 * a[1] + 0.75 * b[1]))]
        line = cut if closed else [line[0], *cut[1:-1], line[-1]]
    return line


def smooth_line(line: list[Point], closed: bool) -> list[Point]:
    """A border line, straightened and rounded; loops are given and returned without their closing point."""
    line = drop_collinear(line, closed)
    if closed:
        if len(line) > 4:
            far = max(range(len(line)), key=lambda i: (math.dist(line[0], line[i]), -i))
            halves = simplify(line[: far + 1])[:-1] + simplify([*line[far:], line[0]])[:-1]
            line = halves if len(halves) >= 3 else line
        return chaikin(line, True)
    return chaikin(simplify(line), False)


def border_lines(raster: np.ndarray, smooth: bool = True):
    """Lines between two labels from junction to junction, each once: (right label, left label, points, closed, raw)."""
    h, w = raster.shape
    padded = np.full((h + 2, w + 2), NONE, np.int64)
    padded[1:-1, 1:-1] = raster
    steps: dict[tuple[int, int], dict[Point, list[tuple[Point, int]]]] = defaultdict(lambda: defaultdict(list))

    def add(ys, xs, right, left, ax, ay, bx, by):
        for y, x in zip(ys.tolist(), xs.tolist()):
            r, lft = int(right[y, x]), int(left[y, x])
            p, q = (x + ax, y + ay), (x + bx, y + by)
            if r > lft:  # one direction for each pair: the smaller label on the right
                r, lft, p, q = lft, r, q, p
            steps[(r, lft)][p].append((q, 1))
            steps[(r, lft)][q].append((p, -1))

    above, below = padded[:-1, 1:-1], padded[1:, 1:-1]
    add(*np.nonzero(above != below), below, above, 0, 0, 1, 0)  # going right, what is below is on the right
    west, east = padded[1:-1, :-1], padded[1:-1, 1:]
    add(*np.nonzero(west != east), west, east, 0, 0, 0, 1)  # going down, what is west is on the right
    for (right, left), around in sorted(steps.items()):
        junctions = {p for p, ways in around.items() if len(ways) != 2 or sum(s for _, s in ways)}
        gone: set[tuple[Point, Point]] = set()
        for start in [*sorted(junctions), *sorted(p for p in around if p not in junctions)]:
            for first in sorted(q for q, s in around[start] if s > 0):
                if (start, first) in gone:
                    continue
                line, closed = [start, first], False
                gone.add((start, first))
                while line[-1] not in junctions:
                    q = next(q for q, s in around[line[-1]] if s > 0)
                    if line[-1] == start:
                        closed = True
                        break
                    gone.add((line[-1], q))
                    line.append(q)
                closed = closed or (line[-1] == start and start not in junctions)
                points = line[:-1] if closed else line
                raw = (line[0], line[1], line[-2], line[-1])
                yield right, left, (smooth_line(points, closed) if smooth else drop_collinear(points, closed)), closed, raw


def label_polygons(raster: np.ndarray, smooth: bool = True) -> dict[int, list[list[list[Point]]]]:
    """label: polygons: rings (the shell first, closed): points, labels ascending."""
    whole: dict[int, list[list[Point]]] = defaultdict(list)
    parts: dict[int, list[tuple[list[Point], Point, Point, Point, Point]]] = defaultdict(list)
    for right, left, points, closed, (a, b, c, d) in border_lines(raster, smooth):
        for label, line, ends in ((right, points, (a, b, c, d)), (left, points[::-1], (d, c, b, a))):
            if label == NONE:
                continue
            if closed:
                whole[label].append(line)
            else:
                parts[label].append((line, *ends))
    out = {}
    for label in sorted({*whole, *parts}):
        rings = [r for r in whole[label]] + _chain(parts[label])
        out[label] = _shells([[*r, r[0]] for r in rings if len(r) >= 3])
    return out


def _chain(parts) -> list[list[Point]]:
    """Rings of directed lines: at each junction on by the sharpest turn to the right, back last."""
    by_start = defaultdict(list)
    for i, part in enumerate(parts):
        by_start[part[1]].append(i)
    used, rings = [False] * len(parts), []
    for i in range(len(parts)):
        if used[i]:
            continue
        ring, at = [], i
        while not used[at]:
            used[at] = True
            line, _, _, c, d = parts[at]
            ring += line[:-1]
            into = (d[0] - c[0], d[1] - c[1])
            free = [k for k in by_start[d] if not used[k]]
            if not free:
                break

            def turn(k: int) -> tuple[bool, float]:
                _, a, b, _, _ = parts[k]
                on = (b[0] - a[0], b[1] - a[1])
                cross, dot = into[0] * on[1] - into[1] * on[0], into[0] * on[0] + into[1] * on[1]
                return (cross != 0 or dot > 0), cross

            at = max(free, key=turn)
        rings.append(ring)
    return rings


def _shells(rings: list[list[Point]]) -> list[list[list[Point]]]:
    """Shells, smallest first, each with the holes whose test point it is the first to hold; other holes go."""
    areas = [(ring_area(r[:-1]), r) for r in rings]
    shells = [[r] for a, r in sorted((x for x in areas if x[0] > 1e-9), key=lambda x: x[0])]
    for a, r in areas:
        if a < -1e-9:
            (ax, ay), (bx, by) = r[0], r[1]
            n = math.hypot(bx - ax, by - ay) or 1.0
            inside = ((ax + bx) / 2 - 0.4 * (by - ay) / n, (ay + by) / 2 + 0.4 * (bx - ax) / n)  # right of the edge: in the label
            for shell in shells:
                if in_ring(inside, shell[0]):
                    shell.append(r)
                    break
    return shells


def colour_classes(n: int, pairs: list[tuple[int, int]], classes: int = len(PALETTE)) -> list[int]:
    """A class for each of n labels, by falling number of neighbours: the least that none of them has, else the rarest among them."""
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    found: dict[int, int] = {}
    for v in sorted(range(n), key=lambda v: (-len(near[v]), v)):
        used = [found[u] for u in near[v] if u in found]
        found[v] = min(range(classes), key=lambda c: (used.count(c), c))
    return [found[v] for v in range(n)]


_RINGS = "array<array<array<struct<x:double,y:double>>>>"


def catchments(labelled: DataFrame, grid, smooth: bool = True) -> DataFrame:
    """(type_id, pid, color, polygons) of the labels of each type's raster, in places (lng, lat). A task holds one raster."""
    from ambula.operators.raster import to_raster

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        raster = to_raster(pdf, grid)
        shapes = label_polygons(raster, smooth)
        pairs = set()
        for a, b in ((raster[:, :-1], raster[:, 1:]), (raster[:-1], raster[1:])):
            mask = (a != b) & (a != NONE) & (b != NONE)
            pairs |= set(zip(np.minimum(a, b)[mask].tolist(), np.maximum(a, b)[mask].tolist()))
        order = {label: i for i, label in enumerate(shapes)}
        colours = colour_classes(len(shapes), [(order[a], order[b]) for a, b in pairs])
        rows = [
            (pdf.type_id.iloc[0], label, colours[i], [[[{"x": grid.west + x * grid.dlng, "y": grid.north - y * grid.dlat} for x, y in ring] for ring in polygon] for polygon in shapes[label]])
            for label, i in order.items()
        ]
        return pd.DataFrame(rows, columns=["type_id", "pid", "color", "polygons"])

    return labelled.groupBy("type_id").applyInPandas(run, f"type_id string, pid long, color int, polygons {_RINGS}")
