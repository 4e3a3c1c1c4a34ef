"""Tests of the engine's own operators: generated inputs against plain Python, and properties that results must have."""

import heapq
import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ambula.config import City, config_hash, parse_feature_types, resolve_types
from ambula.functions import colour, geometry, names, walk
from ambula.functions.rules import compile_rule
from ambula.lookup import arrows, parse_hash, trace
from ambula.operators import components, extract, graph, knn, polygons, raster, sites, tiles


def holds(rule, tags):
    """A rule over a dict of tags."""
    if "any" in rule:
        return any(holds(r, tags) for r in rule["any"])
    if "all" in rule:
        return all(holds(r, tags) for r in rule["all"])
    if "not" in rule:
        return not holds(rule["not"], tags)
    value = tags.get(rule["key"])
    if "exists" in rule:
        return (value is not None) == rule["exists"]
    if "in" in rule:
        return value in rule["in"]
    return value is not None and any(part.lower() in value.lower() for part in rule["contains"])


def random_rule(rng, depth=0):
    kind = rng.choice(["any", "all", "not", "leaf", "leaf"]) if depth < 3 else "leaf"
    if kind in ("any", "all"):
        return {kind: [random_rule(rng, depth + 1) for _ in range(rng.integers(1, 4))]}
    if kind == "not":
        return {"not": random_rule(rng, depth + 1)}
    key = str(rng.choice(["craft", "sport", "title"]))
    return [{"key": key, "exists": bool(rng.integers(2))}, {"key": key, "in": ["tiler", "Golf"]}, {"key": key, "contains": ["GO", "il"]}][rng.integers(3)]


def test_random_rules(spark):
    rng = np.random.default_rng(21)
    values = [None, "tiler", "golf", "Golf", "Old Mill", "argot"]
    tags = [{k: v for k, v in zip(("craft", "sport", "title"), row) if v is not None} for row in itertools.product(values, values, values)]
    rules = [random_rule(rng) for _ in range(12)]
    frame = spark.createDataFrame(list(enumerate(tags)), "i int, tags map<string,string>")
    found = frame.select("i", *[compile_rule(r, F.col("tags")).alias(f"r{k}") for k, r in enumerate(rules)]).collect()
    assert all(row[f"r{k}"] == holds(r, tags[row.i]) for row in found for k, r in enumerate(rules))


def test_variants_and_errors():
    well = {"key": "man_made", "in": ["water_well"]}
    types = parse_feature_types([{"id": "well", "name": "Wells", "match": well, "variants": {"is": {"match": {"key": "natural", "in": ["spring"]}}}}, {"id": "hut", "name": "Huts", "match": {"key": "tourism", "in": ["hut"]}}])
    plain, other = City("o", "Oulu", "", ("hut", "well"), "fi"), City("r", "Reykjavik", "", ("hut", "well"), "is")
    by = {c.id: {t.id: t.match for t in resolve_types(c, types)} for c in (plain, other)}
    assert by["o"]["well"] == well and by["r"]["well"] == {"key": "natural", "in": ["spring"]} and by["o"]["hut"] == by["r"]["hut"]
    assert len({config_hash(resolve_types(c, types)) for c in (plain, other)}) == 2
    assert [t.id for t in resolve_types(plain, types, ["well"])] == ["well"]
    for wrong in (("hut", "moat"), ()):
        with pytest.raises(ValueError):
            resolve_types(City("e", "E", "", wrong), types)


def test_walkable_properties(spark):
    """What a further tag changes, for ways of every kind."""
    kinds = [*walk.WALK_HIGHWAYS, "trunk", "trunk_link", "motorway", "construction", None]
    extras = {"": {}, "barred": {"foot": "no"}, "closed": {"access": "private"}, "let in": {"access": "private", "foot": "permissive"}, "asked": {"foot": "designated"}, "ferry": {"route": "ferry"}, "side": {"sidewalk": "left"}, "window": {"service": "drive-through"}}
    rows = [(k or "", name, {**({"highway": k} if k else {}), **more}) for k in kinds for name, more in extras.items()]
    found = defaultdict(dict)
    for r in spark.createDataFrame(rows, "kind string, extra string, tags map<string,string>").select("kind", "extra", walk.walkable(F.col("tags")).alias("w")).collect():
        found[r.kind][r.extra] = r.w
    for kind, w in found.items():
        road, trunk = kind in walk.WALK_HIGHWAYS, kind.startswith("trunk")
        assert w[""] == road and w["side"] == (road or trunk) and w["asked"] == w["let in"] == (road or trunk)
        assert not (w["barred"] or w["closed"] or w["ferry"] or w["window"])


def test_times_by_formula(spark):
    rng = np.random.default_rng(22)
    rows = [(float(d), float(h), bool(s), bool(f)) for d, h, s, f in zip(rng.uniform(0, 300, 200), rng.uniform(-40, 40, 200), rng.integers(0, 2, 200), rng.integers(0, 2, 200))]

    def seconds(d, rise, steps):
        if steps:
            return d / (0.45 if rise > 0 else 0.6)
        return d / (6 / 3.6 * math.exp(-3.5 * abs(min(0.35, max(-0.35, rise / d)) + 0.05)))

    there, back = walk.segment_times_ds(F.col("d"), F.col("dh"), F.col("s"), F.col("f"))
    for r in spark.createDataFrame(rows, "d double, dh double, s boolean, f boolean").select("*", there.alias("t"), back.alias("b")).collect():
        rise = 0.0 if r.f or r.d < 3 else r.dh
        assert abs(r.t - max(1, 10 * seconds(r.d, rise, r.s))) <= 0.51 and abs(r.b - max(1, 10 * seconds(r.d, -rise, r.s))) <= 0.51


def test_components_and_prune(spark):
    rng = np.random.default_rng(23)
    pairs = [tuple(int(v) for v in rng.integers(0, 90, 2)) for _ in range(60)]
    least = {v: v for p in pairs for v in p}
    for _ in range(90):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    frame = spark.createDataFrame(pairs, "a long, b long")
    assert {tuple(r) for r in components.connected_components(frame).collect()} == set(least.items())
    size = defaultdict(int)
    for c in least.values():
        size[c] += 1
    assert {tuple(r) for r in graph.prune(frame, 6).select("a", "b").collect()} == {p for p in pairs if size[least[p[0]]] >= 6}


@pytest.mark.parametrize("method", ["kernel", "rounds"])
def test_shortest_paths(spark, method):
    """Distances by Dijkstra's method; each hop is a shortest step, and leads to the label that it hands on."""
    rng = np.random.default_rng(24)
    arcs = {(int(a), int(b)): int(w) for a, b, w in zip(rng.integers(0, 50, 160), rng.integers(0, 50, 160), rng.integers(1, 9, 160)) if a != b}
    seeds = [("well", 3, 0), ("well", 41, 1), ("hut", 17, 0)]
    frame = spark.createDataFrame([(a, b, w) for (a, b), w in arcs.items()], "src long, dst long, w int")
    found = graph.shortest_paths(frame, spark.createDataFrame(seeds, "type_id string, node_id long, pid long"), method).collect()
    for kind in ("well", "hut"):
        dist, heap = {}, [(0, n) for t, n, _ in seeds if t == kind]
        while heap:
            d, n = heapq.heappop(heap)
            if n not in dist:
                dist[n] = d
                for (a, b), w in arcs.items():
                    if a == n:
                        heapq.heappush(heap, (d + w, b))
        mine = {r.node_id: r for r in found if r.type_id == kind}
        assert {n: r.dist_ds for n, r in mine.items()} == dist
        for n, r in mine.items():
            if r.next_hop is None:
                assert ("well" if kind == "well" else "hut", n, r.pid) in seeds
            else:
                assert mine[r.next_hop].dist_ds + arcs[r.next_hop, n] == r.dist_ds and mine[r.next_hop].pid == r.pid


def test_rounds_are_few_and_agree(spark, monkeypatch):
    """On a long strip with many equal ways, in many blocks: the kernel's rows, in few rounds for 400 arcs from end to end."""
    rng = np.random.default_rng(27)
    at = [(x, y) for y in range(400) for x in range(4)]
    pairs = [(4 * y + x, 4 * (y + b) + x + a) for x, y in at for a, b in ((1, 0), (0, 1)) if x + a < 4 and y + b < 400]
    arcs = [(a, b, int(rng.integers(1, 3))) for p in pairs for a, b in (p, p[::-1]) if rng.random() < 0.95] + [(7, 5000, 1), (0, 4, 9)]
    seeds = [("well", 3, 0), ("well", 41, 1), ("hut", 1590, 7), ("hut", 9000, 8)]
    frame, start = spark.createDataFrame(arcs, "src long, dst long, w int"), spark.createDataFrame(seeds, "type_id string, node_id long, pid long")
    stages = []

    def counted(df, name):
        stages.append(name)
        assert len(stages) < 60, "too many rounds"
        return write(df, name)

    write = graph.write_stage
    monkeypatch.setattr(graph, "write_stage", counted)
    for block_arcs in (500, 100_000):
        stages.clear()
        found, want = ({tuple(r) for r in graph.shortest_paths(frame, start, *how).collect()} for how in (("rounds", block_arcs), ("kernel",)))
        assert found == want and len(found) > 3000
        assert stages.count("dist") < 30


def test_sites(spark):
    """Sites are the components of places with alike names that lie close, whatever the type's other places."""
    rng = np.random.default_rng(25)
    words = ["Harbour", "Harbour North", "Mill", "mill!", None, ""]
    rows = [("t", i, words[rng.integers(6)], float(rng.uniform(0, 0.02)), float(60 + rng.uniform(0, 0.002))) for i in range(60)]

    def norm(name):
        return "".join(c.lower() if c.isalnum() else " " for c in name or "").split()

    def close(p, q):
        a, b = " ".join(norm(p[2])), " ".join(norm(q[2]))
        h = math.sin(math.radians(q[4] - p[4]) / 2) ** 2 + math.cos(math.radians(p[4])) * math.cos(math.radians(q[4])) * math.sin(math.radians(q[3] - p[3]) / 2) ** 2
        return a and b and (a.startswith(b) or b.startswith(a)) and 2 * walk.EARTH_M * math.asin(math.sqrt(h)) <= sites.GROUP_RADIUS_M

    site = list(range(60))
    for _ in range(60):
        for p, q in itertools.combinations(rows, 2):
            if close(p, q):
                site[p[1]] = site[q[1]] = min(site[p[1]], site[q[1]])
    want = defaultdict(list)
    for i, s in enumerate(site):
        want[s].append(i)
    found = sites.group_sites(spark.createDataFrame(rows, "type_id string, id long, name string, lng double, lat double")).orderBy("pid").collect()
    assert sorted([m.id for m in r.members] for r in found) == sorted(want.values()) and [r.pid for r in found] == list(range(len(found)))
    for r in found:
        ids = [m.id for m in r.members]
        assert r.k == len(ids) and r.name == rows[ids[0]][2] and abs(r.lng - np.mean([rows[i][3] for i in ids])) < 1e-12


def test_nearest(spark):
    rng = np.random.default_rng(26)
    p, q = rng.uniform(0, 0.05, (80, 2)), rng.uniform(0, 0.05, (40, 2))
    xy = lambda v: v * [walk.KX * math.cos(math.radians(0.02)), walk.KY]
    d = np.linalg.norm(xy(p)[:, None] - xy(q)[None], axis=2)
    points = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(p)], "id long, lng double, lat double")
    targets = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(q)], "node_id long, lng double, lat double")
    found = {r.id: (r.node_id, round(r.dist_m, 6)) for r in knn.nearest_within(points, targets, 400.0, 0.02, "id", steps=(100.0,)).collect()}
    assert found == {i: (int(row.argmin()), round(float(row.min()), 6)) for i, row in enumerate(d) if row.min() <= 400}
    own = np.linalg.norm(xy(p)[:, None] - xy(p)[None], axis=2) + np.diag(np.full(80, np.inf))
    lonely = {r.id: r.dist_m for r in knn.nearest_other(points.withColumn("g", F.lit("g")), "id", "g", 0.02, size=20.0).collect()}
    assert len(lonely) == 80 and all(abs(lonely[i] - own[i].min()) < 1e-6 for i in range(80))


def test_stitch():
    """A loop cut anywhere, its parts turned and shuffled, is one loop with the same sides; a part less, it is none."""
    rng = np.random.default_rng(27)
    for _ in range(30):
        loop = rng.permutation(40)[: rng.integers(4, 20)].tolist()
        cuts = sorted(rng.choice(len(loop), rng.integers(2, 4), replace=False).tolist())
        parts = [(loop + loop)[a : b + 1] for a, b in zip(cuts, [*cuts[1:], cuts[0] + len(loop)])]
        chains = [parts[i][:: rng.choice([-1, 1])] for i in rng.permutation(len(parts))]
        (ring,) = extract.stitch(chains)
        sides = lambda r: {frozenset(e) for e in zip(r, r[1:])}
        assert ring[0] == ring[-1] and len(ring) == len(loop) + 1 and sides(ring) == sides([*loop, loop[0]])
        assert extract.stitch(chains[1:]) == []


def area(polys):
    return sum(polygons.ring_area(r[:-1]) for p in polys for r in p)


def test_polygons():
    rng = np.random.default_rng(28)
    noise = rng.integers(-1, 4, (23, 31))
    shapes = polygons.label_polygons(noise, smooth=False)
    assert {k: area(v) for k, v in shapes.items()} == {k: float((noise == k).sum()) for k in range(4)}
    for k, polys in shapes.items():  # a cell's centre is within an odd number of its label's rings
        for y, x in zip(*map(np.ndarray.tolist, np.nonzero(noise == k))):
            assert sum(polygons.in_ring((x + 0.5, y + 0.5), r) for p in polys for r in p) % 2 == 1
    smooth = polygons.label_polygons(np.kron(rng.integers(0, 3, (5, 7)), np.ones((7, 7), int)))
    assert all(r[0] == r[-1] for p in smooth.values() for q in p for r in q)


def patches(r):
    left, out = {(y, x) for y in range(r.shape[0]) for x in range(r.shape[1])}, []
    while left:
        todo = [left.pop()]
        for y, x in todo:
            for n in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if n in left and r[n] == r[y, x]:
                    left.remove(n)
                    todo.append(n)
        out.append(todo)
    return out


def test_absorb():
    """Only patches under the least size change, and each takes a label that it touches."""
    rng = np.random.default_rng(29)
    r = np.kron(rng.integers(-1, 3, (6, 6)), np.ones((4, 4), int))
    r[rng.integers(0, 24, 25), rng.integers(0, 24, 25)] = rng.integers(-1, 3, 25)
    out = raster.absorb_islands(r, 5)
    large = [p for p in patches(r) if len(p) >= 5]
    assert (out != r).any() and all(out[c] == r[c] for p in large for c in p)
    assert len(patches(out)) < len(patches(r)) and (raster.absorb_islands(r, 1) == r).all()


def test_colours(spark):
    rng = np.random.default_rng(30)
    for n in (2, 9, 40):
        pairs = [(i, i + 1) for i in range(n - 1)] + [(i, i + 3) for i in range(n - 3) if rng.integers(2)]
        c = polygons.colour_classes(n, pairs)
        assert len(c) == n and set(c) <= set(range(len(colour.PALETTE))) and all(c[a] != c[b] for a, b in pairs)
    times = [0, 300, 900, 1500, 1800, 4000]
    frame = spark.createDataFrame([(p, t) for p in colour.PALETTE for t in times], "p string, t int").select("p", "t", colour.building_colour(F.col("p"), F.col("t")).alias("c"))
    by = defaultdict(dict)
    for r in frame.collect():
        by[r.p][r.t] = r.c
    for shades in by.values():  # darker the longer the walk, up to half an hour
        light = [colour.lightness(shades[t]) for t in times]
        assert light[:5] == sorted(light[:5], reverse=True) and light[0] > light[4] and shades[1800] == shades[4000]


def test_batch_geometries():
    """Shells and holes within a tile, over its edge and outside, closed or not, with repeats: a batch as row by row."""
    rng, rows, place = np.random.default_rng(3), [], []
    for _ in range(1500):
        z = int(rng.integers(0, 16))
        at = rng.integers(0, 1 << z, 2)
        shape = []
        for _ in range(rng.integers(0, 4)):
            middle, radius = rng.uniform(-0.05, 1.05, 2), rng.choice([0.0002, 0.003, 0.05])
            turn = np.sort(rng.uniform(0, 2 * math.pi, rng.integers(0, 9))) * rng.choice([-1, 1])
            ring = [{"x": float(x), "y": float(y)} for x, y in (at + middle + radius * np.stack((np.cos(turn), np.sin(turn)), 1)) / (1 << z)]
            shape.append((ring[:1] if rng.random() < 0.2 else []) + ring + (ring[:1] if rng.random() < 0.7 else []))
        rows.append(shape)
        place.append((z, *at.tolist()))
    rings = pa.array(rows, pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))
    places = np.array(place, np.int32).T
    expected = [tiles.tile_geometry(shape, *at) for shape, at in zip(rows, place)]
    assert sum(e is not None and len(e) > 0 for e in expected) > 300
    assert tiles.batch_geometries(rings, *places) == expected
    assert tiles.batch_geometries(rings[200:300], *places[:, 200:300]) == expected[200:300]
    assert tiles.batch_geometries(rings[:0], *places[:, :0]) == []


def test_tile_ids(spark):
    """Numbers of a zoom follow those of the zoom before, are dense, and neighbours in number are neighbours in place."""
    at = 0
    for z in range(5):
        side = 1 << z
        ids = {tiles.hilbert_id(z, x, y): (x, y) for x in range(side) for y in range(side)}
        assert sorted(ids) == list(range(at, at + side * side))
        line = [ids[i] for i in sorted(ids)]
        assert all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(line, line[1:]))
        at += side * side
    found = spark.range(64).select(F.col("id"), geometry.hilbert_tile_id(3, F.col("id") % 8, F.floor(F.col("id") / 8)).alias("t")).collect()
    assert all(r.t == tiles.hilbert_id(3, r.id % 8, r.id // 8) for r in found)


def test_archive(tmp_path):
    rng = np.random.default_rng(31)
    found = [(z, int(x), int(y), rng.bytes(int(rng.integers(1, 60)))) for z in (3, 5) for x, y in {tuple(v) for v in rng.integers(0, 1 << z, (20, 2)).tolist()}]
    assert tiles.write_archive(str(tmp_path / "a"), found, (3, 60, 4, 61)) == len(found)
    assert tiles.read_archive(str(tmp_path / "a")) == {tiles.hilbert_id(z, x, y): d for z, x, y, d in found}


def test_budget(spark):
    rng = np.random.default_rng(32)
    rows = [(int(t), i, int(c)) for i, (t, c) in enumerate(zip(rng.integers(0, 3, 60), rng.integers(1, 400, 60)))]
    used, want = defaultdict(int), set()
    for t, i, c in rows:
        if used[t] <= 2000:
            want.add(i)
        used[t] += c
    assert {r.i for r in tiles.within_budget(spark.createDataFrame(rows, "t int, i int, cost int"), ["t"], F.col("cost"), [F.col("i")], 2000).collect()} == want


def test_dem(spark):
    name = raster.dem_tile_name(F.col("a"), F.col("b")).alias("n")
    got = [r.n for r in spark.createDataFrame([(7, 9), (-3, -120)], "a int, b int").select(name).collect()]
    assert got == ["Copernicus_DSM_COG_10_N07_00_E009_00_DEM", "Copernicus_DSM_COG_10_S03_00_W120_00_DEM"]
    rng = np.random.default_rng(33)
    v = rng.uniform(0, 90, (5, 6)).astype("f4")
    v[2, 3] = -32767
    dem = spark.createDataFrame([(60, 24, 6, 5, r, c, float(v[r, c])) for r in range(5) for c in range(6)], "lat0 int, lng0 int, w int, h int, row int, col int, v float")
    spots = [(i, 24 + float(x), 60 + float(y)) for i, (x, y) in enumerate(rng.uniform(0, 1, (40, 2)))]
    found = {r.id: r.elev for r in raster.sample_elevation(spark.createDataFrame([*spots, (99, 3.5, 60.5)], "id long, lng double, lat double"), dem, "id").collect()}
    height = np.where(v < -1000, 0, v)
    for i, lng, lat in spots:
        x, y = np.clip((lng - 24) * 6 - 0.5, 0, 5), np.clip((61 - lat) * 5 - 0.5, 0, 4)
        x0, y0 = int(x), int(y)
        x1, y1 = min(x0 + 1, 5), min(y0 + 1, 4)
        top, low = height[y0, x0] * (1 - x + x0) + height[y0, x1] * (x - x0), height[y1, x0] * (1 - x + x0) + height[y1, x1] * (x - x0)
        assert abs(found[i] - (top * (1 - y + y0) + low * (y - y0))) < 1e-3
    assert found[99] == 0.0


def test_names(spark):
    raw = ["  Über—Straße 7b ", "!!", "", "ÅNGSTRÖM", "a_b  c"]
    got = [r.n for r in spark.createDataFrame([(i, n) for i, n in enumerate(raw)], "i int, n string").orderBy("i").select(names.normalize(F.col("n")).alias("n")).collect()]
    assert got == ["über straße 7b", "", "", "ångström", "a b c"]


def test_trace_and_links():
    grid = raster.Grid(0.0, 3.0, 1.0, 1.0, 3, 3)
    dirs = np.array([[3, 3, 5], [0, 0, 5], [0, 0, 0]])
    line = trace(grid, dirs, 0.5, 2.5)
    assert line[0] == (0.5, 2.5) and line[-1] == (2.5, 0.5)
    assert trace(grid, dirs, 0.5, 0.5) is None and trace(grid, dirs, 9.0, 9.0) is None
    assert arrows([(0.0, 0.0), (0.01, 0.0)], 15)[-1] == (0.01, 0.0, None)
    assert parse_hash("#x/pub/areas/12/51.5/-0.1").zoom == 12.0 and parse_hash("").city is None


def test_pbf(spark, tmp_path):
    from ambula.sources import osm_pbf

    def field(n, data):
        return tiles.varint(n << 3 | 2) + tiles.varint(len(data)) + data

    def number(n, v):
        return tiles.varint(n << 3) + tiles.varint(v)

    def zz(*values):
        return b"".join(tiles.varint(v << 1 if v >= 0 else -v * 2 - 1) for v in values)

    strings = b"".join(field(1, s) for s in (b"", b"highway", b"steps", b"outer"))
    dense = field(2, field(1, zz(10, 1)) + field(8, zz(500_000_000, 10)) + field(9, zz(-1_000_000, 20)) + field(10, bytes([1, 2, 0, 0])))
    way = field(3, number(1, 7) + field(2, bytes([1])) + field(3, bytes([2])) + field(8, zz(10, 1)))
    relation = field(4, number(1, 9) + field(8, bytes([3])) + field(9, zz(7)) + field(10, bytes([1])))
    block = field(1, strings) + b"".join(field(2, g) for g in (dense, way, relation))
    path = tmp_path / "x.pbf"
    out = b""
    for kind, body in ((b"OSMHeader", b""), (b"OSMData", block)):
        blob = field(3, zlib.compress(body)) + number(2, len(body))
        head = field(1, kind) + number(3, len(blob))
        out += len(head).to_bytes(4, "big") + head + blob
    path.write_bytes(out)
    osm_pbf.register(spark)
    read = {e: [r.asDict(True) for r in spark.read.format("osm_pbf").option("element", e).load(str(path)).collect()] for e in osm_pbf.SCHEMAS}
    assert [n["id"] for n in read["node"]] == [10, 11] and math.isclose(read["node"][0]["lat"], 50.0) and read["node"][0]["tags"] == {"highway": "steps"}
    assert read["way"] == [{"id": 7, "refs": [10, 11], "tags": {"highway": "steps"}}]
    assert read["relation"] == [{"id": 9, "members": [{"type": "way", "ref": 7, "role": "outer"}], "tags": {}}]
