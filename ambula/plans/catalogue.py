"""Queries of the engine's own operators over the derived geography, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ambula.config import City, parse_feature_types, resolve_types
from ambula.functions import colour, geometry, names, walk
from ambula.functions.rules import compile_rule, matching_types
from ambula.operators import components, extract, graph, knn, polygons, raster, sites, tiles
from ambula.plans import fixtures as fx
from ambula.plans.fixtures import sql
from ambula.stages import write_stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
CELL_M = 40.0
_MID = "CAST('0.017453292519943295' AS DOUBLE) * {} "  # radians
fx.CTE["grid"] = f"""SELECT *, CAST('{walk.KX!r}' AS DOUBLE) * cos({_MID.format("(north - h * dlat / 2)")}) AS kx FROM
    (SELECT *, CAST(greatest(1, ceil((east - west) / dlng)) AS INT) AS w, CAST(greatest(1, ceil((north - south) / dlat)) AS INT) AS h FROM
    (SELECT *, {CELL_M} / CAST('{walk.KY!r}' AS DOUBLE) AS dlat, {CELL_M} / (CAST('{walk.KX!r}' AS DOUBLE) * cos({_MID.format("((south + north) / 2)")})) AS dlng FROM
    (SELECT min(lng) AS west, min(lat) AS south, max(lng) AS east, max(lat) AS north FROM geo_nodes)))"""
fx.NEEDS["grid"] = ["geo_nodes"]
TYPES = parse_feature_types(
    [
        {"id": "supermarket", "name": "Supermarkets", "match": {"all": [{"key": "shop", "in": ["supermarket"]}, {"key": "brand", "exists": True}]}, "variants": {"uk": {"match": {"key": "shop", "in": ["supermarket"]}}}},
        {"id": "grocery", "name": "Grocery stores", "match": {"any": [{"key": "shop", "in": ["convenience"]}, {"all": [{"key": "shop", "in": ["supermarket"]}, {"not": {"key": "brand", "exists": True}}]}]}},
        {"id": "cafe", "name": "Cafes", "match": {"key": "amenity", "in": ["cafe"]}},
        {"id": "pub", "name": "Pubs", "match": {"key": "amenity", "in": ["pub", "biergarten"]}},
        {"id": "red", "name": "Red names", "match": {"key": "name", "contains": ["RED", "gizmo"]}},
    ]
)
_SUPER, _BRAND = "coalesce(shop = 'supermarket', false)", "brand IS NOT NULL"
_MATCH = {
    "supermarket": f"{_SUPER} AND {_BRAND}",
    "grocery": f"(coalesce(shop = 'convenience', false) OR ({_SUPER} AND NOT ({_BRAND})))",
    "cafe": "coalesce(amenity = 'cafe', false)",
    "pub": "coalesce(amenity IN ('pub', 'biergarten'), false)",
    "red": "coalesce(contains(lower(name), 'red') OR contains(lower(name), 'gizmo'), false)",
}
_FEATURES = " UNION ALL ".join(f"SELECT '{t}' AS type_id, osm_id AS id, name, lng, lat FROM geo_pois WHERE {m}" for t, m in _MATCH.items())
_HAVERSINE = "2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lng - {a}.lng) / 2), 2))))"
_NORM = "trim(regexp_replace(lower(name), '[^\\p{L}\\p{N}]+', ' ', 'g'))"
_PAIRS = f"""SELECT a.type_id, a.id AS a, b.id AS b FROM (SELECT *, {_NORM} AS n FROM features WHERE name IS NOT NULL) a JOIN (SELECT *, {_NORM} AS n FROM features WHERE name IS NOT NULL) b
    ON a.type_id = b.type_id AND a.id < b.id AND a.n <> '' AND b.n <> '' AND (starts_with(a.n, b.n) OR starts_with(b.n, a.n)) AND {_HAVERSINE.format(a='a', b='b')} <= 100"""
_SITES = {
    "features": _FEATURES,
    "pairs": _PAIRS,
    "ways_": "SELECT type_id, a, b FROM pairs UNION ALL SELECT type_id, b, a FROM pairs",
    "reach(type_id, id, site) USING KEY (type_id, id)": """SELECT type_id, id, id FROM features UNION SELECT r.type_id, w.b, min(r.site) FROM reach r JOIN ways_ w ON w.type_id = r.type_id AND w.a = r.id
        JOIN recurring.reach o ON o.type_id = r.type_id AND o.id = w.b WHERE r.site < o.site GROUP BY r.type_id, w.b""",
    "grouped": "SELECT type_id, site, arg_min(name, id) FILTER (id = site) AS name, sum(lng ORDER BY id) / count(*) AS lng, sum(lat ORDER BY id) / count(*) AS lat, count(*) AS k FROM features JOIN reach USING (type_id, id) GROUP BY type_id, site",
    "sites": "SELECT type_id, row_number() OVER (PARTITION BY type_id ORDER BY lng, lat, site) - 1 AS pid, name, lng, lat, k FROM grouped",
}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


def _tagged(spark, d):
    return fx.poi_tags(fx.geo_pois(spark, d))


def _features(spark, d) -> DataFrame:
    p = _tagged(spark, d)
    return p.select(F.explode(matching_types(TYPES, F.col("tags"))).alias("type_id"), F.col("osm_id").alias("id"), "name", "lng", "lat")


# ---- rules ----


@query(sql(f"SELECT osm_id, ({_MATCH['grocery']}) AS grocery, ({_MATCH['pub']}) AS pub, NOT ({_MATCH['cafe']}) AS not_cafe FROM geo_pois", "geo_pois"))
def rule_any_all_not(spark, d):
    tags, by = F.col("tags"), {t.id: t.match for t in TYPES}
    return _tagged(spark, d).select("osm_id", compile_rule(by["grocery"], tags).alias("grocery"), compile_rule(by["pub"], tags).alias("pub"), compile_rule({"not": by["cafe"]}, tags).alias("not_cafe"))


@query(sql(f"SELECT osm_id, ({_MATCH['red']}) AS red FROM geo_pois", "geo_pois"))
def rule_contains(spark, d):
    return _tagged(spark, d).select("osm_id", compile_rule(TYPES[4].match, F.col("tags")).alias("red"))


@query(sql("SELECT osm_id, brand IS NOT NULL AS branded, shop IS NULL AS no_shop FROM geo_pois", "geo_pois"))
def rule_exists(spark, d):
    tags = F.col("tags")
    return _tagged(spark, d).select("osm_id", compile_rule({"key": "brand", "exists": True}, tags).alias("branded"), compile_rule({"key": "shop", "exists": False}, tags).alias("no_shop"))


@query(sql(f"SELECT osm_id, ({_SUPER} AND {_BRAND}) AS base, {_SUPER} AS uk FROM geo_pois", "geo_pois"))
def variant_resolve(spark, d):
    base = resolve_types(City("x", "X", "", ("supermarket",), "fr"), TYPES)[0]
    uk = resolve_types(City("y", "Y", "", ("supermarket",), "uk"), TYPES)[0]
    return _tagged(spark, d).select("osm_id", compile_rule(base.match, F.col("tags")).alias("base"), compile_rule(uk.match, F.col("tags")).alias("uk"))


@query(sql("SELECT type_id, count(*) AS n FROM features GROUP BY type_id", "geo_pois", features=_FEATURES))
def type_explode_counts(spark, d):
    return _features(spark, d).groupBy("type_id").agg(F.count(F.lit(1)).alias("n"))


@query(sql("SELECT osm_id FROM geo_pois WHERE lng BETWEEN -0.09 AND -0.07 AND lat BETWEEN 51.505 AND 51.52", "geo_pois"))
def bbox_filter(spark, d):
    return fx.geo_pois(spark, d).where(geometry.in_bbox(F.col("lng"), F.col("lat"), (-0.09, 51.505, -0.07, 51.52))).select("osm_id")


# ---- ways and segments ----


def _ways(spark, d) -> DataFrame:
    refs = fx.geo_way_refs(spark, d)
    tags = F.map_from_entries(F.filter(F.array(F.struct(F.lit("highway").alias("k"), F.col("highway").alias("v")), F.struct(F.lit("sidewalk").alias("k"), F.col("sidewalk").alias("v"))), lambda p: p["v"].isNotNull()))
    first = F.min(F.struct("pos", "highway", "sidewalk"))
    ways = refs.groupBy("way_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ref"))), lambda s: s["ref"]).alias("refs"), first.alias("f"))
    return ways.select(F.col("way_id").alias("id"), "refs", F.col("f.highway").alias("highway"), F.col("f.sidewalk").alias("sidewalk")).withColumn("tags", tags).select("id", "refs", "tags")


_FIRST = "SELECT way_id, arg_min(highway, pos) AS highway, CASE WHEN count(*) FILTER (pos = 0 AND sidewalk = 'yes') > 0 THEN 'yes' END AS sidewalk FROM geo_way_refs GROUP BY way_id"
_WALK = "highway IN ('footway', 'steps') OR (highway = 'trunk' AND coalesce(sidewalk = 'yes', false))"


@query(sql(f"SELECT way_id, ({_WALK}) AS walkable, highway = 'steps' AS steps FROM f", "geo_way_refs", f=_FIRST))
def walkable_ways(spark, d):
    tags = F.col("tags")
    return _ways(spark, d).select(F.col("id").alias("way_id"), walk.walkable(tags).alias("walkable"), walk.is_steps(tags).alias("steps"))


@query(
    sql(
        f"SELECT way_id, pos, a, b, highway = 'steps' AS steps FROM (SELECT way_id, pos, ref AS a, lead(ref) OVER (PARTITION BY way_id ORDER BY pos) AS b FROM geo_way_refs) JOIN f USING (way_id) WHERE a <> b AND ({_WALK}) AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = a AND s_acctbal > 0) AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = b AND s_acctbal > 0)",
        "geo_way_refs", f=_FIRST,
    )
)
def way_pairs(spark, d):
    known = spark.read.parquet(f"{d}/supplier.parquet").where("s_acctbal > 0").select(F.col("s_suppkey").cast("bigint").alias("id"), F.lit(0.0).alias("lng"), F.lit(0.0).alias("lat"))
    return extract.walk_segments(_ways(spark, d), known).select("way_id", "pos", "a", "b", "steps")


@query(sql("SELECT node_id FROM geo_nodes WHERE node_id IN (SELECT ref FROM geo_way_refs)", "geo_nodes", "geo_way_refs"))
def semi_needed_nodes(spark, d):
    return extract.needed_nodes(fx.geo_nodes(spark, d).withColumnRenamed("node_id", "id"), _ways(spark, d)).select(F.col("id").alias("node_id"))


@query("SELECT DISTINCT CAST(l_orderkey AS BIGINT) AS way_id FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'F')")
def anti_member_ways(spark, d):
    members = spark.read.parquet(f"{d}/orders.parquet").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("bigint").alias("id"))
    return _ways(spark, d).join(members, "id", "left_anti").select(F.col("id").alias("way_id"))


def _weighed(spark, d) -> DataFrame:
    return graph.weigh(fx.geo_segments(spark, d), fx.geo_nodes(spark, d))


@query(sql("SELECT a, b, t_ab, t_ba, CAST(round(d * 1000) AS BIGINT) AS d_mm FROM weighed", "weighed"))
def seg_weights(spark, d):
    return _weighed(spark, d).select("a", "b", "t_ab", "t_ba", F.round(F.col("d") * 1000).cast("bigint").alias("d_mm"))


@query(sql("SELECT src, dst, w FROM arcs", "arcs"))
def reversed_arcs(spark, d):
    return graph.reversed_arcs(_weighed(spark, d)).select("src", "dst", F.col("w").cast("bigint").alias("w"))


_REACH = "SELECT node, node FROM (SELECT a AS node FROM geo_sparse UNION SELECT b FROM geo_sparse) UNION SELECT e.b, min(t.component) FROM component t JOIN (SELECT a, b FROM geo_sparse UNION ALL SELECT b, a FROM geo_sparse) e ON e.a = t.node JOIN recurring.component o ON o.node = e.b WHERE t.component < o.component GROUP BY e.b"
_COMPONENT = {"component(node, component) USING KEY (node)": _REACH}


@query(sql("SELECT node, component FROM component", "geo_sparse", **_COMPONENT))
def components_min_label(spark, d):
    return components.connected_components(fx.geo_segments(spark, d, sparse=True))


@query(sql("SELECT a, b FROM geo_sparse WHERE a IN (SELECT node FROM component WHERE component IN (SELECT component FROM component GROUP BY component HAVING count(*) >= 30))", "geo_sparse", **_COMPONENT))
def prune_components(spark, d):
    return graph.prune(fx.geo_segments(spark, d, sparse=True)).select("a", "b")


@query(sql("SELECT component, count(*) AS size FROM component GROUP BY component", "geo_sparse", **_COMPONENT))
def component_sizes(spark, d):
    return graph.component_sizes(fx.geo_segments(spark, d, sparse=True)).select("component", "size").distinct()


@query(sql("SELECT node_id, count(*) AS degree FROM (SELECT a AS node_id FROM geo_segments UNION ALL SELECT b FROM geo_segments) GROUP BY node_id", "geo_segments"))
def degrees(spark, d):
    s = fx.geo_segments(spark, d)
    return s.select(F.explode(F.array("a", "b")).alias("node_id")).groupBy("node_id").agg(F.count(F.lit(1)).alias("degree"))


# ---- shortest paths ----


def _seeds(spark, d) -> DataFrame:
    return graph.first_seeds(fx.geo_sites(spark, d).withColumnRenamed("site_id", "pid"))


def _labels(spark, d, method: str = "kernel") -> DataFrame:
    return graph.shortest_paths(graph.reversed_arcs(_weighed(spark, d)), _seeds(spark, d), method)


def _thin_labels(spark, d) -> DataFrame:
    """Labels of the thin graph, for rasters: nodes out of reach and labels in pieces. Used more than once in a plan, so staged."""
    arcs = graph.reversed_arcs(graph.weigh(fx.geo_segments(spark, d, sparse=True), fx.geo_nodes(spark, d)))
    return write_stage(graph.shortest_paths(arcs, _seeds(spark, d), "kernel"), "labels")


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, node_id, d AS dist_ds FROM dist", "dist"))
def sssp_dist(spark, d):
    return _labels(spark, d).select("type_id", "node_id", "dist_ds")


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, node_id, next_hop FROM hops", "hops"))
def sssp_next_hop(spark, d):
    return _labels(spark, d).where("next_hop is not null").select("type_id", "node_id", "next_hop")


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, node_id, pid FROM labels", "labels"))
def sssp_label(spark, d):
    return _labels(spark, d).select("type_id", "node_id", "pid")


@query(sql("SELECT CAST(s.type_id AS VARCHAR) AS type_id, s.pid, CAST(coalesce(max(dist.d // 10), 0) AS INT) AS t_max FROM seeds s LEFT JOIN labels l ON l.type_id = s.type_id AND l.pid = s.pid LEFT JOIN dist ON dist.type_id = l.type_id AND dist.node_id = l.node_id GROUP BY s.type_id, s.pid", "labels", "dist"))
def t_max_by_site(spark, d):
    return graph.longest_times(_labels(spark, d), _seeds(spark, d))


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, node_id, pid FROM seeds", "seeds"))
def seeds_first_pid(spark, d):
    return _seeds(spark, d).select(F.col("type_id").cast("string").alias("type_id"), "node_id", "pid")


# ---- sites ----


@query(sql("SELECT type_id, a, b FROM pairs", "geo_pois", **{k: _SITES[k] for k in ("features", "pairs")}))
def similar_pairs(spark, d):
    return sites.similar_pairs(_features(spark, d))


@query(sql("SELECT type_id, pid, name, CAST(round(lng * 1e9) AS BIGINT) AS lng_e9, CAST(round(lat * 1e9) AS BIGINT) AS lat_e9, k FROM sites", "geo_pois", **_SITES))
def site_groups(spark, d):
    s = sites.group_sites(_features(spark, d))
    return s.select("type_id", F.col("pid").cast("bigint").alias("pid"), "name", F.round(F.col("lng") * 1e9).cast("bigint").alias("lng_e9"), F.round(F.col("lat") * 1e9).cast("bigint").alias("lat_e9"), F.col("k").cast("bigint").alias("k"))


_SPACING = f"""SELECT type_id, dist FROM (SELECT type_id, dist, row_number() OVER (PARTITION BY type_id ORDER BY dist) AS r, count(*) OVER (PARTITION BY type_id) AS n FROM
    (SELECT a.type_id, a.pid, min(sqrt(pow((a.lng - b.lng) * CAST('{walk.KX * __import__("math").cos(__import__("math").radians(fx.MID_LAT))!r}' AS DOUBLE), 2) + pow((a.lat - b.lat) * 110574.0, 2))) AS dist FROM sites a JOIN sites b ON a.type_id = b.type_id AND a.pid <> b.pid GROUP BY a.type_id, a.pid)) WHERE r = n // 2 + 1"""


@query(sql("SELECT type_id, CAST(round(dist * 1000) AS BIGINT) AS spacing_mm FROM spacing", "geo_pois", **_SITES, spacing=_SPACING))
def nn_median(spark, d):
    s = sites.group_sites(_features(spark, d))
    near = knn.nearest_other(s, "pid", "type_id", fx.MID_LAT)
    return sites.upper_median("dist_m", ["type_id"], near, "m").select("type_id", F.round(F.col("m") * 1000).cast("bigint").alias("spacing_mm"))


@query(
    sql(
        "SELECT f.type_id, f.n AS n_features, s.n AS n_sites, CAST(round(dist * 1000) AS BIGINT) AS spacing_mm, CASE WHEN s.n < 6 THEN 'too few - skip' WHEN s.n < 15 THEN 'marginal' ELSE 'good' END AS verdict FROM (SELECT type_id, count(*) AS n FROM features GROUP BY type_id) f JOIN (SELECT type_id, count(*) AS n FROM sites GROUP BY type_id) s USING (type_id) LEFT JOIN spacing USING (type_id)",
        "geo_pois", **_SITES, spacing=_SPACING,
    )
)
def verdict(spark, d):
    return sites.analyze(_features(spark, d), fx.MID_LAT).select("type_id", "n_features", "n_sites", F.round(F.col("spacing_m") * 1000).cast("bigint").alias("spacing_mm"), "verdict")


# ---- rasters ----

_D2 = "pow(b.clng * kx - n.lng * kx, 2) + pow(b.clat * 110574.0 - n.lat * 110574.0, 2)"


@query(sql(f"SELECT building_id, arg_min(node_id, ({_D2}, node_id)) AS node_id, CAST(round(min(sqrt({_D2})) * 1000) AS BIGINT) AS dist_mm FROM geo_buildings b, grid, geo_nodes n WHERE abs(b.clat - n.lat) < 0.003 AND {_D2} <= 90000.0 GROUP BY building_id", "geo_buildings", "grid"))
def snap_radius(spark, d):
    b = fx.geo_buildings(spark, d).select("building_id", F.col("clng").alias("lng"), F.col("clat").alias("lat"))
    near = knn.nearest_within(b, fx.geo_nodes(spark, d), 300.0, _grid(spark, d).mid_lat, "building_id", steps=raster.STEPS_M)
    return near.select("building_id", "node_id", F.round(F.col("dist_m") * 1000).cast("bigint").alias("dist_mm"))


def _grid(spark, d) -> raster.Grid:
    """The grid over all nodes, as run_city has it."""
    return raster.Grid.over(raster.extent(fx.geo_nodes(spark, d)), CELL_M)


def _cells(spark, d) -> DataFrame:
    return write_stage(raster.build_grid(_grid(spark, d), fx.geo_nodes(spark, d)), "grid")


@query(sql("SELECT cell, y, x, node_id FROM cells", "cells"))
def grid_nearest(spark, d):
    return _cells(spark, d).where("node_id is not null")


@query(sql("SELECT (SELECT count(*) FROM cell) AS n_cells, (SELECT count(*) FROM cells) AS n_near", "cell", "cells"))
def coverage(spark, d):
    return _cells(spark, d).agg(F.count(F.lit(1)).alias("n_cells"), F.count("node_id").alias("n_near"))


def _labelled(spark, d) -> DataFrame:
    return write_stage(raster.label_cells(_cells(spark, d), _thin_labels(spark, d)), "cells")


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, pid, count(*) AS n_cells FROM labelled GROUP BY type_id, pid", "labelled"))
def cell_label_area(spark, d):
    return _labelled(spark, d).groupBy("type_id", "pid").agg(F.count(F.lit(1)).alias("n_cells"))


_SIDES = "(VALUES (0, -1, 0, 0, 1, 0), (1, 0, 1, 0, 1, 1), (0, 1, 1, 1, 0, 1), (-1, 0, 0, 1, 0, 0)) s(dx, dy, ax, ay, bx, by_)"
_EDGES = f"SELECT c.type_id, c.x + ax AS x0, c.y + ay AS y0, c.x + bx AS x1, c.y + by_ AS y1, c.pid, o.pid AS other FROM labelled c CROSS JOIN {_SIDES} LEFT JOIN labelled o ON o.type_id = c.type_id AND o.x = c.x + dx AND o.y = c.y + dy WHERE o.pid IS NULL OR o.pid <> c.pid"


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, x0, y0, x1, y1, pid, other FROM edges", "labelled", edges=_EDGES))
def boundary_edges(spark, d):
    return raster.boundary_edges(_labelled(spark, d))


@query(sql("SELECT DISTINCT CAST(type_id AS VARCHAR) AS type_id, least(pid, other) AS a, greatest(pid, other) AS b FROM edges WHERE other IS NOT NULL", "labelled", edges=_EDGES))
def adjacency(spark, d):
    return raster.adjacency(raster.boundary_edges(_labelled(spark, d)))


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, pid, other, count(*) AS contacts FROM edges GROUP BY type_id, pid, other", "labelled", edges=_EDGES))
def border_contacts(spark, d):
    return raster.boundary_edges(_labelled(spark, d)).groupBy("type_id", "pid", "other").agg(F.count(F.lit(1)).alias("contacts"))


_ISLAND = {
    "beside": "SELECT a.type_id, a.cell, b.cell AS other FROM labelled a CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) s(dx, dy) JOIN labelled b ON b.type_id = a.type_id AND b.pid = a.pid AND b.x = a.x + dx AND b.y = a.y + dy",
    "island(type_id, cell, island) USING KEY (type_id, cell)": """SELECT type_id, cell, cell FROM labelled UNION SELECT l.type_id, l.other, min(t.island) FROM island t JOIN beside l ON l.type_id = t.type_id AND l.cell = t.cell
        JOIN recurring.island o ON o.type_id = l.type_id AND o.cell = l.other WHERE t.island < o.island GROUP BY l.type_id, l.other""",
}


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, island, count(*) AS n_cells FROM island GROUP BY type_id, island", "labelled", **_ISLAND))
def island_sizes(spark, d):
    cells = _labelled(spark, d)
    a = cells.select("type_id", "pid", "cell", "x", "y")
    right = a.select("type_id", "pid", F.col("cell").alias("to"), (F.col("x") - 1).alias("x"), "y")
    below = a.select("type_id", "pid", F.col("cell").alias("to"), "x", (F.col("y") - 1).alias("y"))
    same = a.select("type_id", "pid", F.col("cell").alias("to"), "x", "y")
    links = a.join(right.unionByName(below).unionByName(same), ["type_id", "pid", "x", "y"]).select(F.struct("type_id", "cell").alias("a"), F.struct("type_id", F.col("to").alias("cell")).alias("b"))
    found = components.connected_components(links)
    return found.groupBy(F.col("component.type_id").alias("type_id"), F.col("component.cell").alias("island")).agg(F.count(F.lit(1)).alias("n_cells"))


_HOMES = {
    "met": f"SELECT building_id, arg_min(node_id, ({_D2}, node_id)) AS node_id, min(sqrt({_D2})) AS dist FROM geo_buildings b, grid, geo_nodes n WHERE abs(b.clat - n.lat) < 0.003 AND {_D2} <= 90000.0 GROUP BY building_id",
    "timed": "SELECT l.type_id, m.building_id, l.pid, CAST(dist_thin.d // 10 + trunc(m.dist / 1.39) AS INT) AS t FROM met m JOIN labels_thin l USING (node_id) JOIN dist_thin ON dist_thin.type_id = l.type_id AND dist_thin.node_id = l.node_id",
    "fallback": """SELECT l.type_id, b.building_id, l.pid, CAST(NULL AS INT) AS t FROM geo_buildings b, grid JOIN cells c ON c.x = floor((b.clng - west) / dlng) AND c.y = floor((north - b.clat) / dlat) JOIN labels_thin l ON l.node_id = c.node_id
        WHERE NOT EXISTS (SELECT 1 FROM timed t WHERE t.type_id = l.type_id AND t.building_id = b.building_id)""",
}


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, building_id, pid, t FROM timed UNION ALL SELECT CAST(type_id AS VARCHAR), building_id, pid, t FROM fallback", "geo_buildings", "grid", "cells", "labels_thin", "dist_thin", **_HOMES))
def building_time(spark, d):
    """Buildings near a node that is out of reach have the label of their cell's node, and no time."""
    b = fx.geo_buildings(spark, d).select("building_id", F.col("clng").alias("lng"), F.col("clat").alias("lat"))
    return raster.building_labels(b, _grid(spark, d), _cells(spark, d), _thin_labels(spark, d), fx.geo_nodes(spark, d))


def _points(spark, d) -> DataFrame:
    return fx.geo_nodes(spark, d).select("node_id", (F.col("lng") * 8).alias("lng"), F.col("lat"))


@query(
    sql(
        """SELECT node_id, CAST(round((((a00 * (1 - ax) + a01 * ax) * (1 - ay)) + ((a10 * (1 - ax) + a11 * ax) * ay)) * 100) AS BIGINT) AS elev_cm FROM (SELECT node_id, CAST(fx - floor(fx) AS FLOAT) AS ax, CAST(fy - floor(fy) AS FLOAT) AS ay, """
        + ", ".join(f"(SELECT CASE WHEN v < -1000 THEN 0 ELSE v END FROM geo_dem g WHERE g.row = least(CAST(floor(fy) AS INT) + {r}, 39) AND g.col = least(CAST(floor(fx) AS INT) + {c}, 39)) AS a{r}{c}" for r in (0, 1) for c in (0, 1))
        + " FROM (SELECT node_id, greatest(0.0, least((lng * 8 + 1) * 40 - 0.5, 39.0)) AS fx, greatest(0.0, least((1 - (lat - 51)) * 40 - 0.5, 39.0)) AS fy FROM geo_nodes WHERE floor(lng * 8) = -1 AND floor(lat) = 51)) UNION ALL SELECT node_id, 0 FROM geo_nodes WHERE NOT (floor(lng * 8) = -1 AND floor(lat) = 51)",
        "geo_nodes", "geo_dem",
    )
)
def bilinear_elev(spark, d):
    e = raster.sample_elevation(_points(spark, d), fx.geo_dem(spark), "node_id")
    # in single precision, as the SQL: a half is rounded as it is there
    return e.select("node_id", F.round(F.col("elev") * F.lit(100).cast("float")).cast("bigint").alias("elev_cm"))


@query()
def dir_paint(spark, d):
    return raster.direction_cells(_grid(spark, d), _cells(spark, d), write_stage(_labels(spark, d), "labels"), fx.geo_nodes(spark, d))


@query()
def absorbed_cells(spark, d):
    return raster.absorb(raster.label_cells(_cells(spark, d), _labels(spark, d)), _grid(spark, d), 6)


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, pid, count(*) AS n_cells FROM labelled GROUP BY type_id, pid", "labelled"))
def polygon_area(spark, d):
    """Cells within the unsmoothed rings of each label: shells less holes."""
    grid = _grid(spark, d)
    rings = F.flatten("polygons")
    area = F.aggregate(F.transform(rings, geometry.doubled_area), F.lit(0.0), lambda acc, a: acc + a)
    cells = F.round(F.abs(area) / (2 * grid.dlng * grid.dlat)).cast("bigint")
    return polygons.catchments(_labelled(spark, d), grid, smooth=False).select("type_id", "pid", cells.alias("n_cells"))


# ---- polygons and tiles ----

_CORNERS = "(VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1)) s(i, sx, sy)"
_RING = f"SELECT building_id, i, clng + sx * half AS x, clat + sy * half AS y FROM geo_buildings CROSS JOIN {_CORNERS}"
_SHOELACE = "SELECT p.building_id, sum(p.x * q.y - q.x * p.y) AS a2 FROM ring p JOIN ring q ON q.building_id = p.building_id AND q.i = (p.i + 1) % 4 GROUP BY p.building_id"


def _ring(spark, d) -> DataFrame:
    return fx.geo_buildings(spark, d).withColumn("ring", fx.square(F.col("clng"), F.col("clat"), F.col("half")))


@query(sql("SELECT building_id, CAST(round(a2 / 2 * 1e10) AS BIGINT) AS area_e10 FROM shoelace", "geo_buildings", ring=_RING, shoelace=_SHOELACE))
def shoelace_area(spark, d):
    return _ring(spark, d).select("building_id", F.round(geometry.doubled_area(F.col("ring")) / 2 * 1e10).cast("bigint").alias("area_e10"))


@query(sql("SELECT building_id, CAST(round(clng * 1e7) AS BIGINT) AS x_e7, CAST(round(clat * 1e7) AS BIGINT) AS y_e7 FROM geo_buildings", "geo_buildings"))
def ring_centroid(spark, d):
    c = geometry.centroid(F.col("ring"))
    return _ring(spark, d).select("building_id", F.round(c["x"] * 1e7).cast("bigint").alias("x_e7"), F.round(c["y"] * 1e7).cast("bigint").alias("y_e7"))


@query(sql("SELECT b.building_id, n.node_id FROM geo_buildings b JOIN geo_nodes n ON n.lng >= b.clng - half AND n.lng < b.clng + half AND n.lat >= b.clat - half AND n.lat < b.clat + half", "geo_buildings", "geo_nodes"))
def point_in_ring(spark, d):
    """Nodes meet the rings whose box touches their bucket."""
    size = 0.001  # degrees
    n = fx.geo_nodes(spark, d).select("node_id", "lng", "lat", F.floor(F.col("lng") / size).alias("bx"), F.floor(F.col("lat") / size).alias("by"))

    def buckets(c: str):
        v = F.transform("ring", lambda p: p[c])
        return F.explode(F.sequence(F.floor(F.array_min(v) / size), F.floor(F.array_max(v) / size)))

    met = _ring(spark, d).select("building_id", "ring", buckets("x").alias("bx")).withColumn("by", buckets("y")).join(n, ["bx", "by"])
    return met.where(geometry.point_in_ring(F.col("lng"), F.col("lat"), F.col("ring"))).select("building_id", "node_id")


_MERC = "lng / 360 + 0.5 AS ux, 0.5 - ln((1 + least(0.9999, greatest(-0.9999, sin(radians(lat))))) / (1 - least(0.9999, greatest(-0.9999, sin(radians(lat)))))) / (4 * pi()) AS uy"


@query(sql(f"SELECT node_id, CAST(floor(ux * 16384) AS INT) AS tx, CAST(floor(uy * 16384) AS INT) AS ty FROM (SELECT node_id, {_MERC} FROM geo_nodes)", "geo_nodes"))
def mercator_tiles(spark, d):
    x, y = geometry.mercator(F.col("lng"), F.col("lat"))
    return fx.geo_nodes(spark, d).select("node_id", geometry.tile_of(x, 14).alias("tx"), geometry.tile_of(y, 14).alias("ty"))


@query(
    sql(
        "SELECT tx, ty, building_id FROM (SELECT *, coalesce(sum(cost) OVER (PARTITION BY tx, ty ORDER BY half DESC, building_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM (SELECT building_id, half, 40 + building_id % 30 AS cost, CAST(floor((clng / 360 + 0.5) * 16384) AS INT) AS tx, CAST(floor(clat * 100) AS INT) AS ty FROM geo_buildings)) WHERE used <= 5000",
        "geo_buildings",
    )
)
def tile_budget(spark, d):
    b = fx.geo_buildings(spark, d).select("building_id", "half", (40 + F.col("building_id") % 30).alias("cost"), F.floor((F.col("clng") / 360 + 0.5) * 16384).cast("int").alias("tx"), F.floor(F.col("clat") * 100).cast("int").alias("ty"))
    return tiles.within_budget(b, ["tx", "ty"], F.col("cost"), [F.col("half").desc(), F.col("building_id")], 5000).select("tx", "ty", "building_id")


_XY = [f"CAST((node_id * {m} + {a}) % 64 AS INT)" for m, a in ((7, 3), (11, 5))]
_HILBERT = """h(node_id, z, x, y, d)"""
_HILBERT_SQL = f"""SELECT node_id, 5, {_XY[0]}, {_XY[1]}, CAST(0 AS BIGINT) FROM geo_nodes UNION ALL
    SELECT node_id, z - 1, CASE WHEN ry = 1 THEN lx WHEN rx = 1 THEN side - 1 - ly ELSE ly END, CASE WHEN ry = 1 THEN ly WHEN rx = 1 THEN side - 1 - lx ELSE lx END, d + side * side * xor(3 * rx, ry)
    FROM (SELECT *, CAST(1 << z AS INT) AS side, (x >> z) & 1 AS rx, (y >> z) & 1 AS ry, x & ((1 << z) - 1) AS lx, y & ((1 << z) - 1) AS ly FROM h WHERE z >= 0)"""


@query(sql("SELECT node_id, 1365 + d AS tile_id FROM h WHERE z = -1", "geo_nodes", **{_HILBERT: _HILBERT_SQL}))
def tile_id_hilbert(spark, d):
    k = F.col("node_id")
    return fx.geo_nodes(spark, d).select("node_id", geometry.hilbert_tile_id(6, (k * 7 + 3) % 64, (k * 11 + 5) % 64).alias("tile_id"))


_ARCHIVES = """SELECT gy, id, offset_, CASE WHEN delta = 0 THEN 0 ELSE offset_ + 1 END AS stored, id - coalesce(lag(id) OVER w, 0) AS step FROM (SELECT gy, id, offset_, offset_ - coalesce(lag(offset_ + n) OVER w, -1) AS delta
    FROM (SELECT gy, node_id AS id, gx + 1 AS n, CAST(coalesce(sum(gx + 1) OVER (PARTITION BY gy ORDER BY node_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_ FROM geo_nodes) WINDOW w AS (PARTITION BY gy ORDER BY id)) WINDOW w AS (PARTITION BY gy ORDER BY id)"""


@query(sql(_ARCHIVES, "geo_nodes"))
def directory_deltas(spark, d):
    """The entries of each row of the lattice as an archive of its own."""
    from pyspark.sql import Window as W

    w = W.partitionBy("gy").orderBy("id")
    t = fx.geo_nodes(spark, d).select("gy", F.col("node_id").alias("id"), (F.col("gx") + 1).cast("bigint").alias("n"))
    t = t.withColumn("offset_", F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    follows = F.coalesce(F.lag(F.col("offset_") + F.col("n")).over(w), F.lit(-1)) == F.col("offset_")
    return t.select("gy", "id", "offset_", F.when(follows, 0).otherwise(F.col("offset_") + 1).alias("stored"), (F.col("id") - F.coalesce(F.lag("id").over(w), F.lit(0))).alias("step"))


@query()
def archive_directories(spark, d):
    """The directory of each row of the lattice as one archive."""

    def run(pdf):
        pdf, at, places = pdf.sort_values("id"), 0, []
        for i, n in zip(pdf.id.tolist(), pdf.n.tolist()):
            places.append((i, at, n))
            at += n
        return pdf[["gy"]].head(1).assign(n_tiles=len(places), directory=tiles.archive_directory(places))

    t = fx.geo_nodes(spark, d).select("gy", F.col("node_id").alias("id"), (F.col("gx") + 1).cast("bigint").alias("n"))
    return t.groupBy("gy").applyInPandas(run, "gy int, n_tiles long, directory binary")


@query()
def polygons_smoothed(spark, d):
    shapes = polygons.catchments(_labelled(spark, d), _grid(spark, d))
    return shapes.select("type_id", "pid", "color", F.size("polygons").alias("n_polygons"), F.to_json("polygons").alias("rings"))


@query()
def mvt_tiles(spark, d):
    b = _ring(spark, d).select("building_id", F.array("ring").alias("rings"), F.col("clng").alias("lng"), F.col("clat").alias("lat"))
    labels = raster.building_labels(b.select("building_id", "lng", "lat"), _grid(spark, d), _cells(spark, d), _thin_labels(spark, d), fx.geo_nodes(spark, d))
    labels = labels.withColumn("c", colour.building_colour(colour.class_colour(F.col("pid")), F.col("t")))
    shapes = write_stage(tiles.tile_geometries(b.select("building_id", "rings")), "geometries")
    found = tiles.building_tiles(shapes, write_stage(labels, "building-labels"))
    return found.select("type_id", "z", "x", "y", F.length("data").alias("n_bytes"), F.sha2("data", 256).alias("sha256"))


# ---- colours and lookups ----


def _hsl_sql(base: str, t: str) -> str:
    """The colour of a building, by arithmetic on the three channels of base."""
    r, g, b = (f"(CAST('0x' || substr({base}, {i}, 2) AS INT) / 255.0::DOUBLE)" for i in (2, 4, 6))
    return f"""SELECT building_id, {t} AS t, h, CASE WHEN t IS NULL THEN s * 0.25 ELSE s * (1 - 0.25 * least(t, 1800) / 1800.0::DOUBLE) END AS s, CASE WHEN t IS NULL THEN 0.60 ELSE greatest(0.15, least(0.85, l + 0.16 - 0.42 * least(t, 1800) / 1800.0::DOUBLE)) END AS l
        FROM (SELECT *, (mx + mn) / 2 AS l, CASE WHEN mx = mn THEN 0 ELSE (mx - mn) / (1 - abs(mx + mn - 1)) END AS s, CASE WHEN mx = mn THEN 0 WHEN mx = r THEN ((g - b) / (mx - mn) + 6) % 6 WHEN mx = g THEN (b - r) / (mx - mn) + 2 ELSE (r - g) / (mx - mn) + 4 END AS h
        FROM (SELECT *, greatest(r, g, b) AS mx, least(r, g, b) AS mn FROM (SELECT *, {r} AS r, {g} AS g, {b} AS b FROM base)))"""


_PALETTE = "CASE building_id % 6 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(colour.PALETTE)) + " END"
_CHANNEL = "lpad(lower(to_hex(CAST(round(255 * (l - (1 - abs(2 * l - 1)) * s / 2 * greatest(-1.0, least((({n} + h * 2) % 12) - 3, 9 - (({n} + h * 2) % 12), 1.0)))) AS BIGINT))), 2, '0')"


@query(
    sql(
        f"SELECT building_id, '#' || {_CHANNEL.format(n=0)} || {_CHANNEL.format(n=8)} || {_CHANNEL.format(n=4)} AS c FROM shade",
        "geo_buildings", base=f"SELECT building_id, CASE WHEN building_id % 7 <> 0 THEN CAST(building_id * 13 % 2500 AS INT) END AS t, {_PALETTE} AS colour FROM geo_buildings", shade=_hsl_sql("colour", "t"),
    )
)
def building_colour(spark, d):
    k = F.col("building_id")
    t = F.when(k % 7 != 0, (k * 13 % 2500).cast("int"))
    return fx.geo_buildings(spark, d).select("building_id", colour.building_colour(colour.class_colour(k), t).alias("c"))


@query(sql("SELECT pid, name FROM sites WHERE type_id = 'grocery' AND contains(lower(name), 'red') ORDER BY pid LIMIT 8", "geo_pois", **_SITES))
def search_sites(spark, d):
    from ambula.lookup import search_sites as search

    return search(sites.group_sites(_features(spark, d)).where("type_id = 'grocery'"), " Red ").select(F.col("pid").cast("bigint").alias("pid"), "name")


@query(sql("SELECT osm_id, coalesce(name, 'Shop #' || osm_id) || ': ' || CASE WHEN osm_id % 5 = 0 THEN 'walking time unknown' WHEN osm_id * 7 % 2000 < 60 THEN 'under a minute''s walk' ELSE CAST(round((osm_id * 7 % 2000) / 60.0) AS INT) || ' min walk' END AS popup FROM geo_pois", "geo_pois"))
def popup_text(spark, d):
    from ambula.lookup import popup_text as popup

    k = F.col("osm_id")
    return fx.geo_pois(spark, d).select("osm_id", popup(F.col("name"), F.lit("Shop"), k, F.when(k % 5 != 0, k * 7 % 2000)).alias("popup"))


@query(sql("SELECT osm_id, trim(regexp_replace(lower(name), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS norm FROM geo_pois", "geo_pois"))
def normalized_names(spark, d):
    return fx.geo_pois(spark, d).select("osm_id", names.normalize(F.col("name")).alias("norm"))


@query("SELECT CAST(n_nationkey AS INT) AS city, n_name AS name FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier) ORDER BY n_name")
def manifest_join(spark, d):
    have = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_nationkey").alias("n_nationkey"))
    return spark.read.parquet(f"{d}/nation.parquet").join(have, "n_nationkey", "left_semi").select(F.col("n_nationkey").cast("int").alias("city"), F.col("n_name").alias("name"))


@query(sql("SELECT CAST(type_id AS VARCHAR) AS type_id, node_id, pid, CAST(d AS BIGINT) AS dist_ds, next_hop FROM dist JOIN labels USING (type_id, node_id) LEFT JOIN hops USING (type_id, node_id)", "dist", "labels", "hops"))
def sssp_by_rounds(spark, d):
    return _labels(spark, d, "rounds").select("type_id", "node_id", "pid", F.col("dist_ds").cast("bigint").alias("dist_ds"), "next_hop")
