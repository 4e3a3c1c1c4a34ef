"""Geography derived from the driver's tables by integer formulas, for Spark and, as common table expressions, for DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MID_LAT = 51.52


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(a: Column, n: int) -> Column:
    return F.floor(a / n).cast("bigint")


def geo_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey").cast("bigint")
    lng = F.lit(-0.10) + (k % 40) * F.lit(0.0012) + ((k * 7919) % 101 - 50) * F.lit(1e-6)
    lat = F.lit(51.50) + _div(k, 40) * F.lit(0.0008) + ((k * 104729) % 101 - 50) * F.lit(1e-6)
    return _table(spark, sf_dir, "customer").select(k.alias("node_id"), (k % 40).cast("int").alias("gx"), _div(k, 40).cast("int").alias("gy"), lng.alias("lng"), lat.alias("lat"), (F.col("c_acctbal").cast("double") / 200).alias("elev"))


def geo_segments(spark: SparkSession, sf_dir: str, sparse: bool = False) -> DataFrame:
    """Lattice neighbours to the east and south, less some; sparse keeps about half."""
    nodes = geo_nodes(spark, sf_dir)
    at = nodes.select("gx", "gy", F.col("node_id").alias("b"))
    steps = F.explode(F.array(F.struct(F.lit(1).alias("dx"), F.lit(0).alias("dy")), F.struct(F.lit(0).alias("dx"), F.lit(1).alias("dy"))))
    near = nodes.select(F.col("node_id").alias("a"), "gx", "gy", steps.alias("s")).select("a", (F.col("gx") + F.col("s.dx")).alias("gx"), (F.col("gy") + F.col("s.dy")).alias("gy"))
    a, b = F.col("a"), F.col("b")
    keep = ((7 * a * a + 5 * b * b + a) % 23 > 10) if sparse else ((7 * a + 3 * b) % 11 != 0)
    return near.join(at, ["gx", "gy"]).where(keep).select("a", "b", ((31 * a + b) % 17 == 0).alias("steps"), ((17 * a + b) % 13 == 0).alias("flat"))


def geo_pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey").cast("bigint")
    lng = F.lit(-0.10) + ((7 * k) % 40) * F.lit(0.0012) + ((31 * k) % 61 - 30) * F.lit(1e-5)
    lat = F.lit(51.50) + _div(k, 53) * F.lit(0.0008) + ((17 * k) % 61 - 30) * F.lit(1e-5)
    shop = F.when(F.col("p_size") % 5 == 0, "supermarket").when(F.col("p_size") % 5 == 1, "convenience").when(F.col("p_size") % 5 == 2, "bakery")
    amenity = F.when(F.col("p_size") % 7 == 0, "cafe").when(F.col("p_size") % 7 == 1, "pub")
    return _table(spark, sf_dir, "part").select(k.alias("osm_id"), lng.alias("lng"), lat.alias("lat"), F.when(k % 10 != 9, F.col("p_name")).alias("name"), F.when(k % 3 == 0, F.col("p_brand")).alias("brand"), shop.alias("shop"), amenity.alias("amenity"))


def poi_tags(pois: DataFrame) -> DataFrame:
    """pois with their tags as a map, missing ones left out."""
    keys = ("name", "brand", "shop", "amenity")
    pairs = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).alias("v")) for k in keys]), lambda p: p["v"].isNotNull())
    return pois.withColumn("tags", F.map_from_entries(pairs))


def geo_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("n"))
    k = F.col("s_suppkey").cast("bigint")
    return _table(spark, sf_dir, "supplier").crossJoin(F.broadcast(n)).select(k.alias("site_id"), ((13 * k) % F.col("n")).alias("node_id"), (F.col("s_nationkey") % 5).cast("int").alias("type_id"))  # one row of n


def geo_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = geo_nodes(spark, sf_dir).select(F.col("node_id").alias("o_custkey"), "lng", "lat")
    k = F.col("o_orderkey").cast("bigint")
    orders = _table(spark, sf_dir, "orders").join(nodes, "o_custkey")
    return orders.select(k.alias("building_id"), (F.col("lng") + ((13 * k) % 81 - 40) * F.lit(1e-5)).alias("clng"), (F.col("lat") + ((29 * k) % 81 - 40) * F.lit(1e-5)).alias("clat"), (F.lit(0.00005) * (1 + k % 5)).alias("half"))


def square(lng: Column, lat: Column, half: Column) -> Column:
    return F.array(*[F.struct((lng + sx * half).alias("x"), (lat + sy * half).alias("y")) for sx, sy in ((-1, -1), (1, -1), (1, 1), (-1, 1))])


def geo_way_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(way_id, pos, ref, highway, sidewalk)."""
    pos = F.row_number().over(W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) - 1
    highway = F.when(F.col("l_returnflag") == "A", "footway").when(F.col("l_returnflag") == "N", "trunk").otherwise("steps")
    return _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("bigint").alias("way_id"), pos.cast("int").alias("pos"), F.col("l_suppkey").cast("bigint").alias("ref"), highway.alias("highway"), F.when(F.col("l_linestatus") == "F", "yes").alias("sidewalk"))


def geo_dem(spark: SparkSession) -> DataFrame:
    """One tile of 40 by 40 heights west of Greenwich; every 97th is void."""
    i = F.col("id")
    v = F.when(i % 97 == 0, -9999.0).otherwise((i * 37) % 101 + 0.5).cast("float")
    return spark.range(1600).select(F.lit(51).alias("lat0"), F.lit(-1).alias("lng0"), F.lit(40).alias("w"), F.lit(40).alias("h"), (i / 40).cast("int").alias("row"), (i % 40).cast("int").alias("col"), v.alias("v"))


#: The same for DuckDB.
CTE = {
    "geo_nodes": """SELECT k AS node_id, CAST(k % 40 AS INT) AS gx, CAST(k // 40 AS INT) AS gy,
        CAST(-0.10 AS DOUBLE) + (k % 40) * CAST(0.0012 AS DOUBLE) + ((k * 7919) % 101 - 50) * CAST(1e-6 AS DOUBLE) AS lng,
        CAST(51.50 AS DOUBLE) + (k // 40) * CAST(0.0008 AS DOUBLE) + ((k * 104729) % 101 - 50) * CAST(1e-6 AS DOUBLE) AS lat,
        CAST(c_acctbal AS DOUBLE) / 200 AS elev FROM (SELECT CAST(c_custkey AS BIGINT) AS k, c_acctbal FROM customer)""",
    "near_nodes": """SELECT a.node_id AS a, b.node_id AS b FROM geo_nodes a JOIN geo_nodes b ON (b.gx = a.gx + 1 AND b.gy = a.gy) OR (b.gx = a.gx AND b.gy = a.gy + 1)""",
    "geo_segments": "SELECT a, b, (31 * a + b) % 17 = 0 AS steps, (17 * a + b) % 13 = 0 AS flat FROM near_nodes WHERE (7 * a + 3 * b) % 11 <> 0",
    "geo_sparse": "SELECT a, b FROM near_nodes WHERE (7 * a * a + 5 * b * b + a) % 23 > 10",
    "geo_pois": """SELECT k AS osm_id, CAST(-0.10 AS DOUBLE) + ((7 * k) % 40) * CAST(0.0012 AS DOUBLE) + ((31 * k) % 61 - 30) * CAST(1e-5 AS DOUBLE) AS lng,
        CAST(51.50 AS DOUBLE) + (k // 53) * CAST(0.0008 AS DOUBLE) + ((17 * k) % 61 - 30) * CAST(1e-5 AS DOUBLE) AS lat,
        CASE WHEN k % 10 <> 9 THEN p_name END AS name, CASE WHEN k % 3 = 0 THEN p_brand END AS brand,
        CASE p_size % 5 WHEN 0 THEN 'supermarket' WHEN 1 THEN 'convenience' WHEN 2 THEN 'bakery' END AS shop,
        CASE p_size % 7 WHEN 0 THEN 'cafe' WHEN 1 THEN 'pub' END AS amenity FROM (SELECT CAST(p_partkey AS BIGINT) AS k, * FROM part)""",
    "geo_sites": "SELECT CAST(s_suppkey AS BIGINT) AS site_id, (13 * CAST(s_suppkey AS BIGINT)) % (SELECT count(*) FROM customer) AS node_id, CAST(s_nationkey % 5 AS INT) AS type_id FROM supplier",
    "geo_buildings": """SELECT k AS building_id, lng + ((13 * k) % 81 - 40) * CAST(1e-5 AS DOUBLE) AS clng, lat + ((29 * k) % 81 - 40) * CAST(1e-5 AS DOUBLE) AS clat,
        CAST(0.00005 AS DOUBLE) * (1 + k % 5) AS half FROM (SELECT CAST(o_orderkey AS BIGINT) AS k, o_custkey FROM orders) JOIN geo_nodes ON node_id = o_custkey""",
    "geo_way_refs": """SELECT CAST(l_orderkey AS BIGINT) AS way_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INT) AS pos,
        CAST(l_suppkey AS BIGINT) AS ref, CASE l_returnflag WHEN 'A' THEN 'footway' WHEN 'N' THEN 'trunk' ELSE 'steps' END AS highway, CASE WHEN l_linestatus = 'F' THEN 'yes' END AS sidewalk FROM lineitem""",
    "geo_dem": """SELECT CAST(i // 40 AS INT) AS row, CAST(i % 40 AS INT) AS col, CAST(CASE WHEN i % 97 = 0 THEN -9999.0 ELSE (i * 37) % 101 + 0.5 END AS FLOAT) AS v FROM (SELECT unnest(range(1600)) AS i)""",
    "weighed": """SELECT *, CAST(CASE WHEN d <= 0 THEN 1 ELSE greatest(1, round(10 * d / CASE WHEN steps THEN CASE WHEN up > 0 THEN 0.45 ELSE 0.6 END ELSE 6 * exp(-3.5 * abs(greatest(-0.35, least(0.35, up / d)) + 0.05)) / 3.6 END)) END AS INT) AS t_ab,
        CAST(CASE WHEN d <= 0 THEN 1 ELSE greatest(1, round(10 * d / CASE WHEN steps THEN CASE WHEN -up > 0 THEN 0.45 ELSE 0.6 END ELSE 6 * exp(-3.5 * abs(greatest(-0.35, least(0.35, -up / d)) + 0.05)) / 3.6 END)) END AS INT) AS t_ba
        FROM (SELECT *, CASE WHEN flat OR d < 3 THEN 0 ELSE dh END AS up FROM (SELECT a, b, steps, flat, q.elev - p.elev AS dh,
            2 * 6371000.0 * asin(least(1.0, sqrt(pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lng - p.lng) / 2), 2)))) AS d
            FROM geo_segments JOIN geo_nodes p ON a = p.node_id JOIN geo_nodes q ON b = q.node_id))""",
    "arcs": "SELECT b AS src, a AS dst, CAST(t_ab AS BIGINT) AS w FROM weighed UNION ALL SELECT a, b, CAST(t_ba AS BIGINT) FROM weighed",
    "seeds": "SELECT type_id, node_id, min(site_id) AS pid FROM geo_sites GROUP BY type_id, node_id",
    "dist": """SELECT type_id, node_id, 0::BIGINT AS d FROM seeds UNION SELECT t.type_id, arcs.dst, min(t.d + arcs.w) FROM dist t JOIN arcs ON arcs.src = t.node_id
        LEFT JOIN recurring.dist r ON r.type_id = t.type_id AND r.node_id = arcs.dst WHERE r.d IS NULL OR t.d + arcs.w < r.d GROUP BY t.type_id, arcs.dst""",
    "hops": "SELECT v.type_id, v.node_id, arg_min(u.node_id, (u.d, u.node_id)) AS next_hop FROM dist v JOIN arcs ON arcs.dst = v.node_id JOIN dist u ON u.node_id = arcs.src AND u.type_id = v.type_id AND u.d + arcs.w = v.d WHERE v.d > 0 GROUP BY v.type_id, v.node_id",
    "labels": """SELECT type_id, node_id, pid FROM seeds UNION ALL SELECT h.type_id, h.node_id, l.pid FROM labels l JOIN hops h ON h.type_id = l.type_id AND h.next_hop = l.node_id""",
    "cell": """SELECT CAST(i AS BIGINT) AS cell, CAST(i // w AS INT) AS y, CAST(i % w AS INT) AS x, west + (i % w + 0.5) * dlng AS lng, north - (i // w + 0.5) * dlat AS lat FROM grid, LATERAL (SELECT unnest(range(w * h)) AS i)""",
    "cells": """SELECT cell.cell, cell.y, cell.x, arg_min(node_id, (pow(cell.lng * kx - n.lng * kx, 2) + pow(cell.lat * 110574.0 - n.lat * 110574.0, 2), node_id)) AS node_id FROM cell, grid, geo_nodes n
        WHERE pow(cell.lng * kx - n.lng * kx, 2) + pow(cell.lat * 110574.0 - n.lat * 110574.0, 2) <= 62500.0 GROUP BY ALL""",
    "labelled": "SELECT type_id, cell, y, x, pid FROM cells JOIN labels USING (node_id)",
}
NEEDS = {
    "near_nodes": ["geo_nodes"], "geo_segments": ["near_nodes"], "geo_sparse": ["near_nodes"], "geo_buildings": ["geo_nodes"], "weighed": ["geo_segments", "geo_nodes"],
    "arcs": ["weighed"], "seeds": ["geo_sites"], "dist": ["arcs", "seeds"], "hops": ["dist", "arcs"], "labels": ["seeds", "hops"], "cell": ["grid"], "cells": ["cell", "geo_nodes", "grid"], "labelled": ["cells", "labels"],
}
#: The raster's graph: about half of the segments, so that nodes are out of reach and labels come in pieces.
CTE["geo_thin"] = "SELECT a, b, (31 * a + b) % 17 = 0 AS steps, (17 * a + b) % 13 = 0 AS flat FROM geo_sparse"
NEEDS["geo_thin"] = ["geo_sparse"]
_THIN = {"geo_segments": "geo_thin", "weighed": "weighed_thin", "arcs": "arcs_thin", "dist": "dist_thin", "hops": "hops_thin", "labels": "labels_thin", "labelled": "labelled"}


def _thin(text: str) -> str:
    return re.sub(r"\b(" + "|".join(_THIN) + r")\b", lambda m: _THIN[m[1]], text)


for _old, _new in _THIN.items():
    if _old != "geo_segments":
        CTE[_new] = _thin(CTE[_old])
        NEEDS[_new] = [_THIN.get(n, n) for n in NEEDS[_old]]
HEADS = {"dist_thin": "dist_thin(type_id, node_id, d) USING KEY (type_id, node_id)", "dist": "dist(type_id, node_id, d) USING KEY (type_id, node_id)"}


def sql(body: str, *names: str, **more: str) -> str:
    """body after the expressions it needs; more: further ones by name, which come last."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    parts = [f"{HEADS.get(n, n)} AS ({CTE[n]})" for n in order if n in CTE] + [f"{n} AS ({s})" for n, s in more.items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body
