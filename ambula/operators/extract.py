"""From map elements to segments, buildings and features.

Elements: nodes(id, lng, lat, tags), ways(id, refs, tags), relations(id, members array<struct<type,ref,role>>, tags).
All tables are keyed by the elements' own ids.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambula.config import FeatureType
from ambula.functions.geometry import centroid, in_bbox, point_in_ring
from ambula.functions.rules import matching_types
from ambula.functions.walk import is_building, is_flat, is_steps, walkable

Box = tuple[float, float, float, float] | None
POINT = "struct<x:double,y:double>"


def needed_nodes(nodes: DataFrame, ways: DataFrame) -> DataFrame:
    """The nodes that any way refers to."""
    return nodes.join(ways.select(F.explode("refs").alias("id")).distinct(), "id", "left_semi")


def walk_segments(ways: DataFrame, nodes: DataFrame, bbox: Box = None) -> DataFrame:
    """(way_id, pos, a, b, steps, flat): consecutive nodes of walkable ways, both known and in the box, not the same.

    Parallel segments stay: the graph is a multigraph.
    """
    walk = ways.where(walkable(F.col("tags"))).select("id", "refs", is_steps(F.col("tags")).alias("steps"), is_flat(F.col("tags")).alias("flat"))
    n = F.size("refs")
    pairs = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(F.get("refs", i).alias("a"), F.get("refs", i + 1).alias("b")))).otherwise(F.array().cast("array<struct<a:bigint,b:bigint>>"))
    each = walk.select(F.col("id").alias("way_id"), "steps", "flat", F.posexplode(pairs).alias("pos", "pair")).select("way_id", "pos", "pair.a", "pair.b", "steps", "flat").where("a <> b")
    known = nodes.where(in_bbox(F.col("lng"), F.col("lat"), bbox)).select("id")
    return each.join(known.withColumnRenamed("id", "a"), "a", "left_semi").join(known.withColumnRenamed("id", "b"), "b", "left_semi").select("way_id", "pos", "a", "b", "steps", "flat")


def way_points(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """ways with points, those of the known nodes in order, and whole: whether all are known."""
    each = ways.select("id", F.posexplode("refs").alias("pos", "ref"))
    met = each.join(nodes.select(F.col("id").alias("ref"), F.struct(F.col("lng").alias("x"), F.col("lat").alias("y")).alias("p")), "ref")
    points = met.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "p"))), lambda s: s["p"]).alias("points"))
    return ways.join(points, "id").withColumn("whole", F.size("points") == F.size("refs"))


def stitch(chains: list[list[int]]) -> list[list[int]]:
    """Closed rings of at least 4 refs, from ways joined end to end, turned where needed; what does not close is dropped."""
    open_chains, rings = [list(c) for c in chains if len(c) > 1], []
    while open_chains:
        ring = open_chains.pop()
        while ring[0] != ring[-1]:
            for k, other in enumerate(open_chains):
                if ring[-1] in (other[0], other[-1]):
                    step = other if other[0] == ring[-1] else other[::-1]
                    ring += step[1:]
                    del open_chains[k]
                    break
            else:
                ring = []
                break
        if len(ring) >= 4:
            rings.append(ring)
    return rings


def _stitched(pdf: pd.DataFrame) -> pd.DataFrame:
    rings = stitch([list(r) for r in pdf.sort_values("pos").refs])
    return pd.DataFrame({"relation_id": pdf.relation_id.iloc[0], "role": pdf.role.iloc[0], "n": range(len(rings)), "refs": rings})


def buildings(ways: DataFrame, relations: DataFrame, nodes: DataFrame, bbox: Box = None) -> DataFrame:
    """(kind, id, rings, centroid) of closed building ways and of the rings of building relations.

    All nodes must be known, rings have at least 4 points, and the centroid is in the box. Ways that belong to a
    building relation are its parts only. An empty role counts as outer; an inner ring goes to the outer one that its first
    point is in.
    """
    of = relations.where(is_building(F.col("tags"))).select(F.col("id").alias("relation_id"), F.posexplode("members").alias("pos", "m"))
    role = F.when(F.col("m.role").isin("", "outer"), "outer").when(F.col("m.role") == "inner", "inner")
    of = of.where("m.type = 'way'").select("relation_id", "pos", F.col("m.ref").alias("id"), role.alias("role")).where("role is not null")
    alone = ways.where(is_building(F.col("tags"))).join(of.select("id").distinct(), "id", "left_anti")
    single = way_points(alone, nodes).where("whole and size(points) >= 4")
    single = single.select(F.lit("way").alias("kind"), "id", F.array("points").alias("rings"), centroid(F.col("points")).alias("centroid"))
    rings = of.join(ways.select("id", "refs"), "id").groupBy("relation_id", "role").applyInPandas(_stitched, "relation_id long, role string, n int, refs array<long>")
    keyed = rings.withColumn("id", F.struct("relation_id", "role", "n"))
    shaped = way_points(keyed, nodes).where("whole").select("relation_id", "role", "n", "points")
    outer = shaped.where("role = 'outer'").select("relation_id", "n", F.col("points").alias("shell"))
    inner = shaped.where("role = 'inner'").select("relation_id", F.col("points").alias("hole"))
    first = F.get("hole", F.lit(0))
    held = outer.join(inner, "relation_id").where(point_in_ring(first["x"], first["y"], F.col("shell"))).groupBy("relation_id", "n").agg(F.collect_list("hole").alias("holes"))
    many = outer.join(held, ["relation_id", "n"], "left").select(
        F.lit("relation").alias("kind"), F.col("relation_id").alias("id"), F.concat(F.array("shell"), F.coalesce("holes", F.array().cast(f"array<array<{POINT}>>"))).alias("rings"), centroid(F.col("shell")).alias("centroid")
    )
    return single.unionByName(many).where(in_bbox(F.col("centroid.x"), F.col("centroid.y"), bbox))


def features(nodes: DataFrame, ways: DataFrame, types: list[FeatureType], bbox: Box = None) -> DataFrame:
    """(type_id, kind, id, name, lng, lat): a row for each type that a node or way fits.

    Ways stand for the centroid of their known nodes, dropped only if there is none; the boxes are tested there.
    """
    tags = F.col("tags")
    of_nodes = nodes.select(F.lit("node").alias("kind"), "id", "tags", "lng", "lat")
    fitting = ways.where(F.size(matching_types(types, tags)) > 0)
    of_ways = way_points(fitting, nodes).withColumn("c", centroid(F.col("points"))).select(F.lit("way").alias("kind"), "id", "tags", F.col("c.x").alias("lng"), F.col("c.y").alias("lat"))
    every = of_nodes.unionByName(of_ways).where(in_bbox(F.col("lng"), F.col("lat"), bbox))
    return every.select(F.explode(matching_types(types, tags, F.col("lng"), F.col("lat"))).alias("type_id"), "kind", "id", tags["name"].alias("name"), "lng", "lat")
