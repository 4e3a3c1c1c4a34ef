"""A city's run: elements and heights in, catchments, tiles and indexes out. All types of a run share one plan."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambula import sinks
from ambula.config import City, FeatureType, config_hash
from ambula.functions.colour import building_colour, class_colour
from ambula.operators import extract, graph, polygons, raster, sites, tiles
from ambula.operators.knn import nearest_within
from ambula.stages import write_stage


def survey(nodes: DataFrame, ways: DataFrame, types: list[FeatureType], bbox=None) -> DataFrame:
    """Counts, spacing and a verdict for each type; needs no graph."""
    found = extract.features(nodes, ways, types, bbox).withColumn("id", F.struct("kind", "id"))
    box = bbox or raster.extent(nodes)
    return sites.analyze(found, (box[1] + box[3]) / 2)


def run_city(city: City, types: list[FeatureType], nodes: DataFrame, ways: DataFrame, relations: DataFrame, dem: DataFrame | None, out: Path, skip_tiles: bool = False) -> dict:
    """Writes the files of a city to out/<id> and returns counts for each type."""
    key = config_hash(types)
    folder = out / city.id
    folder.mkdir(parents=True, exist_ok=True)
    found = write_stage(extract.features(nodes, ways, types, city.bbox).withColumn("id", F.struct("kind", "id")), f"features-{key}")
    segments = write_stage(extract.walk_segments(ways, nodes, city.bbox), "segments")
    kept = write_stage(graph.prune(segments.select("a", "b", "steps", "flat")), "pruned")
    ids = kept.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    places = nodes.join(ids, "id", "left_semi").select(F.col("id").alias("node_id"), "lng", "lat")
    heights = raster.sample_elevation(places, dem, "node_id") if dem is not None else places.select("node_id", F.lit(0.0).alias("elev"))
    places = write_stage(places.join(heights, "node_id"), "nodes")
    arcs = write_stage(graph.reversed_arcs(graph.weigh(kept, places)), "arcs")
    grid = raster.Grid.over(city.bbox or raster.extent(places), city.grid_m)
    cells = write_stage(raster.build_grid(grid, places), "grid")
    shapes = extract.buildings(ways, relations, nodes, city.bbox)
    built = write_stage(shapes.select(F.xxhash64("kind", "id").alias("building_id"), "rings", F.col("centroid.x").alias("lng"), F.col("centroid.y").alias("lat")), "buildings")

    grouped = write_stage(sites.group_sites(found), "sites")
    members = grouped.select("type_id", "pid", F.explode("members").alias("m")).select(F.struct("type_id", "m.id").alias("key"), "type_id", "pid", "m.lng", "m.lat")
    snapped = nearest_within(members, places, raster.SITE_RADIUS_M, grid.mid_lat, "key", steps=raster.STEPS_M)
    seeds = write_stage(graph.first_seeds(members.join(snapped, "key").select("type_id", "node_id", "pid")), "seeds")
    labels = write_stage(graph.shortest_paths(arcs, seeds), "labels")
    longest = graph.longest_times(labels, seeds)
    raw = write_stage(raster.label_cells(cells, labels), "cells")
    whole = write_stage(raster.absorb(raw, grid, raster.island_threshold(city.grid_m)), "absorbed")
    shapes = write_stage(polygons.catchments(whole, grid).join(longest, ["type_id", "pid"], "left").join(grouped.select("type_id", "pid", "name"), ["type_id", "pid"], "left"), "catchments")
    dirs = write_stage(raster.direction_cells(grid, cells, labels, places), "dirs")
    homes = raster.building_labels(built.select("building_id", "lng", "lat"), grid, cells, labels, places)
    coloured = homes.join(shapes.select("type_id", "pid", "color"), ["type_id", "pid"], "left").withColumn("c", building_colour(class_colour(F.coalesce("color", F.lit(0))), F.col("t")))
    coloured = write_stage(coloured.select("type_id", "building_id", "pid", "t", "c"), "building-labels")
    stamped = None if skip_tiles else write_stage(tiles.building_tiles(write_stage(tiles.tile_geometries(built.select("building_id", "rings")), "geometries"), coloured), "tiles")

    counts = {}
    for t in types:
        def mine(df: DataFrame, type_id: str = t.id) -> DataFrame:
            return df.where(F.col("type_id") == type_id)

        n = mine(grouped).count()
        counts[t.id] = {"sites": n, "buildings": mine(coloured).count()}
        if not n:
            continue
        sinks.write_sites(folder / f"{t.id}.sites.json", mine(grouped))
        sinks.write_dirs(folder / f"{t.id}.dirs.gz", grid, mine(dirs))
        counts[t.id]["catchments"] = sinks.write_partitions(folder / f"{t.id}.geojsonl", mine(shapes))
        if stamped is not None:
            rows = ((r.z, r.x, r.y, bytes(r.data)) for r in mine(stamped).toLocalIterator())
            counts[t.id]["tiles"] = tiles.write_archive(str(folder / f"{t.id}.pmtiles"), rows, grid.bbox(), {"name": f"{city.id} {t.id}"})
    sinks.write_meta(folder / "meta.json", city, grid)
    sinks.clean(folder, [t.id for t in types])
    return counts
