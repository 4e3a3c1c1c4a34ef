"""Nearest neighbour within a radius, by buckets of the local plane and radii that grow."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambula.functions.geometry import plane
from ambula.stages import write_stage


def _bucketed(df: DataFrame, size: float) -> DataFrame:
    return df.withColumn("bx", F.floor(F.col("px") / size)).withColumn("by", F.floor(F.col("py") / size))


def _around(df: DataFrame, size: float) -> DataFrame:
    """Each row in its bucket and the eight around it."""
    offsets = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    return _bucketed(df, size).withColumn("o", offsets).withColumn("bx", F.col("bx") + F.col("o.i")).withColumn("by", F.col("by") + F.col("o.j")).drop("o")


def nearest_within(points: DataFrame, targets: DataFrame, radius_m: float, mid_lat: float, key: str, target: str = "node_id", steps: Sequence[float] | None = None) -> DataFrame:
    """(key, target, dist_m): for each of points(key, lng, lat) the nearest of targets(target, lng, lat) within the radius, inclusive.

    Ties go to the smaller target; points without a target are left out. Steps are smaller radii to try first: a target that is
    found within one is the nearest, so only the other points go on, and dense places never meet all targets of the full
    radius.
    """
    x, y = plane(F.col("lng"), F.col("lat"), mid_lat)
    left = points.select(F.col(key), x.alias("px"), y.alias("py"))
    right = targets.select(F.col(target), x.alias("px"), y.alias("py"))
    found: DataFrame | None = None
    radii = [*(steps or ()), radius_m]
    for r in radii:
        buckets = _bucketed(right, r).withColumnsRenamed({"px": "tx", "py": "ty"})
        d2 = F.pow(F.col("px") - F.col("tx"), 2) + F.pow(F.col("py") - F.col("ty"), 2)
        near = _around(left, r).join(buckets, ["bx", "by"]).withColumn("d2", d2).where(F.col("d2") <= r * r).groupBy(key).agg(F.min(F.struct("d2", target)).alias("m"))
        near = near.select(key, F.col(f"m.{target}").alias(target), F.sqrt("m.d2").alias("dist_m"))
        if r != radii[-1]:  # used twice: as a part of the result, and for who goes on
            near = write_stage(near, "near")
        found = near if found is None else found.unionByName(near)
        left = left.join(near, key, "left_anti")
    return found


def nearest_other(points: DataFrame, key: str, group: str, mid_lat: float, size: float = 500.0, growth: float = 4.0) -> DataFrame:
    """(group, key, dist_m): plane distance of each point to the nearest other point of its group; groups of one are left out.

    Buckets grow from step to step until every point has met its nearest: a neighbour within the bucket size is the nearest,
    and only points without one go on.
    """
    x, y = plane(F.col("lng"), F.col("lat"), mid_lat)
    every = points.select(F.col(group), F.col(key), x.alias("px"), y.alias("py"))
    several = every.groupBy(group).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(group)
    left = every = write_stage(every.join(several, group, "left_semi"), "points")
    d = F.sqrt(F.pow(F.col("px") - F.col("tx"), 2) + F.pow(F.col("py") - F.col("ty"), 2))
    parts = [every.select(group, key, F.lit(0.0).alias("dist_m")).where("false")]
    while not left.isEmpty():
        buckets = _bucketed(every, size).withColumnsRenamed({"px": "tx", "py": "ty", key: "other"})
        near = _around(left, size).join(buckets, [group, "bx", "by"]).where(F.col(key) != F.col("other"))
        near = write_stage(near.groupBy(group, key).agg(F.min(d).alias("dist_m")).where(F.col("dist_m") <= size), "near")
        parts.append(near)
        left = write_stage(left.join(near, [group, key], "left_anti"), "lonely")
        size *= growth
    return reduce(DataFrame.unionByName, parts)
