"""Sites: features of similar names close by are one site. And the survey of a city's feature types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ambula.functions.names import normalize, similar
from ambula.functions.walk import KY, haversine_m
from ambula.operators.components import connected_components
from ambula.operators.knn import nearest_other
from ambula.stages import write_stage

GROUP_RADIUS_M = 100.0
#: Fewer sites than these are too few, or marginal.
TOO_FEW, MARGINAL = 6, 15


def similar_pairs(features: DataFrame, radius_m: float = GROUP_RADIUS_M) -> DataFrame:
    """(type_id, a, b), a < b: named features of a type whose names are similar, within the radius.

    Buckets are bands of latitude as high as the radius and the first character of the normalised name, which similar
    names share.
    """
    band = F.floor(F.col("lat") * (KY / radius_m))
    named = features.where("name is not null").select("type_id", "id", "lng", "lat", normalize(F.col("name")).alias("norm"))
    named = named.where("norm <> ''").withColumn("band", band).withColumn("first", F.substring("norm", 1, 1))
    left = named.select("type_id", "first", *[F.col(c).alias(f"a_{c}") for c in ("id", "lng", "lat", "norm")], F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"))
    right = named.select("type_id", "first", "band", *[F.col(c).alias(f"b_{c}") for c in ("id", "lng", "lat", "norm")])
    met = left.join(right, ["type_id", "first", "band"]).where("a_id < b_id")
    close = haversine_m(F.col("a_lng"), F.col("a_lat"), F.col("b_lng"), F.col("b_lat")) <= radius_m
    return met.where(similar(F.col("a_norm"), F.col("b_norm")) & close).select("type_id", F.col("a_id").alias("a"), F.col("b_id").alias("b"))


def group_sites(features: DataFrame, radius_m: float = GROUP_RADIUS_M) -> DataFrame:
    """(type_id, pid, name, lng, lat, k, members): features(type_id, id, name, lng, lat), ids unique within a type, as sites.

    The name is that of the member of the least id, the place the mean. pid counts the sites of a type from 0, west to
    east, then south to north, then by least id.
    """
    pairs = similar_pairs(features, radius_m)
    ends = pairs.select(F.struct("type_id", F.col("a").alias("id")).alias("a"), F.struct("type_id", F.col("b").alias("id")).alias("b"))
    found = connected_components(ends).select(F.col("node.type_id").alias("type_id"), F.col("node.id").alias("id"), F.col("component.id").alias("site"))
    placed = features.join(found, ["type_id", "id"], "left").withColumn("site", F.coalesce("site", "id"))
    grouped = placed.groupBy("type_id", "site").agg(F.array_sort(F.collect_list(F.struct("id", "name", "lng", "lat"))).alias("m"))

    def mean(c: str) -> Column:  # in order of id, so the sum is the same each time
        return F.aggregate("m", F.lit(0.0), lambda acc, x: acc + x[c]) / F.size("m")

    sites = grouped.select("type_id", "site", F.get("m", F.lit(0))["name"].alias("name"), mean("lng").alias("lng"), mean("lat").alias("lat"), F.size("m").alias("k"), F.transform("m", lambda x: F.struct(x["id"], x["lng"], x["lat"])).alias("members"))
    pid = F.row_number().over(W.partitionBy("type_id").orderBy("lng", "lat", "site")) - 1
    return sites.withColumn("pid", pid).select("type_id", "pid", "name", "lng", "lat", "k", "members")


def upper_median(column: str, by: list[str], df: DataFrame, name: str) -> DataFrame:
    """The element at n div 2 of the sorted values, from 0, of each group; without values the group has none."""
    w = W.partitionBy(*by)
    ranked = df.where(F.col(column).isNotNull()).withColumn("r_", F.row_number().over(w.orderBy(column))).withColumn("n_", F.count(F.lit(1)).over(w))
    return ranked.where(F.col("r_") == F.floor(F.col("n_") / 2) + 1).select(*by, F.col(column).alias(name))


def verdict(n: Column) -> Column:
    return F.when(n < TOO_FEW, "too few - skip").when(n < MARGINAL, "marginal").otherwise("good")


def analyze(features: DataFrame, mid_lat: float) -> DataFrame:
    """(type_id, n_features, n_sites, spacing_m, verdict) of each type that has features."""
    sites = write_stage(group_sites(features), "sites")
    spacing = upper_median("dist_m", ["type_id"], nearest_other(sites, "pid", "type_id", mid_lat), "spacing_m")
    raw = features.groupBy("type_id").agg(F.count(F.lit(1)).alias("n_features"))
    n = sites.groupBy("type_id").agg(F.count(F.lit(1)).alias("n_sites"))
    return raw.join(n, "type_id").join(spacing, "type_id", "left").select("type_id", "n_features", "n_sites", "spacing_m", verdict(F.col("n_sites")).alias("verdict"))
