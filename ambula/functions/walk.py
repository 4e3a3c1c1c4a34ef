"""Walking: which ways can be walked, distances, and times by slope. All are Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
#: Metres of a degree of latitude, and of longitude at the equator, for the local plane.
KY, KX = 110_574.0, 111_320.0
#: Speed of the last leg off the graph, in metres a second.
LAST_LEG_MS = 1.39
# fixed values: tag values that decide whether a way can be walked
WALK_HIGHWAYS = (
    "footway", "path", "pedestrian", "steps", "living_street", "residential", "service", "track", "unclassified",
    "tertiary", "tertiary_link", "secondary", "secondary_link", "primary", "primary_link", "cycleway", "bridleway", "corridor", "road",
)
FOOT_YES = ("yes", "designated", "permissive")
FOOT_NO = ("no", "private", "use_sidepath", "discouraged")
SIDEWALK_YES = ("yes", "left", "right", "both")
ACCESS_NO = ("no", "private", "military")


def tag_in(tags: Column, key: str, *values: str) -> Column:
    """Two-valued: false where the key is missing or the map is null."""
    return F.coalesce(tags[key].isin(*values), F.lit(False))


def has_tag(tags: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(tags, key), F.lit(False))


def walkable(tags: Column) -> Column:
    foot_yes = tag_in(tags, "foot", *FOOT_YES)
    road = tag_in(tags, "highway", *WALK_HIGHWAYS)
    trunk = tag_in(tags, "highway", "trunk", "trunk_link") & (tag_in(tags, "sidewalk", *SIDEWALK_YES) | foot_yes)
    barred = tag_in(tags, "foot", *FOOT_NO) | (tag_in(tags, "access", *ACCESS_NO) & ~foot_yes)
    ferry = has_tag(tags, "ferry") | tag_in(tags, "route", "ferry")
    return (road | trunk) & ~barred & ~ferry & ~tag_in(tags, "service", "drive-through")


def is_steps(tags: Column) -> Column:
    return tag_in(tags, "highway", "steps")


def _set_and_not_no(tags: Column, key: str) -> Column:
    return F.coalesce(tags[key] != "no", F.lit(False))


def is_flat(tags: Column) -> Column:
    return _set_and_not_no(tags, "bridge") | _set_and_not_no(tags, "tunnel")


def is_building(tags: Column) -> Column:
    return _set_and_not_no(tags, "building")


def haversine_m(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    half_lat, half_lng = F.radians(lat2 - lat1) / 2, F.radians(lng2 - lng1) / 2
    h = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lng), 2)
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def tobler_ms(slope: Column) -> Column:
    """Speed on a slope, by Tobler's hiking function."""
    return 6 * F.exp(-3.5 * F.abs(slope + 0.05)) / 3.6


def segment_times_ds(d: Column, dh: Column, steps: Column, flat: Column) -> tuple[Column, Column]:
    """Tenths of a second there and back, at least 1; dh is the climb of the way there."""
    climb = F.when(flat | (d < 3), 0.0).otherwise(dh)

    def one(rise: Column) -> Column:
        slope = F.greatest(F.lit(-0.35), F.least(F.lit(0.35), rise / F.nullif(d, F.lit(0.0))))
        speed = F.when(steps, F.when(rise > 0, 0.45).otherwise(0.6)).otherwise(tobler_ms(slope))
        return F.when(d <= 0, 1).otherwise(F.greatest(F.lit(1), F.round(10 * d / speed).cast("int")))

    return one(climb), one(-climb)


def last_leg_s(dist_ds: Column, snap_m: Column) -> Column:
    """Seconds from a place to its site: the node's time and the way to the node."""
    return (F.floor(dist_ds / 10) + F.floor(snap_m / LAST_LEG_MS)).cast("int")
