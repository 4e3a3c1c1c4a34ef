"""The rule language over tags, compiled to boolean Columns.

Forms, the first that fits counts: {any: [..]}, {all: [..]}, {not: rule}, {key: k, in: [..]}, {key: k, contains: [..]},
{key: k, exists: true|false}. Rules are two-valued: a missing tag is false, so its negation is true.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from ambula.config import FeatureType
from ambula.functions.geometry import in_bbox
from ambula.functions.walk import has_tag, tag_in


def compile_rule(rule: dict[str, Any], tags: Column) -> Column:
    if "any" in rule:
        return reduce(lambda a, b: a | b, (compile_rule(r, tags) for r in rule["any"]), F.lit(False))
    if "all" in rule:
        return reduce(lambda a, b: a & b, (compile_rule(r, tags) for r in rule["all"]), F.lit(True))
    if "not" in rule:
        return ~compile_rule(rule["not"], tags)
    key = rule.get("key")
    if key is not None and "in" in rule:
        return tag_in(tags, key, *map(str, rule["in"]))
    if key is not None and "contains" in rule:
        value = F.lower(tags[key])
        return F.coalesce(reduce(lambda a, b: a | b, (F.contains(value, F.lit(str(s).lower())) for s in rule["contains"]), F.lit(False)), F.lit(False))
    if key is not None and "exists" in rule:
        return has_tag(tags, key) == F.lit(bool(rule["exists"]))
    raise ValueError(f"not a rule: {rule}")


def matching_types(types: list[FeatureType], tags: Column, lng: Column | None = None, lat: Column | None = None) -> Column:
    """The ids of all types that fit, as an array; the place is tested where a type has a box and a place is given."""
    fits = []
    for t in types:
        rule = compile_rule(t.match, tags)
        if t.within and lng is not None:
            rule = rule & in_bbox(lng, lat, t.within)
        fits.append(F.when(rule, F.lit(t.id)))
    return F.array_compact(F.array(*fits)) if fits else F.array().cast("array<string>")
