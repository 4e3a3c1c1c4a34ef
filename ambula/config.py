"""Cities and feature types: registries in YAML, resolved on the driver."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession

#: Part of config_hash, so that a change of the extraction rules makes new stage tables.
EXTRACT_VERSION = 1


@dataclass(frozen=True)
class City:
    id: str
    name: str
    pbf_url: str
    types: tuple[str, ...]
    country: str | None = None
    bbox: tuple[float, float, float, float] | None = None
    grid_m: float = 10.0
    pilot: bool = False


@dataclass(frozen=True)
class FeatureType:
    id: str
    name: str
    match: dict[str, Any]
    within: tuple[float, float, float, float] | None = None
    variants: dict[str, Any] = field(default_factory=dict)


def find_root(start: Path) -> Path:
    """The nearest folder at or above start that has config/cities.yaml."""
    for folder in (start, *start.parents):
        if (folder / "config" / "cities.yaml").is_file():
            return folder
    raise FileNotFoundError(f"no config/cities.yaml at or above {start}")


def load_cities(folder: Path) -> list[City]:
    rows = yaml.safe_load((folder / "cities.yaml").read_text()) or []
    return [City(**{**r, "types": tuple(r.get("types") or ()), "bbox": tuple(r["bbox"]) if r.get("bbox") else None}) for r in rows]


def load_feature_types(folder: Path) -> list[FeatureType]:
    """Anchors and aliases are resolved by the YAML library."""
    return parse_feature_types(yaml.safe_load((folder / "feature_types.yaml").read_text()) or [])


def parse_feature_types(rows: list[dict]) -> list[FeatureType]:
    return [FeatureType(**{**r, "within": tuple(r["within"]) if r.get("within") else None, "variants": r.get("variants") or {}}) for r in rows]


def resolve_types(city: City, catalogue: list[FeatureType], subset: list[str] | None = None) -> list[FeatureType]:
    """The types of a city with the variant of the city, else of its country, applied; subset must be of them."""
    if not city.types:
        raise ValueError(f"city {city.id} has no feature types")
    if unknown := [t for t in subset or () if t not in city.types]:
        raise ValueError(f"city {city.id} has no types {unknown}")
    known = {t.id: t for t in catalogue}
    resolved = []
    for type_id in city.types:
        if type_id not in known:
            raise ValueError(f"city {city.id}: unknown feature type {type_id}")
        if subset and type_id not in subset:
            continue
        base = known[type_id]
        variant = base.variants.get(city.id) or base.variants.get(city.country) or {}
        within = variant.get("within")
        resolved.append(FeatureType(base.id, base.name, variant.get("match", base.match), tuple(within) if within else base.within))
    return resolved


def config_hash(types: list[FeatureType]) -> str:
    """Key of the stage tables of these types."""
    text = json.dumps([EXTRACT_VERSION, [[t.id, t.name, t.match, t.within] for t in types]], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def cities_frame(spark: SparkSession, cities: list[City]) -> DataFrame:
    schema = "id string, name string, pbf_url string, country string, types array<string>, bbox array<double>, grid_m double, pilot boolean"
    return spark.createDataFrame([(c.id, c.name, c.pbf_url, c.country, list(c.types), list(c.bbox) if c.bbox else None, float(c.grid_m), c.pilot) for c in cities], schema)
