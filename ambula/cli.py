"""python -m ambula.cli run|analyze|manifest <city>... [--root DIR] [--types a,b] [--skip-tiles] [--dem PARQUET]"""

from __future__ import annotations

import argparse
import json
import sys
import traceback
from pathlib import Path

from ambula import config, sinks
from ambula.plans import city as plan
from ambula.session import get_session
from ambula.sources import osm_pbf
from ambula.sources.files import fetch


def _elements(spark, path: str):
    return [spark.read.format("osm_pbf").option("element", e).load(path) for e in ("node", "way", "relation")]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ambula")
    parser.add_argument("command", choices=("run", "analyze", "manifest"))
    parser.add_argument("cities", nargs="*", help="ids; none or `all` for every city")
    parser.add_argument("--root", type=Path, default=None)
    parser.add_argument("--types", default=None)
    parser.add_argument("--skip-tiles", action="store_true")
    parser.add_argument("--dem", default=None, help="Parquet with lat0, lng0, w, h, row, col, v")
    parser.add_argument("--template", default=None, help="URL template of the data, for the manifest")
    args = parser.parse_args(argv)
    root = args.root or config.find_root(Path.cwd())
    cities, catalogue = config.load_cities(root / "config"), config.load_feature_types(root / "config")
    out = root / "out"
    if args.command == "manifest":
        (out / "manifest.json").write_text(json.dumps(sinks.manifest(cities, catalogue, out, args.template), indent=2, ensure_ascii=False))
        return 0
    wanted = [c for c in cities if not args.cities or args.cities == ["all"] or c.id in args.cities]
    if unknown := set(args.cities) - {"all"} - {c.id for c in cities}:
        parser.error(f"unknown cities: {', '.join(sorted(unknown))}")
    spark, failed = get_session(), 0
    osm_pbf.register(spark)
    for city in wanted:
        try:
            path = fetch(city.pbf_url, root / "data" / city.pbf_url.rsplit("/", 1)[-1])
            nodes, ways, relations = _elements(spark, str(path))
            if args.command == "analyze":
                every = config.City(**{**vars(city), "types": tuple(t.id for t in catalogue)})
                plan.survey(nodes, ways, config.resolve_types(every, catalogue), city.bbox).show(50, False)
            else:
                types = config.resolve_types(city, catalogue, args.types.split(",") if args.types else None)
                dem = spark.read.parquet(args.dem) if args.dem else None
                print(city.id, plan.run_city(city, types, nodes, ways, relations, dem, out, args.skip_tiles))
        except Exception:
            traceback.print_exc()
            failed += 1
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
