"""Command line: ``python -m geoloom fixed|adaptive``; settings are those of ``config``.  Errors go to stderr with status 1."""

from __future__ import annotations

import argparse
import dataclasses
import sys

from .config import AdaptiveConfig, ConfigError, FixedConfig, number_list

#: Settings that are lists of numbers.
LISTS = {"scales": float, "band_steps": int, "phases": float}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="geoloom")
    commands = out.add_subparsers(dest="command", required=True)
    fixed, adaptive = commands.add_parser("fixed", help="cover with circles of 500 and 1000 metres"), commands.add_parser("adaptive", help="cover with radii that follow density")
    for p in (fixed, adaptive):
        p.add_argument("--border", required=True, help="GeoJSON file of the region")
        p.add_argument("--output", required=True, help="JSON file of the circles")
    fixed.add_argument("--small", required=True, help="GeoJSON file of the part for small circles")
    adaptive.add_argument("--cells", required=True, help="CSV file of density cells")
    modes = fixed.add_mutually_exclusive_group()
    for mode in ("fast", "auto", "fast-local"):
        modes.add_argument(f"--{mode}", dest="mode", action="store_const", const=mode)
    for f in dataclasses.fields(AdaptiveConfig):
        if f.name in LISTS:
            adaptive.add_argument(f"--{f.name.replace('_', '-')}", type=str, default=None)
        else:
            adaptive.add_argument(f"--{f.name.replace('_', '-')}", type=float if "float" in str(f.type) else int, default=f.default)
    return out


def config_of(args: argparse.Namespace) -> FixedConfig | AdaptiveConfig:
    if args.command == "fixed":
        return FixedConfig(mode=args.mode or "fast")
    given = {f.name: getattr(args, f.name) for f in dataclasses.fields(AdaptiveConfig)}
    return AdaptiveConfig(**{k: number_list(v, LISTS[k]) if k in LISTS else v for k, v in given.items() if not (k in LISTS and v is None)})


def run(args: argparse.Namespace, config: FixedConfig | AdaptiveConfig) -> int:
    """Writes the circles (lat, lng, radius, collected); returns how many."""
    import numpy as np
    from pyspark.sql import functions as F

    from .functions import geometry as G
    from .functions.scalars import METRES_PER_DEGREE, project, unproject
    from .plans import adaptive, fixed
    from .session import session
    from .sources import sinks, tables

    spark = session("geoloom-plan")
    border = np.array(G.edges(tables.boundary(spark, args.border)), float)
    lng0, lat0 = (float(border[:, [i, i + 2]].min() + border[:, [i, i + 2]].max()) / 2 for i in (0, 1))
    scale = np.array([METRES_PER_DEGREE * np.cos(np.radians(lat0)), METRES_PER_DEGREE] * 2)
    flat = lambda e: (e - np.array([lng0, lat0] * 2)) * scale
    if args.command == "fixed":
        small = np.array(G.edges(tables.boundary(spark, args.small)), float)
        found = fixed.plan(spark, fixed.Zones.of(flat(border), flat(small)), config)
    else:
        x, y = project(F.col("lat_center"), F.col("lon_center"), lat0, lng0)
        cells = np.array([tuple(r) for r in tables.cells(spark, args.cells).select(x.alias("x"), y.alias("y"), "population_density").orderBy("x", "y").collect()])
        found = adaptive.plan(spark, flat(border), cells, config)
    lat, lng = unproject(F.col("x"), F.col("y"), lat0, lng0)
    more = [F.col("density").alias("population_density")] if "density" in found.columns else []
    return sinks.circles_document(found.select(F.round(lat, 6).alias("lat"), F.round(lng, 6).alias("lng"), "radius", F.lit(False).alias("collected"), *more), args.output)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        n = run(args, config_of(args))
    except (ConfigError, ValueError, RuntimeError, OSError) as e:
        print(f"geoloom: {e}", file=sys.stderr)
        return 1
    print(f"{n} circles")
    return 0


if __name__ == "__main__":
    sys.exit(main())
