"""Command line for the index build.

    spark-submit -m tessera.plans.cli --pixels s3a://bucket/pixels \\
        --out s3a://bucket/population --scenario SSP2 --resolutions 1,2,3,4,5,6,7,8

Input is a wide pixel table (``lat, lon, pop_<year>...``) or, with
``--tiles``, a tile table plus ``--grid`` (JSON of the grid descriptor).
``--dry-run`` prints the window plan and stops. ``--resumable`` runs the
build by windows (restartable, see ``tessera.streaming.windows``).
"""

from __future__ import annotations

import argparse
import json

from ..sources.grid import GridSpec, pop_col, tiles_to_wide_pixels
from .build import DEFAULT_SCENARIO, SCENARIOS, build_population_index, parse_resolutions, plan_index


def _args(argv=None):
    p = argparse.ArgumentParser(description="Gridded population -> hexagonal cell index")
    p.add_argument("--pixels", help="wide pixel table (Parquet)")
    p.add_argument("--tiles", help="tile table (Parquet): year, tile_row, tile_col, values")
    p.add_argument("--tile-size", type=int, help="side of the blocks (default: the grid descriptor's)")
    p.add_argument("--grid", help="grid descriptor JSON (required with --tiles)")
    p.add_argument("--years", help="comma-separated years (default: every pop_YYYY column / tile year)")
    p.add_argument("--out", required=True, help="output base folder (any Hadoop URI)")
    p.add_argument("--scenario", default=DEFAULT_SCENARIO, choices=SCENARIOS)
    p.add_argument("--resolutions", default="1,2,3,4,5,6,7,8")
    p.add_argument("--system", default="hex", choices=("hex", "h3"))
    p.add_argument("--nodata", default="-99999.0", help="a number, nan, inf, or none (with --pixels)")
    p.add_argument("--crs", default="EPSG:4326", help="CRS of lat/lon (with --pixels)")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--resumable", action="store_true")
    p.add_argument("--input-version", help="with --resumable: a name for the input's content (default: the listing of its files)")
    p.add_argument("--keep-versions", type=int, help="after the build, delete all but the newest so many versions of the scenario")
    return p.parse_args(argv)


def main(argv=None) -> None:
    from ..session import get_spark
    from ..sources.index_reader import listing_key

    a = _args(argv)
    spark = get_spark("tessera-build")
    res = parse_resolutions(a.resolutions)
    if a.tiles:
        if not a.grid:
            raise SystemExit("--tiles needs --grid")
        grid = GridSpec(**json.loads("\n".join(r[0] for r in spark.read.text(a.grid).collect())))
        tiles = spark.read.parquet(a.tiles)
        years = (
            [int(y) for y in a.years.split(",")]
            if a.years
            else sorted(r[0] for r in tiles.select("year").distinct().collect())
        )
        pixels = tiles_to_wide_pixels(tiles, grid, a.tile_size, years)
    else:
        if not a.pixels:
            raise SystemExit("give --pixels or --tiles")
        pixels = spark.read.parquet(a.pixels)
        from ..operators.analytics import pop_columns

        years = [int(y) for y in a.years.split(",")] if a.years else [int(c[4:]) for c in pop_columns(pixels)]
        nodata = None if a.nodata.lower() == "none" else float(a.nodata)
        grid = GridSpec(-180.0, 90.0, 0.0, 0.0, 0, 0, nodata=nodata, crs=a.crs)
    grid.check_geographic()
    if a.dry_run:
        plan = plan_index(spark, years, res)
        print(f"Dry run: {plan.count()} windows x {len(years)} years x {len(res)} resolutions")
        plan.show(5, truncate=False)
        return
    if a.resumable:
        from ..streaming.resumable import resumable_build

        where = a.tiles or a.pixels
        inputs = f"{where} {a.input_version or listing_key(spark, where)}"
        out = resumable_build(spark, pixels, inputs, grid, years, a.out, a.scenario, res, a.system)
    else:
        out = build_population_index(spark, pixels, grid, years, a.out, a.scenario, res, system=a.system)
    if a.keep_versions:
        from ..sinks.snapshots import expire

        expire(spark, a.out, a.scenario, a.keep_versions)
    for r in out.groupBy("h3_res").count().orderBy("h3_res").collect():
        print(f"  res {r['h3_res']:2d}: {r['count']:12d} cells")


if __name__ == "__main__":
    main()
