"""Command line: the two jobs as one-line commands (plus the scene listing).

    python -m lodestar load-catalog INPUT --url URL --table T --rejects PATH [--key data_url]
    python -m lodestar map PIXELS --out DIR [--res 500 --width 250 --height 200 --threshold 0.3]
    python -m lodestar list-scenes DIR [--suffix .hdf]

Under spark-submit the cluster's master and settings apply; ``--master`` is
for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    builder = SparkSession.builder.appName(f"lodestar {args.command}")
    if args.master:
        builder = builder.master(args.master)
    builder = (builder.config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC"))
    return builder.getOrCreate()


def _load_catalog(spark: SparkSession, args) -> dict:
    from lodestar.sinks.jdbc import stored_keys, write_catalog
    from lodestar.sources.text import catalog_scan

    opts = {"batchsize": args.batchsize}
    if args.max_connections:
        opts["max_connections"] = args.max_connections
    for k in ("user", "password", "driver"):
        if getattr(args, k):
            opts[k] = getattr(args, k)
    key, existing = tuple(args.key or ()), None
    if args.check_existing:
        login = {k: opts[k] for k in ("user", "password", "driver") if k in opts}
        existing = stored_keys(spark, args.url, args.table, key, **login)
    return write_catalog(catalog_scan(spark, args.input), args.url, args.table, args.rejects,
                         key=key, existing_keys=existing, on_error=args.on_error, load_id=args.load_id, **opts)


def _map(spark: SparkSession, args) -> dict:
    from lodestar.functions.raster import TransverseMercator
    from lodestar.operators.grid import GridSpec
    from lodestar.plans.mineral_map import mineral_map
    from lodestar.sinks.frames import frame_sink

    pixels = spark.read.parquet(args.pixels)
    m = mineral_map(pixels, GridSpec(args.res, args.width, args.height), overlap=args.overlap,
                    order=tuple(args.order.split(",")), threshold=args.threshold,
                    pixel_size=args.pixel_size,
                    projection=TransverseMercator(args.central_meridian) if args.lonlat else None)
    cells = m.dense_cells if args.dense else m.binary
    frame_sink(cells, args.out, mode="overwrite" if args.overwrite else "errorifexists")
    summary = spark.read.parquet(args.out).groupBy("frame_row", "frame_col").count()
    return {"frames": summary.count(), "out": args.out}


def _list_scenes(spark: SparkSession, args) -> dict:
    from lodestar.sources.scenes import scene_listing

    n = 0
    for r in scene_listing(spark, args.dir, args.suffix).select("name").toLocalIterator():
        print(r["name"])
        n += 1
    return {"scenes": n}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lodestar", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None, help="Spark master for local runs, e.g. local[*]")
    sub = p.add_subparsers(dest="command", required=True)

    c = sub.add_parser("load-catalog", help="decode catalog text and append it over JDBC")
    c.add_argument("input")
    c.add_argument("--url", required=True)
    c.add_argument("--table", required=True)
    c.add_argument("--rejects", required=True, help="Parquet folder for rejected lines")
    c.add_argument("--key", action="append", help="key column(s): reject NULL and duplicate keys of the load")
    c.add_argument("--check-existing", action="store_true", help="also reject keys that the table holds already")
    c.add_argument("--on-error", choices=("quarantine", "keep"), default="quarantine",
                   help="keep: store records that fail to decode, with default values")
    c.add_argument("--load-id", help="name of this load; repeating it overwrites its rejects")
    c.add_argument("--user")
    c.add_argument("--password")
    c.add_argument("--driver")
    c.add_argument("--batchsize", type=int, default=1000)
    c.add_argument("--max-connections", type=int)

    m = sub.add_parser("map", help="alteration map: index, grid, mosaic, binary frames")
    m.add_argument("pixels", help="Parquet pixel table (scene, x, y, acq, bands)")
    m.add_argument("--out", required=True, help="output folder, one directory per frame")
    m.add_argument("--res", type=float, default=500.0)
    m.add_argument("--width", type=int, default=250)
    m.add_argument("--height", type=int, default=200)
    m.add_argument("--pixel-size", type=float, default=None)
    m.add_argument("--threshold", type=float, default=0.3)
    m.add_argument("--overlap", default="latest")
    m.add_argument("--order", default="acq,scene", help="comma-separated overlap order columns")
    m.add_argument("--overwrite", action="store_true")
    m.add_argument("--dense", action="store_true", help="write every cell of every frame, NULL where nothing is")
    m.add_argument("--lonlat", action="store_true", help="project lon/lat columns first")
    m.add_argument("--central-meridian", type=float, default=None)

    s = sub.add_parser("list-scenes", help="list a directory's scene files")
    s.add_argument("dir")
    s.add_argument("--suffix", default=".hdf")

    args = p.parse_args(argv)
    spark = _session(args)
    run = {"load-catalog": _load_catalog, "map": _map, "list-scenes": _list_scenes}[args.command]
    print(json.dumps(run(spark, args)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
