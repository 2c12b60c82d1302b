"""Command line: run the pipeline steps the way the notebook runs them, one command each.

    python -m strata build    TABLES_DIR            raw -> bronze -> silver -> gold, counts as JSON
    python -m strata ingest   RAW_DIR LAKE_DIR --years 2023 --months 1-5 [--sources yellow,green]
                                                    the same from files already landed; registers silver.* and gold.trips
    python -m strata validate TABLES_DIR [LAYER]    quality report of gold (or silver_yellow, ...)
    python -m strata report   TABLES_DIR KEY [N]    show any registered report, e.g. q1, audit_trail
    python -m strata list                           the registered report keys

The session comes from ``SparkSession.builder``, so a cluster's own
settings (master, ``spark.checkpoint.dir``) apply; ``--local`` starts the
local test session instead.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from strata.config import LakeConfig
from strata.session import cluster_conf


def _session(local: bool, input_bytes: int | None = None, cores: int | None = None) -> SparkSession:
    """The cluster's session, or a local one; sized for the input if its bytes and the cores are given."""
    if local:
        from strata.session import local_session
        return local_session()
    builder = SparkSession.builder.appName("strata")
    if input_bytes and cores:
        builder = builder.config(map=cluster_conf(input_bytes, cores))
    return builder.getOrCreate()


def _numbers(text: str) -> tuple[int, ...]:
    """``1-3,5`` -> (1, 2, 3, 5)."""
    out: list[int] = []
    for part in text.split(","):
        first, _, last = part.partition("-")
        out += range(int(first), int(last or first) + 1)
    return tuple(out)


def _landed_config(years: str, months: str, sources: str | None) -> LakeConfig:
    ys, ms = _numbers(years), _numbers(months)
    first, last = dt.datetime(min(ys), min(ms), 1), dt.datetime(max(ys), max(ms), 1)
    after = dt.datetime(last.year + (last.month == 12), last.month % 12 + 1, 1)
    default = LakeConfig()
    return LakeConfig(years=ys, months=ms, sources=tuple(sources.split(",")) if sources else default.sources,
                      start=first, period_end=after, focus_month=last)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="strata", description=__doc__.splitlines()[0])
    parser.add_argument("--local", action="store_true", help="use a local session (tests, laptops)")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="build (or rebuild) the lake of a table directory")
    b.add_argument("tables_dir")
    i = sub.add_parser("ingest", help="build a lake from landed files {source}/{source}_tripdata_YYYY-MM.parquet")
    i.add_argument("raw_dir")
    i.add_argument("lake_dir")
    i.add_argument("--years", required=True)
    i.add_argument("--months", required=True)
    i.add_argument("--sources")
    for p in (b, i):
        p.add_argument("--input-bytes", type=int, help="size of the raw input, to size shuffles with --cores")
        p.add_argument("--cores", type=int, help="cores of the cluster")
    v = sub.add_parser("validate", help="quality report of one layer")
    v.add_argument("tables_dir")
    v.add_argument("layer", nargs="?", default="gold")
    r = sub.add_parser("report", help="show a registered report")
    r.add_argument("tables_dir")
    r.add_argument("key")
    r.add_argument("rows", nargs="?", type=int, default=50)
    sub.add_parser("list", help="list the registered report keys")
    args = parser.parse_args(argv)

    from strata.registry import CFG, QUERIES
    if args.command == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = _session(args.local, getattr(args, "input_bytes", None), getattr(args, "cores", None))
    from strata.lake import Lake, open_lake
    if args.command == "ingest":
        lake = Lake(spark, None, args.lake_dir, _landed_config(args.years, args.months, args.sources), landed_at=args.raw_dir)
        built = lake.build()
        months = {s: sum(m.values()) for s, m in built["bronze_silver"]["bronze"].items()}
        print(json.dumps({"bronze": months, "silver": built["bronze_silver"]["silver"], "gold": built["gold"]["total"],
                          "tables": list(lake.register_tables(suffix="").values()), "root": lake.root}))
        return 0
    if args.command == "build":
        lake = open_lake(spark, args.tables_dir, CFG, rebuild=True)
        counts = {"bronze": {s: lake.bronze(s).count() for s in CFG.sources},
                  "silver": {s.name: lake.silver(s.name).count() for s in CFG.trip_sources},
                  "gold": lake.gold().count(), "root": lake.root}
        print(json.dumps(counts))
    elif args.command == "validate":
        from strata.plans import quality
        lake = open_lake(spark, args.tables_dir, CFG)
        layer = lake.gold() if args.layer == "gold" else lake.silver(args.layer.removeprefix("silver_"))
        quality.quality_report(layer, args.layer, CFG.warn_pct).show(truncate=False)
    elif args.command == "report":
        if args.key not in QUERIES:
            print(f"unknown report {args.key!r}; see `python -m strata list`", file=sys.stderr)
            return 2
        QUERIES[args.key](spark, args.tables_dir).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
