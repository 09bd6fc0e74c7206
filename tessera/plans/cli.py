"""spark-submit entry point for the card pipeline.

  spark-submit --py-files tessera.zip tessera/plans/cli.py --source parquet:/data/src \\
      --warehouse s3a://bucket/wh --export s3a://bucket/flat/2025-08-20
  ... --source jdbc:jdbc:postgresql://host/db --jdbc-props props.json \\
      --jdbc-partitions 64 --jdbc-partition-columns movement=movement_num,card=card_num \\
      --jdbc-one-task holder,account

Source tables are ``holder``, ``account``, ``card``, ``movement`` (parquet:
``<dir>/<table>``; jdbc: tables of those names). Prints the stage results as JSON.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from dataclasses import replace

from tessera.operators import SkewSpec
from tessera.plans.pipeline import OPTIONAL_STAGES, STAGES, PipelineConfig, run
from tessera.session import build_session
from tessera.sources import read_jdbc


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tessera.plans.cli", description=__doc__.split("\n")[0])
    p.add_argument("--source", required=True, help="parquet:<dir> or jdbc:<url>")
    p.add_argument("--jdbc-props", help="JSON file with user/password/driver")
    p.add_argument("--jdbc-partitions", type=int, default=0)
    p.add_argument("--jdbc-partition-columns", default="",
                   help="table=column,... numeric/date columns to split reads on")
    p.add_argument("--jdbc-one-task", default="",
                   help="table,... small tables to read in one task")
    p.add_argument("--warehouse", required=True, help="shared root of the table store")
    p.add_argument("--export", help="flat-file output folder")
    p.add_argument("--stages", nargs="*", default=list(STAGES), choices=[*STAGES, *OPTIONAL_STAGES])
    p.add_argument("--as-of", type=dt.date.fromisoformat)
    p.add_argument("--now", type=dt.datetime.fromisoformat)
    p.add_argument("--holder-match", choices=["any", "current"], default="any")
    p.add_argument("--null-safe", action="store_true")
    p.add_argument("--validity-upper", choices=["closed", "half_open"], default="closed")
    p.add_argument("--fact-mode", choices=["full", "incremental"], default="full")
    p.add_argument("--flatten-how", choices=["inner", "left"], default="inner")
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--calendar-start", type=dt.date.fromisoformat)
    p.add_argument("--calendar-end", type=dt.date.fromisoformat)
    p.add_argument("--calendar-fixed", action="store_true",
                   help="do not extend the calendar to the movements' days")
    p.add_argument("--key-modulus", type=int)
    p.add_argument("--consecutive-keys", action="store_true",
                   help="number new dimension rows instead of hashing their ids")
    p.add_argument("--holder-parts", type=int, help="hash parts of the holder dimension")
    p.add_argument("--movement-stamp", help="the source's load stamp of a movement")
    p.add_argument("--movement-overlap-days", type=float,
                   help="how many days late a movement may become visible")
    p.add_argument("--compact-after", type=int, help="appended loads after which stage compact rewrites a table")
    p.add_argument("--holder-tracked", nargs="*", help="columns that make a new holder version")
    p.add_argument("--fact-partition-by", nargs="*")
    p.add_argument("--skew-share", type=float,
                   help="split keys above this share of the movements; 0 leaves skew to AQE")
    p.add_argument("--publish", help="jdbc url that the publish stage writes to")
    p.add_argument("--publish-props", help="JSON file with user/password/driver")
    p.add_argument("--master", help="only for local runs, e.g. local[8]")
    return p.parse_args(argv)


def source_reader(spark, args):
    kind, _, where = args.source.partition(":")
    if kind == "parquet":
        return lambda t: spark.read.parquet(f"{where.rstrip('/')}/{t}")
    if kind == "jdbc":
        props = json.load(open(args.jdbc_props)) if args.jdbc_props else {}
        cols = dict(kv.split("=", 1) for kv in args.jdbc_partition_columns.split(",") if kv)
        return lambda t: read_jdbc(spark, where, t, props, partition_column=cols.get(t),
                                   num_partitions=args.jdbc_partitions or None,
                                   one_task=t in args.jdbc_one_task.split(","))
    raise SystemExit(f"unknown source kind {kind!r}: use parquet:<dir> or jdbc:<url>")


def main(argv=None) -> dict:
    args = parse_args(argv)
    spark = build_session(args.master, app="tessera-card-pipeline")
    cfg = PipelineConfig(read_source=source_reader(spark, args), warehouse_root=args.warehouse,
                         export_path=args.export, as_of=args.as_of, now=args.now,
                         holder_match=args.holder_match, null_safe=args.null_safe,
                         validity_upper=args.validity_upper, fact_mode=args.fact_mode,
                         flatten_how=args.flatten_how, single_file=args.single_file,
                         key_modulus=args.key_modulus, publish_url=args.publish,
                         calendar_from_movements=not args.calendar_fixed,
                         consecutive_keys=args.consecutive_keys, movement_stamp=args.movement_stamp)
    given = {"holder_parts": args.holder_parts, "compact_after": args.compact_after,
             "movement_overlap": None if args.movement_overlap_days is None
             else dt.timedelta(days=args.movement_overlap_days),
             "calendar_start": args.calendar_start, "calendar_end": args.calendar_end}
    if args.holder_tracked is not None:
        given["holder_tracked"] = tuple(args.holder_tracked)
    if args.fact_partition_by is not None:
        given["fact_partition_by"] = tuple(args.fact_partition_by)
    if args.publish_props:
        given["publish_properties"] = json.load(open(args.publish_props))
    cfg = replace(cfg, **{k: v for k, v in given.items() if v is not None})
    if args.skew_share is not None:
        cfg = replace(cfg, skew=SkewSpec(args.skew_share) if args.skew_share else None)
    out = run(spark, cfg, stages=args.stages)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
