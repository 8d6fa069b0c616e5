"""Command line: the daily batch and the template checks as Spark jobs.

    spark-submit lakestrata/plans/cli.py daily --root <shared folder> --log <event log> \\
        --templates <template folder> [--type NAME=FILE ...] [--gold NAME=FIELD ...] \\
        [--minutes 3000] [--as-of ISO] [--format parquet] [--buckets 256] [--diagnose]
    spark-submit lakestrata/plans/cli.py investigate --root <shared folder> --templates <folder> --only NAME \\
        [--type NAME=FILE ...] [--since ISO]
    spark-submit lakestrata/plans/cli.py discrepancy --templates <folder> [--type NAME=FILE ...] [--out <folder>]

(``python -m lakestrata ...`` does the same on a local session.)

Runs on the session the launcher provides (``getOrCreate``).
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from lakestrata.plans import daily
from lakestrata.plans.tables import Lakehouse
from lakestrata.session import configure
from lakestrata.sources import templates

# Device types with a gold job, and the telemetry field it reads.
GOLD_FIELDS = {"Compressors": "RUNNINGHR"}


def _pairs(items: list[str] | None, default: dict[str, str]) -> dict[str, str]:
    if not items:
        return dict(default)
    out = {}
    for item in items:
        name, _, value = item.partition("=")
        if not value:
            raise SystemExit(f"expected NAME=VALUE, got {item!r}")
        out[name] = value
    return out


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lakestrata")
    sub = p.add_subparsers(dest="command", required=True)
    d = sub.add_parser("daily", help="bronze ingest, then silver and gold per device type")
    d.add_argument("--root", required=True, help="shared folder of the tables")
    d.add_argument("--database", default="lakestrata")
    d.add_argument("--log", required=True, help="event-log path (body, enqueuedTime, ...)")
    d.add_argument("--format", default="parquet")
    d.add_argument("--templates", required=True, help="folder of device template files")
    d.add_argument("--type", action="append", help="device type=template file (repeatable)")
    d.add_argument("--gold", action="append", help="device type=telemetry field for gold (repeatable)")
    d.add_argument("--minutes", type=int, default=3000)
    d.add_argument("--as-of", default=None, help="end of the window, ISO time (default now, UTC)")
    d.add_argument("--buckets", type=int, default=daily.DEFAULT_BUCKETS)
    d.add_argument("--diagnose", action="store_true", help="also write the flag-detail table")
    d.add_argument("--dedup-flags", action="store_true")
    d.add_argument("--slice-minutes", type=int, default=None,
                   help="process the window in consecutive slices of this many minutes (backfills)")
    d.add_argument("--full-refresh", action="store_true", help="silver reads all of bronze; gold is rebuilt")
    i = sub.add_parser("investigate", help="offending fields of one device type over stored bronze")
    i.add_argument("--root", required=True)
    i.add_argument("--database", default="lakestrata")
    i.add_argument("--templates", required=True)
    i.add_argument("--type", action="append")
    i.add_argument("--only", required=True, help="the device type")
    i.add_argument("--since", default=None, help="hub time from which to read, ISO (default: all)")
    q = sub.add_parser("discrepancy", help="fields declared with different types across templates")
    q.add_argument("--templates", required=True)
    q.add_argument("--type", action="append")
    q.add_argument("--out", default=None, help="write the rows there as Parquet (default: print all)")
    return p


def devices_from_templates(spark: SparkSession, folder: str, mapping: dict[str, str],
                           gold_fields: dict[str, str]) -> list[daily.DeviceType]:
    unsupported: dict[str, dict[str, str]] = {}
    structs = templates.telemetry_by_type(spark, folder, mapping, unsupported)
    for device_type, fields in sorted(unsupported.items()):
        for name, type_name in sorted(fields.items()):
            print(f"left out: {device_type}.{name}, unsupported type {type_name}")
    return [daily.DeviceType(name, structs[name], gold_fields.get(name)) for name in mapping]


def _time(text: str | None) -> dt.datetime | None:
    return dt.datetime.fromisoformat(text.replace("Z", "")) if text else None


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("lakestrata").getOrCreate())
    mapping = _pairs(args.type, templates.ACTIVE_DICTIONARY)
    if args.command == "discrepancy":
        entries = templates.read_entries(spark, f"{args.templates.rstrip('/')}/*")
        found = templates.type_discrepancy(templates.flatten(entries, templates.dictionary(spark, mapping)))
        if args.out:
            found.write.parquet(args.out)
        else:
            for row in found.orderBy("Telemetry", "Asset").toLocalIterator():
                print(row["Telemetry"], row["Asset"], row["DataType"], sep="\t")
        return 0
    if args.command == "investigate":
        if args.only not in mapping:
            raise SystemExit(f"no template for {args.only!r}")
        device, = devices_from_templates(spark, args.templates, {args.only: mapping[args.only]}, {})
        found = daily.investigate(Lakehouse(spark, args.root, args.database), device, _time(args.since))
        print(f"{found.count()} findings in {daily.Layout().investigation_spec(device.name).name}")
        return 0
    devices = devices_from_templates(spark, args.templates, mapping, _pairs(args.gold, GOLD_FIELDS))
    as_of = _time(args.as_of)
    events = spark.read.format(args.format).load(args.log)
    lh = Lakehouse(spark, args.root, args.database)
    options = dict(layout=daily.Layout(buckets=args.buckets), diagnose=args.diagnose, dedup_flags=args.dedup_flags,
                   full_refresh=args.full_refresh)
    if args.slice_minutes:
        end = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        results = daily.backfill(lh, events, devices, end - dt.timedelta(minutes=args.minutes), end,
                                 args.slice_minutes, **options)
    else:
        results = [daily.run_daily(lh, events, devices, args.minutes, as_of, **options)]
    for result in results:
        result.range_report.show(truncate=False)
    print("tables:", ", ".join(sorted(lh.list_tables())))
    return 0


if __name__ == "__main__":
    sys.exit(main())
