"""Job entry points (``python -m landfall`` or ``landfall_job.py`` under ``spark-submit``).

    spark-submit --py-files landfall.zip landfall_job.py load \\
        --feed providers --input_path s3://landing/providers_20240105.txt \\
        --lake s3://lake --audit s3://lake/_audit
    spark-submit --py-files landfall.zip landfall_job.py intake \\
        --landing s3://landing/ --lake s3://lake --audit s3://lake/_audit \\
        --checkpoint s3://lake/_intake [--glob '*.txt'] [--poll '30 seconds']

``load`` exits non-zero when the load FAILED, so a scheduler sees the outcome.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from landfall.plans.feeds import ALL_FEEDS, BY_NAME
from landfall.plans.run import run_load
from landfall.sinks.audit import compact_audit
from landfall.streaming.intake import start_intake, start_notified_intake


def jdbc_options(url: str | None, table: str, user: str | None) -> dict | None:
    """``run_load``'s ``jdbc``; the password comes from the environment, never from the command line."""
    if not url:
        return None
    return {"url": url, "table": table, "user": user, "password": os.environ.get("LANDFALL_JDBC_PASSWORD")}


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="landfall")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="load one landed object")
    ld.add_argument("--feed", required=True, choices=sorted(BY_NAME))
    ld.add_argument("--input_path", required=True)
    ld.add_argument("--lake", required=True)
    ld.add_argument("--audit", required=True)
    ld.add_argument("--long_rows", choices=("fail", "quarantine"))
    ld.add_argument("--multi_line", choices=("true", "false"),
                    help="whether fields may hold line breaks (default: as the feed declares); files of a feed without them split")
    ld.add_argument("--reconcile", choices=("rows", "content"), help="compare the target's row count, or all its values")
    ld.add_argument("--jdbc_url", help="also replace a database table with the loaded snapshot")
    ld.add_argument("--jdbc_table")
    ld.add_argument("--jdbc_user")
    it = sub.add_parser("intake", help="load files as they land")
    src = it.add_mutually_exclusive_group(required=True)
    src.add_argument("--landing", help="folder to list for new files")
    src.add_argument("--events", help="folder of object-store notification records (JSON) instead")
    it.add_argument("--scheme", default="s3", help="scheme of the locations that records name")
    it.add_argument("--jdbc_url", help="database that gets a copy of every feed's snapshot, in the table named like its target")
    it.add_argument("--jdbc_user")
    it.add_argument("--lake", required=True)
    it.add_argument("--audit", required=True)
    it.add_argument("--checkpoint", help="default: a folder under spark.checkpoint.dir")
    it.add_argument("--glob")
    it.add_argument("--unit", choices=("file", "directory"), default="file")
    it.add_argument("--marker", help="name of the file that a producer writes last into a landed folder (unit directory)")
    it.add_argument("--poll", help="poll interval; without it, take what has landed and stop")
    it.add_argument("--archive_dir")
    co = sub.add_parser("compact", help="put the audit's rows into few files")
    co.add_argument("--audit", required=True)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"landfall-{a.cmd}").getOrCreate()
    if a.cmd == "compact":
        print(json.dumps({"epoch": compact_audit(spark, a.audit)}))
        return 0
    if a.cmd == "load":
        spec = BY_NAME[a.feed]
        opts = {k: v for k in ("long_rows", "reconcile") if (v := getattr(a, k))}
        if a.multi_line:
            opts["multi_line"] = a.multi_line == "true"
        out = run_load(spark, spec.with_options(**opts), a.input_path, lake_root=a.lake, audit_root=a.audit,
                       jdbc=jdbc_options(a.jdbc_url, a.jdbc_table or spec.target, a.jdbc_user))
        print(json.dumps(asdict(out), default=str))
        return 0 if out.status == "SUCCEEDED" else 1
    jdbc = {s.name: o for s in ALL_FEEDS if (o := jdbc_options(a.jdbc_url, s.target, a.jdbc_user))}
    if a.events:
        q = start_notified_intake(spark, a.events, ALL_FEEDS, lake_root=a.lake, audit_root=a.audit, checkpoint=a.checkpoint,
                                  scheme=a.scheme, available_now=a.poll is None, processing_time=a.poll, jdbc=jdbc)
        q.awaitTermination()
        return 0
    q = start_intake(spark, a.landing, ALL_FEEDS, lake_root=a.lake, audit_root=a.audit,
                     checkpoint=a.checkpoint, glob=a.glob, unit=a.unit,
                     available_now=a.poll is None, processing_time=a.poll, archive_dir=a.archive_dir, jdbc=jdbc, marker=a.marker)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
