"""The jobs from the command line; each prints its result as one JSON document.

spark-submit --py-files snapvault.zip snapvault/__main__.py backup --help
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from snapvault import (
    Lakehouse,
    Source,
    clean_scratch,
    file_inventory,
    file_type_summary,
    newest_snapshot,
    profile_tables,
    restore,
    retain,
    snapshot,
    verify_snapshot,
)
from snapvault.plans.retention import delete_list, keep_list
from snapvault.plans.verify import verdict
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import child_directories


def _row(df: DataFrame) -> dict:
    row = df.head().asDict(recursive=True)
    row.pop("tables_info", None)
    return row


def backup(spark: SparkSession, args: argparse.Namespace) -> dict:
    source = Source(Lakehouse(args.source), args.lakehouse_name, args.workspace_name)
    run = snapshot(
        spark,
        source,
        args.backup_root,
        args.at,
        tables=not args.no_tables,
        files=not args.no_files,
        source_fmt=args.format,
        fmt=args.format,
        verify=None if args.verify == "none" else args.verify,
        width=args.width,
    )
    return {"backup_path": run.path} | _row(run.manifest)


def restored(spark: SparkSession, args: argparse.Namespace) -> dict:
    snapshot_path = args.snapshot
    if snapshot_path is None:
        if not args.backup_root or not args.source:
            raise SystemExit("restore needs --snapshot, or --backup-root and --source")
        as_of = args.as_of or datetime.now(timezone.utc)
        snapshot_path = newest_snapshot(spark, args.backup_root, args.source, as_of)
        if snapshot_path is None:
            return {"status": "failed", "error": f"no finished snapshot of {args.source} up to {as_of}"}
    run = restore(
        spark,
        snapshot_path,
        Lakehouse(args.target),
        tables=not args.no_tables,
        files=not args.no_files,
        overwrite=not args.keep_existing,
        table_names=args.table,
        file_patterns=args.file,
        dry_run=args.dry_run,
        preference=args.prefer,
        require_manifest=not args.without_manifest,
        source_fmt=args.format,
        fmt=args.format,
        verify=None if args.verify == "none" else args.verify,
        width=args.width,
    )
    if run.manifest is not None:
        return _row(run.manifest)
    counts = run.items.groupBy("kind", "status").count().collect()
    return {"status": "success", "dry_run": True, "layout": run.layout, "plan": [r.asDict() for r in counts]}


def cleanup(spark: SparkSession, args: argparse.Namespace) -> dict:
    run = retain(
        spark,
        args.backup_root,
        args.as_of,
        args.retention_days,
        args.name_pattern,
        dry_run=not args.delete,
        strict=args.strict,
        write_log=args.write_log,
    )
    told = ("name", "size_bytes", "age_days")
    doomed = delete_list(run.plan).select(*told).toLocalIterator()  # printed, oldest first
    newest = keep_list(run.plan, 10).select(*told).collect()
    failures = [] if run.deletions is None else run.deletions.where("status = 'failed'").select("name", "error").collect()
    return (
        _row(run.summary)
        | _row(run.result)
        | {
            "to_delete": [r.asDict() for r in doomed],
            "newest_kept": [r.asDict() for r in newest],
            "failed": [r.asDict() for r in failures],
        }
    )


def verify(spark: SparkSession, args: argparse.Namespace) -> dict:
    tables, files = verify_snapshot(spark, args.snapshot, not args.counts_only, args.format, args.width)
    row = _row(verdict(tables, files))
    return {"status": "success" if row["overall_success"] else "failed"} | row


def profile(spark: SparkSession, args: argparse.Namespace) -> dict:
    lake = Lakehouse(args.source)
    found = child_directories(spark, lake.tables).where("error IS NULL").collect()  # one small row per table
    tables = profile_tables(spark, {r["name"]: r["path"] for r in found}, args.format, args.width).collect()
    types = file_type_summary(file_inventory(spark, lake.files)).collect() if Folders(spark).exists(lake.files) else []
    bad = any(r["error"] for r in tables)
    return {
        "status": "failed" if bad else "success",
        "tables": [{k: r[k] for k in ("name", "row_count", "column_count", "columns", "error")} for r in tables],
        "files": [r.asDict() for r in types],
    }


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="snapvault")
    jobs = top.add_subparsers(required=True)

    def job(name, function, *names):
        sub = jobs.add_parser(name)
        sub.set_defaults(function=function)
        for option in names:
            sub.add_argument(option, required=True)
        sub.add_argument("--format", default="parquet")
        sub.add_argument("--width", type=int, default=8, help="tables in flight at the same time")
        return sub

    sub = job("backup", backup, "--source", "--lakehouse-name", "--workspace-name", "--backup-root")
    sub.add_argument("--at", type=datetime.fromisoformat)
    sub.add_argument("--no-tables", action="store_true")
    sub.add_argument("--no-files", action="store_true")
    sub.add_argument("--verify", choices=("counts", "content", "none"), default="counts")

    sub = job("restore", restored, "--target")
    sub.add_argument("--snapshot", help="path of the snapshot; or name a source below a backup root")
    sub.add_argument("--backup-root")
    sub.add_argument("--source", help="what the names of its snapshots begin with")
    sub.add_argument("--as-of", type=datetime.fromisoformat, help="newest snapshot not later than this")
    sub.add_argument("--no-tables", action="store_true")
    sub.add_argument("--no-files", action="store_true")
    sub.add_argument("--keep-existing", action="store_true")
    sub.add_argument("--table", action="append", help="restore only this table; may be repeated")
    sub.add_argument("--file", action="append", help="restore only files that match; may be repeated")
    sub.add_argument("--dry-run", action="store_true")
    sub.add_argument("--prefer", choices=("auto", "parquet", "csv"), default="auto")
    sub.add_argument("--without-manifest", action="store_true")
    sub.add_argument("--verify", choices=("counts", "content", "none"), default="counts")

    sub = job("cleanup", cleanup, "--backup-root")
    sub.add_argument("--as-of", type=datetime.fromisoformat)
    sub.add_argument("--retention-days", type=int, default=30)
    sub.add_argument("--name-pattern", default="")
    sub.add_argument("--delete", action="store_true", help="without it nothing is deleted")
    sub.add_argument("--strict", action="store_true")
    sub.add_argument("--write-log", action="store_true")

    job("profile", profile, "--source")

    sub = job("verify", verify, "--snapshot")
    sub.add_argument("--counts-only", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("snapvault").getOrCreate()
    try:
        result = args.function(spark, args)
    finally:
        clean_scratch(spark)
    print(json.dumps(result, default=str))
    return 0 if result.get("status") in ("success", "empty") else 1


if __name__ == "__main__":
    sys.exit(main())
