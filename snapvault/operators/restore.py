"""Restoring snapshots."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.lakehouse import Lakehouse
from snapvault.operators.archive import FALLBACK_TABLE, restore_from_archives, store_binary_archives
from snapvault.operators.audit import (
    RESTORE_MANIFEST,
    RunLog,
    append_logs,
    older_records,
    read_items,
    read_manifests,
    restore_manifest,
)
from snapvault.operators.filecopy import copy_files, kept_files
from snapvault.operators.items import ITEMS, conform, file_items, item, items_frame, now
from snapvault.operators.tables import copy_tables
from snapvault.operators.verify import verify_copied_files, verify_tables
from snapvault.plans.restore import (
    ARCHIVE_TABLES,
    below_unread,
    detect_layout,
    files_to_restore,
    restore_plan,
    select_files,
    select_names,
    snapshot_tables,
)
from snapvault.plans.retention import newest_as_of
from snapvault.plans.verify import refused_tables, verdict
from snapvault.session import configure, settled
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import child_directories, only_files, top_level, walk
from snapvault.sources.tables import literal, scan_table


@dataclass(frozen=True)
class RestoreRun:
    layout: str
    items: DataFrame
    manifest: DataFrame | None


def layout_of(spark: SparkSession, snapshot: str) -> str:
    """Layout of one snapshot folder, from its top two levels only."""
    folders = Folders(spark)
    if not folders.exists(snapshot):
        raise FileNotFoundError(snapshot)
    if folders.exists(f"{snapshot}/_items"):  # one of ours: no listing needed
        return "direct_copy"
    path = F.when(F.col("is_directory"), F.concat("relative_path", F.lit("/"))).otherwise(F.col("relative_path"))
    rows = top_level(spark, snapshot, include_hidden=True).select(path.alias("relative_path"))
    if folders.exists(f"{snapshot}/tables"):
        inside = top_level(spark, f"{snapshot}/tables", include_hidden=True).select(path.alias("relative_path"))
        rows = rows.union(inside.select(F.concat(F.lit("tables/"), "relative_path")))
    found = detect_layout(rows, F.lit(snapshot)).head()
    return found["layout"] if found else "unknown"


def newest_snapshot(spark: SparkSession, root: str, source: str, as_of: datetime) -> str | None:
    """Path of the newest finished snapshot of a source that is not later than ``as_of``.

    ``source`` is what the snapshot names start with, e.g. ``silver1_transform_dev``.
    """
    try:
        finished = read_manifests(spark, root).select(F.col("backup_folder_name").alias("name"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = newest_as_of(finished, as_of).where(F.col("source") == source).head()
    return f"{root.rstrip('/')}/{row['name']}" if row else None


def _archives(spark: SparkSession, snapshot: str) -> DataFrame:
    listing = walk(spark, snapshot, include_hidden=True, recursive=False)
    return listing.where("NOT is_directory AND endswith(name, '.zip')").select("relative_path")


def _existing(spark: SparkSession, folder: str) -> DataFrame:
    if Folders(spark).exists(folder):
        return child_directories(spark, folder, include_hidden=True)
    return spark.createDataFrame([], "name string, path string, error string")


def _restore_tables(spark, snapshot, target, names, overwrite, dry_run, source_fmt, fmt, width, commit) -> list[dict]:
    recorded = Folders(spark).exists(f"{snapshot}/_items")
    if recorded:
        kept = read_items(spark, snapshot).where("kind = 'table' AND status = 'success'")
        records = {r["name"]: r.asDict() for r in kept.collect()}  # one small row per table
        kept = spark.createDataFrame([(n,) for n in records], "name string")
    else:
        kept = snapshot_tables(_existing(spark, f"{snapshot}/tables").select("name"))
        records = older_records(spark, snapshot)
    plan = restore_plan(select_names(kept, names), _existing(spark, target), overwrite)
    rows = sorted(plan.collect(), key=lambda r: r["name"])  # one small row per table
    if dry_run:
        status = {"skip": "skipped", "restore": "dry_run"}
        return [item("table", r["name"], status[r["action"]], target_path=f"{target}/{r['name']}") for r in rows]
    skipped = [
        item("table", r["name"], "skipped", error="exists", target_path=f"{target}/{r['name']}")
        for r in rows
        if r["action"] == "skip"
    ]
    paths = {r["name"]: f"{snapshot}/tables/{r['name']}" for r in rows if r["action"] == "restore"}
    return skipped + copy_tables(spark, paths, target, source_fmt, fmt, overwrite, width, records, commit)


def _restore_files(spark, snapshot, target, patterns, overwrite, dry_run, started) -> DataFrame | None:
    source = f"{snapshot}/files"
    if not Folders(spark).exists(source):
        return None
    listing = walk(spark, source, include_hidden=True)
    files = select_files(listing.where("NOT is_directory AND error IS NULL"), patterns)
    if Folders(spark).exists(target) and not overwrite:
        there = walk(spark, target, include_hidden=True)
        present = there.where("NOT is_directory").select("relative_path")
        # What stands in a folder that cannot be listed is not known, so nothing is written into it.
        unknown = settled(below_unread(files, there.where("is_directory AND error IS NOT NULL")), "unknown")
    else:
        present = spark.createDataFrame([], "relative_path string")
        unknown = None
    values = {"kind": F.lit("file"), "name": F.col("relative_path"), "size_bytes": F.col("size")}
    todo = files_to_restore(files, present, overwrite)
    if unknown is not None:
        todo = todo.join(unknown, "relative_path", "left_anti")
    if dry_run:
        return todo.select(*conform(values | {"status": F.lit("dry_run")}))
    unread = listing.where("error IS NOT NULL")
    aside = unread.select(*conform(values | {"status": F.lit("failed"), "error": F.col("error")}))
    if not overwrite:
        unsafe = F.concat(F.lit("target folder cannot be listed: "), "error")
        blocked = files.drop("error").join(unknown, "relative_path")
        aside = aside.unionByName(blocked.select(*conform(values | {"status": F.lit("failed"), "error": unsafe})))
        skipped = files.join(present, "relative_path", "left_semi").join(unknown, "relative_path", "left_anti")
        skipped = skipped.select(*conform(values | {"status": F.lit("skipped"), "error": F.lit("exists")}))
        aside, todo = settled(aside.unionByName(skipped), "aside"), settled(todo, "todo")
    if Folders(spark).exists(f"{snapshot}/_items"):
        known = read_items(spark, snapshot).where("kind = 'file' AND status = 'success' AND digest IS NOT NULL")
        todo = todo.select("relative_path", "size").join(known.select(F.col("name").alias("relative_path"), "digest"), "relative_path", "left")
    status = copy_files(spark, todo, source, target)
    return file_items(status, source, target, "file_copy", started).unionByName(aside)


def restore(
    spark: SparkSession,
    snapshot: str,
    target: Lakehouse,
    tables: bool = True,
    files: bool = True,
    overwrite: bool = True,
    table_names: list[str] | None = None,
    file_patterns: list[str] | None = None,
    dry_run: bool = False,
    preference: str = "auto",
    require_manifest: bool = True,
    verify: str | None = "counts",
    source_fmt: str = "parquet",
    fmt: str = "parquet",
    width: int = 8,
    commit: str = "rename",
) -> RestoreRun:
    """Restore a snapshot of any layout into a lakehouse.

    A dry run only returns the plan. Otherwise item records, log and manifest are written to
    ``Files/_restore_items_<time>_<id>`` and so on, and the run is checked by ``counts`` or ``content``; a run that does
    not pass is ``failed``. Rows of a snapshot that are not those on its record never take a table's place, nor do files whose
    bytes are not those on record a file's. ``commit`` is how tables are put in place: ``rename`` or ``pointer``.
    """
    configure(spark)
    if verify not in ("counts", "content", None):
        raise ValueError(f"unknown verification: {verify}")
    snapshot, started, log, folders = snapshot.rstrip("/"), now(), RunLog(), Folders(spark)
    stamp = f"{started.strftime('%Y-%m-%d_%H-%M-%S')}_{uuid.uuid4().hex[:8]}"
    layout = layout_of(spark, snapshot)
    if layout == "unknown":
        raise ValueError(f"no tables, archive or archive table found in {snapshot}")
    log.add(f"restore of {snapshot} ({layout}) to {target.root}")
    if layout == "direct_copy":
        if require_manifest and not folders.exists(f"{snapshot}/_manifest"):
            raise ValueError(f"{snapshot} has no manifest: its snapshot did not finish")
        records = []
        if tables:
            args = (snapshot, target.tables, table_names, overwrite, dry_run, source_fmt, fmt, width, commit)
            records = _restore_tables(spark, *args)
        items = items_frame(spark, records)
        if files:
            rows = _restore_files(spark, snapshot, target.files, file_patterns, overwrite, dry_run, started)
            items = items if rows is None else items.unionByName(rows)
    else:
        unpacked = None
        if layout == "zip_file":
            root, archives = snapshot, _archives(spark, snapshot)
        else:
            table = next(f"{snapshot}/{t}" for t in ARCHIVE_TABLES if folders.exists(f"{snapshot}/{t}"))
            held = scan_table(spark, table, source_fmt)
            empty = held.where("zip_binary IS NULL").count()
            held = held.where("zip_binary IS NOT NULL")
            number = F.concat(F.hex(F.xxhash64("zip_binary")), F.lit("-"), F.md5("zip_binary"), F.lit(".zip"))
            root, archives = store_binary_archives(spark, held.select(number.alias("archive"), "zip_binary"))
            unpacked = root
        items = restore_from_archives(
            spark,
            root,
            archives,
            target.tables if tables else None,
            target.files if files else None,
            table_names,
            file_patterns,
            preference,
            overwrite,
            dry_run,
            fmt,
            width,
            stamp,
        )
        if unpacked:
            lost = [item("archive", table, "failed", error="archive without content")] * empty
            items = settled(items.unionByName(items_frame(spark, lost)), "items")
            folders.delete(unpacked)
    if dry_run:
        return RestoreRun(layout, items, None)

    path = f"{target.files}/_restore_items_{stamp}"
    items.write.parquet(path)
    items = spark.read.schema(ITEMS).parquet(literal(path))
    passed = None
    if verify:
        rows_table = f"{target.files}/{FALLBACK_TABLE}"
        kept = None
        if folders.exists(rows_table):
            kept = kept_files(scan_table(spark, rows_table).where(F.col("run_id") == stamp))
        table_checks = verify_tables(spark, items, verify == "content", fmt, width)
        file_checks = verify_copied_files(spark, items, target.files, kept, verify == "content")
        table_checks = table_checks.drop("error").unionByName(refused_tables(items))
        passed = verdict(table_checks, file_checks).head()["overall_success"]
        log.add(f"verification by {verify}: {'passed' if passed else 'FAILED'}", "INFO" if passed else "ERROR")
    log.write(spark, f"{target.files}/_restore_logs_{stamp}")
    append_logs(log.frame(spark), f"{target.files}/_run_logs", stamp)
    about = {
        "restore_id": stamp,
        "restore_timestamp": started,
        "source_backup_path": snapshot,
        "backup_folder_name": snapshot.rsplit("/", 1)[-1],
        "target_root": target.root,
        "dry_run": False,
        "backup_type": layout,
        "restore_method": "read_write" if layout == "direct_copy" else "archive",
        "verification_passed": passed,
    }
    if passed is False:
        about["status"] = "failed"
    manifest_path = f"{target.files}/_restore_manifest_{stamp}"
    restore_manifest(items, started, **about).write.parquet(manifest_path)
    return RestoreRun(layout, items, spark.read.schema(RESTORE_MANIFEST).parquet(literal(manifest_path)))
