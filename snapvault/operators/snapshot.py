"""Taking snapshots."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.functions.naming import snapshot_name, wall_clock, wall_clock_lit
from snapvault.lakehouse import Lakehouse
from snapvault.operators.audit import MANIFEST, RunLog, append_logs, manifest, read_items
from snapvault.operators.filecopy import copy_files
from snapvault.operators.items import file_items, items_frame, now
from snapvault.operators.tables import copy_tables, failed_table, message
from snapvault.operators.verify import verify_snapshot
from snapvault.plans.verify import verdict
from snapvault.session import configure
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import child_directories, walk
from snapvault.sources.tables import discover_tables, literal


@dataclass(frozen=True)
class Source:
    """One lakehouse to snapshot, with the names that go into the snapshot's name."""

    lakehouse: Lakehouse
    lakehouse_name: str
    workspace_name: str


@dataclass(frozen=True)
class SnapshotRun:
    path: str
    items: DataFrame
    manifest: DataFrame


def name_of(spark: SparkSession, source: Source, at: datetime) -> str:
    for value in (source.lakehouse_name, source.workspace_name):
        if not value or not value.strip():
            raise ValueError("lakehouse_name and workspace_name are required")
        if "/" in value:
            raise ValueError(f"a name must not contain a slash: {value}")
    names = F.lit(source.lakehouse_name.strip()), F.lit(source.workspace_name.strip())
    name = snapshot_name(*names, wall_clock_lit(at))
    return spark.sql("VALUES (1)").select(name).head()[0]


def _table_paths(spark: SparkSession, lakehouse: Lakehouse) -> tuple[dict[str, str], list[dict]]:
    """Names and paths of the tables (one small row per table), and records of those that cannot be read."""
    if not Folders(spark).exists(lakehouse.tables):
        return {}, []
    found = child_directories(spark, lakehouse.tables)
    inside = F.concat("path", F.lit("/")).alias("path")
    names = sorted(r["name"] for r in discover_tables(found.where("error IS NULL").select(inside), lakehouse.tables).collect())
    unread = [failed_table(r["name"], r["error"], source_path=r["path"]) for r in found.where("error IS NOT NULL").collect()]
    return {name: f"{lakehouse.tables}/{name}" for name in names}, unread


def _copy_files(spark: SparkSession, source_root: str, target_root: str, started: datetime) -> DataFrame:
    listing = walk(spark, source_root)
    files = listing.where("NOT is_directory AND error IS NULL")
    status = copy_files(spark, files, source_root, target_root)
    # A folder that could not be listed is a failure too, not a smaller snapshot.
    unread = listing.where("error IS NOT NULL").select(
        "relative_path",
        F.lit(None).cast("bigint").alias("size"),
        F.lit("failed").alias("status"),
        F.lit(None).cast("bigint").alias("written_bytes"),
        "error",
    )
    return file_items(status.unionByName(unread, allowMissingColumns=True), source_root, target_root, "file_copy", started)


def snapshot(
    spark: SparkSession,
    source: Source,
    backup_root: str,
    at: datetime | None = None,
    tables: bool = True,
    files: bool = True,
    table_paths: dict[str, str] | None = None,
    source_fmt: str = "parquet",
    fmt: str = "parquet",
    verify: str | None = "counts",
    width: int = 8,
) -> SnapshotRun:
    """Copy the tables and files of a lakehouse into a new snapshot folder below ``backup_root``.

    ``table_paths`` names tables that lie elsewhere; by default the folders below ``Tables/`` are
    taken. ``verify`` is ``counts``, ``content`` (of tables and files) or None. The manifest is written last and marks
    the snapshot as complete. Single tables or files that fail are rows with status ``failed``.
    """
    if verify not in ("counts", "content", None):
        raise ValueError(f"unknown verification: {verify}")
    configure(spark)
    folders, log, started = Folders(spark), RunLog(), now()
    at = at or started
    name = name_of(spark, source, at)
    path = f"{backup_root.rstrip('/')}/{name}"
    if folders.exists(path):
        raise FileExistsError(path)
    folders.make(path)
    log.add(f"snapshot of {source.lakehouse.root} to {path}")

    records = []
    if tables:
        paths, unread = (table_paths, []) if table_paths is not None else _table_paths(spark, source.lakehouse)
        records = unread + copy_tables(spark, paths, f"{path}/tables", source_fmt, fmt, width=width)
        for row in records:
            level = "INFO" if row["status"] == "success" else "ERROR"
            log.add(f"table {row['name']}: {row['status']} {row['error'] or row['row_count']}", level)
    items = items_frame(spark, records)
    if files and folders.exists(source.lakehouse.files):
        items = items.unionByName(_copy_files(spark, source.lakehouse.files, f"{path}/files", started))
    items.write.parquet(f"{path}/_items")

    passed = None
    if verify:
        passed = verdict(*verify_snapshot(spark, path, verify == "content", fmt, width)).head()["overall_success"]
        log.add(f"verification by {verify}: {'passed' if passed else 'FAILED'}", "INFO" if passed else "ERROR")
    log.write(spark, f"{path}/_logs")
    append_logs(log.frame(spark), f"{backup_root.rstrip('/')}/_run_logs", name)
    about = {
        "backup_folder_name": name,
        "backup_timestamp": wall_clock(at).replace(tzinfo=timezone.utc),
        "source_lakehouse_name": source.lakehouse_name,
        "source_workspace_name": source.workspace_name,
        "backup_root": backup_root,
        "verification_passed": passed,
    }
    if passed is False:
        about["status"] = "failed"
    manifest(read_items(spark, path), started, **about).write.parquet(f"{path}/_manifest")
    return SnapshotRun(path, read_items(spark, path), spark.read.schema(MANIFEST).parquet(f"{literal(path)}/_manifest"))


def snapshot_many(spark: SparkSession, sources: list[Source], backup_root: str, **options) -> DataFrame:
    """Snapshot several lakehouses, one after the other; the failure of one does not stop the next.

    Returns the item records of all of them with ``source`` and ``snapshot``; a source that fails
    as a whole is one row of kind ``run``.
    """
    done = None
    for source in sources:
        try:
            run = snapshot(spark, source, backup_root, **options)
            rows, path = run.items, run.path
        except Exception as error:
            values = (("run", source.lakehouse_name, "failed", message(error)))
            rows = spark.createDataFrame([values], "kind string, name string, status string, error string")
            path = None
        rows = rows.withColumn("source", F.lit(source.lakehouse_name)).withColumn("snapshot", F.lit(path))
        done = rows if done is None else done.unionByName(rows, allowMissingColumns=True)
    return done
