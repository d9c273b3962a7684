"""Finding, and on demand deleting, expired snapshots."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.functions.files import format_size
from snapvault.operators.audit import RunLog, append_logs, write_cleanup_log
from snapvault.operators.filecopy import delete_paths
from snapvault.operators.items import now
from snapvault.plans.retention import retention_plan, retention_result, retention_summary
from snapvault.session import settled
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import child_directories, folder_sizes, only_files, walk
from snapvault.sources.workers import LINKED, resolve


BULK_FILES = 50_000  # files of one folder that one call removes


@dataclass(frozen=True)
class RetentionRun:
    plan: DataFrame
    summary: DataFrame
    deletions: DataFrame | None
    result: DataFrame


def snapshot_catalogue(spark: SparkSession, root: str, sizes: bool = True) -> DataFrame:
    """``name``, ``path``, ``size_bytes`` and ``error`` of each snapshot folder below ``root``.

    Hidden folders inside a snapshot count towards its size. A snapshot that cannot be listed in
    full has no size, but an error; so has a folder that is a link, which is never followed nor deleted.
    """
    folders = child_directories(spark, root)
    if not sizes:
        return folders.select("name", "path", F.lit(None).cast("bigint").alias("size_bytes"), "error")
    starts = folders.where("error IS NULL").select(F.col("name").alias("relative_path"))
    found = folder_sizes(walk(spark, root, include_hidden=True, starts=starts)).withColumnRenamed("error", "fault")
    error = F.coalesce("error", "fault")
    size = F.when(error.isNull(), F.coalesce("size_bytes", F.lit(0)))
    return folders.join(found, "name", "left").select("name", "path", size.alias("size_bytes"), error.alias("error"))


def spare_links(plan: DataFrame) -> DataFrame:
    """Folders that are links stay: what they lead to is not below the root."""
    linked = F.coalesce(F.col("error") == LINKED, F.lit(False))
    return plan.withColumn("action", F.when(linked & (F.col("action") == "delete"), F.lit("retain")).otherwise(F.col("action")))


def delete_snapshots(spark: SparkSession, root: str, plan: DataFrame, by_file: bool | None = None) -> DataFrame:
    """Delete the folders whose ``action`` is ``delete``; ``name``, ``status``, ``size_bytes``, ``error``.

    Only direct children of ``root`` whose name carries a time are ever touched. Their manifests go first, so that a run
    that ends halfway leaves no snapshot that looks finished. Where removing a folder means removing file by file, the
    folders that hold files are spread over the cluster and each is emptied in one call, very large ones file by file;
    on HDFS a snapshot is one call.
    """
    doomed = plan.where((F.col("action") == "delete") & F.col("ts").isNotNull() & ~F.col("name").contains("/"))
    doomed = doomed.select("name", "size_bytes")
    doomed = settled(doomed, "doomed")
    markers = delete_paths(spark, doomed.select(F.concat("name", F.lit("/_manifest")).alias("relative_path")), root, True)
    held = markers.where("status = 'failed'").select(F.substring_index("relative_path", "/", 1).alias("name"), "error")
    kept = doomed.join(held, "name").select("name", F.lit("failed").alias("status"), "size_bytes", "error")
    doomed = settled(doomed.join(held, "name", "left_anti"), "doomed")
    starts = doomed.select(F.col("name").alias("relative_path"))
    if by_file is None:
        by_file = resolve(Folders(spark).qualified(root))[0].type_name != "hdfs"
    failures = None
    if by_file:
        listing = walk(spark, root, include_hidden=True, starts=starts)
        parent = F.expr("left(relative_path, length(relative_path) - length(name) - 1)")
        files = only_files(listing).where("error IS NULL").withColumn("folder", parent)
        inner = listing.where("is_directory AND error IS NULL").select(parent.alias("folder")).distinct()
        sizes = files.groupBy("folder").agg(F.count("*").alias("n")).join(inner, "folder", "left_anti")
        bulk = settled(sizes.where(F.col("n") <= BULK_FILES).select("folder"), "bulk")
        single = files.join(bulk, "folder", "left_anti")
        gone = delete_paths(spark, bulk.select(F.col("folder").alias("relative_path")), root, directories=True)
        gone = gone.unionByName(delete_paths(spark, single, root, directories=False)).where("status = 'failed'")
        failures = gone.groupBy(F.substring_index("relative_path", "/", 1).alias("name")).agg(
            F.min("error").alias("file_error")
        )
    folders = delete_paths(spark, starts, root, directories=True).withColumnRenamed("relative_path", "name")
    rows = doomed.join(folders, "name")
    if failures is not None:
        rows = rows.join(failures, "name", "left")
        # What the folder call removed after all is no failure.
        rows = rows.withColumn("error", F.when(F.col("status") == "failed", F.coalesce("file_error", "error")))
    return rows.select("name", "status", "size_bytes", "error").unionByName(kept)


def retain(
    spark: SparkSession,
    root: str,
    as_of: datetime | None = None,
    retention_days: int = 30,
    pattern: str = "",
    dry_run: bool = True,
    strict: bool = False,
    write_log: bool = False,
    sizes: bool = True,
) -> RetentionRun:
    """Apply the retention policy; nothing is deleted unless ``dry_run`` is False.

    ``sizes=False`` saves the walk through every snapshot when the freed bytes are of no interest.
    """
    started, log = now(), RunLog()
    catalogue = snapshot_catalogue(spark, root, sizes)
    plan = settled(spare_links(retention_plan(catalogue, as_of or started, retention_days, pattern, strict)), "plan")
    deletions = None if dry_run else delete_snapshots(spark, root, plan)
    result = retention_result(plan, deletions)
    if write_log:
        row = result.withColumn("freed", format_size(F.col("space_freed_bytes"))).head()
        log.add(
            f"{row['status']}: {row['total_backups']} snapshots, {row['expired_backups']} expired, "
            f"{row['deleted_backups']} deleted, {row['failed_deletions']} failed, {row['freed']} freed",
            "INFO" if row["status"] == "success" else "ERROR",
        )
        append_logs(log.frame(spark), f"{root}/_run_logs", f"cleanup_{started.strftime('%Y-%m-%d_%H-%M-%S')}")
        write_cleanup_log(
            spark, log, root, started, retention_days=retention_days, dry_run=dry_run, name_pattern=pattern
        )
    return RetentionRun(plan, retention_summary(plan), deletions, result)
