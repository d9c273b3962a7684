"""Run logs, manifests and clean-up logs: written per run, read over all runs."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.operators.items import ITEMS, fields_of, now
from snapvault.plans.summary import restore_counts, snapshot_counts, without_debug
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import child_directories
from snapvault.sources.tables import literal

LOG = "timestamp string, level string, message string"

# The columns of manifests and clean-up logs, and the kinds of run further below.
MANIFEST = (
    "backup_id string, backup_folder_name string, backup_timestamp timestamp, backup_type string, "
    "source_lakehouse_name string, source_workspace_name string, backup_root string, backup_method string, "
    "tables_discovered bigint, files_discovered bigint, tables_backed_up bigint, tables_failed bigint, "
    "files_backed_up bigint, files_failed bigint, total_rows bigint, total_size bigint, "
    "tables_info array<struct<name:string,row_count:bigint,column_count:int,columns:array<string>,schema_json:string,"
    "error:string>>, status string, "
    "verification_passed boolean, start_time timestamp, end_time timestamp, duration_seconds double"
)

RESTORE_MANIFEST = (
    "restore_id string, restore_timestamp timestamp, source_backup_path string, backup_folder_name string, "
    "target_root string, restore_type string, dry_run boolean, backup_type string, restore_method string, "
    "tables_restored bigint, tables_failed bigint, tables_skipped bigint, files_restored bigint, "
    "files_failed bigint, files_skipped bigint, total_size bigint, status string, verification_passed boolean, "
    "start_time timestamp, end_time timestamp, duration_seconds double"
)

CLEANUP_LOG = (
    "cleanup_timestamp string, "
    "parameters struct<backup_root:string,retention_days:int,dry_run:boolean,name_pattern:string>, "
    "log_entries array<struct<timestamp:string,level:string,message:string>>"
)


class RunLog:
    """The few lines a run has to say; written next to its results."""

    def __init__(self):
        self.rows: list[tuple[str, str, str]] = []

    def add(self, text: str, level: str = "INFO") -> None:
        self.rows.append((now().strftime("%Y-%m-%d %H:%M:%S"), level, text))

    def frame(self, spark: SparkSession) -> DataFrame:
        columns = list(zip(*self.rows)) or [(), (), ()]
        names = ("timestamp", "level", "message")
        return without_debug(spark.createDataFrame(pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, columns)})))

    def write(self, spark: SparkSession, path: str) -> None:
        self.frame(spark).coalesce(1).write.parquet(path)


def read_logs(spark: SparkSession, root: str, folder: str = "_logs") -> DataFrame:
    """The log lines of every run below ``root``."""
    run = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
    return spark.read.schema(LOG).parquet(f"{literal(root)}/*/{folder}").select("*", run.alias("run"))


def log_events(events: DataFrame, timestamp: Column, level: Column, text: Column) -> DataFrame:
    """Any event stream as log lines with a typed time; DEBUG lines are dropped."""
    return without_debug(events.select(timestamp.alias("timestamp"), level.alias("level"), text.alias("message")))


def log_table(events: DataFrame, timestamp: Column, level: Column, text: Column) -> DataFrame:
    """Any event stream in the shape of the run log, with the time as text."""
    written = F.substring(F.col("timestamp").cast("string"), 1, 19)
    return log_events(events, timestamp, level, text).withColumn("timestamp", written)


def append_logs(logs: DataFrame, path: str, run: str) -> None:
    """Append the lines of a run to one log table of all runs, partitioned by day."""
    rows = without_debug(logs).select("*", F.lit(run).alias("run"), F.to_date(F.substring("timestamp", 1, 10)).alias("day"))
    rows.coalesce(1).write.mode("append").partitionBy("day").parquet(path)


def older_records(spark: SparkSession, snapshot: str) -> dict[str, dict]:
    """What a snapshot without item records says of its tables in ``<table>_metadata`` folders: the row count."""
    folders, found = Folders(spark), {}
    if not folders.exists(f"{snapshot}/tables"):
        return found
    cards = child_directories(spark, f"{snapshot}/tables").where("endswith(name, '_metadata') AND error IS NULL")
    for row in cards.collect():  # one small row per table
        card = spark.read.parquet(literal(row["path"]))
        if "row_count" in card.columns:
            first = card.select(F.col("row_count").cast("bigint").alias("n")).head()
            found[row["name"].removesuffix("_metadata")] = {"row_count": first["n"] if first else None}
    return found


def _typed(df: DataFrame, values: dict, schema: str) -> DataFrame:
    """``df`` plus literal columns, in the order and types of ``schema``."""
    pick = lambda f: F.lit(values[f.name]) if f.name in values else F.col(f.name)
    return df.select(*[pick(f).cast(f.dataType).alias(f.name) for f in fields_of(schema)])


def _times(started: datetime) -> dict:
    ended = now()
    return {"start_time": started, "end_time": ended, "duration_seconds": (ended - started).total_seconds()}


def manifest(items: DataFrame, started: datetime, **about) -> DataFrame:
    """The manifest row of a snapshot run, from its item records."""
    values = {
        "backup_id": about["backup_folder_name"],
        "backup_type": "complete_lakehouse_direct_copy",
        "backup_method": "direct_copy",
        **_times(started),
        **about,
    }
    return _typed(snapshot_counts(items, profiles=True), values, MANIFEST)


def restore_manifest(items: DataFrame, started: datetime, **about) -> DataFrame:
    """The manifest row of a restore run, from its item records."""
    values = {"restore_type": "complete_lakehouse_restore", **_times(started), **about}
    return _typed(restore_counts(items), values, RESTORE_MANIFEST)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """The manifests of all snapshots below ``root``; columns an old one lacks are null."""
    return spark.read.schema(MANIFEST).parquet(f"{literal(root)}/*/_manifest")


def read_items(spark: SparkSession, snapshot: str) -> DataFrame:
    return spark.read.schema(ITEMS).parquet(f"{literal(snapshot)}/_items")


def cleanup_documents(runs: DataFrame) -> DataFrame:
    """One JSON document per clean-up run (``cleanup_timestamp``, ``parameters``, ``log_entries``)."""
    return runs.select(F.to_json(F.struct("cleanup_timestamp", "parameters", "log_entries")).alias("value"))


def write_cleanup_log(spark: SparkSession, log: RunLog, root: str, started: datetime, **parameters) -> str:
    name = f"cleanup_log_{started.strftime('%Y-%m-%d_%H-%M-%S')}.json"
    path = f"{root}/_cleanup_logs/{name}"
    row = (
        started.isoformat(),
        (root, parameters["retention_days"], parameters["dry_run"], parameters["name_pattern"]),
        log.rows,
    )
    cleanup_documents(spark.createDataFrame([row], CLEANUP_LOG)).coalesce(1).write.mode("overwrite").text(path)
    return path


def read_cleanup_logs(spark: SparkSession, folder: str) -> DataFrame:
    """All clean-up logs below ``folder`` as one row per log entry."""
    lines = spark.read.option("recursiveFileLookup", True).text(literal(folder))
    documents = lines.select(F.from_json("value", CLEANUP_LOG).alias("d")).select("d.*")
    return documents.select(
        "cleanup_timestamp",
        "parameters.retention_days",
        "parameters.dry_run",
        "parameters.name_pattern",
        F.explode_outer("log_entries").alias("e"),
    ).select("cleanup_timestamp", "retention_days", "dry_run", "name_pattern", "e.timestamp", "e.level", "e.message")
