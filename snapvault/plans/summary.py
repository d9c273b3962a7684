"""Roll-ups over file inventories, status rows and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_totals(inventory: DataFrame) -> DataFrame:
    files = inventory.where("NOT is_directory") if "is_directory" in inventory.columns else inventory
    return files.agg(
        F.count(F.lit(1)).alias("total_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size")
    )


def file_type_summary(inventory: DataFrame) -> DataFrame:
    files = inventory.where("NOT is_directory") if "is_directory" in inventory.columns else inventory
    return files.groupBy("type").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("size"))


def run_summary(items: DataFrame, *by: str) -> DataFrame:
    """Succeeded, failed and skipped items per kind (and per ``by``)."""
    status = lambda s: F.count_if(F.col("status") == s)
    return items.groupBy(*by, "kind").agg(
        status("success").alias("succeeded"), status("failed").alias("failed"), status("skipped").alias("skipped")
    )


def run_status(succeeded, failed):
    """``success``, ``partial``, ``failed`` or ``empty`` from two counts."""
    return (
        F.when((succeeded == 0) & (failed == 0), F.lit("empty"))
        .when(failed == 0, F.lit("success"))
        .when(succeeded == 0, F.lit("failed"))
        .otherwise(F.lit("partial"))
    )


def snapshot_counts(items: DataFrame, *by: str, profiles: bool = False) -> DataFrame:
    """The counting part of a run manifest: one row per run.

    ``profiles`` adds the list of tables, for the manifest of a single run: each of them was a Spark
    job of its own, so the list is short.
    """
    table, file = F.col("kind") == "table", F.col("kind") == "file"
    done, failed = F.col("status") == "success", F.col("status") == "failed"
    about = ("name", "row_count", "column_count", "columns", "schema_json", "error")
    listed = F.sort_array(F.collect_list(F.when(table, F.struct(*about)))) if profiles else None
    counts = items.groupBy(*by).agg(
        F.count_if(table).alias("tables_discovered"),
        F.count_if(file).alias("files_discovered"),
        F.count_if(table & done).alias("tables_backed_up"),
        F.count_if(table & failed).alias("tables_failed"),
        F.count_if(file & done).alias("files_backed_up"),
        F.count_if(file & failed).alias("files_failed"),
        F.coalesce(F.sum(F.when(table & done, F.col("row_count"))), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(file, F.col("size_bytes"))), F.lit(0)).alias("total_size"),
        *([listed.alias("tables_info")] if profiles else []),
    )
    ok = F.col("tables_backed_up") + F.col("files_backed_up")
    bad = F.col("tables_failed") + F.col("files_failed")
    return counts.withColumn("status", run_status(ok, bad))


def restore_counts(items: DataFrame, *by: str) -> DataFrame:
    table, file = F.col("kind") == "table", F.col("kind") == "file"
    status = lambda s: F.col("status") == s
    counts = items.groupBy(*by).agg(
        F.count_if(table & status("success")).alias("tables_restored"),
        F.count_if(table & status("failed")).alias("tables_failed"),
        F.count_if(table & status("skipped")).alias("tables_skipped"),
        F.count_if(file & status("success")).alias("files_restored"),
        F.count_if(file & status("failed")).alias("files_failed"),
        F.count_if(file & status("skipped")).alias("files_skipped"),
        F.coalesce(F.sum(F.when(file & status("success"), F.col("size_bytes"))), F.lit(0)).alias("total_size"),
    )
    ok = F.col("tables_restored") + F.col("files_restored")
    bad = F.col("tables_failed") + F.col("files_failed")
    return counts.withColumn("status", run_status(ok, bad))


def without_debug(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("level") != "DEBUG")


def log_rollup(logs: DataFrame) -> DataFrame:
    """Log lines per day and level; DEBUG is left out. Lines that have a ``day`` are counted by it."""
    day = F.col("day") if "day" in logs.columns else F.to_date("timestamp")
    return without_debug(logs).groupBy(day.alias("day"), "level").agg(F.count(F.lit(1)).alias("n"))
