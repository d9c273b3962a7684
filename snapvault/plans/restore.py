"""What a restore would do, as pure expressions over inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.functions.files import matches_any

# Folders that may hold an archive in a binary column.
ARCHIVE_TABLES = ("complete_backup_zip_data", "files_backup_zip_data", "lakehouse_complete_backup_zip_data")


def detect_layout(inventory: DataFrame, snapshot: Column) -> DataFrame:
    """Layout of each snapshot from its entries (``relative_path`` inside the snapshot, folders with a slash at the end).

    ``direct_copy`` when ``tables/`` holds a folder that is not hidden, or the snapshot has item records; then ``zip_file``
    for an archive at the top, then ``zip_in_table``, else ``unknown``. The paths of files alone do as well.
    """
    path = F.col("relative_path")
    top = ~path.contains("/")
    in_tables = path.rlike(r"\Atables/[^_/][^/]*/") | path.startswith("_items/")
    archive = top & path.endswith(".zip")
    in_table = F.substring_index(path, "/", 1).isin(*ARCHIVE_TABLES) & ~top
    manifest = path.startswith("_manifest/")
    flags = inventory.groupBy(snapshot.alias("snapshot")).agg(
        F.bool_or(in_tables).alias("has_tables"),
        F.bool_or(archive).alias("has_zip_file"),
        F.bool_or(in_table).alias("has_zip_data"),
        F.bool_or(manifest).alias("has_manifest"),
    )
    layout = (
        F.when(F.col("has_tables"), F.lit("direct_copy"))
        .when(F.col("has_zip_file"), F.lit("zip_file"))
        .when(F.col("has_zip_data"), F.lit("zip_in_table"))
        .otherwise(F.lit("unknown"))
    )
    return flags.withColumn("layout", layout)


def select_names(items: DataFrame, names: list[str] | None, column: str = "name") -> DataFrame:
    """Keep the items named in the list; no list keeps all."""
    if not names:
        return items
    wanted = items.sparkSession.createDataFrame([(n,) for n in dict.fromkeys(names)], f"{column} string")
    return items.join(wanted, column, "left_semi")


def select_files(files: DataFrame, patterns: list[str] | None) -> DataFrame:
    """Keep files whose relative path matches any shell pattern; no pattern keeps all."""
    return files.where(matches_any(F.col("relative_path"), patterns)) if patterns else files


def snapshot_tables(names: DataFrame) -> DataFrame:
    """Folders of a snapshot without item records that are tables; ``*_metadata`` are side-cars."""
    return names.where(~F.col("name").startswith("_") & ~F.col("name").endswith("_metadata"))


def restore_plan(source: DataFrame, target: DataFrame, overwrite: bool, key: str = "name") -> DataFrame:
    """Adds ``action`` to the source items: ``skip`` when the target has one and must keep it."""
    existing = target.select(key, F.lit(True).alias("exists_at_target"))
    action = F.when(F.col("exists_at_target") & ~F.lit(overwrite), F.lit("skip")).otherwise(F.lit("restore"))
    return source.join(existing, key, "left").withColumn("action", action).drop("exists_at_target")


def files_to_restore(source: DataFrame, target: DataFrame, overwrite: bool) -> DataFrame:
    """Files to copy: all of them, or only those the target does not have."""
    if overwrite:
        return source
    return source.join(target.select("relative_path"), "relative_path", "left_anti")


def below_unread(files: DataFrame, unread: DataFrame) -> DataFrame:
    """Files in or below a folder (``relative_path``, empty for the root) that could not be listed, with its ``error``."""
    parts = F.split("relative_path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    faults = unread.groupBy(F.col("relative_path").alias("folder")).agg(F.min("error").alias("error"))
    met = files.select("relative_path", F.explode(above).alias("folder")).join(faults, "folder")
    return met.groupBy("relative_path").agg(F.min("error").alias("error"))


def archive_format(preference: str, has_parquet: Column, has_csv: Column) -> Column:
    """Format to restore a table from; falls back only to a format that is there, else ``none``."""
    order = {"csv": ("csv", "parquet")}.get(preference, ("parquet", "csv"))
    if preference not in ("auto", "parquet", "csv"):
        raise ValueError(f"unknown format preference: {preference}")
    there = {"parquet": has_parquet, "csv": has_csv}
    first, second = order
    return F.when(there[first], F.lit(first)).when(there[second], F.lit(second)).otherwise(F.lit("none"))
