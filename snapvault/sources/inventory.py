"""Listing folders and files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapvault.functions.files import file_type
from snapvault.session import scratch_dir
from snapvault.sources.hadoop import Folders
from snapvault.sources.spreading import spread
from snapvault.sources.workers import lister

LISTING = (
    "relative_path string, name string, is_directory boolean, size bigint, "
    "modification_time timestamp, error string, pending boolean"
)

# One task goes on below the directory it was given until either number is reached.
DIRECTORY_BUDGET = 200
ENTRY_BUDGET = 50_000


def walk(
    spark: SparkSession,
    root: str,
    include_hidden: bool = False,
    starts: DataFrame | None = None,
    recursive: bool = True,
    directory_budget: int = DIRECTORY_BUDGET,
    entry_budget: int = ENTRY_BUDGET,
) -> DataFrame:
    """Every entry below ``root`` (or below the directories in ``starts.relative_path``).

    Runs in rounds. Each round lists the directories left over from the round before, spread over
    the cluster by path, and is written to the scratch folder, so a tree of any shape is balanced
    anew every round and a lost executor repeats one round at most. Directories that cannot be
    read give a row with ``error``.
    """
    folders = Folders(spark)
    if not folders.exists(root):
        raise FileNotFoundError(root)
    out = scratch_dir(spark, "walk")
    run = lister(folders.qualified(root), include_hidden, directory_budget if recursive else 0, entry_budget)
    frontier = starts.select("relative_path") if starts is not None else spark.sql("SELECT '' AS relative_path")
    count = 1 if starts is None else frontier.count()
    rounds = []
    while True:
        level, pending = f"{out}/round={len(rounds)}", Observation()
        (
            spread(frontier, count)
            .mapInArrow(run, LISTING)
            .observe(pending, F.count_if("pending").alias("n"))
            .write.parquet(level)
        )
        rounds.append(level)
        count = pending.get["n"]
        if not count:
            break
        frontier = spark.read.schema(LISTING).parquet(level).where("pending").select("relative_path")
    return spark.read.schema(LISTING).parquet(*rounds).where("NOT pending").drop("pending")


def described(listing: DataFrame, root: str) -> DataFrame:
    """A listing with full path and type; the shape of the file inventory."""
    kind = F.when(F.col("is_directory"), F.lit("directory")).otherwise(file_type(F.col("name")))
    return listing.select(
        "name",
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("relative_path")).alias("path"),
        "relative_path",
        "is_directory",
        "size",
        kind.alias("type"),
        "modification_time",
        "error",
    )


def file_inventory(spark: SparkSession, root: str, include_hidden: bool = False) -> DataFrame:
    """All files and directories below ``root``; hidden names and all below them are left out."""
    return described(walk(spark, root, include_hidden), root)


def top_level(spark: SparkSession, root: str, include_hidden: bool = False) -> DataFrame:
    """The entries directly below ``root``. A root that cannot be listed is an error, not an empty folder."""
    listing = walk(spark, root, include_hidden, recursive=False)
    fault = listing.where("relative_path = '' AND error IS NOT NULL").head()
    if fault:
        raise OSError(f"{root} cannot be listed: {fault['error']}")
    return listing


def child_directories(spark: SparkSession, root: str, include_hidden: bool = False) -> DataFrame:
    """``name``, ``path`` and ``error`` of the directories directly below ``root``; linked ones have an error."""
    return described(top_level(spark, root, include_hidden), root).where("is_directory").select("name", "path", "error")


def binary_file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """The files below ``root``, empty ones too; their bytes are not read (:func:`files_as_rows` does that).

    A folder that cannot be listed and a link that leads nowhere are rows with an ``error``.
    """
    return file_inventory(spark, root).where("NOT is_directory OR error IS NOT NULL")


def only_files(inventory: DataFrame) -> DataFrame:
    files = inventory.where("NOT is_directory")
    return files.where("error IS NULL") if "error" in inventory.columns else files


def folder_sizes(inventory: DataFrame, folder: Column | None = None) -> DataFrame:
    """Bytes per top-level folder; null with an ``error`` when a part of it could not be listed. Links to nothing have no bytes."""
    name = F.substring_index("relative_path", "/", 1) if folder is None else folder
    error = F.max(F.when(F.col("is_directory"), F.col("error"))) if "error" in inventory.columns else F.lit(None).cast("string")
    total = F.coalesce(F.sum(F.when(~F.col("is_directory"), F.col("size"))), F.lit(0))
    return (
        inventory.groupBy(name.alias("name"))
        .agg(total.alias("total"), error.alias("error"))
        .select("name", F.when(F.col("error").isNull(), F.col("total")).alias("size_bytes"), "error")
    )
