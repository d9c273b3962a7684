"""Reading, finding and writing tables; any Spark file format, Parquet by default."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.sources.hadoop import Folders
from snapvault.sources.versions import POINTERS, collect_versions, current, latest, new_version, point

# Formats whose folders Spark reads by partition discovery; the others keep their own table log.
FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv", "text")


def discover_tables(inventory: DataFrame, root: str) -> DataFrame:
    """Distinct names of the tables below ``root``, from paths inside them or of their folders with a slash at the end.

    Folders that begin with ``_`` or ``.`` are no tables, nor are loose files.
    """
    inside = F.startswith("path", F.lit(root.rstrip("/") + "/"))
    below = F.substr("path", F.lit(len(root.rstrip("/")) + 2))
    name = F.regexp_extract(F.when(inside, below), r"\A([^/_.][^/]*)/", 1)
    return inventory.select(name.alias("name")).where("name <> ''").distinct()


def literal(path: str) -> str:
    """A path for ``load`` in which no character is a wildcard."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(literal(current(spark, path) if fmt in FILE_FORMATS else path))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names from the first ``column=value`` folders on the way down to a data file."""
    folders, names = Folders(spark), []
    child = folders.first_child(path)
    while child and child[1] and "=" in child[0]:
        names.append(child[0].split("=", 1)[0])
        path = f"{path}/{child[0]}"
        child = folders.first_child(path)
    return names


def scan_exact(
    spark: SparkSession, path: str, fmt: str = "parquet", known: tuple[T.StructType, list[str]] | None = None
) -> tuple[DataFrame, list[str]]:
    """A table for copying or checking, with its partition columns.

    ``known`` is the schema and the partition columns of a table that this package wrote; nothing is inferred then.

    Partition values stay the strings they are in the path (``month=01`` is not turned into 1), and
    columns that only some files have are not lost. Damaged or vanished files are errors, whatever
    the session is set to.
    """
    if fmt not in FILE_FORMATS:
        df = scan_table(spark, path, fmt)
        details = spark.sql(f"DESCRIBE DETAIL {fmt}.`{path}`") if fmt == "delta" else None
        return df, list(details.head()["partitionColumns"]) if details is not None else []
    path = current(spark, path)
    options = {"ignoreCorruptFiles": False, "ignoreMissingFiles": False}
    if known is not None:
        return spark.read.format(fmt).schema(known[0]).options(**options).load(literal(path)), known[1]
    merge = {"mergeSchema": True} if fmt in ("parquet", "orc") else {}
    df = spark.read.format(fmt).options(**options, **merge).load(literal(path))
    parts = [c for c in partition_columns(spark, path) if c in df.columns]
    if not parts:
        return df, parts
    exact = T.StructType([T.StructField(f.name, T.StringType()) if f.name in parts else f for f in df.schema])
    return spark.read.format(fmt).schema(exact).options(**options).load(literal(path)), parts


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by=()) -> None:
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


COMMITS = ("rename", "pointer")


def replace_table(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by=(),
    check: Callable[[], None] | None = None,
    commit: str = "rename",
) -> None:
    """Put a table in place of what is at ``path``, which stays until the new rows are complete and ``check`` has not raised.

    File formats are written to a hidden folder and renamed, or, with ``commit="pointer"`` and wherever there is a pointer
    already, written as a new version that the next pointer names (:mod:`snapvault.sources.versions`); nothing is renamed then.
    Formats with a table log swap atomically by themselves; where there is a check, their rows are staged and checked before.
    """
    if commit not in COMMITS:
        raise ValueError(f"unknown commit: {commit}")
    folders = Folders(spark)
    path = path.rstrip("/")
    parent, name = path.rsplit("/", 1)
    run = uuid.uuid4().hex
    staged, old = f"{parent}/.staging-{run}/{name}", f"{parent}/.replaced-{run}/{name}"
    if fmt in FILE_FORMATS and (commit == "pointer" or folders.exists(f"{path}/{POINTERS}")):
        _replace_by_pointer(spark, df, path, fmt, partition_by, check)
        return
    if check is None and (fmt not in FILE_FORMATS or not folders.exists(path)):
        write_table(df, path, fmt, "errorifexists" if fmt in FILE_FORMATS else "overwrite", partition_by)
        return
    try:
        if fmt not in FILE_FORMATS:
            write_table(df, staged)
            check()
            write_table(spark.read.schema(df.schema).parquet(literal(staged)), path, fmt, "overwrite", partition_by)
            return
        write_table(df, staged, fmt, "errorifexists", partition_by)
        if check is not None:
            check()
        if not folders.exists(path):
            folders.rename(staged, path)
            return
        folders.make(f"{parent}/.replaced-{run}")
        folders.rename(path, old)
        try:
            folders.rename(staged, path)
        except Exception:
            folders.rename(old, path)
            raise
        folders.delete(f"{parent}/.replaced-{run}")
    finally:
        folders.delete(f"{parent}/.staging-{run}")


def _replace_by_pointer(spark, df, path, fmt, partition_by, check) -> None:
    before, version = latest(spark, path), new_version()
    try:
        write_table(df, f"{path}/{version}", fmt, "errorifexists", partition_by)
        if check is not None:
            check()
        point(spark, path, version, before)
    except Exception:
        Folders(spark).delete(f"{path}/{version}")
        raise
    collect_versions(spark, path)
