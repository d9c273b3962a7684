"""Copying and deleting many files, and keeping files as rows of a table."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.functions.files import base_name, file_type
from snapvault.session import passing_shuffles, scratch_dir, settled
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import walk
from snapvault.sources.spreading import spread, spread_by_size
from snapvault.sources.tables import replace_table, scan_table
from snapvault.sources.workers import SEGMENT_BYTES, copier, deleter, hasher, reader, writer

STATUS = "relative_path string, size bigint, status string, written_bytes bigint, error string, digest string"
SEGMENTS = "relative_path string, part int, digest string, error string"
CONTENTS = "relative_path string, part int, offset bigint, size bigint, content binary, error string"
DELETED = "relative_path string, status string, error string"

PART_BYTES = SEGMENT_BYTES
NOTE = "bytes of the file, in the order of their parts"


def copy_files(
    spark: SparkSession,
    files: DataFrame,
    source_root: str,
    target_root: str,
    status_path: str | None = None,
) -> DataFrame:
    """Copy the files named in ``relative_path`` (with ``size``) and return one status row per file.

    The bytes are streamed by the tasks; the status rows are written once to ``status_path`` and
    read back, so using the result again does not copy again. A file that fails is a row.
    ``digest`` of a status row is that of the bytes that passed through (:func:`file_digests`); null where a store copied by itself.
    Where ``files`` has a ``digest`` that is not null, a file with other bytes fails and does not get its place.
    """
    staging, folders = f".staging-{uuid.uuid4().hex}", Folders(spark)
    out = status_path or scratch_dir(spark, "copy")
    columns = [c for c in ("relative_path", "size", "digest") if c in files.columns]
    todo = spread_by_size(files.select(*columns), F.col("relative_path"))
    try:
        todo.mapInArrow(copier(*map(folders.qualified, (source_root, target_root)), staging), STATUS).write.parquet(out)
    finally:
        folders.delete(f"{target_root}/{staging}")
    return spark.read.schema(STATUS).parquet(out)


def write_files(spark: SparkSession, rows: DataFrame, target_root: str, status_path: str | None = None) -> DataFrame:
    """Turn rows with ``relative_path`` and binary ``content`` back into files.

    Rows are dealt out first, to four tasks a core: a table whose rows lie in one row group, which Spark reads by
    one task, would be written by one task, at a cost for each file that its bytes do not show.
    """
    staging, folders = f".staging-{uuid.uuid4().hex}", Folders(spark)
    out = status_path or scratch_dir(spark, "write")
    try:
        todo = rows.select("relative_path", "content").repartition(4 * spark.sparkContext.defaultParallelism, "relative_path")
        with passing_shuffles(spark):
            todo.mapInArrow(writer(folders.qualified(target_root), staging), STATUS).write.parquet(out)
    finally:
        folders.delete(f"{target_root}/{staging}")
    return spark.read.schema(STATUS).parquet(out)


def delete_paths(spark: SparkSession, paths: DataFrame, root: str, directories: bool) -> DataFrame:
    """Delete files (or whole directories) named in ``relative_path``; one status row each."""
    todo = spread(paths.select("relative_path"), paths.count())
    return settled(todo.mapInArrow(deleter(Folders(spark).qualified(root), directories), DELETED), "delete")


def files_as_rows(spark: SparkSession, root: str, at: datetime, part_bytes: int = PART_BYTES) -> DataFrame:
    """Each file below ``root`` as rows with its bytes, one row for every ``part_bytes`` of it.

    Parts are read on their own, so a large file is the work of many tasks. An empty file is one empty part. A part that
    cannot be read has no content and says why; so does one row for each folder that cannot be listed and each link that leads nowhere.
    """
    listing = walk(spark, root)
    parts = file_parts(listing.where("NOT is_directory AND error IS NULL"), part_bytes)
    key = F.concat_ws("/", "relative_path", "part")
    contents = spread_by_size(parts, key).mapInArrow(reader(Folders(spark).qualified(root)), CONTENTS)
    zero, none = F.lit(0), F.lit(None)
    unread = listing.where("error IS NOT NULL").select(
        "relative_path", zero.alias("part"), zero.cast("bigint").alias("offset"), none.cast("bigint").alias("size"),
        none.cast("binary").alias("content"), "error",
    )
    rows = file_rows(contents.unionByName(unread), at)
    return rows.withColumn("restoration_note", F.coalesce("error", "restoration_note")).drop("error")


def file_parts(files: DataFrame, part_bytes: int) -> DataFrame:
    """``relative_path``, ``part``, ``offset`` and ``size`` of the parts of files (``relative_path``, ``size``)."""
    last = F.greatest(F.lit(0), F.ceil(F.col("size") / part_bytes) - 1).cast("int")
    parts = files.select("relative_path", "size").withColumn("part", F.explode(F.sequence(F.lit(0), last)))
    offset = F.col("part").cast("bigint") * part_bytes
    return parts.select("relative_path", "part", offset.alias("offset"), F.least(F.lit(part_bytes), F.col("size") - offset).alias("size"))


def file_digests(spark: SparkSession, root: str, files: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``relative_path``, ``digest`` and ``error`` of files below ``root`` (``relative_path``, ``size``), read part by part.

    The digest of a file is the SHA-256 of the digests of its parts, in order and in hexadecimal: 64 characters for each 64 MB are all that
    meets in a row. A file of which a part cannot be read has no digest and says why.
    """
    parts = spread_by_size(file_parts(files, part_bytes), F.concat_ws("/", "relative_path", "part"))
    read = parts.mapInArrow(hasher(Folders(spark).qualified(root)), SEGMENTS)
    ordered = F.sort_array(F.collect_list(F.struct("part", "digest")))
    whole = read.groupBy("relative_path").agg(ordered.alias("parts"), F.min("error").alias("error"))
    joined = F.array_join(F.transform("parts", lambda p: p["digest"]), "")
    return whole.select("relative_path", F.when(F.col("error").isNull(), F.sha2(joined, 256)).alias("digest"), "error")


def file_rows(files: DataFrame, at: datetime) -> DataFrame:
    """``relative_path``, ``part``, ``offset``, ``content`` and ``error`` in the shape of files kept in a table."""
    name = base_name(F.col("relative_path"))
    return files.select(
        F.col("relative_path").alias("original_path"),
        name.alias("file_name"),
        file_type(name).alias("file_type"),
        "part",
        "offset",
        "content",
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.lit(at.isoformat()).alias("restored_timestamp"),
        F.lit(NOTE).alias("restoration_note"),
        "error",
    )


def kept_files(rows: DataFrame) -> DataFrame:
    """Files kept as rows, one row each: ``original_path`` and ``size_bytes`` over all parts; null if a part is missing."""
    whole = F.bool_and(F.col("content").isNotNull()) & (F.max("part") + 1 == F.count_distinct("part"))
    sizes = rows.groupBy("original_path").agg(F.when(whole, F.sum("size_bytes")).alias("size_bytes"))
    return sizes.select("original_path", "size_bytes")


def files_as_table(
    spark: SparkSession, root: str, table_path: str, at: datetime, fmt: str = "parquet", part_bytes: int = PART_BYTES
) -> DataFrame:
    replace_table(spark, files_as_rows(spark, root, at, part_bytes), table_path, fmt)
    return scan_table(spark, table_path, fmt)
