"""Entries of ZIP archives as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapvault.functions.files import base_name, file_type
from snapvault.session import settled
from snapvault.sources import directory
from snapvault.sources.hadoop import Folders
from snapvault.sources.spreading import spread, spread_by_size
from snapvault.sources.workers import content_reader

CONTENT = "archive string, entry string, part int, offset bigint, content binary, error string"
PART_BYTES = 64 << 20

METADATA = (
    "backup_type string, created_at string, source_lakehouse_name string, source_workspace_name string, "
    "tables_backed_up bigint, files_backed_up bigint"
)


def classify_entries(raw: DataFrame) -> DataFrame:
    """Adds ``kind`` (table, file, metadata, other) and the names that go with it.

    ``tables/<table>/<file>``, ``files/<relative path>`` and ``_backup_info/...``; entries that
    stand for a directory are dropped.
    """
    path, parts = F.col("entry"), F.split("entry", "/")
    kind = (
        F.when(path.startswith("tables/") & (F.size(parts) >= 3), F.lit("table"))
        .when(path.startswith("files/"), F.lit("file"))
        .when(path.startswith("_backup_info/"), F.lit("metadata"))
        .otherwise(F.lit("other"))
    )
    is_table, is_file = F.col("kind") == "table", F.col("kind") == "file"
    relative = F.when(is_file, F.substr(path, F.lit(len("files/") + 1)))
    named = (
        raw.withColumn("kind", kind)
        .withColumn("table_name", F.when(is_table, F.get(parts, F.lit(1))))
        .withColumn("relative_path", relative)
        .withColumn("file_name", F.when(is_table, F.get(parts, F.lit(2))).otherwise(base_name(path)))
        .withColumn("file_type", F.when(is_file, file_type(F.col("file_name"))))
    )
    return named.where(path.isNull() | ~path.endswith("/"))


def archive_entries(
    spark: SparkSession, root: str, archives: DataFrame, run_bytes: int = directory.RUN_BYTES
) -> DataFrame:
    """Entries of the archives named in ``archives.relative_path``; only central directories are read.

    A directory is read in runs of whole entries by many tasks; no task holds more than a run of it. When an archive holds a
    name twice, the last one counts. An archive that cannot be read gives one row with ``error``; so does one in which a run
    cannot be understood, next to the entries of its other runs. An archive that is named twice is read as one.
    """
    root = Folders(spark).qualified(root)
    todo = spread(archives.select("relative_path").distinct(), archives.count())
    ends = directory.located(todo.mapInArrow(directory.tail_reader(root), directory.TAILS))
    runs = settled(ends.mapInArrow(directory.run_lister(root, run_bytes), directory.RUNS), "runs")
    todo = spread_by_size(runs, F.concat_ws(":", "archive", "start"), directory.TASK_BYTES)
    rows = todo.mapInArrow(directory.entry_reader(root), directory.ENTRIES)
    last = F.max_by(F.struct(*RAW[2:], "error"), "number").alias("last")
    return classify_entries(rows.groupBy("archive", "entry").agg(last).select("archive", "entry", "last.*"))


def archive_entries_binary(archives: DataFrame) -> DataFrame:
    """Entries of archives held in a table: every row of ``archive``, ``zip_binary``.

    The directory is found and cut out by Spark expressions, so that no other byte of an archive reaches Python. One task
    reads the whole directory of an archive, which is a value of one row. Each row is an archive of its own, whatever its name.
    """
    value = F.col("zip_binary")
    ends = directory.located(
        archives.select(
            "archive",
            "zip_binary",
            F.length(value).cast("bigint").alias("size"),
            directory.tail_of(value).alias("tail"),
            F.lit(None).cast("string").alias("error"),
        )
    )
    cut = F.when(F.col("error").isNull(), F.substr(value, (F.col("start") + 1).cast("int"), F.col("bytes").cast("int")))
    rows = ends.select("archive", "start", "shift", cut.alias("directory"), "error")
    return classify_entries(rows.mapInArrow(directory.directory_parser(), directory.ENTRIES).drop("number"))


RAW = ["archive", "entry", "size", "compressed_size", "crc", "method", "flags", "offset"]


def entry_contents(entries: DataFrame, root: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """The bytes of each entry in parts, one row for every ``part_bytes``."""
    root = Folders(entries.sparkSession).qualified(root)
    todo = spread_by_size(entries.select(*RAW), F.concat("archive", "entry"))
    return todo.mapInArrow(content_reader(root, part_bytes), CONTENT)


def entry_documents(entries: DataFrame, root: str) -> DataFrame:
    """The text of each small document (``text``), or its ``error``; one of several parts is no small document."""
    rows = entry_contents(entries, root).groupBy("archive", "entry").agg(
        F.max("part").alias("last"), F.min_by("content", "part").alias("content"), F.max("error").alias("error")
    )
    large = F.when(F.col("last") > 0, F.lit("document too large"))
    error = F.coalesce("error", large)
    text = F.when(error.isNull(), F.decode("content", "UTF-8"))
    return rows.select("archive", "entry", text.alias("text"), error.alias("error"))


def archive_metadata(entries: DataFrame, root: str, schema: str = METADATA) -> DataFrame:
    """The metadata document of each archive, parsed."""
    documents = entries.where((F.col("kind") == "metadata") & F.col("entry").endswith("metadata.json"))
    parsed = entry_documents(documents, root).withColumn("d", F.from_json("text", schema))
    return parsed.select("archive", "entry", "d.*", "error")
