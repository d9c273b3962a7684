"""Restoring tables and files from ZIP archives of the old layout."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.functions.files import is_hidden
from snapvault.operators.filecopy import file_rows, write_files
from snapvault.operators.items import conform, in_parallel, item, items_frame, now
from snapvault.operators.tables import failed_table, store_table
from snapvault.plans.restore import (
    archive_format,
    below_unread,
    files_to_restore,
    restore_plan,
    select_files,
    select_names,
)
from snapvault.session import scratch_dir, settled
from snapvault.sources.archives import RAW, archive_entries, entry_contents, entry_documents
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import child_directories, only_files, walk
from snapvault.sources.quoted_csv import read_quoted_csv
from snapvault.sources.spreading import spread_by_size
from snapvault.sources.tables import literal
from snapvault.sources.workers import extractor

EXTRACTED = (
    "archive string, entry string, relative_path string, size bigint, status string, written_bytes bigint, "
    "quoted_newline boolean, error string"
)
FALLBACK_TABLE = "_restored_files"

# Dtype names that old schema documents use, and the Spark type of each.
DTYPES = {
    "int64": "bigint",
    "int32": "int",
    "float64": "double",
    "float32": "float",
    "bool": "boolean",
    "object": "string",
    "datetime64[ns]": "timestamp_ntz",
}


def store_binary_archives(spark: SparkSession, archives: DataFrame) -> tuple[str, DataFrame]:
    """Archives held in a table (``archive``, ``zip_binary``) as files of a scratch folder.

    From there on they take the same way as archive files, entry by entry.
    """
    root = scratch_dir(spark, "archives")
    rows = archives.select(F.col("archive").alias("relative_path"), F.col("zip_binary").alias("content"))
    status = write_files(spark, rows, root)
    failed = status.where("status <> 'success'").head()
    if failed:
        raise OSError(f"archive {failed['relative_path']} could not be stored: {failed['error']}")
    return root, status.select("relative_path")


def scan_archives(spark: SparkSession, root: str, archives: DataFrame) -> DataFrame:
    """Entries, written once, since several steps use them."""
    return settled(archive_entries(spark, root, archives), "entries")


def table_formats(entries: DataFrame, preference: str = "auto") -> DataFrame:
    """Per table: what the archives hold of it and the format to restore from.

    A table may be spread over several archives. It has a format when each of those that hold any of
    its rows has it, so that no part is left out.
    """
    name = F.col("file_name")
    parts = (
        entries.where("kind = 'table'")
        .groupBy("archive", F.col("table_name").alias("name"))
        .agg(
            F.bool_or(name.endswith(".parquet")).alias("p"),
            F.bool_or(name.endswith(".csv")).alias("c"),
            F.bool_or(name == "schema.json").alias("s"),
            F.bool_or(name == "metadata.json").alias("m"),
        )
    )
    whole = lambda flag: F.bool_or(flag) & F.bool_and(F.col(flag) | ~(F.col("p") | F.col("c")))
    found = parts.groupBy("name").agg(
        whole("p").alias("has_parquet"),
        whole("c").alias("has_csv"),
        F.bool_or("s").alias("has_schema"),
        F.bool_or("m").alias("has_metadata"),
    )
    return found.withColumn("format", archive_format(preference, F.col("has_parquet"), F.col("has_csv")))


def _unpack(spark: SparkSession, entries: DataFrame, root: str, target_root: str) -> DataFrame:
    """Unpack entries to their ``relative_path``; each is its own unit of work."""
    staging, out = f".staging-{now().strftime('%Y%m%d%H%M%S%f')}", scratch_dir(spark, "unpack")
    folders = Folders(spark)
    todo = spread_by_size(entries.select(*RAW, "relative_path"), F.concat("archive", "entry"))
    try:
        todo.mapInArrow(extractor(*map(folders.qualified, (root, target_root)), staging), EXTRACTED).write.parquet(out)
    finally:
        folders.delete(f"{target_root}/{staging}")
    return spark.read.schema(EXTRACTED).parquet(out)


def _chosen_entries(entries: DataFrame, plan: DataFrame) -> DataFrame:
    """Data entries of the chosen format: ``<table>.<format>`` where there is one, else all of it."""
    data = entries.where("kind = 'table'").join(
        plan.select(F.col("name").alias("table_name"), "format"), "table_name"
    )
    data = data.where(F.col("file_name").endswith(F.concat(F.lit("."), F.col("format"))))
    main = F.col("file_name") == F.concat("table_name", F.lit("."), F.col("format"))
    has_main = data.groupBy("archive", "table_name").agg(F.bool_or(main).alias("has_main"))
    base = F.substring_index("entry", "/", -1)
    staged = F.concat("table_name", F.lit("/"), F.md5(F.concat_ws("!/", "archive", "entry")), F.lit("-"), base)
    return (
        data.join(has_main, ["archive", "table_name"])
        .where((main | ~F.col("has_main")) & ~is_hidden(base))
        .withColumn("relative_path", staged)
    )


def _stored_schema(text: str) -> T.StructType | None:
    """Schema document of an archive: Spark's own JSON, or a list of ``name`` and ``type``. Any other is an error, since
    types that are guessed instead can change values; only an empty one says nothing."""
    try:
        document = json.loads(text)
        if not document:
            return None
        if isinstance(document, dict) and document.get("type") == "struct":
            return T.StructType.fromJson(document)
        columns = document.get("columns") if isinstance(document, dict) else document
        parts = [f"`{c['name']}` {DTYPES.get(c['type'], c['type'])}" for c in columns]
        return T.StructType.fromDDL(", ".join(parts))
    except Exception as error:
        raise ValueError(f"schema document cannot be read: {type(error).__name__}") from error


def _read_staged(spark: SparkSession, path: str, fmt: str, schema: T.StructType | None, multi_line: bool) -> DataFrame:
    if fmt == "parquet":
        return spark.read.option("mergeSchema", True).parquet(literal(path))
    if multi_line:
        rows = read_quoted_csv(spark, path, schema)
        if rows is not None:
            return rows
    strict = {"mode": "FAILFAST", "enforceSchema": False}  # a value or header that does not fit is an error
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line, **strict)
    return reader.schema(schema).csv(literal(path)) if schema else reader.option("inferSchema", True).csv(literal(path))


def restore_tables(
    spark: SparkSession,
    entries: DataFrame,
    root: str,
    target_tables: str,
    names: list[str] | None = None,
    preference: str = "auto",
    overwrite: bool = True,
    dry_run: bool = False,
    fmt: str = "parquet",
    width: int = 8,
) -> list[dict]:
    """Restore tables from archive entries; one item record per table."""
    folders = Folders(spark)
    if folders.exists(target_tables):
        there = child_directories(spark, target_tables)
    else:
        there = spark.createDataFrame([], "name string")
    plan = restore_plan(select_names(table_formats(entries, preference), names), there, overwrite)
    rows = sorted(plan.collect(), key=lambda r: r["name"])  # one small row per table
    records = []
    for row in rows:
        target = f"{target_tables}/{row['name']}"
        if dry_run:
            records.append(item("table", row["name"], "dry_run", method=row["format"], target_path=target))
        elif row["action"] == "skip":
            records.append(item("table", row["name"], "skipped", error="exists", target_path=target))
        elif row["format"] == "none":
            records.append(failed_table(row["name"], "no suitable format", target_path=target))
    wanted = {r["name"]: r for r in rows if r["action"] == "restore" and r["format"] != "none"}
    if dry_run or not wanted:
        return records

    staging = scratch_dir(spark, "staged")
    # The plan is at hand, one small row per table, so the entries meet it without moving.
    formats = [(n, r["format"]) for n, r in wanted.items()]
    plan = F.broadcast(spark.createDataFrame(formats, "name string, format string"))
    chosen = settled(_chosen_entries(entries, plan), "chosen")
    status = _unpack(spark, chosen, root, staging)
    table = F.substring_index("relative_path", "/", 1)
    outcome = {
        r["name"]: r
        for r in status.groupBy(table.alias("name"))
        .agg(F.max("quoted_newline").alias("multi_line"), F.min("error").alias("error"))
        .collect()
    }
    documents = entries.where("kind = 'table' AND file_name = 'schema.json'").join(
        plan.where("format = 'csv'").select(F.col("name").alias("table_name")), "table_name"
    )
    table_of = F.get(F.split("entry", "/"), F.lit(1)).alias("name")
    texts = entry_documents(documents, root).groupBy(table_of)
    told = texts.agg(F.min("text").alias("text"), F.max("text").alias("other"), F.min("error").alias("error"))
    schemas = {r["name"]: r for r in told.collect()}  # one document per table: those of its archives meet on the executors

    def one(name: str) -> dict:
        target, chosen_format = f"{target_tables}/{name}", wanted[name]["format"]
        record = {"method": f"archive_{chosen_format}", "source_path": root}
        unpacked = outcome.get(name)
        if unpacked is None or unpacked["error"]:
            reason = unpacked["error"] if unpacked else "no readable entry"
            return failed_table(name, reason, target_path=target, **record)
        try:
            said = schemas.get(name)
            if said and said["error"]:
                return failed_table(name, f"schema document cannot be read: {said['error']}", target_path=target, **record)
            if said and said["text"] != said["other"]:
                return failed_table(name, "archives disagree on the schema", target_path=target, **record)
            schema = _stored_schema(said["text"]) if said else None
            df = _read_staged(spark, f"{staging}/{name}", chosen_format, schema, unpacked["multi_line"])
        except Exception as error:
            return failed_table(name, error, target_path=target, **record)
        return store_table(spark, name, df, target, fmt, overwrite=overwrite, **record)

    try:
        return records + in_parallel(spark, one, sorted(wanted), width)
    finally:
        folders.delete(staging)


def restore_files(
    spark: SparkSession,
    entries: DataFrame,
    root: str,
    target_files: str,
    patterns: list[str] | None = None,
    overwrite: bool = True,
    dry_run: bool = False,
    at: datetime | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Restore files from archive entries; one item record per file.

    Files that cannot be written under their name are kept as rows of the ``_restored_files`` table, in parts, under the
    ``run_id``. A file counts as kept if all of it has been read and written by this run.
    """
    run_id = run_id or uuid.uuid4().hex
    found = entries.where("kind = 'file'")
    columns = [c for c in found.columns if c != "relative_path"]
    last = F.max_by(F.struct(*columns), F.struct("archive", "offset"))
    found = found.groupBy("relative_path").agg(last.alias("e")).select("relative_path", "e.*")
    found = select_files(found, patterns)
    values = {
        "kind": F.lit("file"),
        "name": F.col("relative_path"),
        "size_bytes": F.col("size"),
        "source_path": F.concat("archive", F.lit("!/"), "entry"),
        "target_path": F.concat(F.lit(target_files + "/"), "relative_path"),
    }
    shaped = lambda df, **more: df.select(*conform(values | more))
    if dry_run:
        return shaped(found, status=F.lit("dry_run"))
    if overwrite or not Folders(spark).exists(target_files):
        todo, skipped = found, None
    else:
        there = walk(spark, target_files, include_hidden=True)
        present = only_files(there).select("relative_path")
        # What stands in a folder that cannot be listed is not known, so nothing is written into it.
        unknown = settled(below_unread(found, there.where("is_directory AND error IS NOT NULL")), "unknown")
        known = found.join(unknown, "relative_path", "left_anti")
        todo = settled(files_to_restore(known, present, overwrite=False), "todo")
        skipped = shaped(known.join(present, "relative_path", "left_semi"), status=F.lit("skipped"), error=F.lit("exists"))
        unsafe = F.concat(F.lit("target folder cannot be listed: "), "error")
        blocked = shaped(found.drop("error").join(unknown, "relative_path"), status=F.lit("failed"), error=unsafe)
        skipped = settled(skipped.unionByName(blocked), "skipped")
    done = _unpack(spark, todo, root, target_files)
    failed = done.where("status = 'failed'").select("archive", "entry", "relative_path", "error")
    kept = None
    if not failed.isEmpty():
        retry = entries.join(failed.select("archive", "entry"), ["archive", "entry"], "left_semi")
        rows = entry_contents(retry, root).join(failed.select("archive", "entry", "relative_path"), ["archive", "entry"])
        rows = settled(file_rows(rows, at or now()).withColumn("run_id", F.lit(run_id)), "fallback")
        # A last part with an error means that the entry could not be read to its end.
        broken = rows.where("error IS NOT NULL").select("original_path").distinct()
        whole = rows.join(broken, "original_path", "left_anti").drop("error")
        whole.write.mode("append").parquet(f"{target_files}/{FALLBACK_TABLE}")
        kept = whole.select(F.col("original_path").alias("relative_path")).distinct().withColumn("kept", F.lit(True))
    copied = F.when(F.col("status") == "success", F.lit("archive_entry"))
    records = done.withColumn("method", copied)
    if kept is not None:
        rescued = F.col("method").isNull() & F.coalesce("kept", F.lit(False))
        records = (
            records.join(kept, "relative_path", "left")
            .withColumn("status", F.when(rescued, F.lit("success")).otherwise(F.col("status")))
            .withColumn("method", F.when(rescued, F.lit("table_copy")).otherwise(F.col("method")))
        )
    result = shaped(records, status=F.col("status"), method=F.col("method"), error=F.col("error"), finished_at=F.lit(now()))
    return result if skipped is None else result.unionByName(skipped)


def restore_from_archives(
    spark: SparkSession,
    root: str,
    archives: DataFrame,
    target_tables: str | None,
    target_files: str | None,
    names: list[str] | None = None,
    patterns: list[str] | None = None,
    preference: str = "auto",
    overwrite: bool = True,
    dry_run: bool = False,
    fmt: str = "parquet",
    width: int = 8,
    run_id: str | None = None,
) -> DataFrame:
    """Tables and files from all archives of a snapshot, as item records."""
    entries = scan_archives(spark, root, archives)
    records = []
    if target_tables:
        records = restore_tables(spark, entries, root, target_tables, names, preference, overwrite, dry_run, fmt, width)
    # An archive that could not be read is a failure, not an empty archive.
    broken = entries.where("error IS NOT NULL")
    values = {
        "kind": F.lit("archive"),
        "name": F.col("archive"),
        "status": F.lit("failed"),
        "source_path": F.concat(F.lit(root + "/"), "archive"),
        "error": F.col("error"),
    }
    items = items_frame(spark, records).unionByName(broken.select(*conform(values)))
    if target_files:
        files = restore_files(spark, entries, root, target_files, patterns, overwrite, dry_run, run_id=run_id)
        items = items.unionByName(files)
    return items
