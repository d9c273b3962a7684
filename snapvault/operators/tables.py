"""Profiling and copying single tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.functions.fingerprint import checksum_aggregates, row_hash
from snapvault.operators.items import in_parallel, item, now
from snapvault.plans.verify import MISMATCH
from snapvault.sources.hadoop import Folders
from snapvault.sources.tables import replace_table, scan_exact

PROFILE = (
    "name string, row_count bigint, column_count bigint, columns array<string>, schema_json string, error string"
)


CHECKSUM = ("row_count", "hash_sum", "hash_xor")


def message(error: BaseException) -> str:
    lines = str(error).strip().splitlines()
    return f"{type(error).__name__}: {lines[0] if lines else ''}"


def profile_tables(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", width: int = 8) -> DataFrame:
    """Row count, columns and schema per table; a table that cannot be read gives a row with ``error``."""

    def one(pair):
        name, path = pair
        try:
            df, _ = scan_exact(spark, path, fmt)
            return (name, df.count(), len(df.columns), df.columns, df.schema.json(), None)
        except Exception as error:
            return (name, None, None, None, None, message(error))

    return spark.createDataFrame(in_parallel(spark, one, list(paths.items()), width), PROFILE)


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, with count and checksum taken while they pass by."""
    seen = Observation()
    hashed = df.withColumn("__hash", row_hash(df.schema))
    return hashed.observe(seen, *checksum_aggregates(F.col("__hash"))).drop("__hash"), seen


def store_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    target_path: str,
    fmt: str = "parquet",
    partition_by: list[str] | tuple = (),
    overwrite: bool = False,
    expected: dict | None = None,
    commit: str = "rename",
    **record,
) -> dict:
    """Write a table and return its item record. Count, checksum and copy are one scan.

    ``expected`` is the count and checksum that the rows must have, as far as they are known; others fail the table, and nothing
    of them is ever seen under its name. ``commit`` is ``rename`` or ``pointer``, see :func:`replace_table`.
    """
    started, folders = now(), Folders(spark)
    existed = folders.exists(target_path)
    try:
        passing, seen = observed(df)

        def check():
            found = seen.get
            if any(found[k] != v for k, v in (expected or {}).items()):
                raise ValueError(f"{MISMATCH}: {found['row_count']}, recorded {expected['row_count']}")

        if existed and not overwrite:
            raise FileExistsError(target_path)
        replace_table(spark, passing, target_path, fmt, partition_by, check if expected else None, commit)
        return item(
            "table",
            name,
            "success",
            **seen.get,
            column_count=len(df.columns),
            columns=df.columns,
            schema_json=df.schema.json(),
            partition_columns=list(partition_by),
            target_path=target_path,
            started_at=started,
            finished_at=now(),
            **record,
        )
    except Exception as error:
        if not existed:
            folders.delete(target_path)
        return failed_table(name, error, target_path=target_path, started_at=started, **record)


def failed_table(name: str, error: BaseException | str, **record) -> dict:
    text = error if isinstance(error, str) else message(error)
    return item("table", name, "failed", error=text, finished_at=now(), **record)


def copy_table(
    spark: SparkSession,
    name: str,
    source_path: str,
    target_path: str,
    source_fmt: str = "parquet",
    fmt: str = "parquet",
    overwrite: bool = False,
    recorded: dict | None = None,
    commit: str = "rename",
) -> dict:
    """Copy one table, partitions included, and return its item record.

    ``recorded`` is the item record of the run that wrote the source: its schema is taken from there, and rows that are
    not those of the record are never put in a table's place.
    """
    record = {"method": "read_write", "source_path": source_path}
    try:
        folders = Folders(spark)
        source, target = folders.qualified(source_path), folders.qualified(target_path)
        if f"{source}/".startswith(f"{target}/") or f"{target}/".startswith(f"{source}/"):
            raise ValueError("source and target are the same folder, or one lies in the other")
        known, about = None, recorded or {}
        if about.get("schema_json"):
            known = T.StructType.fromJson(json.loads(about["schema_json"])), about["partition_columns"] or []
        expected = {k: about[k] for k in CHECKSUM if about.get(k) is not None}
        df, parts = scan_exact(spark, source_path, source_fmt, known)
    except Exception as error:
        return failed_table(name, error, target_path=target_path, started_at=now(), **record)
    return store_table(spark, name, df, target_path, fmt, parts, overwrite, expected, commit, **record)


def copy_tables(
    spark: SparkSession,
    paths: dict[str, str],
    target_root: str,
    source_fmt: str = "parquet",
    fmt: str = "parquet",
    overwrite: bool = False,
    width: int = 8,
    recorded: dict[str, dict] | None = None,
    commit: str = "rename",
) -> list[dict]:
    """Copy every table to ``<target_root>/<name>``; one failure does not stop the rest."""
    records = recorded or {}
    one = lambda pair: copy_table(
        spark, pair[0], pair[1], f"{target_root}/{pair[0]}", source_fmt, fmt, overwrite, records.get(pair[0]), commit
    )
    return in_parallel(spark, one, list(paths.items()), width)
