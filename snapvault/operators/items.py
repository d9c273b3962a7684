"""Item records: one row per table or file that a run handled."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEMS = (
    "kind string, name string, status string, row_count bigint, column_count int, columns array<string>, "
    "schema_json string, partition_columns array<string>, size_bytes bigint, hash_sum decimal(38,0), "
    "hash_xor bigint, method string, source_path string, target_path string, started_at timestamp, "
    "finished_at timestamp, error string, digest string"
)
COLUMNS = [part.split()[0] for part in ITEMS.replace("decimal(38,0)", "decimal").split(", ")]


@lru_cache
def fields_of(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def now() -> datetime:
    return datetime.now(timezone.utc)


def item(kind: str, name: str, status: str, **values) -> dict:
    return {c: None for c in COLUMNS} | {"kind": kind, "name": name, "status": status} | values


def items_frame(spark: SparkSession, rows: Iterable[dict]) -> DataFrame:
    """Rows of the tables of a run (one small record per table)."""
    return spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], ITEMS)


def file_items(status: DataFrame, source_root: str, target_root: str, method: str, started: datetime) -> DataFrame:
    """Status rows of copied files as item records."""
    values = {
        "kind": F.lit("file"),
        "name": F.col("relative_path"),
        "status": F.col("status"),
        "size_bytes": F.coalesce("written_bytes", "size"),
        "method": F.lit(method),
        "source_path": F.concat(F.lit(source_root.rstrip("/") + "/"), F.col("relative_path")),
        "target_path": F.concat(F.lit(target_root.rstrip("/") + "/"), F.col("relative_path")),
        "started_at": F.lit(started),
        "finished_at": F.lit(now()),
        "error": F.col("error"),
        "digest": F.col("digest"),
    }
    return status.select(*conform(values))


def conform(values: dict[str, Column]) -> list[Column]:
    """The item columns in order and type; those not given are null."""
    return [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields_of(ITEMS)]


def sidecars(items: DataFrame) -> DataFrame:
    """The record of each table or file also as one JSON document; ``table_name`` is the name of either.

    What a record does not have, such as the rows and columns of a file, its document leaves out.
    """
    document = F.to_json(
        F.struct(
            F.col("name").alias("table_name"),
            "row_count",
            "columns",
            F.col("method").alias("backup_method"),
            F.date_format("finished_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("backup_timestamp"),
            "source_path",
            F.col("target_path").alias("backup_path"),
        )
    )
    return items.withColumn("metadata_json", document)


def in_parallel(spark: SparkSession, function: Callable, arguments: list, width: int) -> list:
    """Run one Spark job per argument from a thread pool, in order of the arguments.

    With FAIR scheduling the jobs share the executors, so many small tables do not queue behind a
    large one: jobs share fairly between scheduler pools only, so each thread has its own.
    """
    if not arguments:
        return []

    def in_own_pool(argument):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", threading.current_thread().name)
        return function(argument)

    width = max(1, min(width, len(arguments)))
    with ThreadPoolExecutor(max_workers=width, thread_name_prefix="snapvault") as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(in_own_pool), a) for a in arguments]
        return [job.result() for job in jobs]
