"""Session settings and the scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from snapvault.sources.hadoop import Folders

# Dates before 1582 and timestamps before 1900 are stored as they are, never shifted.
_REBASE_KEYS = (
    "spark.sql.parquet.datetimeRebaseModeInWrite",
    "spark.sql.parquet.datetimeRebaseModeInRead",
    "spark.sql.parquet.int96RebaseModeInWrite",
    "spark.sql.parquet.int96RebaseModeInRead",
)


def configure(spark: SparkSession) -> SparkSession:
    for key in _REBASE_KEYS:
        spark.conf.set(key, "CORRECTED")
    return spark


_own: set[str] = set()


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and Folders(spark).qualified(base).startswith("file:"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share: the warehouse is on a local disk")
    root = f"{base.rstrip('/')}/_snapvault/{spark.sparkContext.applicationId}"
    if spark.sparkContext.master.startswith("local[") and root not in _own:
        _own.add(root)  # in local mode nobody else cleans up when the process ends
        atexit.register(shutil.rmtree, re.sub(r"^file:(//)?", "", root), ignore_errors=True)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder named in ``spark.checkpoint.dir``, else under the warehouse. On a cluster a
    warehouse on a local disk is refused: each executor would write to its own."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the scratch folder; its listings and plans end here."""
    Folders(spark).delete(_scratch_root(spark))


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the scratch folder and read back.

    For a plan that decides what is copied or deleted: it is computed once, before the work changes
    what it was computed from, and a lost executor cannot change it afterwards.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write end with it. Else they lie on the disk until the driver happens to collect its garbage.

    For contents that are dealt out only to be written, once. A Spark that does not know the setting keeps them.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
