"""Checks that read real tables and files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.functions.fingerprint import checksum, checksum_aggregates, row_hash
from snapvault.operators.audit import read_items
from snapvault.operators.filecopy import file_digests
from snapvault.operators.items import in_parallel
from snapvault.operators.tables import message
from snapvault.plans.verify import compare_checksums, compare_rows, counts_checked, same_columns, verify_files
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import only_files, walk
from snapvault.sources.tables import scan_exact

CONTENT = (
    "name string, verified boolean, data_matches boolean, expected_rows bigint, actual_rows bigint, "
    "missing_rows bigint, extra_rows bigint, error string"
)


BUCKETS = 4096


def bucket_checksums(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Count and checksum of the rows of each ``bucket``, a remainder of their hash; summed up before anything moves."""
    hashed = df.select(row_hash(df.schema).alias("hash"))
    return hashed.groupBy(F.pmod("hash", F.lit(buckets)).alias("bucket")).agg(*checksum_aggregates(F.col("hash")))


def in_buckets(df: DataFrame, wanted: list[int], buckets: int = BUCKETS) -> DataFrame:
    return df.where(F.pmod(row_hash(df.schema), F.lit(buckets)).isin(wanted))


def compare_screened(expected: DataFrame, actual: DataFrame, buckets: int = BUCKETS) -> tuple[int, int, int, int]:
    """Expected, actual, missing and extra rows, as :func:`compare_rows` counts them, where only rows of buckets that differ meet.

    Both sides are read once for the checksums of their buckets, at most ``buckets`` rows each, and once more, filtered before the
    shuffle, if any differ. Rows of a bucket are taken for the same if their number, sum and xor of 64-bit hashes agree.
    """
    actual = actual.select(*[F.col(f"`{c}`") for c in expected.columns])
    sides = [{r["bucket"]: tuple(r)[1:] for r in bucket_checksums(df, buckets).collect()} for df in (expected, actual)]
    counts = [sum(r[0] for r in side.values()) for side in sides]
    differing = sorted(b for b in sides[0].keys() | sides[1].keys() if sides[0].get(b) != sides[1].get(b))
    if not differing:
        return (*counts, 0, 0)
    row = compare_rows(*[in_buckets(df, differing, buckets) for df in (expected, actual)]).head()
    return (*counts, row["missing_rows"], row["extra_rows"])


def verify_content(
    spark: SparkSession,
    pairs: dict[str, tuple[str, str]],
    fmt: str = "parquet",
    exact: bool = False,
    width: int = 8,
    screen: bool = False,
) -> DataFrame:
    """Compare tables (name: expected path, actual path) by content, whatever their row order.

    The checksum reads each side once and shuffles nothing; ``exact`` counts missing and extra rows, with one shuffle of all rows, or
    with ``screen`` only of those in hash buckets whose checksums differ (:func:`compare_screened`).
    """

    def one(pair):
        name, (expected_path, actual_path) = pair
        try:
            expected, _ = scan_exact(spark, expected_path, fmt)
            actual, _ = scan_exact(spark, actual_path, fmt)
            if not same_columns(expected, actual):
                return (name, True, False, expected.count(), actual.count(), None, None, "columns differ")
            if exact and screen:
                found = compare_screened(expected, actual)
                return (name, True, not any(found[2:]), *found, None)
            if exact:
                row = compare_rows(expected, actual).head()
                return (name, True, not row["missing_rows"] and not row["extra_rows"], *row, None)
            row = compare_checksums(expected, actual).head()
            return (name, True, row["content_matches"], row["expected_rows"], row["actual_rows"], None, None, None)
        except Exception as error:
            return (name, False, False, None, None, None, None, message(error))

    return spark.createDataFrame(in_parallel(spark, one, list(pairs.items()), width), CONTENT)


def verify_tables(
    spark: SparkSession, items: DataFrame, content: bool = False, fmt: str = "parquet", width: int = 8
) -> DataFrame:
    """Tables that a run wrote against its item records: row count, or count and checksum.

    The row count of a Parquet table comes from its footers; ``content`` reads it once.
    """
    rows = items.where("kind = 'table' AND status = 'success'").collect()  # one small row per table

    def one(row):
        try:
            known = T.StructType.fromJson(json.loads(row["schema_json"])), row["partition_columns"] or []
            df, _ = scan_exact(spark, row["target_path"], fmt, known)
            if not content:
                return (row["name"], df.count(), None, None)
            found = checksum(df).head()
            same = (found["hash_sum"], found["hash_xor"]) == (row["hash_sum"], row["hash_xor"])
            return (row["name"], found["row_count"], same, None)
        except Exception as error:
            return (row["name"], None, None, message(error))

    found = [(*f, r["row_count"]) for f, r in zip(in_parallel(spark, one, rows, width), rows)]
    columns = "name string, actual_rows bigint, same boolean, error string, expected_rows bigint"
    checked = counts_checked(spark.createDataFrame(found, columns))
    return checked.withColumn("data_matches", F.col("data_matches") & F.coalesce("same", F.lit(True))).select(
        "name", "verified", "data_matches", "expected_rows", "actual_rows", "error"
    )


def verify_copied_files(
    spark: SparkSession, items: DataFrame, root: str, rows_table: DataFrame | None = None, content: bool = False
) -> DataFrame | None:
    """Files that a run copied against what is below ``root`` now; None if it copied none.

    With ``content`` every file whose digest is on record is read, 64 MB a row of work, and compared with it.
    """
    if items.where("kind = 'file' AND status = 'success'").isEmpty():
        return None
    done = items.where("kind = 'file' AND status = 'success'")
    expected = done.select(F.col("name").alias("relative_path"), F.col("size_bytes").alias("size"))
    if Folders(spark).exists(root):
        present = only_files(walk(spark, root, include_hidden=True)).select("relative_path", "size")
    else:
        present = spark.createDataFrame([], "relative_path string, size bigint")
    if content:
        recorded = done.where("digest IS NOT NULL").select(F.col("name").alias("relative_path"), "digest")
        found = file_digests(spark, root, present.join(recorded, "relative_path", "left_semi"))
        present = present.join(found.select("relative_path", "digest"), "relative_path", "left")
        expected = expected.join(recorded, "relative_path", "left")
    return verify_files(expected, present, rows_table)


def verify_snapshot(
    spark: SparkSession, snapshot: str, content: bool = True, fmt: str = "parquet", width: int = 8
) -> tuple[DataFrame, DataFrame | None]:
    """Table checks and file checks of a snapshot against its own item records."""
    items = read_items(spark, snapshot)
    # The records name the folder written to at the time; the snapshot may have been moved since.
    here = items.withColumn("target_path", F.concat(F.lit(f"{snapshot}/tables/"), F.col("name")))
    return verify_tables(spark, here, content, fmt, width), verify_copied_files(
        spark, items, f"{snapshot}/files", content=content
    )
