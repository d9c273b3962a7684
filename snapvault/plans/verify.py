"""Checks between a source and its copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.functions.fingerprint import checksum, named

MISMATCH = "rows are not those recorded"


def counts_checked(both: DataFrame) -> DataFrame:
    """Adds ``verified`` and ``data_matches`` to ``expected_rows`` and ``actual_rows``.

    A table is verified when both sides could be counted; only then can the data match.
    """
    verified = F.col("expected_rows").isNotNull() & F.col("actual_rows").isNotNull()
    return both.withColumns(
        {"verified": verified, "data_matches": verified & F.col("expected_rows").eqNullSafe(F.col("actual_rows"))}
    )


def verify_counts(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Row counts side by side (``name``, ``row_count`` on both sides)."""
    left = expected.select("name", F.col("row_count").alias("expected_rows"))
    right = actual.select("name", F.col("row_count").alias("actual_rows"))
    both = counts_checked(left.join(right, "name", "full_outer"))
    return both.select("name", "verified", "data_matches", "expected_rows", "actual_rows")


def refused_tables(items: DataFrame) -> DataFrame:
    """Tables that were not put in place because their rows are not those on the record, as failed checks."""
    refused = (F.col("kind") == "table") & (F.col("status") == "failed") & F.contains("error", F.lit(MISMATCH))
    rows = items.where(refused).select("name", F.lit(None).cast("bigint").alias("expected_rows"), F.lit(None).cast("bigint").alias("actual_rows"))
    return counts_checked(rows).select("name", "verified", "data_matches", "expected_rows", "actual_rows")


def verify_files(source: DataFrame, target: DataFrame, kept_as_rows: DataFrame | None = None) -> DataFrame:
    """Per source file: is it at the target (as a file, or as a row of the fallback table), same size?

    Where both sides have a ``digest``, also ``content_matches``: null for files that are not there, not as files, or without a digest
    on record; false where the target's could not be taken.
    """
    content = "digest" in source.columns and "digest" in target.columns
    found = target.select("relative_path", F.col("size").alias("target_size"), F.lit("file_copy").alias("restore_method"))
    if content:
        digests = target.select("relative_path", F.col("digest").alias("target_digest"))
    if kept_as_rows is not None:
        rows = kept_as_rows.select(
            F.col("original_path").alias("relative_path"),
            F.col("size_bytes").alias("target_size"),
            F.lit("table_copy").alias("restore_method"),
        )
        found = found.unionByName(rows)
        found = found.groupBy("relative_path").agg(
            F.min_by("target_size", "restore_method").alias("target_size"),
            F.min("restore_method").alias("restore_method"),
        )
    exists = F.col("restore_method").isNotNull()
    joined, more = source.join(found, "relative_path", "left"), []
    if content:
        joined = joined.join(digests, "relative_path", "left")
        known = (F.col("restore_method") == "file_copy") & F.col("digest").isNotNull()
        more = [F.when(known, F.col("digest").eqNullSafe(F.col("target_digest"))).alias("content_matches")]
    return joined.select(
        "relative_path",
        exists.alias("file_exists"),
        (exists & F.col("size").eqNullSafe(F.col("target_size"))).alias("size_matches"),
        "restore_method",
        *more,
    )


def verdict(tables: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """One row over all checks; any mismatch clears ``overall_success``."""
    rows = tables.select(F.lit("table").alias("kind"), "verified", F.col("data_matches").alias("ok"))
    if files is not None:
        same = F.coalesce("content_matches", F.lit(True)) if "content_matches" in files.columns else F.lit(True)
        checks = files.select(
            F.lit("file").alias("kind"),
            F.lit(True).alias("verified"),
            (F.col("file_exists") & F.col("size_matches") & same).alias("ok"),
        )
        rows = rows.unionByName(checks)
    is_table, is_file = F.col("kind") == "table", F.col("kind") == "file"
    return rows.agg(
        F.count_if(is_table & F.col("verified")).alias("tables_verified"),
        F.count_if(is_table & F.col("ok")).alias("tables_matching"),
        F.count_if(is_file).alias("files_verified"),
        F.count_if(is_file & F.col("ok")).alias("files_matching"),
        F.coalesce(F.bool_and(F.col("verified") & F.col("ok")), F.lit(True)).alias("overall_success"),
    )


def _holds_variant(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_variant(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds_variant(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _holds_variant(dtype.valueType)
    return isinstance(dtype, T.VariantType)


def _comparable(df: DataFrame) -> list[Column]:
    """Columns by name, as they can be grouped: variants as JSON text, strings by their bytes."""
    out = []
    for field in sorted(df.schema.fields, key=lambda f: f.name):
        column = named(field.name)
        if _holds_variant(field.dataType):
            column = F.to_json(F.struct(column))
        elif isinstance(field.dataType, T.StringType) and not field.dataType.isUTF8BinaryCollation():
            column = F.collate(column, "UTF8_BINARY")
        out.append(column.alias(field.name))
    return out


def same_columns(expected: DataFrame, actual: DataFrame) -> bool:
    """Same names and types; order and nullability do not count."""
    shape = lambda df: sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return shape(expected) == shape(actual)


def _copies(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Every distinct row of both sides with the number of its copies on each.

    One shuffle serves both directions. Copies of a row meet in the map-side aggregation first, so
    a row repeated a billion times is one record per task.
    """
    side = lambda df, e, a: df.select(*_comparable(df), F.lit(e).alias("__expected"), F.lit(a).alias("__actual"))
    rows = side(expected, 1, 0).unionByName(side(actual, 0, 1))
    keys = [named(c) for c in rows.columns if c not in ("__expected", "__actual")]
    return rows.groupBy(*keys).agg(F.sum("__expected").alias("__expected"), F.sum("__actual").alias("__actual"))


def row_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Exact difference: the rows whose number of copies differs, with ``surplus``.

    ``surplus`` is positive for copies missing from ``actual``, negative for copies too many.
    """
    surplus = (F.col("__expected") - F.col("__actual")).alias("surplus")
    rows = _copies(expected, actual)
    kept = [named(c) for c in rows.columns if c not in ("__expected", "__actual")]
    return rows.where("__expected <> __actual").select(*kept, surplus)


def compare_rows(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: the size of both sides, ``missing_rows`` and ``extra_rows``, counted exactly."""
    e, a = F.col("__expected"), F.col("__actual")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return _copies(expected, actual).agg(
        total(e).alias("expected_rows"),
        total(a).alias("actual_rows"),
        total(F.greatest(e - a, F.lit(0))).alias("missing_rows"),
        total(F.greatest(a - e, F.lit(0))).alias("extra_rows"),
    )


def compare_checksums(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: counts of both sides and whether count and checksum agree. No shuffle of rows."""
    sides = checksum(expected).withColumn("side", F.lit("e")).unionByName(checksum(actual).withColumn("side", F.lit("a")))
    row = F.struct("row_count", "hash_sum", "hash_xor")
    both = sides.agg(
        F.max(F.when(F.col("side") == "e", row)).alias("e"), F.max(F.when(F.col("side") == "a", row)).alias("a")
    )
    return both.select(
        F.col("e.row_count").alias("expected_rows"),
        F.col("a.row_count").alias("actual_rows"),
        (F.col("e") == F.col("a")).alias("content_matches"),
    )
