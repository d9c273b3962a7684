"""Retention as pure expressions over a catalogue of snapshots (``name``, ``size_bytes``)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.functions.naming import snapshot_source, snapshot_time, wall_clock, wall_clock_lit

def age_days(at: Column, as_of: datetime) -> Column:
    """Whole days between a TIMESTAMP_NTZ and ``as_of``, rounded down (negative for future times).

    Days between the dates, less one when the time of day is later than that of ``as_of``: wall
    clock arithmetic that no time zone of the session can shift.
    """
    as_of = wall_clock(as_of)
    days = F.datediff(F.lit(as_of.date()), at.cast("date"))
    time_of_day = F.substring(at.cast("string"), 12, 15)
    return (days - F.when(time_of_day > as_of.time().isoformat(), 1).otherwise(0)).cast("bigint")


def matches_name(name: Column, pattern: str) -> Column:
    """Case-insensitive substring test on the trimmed pattern; a blank pattern matches all."""
    return F.lower(name).contains(F.lower(F.lit(pattern.strip())))


def with_age(
    snapshots: DataFrame, as_of: datetime, retention_days: int = 30, pattern: str = "", strict: bool = False
) -> DataFrame:
    """Adds ``ts``, ``age_days``, ``is_expired`` and ``matches_pattern``."""
    if retention_days < 1:
        raise ValueError("retention_days must be at least 1")
    # Older than N whole days is N + 1 days or more: one comparison with a constant.
    try:
        expired = F.col("ts") <= wall_clock_lit(as_of - timedelta(days=retention_days + 1))
    except OverflowError:  # a limit before the year 1
        expired = F.lit(False)
    return (
        snapshots.withColumn("ts", snapshot_time(F.col("name"), strict))
        .withColumn("age_days", age_days(F.col("ts"), as_of))
        .withColumn("is_expired", F.coalesce(expired, F.lit(False)))
        .withColumn("matches_pattern", matches_name(F.col("name"), pattern))
    )


def with_action(aged: DataFrame) -> DataFrame:
    """Adds ``action``: ``invalid`` without a time, ``delete`` when it matches and expired, else ``retain``."""
    # Snapshots without a time are never expired, so the order of the first two does not matter;
    # this one lets a filter on "delete" shrink to the two conditions.
    action = (
        F.when(F.col("matches_pattern") & F.col("is_expired"), F.lit("delete"))
        .when(F.col("ts").isNull(), F.lit("invalid"))
        .otherwise(F.lit("retain"))
    )
    return aged.withColumn("action", action)


def retention_plan(
    snapshots: DataFrame, as_of: datetime, retention_days: int = 30, pattern: str = "", strict: bool = False
) -> DataFrame:
    return with_action(with_age(snapshots, as_of, retention_days, pattern, strict))


def _bytes(action: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("action") == action, F.col("size_bytes"))), F.lit(0))


def retention_summary(plan: DataFrame) -> DataFrame:
    valid = F.col("ts").isNotNull()
    return plan.agg(
        F.count(F.lit(1)).alias("total_backups"),
        F.count_if(valid).alias("valid_backups"),
        F.count_if(~valid).alias("invalid_backups"),
        F.count_if(valid & F.col("matches_pattern")).alias("pattern_matched"),
        F.count_if(F.col("action") == "delete").alias("expired_backups"),
        F.count_if(F.col("action") == "retain").alias("retained_backups"),
        _bytes("delete").alias("total_size_to_delete"),
        _bytes("retain").alias("total_size_to_retain"),
    )


def delete_list(plan: DataFrame, *ties: str) -> DataFrame:
    """Snapshots to delete, oldest first; ``ties`` orders those of the same second and name."""
    return plan.where(F.col("action") == "delete").orderBy("ts", "name", *ties)


def keep_list(plan: DataFrame, newest: int = 10, ties: str = "name") -> DataFrame:
    """The newest retained snapshots; ``ties`` orders those of the same second."""
    return plan.where(F.col("action") == "retain").orderBy(F.col("ts").desc(), ties).limit(newest)


def newest_as_of(snapshots: DataFrame, as_of: datetime) -> DataFrame:
    """Per source, the name and time of the newest snapshot not later than ``as_of``."""
    timed = snapshots.select("name", snapshot_time(F.col("name")).alias("ts"))
    newest = F.max(F.struct("ts", "name"))
    return (
        timed.where(F.col("ts") <= wall_clock_lit(as_of))
        .groupBy(snapshot_source(F.col("name")).alias("source"))
        .agg(newest.alias("newest"))
        .select("source", F.col("newest.name").alias("name"), F.col("newest.ts").alias("ts"))
    )


def retention_result(plan: DataFrame, deletions: DataFrame | None = None) -> DataFrame:
    """One result row; ``deletions`` (``name``, ``status``, ``size_bytes``) is absent on a dry run."""
    none = F.lit(None).cast("string")
    planned = plan.select("action", none.alias("status"), F.lit(0).cast("bigint").alias("size_bytes"))
    rows = planned
    if deletions is not None:
        rows = planned.unionByName(deletions.select(none.alias("action"), "status", "size_bytes"))
    done, failed = F.col("status") == "success", F.col("status") == "failed"
    freed = F.coalesce(F.sum(F.when(done, F.col("size_bytes"))), F.lit(0))
    failures = F.count_if(failed)
    outcome = (
        F.when(failures == 0, F.lit("success")).when(F.count_if(done) > 0, F.lit("partial")).otherwise(F.lit("failed"))
    )
    return rows.agg(
        outcome.alias("status"),
        F.lit(deletions is None).alias("dry_run"),
        F.count("action").alias("total_backups"),
        F.count_if(F.col("action") == "delete").alias("expired_backups"),
        F.count_if(done).alias("deleted_backups"),
        freed.alias("space_freed_bytes"),
        failures.alias("failed_deletions"),
    )
