"""Spreading rows that stand for work outside Spark, such as directories, files and archive entries.

Spark balances partitions by the bytes of the rows themselves, which say nothing about that work.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TASK_BYTES = 512 << 20
FILE_COST = 2 << 20  # opening and closing a file, expressed in bytes
MAX_TASKS = 50_000
TASKS_PER_CORE = 16


def spread(paths: DataFrame, count: int) -> DataFrame:
    """Repartition ``count`` rows with a ``relative_path`` for work that is the same for each."""
    most = paths.sparkSession.sparkContext.defaultParallelism * 4
    return paths.repartition(max(1, min(count, most)), "relative_path")


def useful_tasks(spark: SparkSession) -> int:
    """Tasks that keep all cores busy to the end, however small the work of each."""
    return max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread_by_size(files: DataFrame, key: Column, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Repartition rows with a ``size`` so that tasks get about the same number of bytes.

    Sizes are grouped by powers of two (at most 64 groups come to the driver). Every group gets its
    own range of tasks, large files first, and rows fall into that range by hash: within a group
    sizes differ by a factor of two at most, so equal counts are near-equal bytes.

    The number of files alone makes no more tasks than the cluster has use for (:func:`useful_tasks`): every task of the step
    before deals its rows out to all of these, and each of them leaves a file and a shuffle output to the next step, so tasks that
    grow with the files would cost their square. Beyond that a task gets more files.
    """
    weight = F.coalesce(F.col("size"), F.lit(0)) + F.lit(FILE_COST)
    group = F.floor(F.log2(weight)).cast("int")
    sums = F.count(F.lit(1)).alias("n"), F.sum(weight - F.lit(FILE_COST)).alias("size")
    rows = files.groupBy(group.alias("g")).agg(*sums).collect()
    if not rows:
        return files
    cost = min(FILE_COST, task_bytes * useful_tasks(files.sparkSession) / sum(r["n"] for r in rows))
    work = {r["g"]: r["size"] + r["n"] * cost for r in rows}
    target = max(task_bytes, sum(work.values()) / MAX_TASKS)
    slot, first = F.lit(0), 0
    for row in sorted(rows, key=lambda r: -r["g"]):
        tasks = min(row["n"], math.ceil(work[row["g"]] / target))
        within = F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int") + F.lit(first)
        slot = F.when(group == row["g"], within).otherwise(slot)
        first += tasks
    return files.repartitionById(first, slot)
