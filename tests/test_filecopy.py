import io
import os
from datetime import datetime

import pytest
from conftest import tree_of, write_tree
from pyspark.sql import functions as F

from snapvault.operators.filecopy import copy_files, files_as_table, write_files
from snapvault.plans.verify import verdict, verify_counts, verify_files
from snapvault.sources.inventory import only_files, walk
from snapvault.sources.spreading import FILE_COST, spread_by_size, useful_tasks

FILES = {"a.txt": "a", "empty": "", "d/x y%.bin": b"\x00" * 10_000_000, "d/e/f": "f", "ü": "u"}


def test_copy_and_status(spark, tmp_path):
    source, target = write_tree(tmp_path / "s", FILES), str(tmp_path / "t")
    files = only_files(walk(spark, source)).select("relative_path", "size")
    more = files.unionAll(spark.createDataFrame([("gone", 5), ("../a", 1)], files.schema))
    status = copy_files(spark, more, source, target)
    rows = {r["relative_path"]: r for r in status.collect()}
    assert {n for n, r in rows.items() if r["status"] == "failed"} == {"gone", "../a"} and "FileNotFound" in rows["gone"]["error"]
    assert tree_of(target) == tree_of(source)
    assert all(rows[f]["written_bytes"] == len(c.encode() if isinstance(c, str) else c) for f, c in FILES.items())
    os.remove(f"{target}/a.txt")
    assert status.count() == len(rows) and not os.path.exists(f"{target}/a.txt")  # using the status does not copy again
    copy_files(spark, files, source, target)
    assert tree_of(target) == tree_of(source)


def test_copy_between_different_stores(spark, tmp_path, monkeypatch):
    """The streaming way, taken when source and target are not the same file system."""
    from snapvault.sources import workers

    import pyarrow as pa
    import pyarrow.fs as pafs

    source = write_tree(tmp_path / "s", FILES)
    real = workers.resolve
    inside = pafs.SubTreeFileSystem(source, pafs.LocalFileSystem())
    monkeypatch.setattr(workers, "resolve", lambda uri: (inside, "") if uri == "other:" else real(uri))
    batch = pa.RecordBatch.from_pydict({"relative_path": list(FILES), "size": [0] * len(FILES)})
    out = list(workers.copier("other:", str(tmp_path / "t"), ".st")(iter([batch])))
    assert set(out[0].column("status").to_pylist()) == {"success"}
    found = {k: v for k, v in tree_of(tmp_path / "t").items()}
    assert found == tree_of(source)


def test_rows_to_files_and_back(spark, tmp_path):
    rows = [(n, bytearray(c if isinstance(c, bytes) else c.encode())) for n, c in FILES.items()]
    root = str(tmp_path / "Files")
    write_files(spark, spark.createDataFrame(rows, "relative_path string, content binary"), root)
    assert tree_of(root) == {n: bytes(c) for n, c in rows}
    table = files_as_table(spark, root, str(tmp_path / "table"), datetime(2025, 1, 1))
    got = {r["original_path"]: bytes(r["content"]) for r in table.collect()}
    assert got == {n: bytes(c) for n, c in rows}
    assert table.columns == ["original_path", "file_name", "file_type", "part", "offset", "content", "size_bytes", "restored_timestamp", "restoration_note"]


def test_spread_by_size_balances_bytes(spark):
    # A third of all bytes in one file, a tail of small ones.
    sizes = [10_000_000_000] + [100_000_000] * 100 + [1_000] * 20_000
    df = spark.createDataFrame([(f"f{i}", s) for i, s in enumerate(sizes)], "relative_path string, size bigint")
    spread = spread_by_size(df, F.col("relative_path"), task_bytes=500_000_000)
    load = spread.withColumn("p", F.spark_partition_id()).groupBy("p")
    rows = load.agg(F.sum(F.col("size") + FILE_COST).alias("w"), F.count(F.lit(1)).alias("n")).collect()
    assert sum(r["n"] for r in rows) == len(sizes)
    biggest = max(rows, key=lambda r: r["w"])
    assert biggest["n"] == 1 and biggest["p"] == 0  # the giant is alone and starts first
    assert max(r["w"] for r in rows if r is not biggest) < 4 * 500_000_000
    assert spread_by_size(df.where("false"), F.col("relative_path")).count() == 0


def test_spread_by_size_gives_many_small_files_no_more_tasks(spark):
    """Tasks that grow with the number of files cost its square in shuffle blocks."""
    few, many = [
        spark.range(n).select(F.col("id").cast("string").alias("relative_path"), (F.col("id") % 3000).alias("size")) for n in (40_000, 400_000)
    ]
    tasks = [spread_by_size(df, F.col("relative_path")).rdd.getNumPartitions() for df in (few, many)]
    assert tasks[0] > 4 and max(tasks) <= useful_tasks(spark) + 2
    load = spread_by_size(many, F.col("relative_path")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in load) == 400_000 and max(r["count"] for r in load) < 2 * 400_000 / tasks[1]


def test_spread_keeps_unknown_sizes(spark):
    df = spark.createDataFrame([("a", None), ("b", 0), ("c", 10)], "relative_path string, size bigint")
    assert spread_by_size(df, F.col("relative_path")).count() == 3


def test_checks(spark):
    frame = lambda rows: spark.createDataFrame(rows, "name string, row_count bigint")
    rows = verify_counts(frame([("a", 1), ("b", 2), ("c", None), ("d", 4)]), frame([("a", 1), ("b", 3), ("c", 3), ("e", 5)]))
    got = {r["name"]: (r["verified"], r["data_matches"]) for r in rows.collect()}
    assert got == {"a": (True, True), "b": (True, False), "c": (False, False), "d": (False, False), "e": (False, False)}
    files = lambda rows: spark.createDataFrame(rows, "relative_path string, size bigint")
    kept = spark.createDataFrame([("y", 2), ("x", 1)], "original_path string, size_bytes bigint")
    checks = verify_files(files([("x", 1), ("y", 2), ("z", 3)]), files([("x", 1)]), kept)
    got = {r["relative_path"]: (r["file_exists"], r["size_matches"], r["restore_method"]) for r in checks.collect()}
    assert got == {"x": (True, True, "file_copy"), "y": (True, True, "table_copy"), "z": (False, False, None)}
    row = verdict(rows, checks).head()
    assert tuple(row) == (2, 1, 3, 2, False)
    assert verdict(rows.where("name = 'a'"), checks.where("file_exists")).head()["overall_success"]
    assert verdict(rows.where("false")).head()["overall_success"]


def test_each_task_stages_in_a_folder_of_its_own(tmp_path):
    """In one folder for all, tasks that write at the same moment wait for one another."""
    from snapvault.sources import workers

    targets = [workers.Target(str(tmp_path), ".staging") for _ in range(2)]
    for i, target in enumerate(targets):
        target.put(io.BytesIO(b"x"), f"a/{i}")
    assert len(os.listdir(tmp_path / ".staging")) == 2 and sorted(os.listdir(tmp_path / "a")) == ["0", "1"]
    assert not any(files for _, _, files in os.walk(tmp_path / ".staging"))


@pytest.mark.parametrize("text", ["x", "ä" * 10])
def test_write_files_needs_a_path_below_the_root(spark, tmp_path, text):
    rows = spark.createDataFrame([("../out", bytearray(text.encode())), ("/abs", bytearray(b"x"))], "relative_path string, content binary")
    assert {r["status"] for r in write_files(spark, rows, str(tmp_path / "r")).collect()} == {"failed"}
    assert not os.path.exists(tmp_path / "out")


def test_row_differences_on_a_hot_row(spark):
    from snapvault.plans.verify import compare_rows, row_differences

    base = spark.range(3000).select(F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("v"))
    less = base.where("v <> 2000").unionAll(spark.createDataFrame([(-1,), (-1,), (-5,)], "v bigint"))
    assert {tuple(r) for r in row_differences(base, less).collect()} == {(2000, 1), (-1, -2), (-5, -1)}
    assert tuple(compare_rows(base, less).head()) == (3000, 3002, 1, 3)
    plan = compare_rows(base, less)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_files_as_rows_in_small_batches_and_unreadable_ones(spark, tmp_path, monkeypatch):
    from snapvault.sources import workers

    import pyarrow as pa

    root = write_tree(tmp_path / "s", FILES)
    sizes = [len(tree_of(root)[n]) for n in FILES] + [7]
    zeros = [0] * len(sizes)
    batch = pa.RecordBatch.from_pydict({"relative_path": [*FILES, "gone"], "size": sizes, "part": zeros, "offset": zeros})
    out = list(workers.reader(root)(iter([batch])))
    rows = {r["relative_path"]: r for b in out for r in b.to_pylist()}
    assert "FileNotFound" in rows.pop("gone")["error"]
    assert {n: r["content"] for n, r in rows.items()} == tree_of(root)
    monkeypatch.setattr(workers, "BATCH_BYTES", 1)
    assert len(list(workers.reader(root)(iter([batch])))) > len(out)


def test_a_file_takes_as_many_rows_as_it_needs(spark, tmp_path):
    from snapvault.operators.filecopy import kept_files

    root = write_tree(tmp_path / "s", {"seven": "abcdefg", "six": "abcdef", "none": ""})
    rows = files_as_table(spark, root, str(tmp_path / "t[1]"), datetime(2025, 1, 1), part_bytes=3).collect()
    parts = sorted((r["original_path"], r["part"], r["offset"], bytes(r["content"])) for r in rows)
    assert parts == [
        ("none", 0, 0, b""), ("seven", 0, 0, b"abc"), ("seven", 1, 3, b"def"), ("seven", 2, 6, b"g"), ("six", 0, 0, b"abc"), ("six", 1, 3, b"def"),
    ]
    table = spark.read.parquet(str(tmp_path / "t\\[1\\]"))
    assert {tuple(r) for r in kept_files(table).collect()} == {("none", 0), ("seven", 7), ("six", 6)}
    assert {tuple(r) for r in kept_files(table.where("part <> 1 OR file_name = 'six'")).collect()} == {("none", 0), ("seven", None), ("six", 6)}


def test_overwrite_where_a_move_refuses(tmp_path):
    from snapvault.sources import workers

    import io

    class Refusing(workers.pafs.LocalFileSystem):
        def move(self, source, target):
            if self.get_file_info(target).type != workers.pafs.FileType.NotFound:
                raise OSError("target exists")
            super().move(source, target)

    target = workers.Target(str(tmp_path), ".staging")
    target.fs = Refusing()
    for text in (b"old", b"new"):
        assert target.put(io.BytesIO(text), "f") == 3
    assert (tmp_path / "f").read_bytes() == b"new"


def test_rows_without_path_or_content_are_failures(spark, tmp_path):
    rows = spark.createDataFrame([("a", None), (None, bytearray(b"x")), ("b", bytearray(b"y"))], "relative_path string, content binary")
    got = {(r["relative_path"], r["status"]) for r in write_files(spark, rows, str(tmp_path / "w")).collect()}
    assert got == {("a", "failed"), (None, "failed"), ("b", "success")}


def test_tasks_can_run_again(tmp_path):
    """What a lost executor had already done does not disturb the second attempt."""
    from snapvault.sources import workers

    import pyarrow as pa

    source, target = write_tree(tmp_path / "s", FILES), str(tmp_path / "t")
    batch = pa.RecordBatch.from_pydict({"relative_path": list(FILES), "size": [0] * len(FILES)})
    statuses = lambda run: {s for b in run(iter([batch])) for s in b.column("status").to_pylist()}
    for _ in range(2):
        assert statuses(workers.copier(source, target, ".staging-x")) == {"success"}
    assert {k: v for k, v in tree_of(target).items() if not k.startswith(".staging")} == tree_of(source)
    for _ in range(2):
        assert statuses(workers.deleter(target, False)) == {"success"}
    assert tree_of(target) == {}


def test_rows_of_one_partition_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.createDataFrame([(f"a/{i}.txt", b"x" * i) for i in range(200)], "relative_path string, content binary").coalesce(1)
    done = write_files(spark, rows, str(tmp_path / "many"), str(tmp_path / "status"))
    assert {(r["status"], r["written_bytes"]) for r in done.collect()} == {("success", i) for i in range(200)}
    assert len(list((tmp_path / "status").glob("part-*"))) > 1
