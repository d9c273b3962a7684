"""Table commits by pointer, and checks that come before the commit."""

import os
from datetime import datetime, timedelta, timezone

import pytest

from snapvault import Lakehouse, Source, restore, snapshot
from snapvault.operators.tables import copy_table, store_table
from snapvault.sources import tables as table_sources
from snapvault.sources import versions
from snapvault.sources.hadoop import Folders
from snapvault.sources.tables import replace_table, scan_exact, scan_table


@pytest.fixture
def no_renames(monkeypatch):
    def refuse(self, source, target):
        raise OSError("this store has no rename")

    monkeypatch.setattr(Folders, "rename", refuse)


def ids(spark, path):
    return sorted(r[0] for r in scan_table(spark, path).select("id").collect())


def test_versions_need_no_rename(spark, tmp_path, no_renames):
    path = str(tmp_path / "t [1]")
    for n in (2, 3, 4):
        replace_table(spark, spark.range(n), path, commit="pointer")
        assert ids(spark, path) == list(range(n))
    held = [n for n in os.listdir(path) if n.startswith(versions.VERSION)]
    assert len(held) == 2 and len([n for n in os.listdir(f"{path}/{versions.POINTERS}") if n.isdigit()]) == 2
    with pytest.raises(OSError):
        replace_table(spark, spark.range(1), str(tmp_path / "u"), check=lambda: None)


def test_a_failing_check_leaves_the_table(spark, tmp_path, no_renames):
    path = str(tmp_path / "t")
    assert store_table(spark, "t", spark.range(5), path, commit="pointer")["status"] == "success"
    row = store_table(spark, "t", spark.range(9), path, overwrite=True, expected={"row_count": 8}, commit="pointer")
    assert row["status"] == "failed" and ids(spark, path) == list(range(5))
    assert len([n for n in os.listdir(path) if n.startswith(versions.VERSION)]) == 1
    # A table that has a pointer keeps being replaced by pointer.
    assert store_table(spark, "t", spark.range(3), path, overwrite=True)["status"] == "success"
    assert ids(spark, path) == [0, 1, 2]
    row = store_table(spark, "t", spark.range(1), path)
    assert row["status"] == "failed" and "FileExists" in row["error"] and ids(spark, path) == [0, 1, 2]


def test_a_first_version_that_fails_leaves_nothing(spark, tmp_path):
    for commit in table_sources.COMMITS:
        path = str(tmp_path / commit)
        row = store_table(spark, "t", spark.range(9), path, expected={"row_count": 8}, commit=commit)
        assert row["status"] == "failed" and not os.path.exists(path)


def test_of_two_writers_one_gets_through(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark, spark.range(1), path, commit="pointer")

    def meanwhile():
        replace_table(spark, spark.range(2), path, commit="pointer")

    with pytest.raises(versions.ConcurrentCommit):
        replace_table(spark, spark.range(3), path, check=meanwhile, commit="pointer")
    assert ids(spark, path) == [0, 1]


def test_a_reader_of_the_version_before_can_finish(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark, spark.range(4), path, commit="pointer")
    before = scan_table(spark, path)
    replace_table(spark, spark.range(6), path, commit="pointer")
    assert before.count() == 4 and scan_table(spark, path).count() == 6


def test_a_plain_table_becomes_one_of_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    replace_table(spark, spark.range(2), path, commit="pointer")
    assert ids(spark, path) == [0, 1]
    assert not [n for n in os.listdir(path) if n.endswith(".parquet")]


def test_unfinished_work_of_others_stays_until_it_is_old(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark, spark.range(1), path, commit="pointer")
    os.makedirs(f"{path}/{versions.VERSION}other")
    open(f"{path}/{versions.POINTERS}/{2:020d}", "w").close()  # a pointer that was begun
    assert ids(spark, path) == [0]
    with pytest.raises(versions.ConcurrentCommit):
        replace_table(spark, spark.range(2), path, commit="pointer")
    assert versions.collect_versions(spark, path) == []
    later = datetime.now(timezone.utc) + timedelta(hours=1)
    assert versions.collect_versions(spark, path, unfinished_before=later) == [f"{versions.VERSION}other"]
    replace_table(spark, spark.range(2), path, commit="pointer")
    assert ids(spark, path) == [0, 1]


def test_partitions_schema_and_copies(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "01"), (2, "02")], "id int, month string")
    replace_table(spark, rows, path, partition_by=["month"], commit="pointer")
    df, parts = scan_exact(spark, path)
    assert parts == ["month"] and {tuple(r) for r in df.collect()} == {(1, "01"), (2, "02")}
    assert copy_table(spark, "t", path, str(tmp_path / "copy"))["row_count"] == 2
    assert scan_exact(spark, str(tmp_path / "copy"))[1] == ["month"]


def test_snapshot_and_restore_of_versions(spark, tmp_path, no_renames):
    lake, target = Lakehouse(str(tmp_path / "lake")), Lakehouse(str(tmp_path / "target"))
    replace_table(spark, spark.range(3), f"{lake.tables}/one", commit="pointer")
    replace_table(spark, spark.range(7), f"{lake.tables}/one", commit="pointer")
    taken = snapshot(spark, Source(lake, "l", "w"), str(tmp_path / "backups"), datetime(2025, 1, 1), verify="content")
    assert {(r["status"], r["row_count"]) for r in taken.items.collect()} == {("success", 7)}
    for _ in range(2):
        run = restore(spark, taken.path, target, commit="pointer", verify="content")
        assert run.manifest.head()["status"] == "success" and ids(spark, f"{target.tables}/one") == list(range(7))


def test_formats_with_a_log_are_checked_before_they_are_replaced(spark, tmp_path, monkeypatch):
    """Parquet taken for a format that swaps by itself."""
    path = str(tmp_path / "t")
    spark.range(4).write.parquet(path)
    monkeypatch.setattr(table_sources, "FILE_FORMATS", ())

    def refuse():
        raise ValueError("not these")

    with pytest.raises(ValueError):
        replace_table(spark, spark.range(9), path, check=refuse)
    assert spark.read.parquet(path).count() == 4
    replace_table(spark, spark.range(9), path, check=lambda: None)
    assert spark.read.parquet(path).count() == 9
    assert os.listdir(tmp_path) == ["t"]


def test_unknown_commit(spark, tmp_path):
    with pytest.raises(ValueError):
        replace_table(spark, spark.range(1), str(tmp_path / "t"), commit="hope")
