import os
import shutil
from datetime import datetime

import pytest
from conftest import tree_of, write_tree

from snapvault import Lakehouse, Source, restore, snapshot
from snapvault.operators.restore import layout_of
from snapvault.plans.restore import archive_format, restore_plan, select_names, snapshot_tables
from snapvault.sources.tables import scan_table

AT = datetime(2025, 11, 10, 14, 30, 15)
FILES = {"a.csv": "1", "s/b.txt": "22", "s/c.txt": "333"}


@pytest.fixture(scope="module")
def taken(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = Lakehouse(str(root / "lake"))
    for n, table in enumerate(("one", "two", "three_metadata"), 1):
        spark.range(n).write.parquet(f"{lake.tables}/{table}")
    write_tree(lake.files, FILES)
    return snapshot(spark, Source(lake, "l", "w"), str(root / "backups"), AT).path


def statuses(run):
    return {(r["kind"], r["name"]): r["status"] for r in run.items.collect()}


def copy_of(taken, tmp_path):
    path = str(tmp_path / "moved")
    shutil.copytree(taken, path)
    return path


def test_existing_items_are_skipped_unless_overwritten(spark, taken, tmp_path):
    target = Lakehouse(str(tmp_path / "t"))
    spark.range(99).write.parquet(f"{target.tables}/one")
    write_tree(target.files, {"s/b.txt": "kept"})
    run = restore(spark, taken, target, overwrite=False)
    got = statuses(run)
    assert got["table", "one"] == got["file", "s/b.txt"] == "skipped"
    assert sorted(got.values()) == ["skipped"] * 2 + ["success"] * 4
    assert scan_table(spark, f"{target.tables}/one").count() == 99
    assert tree_of(target.files)["s/b.txt"] == b"kept"
    row = run.manifest.head()
    assert (row["tables_restored"], row["tables_skipped"], row["files_restored"], row["files_skipped"]) == (2, 1, 2, 1)
    assert row["verification_passed"] and row["total_size"] == 4

    got = statuses(restore(spark, taken, target))
    assert set(got.values()) == {"success"}
    assert scan_table(spark, f"{target.tables}/one").count() == 1
    assert tree_of(target.files)["s/b.txt"] == b"22"
    assert not [n for n in os.listdir(target.tables) if n.startswith(".")]


def test_selection(spark, taken, tmp_path):
    target = Lakehouse(str(tmp_path / "t"))
    got = statuses(restore(spark, taken, target, table_names=["two", "nope"], file_patterns=["s/*.txt", "zzz"]))
    assert set(got) == {("table", "two"), ("file", "s/b.txt"), ("file", "s/c.txt")}
    got = statuses(restore(spark, taken, Lakehouse(str(tmp_path / "u")), tables=False))
    assert {k for k, _ in got} == {"file"}
    got = statuses(restore(spark, taken, Lakehouse(str(tmp_path / "v")), files=False))
    assert {k for k, _ in got} == {"table"}


def test_dry_run_changes_nothing(spark, taken, tmp_path):
    target = Lakehouse(str(tmp_path / "t"))
    spark.range(99).write.parquet(f"{target.tables}/one")
    before = tree_of(tmp_path)
    run = restore(spark, taken, target, overwrite=False, dry_run=True)
    got = statuses(run)
    assert got.pop(("table", "one")) == "skipped" and set(got.values()) == {"dry_run"} and len(got) == 5
    assert run.manifest is None and tree_of(tmp_path) == before


def test_unfinished_snapshot_needs_consent(spark, taken, tmp_path):
    moved = copy_of(taken, tmp_path)
    shutil.rmtree(f"{moved}/_manifest")
    with pytest.raises(ValueError, match="no manifest"):
        restore(spark, moved, Lakehouse(str(tmp_path / "t")))
    run = restore(spark, moved, Lakehouse(str(tmp_path / "t")), require_manifest=False)
    assert set(statuses(run).values()) == {"success"}


def test_snapshot_of_another_tool_has_sidecar_tables(spark, taken, tmp_path):
    moved = copy_of(taken, tmp_path)
    assert ("table", "three_metadata") in statuses(restore(spark, moved, Lakehouse(str(tmp_path / "t")), files=False))
    shutil.rmtree(f"{moved}/_items")
    got = statuses(restore(spark, moved, Lakehouse(str(tmp_path / "u")), files=False))
    assert set(got) == {("table", "one"), ("table", "two")}


def test_damaged_table_fails_alone(spark, taken, tmp_path):
    moved = copy_of(taken, tmp_path)
    for name in os.listdir(f"{moved}/tables/one"):
        if name.endswith(".parquet"):
            write_tree(f"{moved}/tables/one", {name: "damaged", f".{name}.crc": ""})
    run = restore(spark, moved, Lakehouse(str(tmp_path / "t")))
    got = statuses(run)
    assert got.pop(("table", "one")) == "failed" and set(got.values()) == {"success"}
    assert run.manifest.head()["status"] == "partial"


def test_layouts(spark, taken, tmp_path):
    write_tree(tmp_path / "zip", {"x.zip": "z", "tables/_t/x": "x"})
    write_tree(tmp_path / "intable", {"files_backup_zip_data/p.parquet": "z", "sub/x.zip": "z"})
    write_tree(tmp_path / "other", {"files/x": "z"})
    found = [layout_of(spark, taken)] + [layout_of(spark, str(tmp_path / n)) for n in ("zip", "intable", "other")]
    assert found == ["direct_copy", "zip_file", "zip_in_table", "unknown"]
    with pytest.raises(ValueError):
        restore(spark, str(tmp_path / "other"), Lakehouse(str(tmp_path / "t")))
    with pytest.raises(FileNotFoundError):
        restore(spark, str(tmp_path / "missing"), Lakehouse(str(tmp_path / "t")))


def test_plans(spark):
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "name string")
    rows = restore_plan(names("a", "b"), names("b", "c"), overwrite=False).collect()
    assert {r["name"]: r["action"] for r in rows} == {"a": "restore", "b": "skip"}
    rows = restore_plan(names("a", "b"), names("b", "c"), overwrite=True).collect()
    assert {r["action"] for r in rows} == {"restore"}
    assert select_names(names("a", "b"), []).count() == 2
    assert snapshot_tables(names("a", "_x", "a_metadata")).collect()[0]["name"] == "a"


@pytest.mark.parametrize(
    "preference, expected",
    [("auto", ["parquet", "parquet", "csv", "none"]), ("parquet", ["parquet", "parquet", "csv", "none"]),
     ("csv", ["csv", "parquet", "csv", "none"])],
)
def test_archive_format(one, preference, expected):
    from pyspark.sql import functions as F

    rows = [(True, True), (True, False), (False, True), (False, False)]
    got = one(rows, "p boolean, c boolean", archive_format(preference, F.col("p"), F.col("c")))
    assert [g[0] for g in got] == expected
    with pytest.raises(ValueError):
        archive_format("xml", F.col("p"), F.col("c"))


def test_snapshot_that_changed_since_it_was_taken_is_noticed(spark, taken, tmp_path):
    moved = copy_of(taken, tmp_path)
    assert restore(spark, moved, Lakehouse(str(tmp_path / "t"))).manifest.head()["verification_passed"]
    before = sorted(spark.read.parquet(str(tmp_path / "t/Tables/two")).collect())
    spark.range(7, 9).write.mode("overwrite").parquet(f"{moved}/tables/two")  # as many rows, other values
    run = restore(spark, moved, Lakehouse(str(tmp_path / "t")))
    row = run.manifest.head()
    assert (row["verification_passed"], row["status"]) == (False, "failed")
    failed = run.items.where("status = 'failed'").collect()
    assert [r["name"] for r in failed] == ["two"] and "not those recorded" in failed[0]["error"]
    assert sorted(spark.read.parquet(str(tmp_path / "t/Tables/two")).collect()) == before


def test_files_in_a_target_folder_that_cannot_be_listed_survive(spark, taken, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from snapvault.operators import restore as module

    target = Lakehouse(str(tmp_path / "t"))
    restore(spark, taken, target, tables=False)
    names = [r["name"] for r in restore(spark, taken, target, tables=False, dry_run=True).items.collect()]
    for name in names:
        with open(f"{target.files}/{name}", "w") as f:
            f.write("newer")
    real = module.walk

    def faulty(spark, root, **options):
        rows = real(spark, root, **options)
        if root != target.files:
            return rows
        lost = spark.createDataFrame([("", "", True, None, None, "503", )], rows.schema)
        return lost

    monkeypatch.setattr(module, "walk", faulty)
    run = restore(spark, taken, target, tables=False, overwrite=False, verify=None)
    assert {(r["name"], r["status"]) for r in run.items.collect()} == {(n, "failed") for n in names}
    for name in names:
        assert open(f"{target.files}/{name}").read() == "newer"


def test_layout_needs_a_folder_below_tables(spark, tmp_path):
    from snapvault.operators.restore import layout_of

    write_tree(tmp_path / "s", {"tables/readme.txt": "x", "old.zip": "z"})
    assert layout_of(spark, str(tmp_path / "s")) == "zip_file"
    write_tree(tmp_path / "s", {"tables/t/part": "x"})
    assert layout_of(spark, str(tmp_path / "s")) == "direct_copy"


def test_older_snapshot_is_held_against_its_side_car(spark, tmp_path):
    root, target = str(tmp_path / "old"), Lakehouse(str(tmp_path / "t"))
    for name, rows in (("good", 3), ("short", 2)):
        spark.range(rows).write.parquet(f"{root}/tables/{name}")
        spark.createDataFrame([(name, 3)], "table_name string, row_count bigint").write.parquet(f"{root}/tables/{name}_metadata")
    run = restore(spark, root, target, require_manifest=False)
    assert {(r["name"], r["status"]) for r in run.items.collect()} == {("good", "success"), ("short", "failed")}


def test_no_snapshot_is_no_error(spark, tmp_path):
    from datetime import datetime

    from snapvault import newest_snapshot

    os.makedirs(tmp_path / "empty")
    assert newest_snapshot(spark, str(tmp_path / "empty"), "x", datetime(2025, 1, 1)) is None
