import os
from datetime import datetime

import pytest
from conftest import tree_of, write_tree

from snapvault import retain, snapshot_catalogue
from snapvault.operators.audit import read_cleanup_logs
from snapvault.operators.filecopy import delete_paths
from snapvault.plans.retention import delete_list, keep_list, newest_as_of, retention_plan, retention_result

AS_OF = datetime(2025, 3, 1, 12)
OLD, LIMIT, OVER = "a_backup_2024-01-01_00-00-00", "a_backup_2025-01-29_12-00-01", "a_backup_2025-01-29_12-00-00"
NEW, FUTURE = "a_backup_2025-02-28_00-00-00", "a_backup_2026-01-01_00-00-00"
OTHER, NO_DATE, NO_TIME = "b_backup_2024-01-01_00-00-00", "a_backup_2001-02-30_00-00-00", "a_backup"
VALID = [OLD, LIMIT, OVER, NEW, FUTURE, OTHER]


@pytest.fixture
def root(tmp_path):
    files = {}
    for name in VALID + [NO_DATE, NO_TIME]:
        files |= {f"{name}/_manifest/m": "mm", f"{name}/tables/t/_log/.x": "xxx", f"{name}/files/f": "f"}
    files |= {"_cleanup_logs/l_2020-01-01_00-00-00/x": "l", ".tmp_2020-01-01_00-00-00/x": "t", "file_2020-01-01_00-00-00": "f"}
    return write_tree(tmp_path / "backups", files)


def test_catalogue_counts_hidden_content(spark, root):
    rows = snapshot_catalogue(spark, root).collect()
    assert {r["name"]: r["size_bytes"] for r in rows} == {n: 6 for n in VALID + [NO_DATE, NO_TIME]}
    assert all(r["path"] == f"{root}/{r['name']}" and r["error"] is None for r in rows)
    assert all(r["size_bytes"] is None for r in snapshot_catalogue(spark, root, sizes=False).collect())


def test_plan(spark, root):
    run = retain(spark, root, AS_OF, 30, " A_Backup ")
    actions = {r["name"]: r["action"] for r in run.plan.collect()}
    assert actions == {OLD: "delete", OVER: "delete", LIMIT: "retain", NEW: "retain", FUTURE: "retain", OTHER: "retain",
                       NO_DATE: "invalid", NO_TIME: "invalid"}
    ages = {r["name"]: r["age_days"] for r in run.plan.collect()}
    assert (ages[LIMIT], ages[OVER], ages[NEW], ages[FUTURE], ages[NO_DATE]) == (30, 31, 1, -306, None)
    assert run.summary.head().asDict() == {
        "total_backups": 8, "valid_backups": 6, "invalid_backups": 2, "pattern_matched": 5, "expired_backups": 2,
        "retained_backups": 4, "total_size_to_delete": 12, "total_size_to_retain": 24,
    }


def test_dry_run_is_the_default(spark, root):
    before = tree_of(root)
    run = retain(spark, root, AS_OF)
    assert run.deletions is None and tree_of(root) == before
    row = run.result.head()
    assert (row["dry_run"], row["expired_backups"], row["deleted_backups"], row["space_freed_bytes"]) == (True, 3, 0, 0)


@pytest.mark.parametrize("by_file", [False, True])
def test_deletes_exactly_the_plan(spark, root, by_file):
    from snapvault.operators.retention import delete_snapshots

    plan = retain(spark, root, AS_OF).plan
    before = tree_of(root)
    rows = delete_snapshots(spark, root, plan, by_file=by_file).collect()
    assert {(r["name"], r["status"], r["size_bytes"]) for r in rows} == {(n, "success", 6) for n in (OLD, OVER, OTHER)}
    assert tree_of(root) == {k: v for k, v in before.items() if k.split("/")[0] not in (OLD, OVER, OTHER)}
    assert not os.path.exists(f"{root}/{OLD}")
    # Once more: what is gone counts as done.
    assert {r["status"] for r in delete_snapshots(spark, root, plan, by_file=by_file).collect()} == {"success"} or by_file


def test_apply_and_log(spark, root):
    run = retain(spark, root, AS_OF, 30, "b_", dry_run=False, write_log=True)
    row = run.result.head()
    assert (row["status"], row["deleted_backups"], row["space_freed_bytes"], row["failed_deletions"]) == ("success", 1, 6, 0)
    assert not os.path.exists(f"{root}/{OTHER}") and os.path.exists(f"{root}/{OLD}")
    logs = [r for r in read_cleanup_logs(spark, f"{root}/_cleanup_logs").collect() if r["level"]]
    assert len(logs) == 1 and logs[0]["name_pattern"] == "b_" and "1 deleted" in logs[0]["message"]
    assert logs[0]["retention_days"] == 30 and logs[0]["dry_run"] is False


def test_delete_never_leaves_the_root(spark, tmp_path):
    write_tree(tmp_path, {"root/a/x": "x", "outside/x": "x"})
    paths = ["../outside", "a/../../outside", "", "/outside", ".", "a/."]
    rows = delete_paths(spark, spark.createDataFrame([(p,) for p in paths], "relative_path string"), str(tmp_path / "root"), True)
    assert {r["status"] for r in rows.collect()} == {"failed"}
    assert tree_of(tmp_path) == {"root/a/x": b"x", "outside/x": b"x"}


def test_names_with_a_slash_are_never_deleted(spark, tmp_path):
    from snapvault.operators.retention import delete_snapshots

    write_tree(tmp_path, {f"x/{OLD}/f": "f"})
    plan = retention_plan(spark.createDataFrame([(f"x/{OLD}", 1)], "name string, size_bytes bigint"), AS_OF)
    assert plan.head()["action"] == "delete"
    assert delete_snapshots(spark, str(tmp_path), plan).count() == 0 and os.path.exists(tmp_path / "x" / OLD)


def test_retention_must_be_a_day_at_least(spark, root):
    with pytest.raises(ValueError):
        retain(spark, root, AS_OF, 0)
    assert retain(spark, root, AS_OF, 10**7).result.head()["expired_backups"] == 0


def test_strict_names(spark):
    df = spark.createDataFrame([("export_2020-01-01_00-00-00", 1), ("a_backup_2020-01-01_00-00-00", 1)], "name string, size_bytes bigint")
    action = lambda strict: [r["action"] for r in retention_plan(df, AS_OF, strict=strict).collect()]
    assert action(False) == ["delete", "delete"] and action(True) == ["invalid", "delete"]


def test_lists(spark):
    rows = [(f"a_backup_2025-02-{d:02d}_00-00-00", d) for d in range(1, 29)] + [("b_backup_2025-02-03_00-00-00", 1), ("x", 1)]
    df = spark.createDataFrame(rows, "name string, size_bytes bigint")
    kept = [r["name"] for r in keep_list(retention_plan(df, AS_OF)).collect()]
    assert kept == [f"a_backup_2025-02-{d:02d}_00-00-00" for d in range(28, 18, -1)]
    newest = {r["source"]: r["name"] for r in newest_as_of(df, datetime(2025, 2, 10, 5)).collect()}
    assert newest == {"a": "a_backup_2025-02-10_00-00-00", "b": "b_backup_2025-02-03_00-00-00"}


def test_delete_list_is_in_one_order(spark):
    """Snapshots of the same second and name, too many for the order they came in to hold by chance."""
    rows = [(2000 - i, OLD, 1) for i in range(2000)] + [(5000, OTHER, 1)]
    df = spark.createDataFrame(rows, "no int, name string, size_bytes bigint").repartition(8, "no")
    listed = [r["no"] for r in delete_list(retention_plan(df, AS_OF), "no").collect()]
    assert listed == [*range(1, 2001), 5000]


def test_result_with_failures(spark):
    df = spark.createDataFrame([(OLD, 1), (OTHER, 2), (NEW, 4)], "name string, size_bytes bigint")
    plan = retention_plan(df, AS_OF)
    done = lambda *rows: spark.createDataFrame(rows, "name string, status string, size_bytes bigint")
    row = retention_result(plan, done((OLD, "success", 1), (OTHER, "failed", 2))).head()
    assert tuple(row) == ("partial", False, 3, 2, 1, 1, 1)
    assert retention_result(plan, done((OLD, "failed", 1), (OTHER, "failed", 2))).head()["status"] == "failed"


def test_empty_and_missing_root(spark, tmp_path):
    run = retain(spark, write_tree(tmp_path / "b", {"_cleanup_logs/x": "x"}), AS_OF, dry_run=False)
    assert (run.result.head()["status"], run.result.head()["total_backups"], run.deletions.count()) == ("success", 0, 0)
    with pytest.raises(FileNotFoundError):
        retain(spark, str(tmp_path / "missing"), AS_OF)


def test_manifests_go_first(spark, root, monkeypatch):
    """A run that ends after its first step leaves no snapshot that looks finished."""
    from snapvault.operators import retention as module

    plan, real, calls = retain(spark, root, AS_OF).plan, module.delete_paths, []

    def once(spark, paths, *args, **options):
        if calls:
            raise RuntimeError("lost")
        calls.append(real(spark, paths, *args, **options))
        return calls[0]

    monkeypatch.setattr(module, "delete_paths", once)
    with pytest.raises(RuntimeError):
        module.delete_snapshots(spark, root, plan)
    for name in (OLD, OVER, OTHER):
        assert os.path.exists(f"{root}/{name}/files/f") and not os.path.exists(f"{root}/{name}/_manifest")
    assert os.path.exists(f"{root}/{NEW}/_manifest")


def test_a_root_that_cannot_be_listed_is_no_empty_root(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(OSError, match="cannot be listed"):
        retain(spark, str(tmp_path / "file"), AS_OF)
