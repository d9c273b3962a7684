import json
import os
from datetime import datetime, timezone

import pytest
from conftest import tree_of, write_tree
from pyspark.sql import functions as F

from snapvault import Lakehouse, Source, restore, snapshot, snapshot_many, verify_content, verify_snapshot
from snapvault.operators.audit import read_items, read_logs, read_manifests
from snapvault.operators.items import sidecars
from snapvault.operators.tables import copy_table, profile_tables
from snapvault.plans.verify import compare_rows
from snapvault.sources.tables import scan_exact, scan_table

AT = datetime(2025, 11, 10, 14, 30, 15)

ALL_TYPES = """
SELECT id, CAST(id AS TINYINT) b, CAST(id AS SMALLINT) s, CAST(id AS INT) i, CAST(id AS FLOAT) / 3 f, CAST(id AS DOUBLE) / 7 d,
  CAST(id AS DECIMAL(38, 10)) / 3 de, id % 2 = 0 bo, CAST(id AS STRING) st, CAST(CAST(id AS STRING) AS BINARY) bi,
  DATE '1500-01-01' + CAST(id AS INT) da, TIMESTAMP '1850-06-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) ts,
  TIMESTAMP_NTZ '1200-02-28 01:02:03.456789' n, INTERVAL '3' MONTH ym, INTERVAL '1 02:03:04' DAY TO SECOND dt,
  array(id, null) a, map('k', id) m, named_struct('x', id, 'y', array(map('z', null), null)) r,
  IF(id % 3 = 0, NULL, 'v') nu
FROM range(50)
"""


def source(root):
    return Source(Lakehouse(str(root)), "lh_silver1", "wsp_transform_dev")


@pytest.fixture
def lake(spark, tmp_path):
    root = tmp_path / "lake"
    tables = Lakehouse(str(root)).tables
    spark.sql(ALL_TYPES).write.parquet(f"{tables}/types")
    spark.range(10).write.parquet(f"{tables}/plain")
    spark.range(10).write.parquet(f"{tables}/plain_metadata")
    spark.range(0).write.parquet(f"{tables}/none")
    rows = [(1, "01", "a b/c"), (2, "02", None), (3, "01", "x=y%"), (4, "10", "")]
    spark.createDataFrame(rows, "v int, month string, q string").write.partitionBy("month", "q").parquet(f"{tables}/parts")
    spark.sql("SELECT 1 a").write.parquet(f"{tables}/grown")
    spark.sql("SELECT 2 a, 'new' b").write.mode("append").parquet(f"{tables}/grown")
    os.makedirs(f"{tables}/no_table")
    os.makedirs(f"{tables}/_hidden")
    write_tree(root / "Files", {"a.csv": "1", "empty": "", "s/b c%20.txt": "2", "_x": "3", "s/.y/z": "4"})
    return Lakehouse(str(root))


def same(spark, one, two):
    left, right = scan_exact(spark, one)[0], scan_exact(spark, two)[0]
    row = compare_rows(left, right).head()
    return sorted(left.dtypes) == sorted(right.dtypes) and (row["missing_rows"], row["extra_rows"]) == (0, 0)


def test_round_trip_of_a_whole_lakehouse(spark, lake, tmp_path):
    before = tree_of(lake.root)
    run = snapshot(spark, source(lake.root), str(tmp_path / "backups"), AT, verify="content")
    assert run.path == f"{tmp_path}/backups/silver1_transform_dev_backup_2025-11-10_14-30-15"
    items = {(r["kind"], r["name"]): r for r in run.items.collect()}
    assert {k for k, r in items.items() if r["status"] == "failed"} == {("table", "no_table")}
    assert {n for k, n in items if k == "file"} == {"a.csv", "empty", "s/b c%20.txt"}
    assert items["table", "none"]["row_count"] == 0 and items["table", "grown"]["column_count"] == 2
    assert items["table", "parts"]["partition_columns"] == ["month", "q"]
    assert sorted(os.listdir(f"{run.path}/tables/parts"))[-2:] == ["month=02", "month=10"]
    row = run.manifest.head()
    assert (row["tables_discovered"], row["tables_backed_up"], row["tables_failed"]) == (7, 6, 1)
    assert (row["files_backed_up"], row["total_size"], row["status"]) == (3, 2, "partial")
    assert row["verification_passed"] and row["backup_id"] == os.path.basename(run.path)

    target = Lakehouse(str(tmp_path / "target"))
    back = restore(spark, run.path, target, verify="content")
    assert back.manifest.head()["verification_passed"] and back.manifest.head()["status"] == "success"
    for table in ("types", "plain", "plain_metadata", "none", "parts", "grown"):
        assert same(spark, f"{lake.tables}/{table}", f"{target.tables}/{table}"), table
    assert not os.path.exists(f"{target.tables}/no_table")
    restored = {k: v for k, v in tree_of(target.files).items() if not k.startswith(("_restore_", "_run_logs"))}
    assert restored == {"a.csv": b"1", "empty": b"", "s/b c%20.txt": b"2"}
    assert tree_of(lake.root) == before
    assert not [n for n in os.listdir(target.files) + os.listdir(target.tables) if n.startswith(".staging")]


def test_old_dates_are_kept_as_they_are(spark, lake, tmp_path):
    copy_table(spark, "types", f"{lake.tables}/types", str(tmp_path / "copy"))
    row = scan_table(spark, str(tmp_path / "copy")).where("id = 0").selectExpr("string(da)", "string(ts)", "string(n)").head()
    assert tuple(row) == ("1500-01-01", "1850-06-01 00:00:00", "1200-02-28 01:02:03.456789")


def test_existing_snapshot_is_refused(spark, lake, tmp_path):
    options = {"tables": False, "verify": None}
    snapshot(spark, source(lake.root), str(tmp_path / "b"), AT, **options)
    with pytest.raises(FileExistsError):
        snapshot(spark, source(lake.root), str(tmp_path / "b"), AT, **options)


def test_empty_lakehouse(spark, tmp_path):
    run = snapshot(spark, source(tmp_path / "nothing"), str(tmp_path / "b"), AT)
    assert run.manifest.head()["status"] == "empty" and run.items.count() == 0


def test_names_are_required(spark, tmp_path):
    with pytest.raises(ValueError):
        snapshot(spark, Source(Lakehouse(str(tmp_path)), " ", "w"), str(tmp_path / "b"), AT)


def test_source_and_target_must_differ(spark, lake):
    path = f"{lake.tables}/plain"
    before = tree_of(lake.root)
    for target in (path, path + "/", f"{path}/inside", lake.tables, f"file:{path}"):
        row = copy_table(spark, "plain", path, target, overwrite=True)
        assert row["status"] == "failed" and "same folder" in row["error"]
    assert tree_of(lake.root) == before


def test_failed_copy_leaves_nothing_and_keeps_the_old_table(spark, lake, tmp_path):
    bad = f"{lake.tables}/bad"
    write_tree(bad, {"part-0.parquet": "this is no parquet file"})
    row = copy_table(spark, "bad", bad, str(tmp_path / "new"))
    assert row["status"] == "failed" and not os.path.exists(tmp_path / "new")
    copy_table(spark, "plain", f"{lake.tables}/plain", str(tmp_path / "old"))
    before = tree_of(tmp_path / "old")
    assert copy_table(spark, "bad", bad, str(tmp_path / "old"), overwrite=True)["status"] == "failed"
    assert copy_table(spark, "plain", f"{lake.tables}/plain", str(tmp_path / "old"))["status"] == "failed"
    assert tree_of(tmp_path / "old") == before


def test_profile(spark, lake):
    paths = {t: f"{lake.tables}/{t}" for t in ("types", "none", "no_table", "parts")}
    rows = {r["name"]: r for r in profile_tables(spark, paths).collect()}
    assert (rows["types"]["row_count"], rows["types"]["column_count"]) == (50, 19)
    assert rows["none"]["row_count"] == 0 and rows["parts"]["columns"] == ["v", "month", "q"]
    assert rows["no_table"]["row_count"] is None and rows["no_table"]["error"]
    from pyspark.sql.types import StructType
    import json

    assert StructType.fromJson(json.loads(rows["types"]["schema_json"])) == scan_exact(spark, paths["types"])[0].schema


def test_several_sources(spark, lake, tmp_path):
    sources = [source(lake.root), Source(lake, "", "w"), Source(lake, "other", "w")]
    rows = snapshot_many(spark, sources, str(tmp_path / "b"), at=AT, tables=False).collect()
    assert sorted((r["source"], r["kind"], r["status"]) for r in rows) == sorted(
        [("lh_silver1", "file", "success")] * 3 + [("", "run", "failed")] + [("other", "file", "success")] * 3
    )
    manifests = read_manifests(spark, str(tmp_path / "b")).collect()
    assert {m["source_lakehouse_name"] for m in manifests} == {"lh_silver1", "other"}


def test_logs_of_all_runs(spark, lake, tmp_path):
    for name in ("one", "two"):
        snapshot(spark, Source(lake, name, "w"), str(tmp_path / "b"), AT, files=False)
    logs = read_logs(spark, str(tmp_path / "b"))
    failed = logs.where("level = 'ERROR'").collect()
    assert {r["run"] for r in failed} == {f"{n}_w_backup_2025-11-10_14-30-15" for n in ("one", "two")}
    assert all("no_table" in r["message"] for r in failed)


def test_verification_finds_damage(spark, lake, tmp_path):
    run = snapshot(spark, source(lake.root), str(tmp_path / "b"), AT)
    tables, files = verify_snapshot(spark, run.path)
    assert all(r["data_matches"] for r in tables.collect()) and all(r["size_matches"] for r in files.collect())
    # Same number of rows, another value; one file gone, one cut short.
    spark.range(1, 11).write.mode("overwrite").parquet(f"{run.path}/tables/plain")
    os.remove(f"{run.path}/files/a.csv")
    write_tree(f"{run.path}/files", {"s/b c%20.txt": ""})
    tables, files = verify_snapshot(spark, run.path)
    assert [r["name"] for r in tables.collect() if not r["data_matches"]] == ["plain"]
    checks = {r["relative_path"]: (r["file_exists"], r["size_matches"]) for r in files.collect()}
    assert checks == {"a.csv": (False, False), "empty": (True, True), "s/b c%20.txt": (True, False)}
    counts, _ = verify_snapshot(spark, run.path, content=False)
    assert all(r["data_matches"] for r in counts.collect())


def test_content_check(spark, tmp_path):
    base = spark.range(100).selectExpr("id", "map('k', id) m", "id % 3 g")
    versions = {
        "same": base.orderBy(F.desc("id")).select("g", "m", "id"),
        "lost": base.where("id <> 5"),
        "twice": base.unionAll(base.where("id = 5")),
        "changed": base.withColumn("g", F.when(F.col("id") == 5, 9).otherwise(F.col("g"))),
        "renamed": base.withColumnRenamed("g", "h"),
    }
    base.write.parquet(str(tmp_path / "base"))
    for name, df in versions.items():
        df.write.parquet(str(tmp_path / name))
    pairs = {n: (str(tmp_path / "base"), str(tmp_path / n)) for n in versions} | {"gone": (str(tmp_path / "base"), "/no/such")}
    exact = {r["name"]: r for r in verify_content(spark, pairs, exact=True).collect()}
    quick = {r["name"]: r for r in verify_content(spark, pairs).collect()}
    for rows in (exact, quick):
        assert [n for n, r in rows.items() if r["data_matches"]] == ["same"]
        assert rows["renamed"]["error"] == "columns differ" and not rows["gone"]["verified"]
    counts = {n: (r["missing_rows"], r["extra_rows"]) for n, r in exact.items()}
    assert (counts["same"], counts["lost"], counts["twice"], counts["changed"]) == ((0, 0), (1, 0), (0, 1), (1, 1))


def test_copy_reads_the_table_once(spark, lake, tmp_path):
    """Count, checksum and copy share one scan and no shuffle."""
    from snapvault.operators.tables import observed

    df, _ = scan_exact(spark, f"{lake.tables}/types")
    passing, _ = observed(df)
    plan = passing._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan and "CollectMetrics" in plan


def test_started_and_finished_are_utc(spark, lake, tmp_path):
    run = snapshot(spark, source(lake.root), str(tmp_path / "b"), AT, files=False)
    row = read_items(spark, run.path).where("name = 'plain'").head()
    assert row["started_at"] <= row["finished_at"]
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - row["finished_at"]).total_seconds()) < 600


def test_newest_finished_snapshot(spark, lake, tmp_path):
    import shutil
    from datetime import timedelta

    from snapvault import newest_snapshot

    root = str(tmp_path / "b")
    options = {"tables": False, "verify": None}
    paths = [snapshot(spark, source(lake.root), root, AT + timedelta(days=d), **options).path for d in range(3)]
    find = lambda at: newest_snapshot(spark, root, "silver1_transform_dev", at)
    assert find(AT + timedelta(days=9)) == paths[2] and find(AT + timedelta(days=1)) == paths[1]
    assert find(AT - timedelta(days=1)) is None
    shutil.rmtree(f"{paths[1]}/_manifest")
    assert find(AT + timedelta(days=1)) == paths[0]


def test_log_table_of_all_runs_by_day(spark, tmp_path):
    from snapvault.operators.audit import append_logs
    from snapvault.plans.summary import log_rollup

    rows = [("2025-01-01 00:00:00", "INFO", "a"), ("2025-01-01 23:59:59", "DEBUG", "b"), ("2025-01-02 00:00:00", "ERROR", "c")]
    logs = spark.createDataFrame(rows, "timestamp string, level string, message string")
    for _ in range(2):
        append_logs(logs, str(tmp_path / "log"), "run")
    back = spark.read.parquet(str(tmp_path / "log"))
    got = {(str(r["day"]), r["level"], r["n"]) for r in log_rollup(back).collect()}
    assert got == {("2025-01-01", "INFO", 2), ("2025-01-02", "ERROR", 2)}
    assert sorted(n for n in os.listdir(tmp_path / "log") if n[0] == "d") == ["day=2025-01-01", "day=2025-01-02"]


def test_names_that_look_like_wildcards_or_codes(spark, tmp_path):
    lake, target = Lakehouse(str(tmp_path / "la[k]e {1}")), Lakehouse(str(tmp_path / "t*?"))
    names = ["a[1]*", "b c%20", "x{y,z}", "ü"]
    for n, name in enumerate(names):
        spark.range(n + 1).selectExpr("id", "id % 2 p").write.partitionBy("p").parquet(f"{lake.tables}/{name}")
    write_tree(lake.files, {f"{n}/{n}.txt": n for n in names})
    run = snapshot(spark, Source(lake, "l[x]*", "w"), str(tmp_path / "b{1}"), AT, verify="content")
    assert run.manifest.head()["status"] == "success" and run.manifest.head()["verification_passed"]
    back = restore(spark, run.path, target, verify="content").manifest.head()
    assert back["status"] == "success" and back["verification_passed"]
    assert {n: scan_table(spark, f"{target.tables}/{n}").count() for n in names} == {n: i + 1 for i, n in enumerate(names)}
    assert {k: v for k, v in tree_of(target.files).items() if k[0] != "_"} == {f"{n}/{n}.txt": n.encode() for n in names}


def test_times_are_utc_wherever_the_driver_is(spark, lake, tmp_path):
    from datetime import timedelta

    zone = timezone(timedelta(hours=5))
    run = snapshot(spark, source(lake.root), str(tmp_path / "b"), AT.replace(tzinfo=zone), tables=False, verify=None)
    assert run.path.endswith("_backup_2025-11-10_09-30-15")
    assert run.manifest.selectExpr("string(backup_timestamp)").head()[0] == "2025-11-10 09:30:15"
    with pytest.raises(ValueError):
        snapshot(spark, Source(lake, "a/b", "w"), str(tmp_path / "b"), AT)


def test_tables_that_cannot_be_listed_end_the_snapshot(spark, tmp_path):
    write_tree(tmp_path / "lake", {"Tables": "a file in the folder's place"})
    with pytest.raises(OSError, match="cannot be listed"):
        snapshot(spark, Source(Lakehouse(str(tmp_path / "lake")), "l", "w"), str(tmp_path / "b"), AT)


def test_linked_folders_are_failures(spark, tmp_path):
    lake = str(tmp_path / "lake")
    spark.range(2).write.parquet(f"{lake}/Tables/one")
    write_tree(lake, {"Files/a": "a"})
    os.makedirs(tmp_path / "else")
    os.symlink(tmp_path / "else", f"{lake}/Files/linked")
    os.symlink(tmp_path / "else", f"{lake}/Tables/elsewhere")
    run = snapshot(spark, Source(Lakehouse(lake), "l", "w"), str(tmp_path / "b"), AT)
    got = {(r["kind"], r["name"], r["status"]) for r in run.items.collect()}
    assert got == {("table", "one", "success"), ("table", "elsewhere", "failed"), ("file", "a", "success"), ("file", "linked", "failed")}
    assert run.manifest.head()["status"] == "partial"
    info = {r["name"]: r for r in run.manifest.head()["tables_info"]}
    assert info["elsewhere"]["error"] and info["one"]["columns"] == ["id"]


def test_every_record_has_its_document_files_too(spark, tmp_path):
    lake = Lakehouse(str(tmp_path / "lake"))
    spark.sql("SELECT id, id a FROM range(3)").write.parquet(f"{lake.tables}/t")
    write_tree(lake.files, {"a.csv": "1", "s/empty": ""})
    run = snapshot(spark, source(lake.root), str(tmp_path / "backups"), AT)
    cards = {(r["kind"], r["name"]): json.loads(r["metadata_json"]) for r in sidecars(run.items).collect()}
    assert set(cards) == {("table", "t"), ("file", "a.csv"), ("file", "s/empty")}
    assert all(card["table_name"] == name and card["backup_timestamp"] for (_, name), card in cards.items())
    assert (cards["table", "t"]["row_count"], cards["table", "t"]["columns"]) == (3, ["id", "a"])
    file = cards["file", "s/empty"]
    assert (file["backup_method"], file["backup_path"]) == ("file_copy", f"{run.path}/files/s/empty")
    assert not {"row_count", "columns"} & set(file)
