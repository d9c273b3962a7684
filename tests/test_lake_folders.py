"""The folders that queries build from tables: what lies on the disk beside what a query writes."""

import os
import sys
import time
from datetime import datetime

import pytest
from conftest import tree_of

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry
from snapvault.operators.filecopy import write_files

DOCUMENTS = [(1, "one", "en", "src1", 3), (2, "", "de", "src1", 0), (15, "fifteen", "en", "src2", 7)]


@pytest.fixture
def tables(spark, tmp_path):
    root = tmp_path / "tables"
    spark.createDataFrame(DOCUMENTS, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{root}/documents.parquet"
    )
    for n, table in enumerate(("customer", "orders", "lineitem"), 1):
        spark.range(n).write.parquet(f"{root}/{table}.parquet")
    return str(root)


def test_a_restore_has_no_lake_beside_it(spark, tables, monkeypatch):
    lake, seen, plain = entry._lake(spark, tables), [], entry.restore
    before = tree_of(lake.files)
    assert len(before) == 3

    def watched(*args, **options):
        seen.append(os.path.exists(lake.root.removeprefix("file:")))
        return plain(*args, **options)

    monkeypatch.setattr(entry, "restore", watched)
    rows = {(r["kind"], r["name"]): r for r in entry.q_restore_status(spark, tables).collect()}
    assert seen == [False, False]
    assert {k: r["status"] for k, r in rows.items()} == {
        ("table", "customer"): "skipped",
        ("table", "orders"): "success",
        ("table", "lineitem"): "success",
        ("file", "src1/en/doc_1.PDF"): "skipped",
        ("file", "src1/de/doc_2.txt"): "skipped",
        ("file", "src2/en/doc_15.txt"): "success",
    }
    told = entry.q_restore_manifest(spark, tables).head()
    assert (told["tables_restored"], told["tables_skipped"], told["files_restored"], told["files_skipped"]) == (2, 1, 1, 2)
    assert told["status"] == "success" and told["verification_passed"]

    # Who needs the lake afterwards finds a whole one.
    files = entry.q_binary_file_scan(spark, tables)
    assert {r["relative_path"]: r["size"] for r in files.collect()} == {k: len(v) for k, v in before.items()}
    assert tree_of(entry._lake(spark, tables).files) == before


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_what_files_are_written_from_does_not_stay_as_shuffle_files(spark, tmp_path):
    before, at = shuffle_files(spark), datetime.now()
    rows = spark.range(50).selectExpr("'d/' || id AS relative_path", "CAST(repeat(CAST(id AS STRING), 9) AS BINARY) AS content")
    status = write_files(spark, rows, str(tmp_path / "out"))
    while (left := shuffle_files(spark) - before) and (datetime.now() - at).seconds < 20:
        time.sleep(0.2)
    assert not left
    assert status.where("status = 'success'").count() == len(tree_of(tmp_path / "out")) == 50
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
