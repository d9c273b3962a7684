import json
import os

from conftest import write_tree

from snapvault.__main__ import main


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    lake, backups, target = str(tmp_path / "lake"), str(tmp_path / "b"), str(tmp_path / "t")
    spark.range(5).write.parquet(f"{lake}/Tables/one")
    write_tree(f"{lake}/Files", {"a.csv": "a", "b.txt": "b"})

    def run(*argv):
        code = main(list(argv))
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    names = ["--lakehouse-name", "lh_x", "--workspace-name", "wsp_y"]
    code, result = run("backup", "--source", lake, *names, "--backup-root", backups, "--at", "2025-01-02T03:04:05")
    path = f"{backups}/x_y_backup_2025-01-02_03-04-05"
    assert (code, result["backup_path"], result["tables_backed_up"], result["files_backed_up"]) == (0, path, 1, 2)
    code, result = run("verify", "--snapshot", path)
    assert code == 0 and result["overall_success"]
    code, result = run("restore", "--snapshot", path, "--target", target, "--dry-run")
    assert code == 0 and not os.path.exists(target)
    code, result = run("restore", "--snapshot", path, "--target", target, "--file", "*.csv")
    assert (code, result["tables_restored"], result["files_restored"]) == (0, 1, 1)
    os.remove(f"{path}/files/a.csv")
    assert run("verify", "--snapshot", path)[0] == 1
    code, result = run("restore", "--backup-root", backups, "--source", "x_y", "--as-of", "2025-01-01", "--target", target)
    assert code == 1 and "no finished snapshot" in result["error"]
    spark.range(4).write.mode("overwrite").parquet(f"{path}/tables/one")
    code, result = run("restore", "--backup-root", backups, "--source", "x_y", "--target", target, "--no-files")
    assert (code, result["status"]) == (1, "failed") and spark.read.parquet(f"{target}/Tables/one").count() == 5
    code, result = run("profile", "--source", lake)
    assert code == 0 and result["tables"][0]["row_count"] == 5 and {r["type"] for r in result["files"]} == {"data", "text"}
    logged = spark.read.parquet(f"{backups}/_run_logs")
    assert logged.where("run = 'x_y_backup_2025-01-02_03-04-05'").count() >= 2
    code, result = run("cleanup", "--backup-root", backups, "--as-of", "2025-03-01")
    assert [r["name"] for r in result["to_delete"]] == [os.path.basename(path)] and result["newest_kept"] == []
    assert (result["dry_run"], result["expired_backups"], result["deleted_backups"]) == (True, 1, 0)
    code, result = run("cleanup", "--backup-root", backups, "--as-of", "2025-03-01", "--delete")
    assert code == 0 and result["deleted_backups"] == 1 and not os.path.exists(path)


def test_scratch_is_cleaned(spark):
    from snapvault.session import clean_scratch, scratch_dir, settled

    df = settled(spark.range(3), "x")
    assert df.count() == 3
    root = os.path.dirname(scratch_dir(spark, "y"))
    assert os.listdir(root)
    clean_scratch(spark)
    assert not os.path.exists(root)
