import io
import json
import os
import zipfile

import pytest
from conftest import tree_of, write_tree

from snapvault import Lakehouse, restore
from snapvault.operators import archive as ops
from snapvault.operators.archive import FALLBACK_TABLE
from snapvault.sources.archives import archive_entries, archive_entries_binary, archive_metadata
from snapvault.sources.tables import scan_table


def zipped(entries, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, content in entries:
            z.writestr(name, content)
    return out.getvalue()


def parquet(spark, tmp_path, df):
    path = str(tmp_path / f"p{len(os.listdir(tmp_path))}")
    df.coalesce(1).write.parquet(path)
    name = next(n for n in os.listdir(path) if n.endswith(".parquet"))
    with open(f"{path}/{name}", "rb") as f:
        return f.read()


CSV = 'id,text\n1,"two\nlines"\n2,"say ""hi"", you"\n3,plain\n'
META = {"backup_type": "old", "tables_backed_up": 2, "files_backed_up": 1, "unknown": [1]}


@pytest.fixture
def entries(spark, tmp_path):
    t = parquet(spark, tmp_path, spark.sql("SELECT id, array(id) a, TIMESTAMP_NTZ '1200-01-01 00:00:00' n FROM range(20)"))
    return [
        ("tables/t/t.parquet", t),
        ("tables/t/t.csv", "id\n1\n"),
        ("tables/t/other.parquet", t),
        ("tables/t/schema.json", "{}"),
        ("tables/t/metadata.json", "{}"),
        ("tables/only_csv/only_csv.csv", CSV),
        ("tables/nothing/readme.md", "x"),
        ("tables/stray.csv", "x"),
        ("files/a/b.txt", "bbb"),
        ("files/a/empty.bin", ""),
        ("files/empty/", ""),
        ("files/c d%20.PDF", b"\x00\xff" * 100_000),
        ("_backup_info/metadata.json", json.dumps(META)),
        ("top.txt", "x"),
    ]


@pytest.fixture
def snap(tmp_path, entries):
    return write_tree(tmp_path / "snap", {"old.zip": zipped(entries)})


def scan(spark, root):
    names = [(n,) for n in sorted(os.listdir(root)) if n.endswith(".zip")]
    return ops.scan_archives(spark, root, spark.createDataFrame(names, "relative_path string"))


def test_entries(spark, snap, entries):
    names = spark.createDataFrame([("old.zip",)], "relative_path string")
    rows = {r["entry"]: r for r in archive_entries(spark, snap, names).collect()}
    assert set(rows) == {n for n, _ in entries if not n.endswith("/")}
    kinds = {n: r["kind"] for n, r in rows.items()}
    assert kinds["tables/stray.csv"] == kinds["top.txt"] == "other" and kinds["_backup_info/metadata.json"] == "metadata"
    row = rows["files/c d%20.PDF"]
    assert (row["kind"], row["relative_path"], row["file_type"], row["size"]) == ("file", "c d%20.PDF", "document", 200_000)
    assert (rows["tables/t/t.csv"]["table_name"], rows["tables/t/t.csv"]["file_name"]) == ("t", "t.csv")
    with open(f"{snap}/old.zip", "rb") as f:
        held = spark.createDataFrame([("old.zip", bytearray(f.read()))], "archive string, zip_binary binary")
    assert {tuple(r) for r in archive_entries_binary(held).collect()} == {tuple(r) for r in rows.values()}


def test_metadata(spark, snap):
    row = archive_metadata(scan(spark, snap), snap).head()
    assert (row["archive"], row["backup_type"], row["tables_backed_up"], row["created_at"]) == ("old.zip", "old", 2, None)


def test_restore_through_the_front_door(spark, snap, tmp_path):
    target = Lakehouse(str(tmp_path / "target"))
    run = restore(spark, snap, target)
    got = {(r["kind"], r["name"]): (r["status"], r["method"], r["row_count"]) for r in run.items.collect()}
    assert run.layout == "zip_file"
    assert got["table", "t"] == ("success", "archive_parquet", 20)
    assert got["table", "only_csv"] == ("success", "archive_csv", 3)
    assert got["table", "nothing"][0] == "failed"
    assert {n for k, n in got if k == "file"} == {"a/b.txt", "a/empty.bin", "c d%20.PDF"}
    t = scan_table(spark, f"{target.tables}/t")
    assert t.dtypes == [("id", "bigint"), ("a", "array<bigint>"), ("n", "timestamp_ntz")] and t.count() == 20
    rows = [tuple(r) for r in scan_table(spark, f"{target.tables}/only_csv").orderBy("id").collect()]
    assert rows == [(1, "two\nlines"), (2, 'say "hi", you'), (3, "plain")]
    files = {k: v for k, v in tree_of(target.files).items() if not k.startswith("_")}
    assert files == {"a/b.txt": b"bbb", "a/empty.bin": b"", "c d%20.PDF": b"\x00\xff" * 100_000}
    row = run.manifest.head()
    assert row["verification_passed"] and (row["status"], row["backup_type"]) == ("partial", "zip_file")
    assert (row["tables_restored"], row["tables_failed"], row["files_restored"], row["total_size"]) == (2, 1, 3, 200_003)


def test_archive_in_a_table(spark, tmp_path, entries):
    other = zipped([("files/second.txt", "2"), ("tables/t/t.parquet", entries[0][1])])
    held = [(bytearray(zipped(entries)),), (bytearray(other),)]
    spark.createDataFrame(held, "zip_binary binary").write.parquet(str(tmp_path / "snap" / "complete_backup_zip_data"))
    target = Lakehouse(str(tmp_path / "target"))
    run = restore(spark, str(tmp_path / "snap"), target)
    assert run.layout == "zip_in_table"
    got = {(r["kind"], r["name"]): r["row_count"] for r in run.items.collect()}
    assert got["table", "t"] == 40 and ("file", "second.txt") in got and ("file", "a/b.txt") in got


def test_selection_collision_and_dry_run(spark, snap, tmp_path):
    target = Lakehouse(str(tmp_path / "target"))
    spark.range(1).write.parquet(f"{target.tables}/t")
    write_tree(target.files, {"a/b.txt": "kept"})
    before = tree_of(target.root)
    run = restore(spark, snap, target, overwrite=False, dry_run=True, table_names=["t", "only_csv"], file_patterns=["a/*"])
    assert {(r["name"], r["status"]) for r in run.items.collect()} == {
        ("t", "dry_run"), ("only_csv", "dry_run"), ("a/b.txt", "dry_run"), ("a/empty.bin", "dry_run")}
    assert tree_of(target.root) == before
    run = restore(spark, snap, target, overwrite=False, table_names=["t", "only_csv"], file_patterns=["a/*"])
    assert {(r["name"], r["status"]) for r in run.items.collect()} == {
        ("t", "skipped"), ("only_csv", "success"), ("a/b.txt", "skipped"), ("a/empty.bin", "success")}
    assert tree_of(target.files)["a/b.txt"] == b"kept" and scan_table(spark, f"{target.tables}/t").count() == 1


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_all_compressions(spark, tmp_path, method):
    body = {f"files/f{i}": os.urandom(1000) + b"x" * 10_000 * i for i in range(5)}
    root = write_tree(tmp_path / "s", {"a.zip": zipped(body.items(), method)})
    ops.restore_files(spark, scan(spark, root), root, str(tmp_path / "t")).collect()
    assert tree_of(tmp_path / "t") == {k[6:]: v for k, v in body.items()}


def test_streamed_archive_with_descriptors(spark, tmp_path):
    class NoSeek(io.RawIOBase):
        def __init__(self):
            self.data = b""

        def writable(self):
            return True

        def write(self, b):
            self.data += bytes(b)
            return len(b)

    out = NoSeek()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("files/ü/x.txt", "streamed")
    root = write_tree(tmp_path / "s", {"a.zip": b"leading bytes" + out.data})
    ops.restore_files(spark, scan(spark, root), root, str(tmp_path / "t")).collect()
    assert tree_of(tmp_path / "t") == {"ü/x.txt": b"streamed"}


def test_bad_archives_and_entries_are_reported(spark, tmp_path):
    good = zipped([("files/good.txt", "good"), ("files/bad.txt", "unique-content")], zipfile.ZIP_STORED)
    root = write_tree(
        tmp_path / "s", {"broken.zip": "no archive", "part.zip": good.replace(b"unique-content", b"uniqueXcontent")}
    )
    target = Lakehouse(str(tmp_path / "t"))
    run = restore(spark, root, target)
    got = {(r["kind"], r["name"]): r for r in run.items.collect()}
    assert got["archive", "broken.zip"]["status"] == "failed" and got["archive", "broken.zip"]["error"]
    assert got["file", "good.txt"]["status"] == "success"
    assert got["file", "bad.txt"]["status"] == "failed" and "CRC" in got["file", "bad.txt"]["error"]
    assert not os.path.exists(f"{target.files}/bad.txt")


def test_last_entry_of_a_name_wins(spark, tmp_path):
    with pytest.warns(UserWarning):
        data = zipped([("files/x", "first"), ("files/x", "second")])
    root = write_tree(tmp_path / "s", {"a.zip": data})
    ops.restore_files(spark, scan(spark, root), root, str(tmp_path / "t")).collect()
    assert tree_of(tmp_path / "t") == {"x": b"second"}


def test_files_that_cannot_be_written_become_rows(spark, tmp_path):
    root = write_tree(tmp_path / "s", {"a.zip": zipped([("files/x", "in the way"), ("files/../../out.txt", "escape"), ("files/y", "y")])})
    target = Lakehouse(str(tmp_path / "t" / "lake"))
    os.makedirs(f"{target.files}/x/sub")
    run = restore(spark, root, target)
    got = {r["name"]: (r["status"], r["method"]) for r in run.items.collect()}
    assert got == {"x": ("success", "table_copy"), "../../out.txt": ("success", "table_copy"), "y": ("success", "archive_entry")}
    rows = scan_table(spark, f"{target.files}/{FALLBACK_TABLE}")
    assert {(r["original_path"], bytes(r["content"])) for r in rows.collect()} == {("x", b"in the way"), ("../../out.txt", b"escape")}
    assert run.manifest.head()["verification_passed"]
    assert not os.path.exists(tmp_path / "out.txt") and not os.path.exists(tmp_path / "t" / "out.txt")


@pytest.mark.parametrize("rows", [CSV, "id,text\n1,a\n2,\"quoted, no break\"\n", "id,text\r\n1,5\" pipe\r\n2,x\r\n"])
def test_csv_with_and_without_breaks_inside_quotes(spark, tmp_path, rows):
    root = write_tree(tmp_path / "s", {"a.zip": zipped([("tables/c/c.csv", rows)])})
    (record,) = ops.restore_tables(spark, scan(spark, root), root, str(tmp_path / "t"))
    assert record["status"] == "success", record["error"]
    import pandas as pd

    want = [tuple(r) for r in pd.read_csv(io.StringIO(rows)).itertuples(index=False)]
    assert sorted(tuple(r) for r in scan_table(spark, str(tmp_path / "t" / "c")).collect()) == want


def test_csv_with_stored_schema(spark, tmp_path):
    schema = json.dumps({"columns": [{"name": "code", "type": "object"}, {"name": "n", "type": "int64"}, {"name": "d", "type": "date"}]})
    spark_schema = spark.createDataFrame([], "code string, n int").schema.json()
    data = zipped([
        ("tables/a/a.csv", "code,n,d\n007,1,2020-01-01\n"), ("tables/a/schema.json", schema),
        ("tables/b/b.csv", "code,n\n007,1\n"), ("tables/b/schema.json", spark_schema),
        ("tables/c/c.csv", "code,n\n007,x\n"), ("tables/c/schema.json", spark_schema),
    ])
    root = write_tree(tmp_path / "s", {"a.zip": data})
    records = {r["name"]: r for r in ops.restore_tables(spark, scan(spark, root), root, str(tmp_path / "t"))}
    assert scan_table(spark, str(tmp_path / "t" / "a")).dtypes == [("code", "string"), ("n", "bigint"), ("d", "date")]
    assert tuple(scan_table(spark, str(tmp_path / "t" / "b")).head()) == ("007", 1)
    # A value that does not fit the stored schema is an error, never a silent null.
    assert records["c"]["status"] == "failed" and not os.path.exists(tmp_path / "t" / "c")


def test_quote_watch_over_block_borders():
    from snapvault.sources.workers import _QuoteWatch

    def seen(text, size):
        source = io.BytesIO(text)
        watch = _QuoteWatch(source)
        out = b""
        while block := watch.read(size):
            out += block
        assert out == text
        return watch.found

    for size in (1, 2, 3, 7, 1000):
        assert seen(b'a,"b\nc",d\n', size) and seen(b'a\n"x""y\n"\n', size)
        assert not seen(b'a,"b c",d\n"e"\n', size) and not seen(b'a\n"x""y"\n""\n', size)


def test_table_in_volumes_of_different_formats(spark, tmp_path):
    p = parquet(spark, tmp_path, spark.range(3))
    root = write_tree(
        tmp_path / "s",
        {
            "1.zip": zipped([("tables/both/both.parquet", p), ("tables/both/both.csv", "id\n9\n"), ("tables/mixed/mixed.parquet", p)]),
            "2.zip": zipped([("tables/both/both.csv", "id\n8\n"), ("tables/mixed/mixed.csv", "id\n8\n")]),
            "3.zip": zipped([("tables/both/schema.json", "{}")]),
        },
    )
    records = {r["name"]: r for r in ops.restore_tables(spark, scan(spark, root), root, str(tmp_path / "t"))}
    # Only CSV is there in all volumes; no single format holds all of the other table.
    assert (records["both"]["method"], records["both"]["row_count"]) == ("archive_csv", 2)
    assert records["mixed"]["status"] == "failed"


def test_csv_volumes_with_other_columns_fail(spark, tmp_path):
    root = write_tree(
        tmp_path / "s",
        {"1.zip": zipped([("tables/c/c.csv", "a,b\n1,2\n")]), "2.zip": zipped([("tables/c/c.csv", "b,a\n1,2\n")])},
    )
    (record,) = ops.restore_tables(spark, scan(spark, root), root, str(tmp_path / "t"))
    assert record["status"] == "failed"


def test_a_null_archive_fails_alone(spark, tmp_path):
    good = bytearray(zipped([("files/a.txt", "a")]))
    rows = spark.createDataFrame([(good,), (None,)], "zip_binary binary")
    listed = archive_entries_binary(rows.selectExpr("'x' archive", "zip_binary")).collect()
    assert sorted(bool(r["error"]) for r in listed) == [False, True]
    rows.write.parquet(str(tmp_path / "snap/files_backup_zip_data"))
    run = restore(spark, str(tmp_path / "snap"), Lakehouse(str(tmp_path / "t")), require_manifest=False)
    got = {(r["kind"], r["status"]) for r in run.items.collect()}
    assert got == {("file", "success"), ("archive", "failed")}


def test_table_names_that_look_like_wildcards(spark, tmp_path):
    t = parquet(spark, tmp_path, spark.range(4))
    entries = [(f"tables/{n}/{n}.parquet", t) for n in ("a[1]", "b{x}")] + [("tables/c*/c*.csv", "id\n1\n2\n")]
    snap = write_tree(tmp_path / "snap", {"x.zip": zipped(entries)})
    run = restore(spark, snap, Lakehouse(str(tmp_path / "t")), files=False)
    assert {(r["name"], r["status"], r["row_count"]) for r in run.items.collect()} == {
        ("a[1]", "success", 4), ("b{x}", "success", 4), ("c*", "success", 2),
    }


def test_schema_documents_that_disagree_fail_the_table(spark, tmp_path):
    files = {
        f"{kind}.zip": zipped([("tables/t/t.csv", "id\n1\n"), ("tables/t/schema.json", json.dumps([{"name": "id", "type": kind}]))])
        for kind in ("int64", "object")
    }
    run = restore(spark, write_tree(tmp_path / "snap", files), Lakehouse(str(tmp_path / "t")), files=False)
    row = run.items.head()
    assert (row["status"], row["error"]) == ("failed", "archives disagree on the schema")


def test_rows_of_an_earlier_run_rescue_nothing(spark, tmp_path):
    """A damaged entry stays a failure, also where an earlier run has kept that file as a row."""
    target = Lakehouse(str(tmp_path / "t"))
    good, bad = zipped([("files/a.txt", "a" * 1000)], zipfile.ZIP_STORED), bytearray(zipped([("files/a.txt", "a" * 1000)], zipfile.ZIP_STORED))
    bad[bad.index(b"aaaa") + 100] = ord("b")
    os.makedirs(f"{target.files}/a.txt/in_the_way")
    first = restore(spark, write_tree(tmp_path / "one", {"x.zip": good}), target)
    assert first.items.head()["method"] == "table_copy" and first.manifest.head()["verification_passed"]
    os.rmdir(f"{target.files}/a.txt/in_the_way")
    os.rmdir(f"{target.files}/a.txt")
    second = restore(spark, write_tree(tmp_path / "two", {"x.zip": bytes(bad)}), target)
    row = second.items.head()
    assert row["status"] == "failed" and "CRC" in row["error"] and second.manifest.head()["status"] == "failed"


def test_two_restores_in_the_same_second(spark, snap, tmp_path, monkeypatch):
    from snapvault.operators import restore as module

    moment = module.now()
    monkeypatch.setattr(module, "now", lambda: moment)
    target = Lakehouse(str(tmp_path / "t"))
    assert len({restore(spark, snap, target).manifest.head()["restore_id"] for _ in range(2)}) == 2
    assert len([n for n in os.listdir(target.files) if n.startswith("_restore_manifest_")]) == 2


@pytest.mark.parametrize("document", ["{not json", '{"fields": 1}', '[{"name": "id", "type": "no such type"}]'])
def test_a_schema_document_that_cannot_be_read_fails_the_table(spark, tmp_path, document):
    """Guessed types would turn 007 into 7 and call it success."""
    root = write_tree(tmp_path / "s", {"1.zip": zipped([("tables/t/t.csv", "id\n007\n"), ("tables/t/schema.json", document)])})
    row = ops.restore_tables(spark, scan(spark, root), root, str(tmp_path / "t"))[0]
    assert row["status"] == "failed" and "schema document cannot be read" in row["error"]
    assert not (tmp_path / "t" / "t").exists()


def test_small_contents_share_a_batch(tmp_path):
    """A batch for each entry costs far more than a small entry does."""
    import pyarrow as pa

    from snapvault.sources import workers

    (tmp_path / "a.zip").write_bytes(zipped([(f"files/{i}", f"text {i}") for i in range(50)]))
    with zipfile.ZipFile(tmp_path / "a.zip") as z:
        rows = [
            {"archive": "a.zip", "entry": i.filename, "size": i.file_size, "compressed_size": i.compress_size, "crc": i.CRC,
             "method": i.compress_type, "flags": i.flag_bits, "offset": i.header_offset}
            for i in z.infolist()
        ]
    out = list(workers.content_reader(str(tmp_path), 4)(iter([pa.RecordBatch.from_pylist(rows)])))
    parts = [row for batch in out for row in batch.to_pylist()]
    found = {e["entry"]: b"".join(p["content"] for p in parts if p["entry"] == e["entry"]) for e in rows}
    assert len(out) == 1 and found == {f"files/{i}": f"text {i}".encode() for i in range(50)}
    assert not any(p["error"] for p in parts)
