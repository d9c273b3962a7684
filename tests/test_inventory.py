import os

import pyarrow.fs as pafs
import pytest
from conftest import write_tree

from snapvault.sources import workers
from snapvault.sources.inventory import binary_file_inventory, child_directories, file_inventory, folder_sizes, walk

FILES = {
    "a.csv": "1,2",
    "sub/b.PDF": "pdf",
    "noext": "x",
    "sub/x=1.csv": "y",
    "x.tar.gz": "z" * 100,
    "empty.bin": "",
    "sub/deep/er/c d%20#.txt": "spaces",
    "sub/ü.txt": "utf",
    "_c.txt": "hidden",
    ".d.txt": "hidden",
    "sub/_hid/e.txt": "hidden below",
    ".dot/f.txt": "hidden below",
}
VISIBLE = [f for f in FILES if not any(p[:1] in "_." for p in f.split("/"))]


@pytest.fixture
def root(tmp_path):
    return write_tree(tmp_path / "lake" / "Files", FILES)


def _files(df):
    return {r["relative_path"]: r["size"] for r in df.where("NOT is_directory").collect()}


@pytest.mark.parametrize("budgets", [(200, 50_000), (1, 50_000), (2, 1), (200, 1)])
def test_walk_finds_everything_once(spark, root, budgets):
    for hidden, names in ((False, VISIBLE), (True, list(FILES))):
        df = walk(spark, root, hidden, directory_budget=budgets[0], entry_budget=budgets[1])
        rows = df.collect()
        assert len(rows) == len({r["relative_path"] for r in rows})
        assert _files(df) == {f: len(FILES[f].encode()) for f in names}
        folders = {"/".join(f.split("/")[:n]) for f in names for n in range(1, f.count("/") + 1)}
        assert {r["relative_path"] for r in rows if r["is_directory"]} == folders


def test_inventory_shape(spark, root):
    rows = {r["relative_path"]: r for r in file_inventory(spark, root).collect()}
    row = rows["sub/b.PDF"]
    assert (row["name"], row["type"], row["size"], row["path"]) == ("b.PDF", "document", 3, f"{root}/sub/b.PDF")
    assert rows["noext"]["type"] == "unknown" and rows["sub"]["type"] == "directory"
    assert abs(row["modification_time"].timestamp() - os.stat(f"{root}/sub/b.PDF").st_mtime) < 86400


def test_binary_file_scan_has_empty_files(spark, root):
    rows = {r["relative_path"]: r["size"] for r in binary_file_inventory(spark, root).collect()}
    assert rows == {f: len(FILES[f].encode()) for f in VISIBLE}


def test_a_root_that_cannot_be_listed_is_an_error(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(OSError, match="cannot be listed"):
        child_directories(spark, str(tmp_path / "file"))


def test_child_directories(spark, root):
    assert [r["name"] for r in child_directories(spark, root).collect()] == ["sub"]
    hidden = child_directories(spark, root, include_hidden=True)
    assert {r["name"] for r in hidden.collect()} == {"sub", ".dot"}


def test_missing_root_raises_and_missing_folder_is_a_row(spark, root):
    with pytest.raises(FileNotFoundError):
        walk(spark, root + "/nothing")
    starts = spark.createDataFrame([("sub",), ("gone",)], "relative_path string")
    found = walk(spark, root, True, starts=starts)
    errors = found.where("error IS NOT NULL").collect()
    assert [e["relative_path"] for e in errors] == ["gone"] and "FileNotFound" in errors[0]["error"]
    sizes = {r["name"]: r for r in folder_sizes(found).collect()}
    assert sizes["gone"]["size_bytes"] is None and sizes["gone"]["error"]
    assert sizes["sub"]["size_bytes"] == sum(len(c.encode()) for f, c in FILES.items() if f.startswith("sub/"))


def test_links_do_not_loop(spark, root):
    os.symlink(root, f"{root}/sub/loop")
    os.symlink(f"{root}/nowhere", f"{root}/sub/broken")
    os.symlink(f"{root}/a.csv", f"{root}/sub/link.csv")
    found = _files(walk(spark, root))
    assert found["sub/link.csv"] == 3 and found["sub/broken"] is None and len(found) == len(VISIBLE) + 2
    linked = walk(spark, root).where("error IS NOT NULL").collect()
    assert sorted((r["relative_path"], r["error"]) for r in linked) == [("sub/broken", "link to nothing"), ("sub/loop", "linked folder, not followed")]


def test_listing_is_the_same_through_any_file_system(root):
    plain = sorted(workers._directory_entries(pafs.LocalFileSystem(), root))
    other = sorted(workers._directory_entries(pafs.SubTreeFileSystem(root, pafs.LocalFileSystem()), ""))
    strip = lambda rows: [r[:3] for r in rows]
    assert strip(plain) == strip(other)


def test_resolve():
    for uri in ("/a/b c%20#", "file:/a/b c%20#", "file:///a/b c%20#"):
        fs, path = workers.resolve(uri)
        assert isinstance(fs, pafs.LocalFileSystem) and path == "/a/b c%20#"


def test_many_directories_in_rounds(spark, tmp_path):
    write_tree(tmp_path / "wide", {f"d{i % 7}/e{i % 40}/f{i}": "x" * i for i in range(300)})
    found = _files(walk(spark, str(tmp_path / "wide"), directory_budget=5))
    assert found == {f"d{i % 7}/e{i % 40}/f{i}": i for i in range(300)}
