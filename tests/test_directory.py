import io
import struct
import zipfile

import pyarrow as pa
import pytest
from conftest import write_tree

from snapvault.sources import directory
from snapvault.sources.archives import archive_entries, archive_entries_binary

FIELDS = ("entry", "size", "compressed_size", "crc", "method", "flags", "offset")


def zipped(names, comment=b"", entry_comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, name in enumerate(names):
            info = zipfile.ZipInfo(name)
            info.comment = entry_comment
            z.writestr(info, f"{name} {i}" * (i % 7))
        z.comment = comment
    return out.getvalue()


def wide(names, monkeypatch, **more):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = zipped(names, **more)
    monkeypatch.undo()
    assert b"PK\x06\x06" in data
    return data


def plainly(data):
    """Entries of an archive by the standard library, the last one of each name; None where it cannot be read."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            last = {i.filename: i for i in z.infolist()}
    except zipfile.BadZipFile:
        return None
    return {
        (i.filename, i.file_size, i.compress_size, i.CRC, i.compress_type, i.flag_bits, i.header_offset)
        for i in last.values()
        if not i.filename.endswith("/")
    }


@pytest.fixture
def archives(monkeypatch):
    names = [f"files/{i:03}/näme €{i}.txt" for i in range(150)] + ["files/folder/", "plain", "x" * 60_000]
    with pytest.warns(UserWarning, match="Duplicate"):
        twice = zipped(["a", "b", "a", "c", "b"] * 20)
    whole = zipped(names)
    at = whole.index(b"PK\x01\x02")
    return {
        "plain.zip": whole,
        "empty.zip": zipped([]),
        "twice.zip": twice,
        "behind.zip": b"bytes in front " * 10_000 + whole,
        "comment.zip": zipped(names, comment=b"c" * 65_535),
        "signatures.zip": zipped(names, entry_comment=b"PK\x01\x02 and PK\x05\x06 inside", comment=b"PK\x01\x02"),
        "wide.zip": wide(names, monkeypatch),
        "wide_behind.zip": b"in front" + wide(names, monkeypatch, comment=b"and a comment"),
        "nothing.zip": b"",
        "short.zip": b"PK",
        "text.zip": b"no archive at all " * 20_000,
        "cut.zip": whole[:-30],
        "entry.zip": whole[:at] + b"XX" + whole[at + 2 :],
        "outside.zip": struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 1, 1, 5_000, 0, 0),
    }


def by_archive(rows):
    found = {}
    for row in rows:
        entry = None if row["error"] else tuple(row[f] for f in FIELDS)
        found.setdefault(row["archive"], []).append(entry)
    return found


def test_both_ways_read_what_the_standard_library_reads(spark, tmp_path, archives):
    root = write_tree(tmp_path, archives)
    names = spark.createDataFrame([(n,) for n in [*archives, "gone.zip", "plain.zip"]], "relative_path string")
    held = spark.createDataFrame([(n, bytearray(d)) for n, d in archives.items()], "archive string, zip_binary binary")
    files = by_archive(archive_entries(spark, root, names, run_bytes=400).collect())
    values = by_archive(archive_entries_binary(held).collect())
    assert files.pop("gone.zip") == [None]
    for name, data in archives.items():
        expected = plainly(data)
        for found in (files, values):
            rows = found.pop(name, [])
            assert rows == [None] if expected is None else (len(rows) == len(expected) and set(rows) == expected), name
    assert not files and not values


def test_archives_of_one_name_without_content_and_none_at_all(spark, tmp_path):
    schema = "archive string, zip_binary binary"
    good = bytearray(zipped(["a"]))
    rows = archive_entries_binary(spark.createDataFrame([("x", good), ("x", good), ("x", None), (None, good)], schema)).collect()
    assert sorted((str(r["archive"]), str(r["entry"])) for r in rows) == [("None", "a"), ("x", "None"), ("x", "a"), ("x", "a")]
    assert archive_entries_binary(spark.createDataFrame([], schema)).count() == 0
    assert archive_entries(spark, str(tmp_path), spark.createDataFrame([], "relative_path string")).count() == 0


def test_runs_are_whole_entries_and_blocks_do_not_matter(archives, monkeypatch):
    data = archives["plain.zip"]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        start, count = z.start_dir, len(z.infolist())
    size = len(data) - 22 - start

    class Source:
        largest = 0

        def read_at(self, length, at):
            Source.largest = max(Source.largest, length)
            return data[at : at + length]

    for block, run_bytes in [(64, 1), (100, 300), (70_000, 4_096), (1 << 20, 1 << 20)]:
        monkeypatch.setattr(directory, "BLOCK", block)
        Source.largest = 0
        runs = list(directory._runs(Source(), start, size, run_bytes))
        assert Source.largest <= block and runs[0][0] == start and sum(n for _, n in runs) == size
        assert all(a + n == b for (a, n), (b, _) in zip(runs, runs[1:]))
        read = [row[2] for at, n in runs for row in directory._parsed("x", data[at : at + n], at, 0)]
        assert len(read) == count and (len(runs) == count) == (run_bytes == 1)


def test_a_run_that_cannot_be_understood_leaves_the_others(tmp_path):
    data = bytearray(zipped([f"n{i}" for i in range(20)]))
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        start = z.start_dir
    data[start + 6] = 99  # the version needed to read the first entry, which nobody knows
    root = write_tree(tmp_path, {"a.zip": bytes(data)})
    ends = pa.RecordBatch.from_pylist([{"archive": "a.zip", "start": start, "bytes": len(data) - 22 - start, "shift": 0, "error": None}])
    runs = list(directory.run_lister(root, 100)([ends]))
    rows = [row for batch in directory.entry_reader(root)(runs) for row in batch.to_pylist()]
    failed = [row for row in rows if row["error"]]
    assert len(failed) == 1 and failed[0]["entry"] is None and {r["entry"] for r in rows} >= {f"n{i}" for i in range(2, 20)}
