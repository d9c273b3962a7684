"""The central directory of ZIP archives, read in runs of whole entries by many tasks.

The end record stands in the last bytes of an archive; Spark expressions find it there, for archive files and for archives in
a table alike. A file's directory is then walked once in blocks, which gives its runs; each run is a row of work of its own.
"""

from __future__ import annotations

import io
import posixpath
import struct
import sys
import zipfile

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.sources.workers import BLOCK, _in_batches, _text, resolve

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the ZIP format: signatures, and the sizes of the records at the end of an archive.
ENTRY, END = b"PK\x01\x02", "PK\x05\x06"
WIDE_END, WIDE_LOCATOR = "PK\x06\x06", "PK\x06\x07"
ENTRY_BYTES, END_BYTES, WIDE_BYTES, COMMENT_BYTES = 46, 22, 56 + 20, 65_535

RUN_BYTES = 1 << 20
TASK_BYTES = 32 << 20  # of runs, each with the cost of opening a file

TAILS = "archive string, size bigint, tail binary, error string"
RUNS = "archive string, start bigint, size bigint, shift bigint, error string"
ENTRIES = (
    "archive string, number bigint, entry string, size bigint, compressed_size bigint, crc bigint, method int, flags int, "
    "offset bigint, error string"
)
_TAILS = pa.schema([("archive", pa.string()), ("size", pa.int64()), ("tail", pa.binary()), ("error", pa.string())])
_RUNS = pa.schema(
    [("archive", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("shift", pa.int64()), ("error", pa.string())]
)
_ENTRIES = pa.schema(
    [
        ("archive", pa.string()),
        ("number", pa.int64()),
        ("entry", pa.string()),
        ("size", pa.int64()),
        ("compressed_size", pa.int64()),
        ("crc", pa.int64()),
        ("method", pa.int32()),
        ("flags", pa.int32()),
        ("offset", pa.int64()),
        ("error", pa.string()),
    ]
)


def _little(value: Column, at: Column, width: int) -> Column:
    """The unsigned number in ``width`` bytes of a binary column, lowest byte first, from byte ``at`` (counted from 0)."""
    digits = [F.substr(value, at + F.lit(i + 1), F.lit(1)) for i in reversed(range(width))]
    return F.conv(F.hex(F.concat(*digits)), 16, 10).try_cast("bigint")


def tail_of(value: Column) -> Column:
    """The end of a binary column in which an end record must stand."""
    length = F.lit(END_BYTES + WIDE_BYTES + COMMENT_BYTES)
    return F.substr(value, F.greatest(F.length(value) - length + 1, F.lit(1)), length)


def located(archives: DataFrame) -> DataFrame:
    """Adds where the directory stands: ``start``, ``bytes``, and ``shift``, which recorded offsets lack; or ``error``.

    Needs ``size``, ``tail`` and ``error``. Bytes in front of an archive, a comment behind it and 64-bit records are taken into
    account. Leaves out ``tail``.
    """
    text, tail, at = F.col("_text"), F.col("tail"), F.col("_at")

    def signature(place, expected):
        return F.substr(text, place + F.lit(1), F.lit(4)) == F.lit(expected)

    wide = (at >= WIDE_BYTES) & signature(at - 20, WIDE_LOCATOR) & signature(at - WIDE_BYTES, WIDE_END)
    size = F.when(F.col("_wide"), _little(tail, at - (WIDE_BYTES - 40), 8)).otherwise(_little(tail, at + 12, 4))
    offset = F.when(F.col("_wide"), _little(tail, at - (WIDE_BYTES - 48), 8)).otherwise(_little(tail, at + 16, 4))
    end = F.col("size") - F.length(tail) + at - F.when(F.col("_wide"), WIDE_BYTES).otherwise(0)
    wrong = F.when(F.col("size").isNull(), "archive without content").when(at < 0, "no end of an archive found")
    outside = F.when(F.coalesce(F.col("start") < 0, F.lit(True)), "directory does not lie inside the archive")
    return (
        archives.withColumn("_text", F.decode("tail", "ISO-8859-1"))
        .withColumn("_at", F.length("tail") - F.length(F.substring_index(text, END, -1)) - 4)
        .withColumn("error", F.coalesce("error", wrong))
        .withColumn("_wide", wide)
        .withColumn("bytes", F.when(F.col("error").isNull(), size))
        .withColumn("start", end - F.col("bytes"))
        .withColumn("shift", F.col("start") - offset)
        .withColumn("error", F.coalesce("error", outside))
        .drop("_text", "_at", "_wide", "tail")
    )


def tail_reader(root: str):
    """Size and last bytes of each archive file; no more than the end record where no comment follows it."""

    def one(fs, base, relative):
        try:
            with fs.open_input_file(posixpath.join(base, relative)) as source:
                size = source.size()
                length = min(size, END_BYTES + WIDE_BYTES)
                tail = source.read_at(length, size - length)
                if tail[-END_BYTES:][:4] != END.encode():
                    length = min(size, END_BYTES + WIDE_BYTES + COMMENT_BYTES)
                    tail = source.read_at(length, size - length)
            return (relative, size, tail, None)
        except Exception as error:
            return (relative, None, None, _text(error))

    def run(batches):
        fs, base = resolve(root)
        names = (name for batch in batches for name in batch.column("relative_path").to_pylist())
        yield from _in_batches(_TAILS, (one(fs, base, name) for name in names))

    return run


def _runs(source, start: int, size: int, run_bytes: int):
    """``(start, size)`` of runs of whole entries; of the directory only one block is held."""
    at = first = start
    end, block, origin = start + size, b"", start
    while at < end:
        if at + ENTRY_BYTES > origin + len(block):
            block, origin = source.read_at(min(BLOCK, end - at), at), at
        local = at - origin
        if len(block) - local < ENTRY_BYTES or block[local : local + 4] != ENTRY:
            raise zipfile.BadZipFile(f"no directory entry at byte {at}")
        behind = at + ENTRY_BYTES + sum(struct.unpack_from("<3H", block, local + 28))
        if behind > end:
            raise zipfile.BadZipFile(f"directory ends inside the entry at byte {at}")
        if behind - first > run_bytes and at > first:
            yield first, at - first
            first = at
        at = behind
    if at > first:
        yield first, at - first


def run_lister(root: str, run_bytes: int = RUN_BYTES):
    """The runs of each archive's directory, or one row with its ``error``."""

    def runs(fs, base, row):
        name = row["archive"]
        try:
            if row["error"]:
                return [(name, None, None, None, row["error"])]
            with fs.open_input_file(posixpath.join(base, name)) as source:
                found = list(_runs(source, row["start"], row["bytes"], run_bytes))
            return [(name, start, size, row["shift"], None) for start, size in found]
        except Exception as error:
            return [(name, None, None, None, _text(error))]

    def run(batches):
        fs, base = resolve(root)
        rows = (found for batch in batches for row in batch.to_pylist() for found in runs(fs, base, row))
        yield from _in_batches(_RUNS, rows)

    return run


def _failed(archive, error):
    return (archive, 0, *[None] * 7, error)


def _parsed(archive, directory: bytes, start: int, shift: int):
    """Rows of whole entries. With an end record of their own behind them they are a directory that ``zipfile`` reads."""
    end = struct.pack("<4s4H2LH", END.encode(), 0, 0, 0, 0, len(directory), 0, 0)
    with zipfile.ZipFile(io.BytesIO(directory + end)) as zipped:
        for number, info in enumerate(zipped.infolist()):
            sizes = (info.file_size, info.compress_size, info.CRC, info.compress_type, info.flag_bits)
            yield (archive, start + number, info.filename, *sizes, info.header_offset + shift, None)


def entry_reader(root: str):
    """The entries of each run (``start``, ``size``) of an archive's directory, numbered in the directory's order."""

    def entries(fs, base, row):
        try:
            if row["error"]:
                return [_failed(row["archive"], row["error"])]
            with fs.open_input_file(posixpath.join(base, row["archive"])) as source:
                directory = source.read_at(row["size"], row["start"])
            return list(_parsed(row["archive"], directory, row["start"], row["shift"]))
        except Exception as error:
            return [_failed(row["archive"], _text(error))]

    def run(batches):
        fs, base = resolve(root)
        rows = (entry for batch in batches for row in batch.to_pylist() for entry in entries(fs, base, row))
        yield from _in_batches(_ENTRIES, rows)

    return run


def directory_parser():
    """The entries of each whole ``directory``; when a name stands there twice, its last entry."""

    def entries(row):
        try:
            if row["error"]:
                return [_failed(row["archive"], row["error"])]
            rows = _parsed(row["archive"], row["directory"], row["start"], row["shift"])
            return list({entry[2]: entry for entry in rows}.values())
        except Exception as error:
            return [_failed(row["archive"], _text(error))]

    def run(batches):
        held = (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows))
        yield from _in_batches(_ENTRIES, (entry for row in held for entry in entries(row)))

    return run
