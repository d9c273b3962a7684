"""The file-system work that runs inside Spark tasks: list, copy, unzip, delete.

Every function here takes Arrow batches and yields Arrow batches, for ``mapInArrow``. A task only
ever holds one block of a file and one batch of result rows. All of it can be run again after a
lost executor: copies go to a name of their own and are moved into place, and deleting what is
already gone counts as done.
"""

from __future__ import annotations

import hashlib
import io
import os
import posixpath
import re
import shutil
import stat
import struct
import sys
import uuid
import zipfile
from collections import deque
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle

# Executors need not have this package installed: its worker code travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4 << 20
BATCH_ROWS = 5_000
SEGMENT_BYTES = 64 << 20  # of a file that has a digest of its own
LINKED = "linked folder, not followed"
NOWHERE = "link to nothing"
OBJECT_STORES = ("s3", "gcs", "abfs")
# Fixed value: the largest object that S3-like stores copy in one request. A larger one passes through its task in blocks.
STORE_COPY_LIMIT = 5 << 30

_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(.*)$", re.S)


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a Hadoop-style URI; names are taken literally, never decoded."""
    found = _SCHEME.match(uri)
    if not found or found.group(1) == "file":
        return pafs.LocalFileSystem(), found.group(3) if found else uri
    scheme, authority, path = found.group(1), found.group(2) or "", found.group(3)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, posixpath.join(base, path.lstrip("/")) if base.strip("/") else path


def _emit(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _in_batches(schema: pa.Schema, rows):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= BATCH_ROWS:
            yield _emit(schema, held)
            held = []
    if held:
        yield _emit(schema, held)


def _text(error: BaseException) -> str:
    return f"{type(error).__name__}: {error}"


# --- list -----------------------------------------------------------------------------------------

LISTING = pa.schema(
    [
        ("relative_path", pa.string()),
        ("name", pa.string()),
        ("is_directory", pa.bool_()),
        ("size", pa.int64()),
        ("modification_time", pa.timestamp("us", tz="UTC")),
        ("error", pa.string()),
        ("pending", pa.bool_()),
    ]
)


def _directory_entries(fs: pafs.FileSystem, path: str):
    """(name, is directory, size, time, error) of each child; local folders are read as a stream.

    A linked folder is not followed, since links can form a ring; it is an entry with an error, as is a link to nothing.
    """
    if isinstance(fs, pafs.LocalFileSystem):
        with os.scandir(path) as entries:
            for entry in entries:
                try:
                    info = entry.stat()
                except FileNotFoundError:
                    if entry.is_symlink():
                        yield entry.name, False, None, None, NOWHERE
                    continue  # else gone since the listing
                is_dir = stat.S_ISDIR(info.st_mode)
                linked = LINKED if is_dir and entry.is_symlink() else None
                when = datetime.fromtimestamp(info.st_mtime, timezone.utc)
                yield entry.name, is_dir, 0 if is_dir else info.st_size, when, linked
        return
    for info in fs.get_file_info(pafs.FileSelector(path, recursive=False)):
        is_dir = info.type == pafs.FileType.Directory
        yield info.base_name, is_dir, 0 if is_dir else info.size, info.mtime, None


def lister(root: str, include_hidden: bool, directory_budget: int, entry_budget: int):
    """List the directories named in ``relative_path``, and those below them within a budget.

    Beyond the budget a directory comes back as a row with ``pending`` set, for the next round to
    spread over all tasks. A budget of zero never goes below the given directories.
    """

    def walk(fs, base, start):
        queue, listed, seen = deque([start]), 0, 0
        while queue:
            here = queue.popleft()
            if listed and seen >= entry_budget:
                yield (here, None, True, None, None, None, True)
                continue
            listed += 1
            try:
                for name, is_dir, size, when, fault in _directory_entries(fs, posixpath.join(base, here) if here else base):
                    if not include_hidden and name[:1] in ("_", "."):
                        continue
                    seen += 1
                    path = f"{here}/{name}" if here else name
                    yield (path, name, is_dir, size, when, fault, False)
                    if is_dir and directory_budget and not fault:
                        if listed + len(queue) < directory_budget:
                            queue.append(path)
                        else:
                            yield (path, None, True, None, None, None, True)
            except Exception as error:
                yield (here, posixpath.basename(here), True, None, None, _text(error), False)

    def run(batches):
        fs, base = resolve(root)
        rows = (
            row
            for batch in batches
            for start in batch.column("relative_path").to_pylist()
            for row in walk(fs, base, start)
        )
        yield from _in_batches(LISTING, rows)

    return run


# --- copy -----------------------------------------------------------------------------------------

STATUS = pa.schema(
    [
        ("relative_path", pa.string()),
        ("size", pa.int64()),
        ("status", pa.string()),
        ("written_bytes", pa.int64()),
        ("error", pa.string()),
        ("digest", pa.string()),
    ]
)


class Digest:
    """SHA-256 of each segment of the bytes that pass by, and of these digests in order: the digest of a file.

    So a file can be checked by many tasks, a segment each, and a copy takes it while it streams.
    """

    def __init__(self, segment_bytes: int = SEGMENT_BYTES):
        self._size, self._whole = segment_bytes, []
        self._open, self._left = hashlib.sha256(), segment_bytes

    def update(self, block) -> None:
        rest = memoryview(block)
        while len(rest):
            part, rest = rest[: self._left], rest[self._left :]
            self._open.update(part)
            self._left -= len(part)
            if not self._left:
                self._whole.append(self._open.hexdigest())
                self._open, self._left = hashlib.sha256(), self._size

    def hexdigest(self) -> str:
        last = [] if self._whole and self._left == self._size else [self._open.hexdigest()]
        return hashlib.sha256("".join(self._whole + last).encode()).hexdigest()


ALTERED = "content is not that of its record"


class Target:
    """Writes whole files below a root.

    On file systems with a rename a file gets a staging name first and is then moved into place. Each task stages in a folder of
    its own below ``staging``: in one folder for all, tasks that create and move at the same moment wait for one another.
    Object stores show an object only once it is complete, so there it is written in place.
    """

    def __init__(self, root: str, staging: str):
        self.fs, self.root = resolve(root)
        self.staging = posixpath.join(self.root, staging, uuid.uuid4().hex)
        self.in_place = self.fs.type_name in OBJECT_STORES
        self.made: set[str] = set()

    def path(self, relative: str) -> str:
        if relative.startswith("/") or ".." in relative.split("/"):
            raise ValueError(f"path leaves the target folder: {relative}")
        return posixpath.join(self.root, relative)

    def folder(self, path: str) -> None:
        if path not in self.made:
            self.fs.create_dir(path, recursive=True)
            self.made.add(path)
            if len(self.made) > 100_000:
                self.made.clear()

    def put(self, source, relative: str, digest: Digest | None = None, expected: str | None = None) -> int:
        """Stream ``source`` into the file, block by block, past ``digest``. If that is not ``expected`` in the end, it is an error, and
        the file does not get its place (on object stores, which are written in place, it is removed again)."""

        def stream(path):
            with self.fs.open_output_stream(path, compression=None) as sink:
                while block := source.read(BLOCK):
                    if digest is not None:
                        digest.update(block)
                    sink.write(block)
                written = sink.tell()
            if expected is not None and digest.hexdigest() != expected:
                raise OSError(ALTERED)
            return written

        return self._write(stream, relative)

    def put_same_store(self, source_path: str, relative: str, size: int) -> int:
        """Copy inside one store without moving the bytes through the task."""
        if self.in_place and (size is None or size > STORE_COPY_LIMIT):
            with self.fs.open_input_stream(source_path, compression=None) as source:
                return self.put(source, relative)

        def copy(path):
            self.fs.copy_file(source_path, path)
            return self.fs.get_file_info(path).size

        return self._write(copy, relative)

    def _write(self, action, relative: str) -> int:
        final = self.path(relative)
        if self.in_place:
            try:
                return action(final)
            except Exception:
                try:
                    self.fs.delete_file(final)
                except Exception:
                    pass
                raise
        self.folder(self.staging)
        draft = posixpath.join(self.staging, uuid.uuid4().hex)
        written = action(draft)
        self.folder(posixpath.dirname(final))
        try:
            self.fs.move(draft, final)
        except OSError:
            # Some file systems never move onto a file. The draft is complete, so the old one can go first.
            if self.fs.get_file_info(final).type != pafs.FileType.File:
                raise
            self.fs.delete_file(final)
            self.fs.move(draft, final)
        return written


def copier(source_root: str, target_root: str, staging: str):
    """Copy each file named in ``relative_path`` below one root to the same place below another, with a digest of its bytes.

    A ``digest`` that comes with a row is the one its bytes must have. Object stores copy inside themselves, without a digest,
    unless one is asked for.
    """

    def one(source_fs, source_base, target, relative, size, expected):
        try:
            path, digest = posixpath.join(source_base, relative), Digest()
            if target.in_place and not expected and source_fs.equals(target.fs):
                return (relative, size, "success", target.put_same_store(path, relative, size), None, None)
            with source_fs.open_input_stream(path, compression=None) as source:
                written = target.put(source, relative, digest, expected)
            return (relative, size, "success", written, None, digest.hexdigest())
        except Exception as error:
            return (relative, size, "failed", None, _text(error), None)

    def run(batches):
        source_fs, source_base = resolve(source_root)
        target = Target(target_root, staging)
        rows = (
            one(source_fs, source_base, target, row["relative_path"], row["size"], row.get("digest"))
            for batch in batches
            for row in batch.to_pylist()
        )
        yield from _in_batches(STATUS, rows)

    return run


CONTENTS = pa.schema(
    [
        ("relative_path", pa.string()),
        ("part", pa.int32()),
        ("offset", pa.int64()),
        ("size", pa.int64()),
        ("content", pa.binary()),
        ("error", pa.string()),
    ]
)
BATCH_BYTES = 64 << 20


def reader(root: str):
    """The bytes of each part (``offset``, ``size``) of a file; a batch holds one large or many small parts."""

    def one(fs, base, row):
        key = (row["relative_path"], row["part"], row["offset"], row["size"])
        try:
            with fs.open_input_file(posixpath.join(base, row["relative_path"])) as source:
                content = source.read_at(row["size"], row["offset"]) if row["size"] else b""
            if len(content) != row["size"]:
                raise OSError(f"{len(content)} bytes where {row['size']} were listed")
            return (*key, content, None)
        except Exception as error:
            return (*key, None, _text(error))

    def run(batches):
        fs, base = resolve(root)
        held, weight = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                size = row["size"] or 0
                if held and (weight + size > BATCH_BYTES or len(held) >= BATCH_ROWS):
                    yield _emit(CONTENTS, held)
                    held, weight = [], 0
                held.append(one(fs, base, row))
                weight += size
        if held:
            yield _emit(CONTENTS, held)

    return run


SEGMENTS = pa.schema([("relative_path", pa.string()), ("part", pa.int32()), ("digest", pa.string()), ("error", pa.string())])


def hasher(root: str):
    """SHA-256 of each part (``offset``, ``size``) of a file."""

    def one(fs, base, row):
        try:
            digest, left = hashlib.sha256(), row["size"]
            with fs.open_input_file(posixpath.join(base, row["relative_path"])) as source:
                source.seek(row["offset"])
                while left:
                    block = source.read(min(BLOCK, left))
                    if not block:
                        raise OSError(f"{left} bytes less than were listed")
                    digest.update(block)
                    left -= len(block)
            return (row["relative_path"], row["part"], digest.hexdigest(), None)
        except Exception as error:
            return (row["relative_path"], row["part"], None, _text(error))

    def run(batches):
        fs, base = resolve(root)
        yield from _in_batches(SEGMENTS, (one(fs, base, row) for batch in batches for row in batch.to_pylist()))

    return run


def writer(target_root: str, staging: str):
    """Write each row's ``content`` to a file at ``relative_path``."""

    def one(target, relative, content):
        size = None if content is None else len(content)
        try:
            if relative is None or content is None:
                raise ValueError("no path" if relative is None else "no content")
            digest = Digest()
            written = target.put(io.BytesIO(content), relative, digest)
            return (relative, size, "success", written, None, digest.hexdigest())
        except Exception as error:
            return (relative, size, "failed", None, _text(error), None)

    def run(batches):
        target = Target(target_root, staging)
        rows = (
            one(target, batch.column("relative_path")[i].as_py(), batch.column("content")[i].as_py())
            for batch in batches
            for i in range(batch.num_rows)
        )
        yield from _in_batches(STATUS, rows)

    return run


# --- delete ---------------------------------------------------------------------------------------

DELETED = pa.schema([("relative_path", pa.string()), ("status", pa.string()), ("error", pa.string())])


def deleter(root: str, directories: bool):
    """Delete each file, or each whole directory, named in ``relative_path`` below the root."""

    def one(fs, base, relative):
        try:
            if not relative or relative.startswith("/") or set(relative.split("/")) & {"", ".", ".."}:
                raise ValueError(f"not a path below the root: {relative!r}")
            try:
                path = posixpath.join(base, relative)
                fs.delete_dir(path) if directories else fs.delete_file(path)
            except FileNotFoundError:
                pass
            return (relative, "success", None)
        except Exception as error:
            return (relative, "failed", _text(error))

    def run(batches):
        fs, base = resolve(root)
        rows = (one(fs, base, r) for batch in batches for r in batch.column("relative_path").to_pylist())
        yield from _in_batches(DELETED, rows)

    return run


# --- archives -------------------------------------------------------------------------------------

class _Archives:
    """Opens entries straight at their offset; keeps the handle of the archive used last."""

    def __init__(self, root: str):
        self.fs, self.base = resolve(root)
        self.name, self.handle = None, None

    def entry(self, row: dict):
        if row["flags"] & 1:
            raise ValueError("entry is encrypted")
        if self.name != row["archive"]:
            if self.handle is not None:
                self.handle.close()
            self.name, self.handle = row["archive"], None
            self.handle = self.fs.open_input_file(posixpath.join(self.base, row["archive"]))
        self.handle.seek(row["offset"])
        header = self.handle.read(zipfile.sizeFileHeader)
        if header[:4] != b"PK\x03\x04":
            raise zipfile.BadZipFile("no entry at the recorded offset")
        name_length, extra_length = struct.unpack("<HH", header[26:30])
        self.handle.seek(name_length + extra_length, io.SEEK_CUR)
        info = zipfile.ZipInfo(row["entry"])
        info.compress_type, info.flag_bits = row["method"], row["flags"]
        info.compress_size, info.file_size, info.CRC = row["compressed_size"], row["size"], row["crc"]
        return zipfile.ZipExtFile(self.handle, "r", info, close_fileobj=False)


class _QuoteWatch(io.RawIOBase):
    """Passes bytes through and notes whether any line break stands inside double quotes."""

    def __init__(self, source):
        self.source, self.inside, self.found = source, False, False

    def read(self, size=-1):
        block = self.source.read(size)
        if not self.found:
            pieces = block.split(b'"')
            for piece in pieces[(0 if self.inside else 1) :: 2]:
                if b"\n" in piece or b"\r" in piece:
                    self.found = True
                    break
            self.inside ^= (len(pieces) - 1) % 2 == 1
        return block


EXTRACTED = pa.schema(
    [
        ("archive", pa.string()),
        ("entry", pa.string()),
        ("relative_path", pa.string()),
        ("size", pa.int64()),
        ("status", pa.string()),
        ("written_bytes", pa.int64()),
        ("quoted_newline", pa.bool_()),
        ("error", pa.string()),
    ]
)


def extractor(archive_root: str, target_root: str, staging: str):
    """Unpack one entry per row to ``relative_path``; each row reads only its own byte range."""

    def one(archives, target, row):
        key = (row["archive"], row["entry"], row["relative_path"], row["size"])
        try:
            with archives.entry(row) as source:
                watch = _QuoteWatch(source) if row["entry"].lower().endswith(".csv") else None
                written = target.put(watch or source, row["relative_path"])
            return (*key, "success", written, bool(watch and watch.found), None)
        except Exception as error:
            return (*key, "failed", None, None, _text(error))

    def run(batches):
        archives, target = _Archives(archive_root), Target(target_root, staging)
        rows = (one(archives, target, row) for batch in batches for row in batch.to_pylist())
        yield from _in_batches(EXTRACTED, rows)

    return run


CONTENT = pa.schema(
    [
        ("archive", pa.string()),
        ("entry", pa.string()),
        ("part", pa.int32()),
        ("offset", pa.int64()),
        ("content", pa.binary()),
        ("error", pa.string()),
    ]
)


def content_reader(archive_root: str, part_bytes: int):
    """The bytes of each entry in parts, one row a part; an entry that fails has a last row with ``error``. A batch holds one
    large or many small parts."""

    def parts(archives, row):
        part = offset = 0
        try:
            with archives.entry(row) as source:
                while True:
                    content = source.read(part_bytes)
                    if content or not part:
                        yield (row["archive"], row["entry"], part, offset, content, None)
                    if not content:
                        return
                    part, offset = part + 1, offset + len(content)
        except Exception as error:
            yield (row["archive"], row["entry"], part, offset, None, _text(error))

    def run(batches):
        archives, held, weight = _Archives(archive_root), [], 0
        for part in (part for batch in batches for row in batch.to_pylist() for part in parts(archives, row)):
            size = len(part[4] or b"")
            if held and (weight + size > BATCH_BYTES or len(held) >= BATCH_ROWS):
                yield _emit(CONTENT, held)
                held, weight = [], 0
            held.append(part)
            weight += size
        if held:
            yield _emit(CONTENT, held)

    return run
