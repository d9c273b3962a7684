"""Tables as versions and a pointer: what readers see changes when one small file appears, and nothing is ever renamed.

Inside the table's folder every version is a hidden folder, complete before anyone reads it. ``_pointer`` holds numbered files that
name one version each; the highest number counts. A writer takes the next number, and it must not be there yet, so of two writers
that started from the same version only one gets through. Spark alone, without :func:`current`, finds no data in such a folder.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from snapvault.sources.hadoop import Folders

POINTERS = "_pointer"
VERSION = "_v-"


class ConcurrentCommit(Exception):
    """Another writer has replaced, or is about to replace, the version that this one started from."""


def new_version() -> str:
    return f"{VERSION}{uuid.uuid4().hex}"


def pointers(spark: SparkSession, path: str) -> dict[int, str]:
    """The version that each pointer names, by number; empty where a writer has not finished its pointer."""
    folders = Folders(spark)
    try:
        names = [name for name, _, _ in folders.children(f"{path}/{POINTERS}") if name.isdigit()]
    except Exception:  # no such folder, or the path is a file
        return {}
    return {int(name): folders.read_text(f"{path}/{POINTERS}/{name}") for name in names}


def latest(spark: SparkSession, path: str) -> int:
    """Number of the pointer that counts; 0 for a table without one."""
    return max((number for number, version in pointers(spark, path).items() if version), default=0)


def current(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: the version its pointer names, or the folder itself."""
    path = path.rstrip("/")
    if not Folders(spark).exists(f"{path}/{POINTERS}"):
        return path
    named = pointers(spark, path)
    number = max((n for n, version in named.items() if version), default=0)
    return f"{path}/{named[number]}" if number else path


def point(spark: SparkSession, path: str, version: str, after: int) -> None:
    """Make ``version`` the one that counts, if number ``after`` still does."""
    try:
        Folders(spark).create_new(f"{path}/{POINTERS}/{after + 1:020d}", version)
    except FileExistsError as error:
        raise ConcurrentCommit(f"{path} has a newer version than the one that was to be replaced") from error


def collect_versions(spark: SparkSession, path: str, keep: int = 2, unfinished_before: datetime | None = None) -> list[str]:
    """Delete versions that the last ``keep`` pointers do not name, and return their names.

    Readers that have planned on an older version keep it for ``keep - 1`` more commits. Data that stood in the folder before it
    had a pointer goes too. What no pointer names may be another writer's work; it goes only if it is older than
    ``unfinished_before``, as do pointers that were never finished.
    """
    folders, named = Folders(spark), pointers(spark, path)
    numbers = sorted((n for n, version in named.items() if version), reverse=True)
    if not numbers:
        return []
    kept = {named[n] for n in numbers[:keep]}
    known = {version for version in named.values() if version}
    gone = []
    for name, _, changed in folders.children(path):
        stale = unfinished_before is not None and datetime.fromtimestamp(changed / 1000, timezone.utc) < unfinished_before
        if name in kept or name == POINTERS:
            continue
        if name in known or not name.startswith(("_", ".")) or (name.startswith(VERSION) and stale):
            folders.delete(f"{path}/{name}")
            gone.append(name)
    # Pointers last: until their version is gone, they say whose it was.
    for number in numbers[keep:]:
        folders.delete(f"{path}/{POINTERS}/{number:020d}")
    if unfinished_before is not None:
        for name, _, changed in folders.children(f"{path}/{POINTERS}"):
            if name.isdigit() and not named.get(int(name)) and datetime.fromtimestamp(changed / 1000, timezone.utc) < unfinished_before:
                folders.delete(f"{path}/{POINTERS}/{name}")
    return sorted(gone)
