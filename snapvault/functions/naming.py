"""Snapshot names: building them, and reading the time and the source back out of them."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker, the form of the time, and further below the two pairs of words that names drop.
MARKER = "_backup_"
STAMP = r"\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}"
STAMP_LENGTH = len("yyyy-MM-dd_HH-mm-ss")


def wall_clock(at: datetime) -> datetime:
    """The UTC wall clock of a time; one without a zone is UTC already."""
    return at.astimezone(timezone.utc).replace(tzinfo=None) if at.tzinfo else at


def wall_clock_lit(at: datetime) -> Column:
    return F.lit(wall_clock(at).isoformat(sep=" ")).cast("timestamp_ntz")


def _short(name: Column, prefix: str, suffix: str) -> Column:
    # The two words are removed wherever they stand, not only at the ends.
    without_prefix = F.replace(F.lower(name), F.lit(prefix), F.lit(""))
    return F.replace(without_prefix, F.lit(suffix), F.lit(""))


def stamp(at: Column) -> Column:
    """``yyyy-MM-dd_HH-mm-ss``; for a TIMESTAMP_NTZ whatever the time zone of the session."""
    return F.translate(F.substring(at.cast("string"), 1, STAMP_LENGTH), " :", "_-")


def snapshot_name(lakehouse: Column, workspace: Column, at: Column) -> Column:
    """``<lakehouse>_<workspace>_backup_<time>`` in lower case, without naming-convention words."""
    return F.concat(
        _short(lakehouse, "lh_", "_lakehouse"),
        F.lit("_"),
        _short(workspace, "wsp_", "_workspace"),
        F.lit(MARKER),
        stamp(at),
    )


def snapshot_time(name: Column, strict: bool = False) -> Column:
    """The time at the end of a name as TIMESTAMP_NTZ; null without one or when it is no real date.

    ``strict`` also asks for the ``_backup_`` marker in front of the time.
    """
    tail = F.substring(name, -STAMP_LENGTH, STAMP_LENGTH)
    digits = lambda start: F.substring(tail, start, 2)
    iso = F.concat(F.substring(tail, 1, 10), F.lit(" "), digits(12), F.lit(":"), digits(15), F.lit(":"), digits(18))
    lead = MARKER if strict else ""
    end = F.substring(name, -len(lead) - STAMP_LENGTH, len(lead) + STAMP_LENGTH)
    valid = end.rlike(f"^{lead}{STAMP}$") & ~tail.startswith("0000")
    return F.when(valid, iso.try_cast("timestamp_ntz"))


def snapshot_source(name: Column) -> Column:
    """What stands before the first ``_backup_``."""
    return F.substring_index(name, MARKER, 1)
