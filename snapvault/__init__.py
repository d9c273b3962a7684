"""Snapshots of data lakes with Spark: take, verify, restore, expire."""

from snapvault.lakehouse import Lakehouse
from snapvault.operators.filecopy import files_as_table
from snapvault.operators.restore import RestoreRun, newest_snapshot, restore
from snapvault.operators.retention import RetentionRun, retain, snapshot_catalogue
from snapvault.operators.snapshot import SnapshotRun, Source, snapshot, snapshot_many
from snapvault.operators.tables import profile_tables
from snapvault.operators.verify import verify_content, verify_snapshot
from snapvault.plans.summary import file_type_summary
from snapvault.plans.verify import row_differences
from snapvault.session import clean_scratch, configure
from snapvault.sources.inventory import file_inventory

__all__ = [
    "Lakehouse",
    "RestoreRun",
    "RetentionRun",
    "SnapshotRun",
    "Source",
    "clean_scratch",
    "configure",
    "file_inventory",
    "file_type_summary",
    "files_as_table",
    "newest_snapshot",
    "profile_tables",
    "restore",
    "retain",
    "row_differences",
    "snapshot",
    "snapshot_catalogue",
    "snapshot_many",
    "verify_content",
    "verify_snapshot",
]
