"""Building ZIP archives of the old layout from table rows, for queries and tests.

This engine only reads such archives; these helpers make some to read.
"""

from __future__ import annotations

import io
import json
import sys
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ARCHIVES = "archive string, zip_binary binary"
_ARCHIVES = pa.schema([("archive", pa.string()), ("zip_binary", pa.binary())])


def zip_bytes(entries: dict[str, bytes]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in entries.items():
            archive.writestr(name, content)
    return out.getvalue()


def _row(name: str, content: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], schema=_ARCHIVES)


def file_archives(files: DataFrame) -> DataFrame:
    """One archive per row of ``archive``, ``relative_path``, ``content``, ``backup_type``."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                about = {"backup_type": row["backup_type"], "files_backed_up": 1, "tables_backed_up": 0}
                entries = {
                    f"files/{row['relative_path']}": row["content"],
                    "files/empty/": b"",
                    "_backup_info/metadata.json": json.dumps(about).encode(),
                }
                yield _row(row["archive"], zip_bytes(entries))

    return files.select("archive", "relative_path", "content", "backup_type").mapInArrow(run, ARCHIVES)


def table_archives(df: DataFrame, table: str, fmt: str = "parquet") -> DataFrame:
    """A table as a set of archives, one per Arrow batch, each with a part of it."""
    schema_json = df.schema.json()

    def run(batches):
        import uuid

        import pyarrow.csv as pacsv

        for batch in batches:
            out = io.BytesIO()
            part = pa.Table.from_batches([batch])
            pq.write_table(part, out) if fmt == "parquet" else pacsv.write_csv(part, out)
            entries = {f"tables/{table}/{table}.{fmt}": out.getvalue(), f"tables/{table}/schema.json": schema_json.encode()}
            yield _row(f"{table}-{uuid.uuid4().hex}.zip", zip_bytes(entries))

    return df.mapInArrow(run, ARCHIVES)
