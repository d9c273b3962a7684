"""CSV files whose quoted values hold line breaks, read by many tasks a file.

Where a record starts depends on all quotes before it, so a file is taken in byte ranges: each range counts its quotes, sums
over the ranges before tell whether it begins inside quotes, and then each range gives the records that start in it.
"""

from __future__ import annotations

import csv
import posixpath
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapvault.session import settled
from snapvault.sources.hadoop import Folders
from snapvault.sources.inventory import only_files, walk
from snapvault.sources.spreading import spread_by_size
from snapvault.sources.workers import BATCH_ROWS, BLOCK, resolve

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE_BYTES = 8 << 20
TASK_BYTES = 64 << 20
_COUNTED = pa.schema(
    [
        ("relative_path", pa.string()),
        ("offset", pa.int64()),
        ("size", pa.int64()),
        ("quotes", pa.int64()),
        ("stray", pa.list_(pa.bool_())),
        ("header", pa.list_(pa.string())),
    ]
)
COUNTED = "relative_path string, offset bigint, size bigint, quotes bigint, stray array<boolean>, header array<string>"
QUOTE, COMMA, BREAK, RETURN = b'",\n\r'


def read_quoted_csv(
    spark: SparkSession, path: str, schema: T.StructType | None, range_bytes: int = RANGE_BYTES
) -> DataFrame | None:
    """Rows of the CSV files below ``path``, or None if quotes cannot be told by counting: one stands inside an unquoted value,
    or one is open at the end of a file; or if headers differ, or hold empty or repeated names.

    A quote is written twice inside quotes. Without a ``schema``, types are inferred from all records. A header with other
    names than the schema, and a value that does not fit, are errors. A file without bytes has no rows. Line breaks inside
    quotes stay as they are, also in files whose lines end with carriage return and line feed.
    """
    root = Folders(spark).qualified(path)
    files = only_files(walk(spark, path)).where("size > 0").select("relative_path", F.col("size").alias("whole"))
    starts = F.explode(F.sequence(F.lit(0), F.col("whole") - 1, F.lit(range_bytes).cast("bigint"))).alias("offset")
    ranges = files.select("relative_path", "whole", starts)
    ranges = ranges.select("relative_path", "offset", F.least(F.lit(range_bytes), F.col("whole") - F.col("offset")).alias("size"))
    spread = lambda df: spread_by_size(df, F.concat_ws(":", "relative_path", "offset"), TASK_BYTES)
    counted = settled(spread(ranges).mapInArrow(_counter(root), COUNTED), "csv-ranges")

    before = Window.partitionBy("relative_path").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).cast("int")
    placed = settled(counted.withColumn("inside", inside), "csv-placed")
    files = placed.groupBy("relative_path").agg(
        (F.bool_or(F.get("stray", "inside")) | (F.sum("quotes") % 2 == 1)).alias("unclear")
    )
    headers = [r["header"] for r in placed.where("offset = 0").select("header").distinct().limit(2).collect()]
    if not files.where("unclear").isEmpty() or len(headers) != 1:
        return None
    names = headers[0]
    folded = lambda ns: list(ns) if spark.conf.get("spark.sql.caseSensitive") == "true" else [n.lower() for n in ns]
    if not all(names) or len(set(folded(names))) < len(names):
        return None
    if schema and folded(schema.names) != folded(names):
        raise ValueError(f"header {names} does not conform to the schema {schema.names}")

    records = spread(placed).mapInArrow(_record_reader(root), "record string")
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}
    if schema is None:
        # The one thing that only the reader can do; it takes lines as an RDD.
        found = spark.read.options(inferSchema=True, **options).csv(records.rdd.map(lambda r: r["record"])).schema
        if len(found) not in (0, len(names)):
            raise ValueError(f"records have {len(found)} values under {len(names)} names")
        types = [f.dataType for f in found] or [T.StringType()] * len(names)
        schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types, strict=True)])
    return records.select(F.inline(F.array(F.from_csv("record", schema.toDDL(), options))))


def _counter(root: str):
    def one(fs, base, row):
        path, offset, size = row["relative_path"], row["offset"], row["size"]
        with fs.open_input_file(posixpath.join(base, path)) as source:
            header = None if offset else next((_names(r) for r in _records(source, 0, 1, 0)), [])
            source.seek(max(offset - 1, 0))
            block = source.read(size + 1 + (offset > 0))
        # One byte before and one behind the range; a file starts and ends like a line.
        data = np.frombuffer((b"" if offset else b"\n") + block + b"\n", dtype=np.uint8)[: size + 2]
        here = data[1:-1]
        quoted = here == QUOTE
        places = np.flatnonzero(quoted)
        prior, after = data[places], data[places + 2]
        may_open = np.isin(prior, [COMMA, BREAK, QUOTE])
        may_close = np.isin(after, [COMMA, BREAK, RETURN, QUOTE])
        lone = (here == RETURN) & (data[2:] != BREAK)
        within = np.logical_xor.accumulate(quoted) if size else quoted
        # For a range that begins outside quotes, and for one that begins inside.
        stray = [
            bool(
                not may_open[odd::2].all() or not may_close[1 - odd :: 2].all() or (lone & (within == bool(odd))).any()
            )
            for odd in (0, 1)
        ]
        return path, offset, size, len(places), stray, header

    def run(batches):
        fs, base = resolve(root)
        for batch in batches:
            rows = [one(fs, base, row) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _COUNTED)] if rows else [pa.array([], f.type) for f in _COUNTED],
                schema=_COUNTED,
            )

    return run


def _names(record: bytes) -> list[str]:
    return next(csv.reader([record.decode("utf-8-sig", "replace")]), [])


def _records(source, offset: int, size: int, inside: int):
    """Records that start in the range, whole, without their line break; ``inside`` says whether it begins inside quotes."""
    source.seek(max(offset - 1, 0))
    started = offset == 0 or (source.read(1) == b"\n" and not inside)
    at, tail = offset, []
    while True:
        block = source.read(BLOCK)
        if not block:
            if started and any(tail):
                yield b"".join(tail).removesuffix(b"\r")
            return
        data = np.frombuffer(block, dtype=np.uint8)
        within = np.logical_xor.accumulate(data == QUOTE) ^ bool(inside)
        inside, last = bool(within[-1]), 0
        for end in np.flatnonzero((data == BREAK) & ~within).tolist():
            if started:
                tail.append(block[last:end])
                yield b"".join(tail).removesuffix(b"\r")
                tail = []
            started, last = True, end + 1
            if at + last >= offset + size:
                return
        if started:
            tail.append(block[last:])
        at += len(block)


def _record_reader(root: str):
    def records(batches):
        fs, base = resolve(root)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(posixpath.join(base, row["relative_path"])) as source:
                    found = _records(source, row["offset"], row["size"], row["inside"])
                    if not row["offset"]:
                        next(found, None)  # the header
                    yield from (r for r in found if r.strip())

    def run(batches):
        held, bytes_held = [], 0
        for record in records(batches):
            held.append(record.decode("utf-8", "replace"))
            bytes_held += len(record)
            if bytes_held >= BLOCK or len(held) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["record"])
                held, bytes_held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["record"])

    return run
