"""What the operators of this folder share: texts through Arrow, words as bytes, names that cannot clash."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = "__text_bytes"

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Lower-case A-Z and every ASCII byte that is no letter or digit to a space; bytes of other characters stay.
WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def worker_cache() -> dict:
    """Lives as long as the Python worker, whatever way this code came to it."""
    return vars(sys.modules.setdefault("_snapvault_worker", types.ModuleType("_snapvault_worker")))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def plain_words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, with A-Z lower-cased."""
    return text.translate(WORDS).split()


def spaced_words(text: bytes) -> list[bytes]:
    """Runs without space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.split()


def map_texts(
    df: DataFrame,
    text: str,
    make: Callable[[], Callable[[list], Sequence]],
    fields: list[T.StructField],
    keep: list[str] | None = None,
) -> DataFrame:
    """``df``'s columns ``keep`` (all, if None) with new columns computed from whole texts, batch by batch.

    ``make`` is called once a task; what it returns gets a list of UTF-8 texts (None for null) and gives
    one list a field. A new column replaces a kept one of the same name.
    """
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])
    types = [_arrow_type(f.dataType) for f in fields]

    def run(batches):
        work = make()
        for batch in slices(batches):
            found = work(batch.column(len(kept)).to_pylist())
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(found, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    source = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("binary").alias(TEXT))
    return source.mapInArrow(run, schema)


def slices(batches, rows: int = 1000):
    """The batches in parts, so that only so many texts stand in memory as Python values."""
    for batch in batches:
        for at in range(0, max(1, batch.num_rows), rows):
            yield batch.slice(at, rows)


def portions(column: pa.Array, most: int, rows: int = 1000):
    """Start and end of runs of a binary column's rows that hold at most ``most`` bytes together, or one row."""
    sizes = pc.binary_length(column).fill_null(0).to_pylist()
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if i > at and (held + size > most or i - at >= rows):
            yield at, i
            at, held = i, 0
        held += size
    if len(sizes) > at:
        yield at, len(sizes)


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Batches that go to Python hold at most so many bytes, not 10,000 texts of any length. A size that the session sets by itself stays."""
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "64m", "64MB")
    if spark.conf.get(key, default[0]) in default:
        spark.conf.set(key, size)


def hashed_sample(rows: DataFrame, order: Column, n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest ``order``, a 64-bit hash. Rows beyond a cut that keeps a tenth more than
    ``n`` in expectation stay where they are, so what meets does not grow with the number of tasks."""
    share = min(1.0, 1.1 * n / max(1, rows.count()))
    cut = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    return rows.where(order <= F.lit(cut).cast("bigint")).orderBy(order, *rows.columns).limit(n)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def field(name: str, kind: str) -> T.StructField:
    return T.StructField(name, T._parse_datatype_string(kind))
