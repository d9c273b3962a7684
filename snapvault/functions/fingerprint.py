"""Order-free checksum of a whole table in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _parts(value: Column, dtype: T.DataType) -> list[Column]:
    """Columns to feed to ``xxhash64`` so that different values give different input.

    ``xxhash64`` skips nulls and does not see where an array ends, so null flags and sizes go in
    as well. Map entries are hashed one by one and sorted, since their order means nothing.
    """
    if isinstance(dtype, T.StructType):
        inner = [p for f in dtype.fields for p in _parts(value.getField(f.name), f.dataType)]
        return [value.isNull(), *inner]
    if isinstance(dtype, T.ArrayType):
        hashes = F.transform(value, lambda x: F.xxhash64(*_parts(x, dtype.elementType)))
        return [value.isNull(), F.array_size(value), hashes]
    if isinstance(dtype, T.MapType):
        entry = F.transform(
            F.map_entries(value),
            lambda e: F.xxhash64(
                *_parts(e.getField("key"), dtype.keyType), *_parts(e.getField("value"), dtype.valueType)
            ),
        )
        return [value.isNull(), F.array_size(entry), F.array_sort(entry)]
    if isinstance(dtype, T.VariantType):
        return [value.isNull(), F.to_json(value)]
    if isinstance(dtype, T.StringType) and not dtype.isUTF8BinaryCollation():
        value = F.collate(value, "UTF8_BINARY")  # values that only a collation holds equal differ
    return [value.isNull(), value]


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_hash(schema: T.StructType) -> Column:
    """64-bit hash of a row; columns are taken in name order."""
    parts = [F.lit(0)]
    for field in sorted(schema.fields, key=lambda f: f.name):
        parts += _parts(named(field.name), field.dataType)
    return F.xxhash64(*parts)


def checksum_aggregates(hashed: Column) -> list[Column]:
    """``row_count``, ``hash_sum`` and ``hash_xor`` over a column that holds ``row_hash``.

    The sum is built from three bit ranges in plain longs, which stays much cheaper per row than adding 38-digit
    decimals. They are safe to 2^41 rows; beyond, the checksum is null, so that nothing is taken for equal.
    """
    safe = F.count(F.lit(1)) < F.lit(1 << 41)
    mask = F.lit((1 << 22) - 1)
    low = F.sum(hashed.bitwiseAND(mask))
    mid = F.sum(F.shiftright(hashed, 22).bitwiseAND(mask))
    high = F.sum(F.shiftright(hashed, 44))
    wide = lambda c, bits: c.cast("decimal(20,0)") * F.lit(1 << bits).cast("decimal(15,0)")
    total = (wide(high, 44) + wide(mid, 22) + wide(low, 0)).cast("decimal(38,0)")
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.when(safe, F.coalesce(total, F.lit(0).cast("decimal(38,0)"))).alias("hash_sum"),
        F.coalesce(F.bit_xor(hashed), F.lit(0).cast("bigint")).alias("hash_xor"),
    ]


def checksum(df: DataFrame) -> DataFrame:
    """One row: ``row_count``, ``hash_sum``, ``hash_xor``."""
    return df.select(row_hash(df.schema).alias("h")).agg(*checksum_aggregates(F.col("h")))
