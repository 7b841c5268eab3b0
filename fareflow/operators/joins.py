"""Joins to dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A dimension is broadcast up to this many bytes, counted as rows times the width of a row.
BROADCAST_BYTES = 32 << 20
#: Bytes a row takes besides its fields, and a field without a fixed width until it is measured.
ROW_BYTES = 16


def _width(kind: T.DataType) -> int | None:
    """Bytes of a field in a row, or None if its values differ in size."""
    if isinstance(kind, T.StructType):
        parts = [_width(f.dataType) for f in kind.fields]
        return None if None in parts else sum(parts) + ROW_BYTES
    if isinstance(kind, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)):
        return None
    return 16 if isinstance(kind, T.DecimalType) else 8


def _row_bytes(df: DataFrame) -> tuple[int, list[Column]]:
    """The fixed part of a row's size, and the columns that add their own."""
    fixed, measured = ROW_BYTES, []
    for field in df.schema.fields:
        width = _width(field.dataType)
        fixed += width or 8
        if width is None:
            value = F.col(f"`{field.name}`")
            plain = isinstance(field.dataType, (T.StringType, T.BinaryType))
            # A nested value is no larger than its text by much.
            measured.append(F.octet_length(value) if plain else F.octet_length(F.to_json(F.struct(value))))
    return fixed, measured


def table_bytes(df: DataFrame) -> int:
    """Size of a table in one pass: its rows at their fixed width, and the texts and nested values as they are."""
    fixed, measured = _row_bytes(df)
    row = df.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(m), F.lit(0)) for m in measured]).first()
    return row[0] * fixed + sum(row[1:])


def small_groups(df: DataFrame, by: str, names: list[str], max_bytes: int = BROADCAST_BYTES) -> set[str]:
    """Those of some named parts of a table, told apart by ``by``, that may be broadcast; measured in one pass."""
    fixed, measured = _row_bytes(df)
    size = sum([F.coalesce(F.sum(m), F.lit(0)) for m in measured], F.count(F.lit(1)) * fixed)
    large = df.filter(F.col(by).isin(*names)).groupBy(by).agg(size.alias("_size")).filter(F.col("_size") > max_bytes)
    return set(names) - {r[0] for r in large.collect()}  # at most one row per name


def sized(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The dimension, marked for broadcast if its measured size allows it.

    A dimension made by a groupBy has no useful size estimate, so Catalyst would
    shuffle the large side for it.  Beyond ``max_bytes`` it stays without a hint:
    then it takes a shuffled join, whose hot keys AQE splits.
    """
    return F.broadcast(dim) if table_bytes(dim) <= max_bytes else dim


def lookup_join(
    df: DataFrame, dim: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join ``df`` to a dimension of checked size, see :func:`sized`."""
    return df.join(sized(dim, max_bytes), on, how)
