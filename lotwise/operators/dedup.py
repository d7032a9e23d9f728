"""Union of sources and removal of repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType,
)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in `order`. NULL keys are equal to each other.

    The rank filter runs before the shuffle too, so each task passes on at
    most one row per key, however many rows a key has.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def keep_any(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row per key (per whole row without keys), whichever comes first."""
    return df.dropDuplicates(list(keys)) if keys else df.dropDuplicates()


def keep_first_twice(
    df: DataFrame, first_keys: Sequence[str], second_keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Repeats within a source by one key, then repeats across sources by another."""
    return keep_first(keep_first(df, first_keys, order), second_keys, order)


def same_columns(left: DataFrame, right: DataFrame) -> bool:
    return left.columns == right.columns


def union_aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both. Columns must agree in name and order; numbers widen."""
    if not same_columns(left, right):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    return left.union(right)


_WHOLE = [ByteType, ShortType, IntegerType, LongType]
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def widened(left: DataType, right: DataType) -> DataType | None:
    """The narrowest type that holds every value of both, NULL if there is none.

    Whole numbers widen to the wider one, to a decimal with room for their digits, and to double up to 32 bits (a
    bigint would lose digits there, as would a decimal).
    """
    if left == right:
        return left
    for a, b in ((left, right), (right, left)):
        kind = type(a)
        if kind in _DIGITS and type(b) in _DIGITS:
            return max(a, b, key=lambda t: _WHOLE.index(type(t)))
        if kind in _DIGITS and isinstance(b, DecimalType):
            digits = max(_DIGITS[kind], b.precision - b.scale) + b.scale
            return DecimalType(digits, b.scale) if digits <= 38 else None
        if kind in _DIGITS and _DIGITS[kind] <= 10 and isinstance(b, DoubleType):
            return b
        if kind in _DIGITS and _DIGITS[kind] <= 5 and isinstance(b, FloatType):
            return b
        if isinstance(a, FloatType) and isinstance(b, DoubleType):
            return b
    if isinstance(left, DecimalType) and isinstance(right, DecimalType):
        scale = max(left.scale, right.scale)
        digits = max(left.precision - left.scale, right.precision - right.scale) + scale
        return DecimalType(digits, scale) if digits <= 38 else None
    return None


def union_widened(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both. Names and order must agree, and each pair of types must have a common one that loses nothing.

    Disagreement raises before any job runs, and names every column concerned.
    """
    if not same_columns(left, right):
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    types = [widened(a.dataType, b.dataType) for a, b in zip(left.schema, right.schema)]
    lossy = [
        f"{a.name}: {a.dataType.simpleString()} and {b.dataType.simpleString()}"
        for a, b, t in zip(left.schema, right.schema, types) if t is None
    ]
    if lossy:
        raise ValueError(f"no common type without loss for {'; '.join(lossy)}")

    def cast(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in zip(df.columns, types)])

    return cast(left).union(cast(right))


def append_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name, absent ones NULL."""
    return left.unionByName(right, allowMissingColumns=True)
