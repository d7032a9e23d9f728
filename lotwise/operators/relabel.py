"""Renames, whole-value relabels and conditional assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions import fixed


def rename_leading(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename the first columns by position."""
    return df.withColumnsRenamed(dict(zip(df.columns, names)))


def relabel(df: DataFrame, column: str, labels: dict[str, str]) -> DataFrame:
    """Whole values replaced by their label, others kept."""
    return df.replace(labels, subset=[column])


def add_category(
    df: DataFrame, source: str = "Property_type", target: str = "Property_Category"
) -> DataFrame:
    """One spelling per type, then its category in a copy of the column."""
    spelled = relabel(df, source, fixed.TYPE_RELABEL)
    return relabel(spelled.withColumn(target, F.col(source)), target, fixed.CATEGORY_RELABEL)


def assign_where(df: DataFrame, condition: Column, values: dict[str, object]) -> DataFrame:
    """Columns set to a value where the condition holds, kept elsewhere."""
    return df.withColumns(
        {c: F.when(condition, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()}
    )


def with_required(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with `value` as `name`, without the rows where it is NULL.

    A filter on the new column would be pushed below the projection and compute
    a costly expression a second time; exploding zero or one values does not.
    """
    found = F.filter(F.array(value), lambda v: v.isNotNull())
    columns = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*columns, F.explode(found).alias(name))
