"""Group counts and the handling of small groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import fixed
from lotwise.operators.lookup import exclude_keys, fold_keys
from lotwise.operators.staging import stage


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per group; a NULL key is a group."""
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def smallest_groups(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The k groups with the fewest rows, ties by key."""
    return group_counts(df, key).orderBy("count", key).limit(k)


def first_rows(df: DataFrame, *order: str, n: int = 20) -> DataFrame:
    """A preview: the first n rows in order. The one way rows should reach the driver."""
    return df.orderBy(*order).limit(n)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, NULL left out."""
    return group_counts(df.dropna(subset=[column]), column).orderBy(F.desc("count"), column)


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values in order: the options of a pick-list."""
    return df.select(column).distinct().orderBy(column)


def small_groups(df: DataFrame, key: str, below: int = fixed.SMALL_GROUP) -> DataFrame:
    return group_counts(df, key).filter(F.col("count") < below)


def fold_small_groups(
    df: DataFrame,
    key: str = "County",
    prefix: str = fixed.DISTRICT_COUNTY,
    below: int = fixed.SMALL_GROUP,
) -> DataFrame:
    """Small groups whose key starts with `prefix` become `prefix`; other small groups are removed."""
    small = stage(small_groups(df, key, below).select(key), "small-groups")
    districts = F.col(key).startswith(prefix)
    folded = fold_keys(df, small.filter(districts), key, prefix)
    return exclude_keys(folded, small.filter(~districts), key)
