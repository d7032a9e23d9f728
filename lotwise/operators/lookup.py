"""Enrichment from a dimension, exclusion and folding by a key table.

No join carries a broadcast hint unless the side is fixed in size: files and
staged tables have known sizes, so the planner's own threshold decides, and
beyond it a sort-merge join with skew splitting takes over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.cleaning import county_of_tokens, county_tokens, lookup_key
from lotwise.sources.files import FILE_ORDER, county_lookup


def last_wins(dim: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key; of repeated keys the last in `order`."""
    return dim.groupBy(key).agg(F.max_by(value, order).alias(value))


def lookup_left(df: DataFrame, dim: DataFrame, key: Column, dim_key: str, value: str) -> DataFrame:
    """`df` with `value` from `dim`, NULL without a match. `dim_key` must be unique in `dim`."""
    side = dim.select(F.col(dim_key).alias("_lookup"), F.col(value))
    return df.join(side, key == F.col("_lookup"), "left").drop("_lookup")


def add_province(df: DataFrame, dim: DataFrame | None = None, county: str = "County") -> DataFrame:
    """Province of each county, numbered districts by their county. Of a county given twice the last row counts."""
    if dim is None:
        dim = F.broadcast(county_lookup(df.sparkSession))
    else:
        if FILE_ORDER not in dim.columns:
            dim = dim.withColumn(FILE_ORDER, F.monotonically_increasing_id())
        dim = last_wins(dim, "County", "Province", FILE_ORDER)
    return lookup_left(df, dim, lookup_key(F.col(county)), "County", "Province")


def add_county(
    df: DataFrame, vocabulary: DataFrame, keys: Sequence[str], address: str = "Address", position: int = -1, into: str = "County"
) -> DataFrame:
    """The county that an address names, out of a vocabulary table (its first column) of any size.

    The same rules as `cleaning.county_from_address`, whose vocabulary is part of the plan: here the words of the
    address are joined with the table, each also without its last character, and the first that is known decides.
    `keys` tell the rows of `df` apart. Only words and keys are shuffled beside the table, and the planner
    broadcasts the table while its size allows.
    """
    rows = df.withColumn("_words", county_tokens(F.col(address), position))
    words = rows.select(*keys, F.posexplode("_words").alias("_at", "_word")).withColumn("_word", F.initcap("_word"))
    spelled = F.array(F.col("_word"), F.substring(F.col("_word"), F.lit(1), F.length("_word") - 1))
    asked = words.select(*keys, (F.col("_at") + 1).alias("_at"), F.explode(spelled).alias("_word"))
    known = vocabulary.select(F.col(vocabulary.columns[0]).alias("_word")).dropna().distinct()
    first = asked.join(known, "_word", "left_semi").groupBy(*keys).agg(F.min("_at").alias("_at"))
    found = rows.join(first, list(keys), "left")
    return found.withColumn(into, county_of_tokens(F.col("_words"), F.col("_at"))).drop("_words", "_at")


def exclude_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose `column` is not among `keys`. NULLs go too, once there are any keys.

    `keys` is read twice: stage it when it is costly to compute.
    """
    side = keys.select(F.col(column).alias("_excluded")).dropna()
    kept = df.join(side, F.col(column) == F.col("_excluded"), "left_anti")
    n_keys = side.limit(1).agg(F.count("*")).scalar()
    return kept.where(F.col(column).isNotNull() | (n_keys == 0))


def fold_keys(df: DataFrame, keys: DataFrame, column: str, bucket: str) -> DataFrame:
    """`column` replaced by `bucket` where its value is among `keys`."""
    side = keys.select(F.col(column).alias("_folded")).dropna().distinct()
    return (
        df.join(side, F.col(column) == F.col("_folded"), "left")
        .withColumn(column, F.when(F.col("_folded").isNotNull(), bucket).otherwise(F.col(column)))
        .drop("_folded")
    )
