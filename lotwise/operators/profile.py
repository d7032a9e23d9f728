"""Column profiles: one row per column, computed in one pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lotwise.operators.quantiles import describe_long


def _per_column(df: DataFrame, stats: dict[str, dict[str, Column]]) -> DataFrame:
    # stats: column -> statistic name -> aggregate, the same names for all columns.
    names = list(next(iter(stats.values())))
    one_row = df.agg(
        *[
            F.struct(F.lit(c).alias("column"), *[per[n].alias(n) for n in names]).alias(f"_{i}")
            for i, (c, per) in enumerate(stats.items())
        ]
    )
    return one_row.select(F.inline(F.array(*one_row.columns)))


def column_report(df: DataFrame) -> DataFrame:
    """Type and number of values of each column."""
    return _per_column(
        df,
        {
            c: {"dtype": F.lit(t), "non_null": F.count(F.col(c))}
            for c, t in df.dtypes
        },
    )


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct values of each column, NULL left out."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return _per_column(df, {c: {"n_unique": count(F.col(c))} for c in df.columns})


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, max of each column as text columns, text columns included."""
    stats = {}
    for c, t in df.select(*(columns or df.columns)).dtypes:
        numeric = isinstance(df.schema[c].dataType, NumericType)
        value = F.col(c)
        stats[c] = {
            "count": F.count(value),
            "mean": F.avg(value) if numeric else F.lit(None).cast("double"),
            "stddev": F.stddev_samp(value) if numeric else F.lit(None).cast("double"),
            "min": F.min(value).cast("string"),
            "max": F.max(value).cast("string"),
        }
    return _per_column(df, stats)


def describe_numbers(df: DataFrame) -> DataFrame:
    """Quartile description of the numeric columns, truncated to whole numbers."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    table = describe_long(df, [], numeric)
    return table.select(
        F.col("measure").alias("column"),
        *[F.col(f"`{c}`").cast("bigint").alias(c) for c in table.columns if c != "measure"],
    )


def violations(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str], value: Column) -> DataFrame:
    """keys, rule, value (of the row, as text): one row per row and rule it breaks, all rules in one pass.

    A rule is a condition that must hold; one that is NULL has nothing to judge and is not broken.
    """
    broken = [F.when(~holds, F.lit(name)) for name, holds in rules.items()]
    names = F.filter(F.array(*broken), lambda name: name.isNotNull())
    return df.select(*keys, F.explode(names).alias("rule"), value.cast("string").alias("value"))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Column, bits: int = 12) -> DataFrame:
    """part, column, sketch: a mergeable sketch of the distinct values of each column in each part, to be stored."""
    parts = df.groupBy(by.alias("part")).agg(
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias(c) for c in columns]
    )
    return parts.unpivot(["part"], list(columns), "column", "sketch")


def merged_counts(sketches: DataFrame) -> DataFrame:
    """column, estimate: the distinct values of each column over the union of its stored sketches."""
    merged = sketches.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column", F.hll_sketch_estimate("sketch").alias("estimate"))


def value_profile(df: DataFrame, frequent: int = 3) -> DataFrame:
    """column, dtype, non_null, n_unique, top (the most frequent values and their numbers): A3, A4 and A7 from one scan.

    Each task counts its (column, value) pairs; a value is shuffled once per task that holds it, beside the number
    of its column, so a column with few values and many rows moves next to nothing. Values pass as text.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(df.columns)])
    counted = df.select(F.inline(pairs)).groupBy("at", "value").agg(F.count("*").alias("n"))
    # a filter on the values would go below their counts, and the table be read twice
    first = Window.partitionBy("at").orderBy(F.col("value").isNull(), F.col("n").desc(), "value")
    # of a column's values the first few leave each task
    top = counted.withColumn("rank", F.row_number().over(first)).where((F.col("rank") <= frequent) & F.col("value").isNotNull())
    tops = top.groupBy("at").agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("top"))
    sums = counted.groupBy("at").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
        F.count("value").alias("n_unique"),
    )
    names = df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)], "at int, column string, dtype string")
    text = F.array_join(F.transform("top", lambda r: F.concat_ws(":", r["value"], r["n"])), ",")
    return names.join(sums, "at", "left").join(tops, "at", "left").select(
        "column", "dtype", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("non_null", "n_unique")],
        F.coalesce(text, F.lit("")).alias("top"),
    )


def orphans(df: DataFrame, keys: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Rows with a payload but none of the key columns: values that lost their record."""
    no_key = F.lit(True)
    for k in keys:
        no_key = no_key & F.col(k).isNull()
    return df.filter(no_key & F.coalesce(*[F.col(p).cast("string") for p in payload]).isNotNull())


def change_consistent(
    new: str = "New_price", old: str = "Old_price", euro: str = "change_eur", pct: str = "change_pct"
) -> Column:
    """New minus old is the change in euro, and the percentage is that change's of old, to a hundredth.

    NULL where the old price is 0, as there is no percentage then.
    """
    change = F.col(euro)
    share = F.round(F.try_divide(change * 100, F.col(old)), 2)
    return (F.col(new) - F.col(old) == change) & (F.abs(share - F.col(pct)) < 0.015)
