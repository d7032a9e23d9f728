"""Extracts in, tables out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructField, StructType

from lotwise.functions import fixed

#: The column of a row's place in the files it was read from.
FILE_ORDER = "_at"

# Quotes inside a field are doubled.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_extract(
    spark: SparkSession, path: str | list[str], schema: StructType, multi_line: bool = False, check_header: bool = False
) -> DataFrame:
    """A delimited extract by position under an explicit schema, never inferred.

    `multi_line` reads line breaks inside quotes; a file is then one task.
    `check_header` raises when the header's names are not the schema's, in order.
    """
    options = {**CSV_OPTIONS, "enforceSchema": not check_header, "multiLine": multi_line}
    return null_tokens(spark.read.options(**options).schema(schema).csv(path))


def with_order(df: DataFrame) -> DataFrame:
    """`df`, as just read from files, with its place in them: path, start of the block, place in the block.

    A number of the row alone follows the order in which blocks were planned, largest first.
    """
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias(FILE_ORDER))


def read_lookup(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """A dimension out of delimited files, with the place of its rows, so that the last of repeated keys can win."""
    return with_order(spark.read.options(**CSV_OPTIONS).schema(schema).csv(path))


def read_register(spark: SparkSession, path: str | list[str], schema: StructType, multi_line: bool = False) -> DataFrame:
    """An extract of several files, each newest first: `src_file` tells them apart and orders them by path."""
    raw = spark.read.options(**CSV_OPTIONS, multiLine=multi_line).schema(schema).csv(path)
    return null_tokens(raw.select("*", F.col("_metadata.file_path").alias("src_file")), columns=schema.names)


CORRUPT = "_corrupt"


def read_checked(
    spark: SparkSession, path: str | list[str], schema: StructType, multi_line: bool = False, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The typed rows of an extract, and the rejected ones: src_file, line (as it stands in the file) and reasons.

    A row is rejected if it has another number of fields than the schema, or a field that is neither a
    missing-value text nor of its type; the reasons name them. Both together are all rows; typed ones have passed
    `null_tokens`.
    """
    options = {**CSV_OPTIONS, "multiLine": multi_line, "header": header}
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    raw = spark.read.options(**options, columnNameOfCorruptRecord=CORRUPT, mode="PERMISSIVE").schema(wide).csv(path)
    # one field more than the schema has shows a line that is too long
    texts = StructType([StructField(f"f{i}", StringType()) for i in range(len(schema) + 1)])
    own = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k not in ("header", "multiLine")}
    fields = F.from_csv(F.col(CORRUPT), texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {**own, "mode": "PERMISSIVE"})
    split = raw.withColumn("_fields", F.when(F.col(CORRUPT).isNotNull(), fields))
    bad = [
        F.when(_not_of_type(F.col("_fields")[f"f{i}"], field.dataType), F.lit(field.name))
        for i, field in enumerate(schema.fields)
        if not isinstance(field.dataType, StringType)
    ]
    count = F.when(_commas(F.col(CORRUPT)) != len(schema) - 1, F.lit("fields"))
    reasons = F.filter(F.array(count, *bad), lambda r: r.isNotNull())
    judged = split.withColumn("_reasons", F.when(F.col(CORRUPT).isNull(), F.array().cast("array<string>")).otherwise(reasons))
    # a reader that may leave out columns does not see what is wrong with them, so all are asked for
    judged = judged.where(F.xxhash64(*[f"`{c}`" for c in schema.names]) >= F.lit(-(1 << 63)))
    typed = judged.where(F.size("_reasons") == 0).select(*[f"`{c}`" for c in schema.names])
    rejected = judged.where(F.size("_reasons") > 0).select(
        F.col("_metadata.file_path").alias("src_file"), F.col(CORRUPT).alias("line"), F.array_join("_reasons", ",").alias("reasons")
    )
    return null_tokens(typed), rejected


def _commas(line: Column) -> Column:
    """Separators outside quotes."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit("")))


def _not_of_type(text: Column, kind: DataType) -> Column:
    known = text.isNotNull() & (text != "") & ~text.isin(list(fixed.NULL_TOKENS))
    return known & text.try_cast(kind).isNull()


def null_tokens(
    df: DataFrame,
    tokens: Sequence[str] = tuple(fixed.NULL_TOKENS),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Missing-value texts and NaN to NULL, over all columns unless some are named."""
    cleaned = {}
    for field in df.schema:
        if columns is not None and field.name not in columns:
            continue
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            cleaned[field.name] = F.when(~value.isin(list(tokens)), value)
        elif isinstance(field.dataType, (DoubleType, FloatType)):
            cleaned[field.name] = F.when(~F.isnan(value), value)
    return df.withColumns(cleaned) if cleaned else df


def write_extract(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", sort_by: Sequence[str] = ()
) -> None:
    """Parquet, partitioned for pruning by the columns that queries fix.

    Rows are rebalanced by those columns first, so a partition gets files of a good size, few of them if it is
    small and several if it holds most rows. With `sort_by` rows are dealt by range over those columns within the
    partitions and sorted, so that files and row groups cover narrow ranges and a range query skips the others.
    """
    if sort_by:
        df = df.repartitionByRange(*partition_by, *sort_by).sortWithinPartitions(*partition_by, *sort_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """The partitions that `df` has rows of are replaced as a whole, all others stay."""
    spread = df.hint("rebalance", *partition_by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A written table under its schema, which a table without rows has nowhere else."""
    return spark.read.schema(schema).parquet(path)


def county_lookup(spark: SparkSession) -> DataFrame:
    """The county -> province dimension: 32 fixed rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("County"), F.lit(p).alias("Province"))
          for c, p in fixed.COUNTY_PROVINCE.items()]
    )
    return spark.range(1).select(F.inline(pairs))
