"""What the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; 0 without a key."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def whole_text(text: str) -> Column:
    """The text; empty if null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have yet, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name
