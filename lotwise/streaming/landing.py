"""Row-local pipelines over landing folders, as files arrive.

Cleaning a portal extract and extracting pages need no state, so the batch
functions take a streaming DataFrame as they are. Registers keep the first row
per address over all files and stay batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lotwise import schemas
from lotwise.sources.files import CSV_OPTIONS, null_tokens


def extract_stream(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1000
) -> DataFrame:
    reader = spark.readStream.options(**CSV_OPTIONS).schema(schema)
    return null_tokens(reader.option("maxFilesPerTrigger", files_per_batch).csv(folder))


def page_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(schemas.PAGES)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def write_stream(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, taking all files that are there and then stopping."""
    writer = rows.writeStream.outputMode("append").format("parquet")
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(folder)
    )
