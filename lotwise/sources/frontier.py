"""The pages to fetch, one URL per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import fixed


def offset_url(base: str, page: Column, page_size: int = fixed.PAGE_SIZE) -> Column:
    """Pages addressed by the position of their first record."""
    return F.concat(
        F.lit(f"{base}?from="), (page * page_size).cast("string"), F.lit(f"&pageSize={page_size}")
    )


def numbered_url(base: str, page: Column) -> Column:
    """Pages addressed by their number at the end of the URL."""
    return F.concat(F.lit(base), page.cast("string"))


def landed_frontier(pages: DataFrame, base: str, page_size: int | None = None) -> DataFrame:
    """page_id and url of the pages that have landed, once each, to fetch them again."""
    page = F.col("page_id")
    url = numbered_url(base, page) if page_size is None else offset_url(base, page, page_size)
    return pages.select("page_id").dropna().distinct().withColumn("url", url)


def missing_pages(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """The rows of a plan (page_id, url) whose page has not landed."""
    return plan.join(pages.select("page_id").distinct(), "page_id", "left_anti")


def page_frontier(
    spark: SparkSession, base: str, start: int, end: int, page_size: int | None = None
) -> DataFrame:
    """page_id and url for the pages from `start` up to, not including, `end`."""
    pages = spark.range(start, end).withColumnRenamed("id", "page_id")
    page = F.col("page_id")
    url = numbered_url(base, page) if page_size is None else offset_url(base, page, page_size)
    return pages.withColumn("url", url)
