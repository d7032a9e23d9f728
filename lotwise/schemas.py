"""Explicit schemas of the extracts. The first, unnamed CSV column is the row number."""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _schema(*fields) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields])


PORTAL_A = _schema(
    ("src_row", LongType),
    ("Bed", DoubleType),
    ("Bath", DoubleType),
    ("floor_area_m2", DoubleType),
    ("Price", StringType),
    ("Address", StringType),
    ("Property_type", StringType),
    ("New_build", StringType),
    ("Page", IntegerType),
)
PORTAL_B = _schema(
    ("src_row", LongType),
    ("beds", DoubleType),
    ("baths", DoubleType),
    ("floor_area", StringType),
    ("Price", StringType),
    ("Address", StringType),
    ("Property_type", StringType),
    ("New_build", StringType),
    ("Page", DoubleType),
)
SOLD = _schema(
    ("src_row", LongType),
    ("Date", DateType),
    ("Address", StringType),
    ("Price", LongType),
    ("Page", IntegerType),
)
CHANGE = _schema(
    ("src_row", LongType),
    ("Date", DateType),
    ("Address", StringType),
    ("New_price", LongType),
    ("Old_price", LongType),
    ("change_eur", LongType),
    ("change_pct", DoubleType),
    ("Page", IntegerType),
)
COUNTY = _schema(("County", StringType), ("Province", StringType))
ALL_LISTINGS = _schema(
    ("Beds", DoubleType),
    ("Baths", DoubleType),
    ("Floor_area", DoubleType),
    ("Price", LongType),
    ("Address", StringType),
    ("Property_type", StringType),
    ("County", StringType),
    ("Province", StringType),
    ("Property_Category", StringType),
)
PAGES = _schema(("page_id", LongType), ("url", StringType), ("html", StringType))
