"""Registered queries of files and tables as they land: rejects, several files, layout, checks and profiles."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from lotwise import schemas
from lotwise.operators import dedup, explore, lookup, profile
from lotwise.operators.staging import scratch_path, stage
from lotwise.plans import driver_queries as driver
from lotwise.plans import pipelines
from lotwise.plans import renditions as r
from lotwise.sources import files

QUERIES: dict[str, driver.Query] = {}


def register(query: driver.Query) -> driver.Query:
    QUERIES[query.__name__] = query
    return query


@register
def extract_rejects(spark, sf):
    """The damaged lines of a written register, with what is wrong with them."""
    key = F.col("c_custkey")
    fields = [
        r.as_text(key),
        F.when(key % 10 == 7, F.lit("soon")).otherwise(F.lit("2022-01-05")),
        F.concat(F.lit('"'), r.as_text(key), F.lit(' Main Street, ""Cork"""')),
        F.when(key % 10 == 3, F.concat(F.lit("x"), r.as_text(key))).when(key % 10 == 1, F.lit("nan")).otherwise(r.as_text(key * 1000)),
        F.when(key % 20 == 13, F.lit("first")).otherwise(r.as_text(key % 20)),
    ]
    line = F.when(key % 10 == 5, F.concat_ws(",", *fields[:3])).when(key % 20 == 9, F.concat_ws(",", *fields, F.lit("more")))
    path = scratch_path(spark, "damaged-extract")
    r.table(spark, sf, "customer").select(line.otherwise(F.concat_ws(",", *fields)).alias("value")).write.text(path)
    return files.read_checked(spark, path, schemas.SOLD, header=False)[1].drop("src_file")


@register
def clean_sold_files(spark, sf):
    """A register of two files, the newer one first, whose row numbers are the same."""
    path = scratch_path(spark, "sold-files")
    whole = r.sold_raw(spark, sf)
    for folder, odd in (("1-new", 1), ("2-old", 0)):
        part = whole.where(F.col("src_row") % 2 == odd).withColumn("src_row", F.floor(F.col("src_row") / 2))
        files.write_extract(part, f"{path}/{folder}")
    read = files.read_register(spark, [f"{path}/1-new", f"{path}/2-old"], schemas.SOLD)
    # the folder is the file of a register written in parts
    return pipelines.clean_sold(read.withColumn("src_file", F.regexp_extract("src_file", "/([12]-[a-z]+)/", 1)))


@register
def partition_replace(spark, sf):
    """One partition of a written table is replaced, the others stay."""
    customers = r.table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "partitions")
    files.write_table(customers, path, ["c_mktsegment"])
    corrected = customers.where("c_mktsegment = 'BUILDING' AND c_custkey % 2 = 0").withColumn("c_acctbal", -F.col("c_acctbal"))
    files.replace_partitions(corrected, path, ["c_mktsegment"])
    return files.read_table(spark, path, customers.schema)


@register
def county_by_table(spark, sf):
    """Addresses whose county is looked for in a table of names."""
    name = F.concat(F.lit("Nation_"), r.as_text(F.col("c_custkey") % 30))
    address = r.cases(
        F.col("c_custkey"),
        [
            F.concat(F.lit("1 Road, Co. "), name), F.concat(F.lit("1 Road, "), name, F.lit(" 7")), F.concat(F.lit("1 Road, "), name, F.lit(".")),
            F.concat(F.lit("1 Road, the "), F.upper(name), F.lit(" way")), F.lit("1 Road, Co.Elsewhere"), F.lit("1 Road,"),
            F.lit(None).cast("string"),
        ],
    )
    customers = r.table(spark, sf, "customer").select("c_custkey", address.alias("Address"))
    names = r.table(spark, sf, "nation").select(F.initcap("n_name").alias("name"))
    return lookup.add_county(customers, names, ["c_custkey"])


@register
def province_from_file(spark, sf):
    """A lookup out of two files; of a county in both the later file's province counts."""
    nations = r.table(spark, sf, "nation").join(r.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    dim = nations.select(F.col("n_name").alias("County"), F.col("r_name").alias("Province"))
    path = scratch_path(spark, "lookup")
    files.write_extract(dim.withColumn("Province", F.lit("outdated")), f"{path}/1")
    files.write_extract(dim.where("Province <> 'ASIA'"), f"{path}/2")
    read = files.read_lookup(spark, [f"{path}/1", f"{path}/2"], schemas.COUNTY)
    customers = r.table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey") + F.col("c_custkey") % 3).alias("County"))
    return lookup.add_province(customers, read)


@register
def cleaning_counts(spark, sf):
    """How many rows each cleaning rule drops, counted while the selected ones are written."""
    counts = Observation("cleaning")
    pipelines.counted(r.portal_a_raw(spark, sf), counts).write.parquet(scratch_path(spark, "counted"))
    return spark.createDataFrame(sorted(counts.get.items()), "rule string, n bigint")


@register
def rule_violations(spark, sf):
    """Rules of the change register over rows with injected faults."""
    key = F.col("src_row")
    rows = r.change_raw(spark, sf).withColumns(
        {
            "Old_price": F.when(key % 10 == 0, F.lit(0)).otherwise(F.col("Old_price")),
            "change_eur": F.when(key % 7 == 0, -F.col("change_eur")).otherwise(F.col("change_eur")),
            "change_pct": F.when(key % 9 == 0, F.col("change_pct") + 1).otherwise(F.col("change_pct")),
        }
    )
    share = F.round(F.try_divide((F.col("New_price") - F.col("Old_price")) * 100, F.col("Old_price")), 2)
    rules = {
        "address": F.col("Address").isNotNull(),
        "old price": F.col("Old_price") > 0,
        "change": F.col("New_price") - F.col("Old_price") == F.col("change_eur"),
        "percentage": F.abs(share - F.col("change_pct")) < 0.015,
    }
    return profile.violations(rows, rules, ["src_row"], F.col("Old_price"))


@register
def distinct_sketches(spark, sf):
    """Whether stored sketches per event type, merged, are within their stated error (three deviations of 1.6 %)."""
    events = r.table(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    columns = ["event_id", "user_id", "props"]
    stored = stage(profile.distinct_sketches(events, columns, F.col("event_type")), "sketches")
    exact = profile.distinct_counts(events.select(*columns))
    merged = profile.merged_counts(stored).join(exact, "column")
    off = F.abs(F.col("estimate") - F.col("n_unique"))
    return merged.select("column", "n_unique", (off <= 0.05 * F.col("n_unique") + 1).alias("within"))


@register
def profile_events(spark, sf):
    """Columns, distinct values, missing ones and frequent ones from one scan."""
    found = profile.value_profile(driver.null_tokens(spark, sf))
    return found.withColumn("top", F.when(F.col("dtype") != "double", F.col("top")))


@register
def union_widened(spark, sf):
    """int with double, bigint with decimal, text with text: the common types lose nothing."""
    parts = r.table(spark, sf, "part").select(
        F.col("p_size").cast("int").alias("size"), F.col("p_partkey").cast("bigint").alias("amount"), F.col("p_name").alias("name")
    )
    lines = r.table(spark, sf, "lineitem").where("l_linenumber = 1").select(
        F.col("l_quantity").cast("double").alias("size"), F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.col("l_returnflag").alias("name"),
    )
    return dedup.union_widened(parts, lines).withColumn("amount", F.col("amount").cast("string"))


@register
def explore_clustered(spark, sf):
    """The explorer over listings that are dealt by price and sorted."""
    path = scratch_path(spark, "clustered")
    listings = driver._lineitem_listings(spark, sf)
    files.write_table(listings, path, ["County"], sort_by=["Price"])
    explore.register(files.read_table(spark, path, listings.schema), "lineitem_clustered")
    return explore.explore(spark, {"Price": (20000, 30000), "Baths": (5, 40)}, county="N", view="lineitem_clustered")
