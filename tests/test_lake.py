"""Files and tables as they land: rejects, order across files, layout, checks, sketches, one-scan profiles."""

import datetime
import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType

from lotwise import schemas
from lotwise.functions import cleaning
from lotwise.operators import dedup, lookup, profile
from lotwise.plans import driver_queries, lake_queries, pipelines, renditions
from lotwise.sources import files, frontier


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_rejected_and_typed_rows_are_all_rows(spark, tmp_path):
    path = tmp_path / "sold.csv"
    path.write_text(
        ",Date,Address,Price,Page\n"
        '0,2022-01-05," ""The House"", 1 Road, Cork",100,1\n'
        "1,soon,2 Road,1x,1\n"
        "2,2022-01-05,3 Road\n"
        "3,2022-01-05,4 Road,nan,1\n"
        "4,2022-01-05,5 Road,500,1,more\n"
        "5,,,,\n"
        '6,2022-01-05,"7 Road, ""Cork"", x",x,y\n',
        encoding="utf-8",
    )
    typed, rejected = files.read_checked(spark, str(path), schemas.SOLD)
    assert sorted(r["src_row"] for r in typed.collect()) == [0, 3, 5]
    assert typed.orderBy("src_row").first() == (0, datetime.date(2022, 1, 5), ' "The House", 1 Road, Cork', 100, 1)
    # whatever is asked of the rows, the same ones are typed and rejected
    assert [typed.select(c).count() for c in typed.columns] == [3] * 5 and typed.count() == 3
    reasons = {r["line"][0]: r["reasons"] for r in rejected.collect()}
    assert {k: set(v.split(",")) for k, v in reasons.items()} == {"1": {"Date", "Price"}, "2": {"fields"}, "4": {"fields"}, "6": {"Price", "Page"}}
    assert rejected.count() == 4 and rejected.where("src_file LIKE '%sold.csv'").count() == 4
    (tmp_path / "none.csv").write_text(",Date,Address,Price,Page\n")
    assert [df.count() for df in files.read_checked(spark, str(tmp_path / "none.csv"), schemas.SOLD)] == [0, 0]


def test_survivor_does_not_hang_on_the_order_of_rows(spark):
    day = datetime.date(2022, 1, 1)
    rows = [("a", 7, day, "1 Road, Cork", 3, 1), ("a", 7, day, "1 Road, Cork", 2, 1), ("b", 1, day, "1 Road, Cork", 1, 1)]
    schema = "src_file string, src_row bigint, Date date, Address string, Price bigint, Page int"
    for order in (rows, rows[::-1]):
        kept = pipelines.clean_sold(spark.createDataFrame(order, schema)).collect()
        assert [r["Price"] for r in kept] == [2] and "src_file" not in kept[0].asDict()
        one_file = spark.createDataFrame([r[1:] for r in order[:2] if r[0] == "a"], schema.split(", ", 1)[1])
        assert len(pipelines.clean_sold(one_file).collect()) == 1


def test_batch_keeps_line_breaks_and_reads_tables_without_rows(spark, tmp_path):
    a, b, out = (str(tmp_path / n) for n in ("a", "b", "out"))
    row = (0, 3.0, 2.0, 90.0, "250000", "1 Road,\nCo. Cork", "House", "no", 1)
    files.write_extract(spark.createDataFrame([row], schemas.PORTAL_A), a)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "b.csv").write_text(",beds,baths,floor_area,Price,Address,Property_type,New_build,Page\n")
    pipelines.clean_extracts(spark, {"portal_a": a, "portal_b": b}, out)
    listed = files.read_table(spark, f"{out}/all_listings", schemas.ALL_LISTINGS).collect()
    assert [(r["Address"], r["County"], r["Province"]) for r in listed] == [("1 Road,\nCo. Cork", "Cork", "Munster")]
    pipelines.clean_extracts(spark, {"portal_a": b, "portal_b": b}, out)
    assert files.read_table(spark, f"{out}/all_listings", schemas.ALL_LISTINGS).count() == 0


def test_partitions_get_few_files_and_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 20000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("part"))
    files.write_table(rows, path, ["part"])
    assert all(len(glob.glob(f"{folder}/*.parquet")) <= 2 for folder in glob.glob(f"{path}/part=*"))
    before = {f for f in glob.glob(f"{path}/part=*/*") if "part=a" not in f}
    files.replace_partitions(spark.createDataFrame([(-1, "a")], "id bigint, part string"), path, ["part"])
    got = files.read_table(spark, path, rows.schema)
    assert got.where("part = 'a'").collect() == [(-1, "a")] and got.where("part <> 'a'").count() == rows.where("part <> 'a'").count()
    assert before == {f for f in glob.glob(f"{path}/part=*/*") if "part=a" not in f}
    files.replace_partitions(rows.where("false"), path, ["part"])
    assert got.count() == files.read_table(spark, path, rows.schema).count()


def test_county_by_table_is_the_literal_form(spark):
    keys = spark.range(0, 4000)
    addresses = keys.select("id", renditions.address(F.col("id")).alias("Address"))
    names = files.county_lookup(spark).select("County")
    odd = spark.createDataFrame([(10**6 + i, a) for i, a in enumerate(["x,Co.", "", ",", "x, Cork, Kerry 9", "x,\u00a0Cork  7 ", "Mayo Mayo"])], addresses.schema)
    every = addresses.unionByName(odd)
    for position in (-1, -2):
        joined = lookup.add_county(every, names, ["id"], position=position, into="found")
        both = joined.withColumn("literal", cleaning.county_from_address(F.col("Address"), position))
        assert both.count() == every.count() and both.where("NOT found <=> literal").count() == 0
    assert lookup.add_county(every, names.where("false"), ["id"]).where("County IS NOT NULL AND lower(Address) NOT LIKE '%co.%'").count() == 0


def test_the_last_row_of_a_lookup_wins_over_files_and_blocks(spark, tmp_path):
    for name, lines in (("1.csv", ["Cork,Old", "Kerry,Munster"]), ("2.csv", ["Cork,First", "Cork,Munster"])):
        (tmp_path / name).write_text("County,Province\n" + "\n".join(lines) + "\n")
    many = [f"c{i},p" for i in range(20000)] + ["c7,late"]
    (tmp_path / "3.csv").write_text("County,Province\n" + "\n".join(many) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        dim = files.read_lookup(spark, [str(tmp_path / f"{i}.csv") for i in (3, 2, 1)], schemas.COUNTY)
        assert dim.rdd.getNumPartitions() > 5
        asked = spark.createDataFrame([("Cork",), ("Kerry",), ("c7",), ("c8",), (None,)], "County string")
        got = {r["County"]: r["Province"] for r in lookup.add_province(asked, dim).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"Cork": "Munster", "Kerry": "Munster", "c7": "late", "c8": "p", None: None}


def test_rules_are_counted_in_the_pass_that_writes(spark, sf_dir, tmp_path):
    counts = Observation()
    rows = pipelines.counted(renditions.portal_a_raw(spark, sf_dir), counts)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count(r"(?U)\\s+") <= 1
    rows.write.parquet(str(tmp_path / "rows"))
    assert counts.get["selected"] == spark.read.parquet(str(tmp_path / "rows")).count()
    assert sum(counts.get.values()) == renditions.portal_a_raw(spark, sf_dir).count()


def test_a_price_of_nothing_has_no_percentage(spark):
    rows = spark.createDataFrame([(5, 0, 5, None), (5, 0, 5, 1.0), (110, 100, 10, 10.0)], "New_price int, Old_price int, change_eur int, change_pct double")
    assert [r[0] for r in rows.select(profile.change_consistent()).collect()] == [None, None, True]


def test_sketches_are_within_their_error(spark):
    rows = spark.range(0, 200000).select((F.col("id") % 50000).alias("many"), (F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none"),
                                         (F.col("id") % 16).alias("day"))
    stored = profile.distinct_sketches(rows, ["many", "few", "none"], F.col("day"))
    got = {r["column"]: r["estimate"] for r in profile.merged_counts(stored).collect()}
    assert abs(got["many"] - 50000) < 2500 and got["few"] == 7 and got["none"] == 0


def test_profile_reads_its_table_once(spark, sf_dir):
    df = driver_queries.null_tokens(spark, sf_dir)
    found = profile.value_profile(df)
    plan = final_plan(found)
    assert plan.count("FileScan") == 1 and "Expand" not in plan
    exact = {r["column"]: r["n_unique"] for r in profile.distinct_counts(df).collect()}
    filled = {r["column"]: r["non_null"] for r in profile.column_report(df).collect()}
    assert {r["column"]: (r["n_unique"], r["non_null"]) for r in found.collect()} == {c: (exact[c], filled[c]) for c in df.columns}
    assert [tuple(r)[2:] for r in profile.value_profile(df.where("false")).collect()] == [(0, 0, "")] * len(df.columns)


def test_types_widen_without_loss_or_not_at_all(spark):
    number = {"int": IntegerType(), "long": LongType(), "double": DoubleType(), "money": DecimalType(12, 2)}
    assert dedup.widened(number["int"], number["double"]) == DoubleType()
    assert dedup.widened(number["money"], number["long"]) == DecimalType(21, 2)
    assert dedup.widened(number["long"], number["double"]) is None and dedup.widened(number["money"], number["double"]) is None
    assert dedup.widened(StringType(), number["double"]) is None
    left, right = spark.createDataFrame([("x", 1)], "a string, b bigint"), spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    with pytest.raises(ValueError, match="a: string and double; b: bigint and double"):
        dedup.union_widened(left, right)
    with pytest.raises(ValueError, match="columns differ"):
        dedup.union_widened(left, right.toDF("b", "a"))


def test_a_price_range_skips_most_files(spark, sf_dir, tmp_path):
    path = str(tmp_path / "clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_table(driver_queries._lineitem_listings(spark, sf_dir), path, ["County"], sort_by=["Price"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = hit = 0
    for name in glob.glob(f"{path}/County=N/*.parquet"):
        group = pq.ParquetFile(name).metadata.row_group(0)
        stats = next(s for i in range(group.num_columns) if (c := group.column(i)).path_in_schema == "Price" for s in [c.statistics])
        held, hit = held + 1, hit + (stats.min <= 30000 and stats.max >= 29000)
    assert held >= 3 and hit <= held / 2
    plan = lake_queries.QUERIES["explore_clustered"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(County" in plan and "GreaterThanOrEqual(Price,20000.0)" in plan


def test_dates_are_prepared_once(spark, sf_dir):
    plan = driver_queries.QUERIES["price_change_signed"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("regexp_replace", plan)) <= 10


def test_frontier_of_landed_pages(spark):
    pages = spark.createDataFrame([(3,), (7,), (7,), (None,)], "page_id bigint")
    landed = {r["page_id"]: r["url"] for r in frontier.landed_frontier(pages, "u/").collect()}
    assert landed == {3: "u/3", 7: "u/7"}
    plan = frontier.page_frontier(spark, "u/", 2, 9)
    assert sorted(r["page_id"] for r in frontier.missing_pages(plan, pages).collect()) == [2, 4, 5, 6, 8]
    assert frontier.landed_frontier(pages.where("false"), "u/", 20).count() == 0
