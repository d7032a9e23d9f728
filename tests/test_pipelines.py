import datetime

import pytest
from pyspark.sql import functions as F

from lotwise import schemas
from lotwise.functions import fixed
from lotwise.operators import explore, groups
from lotwise.plans import pipelines
from lotwise.sources import files
from lotwise.streaming import landing

PORTAL_A = [
    (0, 5.0, 4.0, 332.0, "550000", "Mountain View, Kilconly, Co. Galway", "Detached", "no", 0),
    (1, 3.0, 2.0, 90.0, "295000", "7 Henrietta Street, Dublin 1", "Semi-D", "no", 0),
    (2, None, None, None, "Price on Application", "Field, Co. Cork", "Site", "no", 0),
    (3, 2.0, 1.0, 60.0, "200000", "Nowhere at all", "Studio", "no", 1),
    (4, 3.0, 2.0, 90.0, "295000", "7 Henrietta Street, Dublin 1", "Semi-D", "no", 1),
]
PORTAL_B = [
    (0, 4.0, 3.0, "240m 2", "800000", " Mahananda, Castletroy, Limerick", "Detached House", None, 1.0),
    (1, 3.0, 2.0, "1424ft 2", "150000", " 18 Avenue, Bandon,   West Cork", "Townhouse", None, 1.0),
    (2, 2.0, 2.0, "128 - 133m 2", "PoA", " 4 Hall, Dublin 18", "Apartment", None, 1.0),
    (3, None, None, "75m 2", None, None, None, None, None),
    (4, 3.0, 2.0, "90m 2", "295000", ' "Aurora House", 7 Henrietta Street, Dublin 1', "Semi-Detached House", None, 2.0),
    (5, 3.0, 2.0, "90m 2", "1", "no county here", "nan", None, 2.0),
]
SOLD = [
    (0, datetime.date(2022, 12, 9), "35B Park, Co. Limerick, V42r634", 205000, 1),
    (1, datetime.date(2022, 12, 8), "1 Mayor Street, Mayor Street", 300000, 1),
    (2, datetime.date(2022, 12, 7), "35B Park, Co. Limerick, V42r634", 150000, 1),
    (3, datetime.date(2022, 12, 7), "Portnashangan", 1, 1),
    (4, datetime.date(2022, 12, 6), "2 Road, Galway.", 2, 2),
]
CHANGE = [
    (0, datetime.date(2022, 12, 16), " 10 Building, Dublin 8 ", 465000, 425000, 40000, 9.41, 1),
    (1, datetime.date(2022, 12, 16), " The Downs, Delgany ", 560000, 500000, 60000, 12.0, 1),
    (2, datetime.date(2022, 12, 15), " 10 Building, Dublin 8 ", 425000, 430000, -5000, -1.16, 1),
    (3, datetime.date(2022, 12, 15), "x, Cork-", 1, 2, -1, -50.0, 1),
]


@pytest.fixture(scope="module")
def a(spark):
    return pipelines.clean_portal_a(spark.createDataFrame(PORTAL_A, schemas.PORTAL_A)).cache()


@pytest.fixture(scope="module")
def b(spark):
    return pipelines.clean_portal_b(spark.createDataFrame(PORTAL_B, schemas.PORTAL_B)).cache()


@pytest.fixture(scope="module")
def listings(a, b):
    return pipelines.build_all_listings(a, b).cache()


def picked(df, *columns, order="src_row"):
    return [tuple(r) for r in df.orderBy(order).select(*columns).collect()]


def test_clean_portal_a(a):
    assert picked(a, "src_row", "Bed", "Bath", "Price", "County", "Province") == [
        (0, 5.0, 4.0, 550000, "Galway", "Connaught"),
        (1, 3.0, 2.0, 295000, "Dublin 1", "Leinster"),
        (2, 0.0, 0.0, None, "Cork", "Munster"),
        (4, 3.0, 2.0, 295000, "Dublin 1", "Leinster"),
    ]


def test_clean_portal_b(b):
    assert picked(b, "src_row", "floor_area", "Price", "County", "Province") == [
        (0, 240.0, 800000, "Limerick", "Munster"),
        (1, 132.29, 150000, "Cork", "Munster"),
        (2, 128.0, None, "Dublin 18", "Leinster"),
        (4, 90.0, 295000, "Dublin 1", "Leinster"),
    ]


def test_clean_sold(spark):
    cleaned = pipelines.clean_sold(spark.createDataFrame(SOLD, schemas.SOLD))
    assert picked(cleaned, "src_row", "Price", "County", "Province") == [
        (0, 205000, "Limerick", "Munster"),
        (1, 300000, "Dublin 1", "Leinster"),
        (4, 2, "Galway.", None),
    ]


def test_clean_change_modes(spark):
    raw = spark.createDataFrame(CHANGE, schemas.CHANGE)
    latest = [(0, "Dublin 8", "Leinster"), (1, "Wicklow", "Leinster"), (3, "Cork", "Munster")]
    assert picked(pipelines.clean_change(raw), "src_row", "County", "Province") == latest
    assert pipelines.clean_change(raw, mode="history").count() == 4
    with pytest.raises(ValueError):
        pipelines.clean_change(raw, mode="newest")


def test_all_listings(listings):
    assert [(f.name, f.dataType) for f in listings.schema] == [
        (f.name, f.dataType) for f in schemas.ALL_LISTINGS
    ]
    got = picked(listings, "Address", "Property_type", "Property_Category", "Floor_area", order="Address")
    assert got == [
        (' "Aurora House", 7 Henrietta Street, Dublin 1', "Semi-Detached", "House", 90.0),
        (" 18 Avenue, Bandon,   West Cork", "Townhouse", "House", 132.29),
        (" Mahananda, Castletroy, Limerick", "Detached", "House", 240.0),
        ("7 Henrietta Street, Dublin 1", "Semi-Detached", "House", 90.0),
        ("Mountain View, Kilconly, Co. Galway", "Detached", "House", 332.0),
    ]


def test_regional_stats(listings):
    stats = {r["County"]: r for r in pipelines.regional_stats(listings).collect()}
    assert set(stats) == {"Dublin", "Cork", "Limerick", "Galway"}
    dublin = stats["Dublin"]
    assert (dublin["Province"], dublin["Price_count"], dublin["Price_mean"], dublin["Price_std"]) == (
        "Leinster", 2, 295000.0, 0.0,
    )
    near = {r["County"]: r["Beds_50%"] for r in pipelines.regional_stats(listings, exact=False).collect()}
    assert near == {k: v["Beds_50%"] for k, v in stats.items()}


def test_scatter(listings):
    points, axis = pipelines.scatter_data(listings, "Beds")
    assert points.count() == 5 and points.dtypes == [("x", "string"), ("y", "bigint")]
    assert [r.x for r in axis.collect()] == ["3.0", "4.0", "5.0"]
    below = explore.scatter_points(listings, "Floor_area", below=240)
    assert sorted(r.x for r in below.collect()) == [90.0, 90.0, 132.29]


def test_explorer(spark, listings):
    assert pipelines.explorer(listings, bounds=fixed.EXPLORER_BOUNDS).count() == 0
    wide = {"Beds": (0, 20), "Baths": (0, 20), "Price": (0, 10000000), "Floor_area": (0, 3000)}
    every = pipelines.explorer(listings, bounds=wide).collect()
    assert len(every) == 5 and {r.n_selected for r in every} == {5}
    some = pipelines.explorer(
        listings, bounds=wide, county="Dublin 1", category="House", x_axis="Number of beds", y_axis="Number of baths"
    )
    assert [tuple(r) for r in some.collect()] == [(3.0, 2.0, 295000, "Semi-Detached", "Dublin 1", 2)] * 2
    # A value is a value, whatever is in it.
    assert pipelines.explorer(listings, bounds=wide, county="x' OR '1'='1").count() == 0
    assert explore.n_selected(spark, wide, category="House").first()[0] == 5


def test_combine_and_fold(a, b):
    kept = pipelines.combine_and_fold(a, b, below=2)
    # One address twice in portal A; the small district folds, single other counties go.
    assert sorted((r.County, r.Price or 0) for r in kept.collect()) == [
        ("Cork", 0), ("Cork", 150000), ("Dublin", 0), ("Dublin 1", 295000), ("Dublin 1", 295000),
    ]


def test_profile(spark):
    frames = pipelines.profile_extract(spark.createDataFrame(PORTAL_A, schemas.PORTAL_A))
    assert {r["column"]: r["non_null"] for r in frames["columns"].collect()}["Bed"] == 4
    assert {r["column"]: r["50%"] for r in frames["numbers"].collect()} == {"Bed": 3, "Bath": 2, "floor_area_m2": 90}
    assert {r["column"]: r["n_unique"] for r in frames["distinct"].collect()}["Address"] == 4
    assert frames["types"].first()["Property_type"] == "Semi-D"


def test_batch_from_extracts_to_tables(spark, tmp_path):
    inputs = {}
    for name, data in [("portal_a", PORTAL_A), ("portal_b", PORTAL_B), ("sold", SOLD), ("change", CHANGE)]:
        inputs[name] = str(tmp_path / name)
        files.write_extract(spark.createDataFrame(data, pipelines.EXTRACT_SCHEMAS[name]).coalesce(1), inputs[name])
    out = str(tmp_path / "out")
    pipelines.clean_extracts(spark, inputs, out)
    assert spark.read.parquet(f"{out}/sold").count() == 3
    assert spark.read.parquet(f"{out}/change").count() == 3
    combined = spark.read.parquet(f"{out}/all_listings")
    assert combined.count() == 5 and "Aurora" in combined.orderBy("Address").first()["Address"]
    munster = combined.filter("Province = 'Munster'")
    assert munster.count() == 2
    assert "PartitionFilters: [isnotnull(Province" in munster._jdf.queryExecution().toString()


def test_jobs(spark, tmp_path, sf_dir):
    from lotwise.__main__ import main
    from lotwise.plans import renditions

    a, b, tables, stats = (str(tmp_path / n) for n in ("a", "b", "tables", "stats"))
    files.write_extract(renditions.portal_a_raw(spark, sf_dir), a)
    files.write_extract(renditions.portal_b_raw(spark, sf_dir), b)
    main(["clean", "--portal_a", a, "--portal_b", b, "--out", tables])
    main(["stats", "--listings", f"{tables}/all_listings", "--out", stats])
    listings = spark.read.parquet(f"{tables}/all_listings")
    described = spark.read.csv(stats, header=True, inferSchema=True)
    assert described.agg(F.sum("Price_count")).first()[0] == listings.count() > 0
    pages, rows = str(tmp_path / "pages"), str(tmp_path / "rows")
    renditions.sold_pages(spark, sf_dir).write.parquet(pages)
    main(["extract", "--pages", pages, "--dataset", "sold", "--out", rows])
    orders = renditions.table(spark, sf_dir, "orders")
    assert spark.read.parquet(rows).count() == orders.count()


def test_extract_with_doubled_quotes_and_row_numbers(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text(
        ",beds,baths,floor_area,Price,Address,Property_type,New_build,Page\n"
        '0,3,2,90m 2,295000," ""Aurora House"", 1 Road, Cork",Apartment,,1.0\n'
        "1,,,,,,,,\n",
        encoding="utf-8",
    )
    got = files.read_extract(spark, str(path), schemas.PORTAL_B).orderBy("src_row").collect()
    assert got[0].Address == ' "Aurora House", 1 Road, Cork' and got[0].Page == 1.0
    assert got[1].Address is None and got[1].src_row == 1


def test_streams_give_what_the_batch_gives(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    files.write_extract(spark.createDataFrame(PORTAL_A, schemas.PORTAL_A), folder)
    rows = pipelines.clean_portal_a(landing.extract_stream(spark, folder, schemas.PORTAL_A))
    landing.write_stream(rows, out, str(tmp_path / "ck")).awaitTermination()
    batch = pipelines.clean_portal_a(files.read_extract(spark, folder, schemas.PORTAL_A))
    assert spark.read.parquet(out).exceptAll(batch).count() == 0
    assert spark.read.parquet(out).count() == batch.count() == 4


def test_page_stream(spark, tmp_path, sf_dir):
    from lotwise.plans import renditions

    pages = renditions.portal_a_pages(spark, sf_dir)
    folder, out = str(tmp_path / "pages"), str(tmp_path / "rows")
    pages.write.parquet(folder)
    rows = pipelines.extract_listings(landing.page_stream(spark, folder), "portal_a")
    landing.write_stream(rows, out, str(tmp_path / "ck")).awaitTermination()
    batch = pipelines.extract_listings(pages, "portal_a")
    assert spark.read.parquet(out).count() == batch.count() > 0


def test_county_lookup(spark):
    counts = dict(tuple(r) for r in groups.group_counts(files.county_lookup(spark), "Province").collect())
    assert counts == {"Leinster": 12, "Ulster": 9, "Munster": 6, "Connaught": 5}
    assert files.county_lookup(spark).select(F.count_distinct("County")).first()[0] == 32


def test_extract_keeps_blanks_and_line_breaks(spark, tmp_path):
    rows = [("  10 Building, Dublin 8 ", 1), ('1 Road\n"Cork"', 2)]
    kind = "Address string, n int"
    from pyspark.sql.types import _parse_datatype_string

    files.write_extract(spark.createDataFrame(rows, kind), str(tmp_path / "x"))
    schema = _parse_datatype_string(kind)
    got = files.read_extract(spark, str(tmp_path / "x"), schema, multi_line=True, check_header=True)
    assert sorted(map(tuple, got.collect())) == sorted(rows)
    other = _parse_datatype_string("n int, Address string")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_extract(spark, str(tmp_path / "x"), other, check_header=True).collect()


def test_ranges_that_are_not_named_are_open(spark):
    df = spark.createDataFrame([(i, 9, 10**7, 500.0) for i in range(6)], "Beds int, Baths int, Price int, Floor_area double")
    explore.register(df, "open_ranges")
    assert explore.n_selected(spark, {"Beds": (2, 4)}, view="open_ranges").first()[0] == 3
    assert explore.n_selected(spark, view="open_ranges").first()[0] == 6
