"""The queries registered for the driver: each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise import schemas
from lotwise.functions import cleaning, fixed
from lotwise.functions.html_cards import Address, CardSpec
from lotwise.operators import dedup, explore, extract, groups, lookup, profile, quantiles, relabel
from lotwise.operators.staging import scratch_path, stage
from lotwise.plans import pipelines
from lotwise.plans import renditions as r
from lotwise.sources import files, frontier

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
QUARTERS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded, as sums differ in their last digits with the order of rows."""
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# --- statistics -------------------------------------------------------------


@register
def region_nation_stats(spark, sf):
    """Eight statistics of order prices per region and nation, one name prefix as one nation."""
    nations = r.table(spark, sf, "nation").join(
        r.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    customers = r.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = r.table(spark, sf, "orders").select("o_custkey", "o_totalprice")
    priced = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("r_name").alias("region"),
            cleaning.collapse_prefix(F.col("n_name"), "NATION_1").alias("nation"),
            F.col("o_totalprice").alias("price"),
        )
    )
    return rounded(quantiles.describe_groups(priced, ["region", "nation"], ["price"], QUARTERS))


@register
def lineitem_measure_stats(spark, sf):
    """Several measures per group in one pass."""
    measures = ["l_quantity", "l_extendedprice", "l_discount"]
    lines = r.table(spark, sf, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    return rounded(quantiles.describe_groups(lines, keys, measures, QUARTERS))


@register
def regional_stats(spark, sf):
    """Statistics of all listing measures per province and county."""
    stats = pipelines.regional_stats(_all_listings(spark, sf))
    return rounded(
        stats.select(
            "Province",
            "County",
            *[
                F.col(f"`{m}_{s}`").alias(f"{m}_{n}")
                for m in ("Beds", "Baths", "Floor_area", "Price")
                for s, n in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("25%", "p25"), ("50%", "median"), ("75%", "p75"), ("max", "max")]
            ],
        )
    )


# --- scalar cleaning --------------------------------------------------------


@register
def price_parse(spark, sf):
    whole = F.floor("o_totalprice")
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", r.euro(whole))
        .when(priority == "2-HIGH", F.concat(F.lit("AMV: "), r.euro(whole), F.lit(" ")))
        .when(priority == "3-MEDIUM", F.lit(" AMV: Price on Application"))
        .when(priority == "4-NOT SPECIFIED", F.lit("POA"))
        .otherwise(F.concat(F.lit(" From "), r.euro(whole), F.lit(" to "), r.euro(whole + 5000)))
    )
    kept = cleaning.price_or_sentinel(F.col("text"), fixed.PORTAL_B_ON_APPLICATION, fixed.PORTAL_B_SENTINEL)
    return r.table(spark, sf, "orders").select("o_orderkey", text.alias("text")).select(
        "o_orderkey",
        kept.alias("price_text"),
        cleaning.price_to_int(kept).alias("price"),
        cleaning.price_status(F.col("text"), fixed.PORTAL_B_ON_APPLICATION).alias("price_status"),
    )


@register
def floor_area_m2(spark, sf):
    size = F.col("p_size")
    text = r.cases(
        F.col("p_partkey"),
        [
            F.concat(r.as_text(size * 5), F.lit("m 2")),
            F.concat(F.format_number(size * 97, 0), F.lit("ft 2")),
            F.concat(r.as_text(size + 60), F.lit(" - "), r.as_text(size * 4), F.lit("m 2")),
            F.concat(r.as_text(size * 20), F.lit(" - "), r.as_text(size * 20 + 500), F.lit("ft 2")),
            F.concat(r.as_text(size), F.lit(" ac")),
            F.concat(r.as_text(size), F.lit("yd 2")),
            F.lit(None).cast("string"),
        ],
    )
    acres = cleaning.decimal_number(F.regexp_extract("text", r"^(\S+) ac$", 1))
    return r.table(spark, sf, "part").select("p_partkey", text.alias("text")).select(
        "p_partkey",
        cleaning.is_area_text(F.col("text")).alias("is_area"),
        F.round(
            F.coalesce(cleaning.floor_area_m2(F.col("text")), cleaning.acres_to_m2(acres)), 2
        ).alias("floor_area_m2"),
    )


@register
def county_extract(spark, sf):
    address = F.col("address")
    patches = {**fixed.SOLD_COUNTY_PATCH, **fixed.CHANGE_COUNTY_PATCH}
    found = r.table(spark, sf, "customer").select(
        "c_custkey", r.address(F.col("c_custkey")).alias("address")
    ).select(
        "c_custkey",
        cleaning.county_from_address(address, -1).alias("county_last"),
        cleaning.county_from_address(address, -2).alias("county_before"),
        cleaning.strip_county_mark(cleaning.county_either(address)).alias("county"),
    )
    patched = relabel.relabel(found, "county", patches)
    return lookup.add_province(
        patched.withColumn("valid", cleaning.county_valid(F.col("county"))), county="county"
    ).withColumnRenamed("Province", "province")


@register
def conditional_zero(spark, sf):
    part = r.table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return relabel.assign_where(
        part, F.col("p_type") == "ECONOMY", {"p_size": 0, "p_retailprice": 0.0}
    )


@register
def type_category(spark, sf):
    typed = r.table(spark, sf, "part").select(
        r.nth(r.LISTING_TYPES, F.col("p_partkey") + F.col("p_size")).alias("Property_type")
    )
    return groups.group_counts(relabel.add_category(typed), "Property_type", "Property_Category")


@register
def null_tokens(spark, sf):
    key = F.col("event_id")
    messy = r.table(spark, sf, "events").select(
        "event_id",
        F.when(key % 11 == 3, F.lit("NA")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(key % 7 == 2, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        F.when(key % 5 == 4, F.lit("nan")).otherwise(F.col("props")).alias("props"),
    )
    return files.null_tokens(messy)


@register
def complete_cases(spark, sf):
    return null_tokens(spark, sf).dropna()


@register
def price_change_signed(spark, sf):
    low = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    high = F.floor("l_extendedprice")
    returned = F.col("l_returnflag") == "R"
    priced = r.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.when(returned, high).otherwise(low).alias("new"),
        # a price of 0 has no percentage
        F.when(returned, low).when(F.col("l_linenumber") == 5, F.lit(0).cast("bigint")).otherwise(high).alias("old"),
    )
    percent = F.round(F.try_divide((F.col("new") - F.col("old")) * 100, F.col("old")), 2)
    percent = F.when(F.col("l_linenumber") == 7, percent * 2).otherwise(percent)  # not consistent
    formats = [
        "yyyy-MM-dd", "MM/dd/yyyy", "d MMM yyyy", "MMMM d, yyyy", "yyyy/MM/dd", "d-MMM-yyyy", "yyyy-MM-dd HH:mm:ss",
    ]
    texts = priced.select(
        "l_orderkey",
        "l_linenumber",
        r.cases(F.col("l_linenumber"), [F.date_format("l_shipdate", f) for f in formats]).alias("date"),
        r.euro(F.abs(F.col("new") - F.col("old"))).alias("change"),
        F.concat(F.lit("("), percent.cast("string"), F.lit("%)")).alias("percent"),
        r.euro(F.col("old")).alias("old"),
        r.euro(F.col("new")).alias("new"),
    )
    pct = cleaning.percent_from_text(F.col("percent"))
    parsed = texts.select(
        "l_orderkey",
        "l_linenumber",
        cleaning.date_from_text(F.col("date")).alias("date"),
        cleaning.price_from_text(F.col("new")).alias("New_price"),
        cleaning.price_from_text(F.col("old")).alias("Old_price"),
        cleaning.signed_change(cleaning.price_from_text(F.col("change")), pct).alias("change_eur"),
        pct.alias("change_pct"),
    )
    return parsed.withColumn("consistent", profile.change_consistent())


# --- lookups and groups -----------------------------------------------------


@register
def province_lookup(spark, sf):
    """Customers with their region; a numbered nation looks up as the nation itself."""
    nations = r.table(spark, sf, "nation").join(
        r.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    county = F.concat(F.lit("NATION_"), F.col("c_nationkey") + (F.col("c_custkey") % 3))
    district = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NATION_1 8")).otherwise(county)
    customers = r.table(spark, sf, "customer").select("c_custkey", district.alias("nation"))
    found = lookup.lookup_left(
        customers, nations, cleaning.lookup_key(F.col("nation"), "NATION_1"), "n_name", "r_name"
    )
    return found.withColumnRenamed("r_name", "region").dropna(subset=["region"])


def _customer_nations(spark, sf):
    customers = r.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = r.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return customers.join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select("c_custkey", F.col("n_name").alias("nation"))


def _mean_group(spark, sf) -> int:
    # The threshold that splits the nations at every scale: customers per nation.
    return r.table(spark, sf, "customer").count() // r.table(spark, sf, "nation").count()


@register
def fold_small_groups(spark, sf):
    below = _mean_group(spark, sf)
    return groups.fold_small_groups(_customer_nations(spark, sf), "nation", "NATION_1", below)


@register
def exclude_small_groups(spark, sf):
    customers = _customer_nations(spark, sf)
    small = groups.small_groups(customers, "nation", _mean_group(spark, sf))
    return lookup.exclude_keys(customers, stage(small, "small-groups"), "nation")


@register
def group_counts(spark, sf):
    return groups.group_counts(r.table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@register
def bottom_k_groups(spark, sf):
    return groups.smallest_groups(_customer_nations(spark, sf), "nation", 5)


@register
def preview_rows(spark, sf):
    orders = r.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return groups.first_rows(orders, "o_totalprice", "o_orderkey")


@register
def lookup_last_wins(spark, sf):
    """Of the suppliers of a nation the last one is its entry in the lookup."""
    suppliers = r.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", "s_name")
    dim = lookup.last_wins(suppliers, "s_nationkey", "s_name", "s_suppkey")
    customers = r.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup.lookup_left(customers, dim, F.col("c_nationkey"), "s_nationkey", "s_name")


@register
def value_counts(spark, sf):
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return groups.value_counts(r.table(spark, sf, "orders").select(priority.alias("priority")), "priority")


@register
def distinct_values(spark, sf):
    return groups.sorted_values(r.table(spark, sf, "events"), "user_id")


# --- unions and repeats -----------------------------------------------------


@register
def union_listings(spark, sf):
    """Customers and suppliers aligned by position; the nation key widens to double."""
    names = ["name", "nationkey", "acctbal"]
    customers = r.table(spark, sf, "customer").select(
        "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_acctbal"
    )
    suppliers = r.table(spark, sf, "supplier").select(
        "s_name", F.col("s_nationkey").cast("double").alias("s_nationkey"), "s_acctbal"
    )
    both = dedup.union_aligned(
        relabel.rename_leading(customers, names), relabel.rename_leading(suppliers, names)
    )
    return dedup.keep_any(both)


@register
def append_listings(spark, sf):
    customers = r.table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = r.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")
    )
    return dedup.append_by_name(customers, suppliers)


@register
def distinct_rows(spark, sf):
    return dedup.keep_any(r.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity"))


@register
def dedup_any(spark, sf):
    """One event per user and type; which one is open, so only the key is shown."""
    events = r.table(spark, sf, "events").select("user_id", "event_type", "event_id")
    return dedup.keep_any(events, ["user_id", "event_type"]).select("user_id", "event_type")


@register
def dedup_first(spark, sf):
    events = r.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return dedup.keep_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@register
def dedup_two_stage(spark, sf):
    """Documents by whole text, then by language, source and length. A digest stands for
    the text, so the text itself is not shuffled."""
    documents = r.table(spark, sf, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.sha2("text", 256).alias("text_digest")
    )
    return dedup.keep_first_twice(
        documents, ["text_digest"], ["lang", "source", "n_chars"], ["doc_id"]
    ).drop("text_digest")


# --- exploration ------------------------------------------------------------


def _lineitem_listings(spark, sf):
    names = {
        "l_linenumber": "Beds",
        "l_quantity": "Baths",
        "l_extendedprice": "Price",
        "l_discount": "Floor_area",
        "l_returnflag": "County",
        "l_linestatus": "Property_Category",
        "l_shipdate": "Property_type",
    }
    listings = r.table(spark, sf, "lineitem").select(*names).withColumnsRenamed(names)
    return listings.withColumn("Property_type", F.col("Property_Category"))


@register
def explore_range(spark, sf):
    explore.register(_lineitem_listings(spark, sf), "lineitem_property")
    return explore.explore(
        spark,
        {"Beds": (2, 5), "Baths": (5, 40), "Price": (10000, 60000), "Floor_area": (0.02, 0.07)},
        county="N",
        category="O",
        view="lineitem_property",
    )


@register
def explore_count(spark, sf):
    explore.register(_lineitem_listings(spark, sf), "lineitem_counted")
    bounds = {"Beds": (1, 6), "Baths": (1, 30), "Price": (0, 50000), "Floor_area": (0, 0.05)}
    return explore.n_selected(spark, bounds, view="lineitem_counted")


@register
def explore_partial(spark, sf):
    """One range is named, the others stay open."""
    explore.register(_lineitem_listings(spark, sf), "lineitem_partial")
    return explore.explore(spark, {"Beds": (2, 4)}, category="O", view="lineitem_partial")


@register
def scatter_data(spark, sf):
    return explore.scatter_points(_lineitem_listings(spark, sf), "Baths", "Price", 50000)


@register
def scatter_axis(spark, sf):
    return explore.scatter_axis(_lineitem_listings(spark, sf), "Baths", "Price", 50000)


def _all_listings(spark, sf):
    return pipelines.build_all_listings(
        pipelines.clean_portal_a(r.portal_a_raw(spark, sf)),
        pipelines.clean_portal_b(r.portal_b_raw(spark, sf)),
    )


@register
def explore_listings(spark, sf):
    """The explorer over the combined listings; they are staged, as rows and number both read them."""
    bounds = {"Beds": (1, 6), "Baths": (0, 4), "Price": (0, 600000), "Floor_area": (0, 150)}
    listings = stage(_all_listings(spark, sf), "all-listings")
    return pipelines.explorer(listings, bounds=bounds, category="House", x_axis="Number of beds")


@register
def scatter_listings(spark, sf):
    return pipelines.scatter_data(_all_listings(spark, sf), "Floor_area")[0]


# --- profiles ---------------------------------------------------------------


@register
def profile_nulls(spark, sf):
    return profile.column_report(null_tokens(spark, sf))


@register
def profile_nunique(spark, sf):
    return profile.distinct_counts(null_tokens(spark, sf))


@register
def profile_describe(spark, sf):
    return profile.describe_numbers(r.table(spark, sf, "orders")).withColumnsRenamed(
        {"25%": "p25", "50%": "p50", "75%": "p75"}
    )


@register
def describe_table(spark, sf):
    return rounded(profile.describe_columns(r.table(spark, sf, "orders")))


@register
def orphan_rows(spark, sf):
    """Extracted rows that hold an area but neither address nor price."""
    key = F.col("src_row")
    shifted = files.null_tokens(r.portal_b_raw(spark, sf)).withColumns(
        {
            "Price": F.when(key % 13 != 0, F.col("Price")),
            "Address": F.when(key % 13 != 0, F.col("Address")),
        }
    )
    return profile.orphans(shifted, ["Address", "Price"], ["floor_area"]).select("src_row", "floor_area")


# --- pages ------------------------------------------------------------------


@register
def page_frontier(spark, sf):
    """One URL per landed page, in both URL forms."""
    pages = r.table(spark, sf, "pages")
    by_offset = frontier.landed_frontier(pages, "https://listings.example.com/for-sale", fixed.PAGE_SIZE)
    by_number = frontier.landed_frontier(pages, "https://listings.example.com/sold/page-")
    return by_offset.withColumnRenamed("url", "offset_url").join(
        by_number.withColumnRenamed("url", "numbered_url"), "page_id"
    )


@register
def page_cards(spark, sf):
    spec = CardSpec(Address("li"), {"link": Address("a")}, attrs=(("link", "href"),))
    cards = extract.page_cards(r.table(spark, sf, "pages"), spec)
    link = F.try_element_at(extract.hits_of("link"), F.lit(1))
    return cards.select("page_id", "card_no", link["attr"].alias("href"), link["text"].alias("text"))


@register
def page_fields(spark, sf):
    fields = {
        "title": Address("title"),
        "heading": Address("h1"),
        "ad": Address("div", "ad"),
        "paragraph": Address("p"),
        "price": Address("span", "price"),
    }
    cards = extract.page_cards(r.table(spark, sf, "pages"), CardSpec(Address("html"), fields))
    return cards.select(
        "page_id",
        *[extract.nth_text(f).alias(f) for f in ("title", "heading", "ad", "price")],
        F.size(extract.hits_of("paragraph")).cast("bigint").alias("n_paragraphs"),
    )


@register
def page_listings(spark, sf):
    return rounded(extract.portal_a_listings(r.portal_a_pages(spark, sf)).drop("url"))


@register
def page_listings_b(spark, sf):
    return extract.portal_b_listings(r.portal_b_pages(spark, sf)).drop("url", "New_build")


@register
def page_sold(spark, sf):
    return extract.sold_register(r.sold_pages(spark, sf)).drop("url")


@register
def page_changes(spark, sf):
    return extract.change_register(r.change_pages(spark, sf)).drop("url")


# --- pipelines and files ----------------------------------------------------


@register
def clean_portal_a(spark, sf):
    return pipelines.clean_portal_a(r.portal_a_raw(spark, sf))


@register
def clean_portal_b(spark, sf):
    return pipelines.clean_portal_b(r.portal_b_raw(spark, sf)).drop("New_build")


@register
def clean_sold(spark, sf):
    return pipelines.clean_sold(r.sold_raw(spark, sf))


@register
def clean_change(spark, sf):
    return pipelines.clean_change(r.change_raw(spark, sf))


@register
def clean_change_history(spark, sf):
    return pipelines.clean_change(r.change_raw(spark, sf), mode="history")


@register
def build_all_listings(spark, sf):
    return _all_listings(spark, sf)


@register
def combine_and_fold(spark, sf):
    return pipelines.combine_and_fold(
        pipelines.clean_portal_a(r.portal_a_raw(spark, sf)),
        pipelines.clean_portal_b(r.portal_b_raw(spark, sf)),
    )


@register
def csv_roundtrip(spark, sf):
    """Text with quotes and commas written as an extract and read under its schema."""
    quoted = F.concat(F.lit('"'), F.col("c_name"), F.lit('", '), F.col("c_mktsegment"))
    listings = r.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("src_row"),
        F.col("c_acctbal").alias("Bed"),
        F.lit(None).cast("double").alias("Bath"),
        F.lit(1.5).alias("floor_area_m2"),
        F.lit("nan").alias("Price"),
        quoted.alias("Address"),
        F.lit("").alias("Property_type"),
        F.lit("no").alias("New_build"),
        F.col("c_nationkey").alias("Page"),
    )
    path = scratch_path(spark, "csv-roundtrip")
    files.write_extract(listings, path)
    return files.read_extract(spark, path, schemas.PORTAL_A)
