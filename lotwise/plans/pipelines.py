"""The composed pipelines. Each takes and returns DataFrames and runs nothing itself,
except for the small staged tables of the operators it uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lotwise import schemas
from lotwise.functions import cleaning, fixed
from lotwise.operators import dedup, explore, extract, groups, profile, quantiles, relabel
from lotwise.operators.lookup import add_province
from lotwise.operators.staging import stage
from lotwise.sources.files import null_tokens, read_extract, read_table, write_table


def clean_portal_a(raw: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """Typed price, county, province; sites have no beds and no baths. Row-local."""
    located = relabel.with_required(
        raw.withColumn("Price", cleaning.price_to_int(F.col("Price"))),
        "County",
        cleaning.county_from_address(F.col("Address")),
    )
    site = F.col("Property_type") == fixed.SITE_TYPE
    return relabel.assign_where(add_province(located, counties), site, {"Bed": 0.0, "Bath": 0.0})


def clean_portal_b(raw: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """Typed price and floor area, county, province. Row-local."""
    addressed = null_tokens(raw).dropna(subset=["Address"])
    typed = addressed.withColumns(
        {
            "Price": cleaning.price_to_int(F.col("Price")),
            "floor_area": cleaning.floor_area_m2(F.col("floor_area")),
        }
    )
    county = cleaning.strip_county_mark(cleaning.county_from_address(F.col("Address")))
    located = relabel.with_required(typed, "County", county)
    return add_province(located, counties)


def clean_sold(raw: DataFrame, counties: DataFrame | None = None) -> DataFrame:
    """First row per address. The county hangs on the address alone, so rows without one go first."""
    located = relabel.with_required(raw, "County", cleaning.county_either(F.col("Address")))
    first = _first_per_address(located)
    return add_province(relabel.relabel(first, "County", fixed.SOLD_COUNTY_PATCH), counties)


def _first_per_address(rows: DataFrame) -> DataFrame:
    """The first row per address: by file, if the rows tell theirs, then by row number, then by what they hold."""
    order = [c for c in ("src_file", "src_row") if c in rows.columns]
    rest = [c for c in rows.columns if c not in order and c != "Address"]
    return dedup.keep_first(rows, ["Address"], [*order, *rest]).drop("src_file")


def clean_change(
    raw: DataFrame, counties: DataFrame | None = None, mode: str = "latest"
) -> DataFrame:
    """`latest` keeps the first row per address, `history` every change of a home."""
    county = cleaning.strip_county_mark(cleaning.county_either(F.col("Address")))
    located = relabel.with_required(raw, "County", county)
    if mode == "latest":
        located = _first_per_address(located)
    elif mode != "history":
        raise ValueError(f"mode is latest or history, not {mode!r}")
    return add_province(relabel.relabel(located, "County", fixed.CHANGE_COUNTY_PATCH), counties)


def _listing_columns(cleaned: DataFrame) -> DataFrame:
    complete = cleaned.drop("src_row", "New_build", "Page").dropna()
    return relabel.rename_leading(complete, ["Beds", "Baths", "Floor_area"])


def build_all_listings(portal_a: DataFrame, portal_b: DataFrame) -> DataFrame:
    """Complete cases of both portals, one spelling per type, category, no repeated rows."""
    both = dedup.union_aligned(_listing_columns(portal_a), _listing_columns(portal_b))
    return dedup.keep_any(relabel.add_category(both))


def regional_stats(listings: DataFrame, exact: bool = True) -> DataFrame:
    """Statistics of every measure per province and county, numbered districts as one county."""
    county = cleaning.collapse_prefix(F.col("County"), fixed.DISTRICT_COUNTY)
    describe = quantiles.describe_groups if exact else quantiles.describe_groups_approx
    return describe(
        listings.dropna().withColumn("County", county),
        ["Province", "County"],
        ["Beds", "Baths", "Floor_area", "Price"],
    )


def scatter_data(listings: DataFrame, x: str) -> tuple[DataFrame, DataFrame]:
    """Points, and the categories of the x axis."""
    complete = listings.dropna()
    return explore.scatter_points(complete, x), explore.scatter_axis(complete, x)


def explorer(listings: DataFrame, **choices) -> DataFrame:
    """Register the complete cases and select from them."""
    explore.register(listings.dropna())
    return explore.explore(listings.sparkSession, **choices)


def combine_and_fold(
    portal_a: DataFrame, portal_b: DataFrame, below: int = fixed.SMALL_GROUP
) -> DataFrame:
    """Both portals without repeats, small districts folded, other small counties removed.

    The unique rows are staged, as counting the groups and folding them both read them.
    """
    names_a = {"floor_area_m2": "Floor_area"}
    names_b = {"beds": "Bed", "baths": "Bath", "floor_area": "Floor_area"}

    def part(cleaned: DataFrame, names: dict[str, str], source: int) -> DataFrame:
        typed = cleaned.drop("Page", "New_build").dropna(subset=["Property_type"])
        return typed.withColumnsRenamed(names).withColumn("source", F.lit(source))

    both = dedup.append_by_name(part(portal_a, names_a, 0), part(portal_b, names_b, 1))
    unique = dedup.keep_first_twice(
        both,
        ["Address"],
        ["Bed", "Bath", "Floor_area", "Price", "Property_type", "County"],
        ["source", "src_row"],
    )
    staged = stage(unique.drop("source", "src_row"), "unique-listings")
    return groups.fold_small_groups(staged, below=below)


def profile_extract(raw: DataFrame) -> dict[str, DataFrame]:
    """Column report, quartile description, distinct counts, type frequencies."""
    return {
        "columns": profile.column_report(raw),
        "numbers": profile.describe_numbers(raw.drop("src_row", "Page")),
        "distinct": profile.distinct_counts(raw),
        "types": groups.value_counts(raw, "Property_type"),
    }


EXTRACTORS = {
    "portal_a": extract.portal_a_listings,
    "portal_b": extract.portal_b_listings,
    "sold": extract.sold_register,
    "change": extract.change_register,
}
EXTRACT_SCHEMAS = {
    "portal_a": schemas.PORTAL_A,
    "portal_b": schemas.PORTAL_B,
    "sold": schemas.SOLD,
    "change": schemas.CHANGE,
}
CLEANERS = {
    "portal_a": clean_portal_a,
    "portal_b": clean_portal_b,
    "sold": clean_sold,
    "change": clean_change,
}


def extract_listings(pages: DataFrame, dataset: str) -> DataFrame:
    """Rows of one dataset out of landed pages(page_id, url, html)."""
    return EXTRACTORS[dataset](pages)


def clean_extracts(spark: SparkSession, inputs: dict[str, str], out: str, multi_line: bool = True) -> None:
    """Clean each named extract into `out`/<dataset>, then write the combined listings.

    Fields may hold line breaks, as the portals' do; `multi_line=False` reads large files without any in parallel.
    Listings are laid out for the explorer: by price within a province.
    """
    schemas_of = {}
    for dataset, path in inputs.items():
        raw = read_extract(spark, path, EXTRACT_SCHEMAS[dataset], multi_line)
        cleaned = CLEANERS[dataset](raw)
        schemas_of[dataset] = cleaned.schema
        write_table(cleaned, f"{out}/{dataset}", ["Province"])
    if {"portal_a", "portal_b"} <= inputs.keys():
        cleaned = [read_table(spark, f"{out}/{d}", schemas_of[d]) for d in ("portal_a", "portal_b")]
        write_table(build_all_listings(*cleaned), f"{out}/all_listings", ["Province"], sort_by=["Price"])


def counted(rows: DataFrame, counts: Observation) -> DataFrame:
    """`rows` of a portal, located; `counts` receives how many have no address, no county, and are selected.

    The numbers come with whatever action runs, in its one pass; rows without a county leave after they are counted.
    """
    county = cleaning.county_from_address(F.col("Address"))
    # within generated code the county is computed once, for the counts and the filter
    located = rows.withColumn("County", county)
    seen = located.observe(
        counts,
        F.count_if(F.col("Address").isNull()).alias("no_address"),
        F.count_if(F.col("Address").isNotNull() & F.col("County").isNull()).alias("no_county"),
        F.count_if(F.col("County").isNotNull()).alias("selected"),
    )
    return seen.where(F.col("County").isNotNull())
