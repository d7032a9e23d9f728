"""Listing-shaped inputs derived from the driver's tables by literal expressions.

nation and region play county and province; part, customer and orders play
listings and registers; messy texts are built from their columns, so that an
oracle can state the expected values from the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import fixed

LISTING_TYPES = [
    "End", "Semi-D", "Semi-Detached House", "Detached House", "Terraced House", "Studio",
    "Penthouse", "Period House", "Country House", "Detached", "Terrace", "Apartment", "Cottage",
    "Mews", "Farm", "Townhouse", "Bungalow", "Duplex", "Dormer", "Live-Work Unit", "Investment",
    "Site", "House",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_text(column: Column) -> Column:
    return column.cast("string")


def nth(values: list[str], number: Column) -> Column:
    quoted = ", ".join(f"'{v}'" for v in values)
    return F.element_at(F.expr(f"array({quoted})"), (number % len(values) + 1).cast("int"))


def cases(number: Column, branches: list[Column]) -> Column:
    chosen = None
    for i, branch in enumerate(branches):
        condition = number % len(branches) == i
        chosen = F.when(condition, branch) if chosen is None else chosen.when(condition, branch)
    return chosen


def euro(amount: Column) -> Column:
    return F.concat(F.lit("€"), F.format_number(amount.cast("bigint"), 0))


def address(number: Column) -> Column:
    """One of 19 address spellings around one of the 32 counties."""
    street = F.concat(as_text(number), F.lit(" Main Street"))
    county = nth(fixed.COUNTIES, number)

    def after(*parts: str | Column) -> Column:
        return F.concat(street, *[F.lit(p) if isinstance(p, str) else p for p in parts])

    return cases(
        number,
        [
            after(", Co. ", county),
            after(", Dublin ", as_text(number % 24 + 1)),
            after(", Dublin 6W"),
            after(",   West ", county),
            after(", County ", county),
            after(",Co.", county),
            after(", ", county, "."),
            after(", Co ", county, " A82ET73"),
            after(", West ", county, ". P81P732"),
            after(", Mayor Street"),
            F.lit("The Downs, Delgany"),
            after(", Co. ", county, ", V94xap0"),
            after(", ", county, " 2"),
            after(", DUBLIN 7"),
            after(",P72 T959"),
            F.lit("Portnashangan"),
            after(","),
            F.lit(None).cast("string"),
            after(", Co. ", county),
        ],
    )


def area_text(number: Column) -> Column:
    """Metres, feet, range, missing-value text, NULL."""
    return cases(
        number,
        [
            F.concat(as_text(number % 200 + 40), F.lit("m 2")),
            F.concat(as_text(number % 3000 + 400), F.lit("ft 2")),
            F.concat(as_text(number % 40 + 60), F.lit(" - "), as_text(number % 90 + 90), F.lit("m 2")),
            F.lit("nan"),
            F.lit(None).cast("string"),
        ],
    )


def portal_a_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    price = as_text(F.floor(F.col("p_retailprice") * 500))
    return table(spark, sf_dir, "part").select(
        key.alias("src_row"),
        F.when(F.col("p_type") != "PROMO", size % 7).cast("double").alias("Bed"),
        (size % 4).cast("double").alias("Bath"),
        F.when(F.col("p_type") != "MEDIUM", size * 3.5).alias("floor_area_m2"),
        F.when(key % 10 == 0, F.lit("Price on Application"))
        .when(key % 10 == 1, F.lit("4.5"))
        .when(key % 10 == 2, F.concat(F.lit(" "), price, F.lit(" ")))
        .otherwise(price)
        .alias("Price"),
        address(key).alias("Address"),
        nth(LISTING_TYPES, key).alias("Property_type"),
        F.lit("no").alias("New_build"),
        F.floor(key / fixed.PAGE_SIZE).cast("int").alias("Page"),
    )


def portal_b_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.alias("src_row"),
        (key % 6).cast("double").alias("beds"),
        (key % 3).cast("double").alias("baths"),
        area_text(key).alias("floor_area"),
        F.when(key % 8 == 0, F.lit("PoA"))
        .when(key % 8 == 1, F.lit("nan"))
        .otherwise(as_text(F.floor(F.abs("c_acctbal")) * 100))
        .alias("Price"),
        F.when(key % 50 == 7, F.lit("nan")).otherwise(address(key)).alias("Address"),
        nth(LISTING_TYPES, key).alias("Property_type"),
        F.lit(None).cast("string").alias("New_build"),
        F.floor(key / fixed.PAGE_SIZE).cast("double").alias("Page"),
    )


def sold_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("src_row"),
        F.col("o_orderdate").cast("date").alias("Date"),
        address(F.col("o_custkey")).alias("Address"),
        F.floor("o_totalprice").alias("Price"),
        F.floor(F.col("o_orderkey") / fixed.PAGE_SIZE).cast("int").alias("Page"),
    )


def change_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = F.floor("o_totalprice")
    rise = F.when(F.col("o_orderstatus") == "F", -0.05).otherwise(0.1)
    new = old + F.floor(old * rise)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("src_row"),
        F.col("o_orderdate").cast("date").alias("Date"),
        address(F.col("o_custkey")).alias("Address"),
        new.alias("New_price"),
        old.alias("Old_price"),
        (new - old).alias("change_eur"),
        F.round((new - old) * 100 / old, 2).alias("change_pct"),
        F.floor(F.col("o_orderkey") / fixed.PAGE_SIZE).cast("int").alias("Page"),
    )


# --- pages ------------------------------------------------------------------

PAGE_HEAD = (
    '<!DOCTYPE html><html><head><title>Results</title><script>var t="</li></div>";</script></head>'
    "<body><!-- results --><img src=x><p>Unclosed<br><ul>"
)
PAGE_FOOT = "</ul><footer>&copy; end</footer></body></html>"


def _open(markup: dict, name: str, actual_class: str | None = None) -> str:
    tag, cls = markup[name]
    return f'<{tag} class="{actual_class or cls}">'


def _element(markup: dict, name: str, content: Column | str, actual_class: str | None = None):
    inner = F.lit(content) if isinstance(content, str) else content
    tag = markup[name][0]
    return F.concat(F.lit(_open(markup, name, actual_class)), inner, F.lit(f"</{tag}>"))


def _card(markup: dict, *parts: Column) -> Column:
    return F.concat(F.lit(_open(markup, "card")), *parts, F.lit(f"</{markup['card'][0]}>"))


def pages_of(cards: DataFrame, order: str) -> DataFrame:
    """PAGE_SIZE cards per page, in order. `cards` has the order column and `card`."""
    page = F.floor(F.col(order) / fixed.PAGE_SIZE)
    in_order = F.array_sort(F.collect_list(F.struct(order, "card")))
    return cards.groupBy(page.alias("page_id")).agg(
        F.concat(
            F.lit(PAGE_HEAD),
            F.array_join(F.transform(in_order, lambda c: c["card"]), "\n"),
            F.lit(PAGE_FOOT),
        ).alias("html")
    ).select("page_id", F.concat(F.lit("page/"), as_text(F.col("page_id"))).alias("url"), "html")


def portal_a_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth listing has three units, the last one without a price."""
    m = fixed.PORTAL_A_MARKUP
    key, size = F.col("p_partkey"), F.col("p_size")
    price = F.when(key % 10 == 3, F.lit(" AMV: Price on Application ")).otherwise(
        euro(F.floor(F.col("p_retailprice") * 500))
    )
    where = F.concat(F.col("p_name"), F.lit(", Co. "), nth(fixed.COUNTIES, key))
    area = F.when(key % 3 == 0, F.concat(as_text(size % 9 + 1), F.lit(" ac"))).when(
        key % 3 == 1, F.concat(as_text(size * 10), F.lit(" m²"))
    )
    kind = nth(LISTING_TYPES, key)
    single = _card(
        m,
        _element(m, "price", price),
        _element(m, "address", where),
        _element(m, "detail", F.concat(as_text(size % 7), F.lit(" Bed"))),
        _element(m, "detail", F.concat(F.lit("<b>"), as_text(size % 4), F.lit("</b> Bath"))),
        F.coalesce(_element(m, "detail", area), F.lit("")),
        _element(m, "detail", "Energy"),
        F.when(key % 7 == 0, F.lit("")).otherwise(_element(m, "kind", kind)),
    )

    def unit(extra: int, priced: bool) -> Column:
        info = F.concat(
            as_text(size % 7 + extra), F.lit(" Bed · "), as_text(size % 4 + 1), F.lit(" Bath · "), kind
        )
        amount = euro(F.floor(F.col("p_retailprice") * 500) + 1000 * extra)
        parts = [_element(m, "unit_price", amount)] if priced else []
        return _element(m, "unit", F.concat(*parts, _element(m, "unit_info", info)))

    multi = _card(m, _element(m, "multi_address", where), unit(1, True), unit(2, True), unit(3, False))
    cards = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(key % 5 == 0, multi).otherwise(single).alias("card")
    )
    return pages_of(cards, "p_partkey")


def portal_b_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details with an icon and a text have two children, areas with their raised 2 have three."""
    m = fixed.PORTAL_B_MARKUP
    key = F.col("c_custkey")
    icon = F.lit("<i></i>")

    def detail(text: Column) -> Column:
        return _element(m, "detail", F.concat(icon, F.lit(" "), text, F.lit(" ")))

    beds = F.concat(as_text(key % 6), F.when(key % 6 == 1, F.lit(" bed")).otherwise(F.lit(" beds")))
    area = cases(
        key,
        [
            F.concat(as_text(key % 200 + 40), F.lit("m <sup>2</sup>")),
            F.concat(as_text(key % 3000 + 400), F.lit("ft <sup>2</sup>")),
            F.concat(as_text(key % 9 + 1), F.lit("ac <sup>x</sup>")),
        ],
    )
    price = F.when(key % 8 == 0, F.lit("POA")).otherwise(euro(F.floor(F.abs("c_acctbal")) * 100))
    kind = cases(
        key,
        [F.lit("Apartment"), F.lit("Detached House"), F.lit("End of Terrace House"), F.lit("For Sale Now")],
    )
    card = _card(
        m,
        _element(m, "price", price, "ng-tns-c7 x ng-star-inserted"),
        _element(m, "address", F.col("c_name"), "ng-c1 PropertyListingCard__Address"),
        detail(beds),
        detail(F.concat(as_text(key % 3), F.lit(" baths"))),
        _element(m, "detail", F.concat(icon, area)),
        detail(kind),
    )
    cards = table(spark, sf_dir, "customer").select("c_custkey", card.alias("card"))
    return pages_of(cards, "c_custkey")


def sold_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some prices are on application or no price, some dates no date."""
    m = fixed.SOLD_MARKUP
    key = F.col("o_orderkey")
    price = F.when(key % 9 == 0, "POA").when(key % 9 == 1, "Sale agreed").otherwise(euro(F.floor("o_totalprice")))
    date = F.when(key % 11 == 0, "soon").otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    card = _card(
        m,
        _element(m, "address", F.concat(F.lit(" "), as_text(key), F.lit(" Main Street &amp; Sons, Cork "))),
        _element(m, "date", F.concat(F.lit(" "), date)),
        _element(m, "span", "Sold", "tag ng-star-inserted"),
        _element(m, "span", price, "ng-star-inserted price"),
    )
    cards = table(spark, sf_dir, "orders").select("o_orderkey", card.alias("card"))
    return pages_of(cards, "o_orderkey")


def change_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fixed.CHANGE_MARKUP
    sign = F.when(F.col("change_pct") < 0, F.lit("")).otherwise(F.lit("+"))
    percent = F.concat(F.lit("("), sign, as_text(F.col("change_pct")), F.lit("%)"))

    def span(content: Column) -> Column:
        return F.concat(F.lit("<span>"), content, F.lit("</span>"))

    def item(first: Column, second: Column) -> Column:
        return _element(m, "item", F.concat(span(first), F.lit("<br>"), span(second)))

    card = _card(
        m,
        _element(m, "address", F.concat(F.lit(" "), as_text(F.col("src_row")), F.lit(" Main Street, Cork "))),
        _element(m, "date", F.concat(F.lit(" "), F.date_format("Date", "d MMM yyyy"))),
        item(euro(F.abs("change_eur")), percent),
        item(euro(F.col("Old_price")), euro(F.col("New_price"))),
    )
    cards = change_raw(spark, sf_dir).select("src_row", card.alias("card"))
    return pages_of(cards, "src_row")
