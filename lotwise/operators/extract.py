"""Landed pages to listing rows: cards from the table function, everything else native."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions import cleaning, fixed
from lotwise.functions.html_cards import Address, CardSpec, cards_function


def _spec(markup: dict, patterns: tuple[str, ...] = (), scope: str | None = None) -> CardSpec:
    address = {name: Address(tag, cls, name in patterns) for name, (tag, cls) in markup.items()}
    return CardSpec(address.pop("card"), address, scope)


PORTAL_A = _spec(fixed.PORTAL_A_MARKUP, scope="unit")
PORTAL_B = _spec(fixed.PORTAL_B_MARKUP, patterns=("price", "address"))
SOLD = _spec(fixed.SOLD_MARKUP)
CHANGE = _spec(fixed.CHANGE_MARKUP, scope="item")


def page_cards(pages: DataFrame, spec: CardSpec) -> DataFrame:
    """One row per card with its page: page_id, url, card_no, hits."""
    cards = cards_function(spec)(F.col("html").outer())
    return pages.lateralJoin(cards).select("page_id", "url", "card_no", "hits")


def hits_of(field: str, scope: Column | None = None) -> Column:
    def wanted(hit: Column) -> Column:
        named = hit["field"] == field
        return named if scope is None else named & (hit["scope"] == scope)

    return F.filter("hits", wanted)


def nth_text(field: str, n: int = 1, scope: Column | None = None) -> Column:
    """Text of the n-th element of a field, NULL when there are fewer."""
    return F.try_element_at(hits_of(field, scope), F.lit(n))["text"]


# --- portal A ---------------------------------------------------------------


def _pairs(texts: Column, split_words) -> Column:
    def pair(text: Column) -> Column:
        tokens = split_words(text)
        return F.struct(
            F.try_element_at(tokens, F.lit(1)).alias("value"),
            F.try_element_at(tokens, F.lit(2)).alias("kind"),
        )

    return F.transform(texts, pair)


def _pair_value(pairs: Column, kind: str) -> Column:
    first = F.try_element_at(F.filter(pairs, lambda p: p["kind"] == kind), F.lit(1))
    return cleaning.decimal_number(first["value"])


def _pair_area(pairs: Column) -> Column:
    first = F.try_element_at(F.filter(pairs, lambda p: p["kind"].isin("m²", "ac")), F.lit(1))
    size = cleaning.decimal_number(first["value"])
    return F.when(first["kind"] == "ac", cleaning.acres_to_m2(size)).otherwise(size)


def portal_a_listings(pages: DataFrame) -> DataFrame:
    """Single listings, and one row per priced unit of a multi-unit listing."""
    single = F.col("address").isNotNull()
    units = F.transform(hits_of("unit"), lambda h: h["scope"])
    rows = (
        page_cards(pages, PORTAL_A)
        .withColumn("address", nth_text("address"))
        .withColumn("unit", F.explode(F.when(single, F.array(F.lit(-1))).otherwise(units)))
    )
    unit = F.col("unit")
    items = F.split(nth_text("unit_info", 1, unit), " · ")
    detail_texts = F.transform(hits_of("detail"), lambda h: h["text"])
    rows = rows.select(
        "page_id",
        "url",
        "card_no",
        unit,
        single.alias("single"),
        F.coalesce("address", nth_text("multi_address")).alias("Address"),
        F.when(single, nth_text("price")).otherwise(nth_text("unit_price", 1, unit)).alias("raw_price"),
        F.when(single, nth_text("kind")).otherwise(F.try_element_at(items, F.lit(-1))).alias("Property_type"),
        F.when(single, _pairs(detail_texts, cleaning.words))
        .otherwise(
            _pairs(F.slice(items, F.lit(1), F.size(items) - 1), lambda t: F.split(t, " "))
        )
        .alias("pairs"),
    ).filter(F.col("single") | F.col("raw_price").isNotNull())
    return rows.select(
        "page_id",
        "url",
        "card_no",
        F.when(~F.col("single"), F.col("unit")).alias("unit"),
        _pair_value(F.col("pairs"), "Bed").alias("Bed"),
        _pair_value(F.col("pairs"), "Bath").alias("Bath"),
        F.when(F.col("single"), _pair_area(F.col("pairs"))).alias("floor_area_m2"),
        cleaning.price_or_sentinel(
            F.col("raw_price"), fixed.PORTAL_A_ON_APPLICATION, fixed.PORTAL_A_SENTINEL
        ).alias("Price"),
        cleaning.price_status(F.col("raw_price"), fixed.PORTAL_A_ON_APPLICATION).alias("price_status"),
        "Address",
        "Property_type",
        F.when(F.col("single"), "no").otherwise("yes").alias("New_build"),
        F.col("page_id").cast("int").alias("Page"),
    )


# --- portal B ---------------------------------------------------------------


def portal_b_listings(pages: DataFrame) -> DataFrame:
    """Beds, baths, area and type told apart by the number of children and words of a detail."""
    strips = F.transform(
        F.filter(hits_of("detail"), lambda h: h["n_children"] == 2),
        lambda h: F.split(cleaning.strip(h["text"]), " "),
    )
    measured = F.filter(strips, lambda w: (F.size(w) == 2) & w[1].rlike("^(bed|bath)s?$"))

    def count_of(kind: str) -> Column:
        first = F.try_element_at(
            F.filter(measured, lambda w: w[1].startswith(kind)), F.lit(1)
        )
        return cleaning.decimal_number(F.try_element_at(first, F.lit(1)))

    def is_type(w: Column) -> Column:
        pair = (F.size(w) == 2) & ~F.try_element_at(w, F.lit(2)).rlike("^(bed|bath)s?$")
        return pair | F.size(w).isin(1, 4)

    kind = F.try_element_at(F.filter(strips, is_type), F.lit(1))
    areas = F.filter(
        hits_of("detail"), lambda h: (h["n_children"] == 3) & cleaning.is_area_text(h["text"])
    )
    return (
        page_cards(pages, PORTAL_B)
        .withColumn("raw_price", nth_text("price"))
        .select(
            "page_id",
            "url",
            "card_no",
            count_of("bed").alias("beds"),
            count_of("bath").alias("baths"),
            F.try_element_at(areas, F.lit(1))["text"].alias("floor_area"),
            cleaning.price_or_sentinel(
                F.col("raw_price"), fixed.PORTAL_B_ON_APPLICATION, fixed.PORTAL_B_SENTINEL
            ).alias("Price"),
            cleaning.price_status(F.col("raw_price"), fixed.PORTAL_B_ON_APPLICATION).alias(
                "price_status"
            ),
            nth_text("address").alias("Address"),
            F.when(F.size(kind) == 2, F.concat_ws(" ", kind))
            .otherwise(F.try_element_at(kind, F.lit(1)))
            .alias("Property_type"),
            F.lit(None).cast("string").alias("New_build"),
            F.col("page_id").cast("double").alias("Page"),
        )
    )


# --- registers --------------------------------------------------------------


def sold_register(pages: DataFrame) -> DataFrame:
    """The price is the second of the marked spans. What is no price or no date says so and keeps its text."""
    price = F.col("raw_price")
    texts = page_cards(pages, SOLD).withColumns({"raw_price": nth_text("span", 2), "raw_date": nth_text("date")})
    return texts.select(
        "page_id",
        "url",
        "card_no",
        cleaning.date_from_text(F.col("raw_date")).alias("Date"),
        cleaning.date_status(F.col("raw_date")).alias("date_status"),
        cleaning.strip(nth_text("address")).alias("Address"),
        cleaning.price_from_text(price).alias("Price"),
        *_price_outcome(price),
        F.col("page_id").cast("int").alias("Page"),
    )


def _price_outcome(raw: Column) -> list[Column]:
    return [
        cleaning.price_or_sentinel(raw, fixed.PORTAL_B_ON_APPLICATION, fixed.PORTAL_B_SENTINEL).alias("price_text"),
        cleaning.price_status(raw, fixed.PORTAL_B_ON_APPLICATION).alias("price_status"),
    ]


def change_register(pages: DataFrame) -> DataFrame:
    """First item: change in euro and percent. Second item: old and new price."""
    first, second = F.lit(0), F.lit(1)
    percent = cleaning.percent_from_text(nth_text("item_span", 2, first))
    euro = cleaning.price_from_text(nth_text("item_span", 1, first))
    texts = page_cards(pages, CHANGE).withColumns({"raw_price": nth_text("item_span", 2, second), "raw_date": nth_text("date")})
    return texts.select(
        "page_id",
        "url",
        "card_no",
        cleaning.date_from_text(F.col("raw_date")).alias("Date"),
        cleaning.date_status(F.col("raw_date")).alias("date_status"),
        nth_text("address").alias("Address"),
        cleaning.price_from_text(F.col("raw_price")).alias("New_price"),
        *_price_outcome(F.col("raw_price")),
        cleaning.price_from_text(nth_text("item_span", 1, second)).alias("Old_price"),
        cleaning.signed_change(euro, percent).alias("change_eur"),
        percent.alias("change_pct"),
        F.col("page_id").cast("int").alias("Page"),
    )
