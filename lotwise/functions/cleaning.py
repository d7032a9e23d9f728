"""Messy listing text to typed columns. Column in, Column out, all JVM-side."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions import fixed

WHOLE_NUMBER = r"(?U)^\s*[+-]?[0-9]+\s*$"
# What Unicode counts as white space.
BLANKS = " \t\n\r\x0b\x0c\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
DECIMAL_NUMBER = r"(?U)^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*$"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed a single time per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def whole_number(text: Column) -> Column:
    """Bigint of a text that is nothing but a whole number, else NULL."""
    return F.when(text.rlike(WHOLE_NUMBER), strip(text).try_cast("bigint"))


def decimal_number(text: Column) -> Column:
    """Double of a plain decimal text (thousands commas allowed), else NULL."""
    bare = F.replace(text, F.lit(","), F.lit(""))
    return F.when(bare.rlike(DECIMAL_NUMBER), strip(bare).try_cast("double"))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def words(text: Column) -> Column:
    """Whitespace tokens, Unicode-aware; blank text gives an empty array."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


# --- prices -----------------------------------------------------------------


def price_to_int(price: Column) -> Column:
    """Listing price column (whole number or sentinel text) to bigint."""
    return whole_number(price.cast("string"))


def price_from_text(text: Column) -> Column:
    """Euro amount between the first and the second euro sign, else NULL."""
    amount = F.try_element_at(F.split(text, "€"), F.lit(2))
    return whole_number(F.replace(amount, F.lit(","), F.lit("")))


def price_or_sentinel(text: Column, on_application: Sequence[str], sentinel: str) -> Column:
    """Parsed euros as text, one spelling for "on application", else the trimmed text."""
    bare = strip(text)
    return F.coalesce(
        price_from_text(text).cast("string"),
        F.when(bare.isin(list(on_application)), F.lit(sentinel)).otherwise(bare),
    )


def price_status(text: Column, on_application: Sequence[str]) -> Column:
    return (
        F.when(price_from_text(text).isNotNull(), "parsed")
        .when(strip(text).isin(list(on_application)), "on_application")
        .when(text.isNotNull(), "other")
    )


# --- floor area -------------------------------------------------------------


def acres_to_m2(acres: Column) -> Column:
    return acres.cast("double") / F.lit(fixed.ACRES_PER_M2)


def feet_to_m2(feet: Column, per_metre: float = fixed.FEET_PER_METRE) -> Column:
    return F.round(feet / F.lit(per_metre), 2)


def is_area_text(text: Column) -> Column:
    return text.rlike("(m|ft) 2$")


def floor_area_m2(
    text: Column,
    median: float = fixed.MEDIAN_AREA_M2,
    per_metre: float = fixed.FEET_PER_METRE,
) -> Column:
    """`240m 2`, `1424ft 2` or a range `128 - 133m 2` to square metres.

    A range resolves to the end nearer to `median`, the lower one on a tie.
    """
    number = r"([\d,]*\.?\d+)"
    pattern = rf"^\s*{number}(?: - {number})?(m|ft) 2\s*$"

    def square_metres(parts: Column) -> Column:
        def metres(part: int) -> Column:
            value = decimal_number(parts[part])
            return F.when(parts[2] == "ft", feet_to_m2(value, per_metre)).otherwise(value)

        def resolve(ends: Column) -> Column:
            low, high = ends[0], ends[1]
            further_low = F.abs(F.lit(median) - low) > F.abs(F.lit(median) - high)
            return F.when(further_low, high).otherwise(low)

        return once(F.array(metres(0), metres(1)), resolve)

    return once(F.array(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]), square_metres)


# --- counties ---------------------------------------------------------------


def _is_county(word: Column, vocabulary: Sequence[str]) -> Column:
    # The word itself, or the word but for its last character (`Galway.`).
    return word.rlike(f"^({'|'.join(map(re.escape, vocabulary))}).?$")


def county_from_address(
    address: Column,
    position: int = -1,
    vocabulary: Sequence[str] = tuple(fixed.COUNTIES),
) -> Column:
    """County named in the comma part of `address` at `position` (negative from the end)."""

    def marked(raw: Column) -> Column:
        word = F.initcap(raw)
        known = _is_county(word, vocabulary)
        return F.struct(raw.alias("raw"), word.alias("word"), known.alias("known"))

    def pick(tokens: Column) -> Column:
        first, second = (F.try_element_at(tokens, F.lit(i)) for i in (1, 2))
        one = F.when(first["known"], first["word"]).when(
            F.lower(first["raw"]).contains("co."),
            F.initcap(F.substring(first["raw"], 4, 1 << 30)),
        )
        numbered = F.when(
            second["raw"].rlike(r"^[+-]?\d+$"), F.concat_ws(" ", first["word"], second["raw"])
        ).otherwise(first["word"])
        two = F.when(first["known"], numbered).when(second["known"], second["word"])
        many = F.try_element_at(F.filter(tokens, lambda t: t["known"]), F.lit(1))["word"]
        n = F.size(tokens)
        return F.when(n == 1, one).when(n == 2, two).when(n > 2, many)

    part = F.try_element_at(F.split(address, ","), F.lit(position))
    return once(F.transform(words(part), marked), pick)


def county_tokens(address: Column, position: int = -1) -> Column:
    """The words of the comma part of `address` at `position`."""
    return words(F.try_element_at(F.split(address, ","), F.lit(position)))


def county_of_tokens(tokens: Column, known: Column) -> Column:
    """The county of a part's words, given the place (from 1) of the first one that names a county, or NULL."""

    def pick(t: Column) -> Column:
        first, second = (F.try_element_at(t, F.lit(i)) for i in (1, 2))
        bare = F.when(F.lower(first).contains("co."), F.initcap(F.substring(first, 4, 1 << 30)))
        name = F.initcap(F.try_element_at(t, known))
        numbered = second.rlike(r"^[+-]?\d+$") & (known == 1) & (F.size(t) == 2)
        return F.when(known.isNull(), F.when(F.size(t) == 1, bare)).when(numbered, F.concat_ws(" ", name, second)).otherwise(name)

    return once(tokens, pick)


def county_either(address: Column, vocabulary: Sequence[str] = tuple(fixed.COUNTIES)) -> Column:
    """County of the last comma part, else of the one before it (postcode last)."""
    return F.coalesce(
        county_from_address(address, -1, vocabulary),
        county_from_address(address, -2, vocabulary),
    )


def strip_county_mark(county: Column) -> Column:
    """Drop one trailing full stop or dash."""
    return F.regexp_replace(county, r"[.\-]$", "")


def collapse_prefix(value: Column, prefix: str) -> Column:
    return F.when(value.startswith(prefix), F.lit(prefix)).otherwise(value)


def lookup_key(county: Column, district_county: str = fixed.DISTRICT_COUNTY) -> Column:
    """`Dublin 8` looks up as `Dublin`; everything else as itself."""
    first = F.split_part(county, F.lit(" "), F.lit(1))
    return F.when(first == district_county, F.lit(district_county)).otherwise(county)


def county_valid(county: Column, vocabulary: Sequence[str] = tuple(fixed.COUNTIES)) -> Column:
    return lookup_key(county).rlike(f"^({'|'.join(map(re.escape, vocabulary))})$")


# --- register fields --------------------------------------------------------

# Shapes of a date text and their formats, month first before day first.
DATE_FORMATS = {
    r"^\d{4}-": ["yyyy-M-d"],
    r"^\d{4}/": ["yyyy/M/d"],
    r"^\d+/\d+/\d{4}$": ["M/d/yyyy", "d/M/yyyy"],
    r"^\d+/\d+/\d{2}$": ["M/d/yy", "d/M/yy"],
    r"^\d+-\d+-\d{4}$": ["M-d-yyyy", "d-M-yyyy"],
    r"^\d+-\w{3}-": ["d-MMM-yyyy"],
    r"^\d+ \w{3} ": ["d MMM yyyy"],
    r"^\d+ \w{4,} ": ["d MMMM yyyy"],
    r"^\w{3} \d": ["MMM d, yyyy"],
    r"^\w{4,} \d": ["MMMM d, yyyy"],
}
WEEKDAY = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*,? +"
ORDINAL = r"^((?:\w+ )?\d{1,2})(?:st|nd|rd|th)\b"
TIME_OF_DAY = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$"


def date_from_text(text: Column, formats: Mapping[str, Sequence[str]] = DATE_FORMATS) -> Column:
    """Date of a text in one of the formats, else NULL. Only formats of its shape are tried.

    A weekday before it, a time after it and an ordinal's letters do not matter.
    """
    bare = F.regexp_replace(F.regexp_replace(strip(text), WEEKDAY, ""), TIME_OF_DAY, "")
    bare = F.regexp_replace(bare, ORDINAL, "$1")

    def parse(date: Column) -> Column:
        found = None
        for shape, tried in formats.items():
            value = F.coalesce(*[F.try_to_date(date, f) for f in tried])
            found = F.when(date.rlike(shape), value) if found is None else found.when(date.rlike(shape), value)
        return found

    return once(bare, parse)


def date_status(text: Column) -> Column:
    """Whether a text is a date."""
    return F.when(date_from_text(text).isNotNull(), "parsed").when(text.isNotNull(), "other")


def percent_from_text(text: Column) -> Column:
    """`(-3.57%)` to -3.57: without the first and the last two characters."""
    return decimal_number(F.substring(text, F.lit(2), F.length(text) - 3))


def signed_change(amount: Column, percent: Column) -> Column:
    return F.when(percent < 0, -amount).otherwise(amount)
