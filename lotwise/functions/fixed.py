"""Vocabulary, relabel maps, sentinels, page markup."""

# County -> province.
COUNTY_PROVINCE = {
    "Antrim": "Ulster",
    "Armagh": "Ulster",
    "Cavan": "Ulster",
    "Derry": "Ulster",
    "Donegal": "Ulster",
    "Down": "Ulster",
    "Fermanagh": "Ulster",
    "Monaghan": "Ulster",
    "Tyrone": "Ulster",
    "Galway": "Connaught",
    "Leitrim": "Connaught",
    "Mayo": "Connaught",
    "Roscommon": "Connaught",
    "Sligo": "Connaught",
    "Carlow": "Leinster",
    "Dublin": "Leinster",
    "Kildare": "Leinster",
    "Kilkenny": "Leinster",
    "Laois": "Leinster",
    "Longford": "Leinster",
    "Louth": "Leinster",
    "Meath": "Leinster",
    "Offaly": "Leinster",
    "Westmeath": "Leinster",
    "Wexford": "Leinster",
    "Wicklow": "Leinster",
    "Clare": "Munster",
    "Cork": "Munster",
    "Kerry": "Munster",
    "Limerick": "Munster",
    "Tipperary": "Munster",
    "Waterford": "Munster",
}
COUNTIES = list(COUNTY_PROVINCE)

# The county that is split into numbered districts.
DISTRICT_COUNTY = "Dublin"

# False hits of the county rule, patched per register.
SOLD_COUNTY_PATCH = {"Mayor": "Dublin 1"}
CHANGE_COUNTY_PATCH = {"Downs": "Wicklow"}

# Property type spellings -> one spelling.
TYPE_RELABEL = {
    "End": "End of Terrace",
    "Semi-D": "Semi-Detached",
    "Semi-Detached House": "Semi-Detached",
    "Detached House": "Detached",
    "Terraced House": "Terrace",
    "Studio": "Apartment",
    "Penthouse": "Apartment",
    "Period House": "House",
    "Country House": "House",
}

# Property type -> category. "Null" is a literal category name.
CATEGORY_RELABEL = {
    "End of Terrace": "House",
    "Semi-Detached": "House",
    "Detached": "House",
    "Terrace": "House",
    "Studio": "Apartment",
    "Penthouse": "Apartment",
    "Period House": "House",
    "Country House": "House",
    "Cottage": "House",
    "Mews": "House",
    "Farm": "Site",
    "Townhouse": "House",
    "Bungalow": "House",
    "Duplex": "Apartment",
    "Dormer": "Null",
    "Live-Work Unit": "Null",
    "Investment": "Null",
}

# Property type with neither beds nor baths.
SITE_TYPE = "Site"

# Floor-area units and the area nearest to which a range resolves.
FEET_PER_METRE = 10.764
MEDIAN_AREA_M2 = 110
ACRES_PER_M2 = 0.00024711

# Texts that stand for a price on application, and their one spelling.
PORTAL_A_ON_APPLICATION = ["Price on Application", "AMV: Price on Application"]
PORTAL_A_SENTINEL = "Price on Application"
PORTAL_B_ON_APPLICATION = ["Price on Application", "POA", "AMV: Price on Application"]
PORTAL_B_SENTINEL = "PoA"

# Texts that mean "missing" in the extracts.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Page size of portal A.
PAGE_SIZE = 20

# Groups below this many rows are folded or removed.
SMALL_GROUP = 50

# Scatter plots show floor areas strictly below this.
SCATTER_MAX_AREA = 2000

# Explorer axis labels, category pick-list, default bounds.
AXIS_COLUMNS = {
    "Number of beds": "Beds",
    "Number of baths": "Baths",
    "Size of the property": "Floor_area",
    "Price": "Price",
}
EXPLORER_CATEGORIES = ["House", "Apartment", "Site"]
EXPLORER_BOUNDS = {
    "Beds": (0, 1),
    "Baths": (0, 1),
    "Price": (0, 100000),
    "Floor_area": (0, 200),
}

# Element addresses (tag, class) of the four page layouts.
PORTAL_A_MARKUP = {
    "card": ("li", "SearchPage__Result-gg133s-2 djuMQD"),
    "address": ("p", "TitleBlock__Address-sc-1avkvav-8 dzihyY"),
    "price": ("span", "TitleBlock__StyledSpan-sc-1avkvav-5 fKAzIL"),
    "kind": ("p", "TitleBlock__CardInfoItem-sc-1avkvav-9 cKZZql"),
    "detail": ("p", "TitleBlock__CardInfoItem-sc-1avkvav-9 iLMdur"),
    "multi_address": ("p", "TitleBlock__Address-sc-1avkvav-8 hCMmam"),
    "unit": ("div", "SubUnit__StyledCol-sc-10x486s-4 bIjqYp"),
    "unit_price": ("p", "SubUnit__Title-sc-10x486s-5 feGTKf"),
    "unit_info": ("div", "SubUnit__CardInfoItem-sc-10x486s-7 YYbRy"),
}
PORTAL_B_MARKUP = {
    "card": ("div", "mb-3 ng-star-inserted"),
    "detail": ("span", "PropertyInfoStrip__Detail PropertyInfoStrip__Detail--dark ng-star-inserted"),
    "price": ("div", "^ng-tns.*ng-star-inserted$"),
    "address": ("a", ".*PropertyListingCard"),
}
SOLD_MARKUP = {
    "card": ("div", "PriceRegisterListItem SoldPropertyListItem"),
    "address": ("a", "SoldPropertyListItem__Address"),
    "date": ("span", "PriceRegisterListItem__Date"),
    "span": ("span", "ng-star-inserted"),
}
CHANGE_MARKUP = {
    "card": ("div", "PropertyPriceChangeCard__Info MhHelper__Flex--spaced"),
    "address": ("a", "PropertyPriceChangeCard__Address"),
    "date": ("span", "PriceRegisterListItem__Date"),
    "item": ("div", "PropertyPriceChangeCard__PriceChangeItem"),
    "item_span": ("span", None),
}
