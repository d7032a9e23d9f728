"""The expected result of each registered query as DuckDB SQL over the driver's tables.

Written from the rules and from the columns that the texts were built of,
not from the Spark expressions.
"""

from __future__ import annotations

from lotwise.functions import fixed
from lotwise.plans.renditions import LISTING_TYPES


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _nth(values, number: str) -> str:
    return f"({_list(values)})[(({number}) % {len(values)}) + 1]"


def _cases(number: str, branches) -> str:
    whens = " ".join(f"WHEN {i} THEN {b}" for i, b in enumerate(branches))
    return f"(CASE ({number}) % {len(branches)} {whens} END)"


def _relabel(value: str, labels: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"(CASE {value} {whens} ELSE {value} END)"


COUNTY_DIM = ", ".join(f"('{c}', '{p}')" for c, p in fixed.COUNTY_PROVINCE.items())


def _address(n: str) -> str:
    x, street = _nth(fixed.COUNTIES, n), f"({n})::VARCHAR || ' Main Street'"
    return _cases(
        n,
        [
            f"{street} || ', Co. ' || {x}",
            f"{street} || ', Dublin ' || (({n}) % 24 + 1)::VARCHAR",
            f"{street} || ', Dublin 6W'",
            f"{street} || ',   West ' || {x}",
            f"{street} || ', County ' || {x}",
            f"{street} || ',Co.' || {x}",
            f"{street} || ', ' || {x} || '.'",
            f"{street} || ', Co ' || {x} || ' A82ET73'",
            f"{street} || ', West ' || {x} || '. P81P732'",
            f"{street} || ', Mayor Street'",
            "'The Downs, Delgany'",
            f"{street} || ', Co. ' || {x} || ', V94xap0'",
            f"{street} || ', ' || {x} || ' 2'",
            f"{street} || ', DUBLIN 7'",
            f"{street} || ',P72 T959'",
            "'Portnashangan'",
            f"{street} || ','",
            "NULL",
            f"{street} || ', Co. ' || {x}",
        ],
    )


def _county_last(n: str, dotted: bool = True) -> str:
    """County at the last comma; `dotted` keeps the mark that the unstripped rule leaves."""
    x, mark = _nth(fixed.COUNTIES, n), " || '.'" if dotted else ""
    return _cases(
        n,
        [
            x, f"'Dublin ' || (({n}) % 24 + 1)::VARCHAR", "'Dublin'", x, x, x, f"{x}{mark}", x,
            f"{x}{mark}", "'Mayor'", "NULL", "NULL", f"{x} || ' 2'", "'Dublin 7'", "NULL", "NULL",
            "NULL", "NULL", x,
        ],
    )


def _county_before(n: str) -> str:
    x = _nth(fixed.COUNTIES, n)
    return _cases(n, ["NULL"] * 10 + ["'Downs'", x] + ["NULL"] * 7)


def _county_either(n: str, dotted: bool, patch: dict[str, str]) -> str:
    return _relabel(f"coalesce({_county_last(n, dotted)}, {_county_before(n)})", patch)


def _with_province(body: str, columns: str = "t.*", county: str = "County", province: str = "Province"):
    """`body` selects the rows that have a county."""
    return f"""
        WITH dim(c, p) AS (VALUES {COUNTY_DIM}), t AS ({body})
        SELECT {columns}, dim.p AS {province} FROM t LEFT JOIN dim
        ON dim.c = CASE WHEN t.{county} LIKE 'Dublin %' THEN 'Dublin' ELSE t.{county} END"""


PORTAL_A = f"""
    SELECT p_partkey AS src_row,
           CASE WHEN typ = 'Site' THEN 0 WHEN p_type <> 'PROMO' THEN p_size % 7 END::DOUBLE AS Bed,
           CASE WHEN typ = 'Site' THEN 0 ELSE p_size % 4 END::DOUBLE AS Bath,
           CASE WHEN p_type <> 'MEDIUM' THEN (p_size * 3.5)::DOUBLE END AS floor_area_m2,
           CASE WHEN p_partkey % 10 > 1 THEN floor(p_retailprice * 500)::BIGINT END AS Price,
           {_address('p_partkey')} AS Address, typ AS Property_type, 'no' AS New_build,
           (p_partkey // 20)::INTEGER AS Page, {_county_last('p_partkey')} AS County
    FROM (SELECT *, {_nth(LISTING_TYPES, 'p_partkey')} AS typ FROM part)
    WHERE {_county_last('p_partkey')} IS NOT NULL"""

PORTAL_B = f"""
    SELECT c_custkey AS src_row, (c_custkey % 6)::DOUBLE AS beds, (c_custkey % 3)::DOUBLE AS baths,
           CASE c_custkey % 5
             WHEN 0 THEN (c_custkey % 200 + 40)::DOUBLE
             WHEN 1 THEN round((c_custkey % 3000 + 400)::DOUBLE / 10.764::DOUBLE, 2)
             WHEN 2 THEN CASE WHEN 110 - (c_custkey % 40 + 60) <= abs(110 - (c_custkey % 90 + 90))
                              THEN c_custkey % 40 + 60 ELSE c_custkey % 90 + 90 END::DOUBLE
           END AS floor_area,
           CASE WHEN c_custkey % 8 > 1 THEN floor(abs(c_acctbal))::BIGINT * 100 END AS Price,
           {_address('c_custkey')} AS Address, {_nth(LISTING_TYPES, 'c_custkey')} AS Property_type,
           (c_custkey // 20)::DOUBLE AS Page, {_county_last('c_custkey', dotted=False)} AS County
    FROM customer
    WHERE c_custkey % 50 <> 7 AND {_county_last('c_custkey')} IS NOT NULL"""

A_PROVINCE, B_PROVINCE = _with_province(PORTAL_A), _with_province(PORTAL_B)

ALL_LISTINGS = f"""
    WITH both_portals AS (
        SELECT Bed AS Beds, Bath AS Baths, floor_area_m2 AS Floor_area, Price, Address,
               Property_type, County, Province FROM ({A_PROVINCE})
        UNION ALL
        SELECT beds, baths, floor_area, Price, Address, Property_type, County, Province
        FROM ({B_PROVINCE})
    ), spelled AS (
        SELECT * REPLACE ({_relabel('Property_type', fixed.TYPE_RELABEL)} AS Property_type)
        FROM both_portals
        WHERE Beds IS NOT NULL AND Baths IS NOT NULL AND Floor_area IS NOT NULL
          AND Price IS NOT NULL AND Province IS NOT NULL AND Property_type IS NOT NULL
    )
    SELECT DISTINCT *, {_relabel('Property_type', fixed.CATEGORY_RELABEL)} AS Property_Category
    FROM spelled"""

COMBINE_AND_FOLD = f"""
    WITH both_portals AS (
        SELECT 0 AS source, src_row, Bed, Bath, floor_area_m2 AS Floor_area, Price, Address,
               Property_type, County, Province FROM ({A_PROVINCE})
        UNION ALL
        SELECT 1, src_row, beds, baths, floor_area, Price, Address, Property_type, County, Province
        FROM ({B_PROVINCE})
    ), by_address AS (
        SELECT * FROM both_portals
        QUALIFY row_number() OVER (PARTITION BY Address ORDER BY source, src_row) = 1
    ), unique_rows AS (
        SELECT * FROM by_address
        QUALIFY row_number() OVER (PARTITION BY Bed, Bath, Floor_area, Price, Property_type, County
                                   ORDER BY source, src_row) = 1
    ), counted AS (SELECT *, count(*) OVER (PARTITION BY County) AS n FROM unique_rows)
    SELECT Bed, Bath, Floor_area, Price, Address, Property_type, Province,
           CASE WHEN n < 50 THEN 'Dublin' ELSE County END AS County
    FROM counted WHERE n >= 50 OR starts_with(County, 'Dublin')"""


def _register(columns: str, dotted: bool, patch: dict[str, str], first: bool) -> str:
    qualify = "QUALIFY row_number() OVER (PARTITION BY Address ORDER BY o_orderkey) = 1" if first else ""
    return _with_province(
        f"""SELECT o_orderkey AS src_row, o_orderdate::DATE AS Date, Address, {columns},
                   (o_orderkey // 20)::INTEGER AS Page,
                   {_county_either('o_custkey', dotted, patch)} AS County
            FROM (SELECT *, {_address('o_custkey')} AS Address, floor(o_totalprice)::BIGINT AS old_p,
                         floor(floor(o_totalprice)
                               * CASE o_orderstatus WHEN 'F' THEN -0.05::DOUBLE ELSE 0.1::DOUBLE END
                         )::BIGINT AS delta
                  FROM orders)
            WHERE {_county_either('o_custkey', dotted, patch)} IS NOT NULL {qualify}"""
    )


CHANGE_COLUMNS = """old_p + delta AS New_price, old_p AS Old_price, delta AS change_eur,
                    round(delta * 100 / old_p, 2) AS change_pct"""

NULLED_EVENTS = """
    SELECT event_id, CASE WHEN event_id % 11 <> 3 THEN event_type END AS event_type,
           CASE WHEN event_id % 7 <> 2 THEN value END AS value,
           CASE WHEN event_id % 5 <> 4 THEN props END AS props FROM events"""

CUSTOMER_NATIONS = """
    SELECT c_custkey, n_name AS nation, count(*) OVER (PARTITION BY n_name) AS n,
           (SELECT count(*) FROM customer) // (SELECT count(*) FROM nation) AS below
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""


def _eight(column: str, name: str) -> str:
    return f"""count({column}) AS {name}_count, round(avg({column}), 4) AS {name}_mean,
        round(stddev_samp({column}), 4) AS {name}_std, round(min({column}), 4) AS {name}_min,
        round(quantile_cont({column}, 0.25), 4) AS {name}_p25,
        round(quantile_cont({column}, 0.5), 4) AS {name}_p50,
        round(quantile_cont({column}, 0.75), 4) AS {name}_p75, round(max({column}), 4) AS {name}_max"""


def _regional(column: str) -> str:
    return f"""count({column}) AS {column}_count, round(avg({column}::DOUBLE), 4) AS {column}_mean,
        round(stddev_samp({column}::DOUBLE), 4) AS {column}_std, round(min({column}::DOUBLE), 4) AS {column}_min,
        round(quantile_cont({column}::DOUBLE, 0.25), 4) AS {column}_p25,
        round(quantile_cont({column}::DOUBLE, 0.5), 4) AS {column}_median,
        round(quantile_cont({column}::DOUBLE, 0.75), 4) AS {column}_p75,
        round(max({column}::DOUBLE), 4) AS {column}_max"""


def _per_column(table: str, columns: dict[str, str], select: str) -> str:
    # In `select`, {c} is the column and {t} its type name.
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {select.format(c=c, t=t)} FROM ({table})"
        for c, t in columns.items()
    )


EVENT_TYPES = {"event_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
ORDER_NUMBERS = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
ORDER_TEXTS = {"o_orderstatus": "string", "o_orderdate": "timestamp", "o_orderpriority": "string"}


def _text(html: str) -> str:
    # These references count with and without their semicolon.
    for entity, character in {"&lt": "<", "&gt": ">", "&quot": '"', "&#39": "''", "&amp": "&"}.items():
        html = f"regexp_replace({html}, '{entity};?', '{character}', 'g')"
    return html


A_SINGLE_PRICE = "floor(p_retailprice * 500)::BIGINT"


def _unit_rows(unit: int) -> str:
    return f"""SELECT {unit - 1} AS unit, (p_size % 7 + {unit})::DOUBLE AS Bed,
        (p_size % 4 + 1)::DOUBLE AS Bath, NULL::DOUBLE AS floor_area_m2,
        ({A_SINGLE_PRICE} + {unit * 1000})::VARCHAR AS Price, 'parsed' AS price_status,
        'yes' AS New_build, p_partkey, {_nth(LISTING_TYPES, 'p_partkey')} AS Property_type
        FROM part WHERE p_partkey % 5 = 0"""


PAGE_LISTINGS_A = f"""
    WITH listings AS (
        SELECT NULL::INTEGER AS unit, (p_size % 7)::DOUBLE AS Bed, (p_size % 4)::DOUBLE AS Bath,
               round(CASE p_partkey % 3 WHEN 0 THEN (p_size % 9 + 1)::DOUBLE / 0.00024711::DOUBLE
                                        WHEN 1 THEN (p_size * 10)::DOUBLE END, 4) AS floor_area_m2,
               CASE WHEN p_partkey % 10 = 3 THEN 'Price on Application'
                    ELSE {A_SINGLE_PRICE}::VARCHAR END AS Price,
               CASE WHEN p_partkey % 10 = 3 THEN 'on_application' ELSE 'parsed' END AS price_status,
               'no' AS New_build, p_partkey,
               CASE WHEN p_partkey % 7 <> 0 THEN {_nth(LISTING_TYPES, 'p_partkey')} END AS Property_type
        FROM part WHERE p_partkey % 5 <> 0
        UNION ALL {_unit_rows(1)} UNION ALL {_unit_rows(2)}
    )
    SELECT listings.* EXCLUDE (p_partkey), p_partkey // 20 AS page_id,
           (p_partkey % 20)::INTEGER AS card_no, (p_partkey // 20)::INTEGER AS Page,
           p_name || ', Co. ' || {_nth(fixed.COUNTIES, 'p_partkey')} AS Address
    FROM listings JOIN part USING (p_partkey)"""

SQL: dict[str, str] = {
    "region_nation_stats": f"""
        SELECT r_name AS region,
               CASE WHEN starts_with(n_name, 'NATION_1') THEN 'NATION_1' ELSE n_name END AS nation,
               {_eight('o_totalprice', 'price')}
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
    "lineitem_measure_stats": f"""
        SELECT l_returnflag, l_linestatus, {_eight('l_quantity', 'l_quantity')},
               {_eight('l_extendedprice', 'l_extendedprice')}, {_eight('l_discount', 'l_discount')}
        FROM lineitem GROUP BY 1, 2""",
    "regional_stats": f"""
        SELECT Province, CASE WHEN starts_with(County, 'Dublin') THEN 'Dublin' ELSE County END AS County,
               {_regional('Beds')}, {_regional('Baths')}, {_regional('Floor_area')}, {_regional('Price')}
        FROM ({ALL_LISTINGS}) GROUP BY 1, 2""",
    "price_parse": """
        SELECT o_orderkey,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN n::VARCHAR
                    WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'PoA'
                    ELSE 'From €' || format('{:,}', n) || ' to €' || format('{:,}', n + 5000)
               END AS price_text,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN n END AS price,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'parsed'
                    WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'on_application'
                    ELSE 'other' END AS price_status
        FROM (SELECT *, floor(o_totalprice)::BIGINT AS n FROM orders)""",
    "floor_area_m2": """
        SELECT p_partkey,
               CASE WHEN p_partkey % 7 IN (0, 1, 2, 3) THEN TRUE
                    WHEN p_partkey % 7 IN (4, 5) THEN FALSE END AS is_area,
               round(CASE p_partkey % 7
                 WHEN 0 THEN (p_size * 5)::DOUBLE
                 WHEN 1 THEN round((p_size * 97)::DOUBLE / 10.764::DOUBLE, 2)
                 WHEN 2 THEN CASE WHEN abs(110 - (p_size + 60)) <= abs(110 - p_size * 4)
                                  THEN p_size + 60 ELSE p_size * 4 END::DOUBLE
                 WHEN 3 THEN CASE WHEN abs(110 - a) <= abs(110 - b) THEN a ELSE b END
                 WHEN 4 THEN p_size::DOUBLE / 0.00024711::DOUBLE END, 2) AS floor_area_m2
        FROM (SELECT *, round((p_size * 20)::DOUBLE / 10.764::DOUBLE, 2) AS a,
                     round((p_size * 20 + 500)::DOUBLE / 10.764::DOUBLE, 2) AS b FROM part)""",
    "county_extract": _with_province(
        f"""SELECT c_custkey, {_county_last('c_custkey')} AS county_last,
                   {_county_before('c_custkey')} AS county_before,
                   {_county_either('c_custkey', False,
                                   {**fixed.SOLD_COUNTY_PATCH, **fixed.CHANGE_COUNTY_PATCH})} AS county
            FROM customer""",
        """c_custkey, county_last, county_before, county,
           CASE WHEN county LIKE '% 2' AND county NOT LIKE 'Dublin %' THEN FALSE
                WHEN county IS NOT NULL THEN TRUE END AS valid""",
        "county",
        "province",
    ),
    "conditional_zero": """
        SELECT p_partkey, p_type, CASE WHEN p_type = 'ECONOMY' THEN 0 ELSE p_size END AS p_size,
               CASE WHEN p_type = 'ECONOMY' THEN 0.0 ELSE p_retailprice END::DOUBLE AS p_retailprice
        FROM part""",
    "type_category": f"""
        WITH raw AS (SELECT {_nth(LISTING_TYPES, 'p_partkey + p_size')} AS t FROM part),
             spelled AS (SELECT {_relabel('t', fixed.TYPE_RELABEL)} AS Property_type FROM raw)
        SELECT Property_type, {_relabel('Property_type', fixed.CATEGORY_RELABEL)} AS Property_Category,
               count(*) AS "count" FROM spelled GROUP BY 1, 2""",
    "null_tokens": NULLED_EVENTS,
    "complete_cases": f"""
        SELECT * FROM ({NULLED_EVENTS})
        WHERE event_type IS NOT NULL AND value IS NOT NULL AND props IS NOT NULL""",
    "price_change_signed": """
        WITH ends AS (
            SELECT *, floor(l_extendedprice)::BIGINT AS high,
                   floor(l_extendedprice * (1 - l_discount))::BIGINT AS low FROM lineitem),
        priced AS (
            SELECT *, CASE WHEN l_returnflag = 'R' THEN high ELSE low END AS New_price,
                   CASE WHEN l_returnflag = 'R' THEN low WHEN l_linenumber = 5 THEN 0 ELSE high END AS Old_price FROM ends)
        SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS date, New_price, Old_price,
               New_price - Old_price AS change_eur,
               round((New_price - Old_price) * 100 / nullif(Old_price, 0), 2) * CASE l_linenumber WHEN 7 THEN 2 ELSE 1 END
                   AS change_pct,
               CASE WHEN Old_price <> 0 THEN l_linenumber <> 7 OR New_price = Old_price END AS consistent
        FROM priced""",
    "province_lookup": """
        WITH c AS (
            SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'NATION_1 8'
                ELSE 'NATION_' || (c_nationkey + c_custkey % 3)::VARCHAR END AS nation FROM customer)
        SELECT c_custkey, nation, r_name AS region FROM c
        JOIN nation ON n_name = CASE WHEN nation = 'NATION_1 8' THEN 'NATION_1' ELSE nation END
        JOIN region ON n_regionkey = r_regionkey""",
    "fold_small_groups": f"""
        SELECT c_custkey, CASE WHEN n < below THEN 'NATION_1' ELSE nation END AS nation
        FROM ({CUSTOMER_NATIONS}) WHERE n >= below OR starts_with(nation, 'NATION_1')""",
    "exclude_small_groups": f"SELECT c_custkey, nation FROM ({CUSTOMER_NATIONS}) WHERE n >= below",
    "group_counts": """
        SELECT l_returnflag, l_linestatus, count(*) AS "count" FROM lineitem GROUP BY 1, 2""",
    "bottom_k_groups": """
        SELECT n_name AS nation, count(*) AS "count"
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1 ORDER BY 2, 1 LIMIT 5""",
    "preview_rows": """
        SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
        ORDER BY o_totalprice, o_orderkey LIMIT 20""",
    "lookup_last_wins": """
        SELECT c_custkey, c_nationkey, s_name FROM customer LEFT JOIN (
            SELECT s_nationkey, s_name FROM supplier
            QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey DESC) = 1)
        ON c_nationkey = s_nationkey""",
    "value_counts": """
        SELECT o_orderpriority AS priority, count(*) AS "count" FROM orders
        WHERE o_orderpriority <> '5-LOW' GROUP BY 1 ORDER BY 2 DESC, 1""",
    "distinct_values": "SELECT DISTINCT user_id FROM events ORDER BY 1",
    "union_listings": """
        SELECT c_name AS name, c_nationkey::DOUBLE AS nationkey, c_acctbal AS acctbal FROM customer
        UNION SELECT s_name, s_nationkey::DOUBLE, s_acctbal FROM supplier""",
    "append_listings": """
        SELECT c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS acctbal FROM customer
        UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier""",
    "distinct_rows": "SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem",
    "dedup_any": "SELECT DISTINCT user_id, event_type FROM events",
    "dedup_first": """
        SELECT event_id, user_id, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "dedup_two_stage": """
        WITH by_text AS (
            SELECT * FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
        SELECT doc_id, lang, source, n_chars FROM by_text
        QUALIFY row_number() OVER (PARTITION BY lang, source, n_chars ORDER BY doc_id) = 1""",
    "explore_range": """
        SELECT l_discount AS x, l_extendedprice AS y, l_extendedprice AS Price,
               l_linestatus AS Property_type, l_returnflag AS County, count(*) OVER () AS n_selected
        FROM lineitem
        WHERE l_linenumber >= 2 AND l_linenumber <= 5 AND l_quantity >= 5 AND l_quantity <= 40
          AND l_extendedprice >= 10000 AND l_extendedprice <= 60000
          AND l_discount >= 0.02 AND l_discount <= 0.07 AND l_returnflag = 'N' AND l_linestatus = 'O'""",
    "explore_count": """
        SELECT count(*) AS n_selected FROM lineitem
        WHERE l_linenumber >= 1 AND l_linenumber <= 6 AND l_quantity >= 1 AND l_quantity <= 30
          AND l_extendedprice >= 0 AND l_extendedprice <= 50000
          AND l_discount >= 0 AND l_discount <= 0.05""",
    "explore_partial": """
        SELECT l_discount AS x, l_extendedprice AS y, l_extendedprice AS Price,
               l_linestatus AS Property_type, l_returnflag AS County, count(*) OVER () AS n_selected
        FROM lineitem WHERE l_linenumber >= 2 AND l_linenumber <= 4 AND l_linestatus = 'O'""",
    "scatter_data": """
        SELECT l_quantity::VARCHAR AS x, l_extendedprice AS y FROM lineitem
        WHERE l_extendedprice < 50000""",
    "scatter_axis": """
        SELECT l_quantity::VARCHAR AS x FROM lineitem WHERE l_extendedprice < 50000
        GROUP BY l_quantity ORDER BY l_quantity""",
    "explore_listings": f"""
        SELECT Beds AS x, Price AS y, Price, Property_type, County, count(*) OVER () AS n_selected
        FROM ({ALL_LISTINGS})
        WHERE Beds >= 1 AND Beds <= 6 AND Baths >= 0 AND Baths <= 4 AND Price >= 0
          AND Price <= 600000 AND Floor_area >= 0 AND Floor_area <= 150
          AND Property_Category = 'House'""",
    "scatter_listings": f"""
        SELECT Floor_area AS x, Price AS y FROM ({ALL_LISTINGS}) WHERE Floor_area < 2000""",
    "profile_nulls": _per_column(NULLED_EVENTS, EVENT_TYPES, "'{t}' AS dtype, count({c}) AS non_null"),
    "profile_nunique": _per_column(NULLED_EVENTS, EVENT_TYPES, "count(DISTINCT {c}) AS n_unique"),
    "profile_describe": _per_column(
        "SELECT * FROM orders",
        ORDER_NUMBERS,
        """count({c}) AS "count", trunc(avg({c}))::BIGINT AS mean,
           trunc(stddev_samp({c}))::BIGINT AS std, trunc(min({c}))::BIGINT AS min,
           trunc(quantile_cont({c}::DOUBLE, 0.25))::BIGINT AS p25,
           trunc(quantile_cont({c}::DOUBLE, 0.5))::BIGINT AS p50,
           trunc(quantile_cont({c}::DOUBLE, 0.75))::BIGINT AS p75, trunc(max({c}))::BIGINT AS max""",
    ),
    "describe_table": _per_column(
        "SELECT * FROM orders",
        ORDER_NUMBERS,
        """count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
           min({c})::VARCHAR AS min, max({c})::VARCHAR AS max""",
    )
    + " UNION ALL "
    + _per_column(
        "SELECT * FROM orders",
        ORDER_TEXTS,
        """count({c}) AS "count", NULL::DOUBLE AS mean, NULL::DOUBLE AS stddev,
           min({c})::VARCHAR AS min, max({c})::VARCHAR AS max""",
    ),
    "orphan_rows": """
        SELECT c_custkey AS src_row, CASE c_custkey % 5
             WHEN 0 THEN (c_custkey % 200 + 40)::VARCHAR || 'm 2'
             WHEN 1 THEN (c_custkey % 3000 + 400)::VARCHAR || 'ft 2'
             ELSE (c_custkey % 40 + 60)::VARCHAR || ' - ' || (c_custkey % 90 + 90)::VARCHAR || 'm 2'
           END AS floor_area
        FROM customer
        WHERE c_custkey % 5 < 3
          AND (c_custkey % 13 = 0
               OR (c_custkey % 8 = 1 AND (c_custkey % 50 = 7 OR c_custkey % 19 = 17)))""",
    "page_frontier": """
        SELECT i AS page_id,
               'https://listings.example.com/for-sale?from=' || (i * 20)::VARCHAR || '&pageSize=20'
                 AS offset_url,
               'https://listings.example.com/sold/page-' || i::VARCHAR AS numbered_url
        FROM (SELECT DISTINCT page_id AS i FROM pages)""",
    "page_cards": f"""
        WITH found AS (
            SELECT page_id, regexp_extract_all(html, '<li>.*?</li>') AS cards FROM pages),
        numbered AS (
            SELECT page_id, unnest(cards) AS card,
                   (generate_subscripts(cards, 1) - 1)::INTEGER AS card_no FROM found)
        SELECT page_id, card_no, {_text("regexp_extract(card, 'href=\"([^\"]*)\"', 1)")} AS href,
               {_text("regexp_extract(card, '<a [^>]*>([^<]*)</a>', 1)")} AS text
        FROM numbered""",
    "page_fields": f"""
        SELECT page_id, {_text("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
               {_text("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS heading,
               {_text("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS ad,
               NULL::VARCHAR AS price, len(regexp_extract_all(html, '<p>')) AS n_paragraphs
        FROM pages""",
    "page_listings": PAGE_LISTINGS_A,
    "page_listings_b": """
        SELECT c_custkey // 20 AS page_id, (c_custkey % 20)::INTEGER AS card_no,
               (c_custkey % 6)::DOUBLE AS beds, (c_custkey % 3)::DOUBLE AS baths,
               CASE c_custkey % 3 WHEN 0 THEN (c_custkey % 200 + 40)::VARCHAR || 'm 2'
                                  WHEN 1 THEN (c_custkey % 3000 + 400)::VARCHAR || 'ft 2'
               END AS floor_area,
               CASE WHEN c_custkey % 8 = 0 THEN 'PoA'
                    ELSE (floor(abs(c_acctbal))::BIGINT * 100)::VARCHAR END AS Price,
               CASE WHEN c_custkey % 8 = 0 THEN 'on_application' ELSE 'parsed' END AS price_status,
               c_name AS Address,
               CASE c_custkey % 4 WHEN 0 THEN 'Apartment' WHEN 1 THEN 'Detached House'
                                  WHEN 2 THEN 'End' END AS Property_type,
               (c_custkey // 20)::DOUBLE AS Page
        FROM customer""",
    "page_sold": """
        SELECT o_orderkey // 20 AS page_id, (o_orderkey % 20)::INTEGER AS card_no,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate::DATE END AS Date,
               CASE WHEN o_orderkey % 11 <> 0 THEN 'parsed' ELSE 'other' END AS date_status,
               o_orderkey::VARCHAR || ' Main Street & Sons, Cork' AS Address,
               CASE WHEN o_orderkey % 9 > 1 THEN floor(o_totalprice)::BIGINT END AS Price,
               CASE o_orderkey % 9 WHEN 0 THEN 'PoA' WHEN 1 THEN 'Sale agreed' ELSE floor(o_totalprice)::BIGINT::VARCHAR END
                 AS price_text,
               CASE o_orderkey % 9 WHEN 0 THEN 'on_application' WHEN 1 THEN 'other' ELSE 'parsed' END AS price_status,
               (o_orderkey // 20)::INTEGER AS Page
        FROM orders""",
    "page_changes": """
        SELECT o_orderkey // 20 AS page_id, (o_orderkey % 20)::INTEGER AS card_no,
               o_orderdate::DATE AS Date, 'parsed' AS date_status,
               ' ' || o_orderkey::VARCHAR || ' Main Street, Cork ' AS Address,
               (old_p + delta)::VARCHAR AS price_text, 'parsed' AS price_status, old_p + delta AS New_price, old_p AS Old_price, delta AS change_eur,
               round(delta * 100 / old_p, 2) AS change_pct, (o_orderkey // 20)::INTEGER AS Page
        FROM (SELECT *, floor(o_totalprice)::BIGINT AS old_p,
                     floor(floor(o_totalprice)
                           * CASE o_orderstatus WHEN 'F' THEN -0.05::DOUBLE ELSE 0.1::DOUBLE END
                     )::BIGINT AS delta FROM orders)""",
    "clean_portal_a": A_PROVINCE,
    "clean_portal_b": B_PROVINCE,
    "clean_sold": _register("old_p AS Price", True, fixed.SOLD_COUNTY_PATCH, True),
    "clean_change": _register(CHANGE_COLUMNS, False, fixed.CHANGE_COUNTY_PATCH, True),
    "clean_change_history": _register(CHANGE_COLUMNS, False, fixed.CHANGE_COUNTY_PATCH, False),
    "build_all_listings": ALL_LISTINGS,
    "combine_and_fold": COMBINE_AND_FOLD,
    "csv_roundtrip": """
        SELECT c_custkey AS src_row, c_acctbal AS Bed, NULL::DOUBLE AS Bath, 1.5::DOUBLE AS floor_area_m2,
               NULL::VARCHAR AS Price, '"' || c_name || '", ' || c_mktsegment AS Address,
               NULL::VARCHAR AS Property_type, 'no' AS New_build, c_nationkey AS Page
        FROM customer""",
}
