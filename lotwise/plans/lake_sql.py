"""The expected results of `lake_queries` as DuckDB SQL over the driver's tables."""

from __future__ import annotations

from lotwise.functions import fixed
from lotwise.plans.driver_sql import NULLED_EVENTS, _address, _county_either, _register

_LINE = """
    SELECT *, k::VARCHAR || ',' || CASE WHEN k % 10 = 7 THEN 'soon' ELSE '2022-01-05' END || ',' || q || k::VARCHAR
           || ' Main Street, ' || q || q || 'Cork' || q || q || q AS three,
           CASE WHEN k % 10 = 3 THEN 'x' || k::VARCHAR WHEN k % 10 = 1 THEN 'nan' ELSE (k * 1000)::VARCHAR END || ','
           || CASE WHEN k % 20 = 13 THEN 'first' ELSE (k % 20)::VARCHAR END AS two
    FROM (SELECT c_custkey AS k, chr(34) AS q FROM customer)"""

_SOLD_FILES = _register("old_p AS Price", True, fixed.SOLD_COUNTY_PATCH, True)


def _counted(rule: str, condition: str) -> str:
    return f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {condition}) AS n FROM part"


def _per_column(name: str, kind: str, column: str, top: bool = True) -> str:
    ranked = f"""(SELECT string_agg(v || ':' || n, ',' ORDER BY n DESC, v) FROM (
        SELECT {column}::VARCHAR AS v, count(*) AS n FROM e WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 3))"""
    return f"""SELECT '{name}' AS "column", '{kind}' AS dtype, count({column}) AS non_null, count(DISTINCT {column}) AS n_unique,
        {f"coalesce({ranked}, '')" if top else "NULL::VARCHAR"} AS top FROM e"""


_NAME = "'Nation_' || (c_custkey % 30)::VARCHAR"
_KNOWN = "c_custkey % 30 < 25"
# A name beside the table's that only differs in its last character counts as found: Nation_25 as Nation_2 and a 5.
_TAIL = "c_custkey % 30 BETWEEN 25 AND 29"

SQL: dict[str, str] = {
    "extract_rejects": f"""
        SELECT CASE WHEN k % 10 = 5 THEN three WHEN k % 20 = 9 THEN three || ',' || two || ',more' ELSE three || ',' || two END AS line,
               CASE WHEN k % 10 = 7 THEN 'Date' WHEN k % 20 = 13 THEN 'Price,Page' WHEN k % 10 = 3 THEN 'Price' ELSE 'fields' END AS reasons
        FROM ({_LINE}) WHERE k % 10 IN (3, 5, 7) OR k % 20 = 9""",
    "clean_sold_files": _SOLD_FILES.replace("o_orderkey AS src_row", "o_orderkey // 2 AS src_row")
    .replace("ORDER BY o_orderkey)", "ORDER BY o_orderkey % 2 DESC, o_orderkey // 2)"),
    "partition_replace": """
        SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN -c_acctbal ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey % 2 = 0""",
    "county_by_table": f"""
        WITH a AS (SELECT c_custkey, {_NAME} AS name, {_KNOWN} OR {_TAIL} AS known FROM customer)
        SELECT c_custkey, CASE c_custkey % 7
                 WHEN 0 THEN '1 Road, Co. ' || name WHEN 1 THEN '1 Road, ' || name || ' 7' WHEN 2 THEN '1 Road, ' || name || '.'
                 WHEN 3 THEN '1 Road, the ' || upper(name) || ' way' WHEN 4 THEN '1 Road, Co.Elsewhere' WHEN 5 THEN '1 Road,' END AS Address,
               CASE c_custkey % 7
                 WHEN 0 THEN CASE WHEN known THEN name END WHEN 1 THEN CASE WHEN known THEN name || ' 7' END
                 WHEN 2 THEN CASE WHEN c_custkey % 30 < 25 THEN name || '.' END WHEN 3 THEN CASE WHEN known THEN name END
                 WHEN 4 THEN 'Elsewhere' END AS County
        FROM a""",
    "province_from_file": """
        SELECT c_custkey, 'NATION_' || (c_nationkey + c_custkey % 3)::VARCHAR AS County,
               CASE WHEN r_name = 'ASIA' THEN 'outdated' ELSE r_name END AS Province
        FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
          ON n_name = 'NATION_' || (c_nationkey + c_custkey % 3)::VARCHAR""",
    "cleaning_counts": " UNION ALL ".join(
        [
            _counted("no_address", "p_partkey % 19 = 17"),
            _counted("no_county", "p_partkey % 19 IN (10, 11, 14, 15, 16)"),
            _counted("selected", "p_partkey % 19 NOT IN (10, 11, 14, 15, 16, 17)"),
        ]
    ),
    "rule_violations": f"""
        WITH c AS (
            SELECT o_orderkey AS k, {_address("o_custkey")} AS address, floor(o_totalprice)::BIGINT AS old_p,
                   floor(floor(o_totalprice) * CASE o_orderstatus WHEN 'F' THEN -0.05::DOUBLE ELSE 0.1::DOUBLE END)::BIGINT AS delta
            FROM orders),
        f AS (
            SELECT k, address, old_p + delta AS new_p, CASE WHEN k % 10 = 0 THEN 0 ELSE old_p END AS old,
                   CASE WHEN k % 7 = 0 THEN -delta ELSE delta END AS eur,
                   round(delta * 100 / old_p, 2) + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END AS pct FROM c),
        b AS (
            SELECT *, unnest([CASE WHEN address IS NULL THEN 'address' END, CASE WHEN old <= 0 THEN 'old price' END,
                       CASE WHEN new_p - old <> eur THEN 'change' END,
                       CASE WHEN abs(round((new_p - old) * 100 / nullif(old, 0), 2) - pct) >= 0.015 THEN 'percentage' END]) AS rule
            FROM f)
        SELECT k AS src_row, rule, old::VARCHAR AS value FROM b WHERE rule IS NOT NULL""",
    "distinct_sketches": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_unique, true AS within FROM events""" for c in ("event_id", "user_id", "props")
    ),
    "profile_events": f"WITH e AS ({NULLED_EVENTS}) "
    + " UNION ALL ".join(
        [
            _per_column("event_id", "bigint", "event_id"), _per_column("event_type", "string", "event_type"),
            _per_column("value", "double", "value", False), _per_column("props", "string", "props"),
        ]
    ),
    "union_widened": """
        SELECT p_size::DOUBLE AS size, p_partkey::VARCHAR || '.00' AS amount, p_name AS name FROM part
        UNION ALL
        SELECT l_quantity::DOUBLE, l_extendedprice::DECIMAL(12, 2)::VARCHAR, l_returnflag FROM lineitem WHERE l_linenumber = 1""",
    "explore_clustered": """
        SELECT l_discount AS x, l_extendedprice AS y, l_extendedprice AS Price, l_linestatus AS Property_type,
               l_returnflag AS County, count(*) OVER () AS n_selected
        FROM lineitem
        WHERE l_extendedprice BETWEEN 20000 AND 30000 AND l_quantity BETWEEN 5 AND 40 AND l_returnflag = 'N'""",
}
