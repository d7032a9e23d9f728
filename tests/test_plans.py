"""What the physical plans must and must not hold."""

import re

from lotwise.plans import pipelines, renditions
from lotwise.plans.driver_queries import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (hash|range|Single|Round)", text))


def test_portal_cleaning_is_one_stage_with_the_county_computed_once(spark, sf_dir):
    for clean, raw in [
        (pipelines.clean_portal_a, renditions.portal_a_raw),
        (pipelines.clean_portal_b, renditions.portal_b_raw),
    ]:
        text = plan(clean(raw(spark, sf_dir)))
        assert shuffles(text) == 0
        assert text.count("BroadcastExchange") == 1
        # The county expression is the only one that splits on white space.
        assert text.count(r"(?U)\s+") == 1


def test_registers_shuffle_once_and_limit_groups_before(spark, sf_dir):
    text = plan(pipelines.clean_sold(renditions.sold_raw(spark, sf_dir)))
    assert shuffles(text) == 1
    assert text.index("row_number(), 1, Final") < text.index("Exchange hash") < text.index("row_number(), 1, Partial")


def test_explorer_pushes_its_ranges_to_the_scan(spark, sf_dir):
    text = plan(QUERIES["explore_range"](spark, sf_dir))
    pushed = re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", text)
    assert len(pushed) == 2
    for filters in pushed:
        for condition in ("GreaterThanOrEqual(l_quantity,5.0)", "LessThanOrEqual(l_extendedprice,60000.0)", "EqualTo(l_returnflag,N)"):
            assert condition in filters
    assert "SinglePartition" not in text.split("Subquery")[0]


def test_scans_read_only_what_is_needed(spark, sf_dir):
    text = plan(QUERIES["bottom_k_groups"](spark, sf_dir))
    assert "ReadSchema: struct<c_nationkey:int>" in text
    assert "TakeOrderedAndProject" in text


def test_documents_are_not_shuffled_with_their_text(spark, sf_dir):
    text = plan(QUERIES["dedup_two_stage"](spark, sf_dir))
    above_scan = text[: text.index("sha2(")]
    assert "text#" not in above_scan
