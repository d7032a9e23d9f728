import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotwise.functions import fixed
from lotwise.operators import dedup, groups, lookup, profile, quantiles, relabel
from lotwise.operators.staging import scratch_root
from lotwise.sources import files, frontier


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- repeats ------------------------------------------------------------------


def test_keep_first_takes_the_earliest_row_and_treats_nulls_as_equal(spark):
    df = spark.createDataFrame(
        [("a", 3, "x"), ("a", 1, "y"), (None, 5, "p"), (None, 4, "q"), ("b", 2, "z")], "k string, n int, v string"
    )
    first = dedup.keep_first(df, ["k"], ["n"])
    assert rows(first, "n") == [("a", 1, "y"), ("b", 2, "z"), (None, 4, "q")]
    assert rows(dedup.keep_first(first, ["k"], ["n"]), "n") == rows(first, "n")


def test_keep_first_with_a_hot_key(spark):
    df = spark.range(0, 90000, 1, 16).selectExpr("if(id % 3 = 0, -1, id) AS k", "90000 - id AS n")
    assert dedup.keep_first(df, ["k"], ["n"]).count() == 60001
    hot = dedup.keep_first(df, ["k"], ["n"]).filter("k = -1").collect()
    assert [tuple(r) for r in hot] == [(-1, 3)]


def test_two_stage(spark):
    df = spark.createDataFrame([(1, "a", 7), (2, "a", 8), (3, "b", 7), (4, "c", 8)], "i int, k string, v int")
    assert rows(dedup.keep_first_twice(df, ["k"], ["v"], ["i"]), "i") == [(1, "a", 7), (4, "c", 8)]


def test_union_checks_columns_and_widens(spark):
    left = spark.createDataFrame([(1, "a")], "n bigint, s string")
    right = spark.createDataFrame([(1.5, "b")], "n double, s string")
    both = dedup.union_aligned(left, right)
    assert both.dtypes == [("n", "double"), ("s", "string")] and both.count() == 2
    with pytest.raises(ValueError):
        dedup.union_aligned(left, right.select("s", "n"))
    appended = dedup.append_by_name(left, right.withColumn("extra", F.lit(1)))
    assert rows(appended, "n") == [(1.0, "a", None), (1.5, "b", 1)]


def test_full_row_and_keyed_distinct(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3.0)], "a int, b double")
    assert dedup.keep_any(df).count() == 2
    assert dedup.keep_any(df, ["b"]).count() == 2


# --- relabels -----------------------------------------------------------------


def test_category_of_types(spark):
    types = ["Semi-D", "End", "Studio", "Farm", "Dormer", "Site", "Castle", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(types)], "i int, Property_type string")
    got = rows(relabel.add_category(df), "i")
    assert [r[1:] for r in got] == [
        ("Semi-Detached", "House"), ("End of Terrace", "House"), ("Apartment", "Apartment"), ("Farm", "Site"),
        ("Dormer", "Null"), ("Site", "Site"), ("Castle", "Castle"), (None, None),
    ]


def test_relabel_targets_are_not_relabelled_again():
    for labels in (fixed.TYPE_RELABEL, fixed.CATEGORY_RELABEL):
        assert not set(labels) & set(labels.values())


def test_assign_where_and_with_required(spark):
    df = spark.createDataFrame([(1, "Site", None), (2, "House", 3.0), (3, None, 4.0)], "i int, t string, b double")
    assert rows(relabel.assign_where(df, F.col("t") == "Site", {"b": 0.0}), "i") == [
        (1, "Site", 0.0), (2, "House", 3.0), (3, None, 4.0),
    ]
    assert rows(relabel.with_required(df, "u", F.upper("t")), "i") == [(1, "Site", None, "SITE"), (2, "House", 3.0, "HOUSE")]
    assert relabel.with_required(df, "b", F.col("b")).columns == ["i", "t", "b"]


def test_rename_leading(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert relabel.rename_leading(df, ["x", "y"]).columns == ["x", "y", "c"]


# --- lookups and small groups ---------------------------------------------------


def test_province_lookup_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([(1, "Dublin 8"), (2, "Cork"), (3, "Cork 2"), (4, None)], "i int, County string")
    assert rows(lookup.add_province(df), "i") == [
        (1, "Dublin 8", "Leinster"), (2, "Cork", "Munster"), (3, "Cork 2", None), (4, None, None),
    ]


def test_last_of_repeated_keys_wins(spark):
    dim = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "x", 3)], "k string, v string, n int")
    assert rows(lookup.last_wins(dim, "k", "v", "n"), "k") == [("a", "new"), ("b", "x")]


def test_exclusion_drops_nulls_only_when_there_are_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    some = spark.createDataFrame([("a",)], "k string")
    assert rows(lookup.exclude_keys(df, some, "k")) == [("b",)]
    assert lookup.exclude_keys(df, some.filter("k = 'z'"), "k").count() == 3


def test_small_groups_fold_or_go(spark):
    counts = {"Dublin": 6, "Dublin 1": 2, "Dublin 2": 5, "Cork": 5, "Mayo": 1, None: 1}
    df = spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "County string")
    folded = groups.fold_small_groups(df, below=5)
    assert rows(groups.group_counts(folded, "County"), "County") == [("Cork", 5), ("Dublin", 8), ("Dublin 2", 5)]
    untouched = groups.fold_small_groups(df, below=1)
    assert untouched.count() == df.count()


def test_counts_and_orders(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "b", "a", "a", "c", None]], "v string")
    assert rows(groups.value_counts(df, "v")) == [("a", 2), ("b", 2), ("c", 1)]
    assert rows(groups.smallest_groups(df, "v", 2)) == [(None, 1), ("c", 1)]
    assert rows(groups.sorted_values(df, "v")) == [(None,), ("a",), ("b",), ("c",)]


# --- statistics -----------------------------------------------------------------


def _expected(frame, keys, measure):
    grouped = frame.dropna(subset=keys).groupby(keys)[measure].describe()
    return {k if isinstance(k, tuple) else (k,): list(v) for k, v in zip(grouped.index, grouped.values)}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_describe_matches_pandas(spark, seed):
    rnd = random.Random(seed)

    def value():
        return rnd.choice([
            None, 0.0, -1.5, 120000.0, rnd.gauss(0, 1), rnd.expovariate(1e-5), -rnd.random() * 1e9,
            rnd.random() * 1e-7, float(rnd.randint(1, 9)), rnd.uniform(99.9, 100.1),
        ])

    data = [(rnd.choice(["a", "b", "hot", "hot", None]), rnd.choice(["x", "y"]), value()) for _ in range(3000)]
    data += [("hot", "x", 42.0)] * 1500 + [("single", "x", 5.0)] + [("empty", "x", None)]
    frame = pd.DataFrame(data, columns=["k", "j", "v"])
    df = spark.createDataFrame(data, "k string, j string, v double")
    got = {
        (r["k"], r["j"]): [r[f"v_{s}"] for s in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")]
        for r in quantiles.describe_groups(df, ["k", "j"], ["v"]).collect()
    }
    want = _expected(frame, ["k", "j"], "v")
    assert got.keys() == want.keys()
    for key, stats in want.items():
        for a, b in zip(got[key], stats):
            assert (a is None and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12), key


def test_describe_several_measures_and_approximation(spark):
    df = spark.range(0, 1001).selectExpr("'g' AS k", "id AS a", "id * 2.5 AS b", "cast('nan' AS double) AS c")
    exact = quantiles.describe_groups(df, ["k"], ["a", "b", "c"]).first()
    assert (exact["a_50%"], exact["b_75%"], exact["c_count"], exact["c_max"]) == (500.0, 1875.0, 0, None)
    near = quantiles.describe_groups_approx(df, ["k"], ["a", "b"]).first()
    assert (near["a_50%"], near["b_count"], near["b_mean"]) == (500.0, 1001, 1250.0)


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", 2.5), (2, None, None), (2, "b", 1.0)], "i int, s string, d double")
    assert rows(profile.column_report(df)) == [("i", "int", 3), ("s", "string", 2), ("d", "double", 2)]
    assert rows(profile.distinct_counts(df)) == [("i", 2), ("s", 2), ("d", 2)]
    assert rows(profile.distinct_counts(df, approximate=True)) == [("i", 2), ("s", 2), ("d", 2)]
    described = {r["column"]: r for r in profile.describe_columns(df).collect()}
    assert (described["s"]["min"], described["s"]["max"], described["s"]["mean"]) == ("a", "b", None)
    assert (described["d"]["mean"], described["i"]["count"]) == (1.75, 3)
    numbers = {r["column"]: r for r in profile.describe_numbers(df).collect()}
    assert (numbers["d"]["50%"], numbers["d"]["max"], numbers["i"]["mean"]) == (1, 2, 1)


def test_quality_checks(spark):
    df = spark.createDataFrame([("a", None, 1.0), (None, None, 2.0), (None, None, None)], "k string, p string, area double")
    assert rows(profile.orphans(df, ["k", "p"], ["area"])) == [(None, None, 2.0)]
    changes = spark.createDataFrame(
        [(5, 3, 2, 66.67), (5, 3, -2, -66.67), (3, 5, -2, 40.0)], "New_price long, Old_price long, change_eur long, change_pct double"
    )
    assert [r[0] for r in changes.select(profile.change_consistent()).collect()] == [True, False, False]


# --- sources ----------------------------------------------------------------------


def test_null_tokens(spark):
    df = spark.createDataFrame([("nan", float("nan"), 1), ("Nan", 2.0, 2), ("", None, 3)], "s string, d double, i int")
    assert rows(files.null_tokens(df), "i") == [(None, None, 1), ("Nan", 2.0, 2), (None, None, 3)]
    assert files.null_tokens(df, columns=["d"]).first()["s"] == "nan"


def test_frontier(spark):
    assert rows(frontier.page_frontier(spark, "u", 0, 3, 20), "page_id") == [
        (0, "u?from=0&pageSize=20"), (1, "u?from=20&pageSize=20"), (2, "u?from=40&pageSize=20"),
    ]
    assert rows(frontier.page_frontier(spark, "p-", 1, 3), "page_id") == [(1, "p-1"), (2, "p-2")]


def test_scratch_folder_is_shared_on_a_cluster():
    class Conf:
        def __init__(self, **values):
            self.values = {k.replace("_", "."): v for k, v in values.items()}

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    assert scratch_root(Session(spark_checkpoint_dir="hdfs://shared/x/", spark_master="yarn")) == "hdfs://shared/x"
    with pytest.raises(ValueError):
        scratch_root(Session(spark_master="yarn"))


def test_last_row_of_a_county_wins(spark):
    df = spark.createDataFrame([("Cork",)], "County string")
    dim = spark.createDataFrame([("Cork", "Old"), ("Cork", "New")], "County string, Province string").coalesce(1)
    assert [tuple(r) for r in lookup.add_province(df, dim).collect()] == [("Cork", "New")]


def test_change_and_percentage_agree(spark):
    rows = [(110, 100, 10, 10.0), (110, 100, 10, 50.0), (110, 100, 9, 10.0), (99, 100, -1, -1.0)]
    df = spark.createDataFrame(rows, "New_price bigint, Old_price bigint, change_eur bigint, change_pct double")
    assert [r[0] for r in df.select(profile.change_consistent()).collect()] == [True, False, False, True]
