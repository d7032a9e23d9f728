"""Grouped describe with exact quantiles at any group size.

The built-in exact `percentile` keeps all distinct values of a group in one
task. Here a group is counted per value (pre-aggregated, the value being part
of the shuffle key), the wanted ranks are located among coarse buckets of
three significant digits, and only the buckets that hold a rank are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.staging import stage

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}

# Grows with the value: its sign times its decimal exponent, shifted above zero.
MAGNITUDE = """CASE WHEN value = 0 THEN 0 ELSE cast(signum(value) AS bigint)
    * (least(greatest(floor(log10(abs(value))), -300), 305) + 400) END"""
# The lower edge of four significant digits.
ANCHOR = """CASE WHEN value = 0 THEN 0D ELSE
    floor(value / pow(10D, abs(magnitude) - 403)) * pow(10D, abs(magnitude) - 403) END"""


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _aggregates(**expressions: str) -> list:
    return [F.expr(e).alias(name) for name, e in expressions.items()]


def describe_long(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    quantiles: dict[str, float] = QUARTILES,
) -> DataFrame:
    """One row per (keys, measure): count, mean, std, min, quantiles, max. NULLs and NaNs ignored;
    a group of nothing else has the count 0.

    Quantiles interpolate linearly between neighbouring ranks. Rows with a NULL
    key are left out.
    """
    group = [*keys, "measure"]
    bucket = [*group, "magnitude", "anchor"]
    by_group, by_bucket = ", ".join(_quoted(group)), ", ".join(_quoted(bucket))

    keyed = df.dropna(subset=list(keys)) if keys else df
    long = (
        keyed.selectExpr(*_quoted(keys), *[f"cast(`{m}` AS double) AS `{m}`" for m in measures])
        .unpivot(_quoted(keys), _quoted(measures), "measure", "value")
        .withColumn("value", F.expr("nullif(value, 'NaN')"))
    )
    per_value = stage(
        long.groupBy(*_quoted(group), "value")
        .agg(*_aggregates(n="count(value)"))
        .selectExpr("*", f"{MAGNITUDE} AS magnitude")
        .selectExpr("*", f"{ANCHOR} AS anchor"),
        "per-value",
    )
    buckets = stage(
        per_value.groupBy(*_quoted(bucket)).agg(
            *_aggregates(
                n="sum(n)",
                s1="sum(n * (value - anchor))",
                s2="sum(n * pow(value - anchor, 2))",
                low="min(value)",
                high="max(value)",
            )
        ),
        "buckets",
    )

    whole = f"OVER (PARTITION BY {by_group})"
    placed = buckets.selectExpr(
        "*",
        f"sum(n) OVER (PARTITION BY {by_group} ORDER BY magnitude, anchor) - n AS before",
        f"sum(n) {whole} AS count",
        f"sum(anchor * n + s1) {whole} / nullif(sum(n) {whole}, 0) AS mean",
        f"min(low) {whole} AS min",
        f"max(high) {whole} AS max",
    ).selectExpr(
        "*",
        f"sum(CASE WHEN n > 0 THEN greatest(0D, s2 - s1 * s1 / n)"
        f" + n * pow(anchor + s1 / n - mean, 2) END) {whole} AS squares",
    )

    rank = {name: f"({float(p)}D * (count - 1))" for name, p in quantiles.items()}
    ranks = ", ".join(f"floor({r}), ceil({r})" for r in rank.values())
    wanted = placed.filter(
        f"exists(array({ranks}), r -> r >= before AND r < before + n)"
    ).selectExpr(
        *_quoted(bucket),
        "before",
        "count",
        "mean",
        "CASE WHEN count > 1 THEN sqrt(squares / (count - 1)) END AS std",
        "min",
        "max",
    )
    ranked = per_value.join(wanted, bucket).selectExpr(
        "*", f"before + sum(n) OVER (PARTITION BY {by_bucket} ORDER BY value) AS upto"
    )

    def at(r: str) -> str:
        return f"max(CASE WHEN {r} >= upto - n AND {r} < upto THEN value END)"

    def quantile(r: str) -> str:
        low, high = at(f"floor({r})"), at(f"ceil({r})")
        return f"{low} + ({high} - {low}) * max({r} - floor({r}))"

    # The statistics of a group are on all its rows; max takes them from any.
    valued = ranked.groupBy(*_quoted(group)).agg(
        *_aggregates(
            **{stat: f"max(`{stat}`)" for stat in ("count", "mean", "std", "min")},
            **{name: quantile(r) for name, r in rank.items()},
            max="max(`max`)",
        )
    )
    missing = [f"cast(NULL AS double) AS `{c}`" for c in valued.columns[len(group) + 1 :]]
    valueless = placed.filter("count = 0").selectExpr(*_quoted(group), "count", *missing)
    return valued.union(valueless)


def describe_groups(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    quantiles: dict[str, float] = QUARTILES,
) -> DataFrame:
    """One row per group, statistics flattened to `<measure>_<stat>`."""
    long = describe_long(df, keys, measures, quantiles)
    stats = [c for c in long.columns if c not in (*keys, "measure")]
    if len(measures) == 1:
        return long.drop("measure").withColumnsRenamed({s: f"{measures[0]}_{s}" for s in stats})
    return long.groupBy(*_quoted(keys)).agg(
        *_aggregates(
            **{
                f"{m}_{s}": f"max(CASE WHEN measure = '{m}' THEN `{s}` END)"
                for m in measures
                for s in stats
            }
        )
    )


def describe_groups_approx(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    quantiles: dict[str, float] = QUARTILES,
    accuracy: int = 10000,
) -> DataFrame:
    """`describe_groups` in one pass; quantiles are values within a rank error of 1/accuracy."""
    aggregates = {}
    for m in measures:
        value = f"cast(`{m}` AS double)"
        aggregates |= {
            f"{m}_count": f"count({value})",
            f"{m}_mean": f"avg({value})",
            f"{m}_std": f"stddev_samp({value})",
            f"{m}_min": f"min({value})",
            **{
                f"{m}_{name}": f"percentile_approx({value}, {float(p)}D, {accuracy})"
                for name, p in quantiles.items()
            },
            f"{m}_max": f"max({value})",
        }
    keyed = df.dropna(subset=list(keys)) if keys else df
    return keyed.groupBy(*_quoted(keys)).agg(*_aggregates(**aggregates))
