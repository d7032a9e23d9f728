"""Parameterised range exploration over a table registered for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import fixed

VIEW = "property"
ALL = "All"


def register(df: DataFrame, view: str = VIEW) -> None:
    df.createOrReplaceTempView(view)


def _predicate(bounds, county: str, category: str) -> tuple[str, dict]:
    terms, args = [], {}
    for column, (low, high) in (bounds or {}).items():
        terms.append(f"`{column}` BETWEEN :min_{column} AND :max_{column}")
        args |= {f"min_{column}": low, f"max_{column}": high}
    for column, wanted in {"County": county, "Property_Category": category}.items():
        if wanted != ALL:
            terms.append(f"`{column}` = :{column}")
            args[column] = wanted
    return " AND ".join(terms) or "TRUE", args


def explore(
    spark,
    bounds: dict[str, tuple[float, float]] | None = None,
    county: str = ALL,
    category: str = ALL,
    x_axis: str = "Size of the property",
    y_axis: str = "Price",
    view: str = VIEW,
) -> DataFrame:
    """x, y and the tooltip columns of the selected properties, with their number.

    A range that is not named is open; `fixed.EXPLORER_BOUNDS` are those a page starts with.
    The number comes from a second, pruned scan: a window over all rows would
    pass them through one task.
    """
    where, args = _predicate(bounds, county, category)
    x, y = fixed.AXIS_COLUMNS[x_axis], fixed.AXIS_COLUMNS[y_axis]
    return spark.sql(
        f"""SELECT `{x}` AS x, `{y}` AS y, Price, Property_type, County,
                   (SELECT count(*) FROM {view} WHERE {where}) AS n_selected
            FROM {view} WHERE {where}""",
        args=args,
    )


def n_selected(
    spark, bounds=None, county: str = ALL, category: str = ALL, view: str = VIEW
) -> DataFrame:
    where, args = _predicate(bounds, county, category)
    return spark.sql(f"SELECT count(*) AS n_selected FROM {view} WHERE {where}", args=args)


def scatter_points(
    df: DataFrame, x: str, area: str = "Floor_area", below: float = fixed.SCATTER_MAX_AREA
) -> DataFrame:
    """Price against x below an area bound; a category axis is text, the area axis a number."""
    shown = df.filter(F.col(area) < below)
    axis = F.col(x) if x == area else F.col(x).cast("string")
    return shown.select(axis.alias("x"), F.col("Price").alias("y"))


def scatter_axis(
    df: DataFrame, x: str, area: str = "Floor_area", below: float = fixed.SCATTER_MAX_AREA
) -> DataFrame:
    """The categories of the axis: sorted as numbers, then text."""
    shown = df.filter(F.col(area) < below).select(x).distinct()
    return shown.orderBy(x).select(F.col(x).cast("string").alias("x"))
