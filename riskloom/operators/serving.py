"""Operators behind the interactive views: slices, scoring, priorities."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import positive, ratio, sigmoid, thousands_down, thousands_up
from riskloom.operators.aggregates import add_rate, add_wilson
from riskloom.operators.explain import contributions
from riskloom.operators.linear import LinearModel
from riskloom.roles import DEFAULT_ROLES, MIN_CELL_SIZE, Roles


def matches(selection: Mapping[str, Sequence[object]]) -> Column:
    """AND of IN lists; an empty list does not restrict its column."""
    wanted = [F.col(c).isin(list(v)) for c, v in selection.items() if v]
    return reduce(lambda a, b: a & b, wanted, F.lit(True))


def filter_slice(df: DataFrame, selection: Mapping[str, Sequence[object]]) -> DataFrame:
    return df.filter(matches(selection))


def explore_slice(
    df: DataFrame,
    selection: Mapping[str, Sequence[object]],
    roles: Roles = DEFAULT_ROLES,
    minimum: int = MIN_CELL_SIZE,
) -> DataFrame:
    """Size, share, rate, interval and mean events of a slice, from one aggregate of the base."""
    inside = F.coalesce(matches(selection), F.lit(False))
    totals = df.agg(
        F.count_if(inside).alias("n_units"),
        F.count_if(inside & positive(roles.label)).alias("n_positive"),
        F.avg(F.when(inside, F.col(roles.events))).alias("mean_events"),
        F.count(F.lit(1)).alias("n_base"),
    ).withColumn("share_of_base", ratio("n_units", "n_base"))
    return (
        add_wilson(add_rate(totals))
        .withColumn("small_sample", F.col("n_units") < minimum)
        .drop("n_base")
    )


def observed_ranges(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Limits within which scoring interpolates; usage limits are whole thousands."""
    return df.agg(
        F.max(roles.age).alias("max_age"),
        thousands_down(F.min(roles.usage)).alias("min_usage"),
        thousands_up(F.max(roles.usage)).alias("max_usage"),
        F.max(roles.events).alias("max_events"),
    )


def score_units(
    df: DataFrame,
    model: LinearModel,
    threshold: float,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    row_id: str = "unit_id",
) -> DataFrame:
    """Risk, flag and contributions of every row, sorted from most protective to most harmful.

    ``ranges`` marks rows outside what the model has seen. All columns are row-wise,
    so this also runs on a stream.
    """
    scored = contributions(df, model)
    parts = F.array(
        *[
            F.struct(
                F.col(f"`contribution_{t.name}`").alias("value"), F.lit(t.name).alias("variable")
            )
            for t in model.terms
        ]
    )
    outside = F.lit(False)
    for column, (low, high) in (ranges or {}).items():
        outside = outside | ~F.col(column).between(low, high)
    return (
        scored.withColumn("risk", sigmoid(F.col("log_odds")))
        .withColumns(
            {
                "flagged": F.col("risk") >= F.lit(threshold),
                "out_of_range": F.coalesce(outside, F.lit(True)),
                "contributions": F.array_sort(parts),
            }
        )
        .select(row_id, "risk", "flagged", "out_of_range", "reference", "contributions")
    )


def score_units_with(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    threshold: float,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    row_id: str = "unit_id",
) -> DataFrame:
    """Risk and flag of every row by any model, given as a function that adds a ``risk`` column.

    There are no contributions: those are read from coefficients.
    """
    outside = F.lit(False)
    for column, (low, high) in (ranges or {}).items():
        outside = outside | ~F.col(column).between(low, high)
    return score(df).select(
        row_id,
        "risk",
        (F.col("risk") >= F.lit(threshold)).alias("flagged"),
        F.coalesce(outside, F.lit(True)).alias("out_of_range"),
    )


def seen_ranges(observed: DataFrame, roles: Roles = DEFAULT_ROLES) -> dict[str, tuple[float, float]]:
    """Range check limits from ``observed_ranges`` (one row)."""
    r = observed.first()
    return {
        roles.age: (0, r["max_age"]),
        roles.usage: (r["min_usage"], r["max_usage"]),
        roles.events: (0, r["max_events"]),
    }


def priority_list(scored: DataFrame, row_id: str = "unit_id") -> DataFrame:
    """Units by descending risk with the strongest reason first; ids break ties.

    The order is a range-partitioned sort on (risk, id): equal risks still spread.
    """
    strongest = F.element_at("contributions", -1)
    return scored.select(
        row_id,
        "risk",
        "flagged",
        strongest["variable"].alias("main_reason"),
        strongest["value"].alias("main_contribution"),
    ).orderBy(F.col("risk").desc(), row_id)
