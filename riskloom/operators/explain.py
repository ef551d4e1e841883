"""Reading a linear model: coefficients, contributions, centred contributions, dependence."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import sigmoid
from riskloom.operators.design import CATEGORY
from riskloom.operators.linear import LinearModel
from riskloom.operators.scan import exact_quantiles, value_counts
from riskloom.roles import (
    DEFAULT_ROLES,
    DEPENDENCE_POINTS,
    EVENTS_PER_USAGE,
    MANY_EVENTS,
    YEARLY_EVENTS,
    YEARLY_USAGE,
    Roles,
)
from riskloom.session import stage


def require_linear(model: object) -> LinearModel:
    if not isinstance(model, LinearModel):
        raise TypeError(f"{type(model).__name__} has no coefficients: only linear models do")
    return model


def reading_units(roles: Roles = DEFAULT_ROLES) -> list[tuple[str, float, str]]:
    """The step in which each variable is worth communicating."""
    return [
        (roles.age, 1.0, "per year of age"),
        (roles.usage, 10_000.0, "per 10,000 of usage"),
        (roles.events, 1.0, "per recorded event"),
        (YEARLY_USAGE, 1_000.0, "per 1,000 of usage a year"),
        (YEARLY_EVENTS, 1.0, "per event a year"),
        (EVENTS_PER_USAGE, 1.0, "per event per 10,000 of usage"),
        (MANY_EVENTS, 1.0, "with three or more events"),
    ]


def coefficient_table(table: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Standardised and natural coefficients with odds ratios, largest effect first.

    ``table`` is a model table; terms without a scale keep natural columns null.
    """
    units = table.sparkSession.createDataFrame(
        reading_units(roles), "variable string, unit_factor double, unit string"
    )
    scaled = F.when(F.col("kind").isin("number", "skewed"), F.col("scale"))
    natural = F.col("standardised") / F.col("scale")
    return (
        table.filter("position > 0")
        .select(
            F.col("term").alias("variable"), F.col("coefficient").alias("standardised"),
            scaled.alias("scale"),
        )
        .join(F.broadcast(units), "variable", "left")
        .select(
            "variable",
            "standardised",
            F.exp("standardised").alias("odds_per_sd"),
            "scale",
            natural.alias("natural"),
            F.exp(natural).alias("odds_per_unit"),
            F.coalesce("unit_factor", F.lit(1.0)).alias("unit_factor"),
            F.coalesce("unit", F.lit("per unit")).alias("unit"),
            F.exp(natural * F.coalesce("unit_factor", F.lit(1.0))).alias("odds_communicable"),
            F.abs("standardised").alias("magnitude"),
        )
        .orderBy(F.col("magnitude").desc(), "variable")
    )


def contributions(df: DataFrame, model: LinearModel, prefix: str = "contribution_") -> DataFrame:
    """Per-row value times coefficient for every term, the reference, and the log-odds.

    Exact: contributions plus the reference are the log-odds of the prediction.
    """
    parts = require_linear(model).contribution_columns()
    with_parts = df.withColumns({f"{prefix}{name}": value for name, value in parts.items()})
    log_odds = F.lit(model.intercept)
    for name in parts:
        log_odds = log_odds + F.col(f"`{prefix}{name}`")
    return with_parts.withColumns({"reference": F.lit(model.intercept), "log_odds": log_odds})


def contribution_rows(df: DataFrame, model: LinearModel, row_id: str) -> DataFrame:
    """Contributions in long format."""
    rows = [
        F.struct(F.lit(name).alias("variable"), value.alias("contribution"))
        for name, value in require_linear(model).contribution_columns().items()
    ]
    return df.select(row_id, F.inline(F.array(*rows)))


def _background(df: DataFrame, model: LinearModel) -> list[float]:
    """Mean contribution of each term over all rows: one row of sums."""
    means = df.agg(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(model.contribution_columns().values())]
    ).first()
    return [m or 0.0 for m in means]


def centred_contributions(
    df: DataFrame, model: LinearModel, row_id: str, background: DataFrame | None = None
) -> DataFrame:
    """Shapley values of a linear model in closed form: (value - mean) times coefficient.

    They equal plain contributions for centred columns only: dummies and flags are
    not centred by the model, so there the two differ by the column's mean.
    """
    parts = require_linear(model).contribution_columns()
    means = _background(df if background is None else background, model)
    return df.select(
        row_id, *[(v - F.lit(m)).alias(n) for (n, v), m in zip(parts.items(), means)]
    )


def contribution_summary(centred: DataFrame, model: LinearModel) -> DataFrame:
    """Mean absolute and mean centred contribution per term, strongest first."""
    names = [t.name for t in model.terms]
    sums = centred.agg(
        *[F.avg(F.abs(F.col(f"`{n}`"))).alias(f"a{i}") for i, n in enumerate(names)],
        *[F.avg(F.col(f"`{n}`")).alias(f"m{i}") for i, n in enumerate(names)],
    )
    records = [
        F.struct(
            F.lit(n).alias("variable"),
            F.col(f"a{i}").alias("mean_absolute"),
            F.col(f"m{i}").alias("mean"),
        )
        for i, n in enumerate(names)
    ]
    return sums.select(F.inline(F.array(*records))).orderBy(F.col("mean_absolute").desc())


def dependence_grid(
    df: DataFrame, variables: Sequence[str], points: int = DEPENDENCE_POINTS
) -> dict[str, list[float]]:
    """Grid per variable: its distinct values if few, else a line from the 5th to the 95th
    percentile (quantile positions with parameter 0.4)."""
    counts = stage(value_counts(df, [], list(variables)))
    sizes = counts.groupBy("variable").agg(F.count(F.lit(1)).alias("k"))
    few = [r["variable"] for r in sizes.filter(F.col("k") < points).collect()]
    grid: dict[str, list[float]] = {}
    if few:
        # Fewer than ``points`` values for each of these variables.
        for r in counts.filter(F.col("variable").isin(*few)).orderBy("value").collect():
            grid.setdefault(r["variable"], []).append(r["value"])
    many = [v for v in variables if v not in few]
    if many:
        ends = exact_quantiles(
            df, many, {"low": 0.05, "high": 0.95}, plotting=0.4,
            counts=counts.filter(F.col("variable").isin(*many)),
        )
        for r in ends.collect():  # one row per variable
            grid[r["variable"]] = [float(v) for v in np.linspace(r["low"], r["high"], points)]
    return grid


def partial_dependence(
    df: DataFrame,
    model: LinearModel,
    variables: Sequence[str],
    points: int = DEPENDENCE_POINTS,
    grid: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Mean predicted risk when one numeric variable is set to each grid value.

    Every row meets every grid value inside the map side of one aggregate; what is
    shuffled is one partial mean per task and grid value.
    """
    require_linear(model)
    by_source = {t.source: i for i, t in enumerate(model.terms) if t.kind != CATEGORY}
    unknown = [v for v in variables if v not in by_source]
    if unknown:
        raise ValueError(f"no numeric term for {unknown}")
    grid = grid or dependence_grid(df, variables, points)
    parts = list(model.contribution_columns().values())
    others = {}
    candidates = []
    for k, v in enumerate(variables):
        i = by_source[v]
        rest = F.lit(model.intercept)
        for j, part in enumerate(parts):
            if j != i:
                rest = rest + part
        others[f"__rest{k}"] = rest
        term, b, c, s = model.terms[i], model.coefficients[i], model.centres[i], model.scales[i]
        candidates += [
            F.struct(
                F.lit(v).alias("variable"),
                F.lit(float(g)).alias("value"),
                (F.col(f"__rest{k}") + F.lit((term.at(g) - c) / s * b)).alias("eta"),
            )
            for g in grid.get(v, [])
        ]
    return (
        df.select(*[e.alias(n) for n, e in others.items()])
        .select(F.inline(F.array(*candidates)))
        .groupBy("variable", "value")
        .agg(F.avg(sigmoid(F.col("eta"))).alias("risk"))
        .orderBy("variable", "value")
    )


def partial_dependence_of(
    df: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    variables: Sequence[str],
    points: int = DEPENDENCE_POINTS,
    grid: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """``partial_dependence`` of any model, given as a function that adds a ``risk`` column row by row.

    Rows meet the grid on the map side here as well; only partial means are shuffled.
    """
    grid = grid or dependence_grid(df, variables, points)
    kinds = dict(df.dtypes)
    parts = []
    for v in variables:
        values = F.explode(F.array(*[F.lit(float(g)) for g in grid.get(v, [])])).alias("__value")
        moved = df.select("*", values).withColumn(v, F.col("__value").cast(kinds[v]))
        parts.append(
            score(moved)
            .groupBy(F.lit(v).alias("variable"), F.col("__value").alias("value"))
            .agg(F.avg("risk").alias("risk"))
        )
    return reduce(DataFrame.unionByName, parts).orderBy("variable", "value")


def threshold_crossing(dependence: DataFrame, threshold: float) -> DataFrame:
    """First grid value at which the mean risk reaches the threshold (null if never)."""
    reached = F.when(F.col("risk") >= F.lit(threshold), F.col("value"))
    return dependence.groupBy("variable").agg(F.min(reached).alias("crosses_at")).orderBy("variable")
