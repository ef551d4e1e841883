"""Data-quality reports: column profile, duplicates, outliers, consistency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import ratio
from riskloom.operators.scan import approximate_quantiles, exact_quantiles, value_counts
from riskloom.roles import DEFAULT_ROLES, TUKEY_FACTOR, YEARLY_USAGE_RANGE, Roles
from riskloom.session import stage

# Kinds of columns in the profile.
CATEGORY, NUMBER, TARGET = "category", "number", "target"


def column_profile(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, approximate: bool = False
) -> DataFrame:
    """One row per column: rows, filled, nulls, distinct, minimum, maximum.

    Distinct values of all columns are counted side by side, one shuffle of distinct values rather
    than one expansion per column. ``approximate`` swaps that for sketches in the plain aggregate.
    """
    kinds = [(roles.group, CATEGORY)] + [(c, NUMBER) for c in roles.numerics]
    kinds.append((roles.label, TARGET))
    columns = [c for c, _ in kinds]
    # Rows, filled, minimum and maximum come typed from one plain aggregate; only distinct counts need values side by side.
    plain, entries = [F.count(F.lit(1)).alias("n_rows")], []
    for i, (c, kind) in enumerate(kinds):
        plain.append(F.count(c).alias(f"filled_{i}"))
        if kind == NUMBER:
            plain += [F.min(c).cast("double").alias(f"low_{i}"), F.max(c).cast("double").alias(f"high_{i}")]
        if approximate:
            plain.append(F.approx_count_distinct(c).alias(f"distinct_{i}"))
        entries.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(kind).alias("kind"),
                F.col("n_rows"),
                F.col(f"filled_{i}").alias("n_filled"),
                (F.col("n_rows") - F.col(f"filled_{i}")).alias("n_null"),
                (F.col(f"distinct_{i}") if approximate else F.lit(None).cast("bigint")).alias("n_distinct"),
                (F.col(f"low_{i}") if kind == NUMBER else F.lit(None).cast("double")).alias("minimum"),
                (F.col(f"high_{i}") if kind == NUMBER else F.lit(None).cast("double")).alias("maximum"),
                F.lit(i).alias("place"),
            )
        )
    profile = df.agg(*plain).select(F.inline(F.array(*entries)))
    if not approximate:
        values = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
        distinct = (
            df.select(F.inline(F.array(*values)))
            .filter("value is not null")
            .distinct()
            .groupBy("variable")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        profile = profile.drop("n_distinct").join(F.broadcast(distinct), "variable", "left")
        profile = profile.withColumn("n_distinct", F.coalesce("n", F.lit(0)))
    return profile.orderBy("place").select(
        "variable", "kind", "n_rows", "n_filled", "n_null", "n_distinct", "minimum", "maximum"
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row (or key) groups occurring more than once, most frequent first."""
    columns = list(columns or df.columns)
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_occurrences"))
        .filter(F.col("n_occurrences") > 1)
        .orderBy(F.col("n_occurrences").desc(), *columns)
    )


def tukey_outliers(
    df: DataFrame,
    columns: Sequence[str],
    factor: float = TUKEY_FACTOR,
    accuracy: int | None = None,
) -> DataFrame:
    """Quartiles, Tukey limits, and how many values fall outside, per column.

    Quartiles are exact unless an ``accuracy`` asks for a sketch.
    """
    columns = list(columns)
    shares = {"q1": 0.25, "q3": 0.75}
    # One pass counts the distinct values; quartiles and outliers are read from those counts.
    counts = stage(value_counts(df, [], columns))
    if accuracy:
        quartiles = approximate_quantiles(df, columns, shares, accuracy)
    else:
        quartiles = exact_quantiles(df, columns, shares, counts=counts)
    fences = (
        quartiles.withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumns(
            {
                "lower": F.col("q1") - F.lit(factor) * F.col("iqr"),
                "upper": F.col("q3") + F.lit(factor) * F.col("iqr"),
            }
        )
    )
    limits = {r["variable"]: r for r in fences.collect()}  # one row per column
    missing = F.lit(None).cast("double")
    aggregates = []
    for c in columns:
        fence = limits.get(c)
        x = F.col("value")
        outside = (F.col("variable") == c) & ((x < fence["lower"]) | (x > fence["upper"])) if fence else F.lit(False)
        aggregates.append(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias(f"{c}__out"))
    records = []
    for c in columns:
        fence = limits.get(c)
        number = {
            k: F.lit(fence[k]) if fence else missing for k in ("q1", "q3", "iqr", "lower", "upper")
        }
        records.append(
            F.struct(
                F.lit(c).alias("variable"),
                *[v.alias(k) for k, v in number.items()],
                F.col(f"{c}__out").alias("n_outliers"),
                ratio(f"{c}__out", "__rows").alias("share_outliers"),
            )
        )
    # The number of rows needs no column.
    rows = df.agg(F.count(F.lit(1)).alias("__rows"), F.lit(1).alias("__one"))
    outside = counts.agg(*aggregates, F.lit(1).alias("__one"))
    return rows.join(outside, "__one").select(F.inline(F.array(*records)))


def usage_consistency(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Implied yearly usage of units older than zero, flagged when implausible."""
    low, high = YEARLY_USAGE_RANGE
    yearly = ratio(roles.usage, roles.age)
    return df.filter(F.col(roles.age) > 0).withColumns(
        {"yearly_usage": yearly, "out_of_range": ~yearly.between(low, high)}
    )


def usage_consistency_report(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Evaluated and excluded units, spread of yearly usage, and implausible count."""
    low, high = YEARLY_USAGE_RANGE
    eligible = F.col(roles.age) > 0
    yearly = F.when(eligible, ratio(roles.usage, roles.age))
    totals = df.agg(
        F.count_if(eligible).alias("n_evaluated"),
        F.count_if(F.col(roles.age) == 0).alias("n_age_zero"),
        F.min(yearly).alias("min_yearly"),
        F.max(yearly).alias("max_yearly"),
        F.count_if(~yearly.between(low, high)).alias("n_out_of_range"),
    )
    median = exact_quantiles(
        usage_consistency(df, roles), ["yearly_usage"], {"median_yearly": 0.5}
    ).drop("variable")
    # Both sides are one-row aggregates.
    one = F.lit(1).alias("__one")
    return totals.select("*", one).join(median.select("*", one), "__one", "left").drop("__one")


def schema_listing(df: DataFrame) -> DataFrame:
    """Column, type and one example value."""
    records = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(name).alias("variable"),
            F.lit(kind).alias("type"),
            F.col(f"__ex{i}").alias("example"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    # The smallest value as text: an example that does not depend on row order.
    examples = [F.min(F.col(c).cast("string")).alias(f"__ex{i}") for i, c in enumerate(df.columns)]
    return df.agg(*examples).select(F.inline(F.array(*records))).orderBy("ordinal")
