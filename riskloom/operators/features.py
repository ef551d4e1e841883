"""Row-wise features. Builders learn nothing from the data: no aggregates, no windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import band, ratio
from riskloom.operators.aggregates import describe
from riskloom.operators.stats import correlation_matrix
from riskloom.roles import (
    AGE_BAND,
    AGE_BANDS,
    AGE_OFFSET,
    DEFAULT_ROLES,
    DERIVED_NUMERICS,
    EVENTS_PER_USAGE,
    MANY_EVENTS,
    MANY_EVENTS_FROM,
    USAGE_BAND,
    USAGE_BANDS,
    USAGE_UNIT,
    YEARLY_EVENTS,
    YEARLY_USAGE,
    Roles,
)

Builder = Callable[[Roles], Column]

# A zero usage gives a null ratio, which the feature contract then reports.
BUILDERS: dict[str, Builder] = {
    YEARLY_USAGE: lambda r: ratio(r.usage, F.col(r.age) + F.lit(AGE_OFFSET)),
    YEARLY_EVENTS: lambda r: ratio(r.events, F.col(r.age) + F.lit(AGE_OFFSET)),
    EVENTS_PER_USAGE: lambda r: ratio(r.events, F.col(r.usage) / F.lit(USAGE_UNIT)),
    MANY_EVENTS: lambda r: F.col(r.events) >= F.lit(MANY_EVENTS_FROM),
    AGE_BAND: lambda r: band(r.age, AGE_BANDS),
    USAGE_BAND: lambda r: band(r.usage, USAGE_BANDS),
}


def add_features(
    df: DataFrame, roles: Roles = DEFAULT_ROLES, builders: dict[str, Builder] | None = None
) -> DataFrame:
    """Append every derived column in registry order (one projection, no shuffle)."""
    chosen = BUILDERS if builders is None else builders
    return df.withColumns({name: build(roles) for name, build in chosen.items()})


def feature_correlation(features: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Correlation of original and derived numerics (long format)."""
    return correlation_matrix(features, [*roles.numerics, *DERIVED_NUMERICS])


def feature_summary(features: DataFrame) -> DataFrame:
    """Describe the derived numerics and count their infinities."""
    return describe(features, DERIVED_NUMERICS, count_infinite=True)
