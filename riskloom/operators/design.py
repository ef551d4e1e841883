"""Model inputs: feature sets, and the terms each model kind builds from them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.roles import DEFAULT_ROLES, DERIVED_NUMERICS, MANY_EVENTS, Roles

CATEGORY, FLAG, NUMBER, SKEWED = "category", "flag", "number", "skewed"
ORIGINAL, WITHOUT_GROUP, WITH_DERIVED = "original", "without_group", "with_derived"


def feature_sets(roles: Roles = DEFAULT_ROLES) -> dict[str, tuple[str, ...]]:
    """The columns as they came, without the group, and with the derived columns."""
    return {
        ORIGINAL: (roles.group, *roles.numerics),
        WITHOUT_GROUP: roles.numerics,
        WITH_DERIVED: (roles.group, *roles.numerics, *DERIVED_NUMERICS, MANY_EVENTS),
    }


@dataclass(frozen=True)
class Term:
    """One model input: a dummy, a flag, a number, or the logarithm of a skewed ratio."""

    name: str
    source: str
    kind: str
    level: str | None = None

    @property
    def scaled(self) -> bool:
        return self.kind in (NUMBER, SKEWED)

    def column(self) -> Column:
        source = F.col(self.source)
        if self.kind == CATEGORY:
            # A level never seen in training matches no dummy: all zeros.
            return F.coalesce((source == self.level).cast("double"), F.lit(0.0))
        value = source.cast("double")
        return F.log1p(value) if self.kind == SKEWED else value

    def at(self, value: float) -> float:
        """The term's raw input when its source column holds ``value``."""
        return math.log1p(value) if self.kind == SKEWED else float(value)


def kind_of(column: str, roles: Roles) -> str:
    if column == roles.group:
        return CATEGORY
    if column == MANY_EVENTS:
        return FLAG
    return SKEWED if column in DERIVED_NUMERICS else NUMBER


def terms_for(
    columns: Sequence[str],
    levels: Sequence[str],
    linear: bool = True,
    roles: Roles = DEFAULT_ROLES,
) -> list[Term]:
    """Terms in the order categories, flags, numbers, skewed ratios.

    Linear models drop the first dummy and take logarithms of skewed ratios; trees
    take every dummy and raw values.
    """
    kinds = {c: kind_of(c, roles) for c in columns}
    terms = []
    for c in (c for c in columns if kinds[c] == CATEGORY):
        kept = levels[1:] if linear else levels
        terms += [Term(f"{c}_{level}", c, CATEGORY, level) for level in kept]
    terms += [Term(c, c, FLAG) for c in columns if kinds[c] == FLAG]
    terms += [Term(c, c, NUMBER) for c in columns if kinds[c] == NUMBER]
    terms += [Term(c, c, SKEWED if linear else NUMBER) for c in columns if kinds[c] == SKEWED]
    return terms


#: Levels of a category without a declared domain from which on dummies make no sense.
MAX_LEVELS = 1_000


def group_levels(df: DataFrame, roles: Roles = DEFAULT_ROLES, limit: int = MAX_LEVELS) -> list[str]:
    """Sorted levels of the category: the declared domain, or what the data holds.

    More than ``limit`` levels found in the data are an error; none is left out.
    """
    if roles.groups:
        return sorted(roles.groups)
    found = df.select(roles.group).distinct().filter(F.col(roles.group).isNotNull())
    levels = [r[0] for r in found.limit(limit + 1).collect()]
    if len(levels) > limit:
        raise ValueError(f"{roles.group!r} has over {limit} levels: not a category to dummy-code")
    return sorted(levels)
