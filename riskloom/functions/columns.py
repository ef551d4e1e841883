"""Column expressions shared by the operators. None of them aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.roles import BAND_FLOOR, Z_95


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def positive(label: Column | str) -> Column:
    """Label as boolean; a missing label counts as not positive."""
    return F.coalesce(col(label), F.lit(False))


def label01(label: Column | str) -> Column:
    return positive(label).cast("int")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division giving null, never an error, for a zero divisor."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def tidy(value: Column | str, places: int = 9) -> Column:
    """Round for reporting; adding zero turns -0.0 into 0.0."""
    return F.round(col(value).cast("double"), places) + F.lit(0.0)


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high], keeping null."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def sigmoid(log_odds: Column) -> Column:
    """Logistic function written so that exp never overflows."""
    tail = F.exp(-F.abs(log_odds))
    return F.when(log_odds >= 0, F.lit(1.0) / (F.lit(1.0) + tail)).otherwise(
        tail / (F.lit(1.0) + tail)
    )


def wilson(successes: Column | str, total: Column | str, z: float = Z_95) -> dict[str, Column]:
    """Wilson interval pieces: centre, margin, and the bounds clipped to [0, 1].

    All pieces are null for an empty group.
    """
    n = F.nullif(col(total).cast("double"), F.lit(0.0))
    p = col(successes).cast("double") / n
    z2 = z * z
    spread = F.lit(1.0) + F.lit(z2) / n
    centre = (p + F.lit(z2) / (F.lit(2.0) * n)) / spread
    margin = (
        F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / n + F.lit(z2) / (F.lit(4.0) * n * n)) / spread
    )
    return {
        "centre": centre,
        "margin": margin,
        # At 0 and 1 a bound meets the rate itself; rounding may not push it past.
        "low": F.least(clip(centre - margin, 0.0, 1.0), p),
        "high": F.greatest(clip(centre + margin, 0.0, 1.0), p),
    }


def band(value: Column | str, bands: Sequence[tuple[float, str]]) -> Column:
    """Label of the right-closed band holding the value; null outside all bands."""
    value = col(value)
    chain = F.when(value <= BAND_FLOOR, F.lit(None).cast("string"))
    for limit, label in bands:
        chain = chain.when(value <= limit, F.lit(label))
    return chain


def band_order(label: Column | str, bands: Sequence[tuple[float, str]]) -> Column:
    """Position of a band label, so that tables sort by meaning and not by text."""
    label = col(label)
    chain = F.when(label == bands[0][1], F.lit(0))
    for position, (_, text) in enumerate(bands[1:], start=1):
        chain = chain.when(label == text, F.lit(position))
    return chain


def label_text(label: Column | str, positive_text: str, negative_text: str) -> Column:
    label = col(label)
    return F.when(label, F.lit(positive_text)).when(~label, F.lit(negative_text))


def label_boolean(label: Column | str, positive_text: str) -> Column:
    return col(label) == F.lit(positive_text)


def thousands_down(value: Column | str) -> Column:
    return (F.floor(col(value) / F.lit(1000.0)) * 1000).cast("bigint")


def thousands_up(value: Column | str) -> Column:
    return (F.ceil(col(value) / F.lit(1000.0)) * 1000).cast("bigint")


def interval_text(low: Column | str, high: Column | str, places: int = 3) -> Column:
    return F.format_string(f"[%.{places}f; %.{places}f]", col(low), col(high))


def mean_interval(
    value: Column | str, name: str, z: float = Z_95, guard_single: bool = True
) -> list[Column]:
    """Aggregates ``name``, ``name_low`` and ``name_high``: mean +- z * sd / sqrt(n).

    With one value the interval has zero width; without the guard it is null.
    """
    value = col(value).cast("double")
    mean = F.avg(value)
    margin = F.lit(z) * F.stddev_samp(value) / F.sqrt(F.count(value))
    if guard_single:
        margin = F.coalesce(margin, F.lit(0.0))
    return [mean.alias(name), (mean - margin).alias(f"{name}_low"), (mean + margin).alias(f"{name}_high")]
