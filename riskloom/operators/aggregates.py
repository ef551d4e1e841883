"""Grouped risk tables. Counts are integers until the last step, so results do not
depend on how rows are partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import band_order, col, positive, ratio, wilson
from riskloom.operators.scan import (
    SMALL_SIDE,
    approximate_quantiles,
    bracket_aggregates,
    quantiles_in_brackets,
    running_totals,
    sampled_bucket,
)
from riskloom.roles import (
    AGE_BAND,
    AGE_BANDS,
    DEFAULT_ROLES,
    HISTOGRAM_BINS,
    MIN_CELL_SIZE,
    MIN_LEVEL_SIZE,
    USAGE_BAND,
    USAGE_BANDS,
    Z_95,
    Roles,
)
from riskloom.session import stage


def counts(roles: Roles) -> list[Column]:
    """The two counts behind every rate."""
    return [
        F.count(F.lit(1)).alias("n_units"),
        F.count_if(positive(roles.label)).alias("n_positive"),
    ]


def add_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("rate", ratio("n_positive", "n_units"))


def add_wilson(df: DataFrame, z: float = Z_95) -> DataFrame:
    """Bounds from ``n_positive`` and ``n_units``; the width is that of the clipped bounds."""
    w = wilson("n_positive", "n_units", z)
    return df.withColumns({"ci_low": w["low"], "ci_high": w["high"]}).withColumn(
        "ci_width", F.col("ci_high") - F.col("ci_low")
    )


def group_profile(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Counts, rate, means, exact median usage and maximum events per group."""
    g = roles.group
    middle = {"median_usage": 0.5}
    # Brackets of the median come with the means; only usage values near it are looked at again.
    profile = stage(
        df.groupBy(g).agg(
            *counts(roles),
            F.avg(roles.age).alias("mean_age"),
            F.avg(roles.usage).alias("mean_usage"),
            F.avg(roles.events).alias("mean_events"),
            F.max(roles.events).alias("max_events"),
            *bracket_aggregates([roles.usage], middle),
        )
    )
    medians = (
        quantiles_in_brackets(df, [roles.usage], middle, profile, keys=[g])
        .drop("variable")
        .withColumnRenamed(g, "__g")
    )
    joined = profile.join(medians, F.col(g).eqNullSafe(F.col("__g")), "left").drop("__g")
    return (
        add_rate(joined)
        .select(
            g, "n_units", "n_positive", "rate", "mean_age", "mean_usage", "median_usage",
            "mean_events", "max_events",
        )
        .orderBy(F.col("rate").desc(), F.col(g))
    )


def evolution_by_age(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Cohort reading by age with running totals and running rate."""
    by_age = add_rate(
        df.groupBy(roles.age).agg(
            *counts(roles),
            F.avg(roles.usage).alias("mean_usage"),
            F.avg(roles.events).alias("mean_events"),
        )
    )
    totals = running_totals(by_age, [], roles.age, ["n_units", "n_positive"])
    return (
        totals.withColumnsRenamed({"cum_n_units": "cum_units", "cum_n_positive": "cum_positive"})
        .drop("tot_n_units", "tot_n_positive")
        .withColumn("cum_rate", ratio("cum_positive", "cum_units"))
        .orderBy(roles.age)
    )


def evolution_with_interval(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Evolution by age with the Wilson band of each age's rate."""
    return add_wilson(evolution_by_age(df, roles)).orderBy(roles.age)


def risk_ranking(df: DataFrame, roles: Roles = DEFAULT_ROLES, z: float = Z_95) -> DataFrame:
    """Groups by descending rate with Wilson bounds; the width here is the unclipped 2 * margin."""
    g = roles.group
    # Rate and name are one ordering key, so groups that share a rate are dealt over many buckets as well.
    rated = stage(
        add_rate(df.groupBy(g).agg(*counts(roles))).withColumns({"__down": -F.col("rate"), "__one": F.lit(1).cast("bigint")})
    )
    w = wilson("n_positive", "n_units", z)
    key = rated.withColumn("__key", F.struct("__down", g))
    placed = running_totals(key, [], "__key", ["__one"], bucket=sampled_bucket(rated, ["__down", g]))
    return placed.select(
        F.col("cum___one").cast("bigint").alias("position"),
        g,
        "n_units",
        "n_positive",
        "rate",
        w["low"].alias("ci_low"),
        w["high"].alias("ci_high"),
        (F.lit(2.0) * w["margin"]).alias("ci_width"),
    ).orderBy("position")


def interval_overlap(ranking: DataFrame) -> DataFrame:
    """One row: does the first place's interval reach down to the last place's?"""
    return ranking.agg(
        F.min_by("ci_low", "position").alias("first_low"),
        F.max_by("ci_high", "position").alias("last_high"),
    ).withColumn("overlaps", F.col("first_low") <= F.col("last_high"))


def add_band_order(df: DataFrame) -> DataFrame:
    """Sortable positions next to the two band labels."""
    return df.withColumns(
        {
            f"{AGE_BAND}_order": band_order(AGE_BAND, AGE_BANDS),
            f"{USAGE_BAND}_order": band_order(USAGE_BAND, USAGE_BANDS),
        }
    )


def segment_matrix(features: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Age band by usage band, sorted by band meaning."""
    cells = features.groupBy(AGE_BAND, USAGE_BAND).agg(
        *counts(roles), F.avg(roles.events).alias("mean_events")
    )
    return add_band_order(add_rate(cells)).orderBy(f"{AGE_BAND}_order", f"{USAGE_BAND}_order")


def suppress_small_cells(
    cells: DataFrame, rate: str = "rate", n: str = "n_units", minimum: int = MIN_CELL_SIZE
) -> DataFrame:
    """Blank the rate of cells too small to read."""
    return cells.withColumn(rate, F.when(F.col(n) >= minimum, F.col(rate)))


def segment_pivot(segments: DataFrame, measure: str = "rate") -> DataFrame:
    """Segment matrix as a grid in declared band order; every age band keeps its row."""
    wide = (
        segments.groupBy(AGE_BAND)
        .pivot(USAGE_BAND, [label for _, label in USAGE_BANDS])
        .agg(F.first(measure))
    )
    bands = [(i, label) for i, (_, label) in enumerate(AGE_BANDS)]
    rows = segments.sparkSession.createDataFrame(bands, f"{AGE_BAND}_order int, {AGE_BAND} string")
    return rows.join(wide, AGE_BAND, "left").orderBy(f"{AGE_BAND}_order")


def rate_by_level(
    df: DataFrame,
    column: str,
    roles: Roles = DEFAULT_ROLES,
    minimum: int = 0,
    z: float = Z_95,
) -> DataFrame:
    """Rate and Wilson bounds per level of any column, optionally only well-filled levels."""
    levels = df.groupBy(column).agg(*counts(roles)).filter(F.col("n_units") >= minimum)
    return add_wilson(add_rate(levels), z).orderBy(column)


def rate_by_events(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return rate_by_level(df, roles.events, roles, MIN_LEVEL_SIZE)


def contingency(df: DataFrame, column: str, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Level by outcome counts; absent combinations are zero."""
    return (
        df.filter(F.col(column).isNotNull() & F.col(roles.label).isNotNull())
        .groupBy(column)
        .agg(
            F.count_if(~F.col(roles.label)).alias("n_negative"),
            F.count_if(F.col(roles.label)).alias("n_positive"),
        )
        .orderBy(column)
    )


def target_distribution(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Frequency and share of each outcome."""
    # At most one row per outcome (true, false, missing) enters the window.
    whole = Window.partitionBy()
    return (
        df.groupBy(roles.label)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("share", ratio("n", F.sum("n").over(whole)))
        .orderBy(F.col("n").desc(), roles.label)
    )


def category_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Levels, mode and rarest level of each column; ties go to the smallest level."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "variable", "level"
    )
    levels = long.groupBy("variable", "level").agg(F.count(F.lit(1)).alias("n"))
    rows = F.sum("n")
    known = F.col("level").isNotNull()
    by_count = F.min(F.when(known, F.struct(-F.col("n"), F.col("level").alias("level"))))
    by_rarity = F.min(F.when(known, F.struct(F.col("n").alias("n"), F.col("level").alias("level"))))
    return (
        levels.groupBy("variable")
        .agg(
            F.count_if(known).alias("n_levels"),
            by_count.alias("top"),
            by_rarity.alias("low"),
            rows.alias("n_rows"),
        )
        .select(
            "variable",
            "n_levels",
            F.col("top.level").alias("mode"),
            (-F.col("top.col1")).alias("mode_n"),
            ratio(-F.col("top.col1"), "n_rows").alias("mode_share"),
            F.col("low.level").alias("rarest"),
            F.col("low.n").alias("rarest_n"),
        )
        .orderBy("variable")
    )


def describe(
    df: DataFrame,
    columns: Sequence[str],
    count_infinite: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """Position, spread and shape of numeric columns, one row per column.

    Skewness and excess kurtosis carry the sample-size correction. Quartiles are
    exact unless an ``accuracy`` asks for a sketch.
    """
    columns = list(columns)
    aggregates = []
    for c in columns:
        x = F.col(c).cast("double")
        aggregates += [
            F.count(x).alias(f"{c}__n"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__sd"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
            F.skewness(x).alias(f"{c}__g1"),
            F.kurtosis(x).alias(f"{c}__g2"),
            F.count_if(F.abs(x) == F.lit(float("inf"))).alias(f"{c}__inf"),
        ]
    parts = ("n", "mean", "sd", "min", "max", "g1", "g2", "inf")
    records = [
        F.struct(F.lit(c).alias("variable"), *[F.col(f"{c}__{p}").alias(p) for p in parts])
        for c in columns
    ]
    shares = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    if accuracy:
        moments = df.agg(*aggregates)
        quartiles = approximate_quantiles(df, columns, shares, accuracy)
    else:
        # The pass for the moments also says near which values the quartiles lie.
        moments = stage(df.agg(*aggregates, *bracket_aggregates(columns, shares)))
        quartiles = quantiles_in_brackets(df, columns, shares, moments)
    moments = moments.select(F.inline(F.array(*records)))
    n = F.col("n").cast("double")
    skew = F.when(
        n > 2, F.col("g1") * F.sqrt(n * (n - F.lit(1.0))) / (n - F.lit(2.0))
    )
    kurt = F.when(
        n > 3,
        (n - F.lit(1.0))
        / ((n - F.lit(2.0)) * (n - F.lit(3.0)))
        * ((n + F.lit(1.0)) * F.col("g2") + F.lit(6.0)),
    )
    wanted = [
        "variable", "n", "mean", "sd", "min", "q25", "median", "q75", "max",
        ratio("sd", "mean").alias("cv"),
        skew.alias("skewness"),
        kurt.alias("kurtosis"),
        (F.col("q75") - F.col("q25")).alias("iqr"),
    ]
    if count_infinite:
        wanted.append(F.col("inf").alias("n_infinite"))
    return moments.join(quartiles, "variable", "left").select(*wanted).orderBy("variable")


def histogram(
    df: DataFrame, column: str, by: str, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins over each class's own range; the last bin is closed."""
    x = col(column).cast("double")
    known = df.filter(F.col(column).isNotNull()).select(F.col(by), x.alias("x"))
    ranges = known.groupBy(by).agg(F.min("x").alias("low"), F.max("x").alias("high"))
    # Counts per distinct value first: the join below sees each value once per class,
    # and the ranges are one row per outcome.
    per_value = known.groupBy(by, "x").agg(F.count(F.lit(1)).alias("n"))
    ranges = ranges.withColumnRenamed(by, "__by")
    if dict(df.dtypes)[by] == "boolean":
        ranges = F.broadcast(ranges)  # three rows at most
    else:
        ranges = stage(ranges)
        if ranges.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE:
            ranges = F.broadcast(ranges)
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    slot = F.when(width == 0.0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("low")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1))
    )
    return (
        per_value.join(ranges, F.col(by).eqNullSafe(F.col("__by")))
        .select(by, slot.cast("int").alias("bin"), "low", width.alias("width"), "n")
        .groupBy(by, "bin", "low", "width")
        .agg(F.sum("n").alias("n"))
        .select(
            by,
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_from"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_to"),
            "n",
        )
        .orderBy(by, "bin")
    )


def fleet_totals(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Base rate and global means in one row."""
    return add_rate(
        df.agg(
            *counts(roles),
            F.avg(roles.age).alias("mean_age"),
            F.avg(roles.usage).alias("mean_usage"),
            F.avg(roles.events).alias("mean_events"),
        )
    )
