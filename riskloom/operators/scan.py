"""Ordered scans that stay distributed: running totals, exact quantiles, average ranks.

A window without partition keys, or with a hot key, would pull its rows into one
task. Here rows are cut into buckets of near-equal size along the ordering column,
each bucket is scanned on its own, and one extra row per bucket carries the totals
of the buckets before it. Split points only balance the work: results are exact
for any split. Callers aggregate to one row per distinct value first, so no value,
however frequent, makes a bucket large.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.session import stage

_BUCKET, _HEAD, _AT = "__bucket", "__head", "__at"
_SAMPLED = 40  # sampled rows for each bucket
# A side is broadcast only when it is counted to have no more rows than this.
SMALL_SIDE = 10_000


def bucket_count(spark: SparkSession) -> int:
    """A few buckets per shuffle partition, so that hashing them spreads evenly."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def split_points(df: DataFrame, column: str, buckets: int | None = None) -> list[float]:
    """Sorted cut values dividing the rows into about ``buckets`` equal parts."""
    if buckets is None:
        buckets = bucket_count(df.sparkSession)
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    # Cuts may be half a bucket off; small sketches keep their merge cheap.
    accuracy = max(1_000, 2 * buckets)
    cuts = df.agg(F.percentile_approx(F.col(column).cast("double"), shares, accuracy)).first()[0]
    # Infinite values lie in the outermost buckets anyway.
    return sorted({c for c in cuts or [] if abs(c) < float("inf")})


def with_bucket(df: DataFrame, column: str, cuts: Sequence[float], name: str = _BUCKET) -> DataFrame:
    """Add the index of the left-closed interval [cut, next cut) holding the value."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    edges = [float("-inf"), *cuts, float("inf")]
    bucketizer = Bucketizer(splits=edges, inputCol=_AT, outputCol=name, handleInvalid="keep")
    placed = bucketizer.transform(df.withColumn(_AT, F.col(column).cast("double")))
    return placed.withColumn(name, F.col(name).cast("int")).drop(_AT)


def sampled_bucket(df: DataFrame, columns: Sequence[str], buckets: int | None = None) -> Column:
    """Bucket number that rises with the order of several columns together, nulls first; ``df`` is staged.

    Split points are rows of a bounded sample, so rows that agree in the first column are cut by the next ones.
    They go to the tasks with the function, not into the plan, and are searched by halves.
    """
    buckets = buckets or bucket_count(df.sparkSession)
    share = min(1.0, _SAMPLED * buckets / max(df.count(), 1))

    def key(row):
        return tuple((0, 0) if v is None else (1, v) for v in row)

    rows = df.select(*columns)
    sample = sorted({key(r) for r in (rows if share == 1.0 else rows.sample(False, share, 42)).collect()})
    points = sorted({sample[i * len(sample) // buckets] for i in range(1, buckets)}) if sample else []

    @F.arrow_udf("int")
    def place(*values: pa.Array) -> pa.Array:
        found = zip(*(v.to_pylist() for v in values))
        return pa.array([bisect_right(points, key(r)) for r in found], pa.int32())

    return place(*columns)


def _in_buckets(
    df: DataFrame, order: str, staged: bool, bucket: Column | None = None
) -> DataFrame:
    if bucket is not None:
        return df.withColumn(_BUCKET, bucket)
    base = df if staged else stage(df)
    return with_bucket(base, order, split_points(base, order))


def _bucket_heads(
    bucketed: DataFrame, keys: Sequence[str], sums: Sequence[str], descending: bool
) -> DataFrame:
    """Per key group and bucket: own sums, ``cum_x`` of the buckets before, ``tot_x`` of all."""
    per_bucket = bucketed.groupBy(*keys, _BUCKET).agg(*[F.sum(s).alias(s) for s in sums])
    direction = F.col(_BUCKET).desc() if descending else F.col(_BUCKET).asc()
    # Bounded input: at most one row per bucket for every key group.
    before = (
        Window.partitionBy(*keys).orderBy(direction).rowsBetween(Window.unboundedPreceding, -1)
    )
    whole = Window.partitionBy(*keys)
    return per_bucket.withColumns(
        {f"cum_{s}": F.coalesce(F.sum(s).over(before), F.lit(0)) for s in sums}
        | {f"tot_{s}": F.sum(s).over(whole) for s in sums}
    )


def _scan(
    bucketed: DataFrame,
    heads: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool,
) -> DataFrame:
    """Scan every bucket on its own, starting from its head."""
    first = heads.drop(*sums).withColumn(_HEAD, F.lit(1))
    body = bucketed.withColumns({_HEAD: F.lit(0)} | {f"cum_{s}": F.col(s) for s in sums})
    within = (
        Window.partitionBy(*keys, _BUCKET)
        .orderBy(F.col(_HEAD).desc(), F.col(order).desc() if descending else F.col(order).asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    scanned = body.unionByName(first, allowMissingColumns=True).withColumns(
        {f"cum_{s}": F.sum(f"cum_{s}").over(within) for s in sums}
        | {f"tot_{s}": F.first(f"tot_{s}").over(within) for s in sums}
    )
    return scanned.filter(F.col(_HEAD) == 0).drop(_HEAD, _BUCKET)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool = False,
    staged: bool = False,
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``cum_x`` (inclusive, in order) and ``tot_x`` per key group for each x in ``sums``.

    ``df`` holds one row per (keys, order) value. It is staged unless the caller
    already did, because the split points and the scan both read it. A caller that
    knows a balanced ``bucket`` rising with the order, such as the leading digits of
    a hash, passes it, and then nothing is staged or sampled.
    """
    bucketed = _in_buckets(df, order, staged, bucket)
    heads = _bucket_heads(bucketed, keys, sums, descending)
    return _scan(bucketed, heads, keys, order, sums, descending)


def rows_at_ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    by: str,
    ranks: Column,
    descending: bool = False,
    staged: bool = False,
) -> DataFrame:
    """The rows of ``running_totals`` whose span of ``cum_by`` holds one of the ranks.

    ``ranks`` is an array of 1-based positions, written with the key columns and
    ``tot_by``. Only buckets holding a rank are shuffled and sorted; the others are
    known by their sums.
    """
    bucketed = _in_buckets(df, order, staged)
    heads = _bucket_heads(bucketed, keys, sums, descending)
    upto = F.col(f"cum_{by}") + F.col(by)
    hit = heads.filter(F.exists(ranks, lambda r: (r > F.col(f"cum_{by}")) & (r <= upto)))
    few = hit.limit(SMALL_SIDE + 1).collect()
    small = len(few) <= SMALL_SIDE
    hit = df.sparkSession.createDataFrame(few, hit.schema) if small else stage(hit)
    wanted = hit.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], F.col(_BUCKET).alias("__b"))
    if small:
        wanted = F.broadcast(wanted)
    same = F.col(_BUCKET) == F.col("__b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{i}"))
    scanned = _scan(bucketed.join(wanted, same, "left_semi"), hit, keys, order, sums, descending)
    start = F.col(f"cum_{by}") - F.col(by)
    return scanned.filter(F.exists(ranks, lambda r: (r > start) & (r <= F.col(f"cum_{by}"))))


def value_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows (keys, variable, value, n): frequency of every non-null value of each column."""
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "variable", "value"
    )
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy(*keys, "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
    plotting: float = 1.0,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Interpolated quantiles per (keys, variable), one output column per probability name.

    ``plotting`` is the position parameter a = b of the quantile family: 1 is the
    usual linear interpolation, 0.4 the approximately unbiased one. ``counts`` lets
    a caller pass an already staged ``value_counts`` table.
    """
    keys = [*keys, "variable"]
    ready = counts is not None
    source = counts if ready else value_counts(df, keys[:-1], columns)
    n, last = F.col("tot_n").cast("double"), F.col("cum_n") - 1
    start = F.col("cum_n") - F.col("n")

    picks, results = [], []
    for name, share in probabilities.items():
        raw = n * F.lit(share) + F.lit(plotting + share * (1.0 - 2.0 * plotting)) - F.lit(1.0)
        at = F.least(F.greatest(raw, F.lit(0.0)), n - F.lit(1.0))
        low, high = F.floor(at), F.ceil(at)
        picks.append((name, at, (start <= low) & (low <= last), (start <= high) & (high <= last)))
        below, above = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        results.append((below + (above - below) * F.col(f"__w_{name}")).alias(name))

    ends = [e for _, at, _, _ in picks for e in (F.floor(at) + 1, F.ceil(at) + 1)]
    rows = rows_at_ranks(source, keys, "value", ["n"], "n", F.array(*ends), staged=ready)
    aggregates = []
    for name, at, is_low, is_high in picks:
        aggregates += [
            F.max(F.when(is_low, F.col("value"))).alias(f"__lo_{name}"),
            F.max(F.when(is_high, F.col("value"))).alias(f"__hi_{name}"),
            F.max(at - F.floor(at)).alias(f"__w_{name}"),
        ]
    return rows.groupBy(*keys).agg(*aggregates).select(*keys, *results)


#: Accuracy of the sketches behind brackets, and rows up to which a bracket holds everything.
_BRACKET_ACCURACY, _BRACKET_ALL = 5_000, 20_000
_LOWS, _HIGHS, _ROWS = "__lows_", "__highs_", "__rows_"


def bracket_aggregates(columns: Sequence[str], probabilities: dict[str, float]) -> list[Column]:
    """Aggregates that go along with any other pass: between which values each quantile must lie.

    A mergeable sketch gives values a little below and above the wanted rank. They only say where to look:
    ``quantiles_in_brackets`` counts exactly.
    """
    reach = 3.0 / _BRACKET_ACCURACY
    found = []
    for c in columns:
        x = F.col(c).cast("double")
        for name, sign in ((_LOWS, -1.0), (_HIGHS, 1.0)):
            shares = [min(max(p + sign * reach, 0.0), 1.0) for p in probabilities.values()]
            found.append(F.percentile_approx(x, shares, _BRACKET_ACCURACY).alias(name + c))
        found.append(F.count(x).alias(_ROWS + c))
    return found


def bracket_columns(columns: Sequence[str]) -> list[str]:
    return [name + c for c in columns for name in (_LOWS, _HIGHS, _ROWS)]


def quantiles_in_brackets(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    brackets: DataFrame,
    keys: Sequence[str] = (),
    plotting: float = 1.0,
) -> DataFrame:
    """``exact_quantiles`` given the staged result of ``bracket_aggregates``: one row per key group.

    Values beyond a bracket count as one value on its side, so the shuffle holds the few values near each quantile
    instead of all distinct ones. A quantile that its bracket turned out not to hold is found the plain way.
    """
    infinite = float("inf")
    names = list(probabilities)
    wanted = brackets.select(*[F.col(k).alias(f"__k_{i}") for i, k in enumerate(keys)], *bracket_columns(columns))
    # Without keys it is one row.
    if not keys or wanted.limit(SMALL_SIDE + 1).count() <= SMALL_SIDE:
        wanted = F.broadcast(wanted)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{i}"))
    entries = []
    for c in columns:
        x = F.col(c).cast("double")
        every = F.col(_ROWS + c) <= _BRACKET_ALL
        for i, name in enumerate(names):
            low, high = F.col(_LOWS + c)[i], F.col(_HIGHS + c)[i]
            value = F.when(every, x).when(x < low, -infinite).when(x > high, infinite).otherwise(x)
            entries.append(F.struct(F.lit(f"{name}/{c}").alias("variable"), value.alias("value")))
    near = (
        df.select(*keys, *columns)
        .join(wanted, same)
        .select(*keys, F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy(*keys, "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = exact_quantiles(df, columns, probabilities, keys, plotting, counts=stage(near))
    # Each variable is in one row per quantile; only its own quantile counts there.
    own = [F.max(F.when(F.col("variable").startswith(f"{n}/"), F.col(n))).alias(n) for n in names]
    column = F.expr("substring(variable, instr(variable, '/') + 1)").alias("variable")
    found = found.groupBy(*keys, column).agg(*own)
    # Without keys it is one row per column.
    found = stage(found) if keys else df.sparkSession.createDataFrame(found.collect(), found.schema)
    missed = F.lit(False)
    for n in names:
        missed = missed | F.isnan(n) | (F.abs(n) == infinite)
    if found.filter(missed).isEmpty():
        return found
    return exact_quantiles(df, columns, probabilities, keys, plotting)


def approximate_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    accuracy: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Opt-in sketch version of ``exact_quantiles``: one pass, rank error at most 1/accuracy."""
    shares = list(probabilities.values())
    sketched = df.groupBy(*keys).agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(c) for c in columns]
    )
    records = [
        F.struct(
            F.lit(c).alias("variable"),
            *[F.element_at(c, i).alias(n) for i, n in enumerate(probabilities, start=1)],
        )
        for c in columns
    ]
    return sketched.select(*keys, F.inline(F.array(*records)))


def average_ranks(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tie-averaged rank of every value in a ``value_counts`` table."""
    scanned = running_totals(counts, [*keys, "variable"], "value", ["n"])
    return scanned.withColumn(
        "avg_rank", F.col("cum_n") - (F.col("n") - F.lit(1)) / F.lit(2.0)
    )
