"""Repeated stratified folds from a hash of the unit id."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import label01
from riskloom.operators.scan import bucket_count, running_totals
from riskloom.roles import DEFAULT_ROLES, N_FOLDS, N_REPETITIONS, SEED, Roles
from riskloom.session import discard, stage

_PREFIX_VALUES = 65_536  # four hexadecimal digits
#: Rows (a unit once per repetition) that a round of ``fold_vectors`` shuffles.
ROWS_A_ROUND = 40_000_000


def _keyed(df: DataFrame, roles: Roles) -> DataFrame:
    """``__unit`` (all columns), ``__key`` (its id), ``__row`` (a hash of all it holds) and ``y``."""
    return df.select(
        label01(roles.label).alias("y"),
        F.struct(*df.columns).alias("__unit"),
        F.xxhash64(*df.columns).alias("__row"),
        F.col(roles.unit_id).alias("__key"),
    )


def _ranked(units: DataFrame, repetitions: range, seed: int) -> DataFrame:
    """Rows of ``_keyed`` for each repetition with ``__place`` (from 0) within repetition and outcome.

    Within a repetition and outcome, units are ranked by md5(seed-repetition-id). The leading hash digits cut
    the ranking into equal parts, hence no task ever sees a whole outcome class, and ranks do not depend on
    partitioning. Rows that share an id follow a hash of all they hold.
    """
    buckets = min(bucket_count(units.sparkSession), _PREFIX_VALUES)
    dealt = units.withColumn("repetition", F.explode(F.sequence(F.lit(repetitions.start), F.lit(repetitions.stop - 1))))
    name = F.concat_ws("-", F.lit(str(seed)), F.col("repetition").cast("string"), F.col("__key").cast("string"))
    # Bytes sort as their hexadecimal digits do and are half as long.
    order = F.concat(F.unhex(F.md5(name)), F.encode(F.hex("__row"), "US-ASCII"))
    dealt = dealt.withColumns({"__hash": order, "__one": F.lit(1).cast("bigint")})
    prefix = F.conv(F.hex(F.substring("__hash", 1, 2)), 16, 10).cast("bigint")
    bucket = F.floor(prefix * buckets / F.lit(_PREFIX_VALUES)).cast("int")
    ranked = running_totals(dealt, ["repetition", "y"], "__hash", ["__one"], bucket=bucket)
    return ranked.withColumn("__place", F.col("cum___one") - 1).drop("__hash", "__one", "cum___one", "tot___one")


def assign_folds(
    df: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    n_folds: int = N_FOLDS,
    repetitions: int = N_REPETITIONS,
    seed: int = SEED,
) -> DataFrame:
    """Every row once per repetition with its ``fold`` and 0/1 outcome ``y``.

    Ranked units are dealt to the folds in turn, so fold sizes differ by at most one per outcome.
    """
    ranked = _ranked(_keyed(df, roles), range(repetitions), seed)
    fold = (F.col("__place") % n_folds).cast("int").alias("fold")
    own = [F.col("__unit")[c].alias(c) for c in df.columns if c not in ("y", "repetition", "fold")]
    return ranked.select(*own, "y", "repetition", fold)


def fold_vectors(
    df: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    n_folds: int = N_FOLDS,
    repetitions: int = N_REPETITIONS,
    seed: int = SEED,
) -> DataFrame:
    """Every row once with ``y`` and ``folds``, its fold of each repetition: the folds of ``assign_folds``.

    Rankings move id and hash alone. Equal rows are neighbours in every ranking, so their places follow from the first one
    and their number. Repetitions are ranked, and their places brought together, some at a time (``ROWS_A_ROUND``), so the
    disk holds the shuffle of one round beside places of a few bytes.
    """
    keyed = stage(_keyed(df, roles))
    rounds = -(-keyed.count() * repetitions // ROWS_A_ROUND) or 1
    step = max(1, repetitions // rounds)
    keys = ["__key", "__row", "y"]
    ranked = []
    for start in range(0, repetitions, step):
        some = _ranked(keyed.select(*keys), range(start, min(start + step, repetitions)), seed)
        ranked.append(stage(some.select(*keys, "repetition", "__place")))
    places = reduce(DataFrame.unionByName, ranked)
    starts = [F.min(F.when(F.col("repetition") == r, F.col("__place"))).alias(f"__s{r}") for r in range(repetitions)]
    own = [F.col("__unit")[c].alias(c) for c in df.columns if c not in ("y", "folds")]
    folds = F.array(*[((F.col(f"__s{r}") + F.col("__copy")) % n_folds).cast("int") for r in range(repetitions)])
    parts = []
    for k in range(rounds):
        rows, units = places, keyed.withColumn("repetition", F.lit(-1))
        if rounds > 1:
            share = F.pmod(F.xxhash64(*keys), F.lit(rounds)) == k
            rows, units = rows.filter(share), units.filter(share)
        rows = rows.unionByName(units, allowMissingColumns=True)
        per_unit = rows.groupBy(*keys).agg(
            F.any_value("__unit", True).alias("__unit"), F.count_if(F.col("repetition") == -1).alias("__n"), *starts
        )
        copies = per_unit.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1)))
        part = copies.select(*own, "y", folds.alias("folds"))
        parts.append(stage(part) if rounds > 1 else part)
    if rounds > 1:
        discard(keyed, *ranked)
    return reduce(DataFrame.unionByName, parts)


def gathered_folds(folds: DataFrame, unit_columns: Sequence[str]) -> DataFrame:
    """The rows of ``assign_folds`` brought to one per unit with ``folds``; units are told apart by ``unit_columns``."""
    pairs = F.sort_array(F.collect_list(F.struct("repetition", "fold")))
    per_unit = folds.groupBy(*unit_columns).agg(pairs.alias("__pairs"))
    n = F.size("__pairs") / F.size(F.array_distinct(F.col("__pairs")["repetition"]))
    copies = per_unit.withColumn("__n", n.cast("int")).withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))
    )
    own = F.filter(F.col("__pairs"), lambda _, i: i % F.col("__n") == F.col("__copy"))
    return copies.select(*unit_columns, own["fold"].alias("folds"))


def by_repetition(vectors: DataFrame) -> DataFrame:
    """One row per unit and repetition, from a table with fold vectors: nothing is written for it."""
    others = [c for c in vectors.columns if c != "folds"]
    return vectors.select(F.posexplode("folds").alias("repetition", "fold"), *others)


def fold_balance(folds: DataFrame) -> DataFrame:
    """Units and positives per repetition and fold."""
    return (
        folds.groupBy("repetition", "fold")
        .agg(F.count(F.lit(1)).alias("n_units"), F.sum("y").alias("n_positive"))
        .orderBy("repetition", "fold")
    )
