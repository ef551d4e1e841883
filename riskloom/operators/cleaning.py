"""Cleaning: whole-row duplicates, types, label encoding, and the report about it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import label_boolean, label_text, ratio
from riskloom.roles import DEFAULT_ROLES, Roles


#: Unknown label texts an error message names; it counts all.
NAMED_LABELS = 20


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Keep one of each group of equal rows."""
    return df.dropDuplicates()


def unknown_labels(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    """Label texts outside the two accepted ones, with their row counts ``n``."""
    return (
        df.filter(~F.col(roles.label).isin(roles.positive_text, roles.negative_text))
        .groupBy(roles.label)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def binarise_label(df: DataFrame, roles: Roles = DEFAULT_ROLES, check: bool = True) -> DataFrame:
    """Text label to boolean; boolean labels pass through, unknown texts are an error."""
    if dict(df.dtypes)[roles.label] == "boolean":
        return df
    if check:
        counts = unknown_labels(df, roles)
        total = counts.agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")).first()
        if total["texts"]:
            # The message names the most frequent ones and counts all.
            shown = counts.orderBy(F.col("n").desc(), roles.label).limit(NAMED_LABELS).collect()
            names = ", ".join(f"{r[roles.label]!r} ({r['n']})" for r in shown)
            more = total["texts"] - len(shown)
            raise ValueError(
                f"unexpected labels in {roles.label!r}: {names}"
                + (f" and {more} more" if more else "")
                + f", {total['n']} rows in all; expected {[roles.positive_text, roles.negative_text]}"
            )
    return df.withColumn(roles.label, label_boolean(roles.label, roles.positive_text))


def label_as_text(df: DataFrame, roles: Roles = DEFAULT_ROLES) -> DataFrame:
    return df.withColumn(
        roles.label, label_text(roles.label, roles.positive_text, roles.negative_text)
    )


def fix_types(df: DataFrame, roles: Roles = DEFAULT_ROLES, check: bool = True) -> DataFrame:
    """Declared types in canonical order; running it twice changes nothing."""
    typed = binarise_label(df, roles, check)
    return typed.select(
        *[c for c in (roles.unit_id,) if c in df.columns],
        F.col(roles.group).cast("string").alias(roles.group),
        *[F.col(c).cast("bigint").alias(c) for c in roles.numerics],
        roles.label,
    )


def clean(df: DataFrame, roles: Roles = DEFAULT_ROLES, check: bool = True) -> DataFrame:
    """Deduplicate, then fix types."""
    return fix_types(drop_duplicate_rows(df), roles, check)


def cleaning_report(
    source: DataFrame,
    cleaned: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    conforming: bool = True,
) -> DataFrame:
    """What the cleaning step did, as (check, value, detail) texts."""
    columns = [c for c in cleaned.columns if c != roles.unit_id]
    before = source.agg(F.count(F.lit(1)).alias("rows_in"), F.lit(1).alias("one"))
    nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in columns])
    # One row per group level; the totals of these rows are the totals of the table.
    after = (
        cleaned.groupBy(roles.group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            nulls.alias("nulls"),
            F.count_if(F.col(roles.label)).alias("pos"),
            F.count(F.col(roles.label)).alias("known"),
        )
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows_out"),
            F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls"),
            F.count(roles.group).alias("groups"),
            ratio(F.sum("pos"), F.sum("known")).alias("label_rate"),
            F.lit(1).alias("one"),
        )
    )

    def entry(check, value, detail):
        return F.struct(
            F.lit(check).alias("check"), value.cast("string").alias("value"),
            F.lit(detail).alias("detail"),
        )

    expected = f"expected: {len(roles.groups)}" if roles.groups else "-"
    rule = "rule: keep the first"
    if roles.unit_id not in source.columns:
        rule += "; the source has no unit id, so units equal in all columns count as repeats"
    entries = [
        entry("rows in source", F.col("rows_in"), "-"),
        entry("duplicates removed", F.col("rows_in") - F.col("rows_out"), rule),
        entry("rows in clean table", F.col("rows_out"), "-"),
        entry("columns in clean table", F.lit(len(columns)), ", ".join(columns)),
        entry("null values", F.col("nulls"), "contract requires zero"),
        entry("distinct groups", F.col("groups"), expected),
        entry(
            "target rate",
            F.format_string("%.4f", F.col("label_rate")),
            f"share of '{roles.positive_text}'",
        ),
        entry("target type", F.lit(dict(cleaned.dtypes)[roles.label]), "boolean once binarised"),
        entry(
            "clean contract",
            F.lit("conforming" if conforming else "violated"),
            "validated before writing",
        ),
    ]
    return before.join(after, "one").select(F.inline(F.array(*entries)))
