"""Source to mart: clean, validate, derive, aggregate, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskloom.operators import aggregates
from riskloom.operators.cleaning import cleaning_report, drop_duplicate_rows, fix_types
from riskloom.operators.contracts import (
    ContractError,
    clean_contract,
    coerce,
    feature_contract,
    observed,
    raw_contract,
    require,
    risk_contract,
)
from riskloom.operators.features import add_features
from riskloom.operators.quality import column_profile
from riskloom.roles import DEFAULT_ROLES, Roles
from riskloom.session import discard, stage
from riskloom.sources.tables import canonical_view, open_source, project_source, source_id, write_layer

# Aggregates over the clean table, and those that need the bands.
CLEAN_AGGREGATES = {
    "group_profile": aggregates.group_profile,
    "evolution_by_age": aggregates.evolution_by_age,
    "risk_ranking": aggregates.risk_ranking,
}
FEATURE_AGGREGATES = {"segment_matrix": aggregates.segment_matrix}
AGGREGATES = {**CLEAN_AGGREGATES, **FEATURE_AGGREGATES}
WITH_INTERVALS = frozenset({"risk_ranking"})

NAMED_QUERIES = {**AGGREGATES, "column_profile": column_profile}


def query(df: DataFrame, name: str, roles: Roles = DEFAULT_ROLES, **parameters) -> DataFrame:
    """Run a named query over the canonical view of ``df``."""
    if name not in NAMED_QUERIES:
        raise KeyError(f"unknown query {name!r}; options: {sorted(NAMED_QUERIES)}")
    return NAMED_QUERIES[name](canonical_view(df, roles), roles, **parameters)


@dataclass(frozen=True)
class Cleaned:
    table: DataFrame
    report: DataFrame


@dataclass(frozen=True)
class Mart:
    features: DataFrame
    tables: dict[str, DataFrame]


def clean_step(source: DataFrame, roles: Roles = DEFAULT_ROLES, strict: bool = True) -> Cleaned:
    """Strict: neither the input nor the output may break its contract. Otherwise every row is kept, a warning names
    the broken rules with their counts, and the report says that the clean contract is violated.

    Repeated rows are those equal in *all* columns of the source, so they are taken out before anything is
    projected. The cleaned table is staged, because its report and the mart read it; both contracts are checked by the
    pass that writes it, which fails before anything reads the table.
    """
    named = source_id(source, roles)
    contract = raw_contract(roles)
    counted, source_holds = observed(source, contract, named, project_source(source, roles), strict)
    once = project_source(drop_duplicate_rows(counted), roles)
    typed = coerce(once, contract, [named] if named else [])
    counted, table_holds = observed(fix_types(typed, roles, check=False), clean_contract(roles), named, strict=strict)
    table = stage(counted)
    try:
        source_holds()
        conforming = table_holds()
    except ContractError:
        discard(table)
        raise
    return Cleaned(table, cleaning_report(source, table, roles, conforming))


def build_features(table: DataFrame, roles: Roles = DEFAULT_ROLES, strict: bool = True) -> DataFrame:
    """Derived columns, checked against the feature contract; a broken rule is an error, or a warning if not strict."""
    return require(add_features(table, roles), feature_contract(roles), source_id(table, roles), strict)


def build_aggregates(
    table: DataFrame, features: DataFrame, roles: Roles = DEFAULT_ROLES, strict: bool = True
) -> dict[str, DataFrame]:
    results = {name: build(table, roles) for name, build in CLEAN_AGGREGATES.items()}
    results |= {name: build(features, roles) for name, build in FEATURE_AGGREGATES.items()}
    for name in WITH_INTERVALS:
        require(results[name], risk_contract(), strict=strict)
    return results


def mart_step(
    table: DataFrame, roles: Roles = DEFAULT_ROLES, strict: bool = True, check_features: bool = True
) -> Mart:
    features = build_features(table, roles, strict) if check_features else add_features(table, roles)
    return Mart(features, build_aggregates(table, features, roles, strict))


def run(
    spark: SparkSession,
    source: str | DataFrame,
    target: str | None = None,
    roles: Roles = DEFAULT_ROLES,
    strict: bool = True,
    **read_options,
) -> tuple[Cleaned, Mart]:
    """Whole chain, from a path or a table. Without ``target`` no layer is written; ``strict`` as in ``clean_step``."""
    df = open_source(spark, source, **read_options) if isinstance(source, str) else source
    cleaned = clean_step(df, roles, strict)
    # The feature contract is checked by the pass that writes the features, if one does.
    mart = mart_step(cleaned.table, roles, strict, check_features=not target)
    if target:
        counted, features_hold = observed(
            mart.features, feature_contract(roles), source_id(cleaned.table, roles), strict=strict
        )
        write_layer(counted, f"{target}/features")
        features_hold()
        write_layer(cleaned.table, f"{target}/clean")
        write_layer(cleaned.report, f"{target}/cleaning_report")
        for name, table in mart.tables.items():
            write_layer(table, f"{target}/{name}")
    return cleaned, mart


def run_counts(cleaned: Cleaned, mart: Mart) -> dict[str, int]:
    """Row, duplicate, column and aggregate counts of a finished run."""
    report = {r["check"]: r["value"] for r in cleaned.report.collect()}  # nine rows
    return {
        "clean_rows": int(report["rows in clean table"]),
        "duplicates_removed": int(report["duplicates removed"]),
        "feature_columns": len(mart.features.columns),
        "aggregates": len(mart.tables),
    }
