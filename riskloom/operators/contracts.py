"""Declared data contracts: every violation as a row, from one pass over the data."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from riskloom.roles import (
    AGE_BAND,
    AGE_DOMAIN,
    DEFAULT_ROLES,
    EVENTS_DOMAIN,
    EVENTS_PER_USAGE,
    MANY_EVENTS,
    USAGE_BAND,
    USAGE_DOMAIN,
    YEARLY_EVENTS,
    YEARLY_USAGE,
    Roles,
)

FAILURE_SCHEMA = (
    "schema_context string, column string, check string, failure_case string, row_id string"
)
TABLE, COLUMN = "DataFrameSchema", "Column"


@dataclass(frozen=True)
class Field:
    """What one column must look like."""

    name: str
    dtype: str
    nullable: bool = False
    isin: tuple = ()
    ge: float | None = None
    le: float | None = None
    gt: float | None = None
    finite: bool = False


@dataclass(frozen=True)
class RowCheck:
    """A condition over several columns; a null outcome does not fail it."""

    name: str
    holds: Callable[[], Column]


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    strict: bool = True
    coerce: bool = False
    unique_names: bool = False
    row_checks: tuple[RowCheck, ...] = field(default=())

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    def extended(self, name: str, *fields: Field, **changes) -> Contract:
        """A contract that inherits everything and adds fields."""
        return replace(self, name=name, fields=(*self.fields, *fields), **changes)


class ContractError(ValueError):
    """Raised in strict mode, naming every failed check with its count."""


# --------------------------------------------------------------------------- contracts


def raw_contract(roles: Roles = DEFAULT_ROLES) -> Contract:
    """Source data: text label, types are coerced, duplicates are still allowed."""
    return Contract(
        "raw",
        (
            Field(roles.group, "string", isin=roles.groups),
            Field(roles.age, "bigint", ge=AGE_DOMAIN[0], le=AGE_DOMAIN[1]),
            Field(roles.usage, "bigint", ge=USAGE_DOMAIN[0], le=USAGE_DOMAIN[1]),
            Field(roles.events, "bigint", ge=EVENTS_DOMAIN[0], le=EVENTS_DOMAIN[1]),
            Field(roles.label, "string", isin=(roles.positive_text, roles.negative_text)),
        ),
        coerce=True,
    )


def clean_contract(roles: Roles = DEFAULT_ROLES) -> Contract:
    """Clean data: boolean label. Nothing is coerced, since text would turn into true."""
    raw = raw_contract(roles)
    return Contract(
        "clean", (*raw.fields[:-1], Field(roles.label, "boolean")), unique_names=True
    )


def feature_contract(roles: Roles = DEFAULT_ROLES) -> Contract:
    """The clean contract plus the derived columns, whose ratios must be finite."""
    return clean_contract(roles).extended(
        "features",
        Field(YEARLY_USAGE, "double", gt=0, le=USAGE_DOMAIN[1], finite=True),
        Field(YEARLY_EVENTS, "double", ge=0, finite=True),
        Field(EVENTS_PER_USAGE, "double", ge=0, finite=True),
        Field(MANY_EVENTS, "boolean"),
        Field(AGE_BAND, "string"),
        Field(USAGE_BAND, "string"),
        unique_names=False,
    )


def risk_contract() -> Contract:
    """Rate tables with intervals. Extra columns are welcome."""
    unit = {"ge": 0.0, "le": 1.0}
    return Contract(
        "risk aggregate",
        (
            Field("n_units", "bigint", gt=0),
            Field("n_positive", "bigint", ge=0),
            Field("rate", "double", **unit),
            Field("ci_low", "double", **unit),
            Field("ci_high", "double", **unit),
        ),
        strict=False,
        coerce=True,
        row_checks=(
            RowCheck(
                "interval_contains_estimate",
                lambda: (F.col("ci_low") <= F.col("rate")) & (F.col("rate") <= F.col("ci_high")),
            ),
            RowCheck("positives_within_total", lambda: F.col("n_positive") <= F.col("n_units")),
        ),
    )


# --------------------------------------------------------------------------- evaluation


def schema_failures(df: DataFrame, contract: Contract) -> list[tuple]:
    """Violations visible in the schema alone; no job runs."""
    names = [n.lower() for n in df.columns]
    found = []
    for f in contract.fields:
        if f.name.lower() not in names:
            found.append((TABLE, None, "column_in_dataframe", f.name, None))
    if contract.strict:
        expected = {c.lower() for c in contract.columns}
        found += [
            (TABLE, c, "column_in_schema", c, None) for c in df.columns if c.lower() not in expected
        ]
    if contract.unique_names:
        found += [
            (TABLE, c, "unique_column_name", c, None)
            for c in sorted({c for c in names if names.count(c) > 1})
        ]
    if not contract.coerce:
        types = dict(df.dtypes)
        found += [
            (COLUMN, f.name, f"dtype('{f.dtype}')", types[f.name], None)
            for f in contract.fields
            if f.name in types and types[f.name] != f.dtype
        ]
    return found


def _coerced(f: Field, source: str) -> tuple[Column, Column]:
    """The column in its declared type, and whether a value was lost on the way."""
    name = f"`{f.name}`"
    if source == f.dtype:
        return F.col(name), F.lit(False)
    if f.dtype == "bigint" and source not in ("tinyint", "smallint", "int"):
        # try_cast would silently cut a fraction off.
        number = F.expr(f"try_cast({name} as double)")
        whole = F.coalesce(number == F.floor(number), F.lit(False))
        value = F.when(whole, F.expr(f"try_cast({name} as bigint)"))
        value = F.coalesce(value, F.when(whole, F.expr(f"try_cast(try_cast({name} as double) as bigint)")))
    else:
        value = F.expr(f"try_cast({name} as {f.dtype})")
    return value, F.col(name).isNotNull() & value.isNull()


def _plain(number: float) -> str:
    return str(int(number)) if float(number).is_integer() else str(number)


def row_rules(df: DataFrame, contract: Contract) -> list[tuple[str, str | None, str, Column, Column]]:
    """(context, column, check, failed?, offending value) of every data-level rule."""
    types = {k.lower(): v for k, v in df.dtypes}
    rules = []
    for f in contract.fields:
        source = types.get(f.name.lower())
        if source is None or (not contract.coerce and source != f.dtype):
            continue
        value, lost = _coerced(f, source) if contract.coerce else (F.col(f"`{f.name}`"), F.lit(False))
        shown = F.col(f"`{f.name}`").cast("string")
        if contract.coerce and source != f.dtype:
            rules.append((COLUMN, f.name, f"coerce_dtype('{f.dtype}')", lost, shown))
        if not f.nullable:
            rules.append((COLUMN, f.name, "not_nullable", F.col(f"`{f.name}`").isNull(), shown))
        if f.isin:
            rules.append((COLUMN, f.name, "isin", ~value.isin(*f.isin), shown))
        limits = (
            ("greater_than_or_equal_to", f.ge, lambda v, b: v < b),
            ("less_than_or_equal_to", f.le, lambda v, b: v > b),
            ("greater_than", f.gt, lambda v, b: v <= b),
        )
        for check, bound, breaks in limits:
            if bound is not None:
                rules.append(
                    (COLUMN, f.name, f"{check}({_plain(bound)})", breaks(value, F.lit(bound)), shown)
                )
        if f.finite:
            bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
            rules.append((COLUMN, f.name, "finite", bad, shown))
    for check in contract.row_checks:
        rules.append((TABLE, None, check.name, ~check.holds(), F.lit("false")))
    return [(c, n, k, F.coalesce(bad, F.lit(False)), v) for c, n, k, bad, v in rules]


def failures(df: DataFrame, contract: Contract, row_id: str | None = None) -> DataFrame:
    """Every violation as a row. One scan; rows without violations emit nothing."""
    rules = row_rules(df, contract)
    identity = F.col(row_id).cast("string") if row_id else F.lit(None).cast("string")
    entries = [
        F.when(
            bad,
            F.struct(
                F.lit(context).alias("schema_context"),
                F.lit(column).cast("string").alias("column"),
                F.lit(check).alias("check"),
                shown.alias("failure_case"),
                identity.alias("row_id"),
            ),
        )
        for context, column, check, bad, shown in rules
    ]
    spark = df.sparkSession
    from_schema = spark.createDataFrame(schema_failures(_without(df, row_id), contract), FAILURE_SCHEMA)
    if not entries:
        return from_schema
    found = df.select(
        F.inline(F.filter(F.array(*entries), lambda entry: entry.isNotNull()))
    )
    return found.unionByName(from_schema)


def _without(df: DataFrame, row_id: str | None) -> DataFrame:
    """The row id is bookkeeping, not part of the contract."""
    return df.drop(row_id) if row_id else df


def check_counts(df: DataFrame, contract: Contract, row_id: str | None = None) -> DataFrame:
    """Violations per rule, zeros included, plus the row count; one aggregate."""
    rules = row_rules(df, contract)
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(bad).alias(f"__{i}") for i, (_, _, _, bad, _) in enumerate(rules)],
    )
    records = [
        F.struct(
            F.lit(column).cast("string").alias("column"),
            F.lit(check).alias("check"),
            F.col(f"__{i}").alias("n_failures"),
            F.col("n_rows"),
        )
        for i, (_, column, check, _, _) in enumerate(rules)
    ] + [
        F.struct(
            F.lit(column).cast("string").alias("column"),
            F.lit(check).alias("check"),
            F.lit(1).cast("bigint").alias("n_failures"),
            F.col("n_rows"),
        )
        for _, column, check, _, _ in schema_failures(_without(df, row_id), contract)
    ]
    return counted.select(F.inline(F.array(*records)))


def summary(df: DataFrame, contract: Contract, row_id: str | None = None) -> DataFrame:
    """One row: conforming, rows, columns, violations, and the failed checks by name."""
    counts = check_counts(df, contract, row_id)
    width = len(_without(df, row_id).columns)
    failed = F.array_sort(F.collect_set(F.when(F.col("n_failures") > 0, F.col("check"))))
    return counts.agg(
        (F.sum("n_failures") == 0).alias("conforming"),
        F.max("n_rows").alias("n_rows"),
        F.sum("n_failures").alias("n_failures"),
        F.concat_ws(", ", failed).alias("failed_checks"),
    ).select(
        "conforming", "n_rows", F.lit(width).alias("n_columns"), "n_failures", "failed_checks"
    )


def require(df: DataFrame, contract: Contract, row_id: str | None = None, strict: bool = True) -> DataFrame:
    """Return ``df`` if it conforms; otherwise raise with every failed check and its count, or warn if not ``strict``."""
    broken = check_counts(df, contract, row_id).filter("n_failures > 0").collect()  # one row per rule
    if broken:
        lines = [f"{r['column'] or '(table)'}: {r['check']} x {r['n_failures']}" for r in broken]
        message = f"{contract.name} contract violated\n" + "\n".join(sorted(lines))
        if strict:
            raise ContractError(message)
        warnings.warn(message, stacklevel=2)
    return df


def observed(
    df: DataFrame,
    contract: Contract,
    row_id: str | None = None,
    checked: DataFrame | None = None,
    strict: bool = True,
) -> tuple[DataFrame, Callable[[], bool]]:
    """``df`` whose rules are counted by whatever action reads it, and the check to call after that action.

    So a check rides on the pass that writes a table and needs none of its own. ``checked`` names the columns that the
    contract is about, if ``df`` holds more. A rule broken by no row is counted zero whatever tasks are run again; if
    any is broken, ``require`` counts once more, exactly, for its message. The check returns whether the rules hold,
    which it can only deny if not ``strict``.
    """
    table = df if checked is None else checked
    if schema_failures(_without(table, row_id), contract):
        require(table, contract, row_id)
    rules = row_rules(table, contract)
    if not rules:
        return df, lambda: True
    observation = Observation()
    counted = df.observe(observation, *[F.count_if(bad).alias(f"r{i}") for i, (*_, bad, _) in enumerate(rules)])

    def check() -> bool:
        holds = not any(observation.get.values())
        if not holds:
            require(table, contract, row_id, strict)
        return holds

    return counted, check


def coerce(df: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Project to the contract's columns in order, in their declared types."""
    types = {k.lower(): v for k, v in df.dtypes}
    return df.select(
        *keep,
        *[_coerced(f, types[f.name.lower()])[0].alias(f.name) for f in contract.fields],
    )
