"""Contracts, data quality, cleaning and feature queries."""

from pyspark.sql import functions as F

from riskloom.catalog.inputs import ROLES, table, units, units_dirty, units_repeated, units_text
from riskloom.catalog.mart_queries import FEATURES
from riskloom.catalog.registry import register
from riskloom.functions.columns import interval_text
from riskloom.operators import contracts, quality
from riskloom.operators.aggregates import rate_by_level, risk_ranking
from riskloom.operators.cleaning import (
    cleaning_report,
    drop_duplicate_rows,
    fix_types,
    label_as_text,
    unknown_labels,
)
from riskloom.operators.features import add_features, feature_correlation, feature_summary
from riskloom.plans.mart import build_features, clean_step, query
from riskloom.session import stage

DOMAIN = "('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')"


def _rules(rows: list[tuple[str, str, str]], source: str, identity: str = "unit_id") -> str:
    """Failure rows of (column, check, failing condition) rules as one UNION ALL."""
    parts = [
        f"""select 'Column' as schema_context, '{c}' as "column", '{k}' as "check",
        cast({c} as varchar) as failure_case, cast({identity} as varchar) as row_id
        from {source} where {bad}"""
        for c, k, bad in rows
    ]
    return "\nunion all\n".join(parts)


RAW_RULES = [
    ("grp", "not_nullable", "grp is null"),
    ("grp", "isin", f"grp not in {DOMAIN}"),
    ("age", "not_nullable", "age is null"),
    ("age", "greater_than_or_equal_to(0)", "age < 0"),
    ("age", "less_than_or_equal_to(30)", "age > 30"),
    ("usage_km", "not_nullable", "usage_km is null"),
    ("usage_km", "greater_than_or_equal_to(0)", "usage_km < 0"),
    ("usage_km", "less_than_or_equal_to(500000)", "usage_km > 500000"),
    ("events", "not_nullable", "events is null"),
    ("events", "greater_than_or_equal_to(0)", "events < 0"),
    ("events", "less_than_or_equal_to(100)", "events > 100"),
    ("label", "not_nullable", "label is null"),
    ("label", "isin", "label not in ('Sim', 'Não')"),
]


@register("contract_failures_raw", _rules(RAW_RULES, "dirty"), views=("units", "dirty"))
def raw_failures(spark, sf_dir):
    return contracts.failures(units_dirty(spark, sf_dir), contracts.raw_contract(ROLES), "unit_id")


@register(
    "contract_summary_raw",
    f"""with f as ({_rules(RAW_RULES, "dirty")})
final select count(*) = 0 as conforming, (select count(*) from dirty) as n_rows,
  5 as n_columns, count(*) as n_failures,
  coalesce(string_agg(distinct "check", ', ' order by "check"), '') as failed_checks from f""",
    views=("units", "dirty"),
)
def raw_summary(spark, sf_dir):
    return contracts.summary(units_dirty(spark, sf_dir), contracts.raw_contract(ROLES), "unit_id")


@register(
    "contract_check_counts",
    "\nunion all\n".join(
        f"""select '{c}' as "column", '{k}' as "check", count(*) filter (where {bad}) as n_failures,
        count(*) as n_rows from dirty"""
        for c, k, bad in RAW_RULES
    ),
    views=("units", "dirty"),
)
def raw_counts(spark, sf_dir):
    return contracts.check_counts(units_dirty(spark, sf_dir), contracts.raw_contract(ROLES), "unit_id")


COERCE_RULES = """select 'Column' as schema_context, 'age' as "column", 'coerce_dtype(''bigint'')' as "check",
  age as failure_case, cast(unit_id as varchar) as row_id
from (select unit_id, case when unit_id % 89 = 0 then 'n/a' when unit_id % 89 = 1 then age || '.5'
      else cast(age as varchar) end as age from units)
where unit_id % 89 in (0, 1)"""


@register("contract_failures_coercion", COERCE_RULES)
def coercion(spark, sf_dir):
    kind = F.col("unit_id") % 89
    text = F.col("age").cast("string")
    spoiled = units_text(spark, sf_dir).withColumn(
        "age",
        F.when(kind == 0, F.lit("n/a")).when(kind == 1, F.concat(text, F.lit(".5"))).otherwise(text),
    )
    return contracts.failures(spoiled, contracts.raw_contract(ROLES), "unit_id")


@register(
    "contract_failures_schema",
    """select * replace (cast(row_id as varchar) as row_id) from (values
  ('DataFrameSchema', null, 'column_in_dataframe', 'events', null),
  ('DataFrameSchema', 'extra', 'column_in_schema', 'extra', null),
  ('Column', 'label', 'dtype(''boolean'')', 'string', null))
  as t(schema_context, "column", "check", failure_case, row_id)""",
)
def wrong_schema(spark, sf_dir):
    df = units_text(spark, sf_dir).withColumnRenamed("events", "extra")
    return contracts.failures(df, contracts.clean_contract(ROLES), "unit_id")


FEATURE_RULES = [
    ("usage_km", "greater_than_or_equal_to(0)", "usage_km < 0"),
    ("usage_per_year", "greater_than(0)", "usage_per_year <= 0"),
    ("usage_per_year", "less_than_or_equal_to(500000)", "usage_per_year > 500000"),
    ("events_per_year", "greater_than_or_equal_to(0)", "events_per_year < 0"),
    ("events_per_10k", "not_nullable", "events_per_10k is null"),
    ("events_per_10k", "greater_than_or_equal_to(0)", "events_per_10k < 0"),
    ("usage_band", "not_nullable", "usage_band is null"),
]

SPOILED_FEATURES = FEATURES.replace(
    "from units",
    """from (select * replace (case when unit_id % 97 = 1 then -usage_km when unit_id % 97 = 5 then 0
                               else usage_km end as usage_km) from units)""",
)


@register(
    "contract_failure_counts_features",
    f"""with f as ({SPOILED_FEATURES}),
v as ({_rules(FEATURE_RULES, "f")})
final select "column", "check", count(*) as n from v group by "column", "check" """,
)
def feature_failures(spark, sf_dir):
    kind = F.col("unit_id") % 97
    usage = F.col("usage_km")
    spoiled = units(spark, sf_dir).withColumn(
        "usage_km", F.when(kind == 1, -usage).when(kind == 5, F.lit(0)).otherwise(usage)
    )
    found = contracts.failures(
        add_features(spoiled, ROLES), contracts.feature_contract(ROLES), "unit_id"
    )
    return found.groupBy("column", "check").agg(F.count(F.lit(1)).alias("n"))


@register(
    "contract_failures_risk_table",
    """with r as (select grp, count(*) as n_units, count(*) filter (where label) as n_positive
                 from units group by grp),
t as (select grp, n_units, n_units + 1 as n_positive, 1.5e0 as rate, 0.5e0 as ci_low, 0.4e0 as ci_high from r),
f as (select 'Column' as schema_context, 'rate' as "column", 'less_than_or_equal_to(1)' as "check",
             '1.5' as failure_case, grp as row_id from t
      union all select 'DataFrameSchema', null, 'interval_contains_estimate', 'false', grp from t
      union all select 'DataFrameSchema', null, 'positives_within_total', 'false', grp from t)
final select * from f""",
)
def risk_failures(spark, sf_dir):
    broken = rate_by_level(units(spark, sf_dir), "grp", ROLES).select(
        "grp",
        "n_units",
        (F.col("n_units") + 1).alias("n_positive"),
        F.lit(1.5).alias("rate"),
        F.lit(0.5).alias("ci_low"),
        F.lit(0.4).alias("ci_high"),
    )
    return contracts.failures(broken, contracts.risk_contract(), "grp")


@register(
    "contract_summary_risk_ranking",
    """select true as conforming, count(distinct grp) as n_rows, 8 as n_columns, cast(0 as bigint) as n_failures,
       '' as failed_checks from units""",
)
def ranking_contract(spark, sf_dir):
    return contracts.summary(risk_ranking(units(spark, sf_dir), ROLES), contracts.risk_contract())


def _profile(column: str, kind: str, numeric: bool) -> str:
    low, high = (
        (f"cast(min({column}) as double)", f"cast(max({column}) as double)")
        if numeric
        else ("cast(null as double)", "cast(null as double)")
    )
    return f"""select '{column}' as variable, '{kind}' as kind, count(*) as n_rows,
  count({column}) as n_filled, count(*) - count({column}) as n_null,
  count(distinct {column}) as n_distinct, {low} as minimum, {high} as maximum from dirty"""


@register(
    "column_profile",
    "\nunion all\n".join(
        [_profile("grp", "category", False)]
        + [_profile(c, "number", True) for c in ("age", "usage_km", "events")]
        + [_profile("label", "target", False)]
    ),
    "minimum maximum",
    views=("units", "dirty"),
)
def profile(spark, sf_dir):
    return quality.column_profile(units_dirty(spark, sf_dir), ROLES)


@register(
    "duplicate_rows",
    """select grp, age, usage_km, events, label, count(*) as n_occurrences from dirty
       group by grp, age, usage_km, events, label having count(*) > 1""",
    views=("units", "dirty"),
)
def duplicates(spark, sf_dir):
    return quality.duplicate_rows(units_dirty(spark, sf_dir), list(ROLES.canonical))


@register(
    "duplicate_line_keys",
    """select l_orderkey, l_linenumber, count(*) as n_occurrences from lineitem
       group by l_orderkey, l_linenumber having count(*) > 1""",
    views=(),
)
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("deduplicated_units", "select distinct * from dirty", views=("units", "dirty"))
def deduplicated(spark, sf_dir):
    return drop_duplicate_rows(units_dirty(spark, sf_dir))


@register(
    "unknown_label_texts",
    "select label, count(*) as n from dirty where label not in ('Sim', 'Não') group by label",
    views=("units", "dirty"),
)
def unknown(spark, sf_dir):
    return unknown_labels(units_dirty(spark, sf_dir), ROLES)


@register("typed_units", "select * from units")
def typed(spark, sf_dir):
    return fix_types(units_text(spark, sf_dir), ROLES)


@register(
    "label_round_trip",
    "select * replace (case when label then 'Sim' else 'Não' end as label) from units",
)
def round_trip(spark, sf_dir):
    return label_as_text(fix_types(units_text(spark, sf_dir), ROLES), ROLES)


def _tukey(c: str) -> str:
    q = f"(select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from units)"
    outside = f"count(*) filter (where {c} < q1 - 1.5e0 * (q3 - q1) or {c} > q3 + 1.5e0 * (q3 - q1))"
    return f"""select '{c}' as variable, q1, q3, q3 - q1 as iqr, q1 - 1.5e0 * (q3 - q1) as lower,
  q3 + 1.5e0 * (q3 - q1) as upper, {outside} as n_outliers,
  {outside} * 1e0 / count(*) as share_outliers from units, {q} as q group by q1, q3"""


@register(
    "tukey_outliers",
    "\nunion all\n".join(_tukey(c) for c in ("age", "usage_km", "events")),
    "q1 q3 iqr lower upper share_outliers",
)
def outliers(spark, sf_dir):
    return quality.tukey_outliers(units(spark, sf_dir), ROLES.numerics)


@register(
    "usage_consistency",
    """select *, usage_km * 1e0 / age as yearly_usage,
       not (usage_km * 1e0 / age between 2000 and 60000) as out_of_range
       from units where age > 0""",
    "yearly_usage",
    places=6,
)
def consistency(spark, sf_dir):
    return quality.usage_consistency(units(spark, sf_dir), ROLES)


@register(
    "usage_consistency_report",
    """select count(*) filter (where age > 0) as n_evaluated, count(*) filter (where age = 0) as n_age_zero,
       min(y) as min_yearly, max(y) as max_yearly,
       count(*) filter (where not (y between 2000 and 60000)) as n_out_of_range,
       quantile_cont(y, 0.5) as median_yearly
       from (select age, case when age > 0 then usage_km * 1e0 / age end as y from units)""",
    "min_yearly max_yearly median_yearly",
    places=6,
)
def consistency_report(spark, sf_dir):
    return quality.usage_consistency_report(units(spark, sf_dir), ROLES)


REPORT_SQL = """with t as (select count(*) as rows_in from repeated),
c as (select count(*) as n, count(distinct grp) as groups,
             count(*) filter (where label = 'Sim') * 1e0 / count(*) as rate from (select distinct * from repeated))
final select 'rows in source' as "check", cast(rows_in as varchar) as value, '-' as detail from t
union all select 'duplicates removed', cast(rows_in - n as varchar), 'rule: keep the first' from t, c
union all select 'rows in clean table', cast(n as varchar), '-' from c
union all select 'columns in clean table', '5', 'grp, age, usage_km, events, label'
union all select 'null values', '0', 'contract requires zero'
union all select 'distinct groups', cast(groups as varchar), 'expected: 5' from c
union all select 'target rate', printf('%.4f', rate), 'share of ''Sim''' from c
union all select 'target type', 'boolean', 'boolean once binarised'
union all select 'clean contract', 'conforming', 'validated before writing'"""

REPEATED_SQL = """with repeated as (select unit_id, grp, age, usage_km, events,
  case when label then 'Sim' else 'Não' end as label
  from units, (values (1), (2)) as copies(copy) where copy = 1 or unit_id % 97 = 6),
"""


@register("cleaning_report", REPEATED_SQL + REPORT_SQL[5:])
def report(spark, sf_dir):
    return clean_step(units_repeated(spark, sf_dir), ROLES, strict=False).report


@register("cleaned_units", "select * from units")
def cleaned(spark, sf_dir):
    return clean_step(units_repeated(spark, sf_dir), ROLES, strict=False).table


@register(
    "schema_listing",
    """select 0 as ordinal, 'unit_id' as variable, 'bigint' as type, min(cast(unit_id as varchar)) as example from units
union all select 1, 'grp', 'string', min(grp) from units
union all select 2, 'age', 'bigint', min(cast(age as varchar)) from units
union all select 3, 'usage_km', 'bigint', min(cast(usage_km as varchar)) from units
union all select 4, 'events', 'bigint', min(cast(events as varchar)) from units
union all select 5, 'label', 'boolean', min(cast(label as varchar)) from units""",
)
def listing(spark, sf_dir):
    return quality.schema_listing(units(spark, sf_dir))


@register(
    "unit_features", FEATURES, "usage_per_year events_per_year events_per_10k", places=6
)
def features(spark, sf_dir):
    return build_features(units(spark, sf_dir), ROLES, strict=False)


PAIRS = ("age", "usage_km", "events", "usage_per_year", "events_per_year", "events_per_10k")


def correlation_sql(columns, source):
    cells = [
        f"select '{a}' as variable, '{b}' as other, "
        + ("1e0" if a == b else f"corr({a}, {b})")
        + f" as r from {source}"
        + (" limit 1" if a == b else "")
        for a in columns
        for b in columns
    ]
    return "\nunion all\n".join(f"select * from ({c})" for c in cells)


@register(
    "feature_correlation",
    f"with f as ({FEATURES})\nfinal " + correlation_sql(PAIRS, "f"),
    "r",
)
def correlation(spark, sf_dir):
    return feature_correlation(add_features(units(spark, sf_dir), ROLES), ROLES)


def describe_sql(columns, source, extra=""):
    return "\nunion all\n".join(
        f"""select '{c}' as variable, count({c}) as n, avg({c}) as mean, stddev_samp({c}) as sd,
  cast(min({c}) as double) as min, quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as median,
  quantile_cont({c}, 0.75) as q75, cast(max({c}) as double) as max, stddev_samp({c}) / avg({c}) as cv,
  skewness({c}) as skewness, kurtosis({c}) as kurtosis,
  quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) as iqr{extra.format(c=c)} from {source}"""
        for c in columns
    )


DESCRIBED = "mean sd min q25 median q75 max cv skewness kurtosis iqr"


@register(
    "feature_summary",
    f"with f as ({FEATURES})\nfinal "
    + describe_sql(PAIRS[3:], "f", ", count(*) filter (where isinf({c})) as n_infinite"),
    DESCRIBED,
    places=5,
)
def summary(spark, sf_dir):
    return feature_summary(add_features(units(spark, sf_dir), ROLES))


@register(
    "rate_interval_text",
    f"""with r as (select grp, n_positive * 1e0 / n_units as p, n_units as n from
  (select grp, count(*) as n_units, count(*) filter (where label) as n_positive from units group by grp)),
b as (select grp, (p + 3.841458820694124e0 / (2e0 * n)) / (1e0 + 3.841458820694124e0 / n) as c,
  1.959963984540054e0 * sqrt(p * (1e0 - p) / n + 3.841458820694124e0 / (4e0 * n * n))
  / (1e0 + 3.841458820694124e0 / n) as m from r)
final select grp, '[' || printf('%.3f', greatest(c - m, 0e0)) || '; ' || printf('%.3f', least(c + m, 1e0)) || ']'
  as interval_text from b""",
)
def interval_texts(spark, sf_dir):
    ranked = query(units(spark, sf_dir), "risk_ranking", ROLES)
    return ranked.select("grp", interval_text("ci_low", "ci_high").alias("interval_text"))
