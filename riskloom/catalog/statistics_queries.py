"""Descriptive statistics and association queries."""

from riskloom.catalog.inputs import ROLES, units, units_dirty
from riskloom.catalog.quality_queries import DESCRIBED, correlation_sql, describe_sql
from riskloom.catalog.registry import register
from riskloom.operators import stats
from riskloom.operators.aggregates import describe
from riskloom.operators.scan import exact_quantiles

NUMERICS = ("age", "usage_km", "events")

TARGETED = "select *, cast(label as integer) as target from units"


@register("numeric_description", describe_sql(NUMERICS, "units"), DESCRIBED, places=5)
def description(spark, sf_dir):
    return describe(units(spark, sf_dir), ROLES.numerics)


@register(
    "usage_quantiles_by_group",
    """select grp, 'usage_km' as variable, quantile_cont(usage_km, 0.05) as p05,
       quantile_cont(usage_km, 0.5) as p50, quantile_cont(usage_km, 0.95) as p95 from units group by grp""",
    "p05 p50 p95",
    places=6,
)
def quantiles(spark, sf_dir):
    return exact_quantiles(
        units(spark, sf_dir), ["usage_km"], {"p05": 0.05, "p50": 0.5, "p95": 0.95}, keys=["grp"]
    )


@register(
    "pearson_matrix",
    f"with t as ({TARGETED})\nfinal " + correlation_sql((*NUMERICS, "target"), "t"),
    "r",
)
def pearson(spark, sf_dir):
    return stats.correlation_matrix(units(spark, sf_dir), ROLES.numerics, label="label")


def _ranks(source: str, columns) -> str:
    ranks = ", ".join(
        f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2e0 as {c}" for c in columns
    )
    return f"select {ranks} from {source}"


@register(
    "spearman_matrix",
    f"with t as ({TARGETED}),\nk as ({_ranks('t', (*NUMERICS, 'target'))})\nfinal "
    + correlation_sql((*NUMERICS, "target"), "k"),
    "r",
)
def spearman(spark, sf_dir):
    return stats.correlation_matrix(units(spark, sf_dir), ROLES.numerics, "spearman", "label")


NULLS = "select age, usage_km, events from dirty"


@register("pearson_matrix_with_nulls", f"with t as ({NULLS})\nfinal " + correlation_sql(NUMERICS, "t"), "r", ("units", "dirty"))
def pearson_nulls(spark, sf_dir):
    return stats.correlation_matrix(units_dirty(spark, sf_dir), ROLES.numerics)


def _complete_ranks(a: str, b: str) -> str:
    """Correlation of two columns' ranks over the rows complete in both."""
    rank = "rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2e0"
    return f"""(select corr(ra, rb) from (select {rank.format(c=a)} as ra, {rank.format(c=b)} as rb
  from t where {a} is not null and {b} is not null))"""


@register(
    "spearman_matrix_with_nulls",
    f"with t as ({NULLS})\nfinal "
    + " union all ".join(
        f"select '{a}' as variable, '{b}' as other, {'1e0' if a == b else _complete_ranks(a, b)} as r"
        for a in NUMERICS
        for b in NUMERICS
    ),
    "r",
    ("units", "dirty"),
)
def spearman_nulls(spark, sf_dir):
    return stats.correlation_matrix(units_dirty(spark, sf_dir), ROLES.numerics, "spearman")


def t_tail(t: str, dof: str, parity: str) -> str:
    """Two-sided Student tail as the finite series for integer degrees of freedom.

    The k-th coefficient comes from log-gamma: odd dof uses (2k)!!/(2k+1)!!, even
    dof (2k-1)!!/(2k)!!.
    """
    c2 = f"(({dof}) / (({dof}) + ({t}) * ({t})))"
    theta = f"atan(abs({t}) / sqrt({dof}))"
    if parity == "odd":
        term = f"exp(lgamma(k + 1e0) + 0.5e0 * ln(pi()) - lgamma(k + 1.5e0) + k * ln({c2})) / 2e0"
        series = f"(select sum({term}) from range(cast((({dof}) - 1) / 2 as bigint)) as s(k))"
        return f"greatest(0e0, 1e0 - 2e0 / pi() * ({theta} + sin({theta}) * cos({theta}) * {series}))"
    term = f"exp(lgamma(k + 0.5e0) - 0.5e0 * ln(pi()) - lgamma(k + 1e0) + k * ln({c2}))"
    series = f"(select sum({term}) from range(cast(({dof}) / 2 as bigint)) as s(k))"
    return f"greatest(0e0, 1e0 - sin({theta}) * {series})"


def student_sql(t: str, dof: str) -> str:
    odd, even = t_tail(t, dof, "odd"), t_tail(t, dof, "even")
    return f"case when cast({dof} as bigint) % 2 = 1 then {odd} else {even} end"


def _with_target(c: str) -> str:
    return f"""select '{c}' as variable, (select corr({c}, target) from t) as r,
  (select corr({c}, target) from k) as rho, (select count(*) - 2e0 from t) as dof"""


@register(
    "correlation_with_target",
    f"with t as ({TARGETED}),\nk as ({_ranks('t', (*NUMERICS, 'target'))}),\nc as ("
    + " union all ".join(_with_target(c) for c in NUMERICS)
    + "),\ns as (select *, r * sqrt(dof / (1e0 - r * r)) as tr, rho * sqrt(dof / (1e0 - rho * rho)) as ts from c)"
    + f"\nfinal select variable, r, {student_sql('tr', 'dof')} as r_p, rho, {student_sql('ts', 'dof')} as rho_p,"
    + f" {student_sql('tr', 'dof')} < 0.05e0 as significant from s",
    "r r_p rho rho_p",
    places=8,
)
def with_target(spark, sf_dir):
    return stats.correlation_with_target(units(spark, sf_dir), ROLES.numerics, ROLES)


def _vif(a: str, b: str, c: str) -> str:
    r2 = "(ab * ab + ac * ac - 2e0 * ab * ac * bc) / (1e0 - bc * bc)"
    return f"""select '{a}' as variable, {r2} as r2, 1e0 / (1e0 - {r2}) as vif
  from (select corr({a}, {b}) as ab, corr({a}, {c}) as ac, corr({b}, {c}) as bc from units)"""


@register(
    "variance_inflation",
    "\nunion all\n".join(
        _vif(*o)
        for o in (
            ("age", "usage_km", "events"),
            ("usage_km", "age", "events"),
            ("events", "age", "usage_km"),
        )
    ),
    "r2 vif",
)
def inflation(spark, sf_dir):
    return stats.variance_inflation(units(spark, sf_dir), ROLES.numerics)


def chi_sql(column: str) -> str:
    """Statistic from observed and expected cells; the tail is the closed form for even dof."""
    return f"""with o as (select {column} as level, count(*) * 1e0 as n, count(*) filter (where label) * 1e0 as pos
            from units group by {column}),
a as (select sum(n) as n, sum(pos) / sum(n) as p, count(*) as k from o),
x as (select sum(pow(o.pos - o.n * a.p, 2) / (o.n * a.p)
           + pow((o.n - o.pos) - o.n * (1e0 - a.p), 2) / (o.n * (1e0 - a.p))) as chi2,
           max(a.k) as k, max(a.n) as n from o, a),
w as (select chi2, exp(-chi2 / 2e0) * (select sum(exp(j * ln(chi2 / 2e0) - lgamma(j + 1e0)))
        from range(cast((k - 1) / 2 as bigint)) as s(j)) as p_value, k, n from x)
final select '{column}' as variable, chi2, p_value, cast(k - 1 as integer) as dof,
  sqrt(chi2 / n) as cramers_v, cast(n as bigint) as n, p_value < 0.05e0 as significant from w"""


@register("chi_square_group", chi_sql("grp"), "chi2 p_value cramers_v")
def chi_group(spark, sf_dir):
    return stats.chi_square(units(spark, sf_dir), "grp", ROLES)


YATES_SQL = """with t as (select events >= 3 as level, count(*) * 1e0 as n, count(*) filter (where label) * 1e0 as pos
            from units group by events >= 3),
a as (select sum(n) as n, sum(pos) / sum(n) as p from t),
g as (select abs(t.pos - t.n * a.p) as d, t.n * a.p as e1, t.n * (1e0 - a.p) as e0, a.n as total from t, a),
x as (select sum(pow(d - least(d, 0.5e0), 2) / e1 + pow(d - least(d, 0.5e0), 2) / e0) as chi2,
             max(total) as n from g),
p as (select chi2, n, 2e0 * (1e0 - 0.5e0) as unused from x)
final select 'many_events' as variable, chi2, 1 as dof, sqrt(chi2 / n) as cramers_v,
  cast(n as bigint) as n, chi2 > 3.841458820694124e0 as significant from p"""


@register("chi_square_two_by_two", YATES_SQL, "chi2 cramers_v", places=6)
def chi_two(spark, sf_dir):
    from riskloom.operators.features import add_features

    return stats.chi_square(add_features(units(spark, sf_dir), ROLES), "many_events", ROLES).drop(
        "p_value"
    )
