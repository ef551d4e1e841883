"""Fold, model and interpretation queries."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.inputs import ROLES, predictions, units, units_dirty, units_repeated
from riskloom.catalog.mart_queries import FEATURES
from riskloom.catalog.quality_queries import RAW_RULES, REPEATED_SQL
from riskloom.catalog.quality_queries import _rules as rules_sql
from riskloom.catalog.registry import register
from riskloom.operators import ensembles, explain, importance, linear, serving, trees
from riskloom.operators.design import FLAG, NUMBER, WITH_DERIVED, WITHOUT_GROUP, Term
from riskloom.operators.features import add_features
from riskloom.operators.folds import assign_folds, by_repetition, fold_balance, fold_vectors
from riskloom.operators.metrics import fold_metrics
from riskloom.plans import experiment, mart
from riskloom.plans.evaluation import evaluate
from riskloom.plans.interpretation import age_and_usage
from riskloom.roles import N_FOLDS, N_REPETITIONS
from riskloom.session import stage, staging_root
from riskloom.sources.tables import (
    load_source,
    missing_layers,
    read_layer,
    read_predictions,
    read_record,
    register_parquet,
    write_layer,
    write_record,
)


def features(spark, sf_dir):
    return add_features(units(spark, sf_dir), ROLES)


def folds(spark, sf_dir, repetitions=5):
    """Units with their fold vectors, staged."""
    return stage(fold_vectors(features(spark, sf_dir), ROLES, repetitions=repetitions))


FOLDS_SQL = f"""with features as ({FEATURES}),
dealt as (select *, cast(label as integer) as y, repetition from features, (select unnest(range(5)) as repetition)),
folds as (select * exclude (repetition), cast(repetition as integer) as repetition,
  cast((row_number() over (partition by repetition, y order by md5('42-' || repetition || '-' || unit_id)) - 1) % 5
  as integer) as fold from dealt)
final """


@register(
    "stratified_folds", FOLDS_SQL + "select unit_id, label, y, repetition, fold from folds"
)
def stratified(spark, sf_dir):
    df = assign_folds(units(spark, sf_dir).select("unit_id", "label"), ROLES)
    return df.select("unit_id", "label", "y", "repetition", "fold")


@register(
    "fold_balance",
    FOLDS_SQL
    + """select repetition, fold, count(*) as n_units, cast(sum(y) as bigint) as n_positive from folds
  group by repetition, fold""",
)
def balance(spark, sf_dir):
    return fold_balance(assign_folds(units(spark, sf_dir).select("unit_id", "label"), ROLES))


def _training(column: str, name: str) -> str:
    return f"avg({column}) as {name}_mean, stddev_pop({column}) as {name}_sd"


@register(
    "training_scales",
    FOLDS_SQL
    + f"""select a.repetition, a.fold, count(*) as n, cast(sum(b.y) as bigint) as n_positive, {_training("b.age", "age")},
  {_training("b.usage_km", "usage_km")}, {_training("ln(1 + b.events_per_10k)", "events_per_10k")}
  from (select distinct repetition, fold from folds) a
  join folds b on a.repetition = b.repetition and a.fold <> b.fold group by a.repetition, a.fold""",
    "age_mean age_sd usage_km_mean usage_km_sd events_per_10k_mean events_per_10k_sd",
    places=6,
)
def scales(spark, sf_dir):
    design = experiment.linear_design(folds(spark, sf_dir), ROLES, [WITH_DERIVED])
    moments = linear.fold_moments(design)
    place = {t.name: i for i, t in enumerate(design.terms)}
    rows = []
    for repetition, fold in sorted(moments):
        m = linear.training_moments(moments, repetition, fold)
        values = []
        for name in ("age", "usage_km", "events_per_10k"):
            values += [float(m.mean[place[name]]), float(m.variance[place[name]] ** 0.5)]
        rows.append((repetition, fold, int(m.n), int(m.positives), *values))
    names = [f"{n}_{k} double" for n in ("age", "usage_km", "events_per_10k") for k in ("mean", "sd")]
    return spark.createDataFrame(
        rows, f"repetition int, fold int, n bigint, n_positive bigint, {', '.join(names)}"
    )


def _inputs(design):
    named = [F.col(design.column(t)).alias(t.name) for t in design.terms]
    return design.table.select("repetition", "fold", "unit_id", "y", *named)


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _design_sql(levels, skewed: str) -> str:
    dummies = ", ".join(f"case when grp = '{s}' then 1e0 else 0e0 end as \"grp_{s}\"" for s in levels)
    ratios = ", ".join(
        f"{skewed.format(c=c)} as {c}" for c in ("usage_per_year", "events_per_year", "events_per_10k")
    )
    return f"""select repetition, fold, unit_id, y, {dummies}, cast(many_events as double) as many_events,
  cast(age as double) as age, cast(usage_km as double) as usage_km, cast(events as double) as events, {ratios} from folds"""


RATIOS = "usage_per_year events_per_year events_per_10k"


@register(
    "linear_model_inputs",
    FOLDS_SQL + _design_sql(SEGMENTS[1:], "ln(1e0 + {c})"),
    RATIOS,
    places=8,
)
def linear_inputs(spark, sf_dir):
    return _inputs(experiment.linear_design(folds(spark, sf_dir), ROLES, [WITH_DERIVED]))


@register("tree_model_inputs", FOLDS_SQL + _design_sql(SEGMENTS, "{c}"), RATIOS, places=6)
def tree_inputs(spark, sf_dir):
    return _inputs(experiment.tree_design(folds(spark, sf_dir), ROLES, [WITH_DERIVED]))


@register(
    "baseline_predictions",
    FOLDS_SQL
    + """select 'baseline' as model, 'without_group' as feature_set, f.repetition, f.fold, f.unit_id, f.y,
  case when 2 * t.pos > t.n then 1e0 else 0e0 end as p from folds f
  join (select a.repetition, a.fold, count(*) as n, sum(b.y) as pos
        from (select distinct repetition, fold from folds) a
        join folds b on a.repetition = b.repetition and a.fold <> b.fold group by a.repetition, a.fold) t
  on f.repetition = t.repetition and f.fold = t.fold""",
    "p",
)
def baseline(spark, sf_dir):
    design = experiment.linear_design(folds(spark, sf_dir), ROLES, [WITHOUT_GROUP])
    return linear.baseline_predictions(design)


# --------------------------------------------------------------------------- fitted models


def fitted(spark, sf_dir, sets=None, dealt=None):
    """Design, all-rows models and fold models of the logistic regression, over units dealt already if given."""
    design = experiment.linear_design(dealt or folds(spark, sf_dir), ROLES, sets)
    moments = linear.fold_moments(design)
    full = linear.fit_all_rows(design, moments)
    return design, full, linear.fit_folds(design, full, moments)


@register("logistic_coefficients_by_fold", places=6)
def fold_coefficients(spark, sf_dir):
    _, _, models = fitted(spark, sf_dir)
    return linear.model_table(spark, models)


@register("logistic_out_of_fold", places=6)
def logistic(spark, sf_dir):
    design, _, models = fitted(spark, sf_dir, [WITHOUT_GROUP])
    return linear.out_of_fold(design, models)


@register("coefficient_table", places=6)
def coefficients(spark, sf_dir):
    design = experiment.linear_design(folds(spark, sf_dir, 1), ROLES, [WITH_DERIVED])
    model = linear.fit_all_rows(design)[WITH_DERIVED]
    return explain.coefficient_table(linear.model_table(spark, [model]), ROLES)


def _experiment(spark, sf_dir):
    return experiment.run(features(spark, sf_dir), ROLES)


@register("experiment_comparison", places=6)
def compared(spark, sf_dir):
    return _experiment(spark, sf_dir).comparison


@register("experiment_paired_tests", places=6)
def tested(spark, sf_dir):
    return _experiment(spark, sf_dir).tests


@register("decision_record")
def decision(spark, sf_dir):
    run = _experiment(spark, sf_dir)
    chosen = run.chosen
    record = evaluate(run.predictions, chosen["model"], chosen["feature_set"]).decision
    return spark.createDataFrame([tuple(record.values())], list(record))


def _scored_parts(parts):
    """The scores of all feature sets, staged."""
    return stage(reduce(DataFrame.unionByName, parts))


@register("forest_fold_metrics", places=6)
def forest(spark, sf_dir):
    design = experiment.tree_design(folds(spark, sf_dir), ROLES)
    return fold_metrics(_scored_parts(ensembles.out_of_fold(trees.FOREST, design)), experiment.GROUP_KEYS)


@register("boosting_fold_metrics", places=6)
def boosting(spark, sf_dir):
    design = experiment.tree_design(folds(spark, sf_dir), ROLES)
    return fold_metrics(_scored_parts(ensembles.out_of_fold(trees.BOOSTING, design)), experiment.GROUP_KEYS)


# --------------------------------------------------------------------------- given model
#
# These queries read all units with stated coefficients, so SQL can follow every number.

GIVEN = linear.LinearModel(
    WITHOUT_GROUP,
    tuple(Term(c, c, NUMBER) for c in ROLES.numerics),
    coefficients=(0.8, 0.3, -0.2),
    centres=(4.0, 100_000.0, 1.4),
    scales=(2.0, 50_000.0, 1.2),
    intercept=1.1,
)
THRESHOLD = 0.75

@register(
    "coefficient_table_of_given_model",
    """with s as (select stddev_pop(age) as age, stddev_pop(usage_km) as usage_km, stddev_pop(events) as events from units),
terms as (select 'age' as variable, 0.8e0 as standardised, age as scale, 1e0 as unit_factor, 'per year of age' as unit from s
  union all select 'usage_km', 0.3e0, usage_km, 10000e0, 'per 10,000 of usage' from s
  union all select 'events', -0.2e0, events, 1e0, 'per recorded event' from s)
final select variable, standardised, exp(standardised) as odds_per_sd, scale, standardised / scale as "natural",
  exp(standardised / scale) as odds_per_unit, unit_factor, unit, exp(standardised / scale * unit_factor) as odds_communicable,
  abs(standardised) as magnitude from terms""",
    'standardised odds_per_sd scale "natural" odds_per_unit odds_communicable magnitude',
    places=8,
)
def given_coefficients(spark, sf_dir):
    """Scales from all units, stated coefficients: every column of the table follows."""
    design = experiment.linear_design(folds(spark, sf_dir, 1), ROLES, [WITHOUT_GROUP])
    every = linear.training_moments(linear.fold_moments(design), 0, linear.ALL_FOLDS)
    at = [design.terms.index(t) for t in GIVEN.terms]
    model = replace(
        GIVEN, centres=tuple(float(every.mean[i]) for i in at), scales=tuple(float(every.variance[i] ** 0.5) for i in at)
    )
    return explain.coefficient_table(linear.model_table(spark, [model]), ROLES)


@register(
    "out_of_fold_of_given_models",
    FOLDS_SQL
    + """select 'logistic' as model, 'without_group' as feature_set, repetition, fold, unit_id, y,
  1e0 / (1e0 + exp(-(1.1e0 + fold * 0.1e0 - repetition * 0.2e0 + (age - 4e0) / 2e0 * 0.8e0
    + (usage_km - 100000e0) / 50000e0 * 0.3e0 + (events - 1.4e0) / 1.2e0 * -0.2e0))) as p from folds""",
    "p",
    places=8,
)
def given_out_of_fold(spark, sf_dir):
    """Each fold scored by its own model: stated coefficients, an intercept that tells the models apart."""
    design = experiment.linear_design(folds(spark, sf_dir), ROLES, [WITHOUT_GROUP])
    models = [
        replace(GIVEN, repetition=r, fold=f, intercept=1.1 + f * 0.1 - r * 0.2)
        for r in range(N_REPETITIONS)
        for f in range(N_FOLDS)
    ]
    return linear.out_of_fold(design, models)


PARTS_SQL = """with parts as (select *, (age - 4e0) / 2e0 * 0.8e0 as ca, (usage_km - 100000e0) / 50000e0 * 0.3e0 as cu,
  (events - 1.4e0) / 1.2e0 * -0.2e0 as ce from units),
scored as (select *, 1e0 / (1e0 + exp(-(1.1e0 + ca + cu + ce))) as risk from parts)
final """
PARTS = "contribution_age contribution_usage_km contribution_events"


@register(
    "unit_contributions",
    PARTS_SQL
    + """select unit_id, ca as contribution_age, cu as contribution_usage_km, ce as contribution_events,
  1.1e0 as reference, 1.1e0 + ca + cu + ce as log_odds from parts""",
    PARTS + " reference log_odds",
    places=8,
)
def contribution(spark, sf_dir):
    return explain.contributions(units(spark, sf_dir), GIVEN).select(
        "unit_id", *PARTS.split(), "reference", "log_odds"
    )


@register(
    "unit_contribution_rows",
    PARTS_SQL
    + """select unit_id, 'age' as variable, ca as contribution from parts union all
  select unit_id, 'usage_km', cu from parts union all select unit_id, 'events', ce from parts""",
    "contribution",
    places=8,
)
def contribution_rows(spark, sf_dir):
    return explain.contribution_rows(units(spark, sf_dir), GIVEN, "unit_id")


CENTRED_SQL = PARTS_SQL.replace(
    "\nfinal ",
    """,
m as (select avg(ca) as ma, avg(cu) as mu, avg(ce) as me from parts),
centred as (select unit_id, ca - ma as age, cu - mu as usage_km, ce - me as events from parts, m)
final """,
)


@register(
    "centred_contributions", CENTRED_SQL + "select * from centred", "age usage_km events", places=7
)
def centred(spark, sf_dir):
    return explain.centred_contributions(units(spark, sf_dir), GIVEN, "unit_id")


@register(
    "contribution_summary",
    CENTRED_SQL
    + " union all ".join(
        f"select '{c}' as variable, avg(abs({c})) as mean_absolute, avg({c}) as mean from centred"
        for c in ROLES.numerics
    ),
    "mean_absolute mean",
    places=7,
)
def contribution_summary(spark, sf_dir):
    table = stage(explain.centred_contributions(units(spark, sf_dir), GIVEN, "unit_id"))
    return explain.contribution_summary(table, GIVEN)


def _percentile(p: float) -> str:
    """Order statistics around n * p + 0.4 + 0.2 * p, read from the value ranks."""
    at = f"greatest(least(n * {p}e0 + {0.4 + p * 0.2!r}e0, n - 1e0), 1e0)"
    return f"""(select max(case when rn = floor({at}) then usage_km end) * (1e0 - ({at.replace("n ", "max(n) ")} - floor({at.replace("n ", "max(n) ")})))
      + max(case when rn = floor({at}) + 1 then usage_km end) * ({at.replace("n ", "max(n) ")} - floor({at.replace("n ", "max(n) ")}))
      from (select usage_km, row_number() over (order by usage_km) as rn, count(*) over () as n from units))"""


def _depend(variable: str, coefficient: str, centre: str, scale: str, own: str) -> str:
    values = (
        f"(select distinct {variable} * 1e0 as g from units)"
        if variable != "usage_km"
        else f"""(select case when i = 29 then hi when i = 0 then lo else i * ((hi - lo) / 29e0) + lo end as g
             from (select {_percentile(0.05)} as lo, {_percentile(0.95)} as hi), range(30) as r(i))"""
    )
    return f"""select '{variable}' as variable, g as value,
  avg(1e0 / (1e0 + exp(-(1.1e0 + ca + cu + ce - {own} + (g - {centre}) / {scale} * {coefficient})))) as risk
  from parts, {values} as v group by g"""


DEPENDENCE_SQL = PARTS_SQL.replace(
    "\nfinal ",
    ",\ndependence as ("
    + " union all ".join(
        (
            _depend("age", "0.8e0", "4e0", "2e0", "ca"),
            _depend("usage_km", "0.3e0", "100000e0", "50000e0", "cu"),
            _depend("events", "-0.2e0", "1.4e0", "1.2e0", "ce"),
        )
    )
    + ")\nfinal ",
)


@register("partial_dependence", DEPENDENCE_SQL + "select * from dependence", "value risk", places=6)
def dependence(spark, sf_dir):
    return explain.partial_dependence(units(spark, sf_dir), GIVEN, ROLES.numerics)


@register(
    "threshold_crossing",
    DEPENDENCE_SQL
    + "select variable, min(case when risk >= 0.75e0 then value end) as crosses_at from dependence group by variable",
    "crosses_at",
    places=6,
)
def crossing(spark, sf_dir):
    curve = explain.partial_dependence(units(spark, sf_dir), GIVEN, ROLES.numerics)
    return explain.threshold_crossing(curve, THRESHOLD)


@register(
    "observed_ranges",
    """select max(age) as max_age, cast(floor(min(usage_km) / 1000e0) * 1000 as bigint) as min_usage,
  cast(ceil(max(usage_km) / 1000e0) * 1000 as bigint) as max_usage, max(events) as max_events from units""",
)
def ranges(spark, sf_dir):
    return serving.observed_ranges(units(spark, sf_dir), ROLES)


def _scored(spark, sf_dir):
    limits = {"age": (0, 10), "usage_km": (0, 300_000), "events": (0, 5)}
    return serving.score_units(units(spark, sf_dir), GIVEN, THRESHOLD, limits)


@register(
    "unit_scoring",
    PARTS_SQL
    + """select unit_id, risk, risk >= 0.75e0 as flagged, 1.1e0 as reference,
  not (age between 0 and 10 and usage_km between 0 and 300000 and events between 0 and 5) as out_of_range,
  least(ca, cu, ce) as lowest, greatest(ca, cu, ce) as highest from scored""",
    "risk reference lowest highest",
    places=8,
)
def scoring(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.select(
        "unit_id",
        "risk",
        "flagged",
        "out_of_range",
        "reference",
        F.element_at("contributions", 1)["value"].alias("lowest"),
        F.element_at("contributions", -1)["value"].alias("highest"),
    )


@register(
    "priority_list",
    PARTS_SQL
    + """select unit_id, risk, risk >= 0.75e0 as flagged,
  case when cu >= ca and cu >= ce then 'usage_km' when ce > ca then 'events' when ca >= ce then 'age' end as main_reason,
  greatest(ca, cu, ce) as main_contribution from scored""",
    "risk main_contribution",
    places=8,
)
def priorities(spark, sf_dir):
    return serving.priority_list(_scored(spark, sf_dir))


# --------------------------------------------------------------------------- importance of the given model

IMPORTANCE_SQL = FOLDS_SQL.replace(
    "\nfinal ",
    """,
parts as (select repetition, fold, unit_id, y, 1.1e0 as base, (age - 4e0) / 2e0 * 0.8e0 as ca,
  (usage_km - 100000e0) / 50000e0 * 0.3e0 as cu, (events - 1.4e0) / 1.2e0 * -0.2e0 as ce from folds),
tried as (select *, unnest(range(5)) as permutation from parts),
ring as (select *, md5('42-' || repetition || '-' || permutation || '-' || unit_id) as o from tried),
moved as (select *, coalesce(lead(ca) over w, first_value(ca) over w) as na, coalesce(lead(cu) over w, first_value(cu) over w) as nu,
  coalesce(lead(ce) over w, first_value(ce) over w) as ne from ring
  window w as (partition by repetition, fold, permutation order by o, unit_id)),
scores as (
  select repetition, fold, permutation, y, 'age' as block, round(base + cu + ce + na, 9) as s from moved
  union all select repetition, fold, permutation, y, 'usage_km', round(base + ca + ce + nu, 9) from moved
  union all select repetition, fold, permutation, y, 'events', round(base + ca + cu + ne, 9) from moved
  union all select repetition, fold, permutation, y, 'age_and_usage', round(base + ce + na + nu, 9) from moved
  union all select repetition, fold, -1, y, '', round(base + ca + cu + ce, 9) from parts),
ties as (select repetition, fold, permutation, block, s, sum(y) as pos, count(*) - sum(y) as neg
  from scores group by repetition, fold, permutation, block, s),
below as (select *, sum(neg) over (partition by repetition, fold, permutation, block order by s) - neg as under from ties),
auc as (select repetition, fold, permutation, block, sum(pos * (under + neg / 2e0)) / (sum(pos) * sum(neg)) as auc
  from below group by repetition, fold, permutation, block),
drops as (select a.repetition, a.fold, a.block, r.auc - avg(a.auc) as auc_drop from auc a
  join auc r on a.repetition = r.repetition and a.fold = r.fold and r.permutation = -1
  where a.permutation >= 0 group by a.repetition, a.fold, a.block, r.auc),
summary as (select block, avg(auc_drop) as auc_drop, stddev_samp(auc_drop) as sd, count(*) as n from drops group by block)
final """,
)


def _importance(spark, sf_dir):
    """Every block of the given model, its coefficients standing in every fold."""
    design = experiment.linear_design(folds(spark, sf_dir), ROLES, [WITHOUT_GROUP])
    models = [
        replace(GIVEN, repetition=r, fold=f) for r in range(N_REPETITIONS) for f in range(N_FOLDS)
    ]
    blocks = importance.both_readings(ROLES.numerics, age_and_usage(ROLES))
    return importance.permutation_importance(design, models, WITHOUT_GROUP, blocks)


@register(
    "permutation_importance",
    IMPORTANCE_SQL + "select repetition, fold, block, auc_drop from drops",
    "auc_drop",
    places=6,
)
def permuted(spark, sf_dir):
    return _importance(spark, sf_dir).select("repetition", "fold", "block", "auc_drop")


@register(
    "importance_summary",
    IMPORTANCE_SQL
    + """select block, case when block = 'age_and_usage' then 2 else 1 end as n_columns, auc_drop,
  auc_drop - 1.959963984540054e0 * sd / sqrt(n) as ci_low, auc_drop + 1.959963984540054e0 * sd / sqrt(n) as ci_high,
  auc_drop - 1.959963984540054e0 * sd / sqrt(n) > 0 as relevant from summary""",
    "auc_drop ci_low ci_high",
    places=6,
)
def importance_summarised(spark, sf_dir):
    return importance.importance_summary(_importance(spark, sf_dir))


@register(
    "block_importance_ratio",
    IMPORTANCE_SQL
    + """select 'age_and_usage' as block, max(case when block = 'age_and_usage' then auc_drop end) as block_drop,
  sum(case when block in ('age', 'usage_km') then auc_drop end) as sum_of_parts,
  max(case when block = 'age_and_usage' then auc_drop end) / sum(case when block in ('age', 'usage_km') then auc_drop end) as ratio
  from summary""",
    "block_drop sum_of_parts ratio",
    places=6,
)
def block_ratio(spark, sf_dir):
    summary = stage(importance.importance_summary(_importance(spark, sf_dir)))
    blocks = age_and_usage(ROLES)
    return importance.block_ratio(summary, summary, "age_and_usage", blocks["age_and_usage"])


# --------------------------------------------------------------------------- closed forms of fitted models
#
# A single unsampled tree of depth one on a flag predicts the class rates of the training rows, one boosting
# round the logistic of twice their mean of -1 and 1; a logistic fit has no gradient left. All folds, all rows.

STUMP = trees.TreeOptions(
    forest_trees=1, forest_depth=1, forest_leaf=1, bootstrap=False, boosting_rounds=1, boosting_depth=1, sampling=1.0
)
#: The same on a sample of the units, as the SQL of some queries says.
SAMPLED_STUMP = replace(STUMP, fit_rows=5_000)
FLAG_TERM = Term("young", "young", FLAG)
RATES_SQL = FOLDS_SQL.replace(
    "\nfinal ",
    """,
counted as (select repetition, fold, age <= 1 as young, count(*) as n, sum(y) as pos from folds group by repetition, fold, age <= 1),
rates as (select a.repetition, a.fold, a.young, sum(b.pos) * 1e0 / sum(b.n) as rate
  from (select distinct f.repetition, f.fold, v.young from counted f, (values (true), (false)) as v(young)) a
  join counted b on a.repetition = b.repetition and a.fold <> b.fold and a.young = b.young
  group by a.repetition, a.fold, a.young)
final """,
)


def young(df):
    """A flag whose rates lie on either side of one half: the library merges leaves of one majority."""
    return df.withColumn("young", F.col("age") <= 1)


def _stump_design(spark, sf_dir):
    return linear.build_design(young(folds(spark, sf_dir)), {"flag": [FLAG_TERM]}, ROLES)


def _stump_sql(p: str) -> str:
    return RATES_SQL + f"""select f.repetition, f.fold, f.unit_id, f.y, {p} as p from folds f
  join rates r on f.repetition = r.repetition and f.fold = r.fold and (f.age <= 1) = r.young"""


@register("forest_stump_out_of_fold", _stump_sql("rate"), "p")
def forest_stump(spark, sf_dir):
    oof = trees.tree_out_of_fold(trees.FOREST, _stump_design(spark, sf_dir), options=STUMP)
    return oof.select("repetition", "fold", "unit_id", "y", "p")


@register("boosting_stump_out_of_fold", _stump_sql("1e0 / (1e0 + exp(-2e0 * (2e0 * rate - 1e0)))"), "p")
def boosting_stump(spark, sf_dir):
    oof = trees.tree_out_of_fold(trees.BOOSTING, _stump_design(spark, sf_dir), options=STUMP)
    return oof.select("repetition", "fold", "unit_id", "y", "p")


#: The units that a fit reads, and their training rates outside each fold.
FIT_SQL = FOLDS_SQL.replace(
    "\nfinal ",
    f""",
sample as (select unit_id from (select unit_id, row_number() over (order by md5('42-fit-' || unit_id)) as place from features)
  where place <= {SAMPLED_STUMP.fit_rows}),
counted as (select repetition, fold, age <= 1 as young, count(*) as n, sum(y) as pos from folds
  where unit_id in (select unit_id from sample) group by repetition, fold, age <= 1),
fits as (select a.repetition, a.fold, a.young, sum(b.n) filter (where b.young = a.young) * 1e0 as n,
    sum(b.pos) filter (where b.young = a.young) * 1e0 as pos, sum(b.pos) * 1e0 / sum(b.n) as rate
  from (select distinct f.repetition, f.fold, v.young from counted f, (values (true), (false)) as v(young)) a
  join counted b on a.repetition = b.repetition and a.fold <> b.fold group by a.repetition, a.fold, a.young),
round_1 as (select *, ln(rate / (1e0 - rate)) - 0.05e0 * (n * rate - pos) / (n * rate * (1e0 - rate) + 1e0) as m1 from fits),
round_2 as (select *, 1e0 / (1e0 + exp(-m1)) as p1 from round_1),
boosted as (select *, 1e0 / (1e0 + exp(-(m1 - 0.05e0 * (n * p1 - pos) / (n * p1 * (1e0 - p1) + 1e0)))) as p2 from round_2)
final """,
)


def _fit_sql(p: str) -> str:
    return FIT_SQL + f"""select f.repetition, f.fold, f.unit_id, f.y, {p} as p from folds f
  join boosted r on f.repetition = r.repetition and f.fold = r.fold and (f.age <= 1) = r.young"""


def _out_of_fold(spark, sf_dir, kind, options):
    oof = ensembles.out_of_fold(kind, _stump_design(spark, sf_dir), ["flag"], options)[0]
    return oof.select("repetition", "fold", "unit_id", "y", "p")


@register("forest_tree_out_of_fold", _fit_sql("r.pos / r.n"), "p")
def forest_tree(spark, sf_dir):
    """One unsampled tree of depth one: the rate of the training rows on its side."""
    return _out_of_fold(spark, sf_dir, trees.FOREST, SAMPLED_STUMP)


@register("boosting_rounds_out_of_fold", _fit_sql("p2"), "p")
def boosting_rounds(spark, sf_dir):
    """Two rounds by gradient and curvature with penalised leaf values."""
    return _out_of_fold(spark, sf_dir, trees.BOOSTING, replace(SAMPLED_STUMP, boosting_rounds=2))


#: Rates of the fitted units by the flag, no fold left out.
FINAL_SQL = f"""with features as ({FEATURES}),
sample as (select age <= 1 as young, cast(label as integer) as y from
  (select *, row_number() over (order by md5('42-fit-' || unit_id)) as place from features) where place <= {SAMPLED_STUMP.fit_rows}),
rates as (select young, sum(y) * 1e0 / count(*) as rate from sample group by young)
final """


def _final_tree(spark, sf_dir):
    return ensembles.fit_final(trees.FOREST, _stump_design(spark, sf_dir), "flag", SAMPLED_STUMP)


@register(
    "tree_node_table",
    FINAL_SQL
    + """select 0 as tree, 0 as node, 'young' as term, 0.5e0 as threshold, 1 as "left", 2 as "right", cast(null as double) as value
  union all select 0, case when young then 2 else 1 end, null, null, null, null, rate from rates""",
    "value",
)
def tree_nodes(spark, sf_dir):
    nodes = ensembles.node_table(spark, _final_tree(spark, sf_dir))
    return nodes.select("tree", "node", "term", "threshold", "left", "right", "value")


@register("tree_model_round_trip", FINAL_SQL + "select unit_id, rate as risk from features join rates on (age <= 1) = young", "risk")
def tree_round_trip(spark, sf_dir):
    """A model written as a table of nodes, read again, scores every unit."""
    path = layer_path(spark)
    write_layer(ensembles.node_table(spark, _final_tree(spark, sf_dir)), path)
    model = ensembles.read_ensemble(read_layer(spark, path))
    return ensembles.scorer(model)(young(features(spark, sf_dir))).select("unit_id", "risk")


TREE_IMPORTANCE_SQL = FOLDS_SQL.replace(
    "\nfinal ",
    """,
counted as (select repetition, fold, age <= 1 as young, count(*) as n, sum(y) as pos from folds group by repetition, fold, age <= 1),
fits as (select a.repetition, a.fold, a.young, sum(b.n) filter (where b.young = a.young) * 1e0 as n,
    sum(b.pos) filter (where b.young = a.young) * 1e0 as pos
  from (select distinct f.repetition, f.fold, v.young from counted f, (values (true), (false)) as v(young)) a
  join counted b on a.repetition = b.repetition and a.fold <> b.fold group by a.repetition, a.fold, a.young),
tried as (select repetition, fold, unit_id, y, age <= 1 as young, unnest(range(5)) as permutation from folds),
ring as (select *, md5('42-' || repetition || '-' || permutation || '-' || unit_id) as o from tried),
moved as (select *, coalesce(lead(young) over w, first_value(young) over w) as nyoung from ring
  window w as (partition by repetition, fold, permutation order by o, unit_id)),
scores as (select m.repetition, m.fold, m.permutation, m.y, round(f.pos / f.n, 12) as s from moved m
    join fits f on m.repetition = f.repetition and m.fold = f.fold and m.nyoung = f.young
  union all select m.repetition, m.fold, -1, m.y, round(f.pos / f.n, 12) from folds m
    join fits f on m.repetition = f.repetition and m.fold = f.fold and (m.age <= 1) = f.young),
ties as (select repetition, fold, permutation, s, sum(y) as pos, count(*) - sum(y) as neg from scores group by repetition, fold, permutation, s),
below as (select *, sum(neg) over (partition by repetition, fold, permutation order by s) - neg as under from ties),
auc as (select repetition, fold, permutation, sum(pos * (under + neg / 2e0)) / (sum(pos) * sum(neg)) as auc
  from below group by repetition, fold, permutation)
final """,
)


@register(
    "tree_permutation_importance",
    TREE_IMPORTANCE_SQL
    + """select a.repetition, a.fold, 'young' as block, r.auc as reference_auc, r.auc - avg(a.auc) as auc_drop from auc a
  join auc r on a.repetition = r.repetition and a.fold = r.fold and r.permutation = -1
  where a.permutation >= 0 group by a.repetition, a.fold, r.auc""",
    "reference_auc auc_drop",
    places=6,
)
def tree_importance(spark, sf_dir):
    design = _stump_design(spark, sf_dir)
    pairs = [(r, f) for r in range(N_REPETITIONS) for f in range(N_FOLDS)]
    models = ensembles.fit(trees.FOREST, design, "flag", pairs, STUMP)
    score = ensembles.fold_scorer(spark, models)
    found = importance.permutation_importance_of(design, score, "flag", {"young": ("young",)})
    return found.select("repetition", "fold", "block", "reference_auc", "auc_drop")


def _stump_scorer(spark, sf_dir):
    design = _stump_design(spark, sf_dir)
    model = trees.fit_final_tree(trees.FOREST, design, "flag", STUMP)
    return trees.tree_scorer(model, trees.design_columns(design, "flag"))


ALL_RATES_SQL = f"""with features as ({FEATURES}),
rates as (select age <= 1 as young, count(*) filter (where label) * 1e0 / count(*) as rate from features group by age <= 1)
final """


@register(
    "tree_scoring",
    ALL_RATES_SQL
    + """select unit_id, rate as risk, rate >= 0.75e0 as flagged, not (age between 0 and 10) as out_of_range
  from features join rates on (age <= 1) = young""",
    "risk",
)
def tree_scoring(spark, sf_dir):
    score = _stump_scorer(spark, sf_dir)
    return serving.score_units_with(young(features(spark, sf_dir)), score, THRESHOLD, {"age": (0, 10)})


@register(
    "tree_partial_dependence",
    ALL_RATES_SQL
    + """select 'young' as variable, case when young then 1e0 else 0e0 end as value, rate as risk from rates
  union all select 'events', v, avg(rate) from (select distinct events * 1e0 as v from features), features join rates on (age <= 1) = young
  group by v""",
    "value risk",
)
def tree_dependence(spark, sf_dir):
    score = _stump_scorer(spark, sf_dir)
    table = young(features(spark, sf_dir))
    return explain.partial_dependence_of(table, score, ["young", "events"])


@register(
    "logistic_optimality",
    FOLDS_SQL
    + """select a.repetition, a.fold, count(*) as n, cast(sum(b.y) as bigint) as n_positive, 0e0 as largest_gradient
  from (select distinct repetition, fold from folds) a
  join folds b on a.repetition = b.repetition and a.fold <> b.fold group by a.repetition, a.fold""",
    "largest_gradient",
)
def optimality(spark, sf_dir):
    """Largest gradient entry of the penalised loss at each fold's coefficients, from raw columns and SQL functions only."""
    # The deal is the largest step; the fit and the check read the same one.
    dealt = folds(spark, sf_dir)
    _, _, models = fitted(spark, sf_dir, [WITHOUT_GROUP], dealt)
    terms = models[0].terms
    rows = [
        (m.repetition, m.fold, m.intercept, list(m.coefficients), list(m.centres), list(m.scales)) for m in models
    ]
    given = spark.createDataFrame(
        rows, "repetition int, left_out int, b0 double, b array<double>, c array<double>, s array<double>"
    )
    # One row of parameters per fold.
    joined = by_repetition(dealt).join(F.broadcast(given), "repetition").filter("fold <> left_out")
    z = [(t.column() - F.col("c")[i]) / F.col("s")[i] for i, t in enumerate(terms)]
    eta = F.col("b0")
    for i, x in enumerate(z):
        eta = eta + F.col("b")[i] * x
    off = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta)) - F.col("y")
    # A number per coefficient, not the array: it keeps the aggregate a hash aggregate, 25 rows in a task, no sort.
    own = [F.max(F.col("b")[i]) for i in range(len(terms))]
    sums = [F.sum(off).alias("g0"), *[(F.sum(off * x) + own[i]).alias(f"g{i + 1}") for i, x in enumerate(z)]]
    result = joined.groupBy("repetition", "left_out").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n_positive"), *sums)
    largest = F.greatest(*[F.abs(f"g{i}") for i in range(len(terms) + 1)]) / F.col("n")
    return result.select(
        "repetition", F.col("left_out").alias("fold"), "n", "n_positive", F.round(largest, 8).alias("largest_gradient")
    )


# --------------------------------------------------------------------------- whole chain


@register(
    "mart_run_counts",
    REPEATED_SQL.rstrip().rstrip(",")
    + """
final select (select count(*) from units) as clean_rows,
  (select count(*) from repeated) - (select count(*) from units) as duplicates_removed,
  cast(12 as bigint) as feature_columns, cast(4 as bigint) as aggregates""",
)
def mart_counts(spark, sf_dir):
    cleaned, built = mart.run(spark, units_repeated(spark, sf_dir), roles=ROLES, strict=False)
    counts = mart.run_counts(cleaned, built)
    return spark.createDataFrame(
        [tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts)
    )


# --------------------------------------------------------------------------- layers on disk


def written(df, *partition_by):
    """A table written to the shared folder, as a source or layer would be; its path."""
    return stage(df, *partition_by).inputFiles()[0].rpartition("/")[0]


def layer_path(spark):
    return f"{staging_root(spark)}/{uuid.uuid4().hex}"


@register(
    "mart_from_path",
    REPEATED_SQL.rstrip().rstrip(",")
    + """
final select (select count(*) from units) as clean_rows, (select count(distinct unit_id) from units) as units_kept,
  (select count(*) from repeated) - (select count(*) from units) as duplicates_removed,
  cast(12 as bigint) as feature_columns, cast(4 as bigint) as aggregates""",
)
def mart_path(spark, sf_dir):
    """The chain from a file with default arguments keeps every unit."""
    cleaned, built = mart.run(spark, written(units_repeated(spark, sf_dir)), strict=False)
    kept = cleaned.table.select("unit_id").distinct().count()
    counts = mart.run_counts(cleaned, built)
    row = (counts["clean_rows"], kept, counts["duplicates_removed"], counts["feature_columns"], counts["aggregates"])
    return spark.createDataFrame(
        [row], "clean_rows bigint, units_kept bigint, duplicates_removed bigint, feature_columns bigint, aggregates bigint"
    )


@register("source_failures_with_ids", rules_sql(RAW_RULES, "dirty"), views=("units", "dirty"))
def source_failures(spark, sf_dir):
    return load_source(spark, written(units_dirty(spark, sf_dir)), ROLES)[2]


@register("layer_round_trip", "select * from units")
def round_trip(spark, sf_dir):
    path = layer_path(spark)
    write_layer(units(spark, sf_dir), path)
    return read_layer(spark, path)


@register("view_over_layer", "select grp, count(*) as n, sum(usage_km) as usage from units where age >= 3 group by grp")
def view_over_layer(spark, sf_dir):
    path, view = layer_path(spark), f"units_{uuid.uuid4().hex}"
    write_layer(units(spark, sf_dir), path)
    register_parquet(spark, path, view)
    return spark.sql(f"select grp, count(*) as n, cast(sum(usage_km) as bigint) as usage from {view} where age >= 3 group by grp")


@register(
    "predictions_from_disk",
    "select repetition, fold, unit_id, y, p from oof where model = 'signal'",
    "p",
    ("units", "oof"),
)
def predictions_on_disk(spark, sf_dir):
    path = layer_path(spark)
    write_layer(predictions(spark, sf_dir), path, "model", "feature_set")
    return read_predictions(spark, path, "signal", "original").select("repetition", "fold", "unit_id", "y", "p")


@register(
    "record_round_trip",
    "select count(*) as n_units, cast(sum(events) as bigint) as n_events, max(age) as max_age from units",
)
def record(spark, sf_dir):
    path = layer_path(spark)
    totals = units(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_units"), F.sum("events").alias("n_events"), F.max("age").alias("max_age")
    )
    write_record(spark, totals.first().asDict(), path)
    found = read_record(spark, path)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} bigint" for k in found))


@register("missing_layers", "select 'absent' as layer")
def missing(spark, sf_dir):
    folder = layer_path(spark)
    write_layer(units(spark, sf_dir), f"{folder}/present")
    return spark.createDataFrame([(x,) for x in missing_layers(spark, folder, ["present", "absent"])], "layer string")
