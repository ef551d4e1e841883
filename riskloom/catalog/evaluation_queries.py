"""Metrics, thresholds, curves and decision queries on rule-made predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.inputs import predictions
from riskloom.catalog.registry import register
from riskloom.operators import curves, metrics, thresholds
from riskloom.operators.curves import bin_labels
from riskloom.operators.stats import feature_set_effects, paired_tests
from riskloom.catalog.statistics_queries import student_sql
from riskloom.plans.evaluation import (
    COST_SCENARIO,
    DEFAULT_SCENARIO,
    operating_threshold,
    scenario_metrics,
)
from riskloom.roles import COST_RATIOS
from riskloom.plans.evaluation import evaluate
from riskloom.session import stage
from riskloom.sources.tables import select_predictions

V = ("units", "oof")
KEYS = ["model", "feature_set", "repetition", "fold"]
Z = "1.959963984540054e0"


def chosen(spark, sf_dir, model="pseudo"):
    return predictions(spark, sf_dir).filter(F.col("model") == model)


RATES = """(tp + tn) * 1e0 / (tp + fp + fn + tn) as accuracy,
  coalesce(tp * 1e0 / nullif(tp + fp, 0), 0e0) as precision,
  coalesce(tp * 1e0 / nullif(tp + fn, 0), 0e0) as recall,
  coalesce(2e0 * tp / nullif(2 * tp + fp + fn, 0), 0e0) as f1"""


def cells(t: str) -> str:
    return f"""count(*) filter (where y = 1 and p >= {t}) as tp, count(*) filter (where y = 0 and p >= {t}) as fp,
  count(*) filter (where y = 1 and p < {t}) as fn, count(*) filter (where y = 0 and p < {t}) as tn"""


NAMED_CELLS = """tp as true_positives, fp as false_positives, fn as false_negatives, tn as true_negatives"""


@register("predictions_of_model", "select * from oof where model = 'signal' and feature_set = 'original'", views=V)
def of_model(spark, sf_dir):
    return select_predictions(predictions(spark, sf_dir), "signal", "original")


@register(
    "metrics_at_half",
    f"""select model, feature_set, repetition, {NAMED_CELLS}, {RATES}, tp + fp as n_flagged,
  (tp + fp) * 1e0 / (tp + fp + fn + tn) as flagged_share
  from (select model, feature_set, repetition, {cells("0.5e0")} from oof group by model, feature_set, repetition)""",
    "accuracy precision recall f1 flagged_share",
    V,
)
def at_half(spark, sf_dir):
    return metrics.metrics_at(predictions(spark, sf_dir), 0.5, KEYS[:3])


@register(
    "expected_cost",
    f"""select model, repetition, {NAMED_CELLS}, fn * 3e0 + fp * 1e0 as cost
  from (select model, repetition, {cells("0.231e0")} from oof group by model, repetition)""",
    "cost",
    V,
)
def cost(spark, sf_dir):
    return metrics.expected_cost(predictions(spark, sf_dir), 0.231, 3.0, ["model", "repetition"])


FOLD_SQL = f"""with s as (select model, feature_set, repetition, fold, p, sum(y) as pos, sum(1 - y) as neg
  from oof group by model, feature_set, repetition, fold, p),
c as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg,
  sum(pos) over g as tot_pos, sum(neg) over g as tot_neg from s
  window w as (partition by model, feature_set, repetition, fold order by p desc),
         g as (partition by model, feature_set, repetition, fold)),
r as (select model, feature_set, repetition, fold,
  sum(pos * 1e0 / tot_pos * (tot_neg - cum_neg + neg / 2e0) / tot_neg) as roc_auc,
  sum(pos * 1e0 / tot_pos * cum_pos / (cum_pos + cum_neg)) as average_precision
  from c group by model, feature_set, repetition, fold),
h as (select model, feature_set, repetition, fold, {cells("0.5e0")}, avg(pow(y - p, 2)) as brier
  from oof group by model, feature_set, repetition, fold),
folds as (select h.model, h.feature_set, h.repetition, h.fold, {RATES}, roc_auc, average_precision, brier
  from h join r on h.model = r.model and h.feature_set = r.feature_set
   and h.repetition = r.repetition and h.fold = r.fold)
final """

METRICS = "accuracy precision recall f1 roc_auc average_precision brier"


@register("fold_metrics", FOLD_SQL + "select * from folds", METRICS, V)
def folds(spark, sf_dir):
    return metrics.fold_metrics(predictions(spark, sf_dir), KEYS)


@register(
    "ranking_metrics_by_model",
    """with s as (select model, p, sum(y) as pos, sum(1 - y) as neg from oof group by model, p),
c as (select *, sum(pos) over w as cum_pos, sum(neg) over w as cum_neg, sum(pos) over g as tot_pos,
  sum(neg) over g as tot_neg from s
  window w as (partition by model order by p desc), g as (partition by model))
final select model, sum(pos * 1e0 / tot_pos * (tot_neg - cum_neg + neg / 2e0) / tot_neg) as roc_auc,
  sum(pos * 1e0 / tot_pos * cum_pos / (cum_pos + cum_neg)) as average_precision from c group by model""",
    "roc_auc average_precision",
    V,
)
def ranking(spark, sf_dir):
    return metrics.rank_metrics(metrics.score_scan(predictions(spark, sf_dir), ["model"]), ["model"])


@register(
    "brier_score",
    "select model, repetition, avg(pow(y - p, 2)) as brier from oof group by model, repetition",
    "brier",
    V,
)
def brier(spark, sf_dir):
    return metrics.brier(predictions(spark, sf_dir), ["model", "repetition"])


def interval(name: str, guard: bool = True) -> str:
    margin = f"{Z} * stddev_samp({name}) / sqrt(count({name}))"
    margin = f"coalesce({margin}, 0e0)" if guard else margin
    return f"avg({name}) as {name}, avg({name}) - {margin} as {name}_low, avg({name}) + {margin} as {name}_high"


COMPARED = " ".join(f"{m} {m}_low {m}_high {m}_sd" for m in METRICS.split())
COMPARISON_SQL = FOLD_SQL.replace(
    "\nfinal ",
    ",\ncomparison as (select model, feature_set, "
    + ", ".join(f"{interval(m, False)}, stddev_samp({m}) as {m}_sd" for m in METRICS.split())
    + " from folds group by model, feature_set)\nfinal ",
)


@register("model_comparison", COMPARISON_SQL + "select * from comparison", COMPARED, V)
def comparison(spark, sf_dir):
    return metrics.compare_models(metrics.fold_metrics(predictions(spark, sf_dir), KEYS))


@register(
    "model_selection",
    COMPARISON_SQL
    + """select model, feature_set, 4 as n_features, roc_auc, roc_auc - roc_auc_sd / 5e0 as band_low,
  roc_auc as band_high from comparison order by roc_auc desc limit 1""",
    "roc_auc band_low band_high",
    V,
)
def selection(spark, sf_dir):
    table = stage(
        metrics.compare_models(
            metrics.fold_metrics(predictions(spark, sf_dir), KEYS), {"original": 4}
        )
    )
    return metrics.select_model(table, 25).select(
        "model", "feature_set", "n_features", "roc_auc", "band_low", "band_high"
    )


@register(
    "one_error_band",
    COMPARISON_SQL
    + "select max(roc_auc) - arg_max(roc_auc_sd, roc_auc) / 5e0 as band_low, max(roc_auc) as band_high from comparison",
    "band_low band_high",
    V,
)
def band(spark, sf_dir):
    return metrics.one_error_band(
        metrics.compare_models(metrics.fold_metrics(predictions(spark, sf_dir), KEYS)), 25
    )


PAIRED = """,
d as (select a.model as base_model, a.feature_set as base_set, b.model, b.feature_set,
  a.roc_auc - b.roc_auc as d from folds a join folds b on a.repetition = b.repetition and a.fold = b.fold
  where a.model = 'signal' and b.model <> 'signal'),
v as (select base_model, base_set, model, feature_set, count(*) * 1e0 as n, avg(d) as mean_difference,
  var_samp(d) as v from d group by base_model, base_set, model, feature_set),
t as (select *, mean_difference / sqrt(v * (1e0 / n + 0.25e0)) as t_corrected, mean_difference / sqrt(v / n) as t_naive
  from v)
final """


@register(
    "paired_tests",
    FOLD_SQL.replace("\nfinal ", PAIRED)
    + f"""select base_model, base_set, model, feature_set, mean_difference, t_corrected,
  {student_sql("t_corrected", "(n - 1e0)")} as p_corrected, {student_sql("t_naive", "(n - 1e0)")} as p_naive,
  {student_sql("t_corrected", "(n - 1e0)")} < 0.05e0 as distinguishable from t""",
    "mean_difference t_corrected p_corrected p_naive",
    V,
    places=7,
)
def paired(spark, sf_dir):
    table = metrics.fold_metrics(predictions(spark, sf_dir), KEYS)
    return paired_tests(stage(table), "signal", "original")


@register(
    "feature_set_effects",
    FOLD_SQL.replace(
        "\nfinal ",
        """,
d as (select a.repetition, a.fold, b.roc_auc - a.roc_auc as d from folds a join folds b
  on a.repetition = b.repetition and a.fold = b.fold where a.model = 'pseudo' and b.model = 'signal'),
t as (select avg(d) as effect, avg(d) / sqrt(var_samp(d) * (1e0 / count(*) + 0.25e0)) as t, count(*) * 1e0 as n from d)
final """,
    )
    + f"""select 'rule' as model, 'signal' as feature_set, effect, {student_sql("t", "(n - 1e0)")} as p_corrected from t""",
    "effect p_corrected",
    V,
    places=7,
)
def effects(spark, sf_dir):
    # The two score rules stand for two feature sets of one model family.
    as_sets = predictions(spark, sf_dir).withColumns(
        {"feature_set": F.col("model"), "model": F.lit("rule")}
    )
    return feature_set_effects(stage(metrics.fold_metrics(as_sets, KEYS)), "pseudo")


GRID = ", ".join(f"({t!r}e0)" if "e" not in repr(t) else f"({t!r})" for t in thresholds.threshold_grid())

THRESHOLD_SQL = f"""with grid as (select * from (values {GRID}) as g(threshold)),
chosen as (select * from oof where model = 'pseudo'),
per_score as (select repetition, p, sum(y) as pos, sum(1 - y) as neg from chosen group by repetition, p),
cut as (select repetition, threshold,
  sum(case when p >= threshold then pos else 0 end) as tp, sum(case when p >= threshold then neg else 0 end) as fp,
  sum(case when p < threshold then pos else 0 end) as fn, sum(case when p < threshold then neg else 0 end) as tn
  from per_score, grid group by repetition, threshold),
cells as (select repetition, threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
  cast(fn as bigint) as fn, cast(tn as bigint) as tn from cut),
ratios as (select * from (values {", ".join(f"({r!r}e0)" for r in COST_RATIOS)}) as r(cost_ratio)),
priced as (select *, fn * cost_ratio + fp * 1e0 as cost from cells, ratios),
best as (select * from (select *, row_number() over (partition by repetition, cost_ratio
  order by cost, threshold desc) as rn from priced) where rn = 1),
rated as (select *, {RATES}, tp + fp as n_flagged, (tp + fp) * 1e0 / (tp + fp + fn + tn) as flagged_share,
  fn as false_negatives, fp as false_positives from best),
sensitivity as (select cost_ratio, {", ".join(interval(c) for c in ("threshold", *thresholds.SUMMARISED))},
  cost_ratio = 3e0 as is_anchor from rated group by cost_ratio)
final """

SENSITIVE = " ".join(f"{c} {c}_low {c}_high" for c in ("threshold", *thresholds.SUMMARISED))


@register(
    "threshold_cells",
    THRESHOLD_SQL + f"select repetition, threshold, {NAMED_CELLS} from cells",
    "threshold",
    V,
)
def cells_by_threshold(spark, sf_dir):
    return thresholds.threshold_cells(chosen(spark, sf_dir))


@register(
    "optimal_thresholds",
    THRESHOLD_SQL
    + """select repetition, cost_ratio, threshold, cost, tp as true_positives, fp as false_positives,
  fn as false_negatives, tn as true_negatives, accuracy, precision, recall, f1, n_flagged, flagged_share from rated""",
    "threshold cost accuracy precision recall f1 flagged_share",
    V,
)
def optimal(spark, sf_dir):
    return thresholds.optimal_thresholds(chosen(spark, sf_dir))


@register("cost_sensitivity", THRESHOLD_SQL + "select * from sensitivity", SENSITIVE, V)
def sensitivity(spark, sf_dir):
    return thresholds.cost_sensitivity(chosen(spark, sf_dir))


@register(
    "cost_sensitivity_any_ratio",
    THRESHOLD_SQL.replace("(1.0e0), (2.0e0)", "(4.5e0), (2.0e0)")
    + "select * from sensitivity where cost_ratio = 4.5e0",
    SENSITIVE,
    V,
)
def any_ratio(spark, sf_dir):
    return thresholds.cost_sensitivity(chosen(spark, sf_dir), [4.5])


@register(
    "degenerate_ratios",
    THRESHOLD_SQL
    + "select cost_ratio, flagged_share, not is_anchor and flagged_share > 0.85e0 as degenerate from sensitivity",
    "flagged_share",
    V,
)
def degenerate(spark, sf_dir):
    table = thresholds.degeneracy(thresholds.cost_sensitivity(chosen(spark, sf_dir)))
    return table.select("cost_ratio", "flagged_share", "degenerate")


SCENARIO_SQL = THRESHOLD_SQL.replace(
    "\nfinal ",
    f""",
op as (select round(threshold, 3) as t, '{COST_SCENARIO}' as scenario from sensitivity where is_anchor
       union all select 0.5e0, '{DEFAULT_SCENARIO}'),
sc as (select t, scenario, repetition, sum(case when p >= t then pos else 0 end) as tp,
  sum(case when p >= t then neg else 0 end) as fp, sum(case when p < t then pos else 0 end) as fn,
  sum(case when p < t then neg else 0 end) as tn from per_score, op group by t, scenario, repetition),
sr as (select *, {RATES} from sc),
sm as (select scenario, t as threshold, unnest(['accuracy', 'precision', 'recall', 'f1']) as metric,
  unnest([accuracy, precision, recall, f1]) as v from sr),
scenarios as (select scenario, metric, threshold, avg(v) as value,
  avg(v) - {Z} * stddev_samp(v) / sqrt(count(*)) as ci_low, avg(v) + {Z} * stddev_samp(v) / sqrt(count(*)) as ci_high
  from sm group by scenario, metric, threshold),
confusion as (select unnest(['negative', 'negative', 'positive', 'positive']) as actual,
  unnest(['not flagged', 'flagged', 'not flagged', 'flagged']) as predicted,
  unnest([avg(tn), avg(fp), avg(fn), avg(tp)]) as n,
  unnest(['true_negatives', 'false_positives', 'false_negatives', 'true_positives']) as cell
  from sc where scenario = '{COST_SCENARIO}')
final """,
)


@register(
    "scenario_metrics", SCENARIO_SQL + "select * from scenarios", "value ci_low ci_high threshold", V
)
def scenarios(spark, sf_dir):
    oof = stage(chosen(spark, sf_dir))
    return scenario_metrics(oof, operating_threshold(oof))


@register(
    "metric_by_scenario",
    SCENARIO_SQL
    + f"""select metric, max(case when scenario = '{DEFAULT_SCENARIO}' then round(value, 9) end) as "{DEFAULT_SCENARIO}",
  max(case when scenario = '{COST_SCENARIO}' then round(value, 9) end) as "{COST_SCENARIO}" from scenarios group by metric""",
    views=V,
)
def by_scenario(spark, sf_dir):
    oof = stage(chosen(spark, sf_dir))
    table = scenario_metrics(oof, operating_threshold(oof))
    return thresholds.metrics_by_scenario(table, [DEFAULT_SCENARIO, COST_SCENARIO])


def _confusion(spark, sf_dir):
    oof = stage(chosen(spark, sf_dir))
    return thresholds.confusion_matrix(oof, operating_threshold(oof))


@register("confusion_matrix", SCENARIO_SQL + "select * from confusion", "n", V)
def confusion(spark, sf_dir):
    return _confusion(spark, sf_dir)


@register(
    "confusion_grid",
    SCENARIO_SQL
    + """select actual, max(case when predicted = 'not flagged' then n end) as not_flagged,
  max(case when predicted = 'flagged' then n end) as flagged from confusion group by actual""",
    "not_flagged flagged",
    V,
)
def grid(spark, sf_dir):
    return thresholds.confusion_grid(_confusion(spark, sf_dir))


@register(
    "confusion_shares",
    SCENARIO_SQL
    + """select *, found / (found + missed) as found_share, missed / (found + missed) as missed_share from (
  select max(case when cell = 'true_positives' then n end) as found,
  max(case when cell = 'false_negatives' then n end) as missed,
  max(case when cell = 'false_positives' then n end) as empty_inspections,
  max(case when cell = 'true_negatives' then n end) as left_alone from confusion)""",
    "found missed empty_inspections left_alone found_share missed_share",
    V,
)
def shares(spark, sf_dir):
    return thresholds.confusion_shares(_confusion(spark, sf_dir))


# Means of p are rounded before grouping on either side: the order of five additions
# decides the last bit, and equal scores must stay equal.
SCORES = """scores as (select unit_id, max(y) as y, round(avg(p), 12) as p from oof where model = '{m}' group by unit_id)"""


def tied_scores(spark, sf_dir, model="pseudo"):
    return stage(curves.mean_scores(chosen(spark, sf_dir, model)))


@register(
    "mean_scores",
    "select unit_id, max(y) as y, avg(p) as p from oof where model = 'pseudo' group by unit_id",
    "p",
    V,
)
def mean_scores(spark, sf_dir):
    return curves.mean_scores(chosen(spark, sf_dir))


CUMULATIVE = f"""with {SCORES.format(m="pseudo")},
s as (select p, sum(y) as pos, sum(1 - y) as neg from scores group by p),
c as (select p, sum(pos) over w as cp, sum(neg) over w as cn, sum(pos) over () as tp, sum(neg) over () as tn
      from s window w as (order by p desc))
final """


@register(
    "roc_curve",
    CUMULATIVE
    + """select cn * 1e0 / tn as false_positive_rate, cp * 1e0 / tp as true_positive_rate, p as threshold from c
  union all select 0e0, 0e0, cast('inf' as double)""",
    "false_positive_rate true_positive_rate threshold",
    V,
)
def roc(spark, sf_dir):
    return curves.roc_curve(tied_scores(spark, sf_dir))


@register(
    "precision_recall_curve",
    CUMULATIVE + "select cp * 1e0 / (cp + cn) as precision, cp * 1e0 / tp as recall, p as threshold from c",
    "precision recall threshold",
    V,
)
def precision_recall(spark, sf_dir):
    return curves.precision_recall_curve(tied_scores(spark, sf_dir))


EDGES = [0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001, 0.7000000000000001, 0.8, 0.9, 1.0]
CALIBRATION_SQL = (
    f"with {SCORES.format(m='signal')},\nb as (select case "
    + " ".join(f"when p <= {e!r}e0 then {i}" for i, e in enumerate(EDGES))
    + " end as bin, p, y from scores),\nl as (select * from (values "
    + ", ".join(f"({i}, '{t}')" for i, t in enumerate(bin_labels()))
    + """) as l(bin, bin_label)),
k as (select b.bin, bin_label, count(*) as n, avg(p) as mean_p, avg(y) as observed, avg(y) - avg(p) as deviation
  from b join l on b.bin = l.bin group by b.bin, bin_label)
final """
)


@register("calibration", CALIBRATION_SQL + "select * from k", "mean_p observed deviation", V)
def calibration(spark, sf_dir):
    return curves.calibration(tied_scores(spark, sf_dir, "signal"))


@register(
    "calibration_error",
    CALIBRATION_SQL
    + """select avg(abs(deviation)) as mean_absolute_error, arg_max(bin_label, abs(deviation)) as worst_bin,
  arg_max(mean_p, abs(deviation)) as worst_mean_p, arg_max(observed, abs(deviation)) as worst_observed,
  arg_max(n, abs(deviation)) as worst_n from k""",
    "mean_absolute_error worst_mean_p worst_observed",
    V,
)
def calibration_error(spark, sf_dir):
    return curves.calibration_error(curves.calibration(tied_scores(spark, sf_dir, "signal")))


def gain_sql(model: str) -> str:
    return f"""with {SCORES.format(m=model)},
r as (select y, row_number() over (order by p desc, unit_id) as rn from scores),
t as (select count(*) as n, sum(y) as pos from scores),
g as (select slice, cast(round_even(n * slice / 10e0, 0) as bigint) as n_inspected, n, pos
      from t, range(1, 11) as s(slice)),
w as (select g.slice, g.n_inspected, g.n, g.pos, count(*) filter (where r.y = 1) as captured
      from g join r on r.rn <= g.n_inspected group by g.slice, g.n_inspected, g.n, g.pos),
gain as (select cast(slice as integer) as slice, slice / 10e0 as share_inspected, n_inspected, captured,
  captured * 1e0 / pos as captured_share, captured * 1e0 / n_inspected as precision_in_slice,
  (captured * 1e0 / n_inspected) / (pos * 1e0 / n) as lift from w)
final """


GAINED = "share_inspected captured_share precision_in_slice lift"


@register("gain_curve", gain_sql("pseudo") + "select * from gain", GAINED, V)
def gain(spark, sf_dir):
    return curves.gain_curve(tied_scores(spark, sf_dir), staged=True)


@register("gain_curve_text_ids", gain_sql("pseudo").replace("order by p desc, unit_id", "order by p desc, 'u' || unit_id") + "select * from gain", GAINED, V)
def gain_text(spark, sf_dir):
    named = tied_scores(spark, sf_dir).withColumn("unit_id", F.concat(F.lit("u"), F.col("unit_id").cast("string")))
    return curves.gain_curve(named)


@register("gain_curve_signal", gain_sql("signal") + "select * from gain", GAINED, V)
def gain_signal(spark, sf_dir):
    return curves.gain_curve(tied_scores(spark, sf_dir, "signal"), staged=True)


@register(
    "gain_highlights",
    gain_sql("signal")
    + "select slice, share_inspected, captured_share, lift from gain where slice in (1, 3, 5)",
    "share_inspected captured_share lift",
    V,
)
def highlights(spark, sf_dir):
    return curves.gain_highlights(curves.gain_curve(tied_scores(spark, sf_dir, "signal"), staged=True))


@register(
    "capacity_plan",
    gain_sql("signal").replace(
        "\nfinal ",
        """,
seg as (select share_inspected as x1, captured_share as y1,
  coalesce(lag(share_inspected) over (order by slice), 0e0) as x0,
  coalesce(lag(captured_share) over (order by slice), 0e0) as y0,
  max(n_inspected) over () as fleet, max(captured) over () as total from gain),
cap as (select capacity, capacity * 1e0 / fleet as share, y0 + (capacity * 1e0 / fleet - x0) * (y1 - y0) / (x1 - x0)
  as captured_share, total from seg, (values (25), (100), (777), (1000)) as c(capacity)
  where capacity * 1e0 / fleet > x0 and capacity * 1e0 / fleet <= x1)
final """,
    )
    + """select cast(capacity as bigint) as capacity, share, captured_share,
  cast(round_even(captured_share * total, 0) as bigint) as found, captured_share / share as lift from cap""",
    "share captured_share lift",
    V,
)
def capacity(spark, sf_dir):
    table = curves.gain_curve(tied_scores(spark, sf_dir, "signal"), staged=True)
    return curves.capacity_plan(table, [25, 100, 777, 1000])


def _ctes(text: str) -> str:
    """The table expressions of a comparison text, without its frame."""
    return text.strip().removeprefix("with ").removesuffix("final").rstrip()


DECISION_SQL = (
    "with "
    + _ctes(THRESHOLD_SQL.replace("model = 'pseudo'", "model = 'signal'"))
    + ",\n"
    + _ctes(CALIBRATION_SQL)
    + ",\n"
    + _ctes(gain_sql("signal")).split("group by unit_id),\n", 1)[1]
    + """,
record as (select 'signal' as model, 'original' as feature_set, 3e0 as cost_ratio, round(threshold, 3) as threshold,
  round(threshold_low, 3) as threshold_low, round(threshold_high, 3) as threshold_high, round(flagged_share, 4) as flagged_share,
  round(false_negatives, 1) as mean_false_negatives, round(false_positives, 1) as mean_false_positives,
  round((select avg(abs(deviation)) from k), 4) as calibration_error,
  round((select captured_share from gain where slice = 3), 4) as captured_top30,
  round((select lift from gain where slice = 3), 2) as lift_top30,
  round((select captured_share from gain where slice = 5), 4) as captured_top50,
  round((select lift from gain where slice = 5), 2) as lift_top50 from sensitivity where is_anchor)
final select * from record"""
)


@register(
    "decision_of_given_scores",
    DECISION_SQL,
    "cost_ratio threshold threshold_low threshold_high flagged_share mean_false_negatives mean_false_positives "
    "calibration_error captured_top30 lift_top30 captured_top50 lift_top50",
    V,
    places=6,
)
def decision_of_given(spark, sf_dir):
    """The whole evaluation of one model's predictions, down to its decision record."""
    record = evaluate(predictions(spark, sf_dir), "signal", "original").decision
    return spark.createDataFrame([tuple(record.values())], list(record))
