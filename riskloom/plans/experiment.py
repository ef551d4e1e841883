"""The experiment: every model on every feature set over the same folds, then a choice."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from riskloom.operators import ensembles
from riskloom.operators.design import feature_sets, group_levels, terms_for
from riskloom.operators.ensembles import Ensemble
from riskloom.operators.folds import fold_vectors
from riskloom.operators.linear import (
    BASELINE,
    LOGISTIC,
    Design,
    LinearModel,
    baseline_predictions,
    build_design,
    fit_all_rows,
    fit_folds,
    fold_moments,
    model_table,
    out_of_fold,
)
from riskloom.operators.metrics import compare_models, fold_metrics, select_model
from riskloom.operators.stats import paired_tests
from riskloom.operators.trees import BOOSTING, FOREST, TreeOptions
from riskloom.roles import (
    DEFAULT_ROLES,
    N_FOLDS,
    N_REPETITIONS,
    SEED,
    SELECTION_METRIC,
    Roles,
)
from riskloom.session import discard, stage
from riskloom.sources.tables import read_layer, write_layer, write_record

MODELS = (BASELINE, LOGISTIC, FOREST, BOOSTING)
GROUP_KEYS = ["model", "feature_set", "repetition", "fold"]


@dataclass(frozen=True)
class Experiment:
    comparison: DataFrame
    folds: DataFrame
    predictions: DataFrame
    tests: DataFrame
    fold_models: list[LinearModel]
    design: Design | None
    chosen: dict[str, object]
    final: LinearModel | Ensemble


def linear_design(
    folds: DataFrame, roles: Roles = DEFAULT_ROLES, sets: Sequence[str] | None = None
) -> Design:
    levels = group_levels(folds, roles)
    chosen = feature_sets(roles)
    return build_design(
        folds, {s: terms_for(chosen[s], levels, True, roles) for s in sets or chosen}, roles
    )


def tree_design(
    folds: DataFrame, roles: Roles = DEFAULT_ROLES, sets: Sequence[str] | None = None
) -> Design:
    levels = group_levels(folds, roles)
    chosen = feature_sets(roles)
    return build_design(
        folds, {s: terms_for(chosen[s], levels, False, roles) for s in sets or chosen}, roles
    )


def run(
    features: DataFrame,
    roles: Roles = DEFAULT_ROLES,
    models: Sequence[str] = MODELS,
    sets: Sequence[str] | None = None,
    n_folds: int = N_FOLDS,
    repetitions: int = N_REPETITIONS,
    options: TreeOptions = TreeOptions(),
    target: str | None = None,
) -> Experiment:
    """Cross-validate, compare, choose, refit on all rows, and optionally write everything."""
    names = feature_sets(roles)
    sets = list(sets or names)
    # Folds carry only what the models read.
    used = dict.fromkeys(c for s in sets for c in names[s])
    folds = stage(
        fold_vectors(
            features.select(roles.unit_id, roles.label, *used), roles, n_folds, repetitions
        )
    )
    linear = linear_design(folds, roles, sets) if {BASELINE, LOGISTIC} & set(models) else None
    trees = tree_design(folds, roles, sets) if {FOREST, BOOSTING} & set(models) else None

    parts, fold_models, full = [], [], {}
    if linear:
        moments = fold_moments(linear)
    if BASELINE in models:
        parts.append(baseline_predictions(linear, moments))
    if LOGISTIC in models:
        full = fit_all_rows(linear, moments)
        fold_models = fit_folds(linear, full, moments)
        parts.append(out_of_fold(linear, fold_models))
    sample = ensembles.fit_sample(trees, options) if trees else None
    for kind in (FOREST, BOOSTING):
        if kind in models:
            parts += ensembles.out_of_fold(kind, trees, sets, options, sample=sample)

    # The largest table is written once, to where it is wanted.
    scored = reduce(DataFrame.unionByName, parts)
    if target:
        write_layer(scored, f"{target}/predictions", "model", "feature_set")
        predictions = read_layer(features.sparkSession, f"{target}/predictions").select(scored.columns)
    else:
        predictions = stage(scored, "model", "feature_set")
    per_fold = stage(fold_metrics(predictions, GROUP_KEYS))
    comparison = stage(compare_models(per_fold, {s: len(names[s]) for s in sets}))
    best = select_model(comparison, n_folds * repetitions).first()
    tests = paired_tests(per_fold, best["model"], best["feature_set"])
    chosen = {
        "model": best["model"],
        "feature_set": best["feature_set"],
        "columns": list(names[best["feature_set"]]),
        "selection_metric": SELECTION_METRIC,
        "selection_value": best[SELECTION_METRIC],
        "seed": SEED,
        "n_folds": n_folds,
        "n_repetitions": repetitions,
    }
    if best["model"] == LOGISTIC:
        final = full[best["feature_set"]]
    else:
        final = ensembles.fit_final(best["model"], trees, best["feature_set"], options, sample)

    if target:
        spark = features.sparkSession
        write_layer(comparison, f"{target}/comparison")
        write_layer(per_fold, f"{target}/fold_metrics")
        write_layer(tests, f"{target}/paired_tests")
        if fold_models:
            write_layer(model_table(spark, fold_models), f"{target}/fold_models")
        if isinstance(final, LinearModel):
            write_layer(model_table(spark, [final]), f"{target}/model")
        else:
            write_layer(ensembles.node_table(spark, final), f"{target}/model")
        write_record(spark, chosen, f"{target}/model_metadata")
    # What the result does not read any more goes with the plan.
    discard(folds, *([trees.units] if trees else []))
    return Experiment(comparison, per_fold, predictions, tests, fold_models, linear, chosen, final)
