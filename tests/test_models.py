import math

import hashlib
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ensembles, explain, importance, linear, serving, trees
from riskloom.operators.design import NUMBER, Term, feature_sets, terms_for
from riskloom.operators.features import add_features
from riskloom.operators.folds import assign_folds, fold_balance
from riskloom.operators.metrics import fold_metrics
from riskloom.plans import experiment, interpretation
from riskloom.roles import Roles
from riskloom.session import stage
from riskloom.sources.tables import load_model, read_layer, read_predictions, read_record, save_model
from riskloom.streaming import rowwise

GROUPS = ("A", "B", "C")
ROLES = Roles(groups=GROUPS)
SCHEMA = "unit_id long, grp string, age long, usage_km long, events long, label boolean"


def make_units(n=500, seed=42):
    rng = np.random.default_rng(seed)
    age = rng.integers(0, 9, n)
    usage = np.maximum(1_000, 15_000 + 14_000 * age + rng.normal(0, 15_000, n)).astype(int)
    events = rng.poisson(0.5 + 0.6 * age)
    logit = -2.5 + 0.25 * age + 0.000005 * usage + 0.2 * events
    return pd.DataFrame(
        {"unit_id": np.arange(n) * 7 + 3, "grp": rng.choice(GROUPS, n), "age": age, "usage_km": usage,
         "events": events, "label": rng.uniform(size=n) < 1 / (1 + np.exp(-logit))}
    )


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame(make_units(), SCHEMA)


@pytest.fixture(scope="module")
def folded(units):
    return stage(assign_folds(add_features(units, ROLES), ROLES))


@pytest.fixture(scope="module")
def design(folded):
    return experiment.linear_design(folded, ROLES)


@pytest.fixture(scope="module")
def fits(design):
    full = linear.fit_all_rows(design)
    return full, linear.fit_folds(design, full)


# ------------------------------------------------------------------ folds


def test_folds_are_balanced_within_one_per_outcome(folded):
    pdf = folded.select("repetition", "fold", "y").toPandas()
    sizes = pdf.groupby(["repetition", "y", "fold"]).size()
    for _, group in sizes.groupby(level=[0, 1]):
        assert group.max() - group.min() <= 1
    assert len(sizes) == 5 * 2 * 5
    assert fold_balance(folded).agg(F.sum("n_units")).first()[0] == 5 * 500


def test_each_unit_once_per_repetition_and_repetitions_differ(folded):
    wide = folded.select("unit_id", "repetition", "fold").toPandas().pivot(
        index="unit_id", columns="repetition", values="fold"
    )
    assert wide.shape == (500, 5) and wide.notna().all().all()
    assert (wide[0] != wide[1]).mean() > 0.5


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_folds_do_not_depend_on_partitioning(spark, units, folded, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    want = {(r.unit_id, r.repetition): r.fold for r in folded.collect()}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        again = assign_folds(units.repartition(parts), ROLES).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {(r.unit_id, r.repetition): r.fold for r in again} == want


# ------------------------------------------------------------------ terms


def test_terms_follow_the_model_kind():
    sets = feature_sets(ROLES)
    lin = terms_for(sets["with_derived"], GROUPS, True, ROLES)
    assert [t.name for t in lin] == [
        "grp_B", "grp_C", "many_events", "age", "usage_km", "events",
        "usage_per_year", "events_per_year", "events_per_10k",
    ]
    tree = terms_for(sets["original"], GROUPS, False, ROLES)
    assert [t.name for t in tree] == ["grp_A", "grp_B", "grp_C", "age", "usage_km", "events"]
    assert {t.kind for t in terms_for(sets["with_derived"], GROUPS, False, ROLES)} == {
        "category", "flag", "number",
    }
    assert len(sets["without_group"]) == 3


def test_unknown_level_gives_zeros(spark):
    term = Term("grp_B", "grp", "category", "B")
    df = spark.createDataFrame([("Z",), (None,), ("B",)], "grp string")
    assert [r[0] for r in df.select(term.column()).collect()] == [0.0, 0.0, 1.0]


# ------------------------------------------------------------------ linear model


def gradient(design, model):
    """Penalised gradient at the solution, straight from the definition."""
    pdf = design.table.filter(
        (F.col("repetition") == model.repetition) & (F.col("fold") != model.fold)
    ).toPandas()
    x = pdf[[design.column(t) for t in model.terms]].to_numpy()
    z = np.column_stack([np.ones(len(x)), (x - np.array(model.centres)) / np.array(model.scales)])
    w = np.array([model.intercept, *model.coefficients])
    p = 1 / (1 + np.exp(-z @ w))
    return z.T @ (p - pdf["y"].to_numpy()) + np.concatenate([[0.0], w[1:]])


def test_every_fit_is_at_the_optimum(design, fits):
    full, folds = fits
    assert len(folds) == 3 * 25
    for model in [*full.values(), folds[0], folds[31], folds[-1]]:
        assert np.abs(gradient(design, model)).max() < 1e-6


def test_scaling_uses_training_rows_and_population_spread(design, fits):
    model = next(m for m in fits[1] if (m.feature_set, m.repetition, m.fold) == ("original", 2, 3))
    rows = design.table.filter("repetition = 2 and fold <> 3").toPandas()
    for term, centre, scale in zip(model.terms, model.centres, model.scales):
        values = rows[design.column(term)]
        want = (values.mean(), values.std(ddof=0)) if term.scaled else (0.0, 1.0)
        assert (centre, scale) == pytest.approx(want, rel=1e-9)


def test_fits_do_not_depend_on_partitioning(units, fits):
    again = stage(assign_folds(add_features(units.repartition(13), ROLES), ROLES))
    design = experiment.linear_design(again, ROLES, ["without_group"])
    got = linear.fit_all_rows(design)["without_group"]
    assert got.coefficients == pytest.approx(fits[0]["without_group"].coefficients, abs=1e-8)


def test_constant_column_is_harmless(spark):
    pdf = make_units(120).assign(age=4)
    df = stage(assign_folds(add_features(spark.createDataFrame(pdf, SCHEMA), ROLES), ROLES, 3, 1))
    model = linear.fit_all_rows(experiment.linear_design(df, ROLES, ["without_group"]))["without_group"]
    assert model.coefficients[0] == pytest.approx(0.0, abs=1e-12)


def test_separable_data_converges(spark):
    pdf = make_units(200)
    pdf["label"] = pdf["age"] > 4
    df = stage(assign_folds(add_features(spark.createDataFrame(pdf, SCHEMA), ROLES), ROLES, 5, 1))
    design = experiment.linear_design(df, ROLES, ["without_group"])
    model = linear.fit_all_rows(design)["without_group"]
    assert np.abs(gradient(design, model)).max() < 1e-6


def test_out_of_fold_scores_come_from_the_other_folds(design, fits):
    oof = linear.out_of_fold(design, fits[1])
    assert oof.count() == 3 * 5 * 500
    model = next(m for m in fits[1] if (m.feature_set, m.repetition, m.fold) == ("with_derived", 1, 2))
    rows = design.table.filter("repetition = 1 and fold = 2").toPandas().set_index("unit_id")
    z = (rows[[design.column(t) for t in model.terms]] - model.centres) / model.scales
    want = 1 / (1 + np.exp(-(z.to_numpy() @ np.array(model.coefficients) + model.intercept)))
    got = (
        oof.filter("feature_set = 'with_derived' and repetition = 1 and fold = 2")
        .toPandas().set_index("unit_id").loc[rows.index, "p"]
    )
    assert got.to_numpy() == pytest.approx(want, abs=1e-10)


def test_models_survive_as_tables(spark, fits):
    full, folds = fits
    assert linear.read_models(linear.model_table(spark, [full["with_derived"]])) == [full["with_derived"]]
    assert len(linear.read_models(linear.model_table(spark, folds))) == 75


# ------------------------------------------------------------------ interpretation


@pytest.fixture(scope="module")
def model(fits):
    return fits[0]["with_derived"]


def test_coefficients_in_both_scales(spark, model):
    rows = explain.coefficient_table(linear.model_table(spark, [model]), ROLES).collect()
    assert [r.magnitude for r in rows] == sorted((r.magnitude for r in rows), reverse=True)
    got = {r.variable: r for r in rows}
    i = [t.name for t in model.terms].index("usage_km")
    usage = got["usage_km"]
    assert usage.natural == pytest.approx(model.coefficients[i] / model.scales[i])
    assert usage.odds_per_sd == pytest.approx(math.exp(model.coefficients[i]))
    assert usage.odds_communicable == pytest.approx(usage.odds_per_unit**10_000, rel=1e-6)
    assert got["grp_B"].scale is None and got["grp_B"].natural is None
    assert (got["grp_B"].unit_factor, got["grp_B"].unit) == (1.0, "per unit")


def test_only_linear_models_have_coefficients():
    with pytest.raises(TypeError, match="only linear"):
        explain.require_linear(object())


def test_contributions_add_up(units, model):
    df = explain.contributions(add_features(units, ROLES), model).withColumn("p", model.probability())
    for r in df.limit(20).collect():
        total = r.reference + sum(r[f"contribution_{t.name}"] for t in model.terms)
        assert 1 / (1 + math.exp(-total)) == pytest.approx(r.p, abs=1e-9)


def test_centred_contributions_differ_only_for_uncentred_terms(units, model):
    features = add_features(units, ROLES)
    plain = explain.contributions(features, model).toPandas().set_index("unit_id")
    centred_df = explain.centred_contributions(features, model, "unit_id")
    centred = centred_df.toPandas().set_index("unit_id")
    for t in model.terms:
        p = plain[f"contribution_{t.name}"].loc[centred.index]
        shift = (p - centred[t.name]).to_numpy()
        assert shift == pytest.approx(p.mean(), abs=1e-9)
        if t.scaled:
            assert p.mean() == pytest.approx(0.0, abs=1e-9)
    table = {r.variable: r for r in explain.contribution_summary(centred_df, model).collect()}
    assert table["age"].mean_absolute == pytest.approx(centred["age"].abs().mean())
    assert table["age"].mean == pytest.approx(0.0, abs=1e-9)


def test_dependence_grid_and_curve(units, model):
    features = add_features(units, ROLES)
    pdf = features.toPandas()
    curve = explain.partial_dependence(features, model, ["age", "usage_km"]).toPandas()
    age = curve[curve.variable == "age"]
    usage = curve[curve.variable == "usage_km"]
    assert age["value"].tolist() == sorted(pdf["age"].unique().tolist())
    assert len(usage) == 30 and curve["risk"].between(0, 1).all()
    assert (np.diff(usage["risk"]) > 0).all() == (
        model.coefficients[[t.name for t in model.terms].index("usage_km")] > 0
    )
    parts = explain.contributions(features, model).toPandas()
    i = [t.name for t in model.terms].index("age")
    for value, risk in age[["value", "risk"]].to_numpy():
        eta = parts["log_odds"] - parts["contribution_age"]
        eta = eta + (value - model.centres[i]) / model.scales[i] * model.coefficients[i]
        assert risk == pytest.approx((1 / (1 + np.exp(-eta))).mean(), abs=1e-9)
    reached = {r.variable: r.crosses_at for r in explain.threshold_crossing(
        explain.partial_dependence(features, model, ["age"]), 0.5).collect()}
    above = age.loc[age["risk"] >= 0.5, "value"]
    assert reached["age"] == (above.min() if len(above) else None)
    with pytest.raises(ValueError, match="no numeric term"):
        explain.partial_dependence(features, model, ["grp"])


def collinear(spark, n=900):
    """Three columns over one hidden cause: two follow it closely, the third hardly at all."""
    rng = np.random.default_rng(19)
    cause = rng.uniform(-2, 2, n)
    pdf = pd.DataFrame(
        {
            "unit_id": np.arange(n),
            "age": cause + rng.uniform(-0.1, 0.1, n),
            "usage_km": 3 * cause + rng.uniform(-0.3, 0.3, n),
            "events": 0.05 * cause + rng.uniform(-1, 1, n),
            "label": cause + rng.logistic(0, 0.5, n) > 0,
        }
    )
    return spark.createDataFrame(pdf)


def test_block_importance_sees_through_collinearity(spark):
    folds = stage(assign_folds(collinear(spark), ROLES))
    design = experiment.linear_design(folds, ROLES, ["without_group"])
    models = linear.fit_folds(design)

    def summary(blocks):
        return stage(importance.importance_summary(
            importance.permutation_importance(design, models, "without_group", blocks)))

    alone = summary(importance.single_blocks(("age", "usage_km", "events")))
    blocks = importance.collinear_blocks(
        ("age", "usage_km", "events"), interpretation.age_and_usage(ROLES))
    assert list(blocks) == ["age_and_usage", "events"]
    together = summary(blocks)
    single = {r.block: r for r in alone.collect()}
    joint = {r.block: r for r in together.collect()}
    assert joint["age_and_usage"].auc_drop > single["age"].auc_drop + single["usage_km"].auc_drop
    assert joint["age_and_usage"].relevant and not joint["events"].relevant
    assert joint["age_and_usage"].n_columns == 2
    assert all(r.ci_low <= r.auc_drop <= r.ci_high for r in [*single.values(), *joint.values()])
    ratio = importance.block_ratio(alone, together, "age_and_usage", ("age", "usage_km")).first()
    assert ratio.ratio > 1


def test_blocks_need_all_their_members():
    blocks = importance.collinear_blocks(("age", "events"), {"pair": ("age", "usage_km")})
    assert blocks == {"age": ("age",), "events": ("events",)}


def test_importance_is_the_same_for_any_split(spark):
    folds = stage(assign_folds(collinear(spark), ROLES))
    design = experiment.linear_design(folds, ROLES, ["without_group"])
    models = linear.fit_folds(design)
    blocks = importance.both_readings(("age", "usage_km", "events"), {"pair": ("age", "usage_km")})

    def detail(buckets, parts):
        moved = replace(design, table=design.table.repartition(parts))
        found = importance.permutation_importance(moved, models, "without_group", blocks, buckets=buckets)
        return sorted((r.repetition, r.fold, r.block, round(r.auc_drop, 9)) for r in found.collect())

    one = detail(1, 1)
    assert detail(7, 7) == one and detail(64, 50) == one


def test_neighbours_go_round_the_fold(spark):
    """Against a plain shuffle in pandas: every unit takes the block value of the next in hash order."""
    folds = stage(assign_folds(collinear(spark, 60), ROLES))
    design = experiment.linear_design(folds, ROLES, ["without_group"])
    models = linear.fit_folds(design)
    found = importance.permutation_importance(
        design, models, "without_group", {"age": ("age",)}, n_permutations=2, buckets=5
    )
    got = {(r.repetition, r.fold): r.auc_drop for r in found.collect()}
    rows = design.table.toPandas()
    model = next(m for m in models if (m.repetition, m.fold) == (1, 2))
    own = rows[(rows.repetition == 1) & (rows.fold == 2)]
    slopes, at = dict(zip((t.name for t in model.terms), model.slopes())), {t.name: design.column(t) for t in model.terms}
    rest = model.offset() + sum(slopes[c] * own[at[c]] for c in ("usage_km", "events"))
    moved = slopes["age"] * own[at["age"]]

    def auc(score):
        score = score.round(9)
        gaps = score[own.y == 1].to_numpy()[:, None] - score[own.y == 0].to_numpy()[None, :]
        return ((gaps > 0).sum() + 0.5 * (gaps == 0).sum()) / gaps.size

    drops = []
    for k in range(2):
        order = own.unit_id.map(lambda u: hashlib.md5(f"42-1-{k}-{u}".encode()).hexdigest()).sort_values().index
        taken = pd.Series(np.roll(moved.loc[order].to_numpy(), -1), index=order)
        drops.append(auc(rest + moved) - auc(rest + taken.loc[own.index]))
    assert got[(1, 2)] == pytest.approx(np.mean(drops), abs=1e-9)


# ------------------------------------------------------------------ serving


def test_scoring_flags_and_orders(units, fits):
    model = fits[0]["without_group"]
    limits = serving.seen_ranges(serving.observed_ranges(units, ROLES), ROLES)
    scored = serving.score_units(units, model, 0.5, limits)
    rows = scored.toPandas()
    assert not rows["out_of_range"].any()
    assert (rows["flagged"] == (rows["risk"] >= 0.5)).all()
    assert all([c["value"] for c in r] == sorted(c["value"] for c in r) for r in rows["contributions"])
    listed = serving.priority_list(scored).toPandas()
    assert listed["risk"].is_monotonic_decreasing and len(listed) == 500
    far = serving.score_units(units.withColumn("age", F.lit(29)), model, 0.5, limits)
    assert far.filter("out_of_range").count() == 500


def test_slices(units):
    pdf = units.toPandas()
    row = serving.explore_slice(units, {"grp": ["A"], "age": []}, ROLES).first()
    inside = pdf[pdf.grp == "A"]
    assert (row.n_units, row.rate) == (len(inside), pytest.approx(inside.label.mean()))
    assert row.share_of_base == pytest.approx(len(inside) / 500) and not row.small_sample
    empty = serving.explore_slice(units, {"grp": ["none"]}, ROLES).first()
    assert (empty.n_units, empty.rate, empty.ci_low, empty.small_sample) == (0, None, None, True)
    assert serving.filter_slice(units, {"grp": ["A"]}).count() == len(inside)


def test_stream_gives_the_batch_result(spark, units, fits, tmp_path):
    model = fits[0]["with_derived"]
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    half = units.filter("unit_id % 2 = 0")
    half.write.parquet(source)
    stream = rowwise.read_arriving(spark, source, units.schema)
    rowwise.write_available(rowwise.scored_stream(stream, model, 0.5, roles=ROLES), target, checkpoint).awaitTermination()
    assert spark.read.parquet(target).count() == half.count()
    units.filter("unit_id % 2 = 1").write.mode("append").parquet(source)
    stream = rowwise.read_arriving(spark, source, units.schema)
    rowwise.write_available(rowwise.scored_stream(stream, model, 0.5, roles=ROLES), target, checkpoint).awaitTermination()
    batch = serving.score_units(add_features(units, ROLES), model, 0.5)
    assert sorted(map(tuple, spark.read.parquet(target).select("unit_id", "risk").collect())) == sorted(
        map(tuple, batch.select("unit_id", "risk").collect()))


# ------------------------------------------------------------------ experiment and trees


SMALL = trees.TreeOptions(forest_trees=5, forest_depth=4, boosting_rounds=3)


def test_experiment_end_to_end(spark, units, tmp_path):
    target = str(tmp_path / "experiment")
    run = experiment.run(
        add_features(units, ROLES), ROLES, sets=["original", "without_group"], n_folds=3,
        repetitions=1, options=SMALL, target=target,
    )
    assert run.comparison.count() == 4 * 2
    p = run.predictions.select("p").toPandas()["p"]
    assert p.between(0, 1).all() and run.predictions.count() == 8 * 500
    assert run.chosen["model"] != "baseline"
    assert run.tests.count() == 7
    baseline = run.comparison.filter("model = 'baseline'").first()
    assert baseline.roc_auc == 0.5
    record = read_record(spark, f"{target}/model_metadata")
    assert record["columns"] == run.chosen["columns"]
    chosen = read_predictions(spark, f"{target}/predictions", record["model"], record["feature_set"])
    assert chosen.count() == 500
    assert read_layer(spark, f"{target}/paired_tests").count() == 7
    result = interpretation.interpret(
        add_features(units, ROLES), run.design, run.fold_models,
        next(iter(linear.fit_all_rows(run.design).values())), ROLES, n_permutations=1,
        target=str(tmp_path / "interpretation"),
    )
    assert result.importance.count() == 4 and result.block_importance.count() == 3
    assert read_layer(spark, str(tmp_path / "interpretation/coefficients")).count() == 5


@pytest.mark.parametrize("kind", [trees.FOREST, trees.BOOSTING])
def test_trees_score_and_persist(spark, folded, tmp_path, kind):
    design = experiment.tree_design(folded, ROLES, ["with_derived"])
    oof = stage(trees.tree_out_of_fold(kind, design, options=SMALL, folds=[(0, 0), (0, 1)]))
    rows = fold_metrics(oof, experiment.GROUP_KEYS).collect()
    assert len(rows) == 2 and all(r.roc_auc > 0.6 for r in rows)
    final = trees.fit_final_tree(kind, design, "with_derived", SMALL)
    save_model(final, str(tmp_path / "model"))
    once = design.table.filter("repetition = 0")
    columns = ["unit_id", "prediction"]
    again = load_model(str(tmp_path / "model")).transform(once).select(columns)
    assert sorted(map(tuple, again.collect())) == sorted(
        map(tuple, final.transform(once).select(columns).collect()))
    with pytest.raises(ValueError, match="unknown tree"):
        trees.estimator("stump")


@pytest.mark.parametrize("name, kind", [("forest_fold_metrics", trees.FOREST), ("boosting_fold_metrics", trees.BOOSTING)])
def test_tree_queries_run_the_whole_job(spark, sf_dir, monkeypatch, name, kind):
    from riskloom.catalog import ENTRIES

    whole, fits = ensembles.fit, []

    def noted(*args, **kw):
        fits.append((args, whole(*args, **kw)))
        return fits[-1][1]

    monkeypatch.setattr(ensembles, "fit", noted)
    rows = ENTRIES[name].query(spark, sf_dir).collect()
    assert len(rows) == 75 and {r.model for r in rows} == {kind}
    assert sorted(args[2] for args, _ in fits) == sorted(feature_sets(ROLES))
    for args, models in fits:
        assert args[0] == kind and args[4] == trees.TreeOptions()
        assert [(m.repetition, m.fold) for m in models] == [(r, f) for r in range(5) for f in range(5)]
        assert {len(m.trees.root) for m in models} == {300}


@pytest.mark.parametrize("name", ["experiment_comparison", "experiment_paired_tests", "decision_record"])
def test_registered_experiment_is_whole(spark, sf_dir, monkeypatch, name):
    from riskloom.catalog import ENTRIES

    def noted(features, roles, models=experiment.MODELS, sets=None, n_folds=5, repetitions=5, options=trees.TreeOptions()):
        assert (tuple(models), sets, n_folds, repetitions, options) == (experiment.MODELS, None, 5, 5, trees.TreeOptions())
        raise InterruptedError

    monkeypatch.setattr(experiment, "run", noted)
    with pytest.raises(InterruptedError):
        ENTRIES[name].query(spark, sf_dir)
