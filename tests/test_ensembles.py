"""Forests and boosted trees against growers that look at one node and one cut at a time."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ensembles, importance
from riskloom.operators.ensembles import Trees, bootstrap_counts, drawn_for_round, grow_boosting, grow_forest, hash_of, term_order
from riskloom.operators.features import add_features
from riskloom.operators.folds import assign_folds, by_repetition, fold_vectors, gathered_folds
from riskloom.operators.trees import BOOSTING, FOREST, TreeOptions
from riskloom.plans import experiment
from riskloom.session import stage
from tests.test_models import ROLES, SCHEMA, make_units


def table(n=200, seed=0):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 40, n), rng.integers(0, 3, n), rng.integers(0, 2, n), rng.integers(0, 9, n)], 1).astype(np.uint8)
    return x, (rng.random(n) < 0.2 + 0.015 * x[:, 0]).astype(np.uint8)


def key_of(seed, path):
    key = ensembles._below(np.array([hash_of(seed)], np.uint64), 0)
    for side in path:
        key = ensembles._below(key, 4 + side)
    return key


def slow_tree(x, y, weight, seed, options, path=()):
    """Leaf value, or (term, cut, left, right)."""
    d = x.shape[1]
    total, ones = int(weight.sum()), int((weight * y).sum())
    leaf = ones / total
    deep = options.forest_depth is not None and len(path) >= options.forest_depth
    if len(y) < 2 * options.forest_leaf or ones in (0, total) or deep:
        return leaf
    best = None
    for j, term in enumerate(term_order(key_of(seed, path), d)[0]):
        if j >= max(1, int(d**0.5)) and best:
            break
        for cut in sorted(set(x[:, term].tolist()))[:-1]:
            left = x[:, term] <= cut
            if min(left.sum(), (~left).sum()) < options.forest_leaf:
                continue
            lw, lp = int(weight[left].sum()), int((weight * y)[left].sum())
            score = lp * lp / lw + (ones - lp) * (ones - lp) / (total - lw)
            if best is None or score > best[0]:
                best = (score, int(term), int(cut), left)
    if best is None:
        return leaf
    _, term, cut, left = best
    return (
        term, cut,
        slow_tree(x[left], y[left], weight[left], seed, options, (*path, 0)),
        slow_tree(x[~left], y[~left], weight[~left], seed, options, (*path, 1)),
    )


def nested(trees, node):
    if trees.child[node] < 0:
        return float(trees.leaf[-1 - trees.child[node]])
    left = int(trees.child[node])
    return int(trees.feature[node]), int(trees.cut[node]), nested(trees, left), nested(trees, left + 1)


@pytest.mark.parametrize("depth, leaf, bootstrap", [(3, 5, True), (None, 1, True), (None, 5, False), (1, 20, True)])
def test_forest_equals_the_slow_grower(depth, leaf, bootstrap):
    x, y = table()
    options = TreeOptions(forest_depth=depth, forest_leaf=leaf, bootstrap=bootstrap)
    seeds = [(42, 0, 1, 2, t) for t in range(6)]
    grown = grow_forest(x, y, seeds, options)
    for t, seed in enumerate(seeds):
        counts = bootstrap_counts(len(y), seed) if bootstrap else np.ones(len(y), int)
        keep = counts > 0
        assert nested(grown, grown.root[t]) == slow_tree(x[keep], y[keep], counts[keep], seed, options)


def test_blocks_of_trees_change_nothing():
    x, y = table(300, 3)
    seeds = [(1, 2, 3, t) for t in range(7)]
    whole = grow_forest(x, y, seeds, TreeOptions())
    parts = grow_forest(x, y, seeds[:3], TreeOptions()) + grow_forest(x, y, seeds[3:], TreeOptions())
    assert [nested(whole, r) for r in whole.root] == [nested(parts, r) for r in parts.root]
    assert (whole.total(x) == parts.total(x)).all()
    again = Trees.unpacked(parts.packed())
    assert (again.total(x) == parts.total(x)).all()


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def test_walking_down_in_step(monkeypatch):
    x, y = table(400, 5)
    grown = grow_forest(x, y, [(9, t) for t in range(5)], TreeOptions(forest_leaf=2))
    trees = [nested(grown, r) for r in grown.root]
    want = [sum(walk(t, row) for t in trees) for row in x]
    assert np.allclose(grown.total(x), want, rtol=0, atol=1e-12)
    monkeypatch.setattr(ensembles, "STEP", 16)
    assert (grown.total(x) == grown.total(x[::-1])[::-1]).all()


def slow_round(x, g, h, rows, terms, options, depth=0):
    use = rows
    G, H = g[use].sum(), h[use].sum()
    value = -options.boosting_rate * G / (H + options.leaf_penalty)
    if depth == options.boosting_depth or not use.any():
        return value
    best = None
    for term in terms:
        for cut in range(int(x[:, term].max())):
            left = use & (x[:, term] <= cut)
            gl, hl = g[left].sum(), h[left].sum()
            if hl < options.least_curvature - 1e-12 or H - hl < options.least_curvature - 1e-12:
                continue
            lam = options.leaf_penalty
            gain = gl**2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G**2 / (H + lam)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-10):
                best = (gain, int(term), cut)
    if best is None:
        return value
    _, term, cut = best
    below = x[:, term] <= cut
    return (
        term, cut,
        slow_round(x, g, h, use & below, terms, options, depth + 1),
        slow_round(x, g, h, use & ~below, terms, options, depth + 1),
    )


@pytest.mark.parametrize("sampling, depth", [(0.8, 3), (1.0, 2), (0.5, 1)])
def test_boosting_equals_the_slow_grower(sampling, depth):
    x, y = table(250, 7)
    options = TreeOptions(boosting_rounds=6, boosting_depth=depth, sampling=sampling, boosting_rate=0.3)
    seed = (42, 1, 2, 3)
    start, grown = grow_boosting(x, y, seed, options)
    rate = y.mean()
    assert start == pytest.approx(np.log(rate / (1 - rate)))
    margin = np.full(len(y), start)
    for r in range(6):
        p = 1 / (1 + np.exp(-margin))
        rows, terms = drawn_for_round(len(y), x.shape[1], (*seed, r), sampling)
        tree = slow_round(x, p - y, p * (1 - p), rows, terms, options)
        step = np.array([walk(tree, row) for row in x])
        one = replace_root(grown, r)
        assert np.allclose(one.total(x), step, atol=1e-9), r
        margin = margin + step
    assert np.allclose(start + grown.total(x), margin, atol=1e-9)


def replace_root(trees, r):
    return Trees(trees.feature, trees.cut, trees.child, trees.leaf, trees.root[r : r + 1])


def test_cuts_and_bins():
    values = np.array([-np.inf, 1.0, 2.0, 2.0, 5.0])
    cuts = ensembles.term_cuts(values)
    assert cuts.tolist() == [-np.inf, 1.5, 3.5]
    assert ensembles.to_bins([np.array([np.nan, 1.0, 1.5, 3.0, 9.0])], [cuts]).ravel().tolist() == [0, 1, 1, 2, 3]
    many = np.random.default_rng(1).normal(size=5000)
    cuts = ensembles.term_cuts(many)
    shares = np.bincount(ensembles.to_bins([many], [cuts]).ravel())
    assert len(cuts) == 255 and shares.min() >= 15 and shares.max() <= 25
    assert len(ensembles.term_cuts(np.ones(9))) == 0


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame(make_units(), SCHEMA)


@pytest.fixture(scope="module")
def design(units):
    return experiment.tree_design(stage(fold_vectors(add_features(units, ROLES), ROLES)), ROLES)


SMALL = TreeOptions(forest_trees=30, boosting_rounds=20)


@pytest.mark.parametrize("kind", [FOREST, BOOSTING])
def test_out_of_fold_and_tables(spark, units, design, kind):
    pairs = [(0, 0), (0, 1), (4, 3)]
    (oof,) = ensembles.out_of_fold(kind, design, ["with_derived"], SMALL, pairs)
    got = oof.toPandas()
    assert sorted(set(zip(got.repetition, got.fold))) == pairs and 290 < len(got) < 310
    order = got.p.rank()
    n1 = got.y.sum()
    auc = (order[got.y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(got) - n1))
    assert auc > 0.6
    models = ensembles.fit(kind, design, "with_derived", pairs[:1], SMALL)
    sample = ensembles.fit_sample(design, SMALL)
    assert len(sample.y) == 500
    model = models[0]
    read = ensembles.read_ensemble(stage(ensembles.node_table(spark, model)))
    rows = add_features(units, ROLES)
    one = {r.unit_id: r.risk for r in ensembles.scorer(model)(rows).collect()}
    two = {r.unit_id: r.risk for r in ensembles.scorer(read)(rows).collect()}
    assert one == two and len(one) == 500
    own = got[(got.repetition == 0) & (got.fold == 0)]
    assert {u: p for u, p in zip(own.unit_id, own.p)} == {u: one[u] for u in own.unit_id}
    with pytest.raises(ValueError, match="unknown tree"):
        ensembles.fit("stump", design, "original", pairs)


def test_training_leaves_the_fold_out(design):
    """A forest of one full tree knows its training rows and not the others."""
    options = TreeOptions(forest_trees=1, forest_leaf=1, bootstrap=False)
    (oof,) = ensembles.out_of_fold(FOREST, design, ["with_derived"], options, [(1, 2)])
    assert oof.agg(F.avg(F.abs(F.col("p") - F.col("y")))).first()[0] > 0.1
    model = ensembles.fit(FOREST, design, "with_derived", [(1, 2)], options)[0]
    sample = ensembles.fit_sample(design, options)
    columns = [design.terms.index(t) for t in design.sets["with_derived"]]
    p = model.probability(sample.bins[:, columns])
    inside = sample.folds[:, 1] != 2
    assert (p[inside] == sample.y[inside]).mean() > 0.99


def test_fit_rows_bound_the_sample(spark, units):
    df = stage(fold_vectors(add_features(units.repartition(7), ROLES), ROLES))
    design = experiment.tree_design(df, ROLES, ["without_group"])
    bounded = ensembles.fit_sample(design, TreeOptions(fit_rows=60))
    assert bounded.bins.shape == (60, 3)
    want = units.select("unit_id", F.md5(F.concat(F.lit("42-fit-"), "unit_id")).alias("o")).orderBy("o").limit(60)
    ids = {r.unit_id for r in want.collect()}
    y = {r.unit_id: int(r.label) for r in units.collect()}
    assert bounded.y.tolist() == [y[r.unit_id] for r in want.collect()] and len(ids) == 60
    # Every row with one id: the bound holds all the same.
    same = units.withColumn("unit_id", F.lit(1).cast("long"))
    one = experiment.tree_design(stage(fold_vectors(add_features(same, ROLES), ROLES)), ROLES, ["without_group"])
    assert len(ensembles.fit_sample(one, TreeOptions(fit_rows=60)).y) == 60
    none = units.withColumn("unit_id", F.lit(None).cast("long"))
    nulls = experiment.tree_design(stage(fold_vectors(add_features(none, ROLES), ROLES)), ROLES, ["without_group"])
    assert len(ensembles.fit_sample(nulls, TreeOptions(fit_rows=60)).y) == 60


def test_vectors_hold_the_same_folds(spark, units):
    rows = add_features(units, ROLES)
    long = assign_folds(rows, ROLES)
    vectors = stage(fold_vectors(rows, ROLES))
    assert vectors.count() == 500
    columns = ["unit_id", "repetition", "fold", "y"]
    want = sorted(map(tuple, long.select(columns).collect()))
    assert sorted(map(tuple, by_repetition(vectors).select(columns).collect())) == want
    again = gathered_folds(long, ["unit_id", "y"])
    assert sorted(map(tuple, by_repetition(again).select(columns).collect())) == want


def test_vectors_of_equal_rows(spark):
    pdf = pd.concat([make_units(40), make_units(3), make_units(3)])
    rows = spark.createDataFrame(pdf, SCHEMA)
    vectors = stage(fold_vectors(rows, ROLES, 5, 3))
    assert vectors.count() == 46
    sizes = by_repetition(vectors).groupBy("repetition", "y", "fold").count().toPandas()
    for _, group in sizes.groupby(["repetition", "y"]):
        assert group["count"].max() - group["count"].min() <= 1
    again = by_repetition(gathered_folds(assign_folds(rows, ROLES, 5, 3), rows.columns + ["y"]))
    assert sorted(map(str, again.select("unit_id", "repetition", "fold").collect())) == sorted(
        map(str, by_repetition(vectors).select("unit_id", "repetition", "fold").collect())
    )


def test_importance_of_trees_sees_the_strong_column(spark, design):
    pairs = [(r, f) for r in range(5) for f in range(5)]
    options = replace(SMALL, boosting_rounds=10)
    score = ensembles.fold_scorer(spark, ensembles.fit(BOOSTING, design, "without_group", pairs, options))
    blocks = importance.both_readings(("age", "usage_km", "events"), {"pair": ("age", "usage_km")})
    found = importance.permutation_importance_of(design, score, "without_group", blocks, n_permutations=2)
    rows = {r.block: r for r in importance.importance_summary(found).collect()}
    assert set(rows) == {"pair", "age", "usage_km", "events"}
    assert rows["pair"].auc_drop > max(rows["events"].auc_drop, 0) and rows["pair"].n_columns == 2


def counted(x, y):
    cells, place = np.unique(x, axis=0, return_inverse=True)
    counts = np.zeros((len(cells), 2), np.int64)
    np.add.at(counts, (place.reshape(-1), y), 1)
    return cells, counts


def close(a, b):
    if isinstance(a, float):
        return a == pytest.approx(b, abs=1e-9)
    return a[:2] == b[:2] and close(a[2], b[2]) and close(a[3], b[3])


def test_counted_rows_grow_the_same_trees():
    x, y = table(3000)
    x[:, 0] //= 4
    cells, counts = counted(x, y)
    assert len(cells) < 600
    options = TreeOptions(bootstrap=False, boosting_rounds=8, sampling=1.0)
    seeds = [(42, 0, 1, 2, t) for t in range(4)]
    plain, grouped = grow_forest(x, y, seeds, options), grow_forest(cells, None, seeds, options, counts)
    assert [nested(grouped, r) for r in grouped.root] == [nested(plain, r) for r in plain.root]
    (start, plain), (other, grouped) = grow_boosting(x, y, (7,), options), grow_boosting(cells, None, (7,), options, counts)
    assert start == pytest.approx(other)
    assert all(close(nested(grouped, a), nested(plain, b)) for a, b in zip(grouped.root, plain.root))


def test_counted_bootstrap_draws_as_single_rows_do():
    counts = np.array([1, 2, 3, 30, 400])
    starts = np.append(0, counts.cumsum()[:-1])
    one, two = [], []
    for t in range(600):
        drawn, distinct = ensembles.counted_bootstrap(counts, (1, t), 10)
        assert drawn.sum() == counts.sum() and (distinct <= np.minimum(np.minimum(drawn, counts), 10)).all()
        assert ((drawn == 0) == (distinct == 0)).all()
        single = bootstrap_counts(counts.sum(), (2, t))
        one.append(np.append(drawn, distinct))
        two.append(np.append(np.add.reduceat(single, starts), np.minimum(np.add.reduceat(single > 0, starts), 10)))
    assert np.mean(one, 0) == pytest.approx(np.mean(two, 0), rel=0.12)
    assert np.std(one, 0)[:9] == pytest.approx(np.std(two, 0)[:9], rel=0.2)


def test_dense_and_sorted_cuts_agree(monkeypatch):
    x, y = table(2000, 5)
    seeds = [(1, t) for t in range(4)]
    monkeypatch.setattr(ensembles, "DENSE", 0)
    by_sort = grow_forest(x, y, seeds, TreeOptions(forest_leaf=2))
    monkeypatch.setattr(ensembles, "DENSE", 1 << 30)
    by_count = grow_forest(x, y, seeds, TreeOptions(forest_leaf=2))
    assert by_sort.packed() == by_count.packed()


def test_all_units_are_fitted_by_default(spark):
    """More units than the former bound: every one is counted, with cuts at ranks of all of them."""
    n = 6_000
    rows = add_features(spark.createDataFrame(make_units(n), SCHEMA), ROLES)
    rows = rows.withColumn("usage_km", F.when(F.col("unit_id") % 50 != 0, F.col("usage_km")))
    design = experiment.tree_design(stage(fold_vectors(rows, ROLES)), ROLES)
    sample = ensembles.fit_sample(design)
    assert sample.counts.shape[1:] == (2, 5, 5)
    assert sample.counts.sum((0, 1, 3)).tolist() == [n] * 5
    pdf = design.units.toPandas()
    columns = [pdf[f"x{i}"].fillna(-np.inf).to_numpy(float) for i in range(len(design.terms))]
    wanted = [ensembles.term_cuts(c) for c in columns]
    assert 240 < max(map(len, wanted)) < 256
    for got, want in zip(sample.cuts, wanted):
        assert got.tolist() == want.tolist()
    cells, counts = counted(ensembles.to_bins(columns, wanted), pdf.y.to_numpy())
    assert np.array_equal(sample.bins, cells)
    assert np.array_equal(sample.counts[:, :, 2].sum(2), counts)
    fourth = np.array([f[2] for f in pdf.folds]) == 4
    left, inside = ensembles._training(sample, 2, 4)[2], counted(ensembles.to_bins(columns, wanted)[~fourth], pdf.y.to_numpy()[~fourth])[1]
    assert np.array_equal(left, inside)
    fewer = sample.of([5, 0])
    assert fewer.counts.sum() == sample.counts.sum() and len(fewer.bins) < len(sample.bins)


@pytest.mark.parametrize("kind", [FOREST, BOOSTING])
def test_scores_made_where_trees_grow(spark, design, monkeypatch, kind):
    """Scores from the tasks that fit equal those of the fitted models; every unit is scored, or those of the folds asked for."""
    monkeypatch.setattr(ensembles, "SINGLE_UNITS", 100)
    options = TreeOptions(forest_trees=7, boosting_rounds=5)
    parts = ensembles.out_of_fold(kind, design, options=options)
    assert [p.count() for p in parts] == [2500] * 3
    pairs = [(0, 0), (4, 3)]
    models = ensembles.fit(kind, design, "with_derived", pairs, options)
    score = ensembles.fold_scorer(spark, models)
    terms = [design.column(t) for t in design.sets["with_derived"]]
    rows = design.table.filter("(repetition = 0 and fold = 0) or (repetition = 4 and fold = 3)")
    want = sorted(map(tuple, rows.select("repetition", "unit_id", "y", score("repetition", "fold", *terms)).collect()))
    (asked,) = ensembles.out_of_fold(kind, design, ["with_derived"], options, pairs)
    for part in (asked, parts[list(design.sets).index("with_derived")].filter("(repetition, fold) in ((0, 0), (4, 3))")):
        assert {(r.model, r.feature_set) for r in part.select("model", "feature_set").distinct().collect()} == {(kind, "with_derived")}
        got = sorted(map(tuple, part.select("repetition", "unit_id", "y", "p").collect()))
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-12)


def test_tree_importance_query_reads_no_sample():
    from riskloom.catalog import ENTRIES, model_queries

    assert "fit-" not in ENTRIES["tree_permutation_importance"].oracle
    assert model_queries.STUMP.fit_rows is None and TreeOptions().fit_rows is None


def test_folds_dealt_in_rounds_are_the_same(spark, monkeypatch):
    """Repeated rows, repeated and null ids: the folds do not depend on how many repetitions are ranked at a time."""
    from riskloom.operators import folds

    pdf = pd.concat([make_units(60), make_units(4), make_units(4)])
    rows = spark.createDataFrame(pdf, SCHEMA)
    rows = rows.unionByName(rows.limit(5).withColumn("usage_km", F.lit(7).cast(rows.schema["usage_km"].dataType)))
    rows = stage(rows.withColumn("unit_id", F.when(F.col("unit_id") % 9 != 0, F.col("unit_id"))))
    ranked, plain, found = [], folds._ranked, []
    monkeypatch.setattr(folds, "_ranked", lambda units, some, seed: ranked.append(some) or plain(units, some, seed))
    for size in (10**9, 80):
        monkeypatch.setattr(folds, "ROWS_A_ROUND", size)
        found.append(sorted(map(str, by_repetition(fold_vectors(rows, ROLES, 5, 3)).collect())))
    assert ranked[0] == range(3) and ranked[1:4] == [range(r, r + 1) for r in range(3)]
    assert found[0] == found[1] and len(found[0]) == 3 * rows.count()
    want = sorted(map(str, assign_folds(rows, ROLES, 5, 3).select("repetition", "fold", *rows.columns, "y").collect()))
    assert sorted(map(str, by_repetition(fold_vectors(rows, ROLES, 5, 3)).select("repetition", "fold", *rows.columns, "y").collect())) == want
