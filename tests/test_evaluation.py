import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import curves, metrics, thresholds
from riskloom.plans.evaluation import evaluate
from riskloom.sources.tables import read_layer, read_predictions, read_record, write_layer

SCHEMA = (
    "model string, feature_set string, repetition int, fold int, unit_id long, y int, p double"
)


def as_oof(spark, pdf):
    full = pdf.assign(model="m", feature_set="s", fold=pdf["unit_id"] % 5)
    return spark.createDataFrame(full[["model", "feature_set", "repetition", "fold", "unit_id", "y", "p"]], SCHEMA)


@pytest.fixture(scope="module")
def synthetic():
    """Two-decimal logistic scores, so that many tie, of 240 units in three repetitions; every third unit is positive."""
    rng = np.random.default_rng(7)
    unit = np.arange(240)
    y = (unit % 3 == 0).astype(int)
    frames = []
    for repetition in range(3):
        lean = 1.4 * y - 0.6 + rng.logistic(0, 0.8, len(unit))
        p = np.round(1 / (1 + np.exp(-lean)), 2)
        frames.append(pd.DataFrame({"repetition": repetition, "unit_id": unit, "y": y, "p": p}))
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="module")
def oof(spark, synthetic):
    return as_oof(spark, synthetic)


def scores_of(spark, y, p, repetition=0):
    n = len(y)
    return as_oof(
        spark, pd.DataFrame({"repetition": repetition, "unit_id": np.arange(n), "y": y, "p": p})
    )


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    gaps = pos[:, None] - neg[None, :]
    return ((gaps > 0).sum() + 0.5 * (gaps == 0).sum()) / gaps.size


# ------------------------------------------------------------------ metrics


def test_perfect_and_constant_scores(spark):
    perfect = scores_of(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9])
    row = metrics.fold_metrics(perfect, ["model"]).first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.roc_auc, row.average_precision) == (1,) * 6
    flat = metrics.fold_metrics(scores_of(spark, [0, 1, 0, 1], [0.2] * 4), ["model"]).first()
    assert (flat.roc_auc, flat.precision, flat.recall, flat.f1) == (0.5, 0.0, 0.0, 0.0)
    assert flat.average_precision == 0.5
    assert flat.brier == pytest.approx((2 * 0.04 + 2 * 0.64) / 4)


def test_one_class_has_no_auc(spark):
    assert metrics.fold_metrics(scores_of(spark, [1, 1], [0.2, 0.7]), ["model"]).first().roc_auc is None


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_auc_with_a_hot_score_matches_brute_force(spark, parts):
    rng = np.random.default_rng(7)
    n = 900
    y = rng.integers(0, 2, n)
    p = np.where(rng.uniform(size=n) < 0.34, 0.5, np.round(rng.uniform(size=n) * 0.6 + 0.2 * y, 3))
    df = scores_of(spark, y, p).repartition(parts)
    row = metrics.fold_metrics(df, ["model"]).first()
    assert row.roc_auc == pytest.approx(brute_auc(y, p), abs=1e-12)
    order = np.unique(p)[::-1]
    tp = np.array([(y[p >= t] == 1).sum() for t in order])
    flagged = np.array([(p >= t).sum() for t in order])
    steps = np.diff(np.concatenate([[0], tp])) / y.sum()
    assert row.average_precision == pytest.approx((steps * tp / flagged).sum(), abs=1e-12)
    assert row.brier == pytest.approx(((y - p) ** 2).mean(), abs=1e-12)


# ------------------------------------------------------------------ cost and thresholds


def cost_of(df, t, ratio):
    return metrics.expected_cost(df, t, ratio).first()["cost"]


def test_costs_by_hand(spark):
    # Two missed positives and one false alarm at 0.6; everything flagged at 0.05; nothing at 0.99.
    df = scores_of(spark, [1, 1, 1, 0, 0, 0, 0], [0.3, 0.55, 0.8, 0.7, 0.2, 0.1, 0.4])
    assert [cost_of(df, 0.6, r) for r in (1.0, 2.5, 20.0)] == [3.0, 6.0, 41.0]
    assert cost_of(df, 0.05, 20.0) == 4.0
    assert cost_of(df, 0.99, 4.0) == 12.0


def brute_threshold(y, p, ratio):
    grid = np.linspace(0.01, 0.99, 197)
    costs = np.array([((y == 1) & (p < t)).sum() * ratio + ((y == 0) & (p >= t)).sum() for t in grid])
    return grid[np.flatnonzero(costs == costs.min())[-1]], costs.min()


def test_optimal_thresholds_match_the_full_search(oof, synthetic):
    ratios = [1.0, 3.0, 10.0, 50.0, 200.0]
    for r in thresholds.optimal_thresholds(oof, ratios).collect():
        rows = synthetic[synthetic.repetition == r.repetition]
        best, cost = brute_threshold(rows.y.to_numpy(), rows.p.to_numpy(), r.cost_ratio)
        assert (r.threshold, r.cost) == (best, cost)
        assert r.true_positives + r.false_positives + r.false_negatives + r.true_negatives == 240


def test_scores_on_the_grid_are_flagged(spark):
    grid = thresholds.threshold_grid()
    df = scores_of(spark, [1] * 197, grid)
    cells = {r.threshold: r.true_positives for r in thresholds.threshold_cells(df).collect()}
    assert [cells[t] for t in grid] == list(range(197, 0, -1))


def test_ties_go_to_the_highest_threshold(spark):
    row = thresholds.optimal_thresholds(scores_of(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]), [3.0]).first()
    assert row.threshold == max(t for t in thresholds.threshold_grid() if t <= 0.8)


def test_sensitivity_moves_one_way(oof):
    table = thresholds.cost_sensitivity(oof).toPandas()
    assert table["is_anchor"].sum() == 1
    assert (table["recall"].diff().dropna() >= 0).all()
    assert (table["threshold"].diff().dropna() <= 0).all()
    assert (table["n_flagged"].diff().dropna() >= 0).all()
    assert (table["false_negatives"].diff().dropna() <= 0).all()
    assert (table["threshold_low"] <= table["threshold"]).all()


def test_degeneracy_spares_the_anchor(spark):
    rows = [(1.0, False, 0.85), (3.0, True, 0.9), (5.0, False, 0.86)]
    df = spark.createDataFrame(rows, "cost_ratio double, is_anchor boolean, flagged_share double")
    assert [r.degenerate for r in thresholds.degeneracy(df).collect()] == [False, False, True]


def test_single_repetition_has_zero_width(spark):
    df = scores_of(spark, [0, 1, 1, 0], [0.2, 0.9, 0.4, 0.6])
    for r in thresholds.metrics_with_interval(df, 0.5).collect():
        assert r.ci_low == r.value == r.ci_high


def test_confusion_cells_average_over_repetitions(oof):
    cells = {r.cell: r.n for r in thresholds.confusion_matrix(oof, 0.5).collect()}
    assert sum(cells.values()) == pytest.approx(240)
    assert cells["true_positives"] + cells["false_negatives"] == pytest.approx(80)


# ------------------------------------------------------------------ curves


def brute_gain(ids, y, p, slices=10):
    order = np.lexsort((ids, -p))
    ranked = y[order]
    return [int(ranked[: int(round(len(y) * k / slices))].sum()) for k in range(1, slices + 1)]


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_gain_splits_tie_groups_by_id(spark, parts):
    rng = np.random.default_rng(3)
    n = 1_003
    y = rng.integers(0, 2, n)
    p = np.where(rng.uniform(size=n) < 0.4, 0.5, np.round(rng.uniform(size=n), 1))
    ids = rng.permutation(n)
    df = spark.createDataFrame(
        pd.DataFrame({"unit_id": ids, "y": y, "p": p}), "unit_id long, y int, p double"
    ).repartition(parts)
    got = curves.gain_curve(df).toPandas()
    assert got["captured"].tolist() == brute_gain(ids, y, p)
    assert got["captured_share"].iloc[-1] == 1.0 and got["lift"].iloc[-1] == pytest.approx(1.0)
    assert got["n_inspected"].tolist() == [int(round(n * k / 10)) for k in range(1, 11)]


def test_gain_when_every_score_is_equal(spark):
    df = spark.createDataFrame([(i, i % 2, 0.5) for i in range(40)], "unit_id long, y int, p double")
    assert [r.captured for r in curves.gain_curve(df).collect()] == [2 * k for k in range(1, 11)]


def test_gain_finds_signal_and_not_noise(spark, oof):
    assert curves.gain_curve(curves.mean_scores(oof)).first().lift > 1.5
    rng = np.random.default_rng(42)
    noise = scores_of(spark, rng.integers(0, 2, 400), rng.uniform(size=400))
    lifts = [r.lift for r in curves.gain_curve(curves.mean_scores(noise)).collect()]
    assert lifts[4] == pytest.approx(1.0, abs=0.2)


def test_capacity_interpolates_the_gain(spark, oof):
    gain = curves.gain_curve(curves.mean_scores(oof))
    points = gain.toPandas()
    capacities = [0, 10, 33, 60, 240]
    got = curves.capacity_plan(gain, capacities).toPandas()
    x = np.concatenate([[0], points["share_inspected"]])
    y = np.concatenate([[0], points["captured_share"]])
    want = np.interp([c / 240 for c in capacities], x, y)
    assert got["captured_share"].tolist() == pytest.approx(want.tolist())
    assert got["found"].tolist() == [round(float(w) * 80) for w in want]
    assert got["lift"].iloc[0] == 0.0


def test_roc_and_precision_recall_points(spark):
    y, p = np.array([0, 1, 1, 0, 1]), np.array([0.1, 0.4, 0.4, 0.6, 0.9])
    scores = curves.mean_scores(scores_of(spark, y, p))
    roc = [(r.threshold, r.false_positive_rate, r.true_positive_rate) for r in curves.roc_curve(scores).collect()]
    assert roc == [(float("inf"), 0, 0), (0.9, 0, pytest.approx(1 / 3)), (0.6, 0.5, pytest.approx(1 / 3)), (0.4, 0.5, 1), (0.1, 1, 1)]
    pr = [(r.threshold, r.precision, r.recall) for r in curves.precision_recall_curve(scores).collect()]
    assert pr[0] == (0.1, 0.6, 1.0) and pr[-1] == (0.9, 1.0, pytest.approx(1 / 3)) and len(pr) == 4


def test_calibration_reads_off_miscalibration(spark):
    rng = np.random.default_rng(42)
    p = rng.uniform(0, 0.5, 4_000)
    for factor, check in ((1, lambda e: e < 0.06), (2, lambda e: e > 0.15)):
        y = (rng.uniform(size=4_000) < factor * p).astype(int)
        table = curves.calibration(curves.mean_scores(scores_of(spark, y, p)))
        assert check(curves.calibration_error(table).first().mean_absolute_error)
        assert table.count() == 5


def test_calibration_bins_are_right_closed(spark):
    df = spark.createDataFrame(
        [(i, 1, v) for i, v in enumerate([0.0, 0.1, 0.1000001, 1.0])], "unit_id long, y int, p double"
    )
    got = {r.bin_label: r.n for r in curves.calibration(df).collect()}
    assert got == {"(-0.001, 0.1]": 2, "(0.1, 0.2]": 1, "(0.9, 1.0]": 1}
    assert curves.bin_labels()[2] == "(0.2, 0.3]"


def test_evaluation_writes_and_decides(spark, oof, tmp_path):
    target = str(tmp_path / "evaluation")
    write_layer(oof, str(tmp_path / "oof"), "model", "feature_set")
    result = evaluate(read_predictions(spark, str(tmp_path / "oof"), "m", "s"), "m", "s", target)
    record = read_record(spark, f"{target}/decision")
    assert record == result.decision
    assert record["threshold_low"] <= record["threshold"] <= record["threshold_high"]
    assert read_layer(spark, f"{target}/metrics").count() == 8
    with pytest.raises(ValueError, match="no out-of-fold"):
        read_predictions(spark, str(tmp_path / "oof"), "m", "other")


def test_selection_prefers_few_features_near_the_best(spark):
    schema = "model string, feature_set string, n_features int, roc_auc double, roc_auc_sd double"

    def choose(rows):
        return metrics.select_model(spark.createDataFrame(rows, schema), 25).first()

    inside = [("big", "x", 8, 0.800, 0.05), ("small", "y", 3, 0.795, 0.05)]
    assert choose(inside)["model"] == "small"
    outside = [("big", "x", 8, 0.85, 0.05), ("small", "y", 3, 0.75, 0.05)]
    assert choose(outside)["model"] == "big"
    assert choose([*outside, ("baseline", "y", 1, 0.99, 0.0)])["model"] == "big"


# ------------------------------------------------------------------ edges


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_scores_stop_every_operator(spark, bad):
    df = scores_of(spark, [0, 1, 1], [0.2, 0.9, 0.4]).withColumn(
        "p", F.when(F.col("unit_id") == 1, F.lit(bad)).otherwise(F.col("p"))
    )
    for attempt in (
        lambda: thresholds.optimal_thresholds(df, [3.0]),
        lambda: metrics.fold_metrics(df, ["model"]),
        lambda: metrics.brier(df),
        lambda: curves.roc_curve(df),
        lambda: curves.calibration(df),
        lambda: curves.mean_scores(df),
    ):
        with pytest.raises(Exception, match="null or NaN"):
            attempt().collect()


def test_mean_scores_ignore_the_order_of_rows(spark):
    rng = np.random.default_rng(3)
    values = rng.permutation(np.arange(5) / 7 + 0.013)
    rows = pd.concat(
        pd.DataFrame({"repetition": range(5), "unit_id": u, "y": u % 2, "p": np.roll(values, u)}) for u in range(40)
    )
    df = as_oof(spark, rows)
    for parts in (1, 7, 50):
        assert curves.mean_scores(df.repartition(parts)).select("p").distinct().count() == 1


def test_gain_with_text_ids_matches_numbers(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 500)
    p = rng.integers(0, 4, 500) / 10 + 0.1
    df = scores_of(spark, y, p)
    text = df.withColumn("unit_id", F.format_string("dev-%05d", "unit_id"))
    assert curves.gain_curve(text).collect() == curves.gain_curve(df).collect()
