import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.functions import tails
from riskloom.functions.columns import tidy, wilson
from riskloom.functions.tails import chi_square_upper, incomplete_beta, student_two_sided
from riskloom.operators import aggregates, stats
from riskloom.operators.features import BUILDERS, add_features, feature_correlation, feature_summary
from riskloom.operators.quality import column_profile, duplicate_rows, tukey_outliers, usage_consistency
from riskloom.roles import AGE_BANDS, DEFAULT_ROLES, USAGE_BANDS, Z_95

SCHEMA = "unit_id long, grp string, age long, usage_km long, events long, label boolean"


@pytest.fixture(scope="module")
def fleet(spark):
    rng = np.random.default_rng(42)
    n = 600
    age = rng.integers(0, 9, n)
    usage = np.maximum(1_000, 15_000 + 14_000 * age + rng.normal(0, 6_000, n)).astype(int)
    events = rng.poisson(0.5 + 0.6 * age)
    label = rng.uniform(size=n) < 1 / (1 + np.exp(2.5 - 0.6 * age))
    pdf = pd.DataFrame(
        {"unit_id": np.arange(n), "grp": rng.choice(["A", "B", "C"], n), "age": age,
         "usage_km": usage, "events": events, "label": label}
    )
    return pdf, spark.createDataFrame(pdf, SCHEMA)


# ------------------------------------------------------------------ features


def test_feature_arithmetic(spark):
    df = spark.createDataFrame([(1, "A", 3, 40_000, 2, True), (2, "A", 0, 500, 3, False)], SCHEMA)
    first, second = add_features(df).orderBy("unit_id").collect()
    assert (first.usage_per_year, first.events_per_year, first.events_per_10k) == (10_000.0, 0.5, 0.5)
    assert (first.many_events, second.many_events) == (False, True)
    assert (second.usage_per_year, second.events_per_10k) == (500.0, 60.0)


def test_zero_usage_gives_null_not_an_error(spark):
    df = spark.createDataFrame([(1, "A", 0, 0, 1, True)], SCHEMA)
    assert add_features(df).first().events_per_10k is None


@pytest.mark.parametrize(
    ("column", "bands", "values"),
    [
        ("age_band", AGE_BANDS, {0: 0, 1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 3, 30: 3}),
        ("usage_band", USAGE_BANDS, {0: 0, 25_000: 0, 25_001: 1, 75_000: 1, 125_000: 2, 125_001: 3}),
    ],
)
def test_bands_are_right_closed(spark, column, bands, values):
    source = "age" if column == "age_band" else "usage_km"
    df = spark.createDataFrame([(int(v),) for v in values], f"{source} long")
    got = dict(map(tuple, df.select(source, BUILDERS[column](DEFAULT_ROLES).alias("b")).collect()))
    assert got == {v: bands[i][1] for v, i in values.items()}


def test_values_outside_all_bands_have_none(spark):
    df = spark.createDataFrame([(31,), (-1,), (None,)], "age long")
    assert [r[0] for r in df.select(BUILDERS["age_band"](DEFAULT_ROLES)).collect()] == [None] * 3


def test_features_are_row_wise(fleet):
    _, df = fleet
    half = add_features(df.filter("unit_id < 300"))
    whole = add_features(df).filter("unit_id < 300")
    assert sorted(map(tuple, half.collect())) == sorted(map(tuple, whole.collect()))


def test_yearly_usage_separates_from_age(fleet):
    _, df = fleet
    r = {(x.variable, x.other): x.r for x in feature_correlation(add_features(df)).collect()}
    assert r[("age", "usage_km")] > 0.9
    assert abs(r[("usage_per_year", "age")]) < 0.3
    assert all(x.n_infinite == 0 for x in feature_summary(add_features(df)).collect())


# ------------------------------------------------------------------ intervals


@pytest.mark.parametrize("case", [(0, 1), (2, 2), (0, 37), (41, 41), (13, 29), (1, 10**9), (10**9 - 2, 10**9)])
def test_wilson_edge_values(spark, case):
    k, n = case
    p, z2 = k / n, Z_95**2
    centre = (p + z2 / (2 * n)) / (1 + z2 / n)
    margin = Z_95 * math.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    w = wilson("k", "n")
    low, high = spark.createDataFrame([case], "k long, n long").select(w["low"], w["high"]).first()
    assert low == pytest.approx(max(centre - margin, 0), abs=1e-12)
    assert high == pytest.approx(min(centre + margin, 1), abs=1e-12)
    assert low <= p + 1e-12 and p - 1e-12 <= high


def test_wilson_of_nothing_is_null_and_width_shrinks(spark):
    w = wilson("k", "n")
    df = spark.createDataFrame([(0, 0), (5, 10), (500, 1000)], "k long, n long")
    widths = [r[0] for r in df.select(w["high"] - w["low"]).collect()]
    assert widths[0] is None and widths[1] > widths[2]


def test_ranking_and_rate_table_agree(fleet):
    _, df = fleet
    ranking = {r.grp: r for r in aggregates.risk_ranking(df).collect()}
    rates = {r.grp: r for r in aggregates.rate_by_level(df, "grp").collect()}
    for g, row in ranking.items():
        assert (row.rate, row.ci_low, row.ci_high) == pytest.approx(
            (rates[g].rate, rates[g].ci_low, rates[g].ci_high), rel=1e-9
        )
    assert aggregates.interval_overlap(aggregates.risk_ranking(df)).first().overlaps


def test_small_levels_and_null_groups(spark):
    rows = [(i, None if i < 3 else "A", 1, 10, 1, True) for i in range(15)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.grp: r.n_units for r in aggregates.rate_by_level(df, "grp").collect()} == {None: 3, "A": 12}
    assert [r.grp for r in aggregates.rate_by_level(df, "grp", minimum=10).collect()] == ["A"]
    profile = {r.grp: r.median_usage for r in aggregates.group_profile(df).collect()}
    assert profile == {None: 10.0, "A": 10.0}


def test_missing_label_counts_as_not_positive(spark):
    df = spark.createDataFrame([(1, "A", 1, 1, 1, True), (2, "A", 1, 1, 1, None)], SCHEMA)
    row = aggregates.rate_by_level(df, "grp").first()
    assert (row.n_units, row.n_positive, row.rate) == (2, 1, 0.5)


def test_grid_keeps_empty_cells(spark):
    df = spark.createDataFrame([(1, "A", 1, 1_000, 1, True), (2, "A", 9, 200_000, 1, False)], SCHEMA)
    grid = aggregates.segment_pivot(aggregates.segment_matrix(add_features(df))).collect()
    assert [r.age_band for r in grid] == [label for _, label in AGE_BANDS]
    assert grid[0]["ate 25 mil km"] == 1.0 and grid[1]["ate 25 mil km"] is None


def test_histogram_matches_numpy(fleet):
    pdf, df = fleet
    got = aggregates.histogram(df, "usage_km", "label").toPandas()
    for label in (True, False):
        counts, edges = np.histogram(pdf.loc[pdf.label == label, "usage_km"], bins=22)
        mine = got[got.label == label].set_index("bin")
        assert [int(mine["n"].get(i, 0)) for i in range(22)] == counts.tolist()
        assert mine["bin_from"].iloc[0] == pytest.approx(edges[mine.index[0]])


# ------------------------------------------------------------------ description and association


def test_description_matches_pandas(fleet):
    pdf, df = fleet
    got = aggregates.describe(df, ["age", "usage_km", "events"]).toPandas().set_index("variable")
    for c in got.index:
        x = pdf[c]
        want = [x.mean(), x.std(), x.quantile(0.25), x.median(), x.quantile(0.75), x.skew(), x.kurtosis()]
        names = ["mean", "sd", "q25", "median", "q75", "skewness", "kurtosis"]
        assert got.loc[c, names].tolist() == pytest.approx(want, rel=1e-9)


def test_sketched_quartiles_are_close(fleet):
    pdf, df = fleet
    row = {r.variable: r for r in aggregates.describe(df, ["usage_km"], accuracy=1_000).collect()}["usage_km"]
    assert row.median == pytest.approx(pdf.usage_km.median(), rel=0.02)
    row = tukey_outliers(df, ["usage_km"], accuracy=1_000).first()
    assert row.q1 == pytest.approx(pdf.usage_km.quantile(0.25), rel=0.05)


def test_profile_duplicates_outliers_consistency(fleet):
    pdf, df = fleet
    profile = {r.variable: r for r in column_profile(df).collect()}
    assert profile["usage_km"].n_distinct == pdf.usage_km.nunique()
    approx = {r.variable: r.n_distinct for r in column_profile(df, approximate=True).collect()}
    assert approx["grp"] == 3
    repeated = df.union(df.filter("unit_id < 2"))
    assert [r.n_occurrences for r in duplicate_rows(repeated).collect()] == [2, 2]
    assert duplicate_rows(df).columns[-1] == "n_occurrences" and duplicate_rows(df).isEmpty()
    row = {r.variable: r for r in tukey_outliers(df, ["events"]).collect()}["events"]
    q1, q3 = pdf.events.quantile([0.25, 0.75])
    outside = (pdf.events < q1 - 1.5 * (q3 - q1)) | (pdf.events > q3 + 1.5 * (q3 - q1))
    assert (row.n_outliers, row.share_outliers) == (outside.sum(), pytest.approx(outside.mean()))
    assert usage_consistency(df).count() == (pdf.age > 0).sum()


def test_correlations_match_pandas(fleet):
    pdf, df = fleet
    columns = ["age", "usage_km", "events"]
    wide = pdf[columns].assign(target=pdf.label.astype(int))
    for method in ("pearson", "spearman"):
        want = wide.corr(method=method)
        for r in stats.correlation_matrix(df, columns, method, "label").collect():
            assert r.r == pytest.approx(want.loc[r.variable, r.other], abs=1e-12)
    with_target = {r.variable: r for r in stats.correlation_with_target(df, columns).collect()}
    for c in columns:
        assert with_target[c].r == pytest.approx(wide.corr().loc[c, "target"], abs=1e-12)
        assert with_target[c].rho == pytest.approx(wide.corr("spearman").loc[c, "target"], abs=1e-12)
        assert with_target[c].significant
    with pytest.raises(ValueError, match="unknown method"):
        stats.correlation_matrix(df, columns, "kendall")


def test_constant_columns_describe_and_correlate_to_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, True), (1.0, 3.0, False)], "a double, b double, label boolean")
    row = {r.variable: r for r in aggregates.describe(df, ["a", "b"]).collect()}["a"]
    assert (row.sd, row.iqr, row.skewness) == (0.0, 0.0, None)
    r = {(x.variable, x.other): x.r for x in stats.correlation_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None and r[("a", "a")] == 1.0
    assert {x.variable: x.r for x in stats.correlation_with_target(df, ["a"]).collect()} == {"a": None}


def test_vif_flags_collinear_columns(fleet, spark):
    pdf, df = fleet
    got = {r.variable: r.vif for r in stats.variance_inflation(df, ["age", "usage_km", "events"]).collect()}
    x = pdf[["age", "usage_km", "events"]].to_numpy(float)
    want = np.diag(np.linalg.inv(np.corrcoef(x.T)))
    assert [got[c] for c in ("age", "usage_km", "events")] == pytest.approx(want.tolist(), rel=1e-9)
    assert got["age"] > 5 and got["events"] < 3
    copy = df.withColumns({"twice": F.col("age") * 2, "flat": F.lit(1)})
    exact = {r.variable: r.vif for r in stats.variance_inflation(copy, ["age", "twice", "flat"]).collect()}
    assert exact == {"age": math.inf, "twice": math.inf, "flat": 1.0}


def test_chi_square_known_values(spark):
    rows = [(10, True, "A"), (20, False, "A"), (30, True, "B"), (40, False, "B"), (25, True, "C"), (15, False, "C")]
    df = spark.createDataFrame(
        [(g, y) for n, y, g in rows for _ in range(n)], "grp string, label boolean"
    )
    observed = np.array([[10, 20], [30, 40], [25, 15]], float)
    expected = np.outer(observed.sum(1), observed.sum(0)) / observed.sum()
    chi2 = ((observed - expected) ** 2 / expected).sum()
    row = stats.chi_square(df, "grp").first()
    assert (row.chi2, row.dof, row.n) == (pytest.approx(chi2), 2, 140)
    assert row.p_value == pytest.approx(math.exp(-chi2 / 2))
    assert row.cramers_v == pytest.approx(math.sqrt(chi2 / 140))
    two = stats.chi_square(df.filter("grp <> 'C'"), "grp").first()
    part = observed[:2]
    e = np.outer(part.sum(1), part.sum(0)) / part.sum()
    gap = np.abs(part - e)
    assert two.chi2 == pytest.approx(((gap - np.minimum(0.5, gap)) ** 2 / e).sum())
    assert two.dof == 1
    one = stats.chi_square(df.filter("grp = 'A'"), "grp").first()
    assert (one.chi2, one.p_value, one.dof, one.cramers_v) == (0.0, 1.0, 0, 0.0)


def test_tail_probabilities():
    # Closed forms: t with 1 and 2 degrees of freedom; chi-square with 1 and 4.
    for t in (0.0, 0.5, 2.0, 30.0):
        assert student_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-13)
        assert student_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-13)
    for x in (0.01, 1.0, 6.69, 80.0):
        assert chi_square_upper(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
        assert chi_square_upper(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-10)
    assert chi_square_upper(6.69, 8) == pytest.approx(0.570, abs=1e-3)
    assert incomplete_beta(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert student_two_sided(math.inf, 24) == 0.0 and student_two_sided(None, 24) is None
    assert student_two_sided(1.96, 1e6) == pytest.approx(0.05, abs=1e-4)


# ------------------------------------------------------------------ paired tests and selection


def fold_table(spark, values):
    rows = [
        (m, s, i // 5, i % 5, float(v)) for (m, s), series in values.items() for i, v in enumerate(series)
    ]
    return spark.createDataFrame(
        rows, "model string, feature_set string, repetition int, fold int, roc_auc double"
    )


def test_corrected_test_is_more_careful(spark):
    rng = np.random.default_rng(42)
    base = 0.8 + rng.normal(0, 0.02, 25)
    folds = fold_table(
        spark,
        {
            ("a", "s"): base,
            ("same", "s"): base,
            ("shifted", "s"): base - 0.125,
            ("close", "s"): base - 0.01 + rng.normal(0, 0.02, 25),
            ("far", "s"): base - 0.2 + rng.normal(0, 0.01, 25),
        },
    )
    got = {r.model: r for r in stats.paired_tests(folds, "a", "s").collect()}
    assert got["same"].p_corrected == 1.0 and not got["same"].distinguishable
    assert got["same"].p_naive is None
    assert got["close"].p_corrected > got["close"].p_naive
    assert got["far"].p_corrected < 1e-3 and got["far"].mean_difference > 0
    assert got["shifted"].t_corrected > 1e6 and got["shifted"].p_corrected < 1e-100


def test_constant_exact_difference_is_infinite(spark):
    folds = fold_table(spark, {("a", "s"): [0.75] * 25, ("b", "s"): [0.5] * 25})
    row = stats.paired_tests(folds, "a", "s").first()
    assert row.t_corrected == math.inf and row.p_corrected == 0.0


def test_tidy_has_no_negative_zero(spark):
    value = spark.range(1).select(tidy(F.lit(-1e-15))).first()[0]
    assert math.copysign(1, value) == 1.0


# ------------------------------------------------------------------ nulls and many rows


def test_rank_correlation_uses_rows_complete_in_the_pair(spark):
    rng = np.random.default_rng(23)
    pdf = pd.DataFrame({c: rng.integers(0, k, 400).astype(float) for c, k in (("a", 4), ("b", 50), ("c", 300))})
    pdf.loc[rng.choice(400, 60, replace=False), "a"] = np.nan
    pdf.loc[rng.choice(400, 90, replace=False), "c"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    for method in ("pearson", "spearman"):
        expected = pdf.corr(method)
        for r in stats.correlation_matrix(df, ["a", "b", "c"], method).collect():
            assert r.r == pytest.approx(expected.loc[r.variable, r.other], abs=1e-12)


@pytest.mark.parametrize("t, normal", [(2.0, 0.04550026389635842), (6.0, 1.973175290075396e-09)])
def test_t_tail_with_very_many_rows(t, normal):
    # The first correction to the normal tail is t (t^2 + 1) density / (2 dof).
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    for dof in (1e6, 1e8, 1e10, 1e12, 1e14):
        expected = normal + 2 * t * (t * t + 1) * density / (4 * dof)
        assert tails.student_two_sided(t, dof) == pytest.approx(expected, rel=1e-9)
    assert tails.student_two_sided(t, 20_001.0) == pytest.approx(tails.student_two_sided(t, 20_000.0), rel=2e-3)
