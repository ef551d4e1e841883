"""Distributed scans against brute force, with one value holding a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators.scan import (
    average_ranks,
    bracket_aggregates,
    exact_quantiles,
    quantiles_in_brackets,
    running_totals,
    sampled_bucket,
    split_points,
    value_counts,
    with_bucket,
)
from riskloom.session import stage


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(42)
    n = 3_000
    value = np.where(rng.uniform(size=n) < 0.34, 7.0, np.round(rng.lognormal(2, 2, n), 2))
    group = np.where(rng.uniform(size=n) < 0.5, "hot", rng.choice(["a", "b", "c"], n))
    return pd.DataFrame({"id": np.arange(n), "g": group, "v": value})


def test_running_totals_match_cumsum(spark, skewed):
    df = spark.createDataFrame(skewed)
    counts = value_counts(df, ["g"], ["v"])
    got = (
        running_totals(counts, ["g", "variable"], "value", ["n"])
        .toPandas()
        .sort_values(["g", "value"])
    )
    want = skewed.groupby(["g", "v"]).size().groupby(level=0).cumsum()
    assert got["cum_n"].tolist() == want.tolist()
    assert (got.groupby("g")["tot_n"].first() == skewed.groupby("g").size()).all()


def test_running_totals_descending_without_keys(spark, skewed):
    df = spark.createDataFrame(skewed[["id", "v"]].assign(one=1))
    got = running_totals(df.select("id", "one"), [], "id", ["one"], descending=True).toPandas()
    assert (got.sort_values("id", ascending=False)["cum_one"].to_numpy() == np.arange(1, 3001)).all()


def test_running_totals_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 5)], "g string, v double, n int")
    got = {(r.g, r.v): (r.cum_n, r.tot_n) for r in running_totals(df, ["g"], "v", ["n"]).collect()}
    assert got == {(None, 1.0): (2, 5), (None, 2.0): (5, 5), ("a", 1.0): (5, 5)}


@pytest.mark.parametrize("cuts", [[], [7.0], [0.0, 7.0, 7.5, 1e9]])
def test_any_split_gives_the_same_totals(spark, skewed, cuts, monkeypatch):
    import riskloom.operators.scan as scan

    counts = value_counts(spark.createDataFrame(skewed), [], ["v"])
    expected = scan.running_totals(counts, [], "value", ["n"]).toPandas()
    monkeypatch.setattr(scan, "split_points", lambda *a, **k: cuts)
    got = scan.running_totals(counts, [], "value", ["n"]).toPandas()
    key = ["value", "cum_n", "tot_n"]
    assert got[key].sort_values("value").values.tolist() == expected[key].sort_values("value").values.tolist()


@pytest.mark.parametrize("parts", [1, 7, 50])
def test_quantiles_match_numpy_whatever_the_partitioning(spark, skewed, parts):
    df = spark.createDataFrame(skewed).repartition(parts)
    got = exact_quantiles(df, ["v"], {"lo": 0.05, "mid": 0.5, "hi": 0.99}, keys=["g"]).toPandas()
    for _, row in got.iterrows():
        values = skewed.loc[skewed["g"] == row["g"], "v"]
        assert row[["lo", "mid", "hi"]].tolist() == pytest.approx(
            values.quantile([0.05, 0.5, 0.99]).tolist(), rel=1e-12
        )


def test_quantiles_with_other_plotting_positions(spark, skewed):
    values = np.sort(skewed["v"].to_numpy())
    n = len(values)
    got = exact_quantiles(
        spark.createDataFrame(skewed), ["v"], {"a": 0.05, "b": 0.95}, plotting=0.4
    ).first()
    for name, p in (("a", 0.05), ("b", 0.95)):
        at = n * p + 0.4 + 0.2 * p
        k = int(np.floor(min(max(at, 1), n - 1)))
        weight = min(max(at - k, 0), 1)
        assert got[name] == pytest.approx((1 - weight) * values[k - 1] + weight * values[k])


def test_quantiles_of_tiny_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 5.0, None), (2, None, None)], "id int, v double, w double")
    got = {r.variable: r.mid for r in exact_quantiles(df, ["v", "w"], {"mid": 0.5}).collect()}
    assert got == {"v": 5.0}


def test_average_ranks_match_pandas(spark, skewed):
    counts = value_counts(spark.createDataFrame(skewed), [], ["v"])
    got = average_ranks(counts, []).toPandas().set_index("value")["avg_rank"]
    want = skewed["v"].rank(method="average")
    assert (got.loc[skewed["v"]].to_numpy() == want.to_numpy()).all()


def test_buckets_stay_small_under_a_heavy_tail(spark, skewed):
    counts = value_counts(spark.createDataFrame(skewed), [], ["v"])
    cuts = split_points(counts, "value", 16)
    sizes = with_bucket(counts, "value", cuts, "b").groupBy("b").count().toPandas()["count"]
    assert sizes.max() <= 3 * counts.count() / 16


def test_bucket_edges_are_left_closed(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (2.0,)], "v double")
    got = with_bucket(df, "v", [1.0, 2.0], "b").orderBy("v").select(F.collect_list("b")).first()[0]
    assert got == [0, 1, 1, 2]


# ------------------------------------------------------------------ several ordering columns


def test_sampled_bucket_splits_ties(spark):
    """All rows share the first column: the second one deals them evenly."""
    df = stage(spark.range(20_000).select(F.lit(0.0).alias("a"), F.concat(F.lit("g"), "id").alias("b")))
    sizes = sorted(r["count"] for r in df.groupBy(sampled_bucket(df, ["a", "b"], 16).alias("k")).count().collect())
    assert len(sizes) == 16 and sizes[-1] < 2 * sizes[8]


def test_sampled_bucket_rises_with_the_order(spark):
    rows = [(None if i % 7 == 0 else float(i % 5), None if i % 11 == 0 else f"é{i}") for i in range(600)]
    df = stage(spark.createDataFrame(rows, "a double, b string"))
    got = df.withColumn("k", sampled_bucket(df, ["a", "b"], 9)).orderBy(F.asc_nulls_first("a"), F.asc_nulls_first("b")).collect()
    ks = [r.k for r in got]
    assert ks == sorted(ks) and len(set(ks)) > 6
    empty = stage(df.filter("false"))
    assert empty.withColumn("k", sampled_bucket(empty, ["a"])).count() == 0


# ------------------------------------------------------------------ quantiles in brackets


@pytest.mark.parametrize("keep_all", [0, 20_000])
def test_brackets_hold_the_exact_quantiles(spark, monkeypatch, keep_all):
    from riskloom.operators import scan

    monkeypatch.setattr(scan, "_BRACKET_ALL", keep_all)
    rng = np.random.default_rng(3)
    n = 9_000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], n), "v": rng.normal(size=n).round(3), "w/x": rng.integers(0, 5, n).astype(float)})
    pdf.loc[rng.random(n) < 0.1, "v"] = 7.0
    df = spark.createDataFrame(pdf, "g string, v double, `w/x` double").withColumnRenamed("w/x", "w")
    df = df.withColumn("v", F.when(F.col("v") > 2.5, None).otherwise(F.col("v")))
    probabilities = {"q": 0.25, "m": 0.5, "top": 0.95}
    for keys in ([], ["g"]):
        brackets = stage(df.groupBy(*keys).agg(*bracket_aggregates(["v", "w"], probabilities)))
        got = quantiles_in_brackets(df, ["v", "w"], probabilities, brackets, keys)
        want = exact_quantiles(df, ["v", "w"], probabilities, keys)
        columns = [*keys, "variable", *probabilities]
        assert sorted(got.select(columns).collect(), key=repr) == sorted(want.select(columns).collect(), key=repr)


def test_missed_brackets_fall_back(spark):
    df = stage(spark.range(50_000).select(F.col("id").cast("double").alias("v")))
    wrong = stage(df.agg(*bracket_aggregates(["v"], {"m": 0.5})).withColumn("__lows_v", F.array(F.lit(40_000.0))).withColumn("__highs_v", F.array(F.lit(41_000.0))))
    assert quantiles_in_brackets(df, ["v"], {"m": 0.5}, wrong).first().m == 24_999.5
    right = stage(df.agg(*bracket_aggregates(["v"], {"m": 0.5})))
    assert quantiles_in_brackets(df, ["v"], {"m": 0.5}, right).first().m == 24_999.5
    assert quantiles_in_brackets(df.filter("false"), ["v"], {"m": 0.5}, stage(df.filter("false").agg(*bracket_aggregates(["v"], {"m": 0.5})))).collect() == []
