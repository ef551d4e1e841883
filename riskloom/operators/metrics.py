"""Classifier metrics from predictions (columns y and p), per group of key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import mean_interval, ratio, ratio_or_zero
from riskloom.operators.scan import running_totals
from riskloom.roles import FALSE_POSITIVE_COST

FIXED_METRICS = ("accuracy", "precision", "recall", "f1")
RANK_METRICS = ("roc_auc", "average_precision", "brier")
CELLS = ("true_positives", "false_positives", "false_negatives", "true_negatives")


def score() -> Column:
    """The score ``p``; a null or NaN score stops the query instead of vanishing from a count."""
    missing = F.col("p").isNull() | F.isnan("p")
    return F.when(missing, F.raise_error(F.lit("a score is null or NaN"))).otherwise(F.col("p"))


def cells_at(threshold: Column | float) -> list[Column]:
    """Confusion counts as aggregates; a score equal to the threshold is flagged."""
    cut = F.lit(threshold) if isinstance(threshold, float) else threshold
    flagged, actual = score() >= cut, F.col("y") == 1
    return [
        F.count_if(actual & flagged).alias("true_positives"),
        F.count_if(~actual & flagged).alias("false_positives"),
        F.count_if(actual & ~flagged).alias("false_negatives"),
        F.count_if(~actual & ~flagged).alias("true_negatives"),
    ]


def add_rates(df: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and flagged share from the four cells; 0 if undefined."""
    tp, fp, fn, tn = (F.col(c) for c in CELLS)
    total = tp + fp + fn + tn
    return df.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, total),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(tp * 2, tp * 2 + fp + fn),
            "n_flagged": tp + fp,
            "flagged_share": ratio_or_zero(tp + fp, total),
        }
    )


def metrics_at(df: DataFrame, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    """Cells and the four metrics at one threshold for each key group."""
    return add_rates(df.groupBy(*keys).agg(*cells_at(threshold)))


def expected_cost(
    df: DataFrame, threshold: float, cost_ratio: float, keys: Sequence[str] = ()
) -> DataFrame:
    """Cost of a threshold in units of one false positive."""
    cells = df.groupBy(*keys).agg(*cells_at(threshold))
    return cells.withColumn(
        "cost",
        F.col("false_negatives") * F.lit(float(cost_ratio))
        + F.col("false_positives") * F.lit(FALSE_POSITIVE_COST),
    )


def score_counts(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: positives and negatives. Ties collapse here."""
    return df.withColumn("p", score()).groupBy(*keys, "p").agg(
        F.sum(F.col("y").cast("bigint")).alias("pos"),
        F.sum((F.lit(1) - F.col("y")).cast("bigint")).alias("neg"),
    )


def score_scan(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Cumulative positives and negatives from the highest score down."""
    return running_totals(score_counts(df, keys), keys, "p", ["pos", "neg"], descending=True)


def rank_metrics(scanned: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ROC AUC (ties at half weight) and average precision from a score scan.

    Terms are shares rather than products of counts, so they cannot overflow.
    """
    pos_share = ratio("pos", "tot_pos")
    below = F.col("tot_neg") - F.col("cum_neg") + F.col("neg") / F.lit(2.0)
    return scanned.groupBy(*keys).agg(
        F.sum(pos_share * ratio(below, "tot_neg")).alias("roc_auc"),
        F.sum(pos_share * ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg"))).alias(
            "average_precision"
        ),
    )


def brier(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    gap = F.col("y") - score()
    return df.groupBy(*keys).agg(F.avg(gap * gap).alias("brier"))


def fold_metrics(oof: DataFrame, keys: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """All seven metrics per key group, from one table of counts per distinct score.

    Every metric is a function of (score, positives, negatives), so predictions are
    read once and the rest works on that table.
    """
    keys = list(keys)
    scanned = score_scan(oof, keys)
    flagged = F.col("p") >= F.lit(threshold)
    miss = F.lit(1.0) - F.col("p")

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    pos_share = ratio("pos", "tot_pos")
    below = F.col("tot_neg") - F.col("cum_neg") + F.col("neg") / F.lit(2.0)
    per = scanned.groupBy(*keys).agg(
        total("pos", flagged).alias("true_positives"),
        total("neg", flagged).alias("false_positives"),
        total("pos", ~flagged).alias("false_negatives"),
        total("neg", ~flagged).alias("true_negatives"),
        F.sum(pos_share * ratio(below, "tot_neg")).alias("roc_auc"),
        F.sum(pos_share * ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg"))).alias(
            "average_precision"
        ),
        F.sum(F.col("pos") * miss * miss + F.col("neg") * F.col("p") * F.col("p")).alias("__sq"),
        F.sum(F.col("pos") + F.col("neg")).alias("__n"),
    )
    return add_rates(per).select(
        *keys, *FIXED_METRICS, "roc_auc", "average_precision", ratio("__sq", "__n").alias("brier")
    )


def compare_models(folds: DataFrame, n_features: dict[str, int] | None = None) -> DataFrame:
    """Mean, interval and standard deviation of every metric per model and feature set."""
    aggregates = []
    for m in (*FIXED_METRICS, *RANK_METRICS):
        aggregates += mean_interval(m, m, guard_single=False)
        aggregates.append(F.stddev_samp(m).alias(f"{m}_sd"))
    table = folds.groupBy("model", "feature_set").agg(*aggregates)
    if n_features:
        sizes = F.create_map(*[F.lit(v) for pair in n_features.items() for v in pair])
        table = table.withColumn("n_features", sizes[F.col("feature_set")])
    return table.orderBy(F.col("roc_auc").desc(), "model", "feature_set")


def select_model(
    comparison: DataFrame,
    n_estimates: int,
    metric: str = "roc_auc",
    baseline: str = "baseline",
) -> DataFrame:
    """One-standard-error rule: fewest features among the combinations near the best.

    The comparison table has one row per model and feature set.
    """
    eligible = comparison.filter(F.col("model") != baseline)
    best = eligible.orderBy(F.col(metric).desc(), "model", "feature_set").first()
    if best is None:
        raise ValueError("no candidate besides the baseline")
    error = best[f"{metric}_sd"] / n_estimates**0.5
    return (
        eligible.filter(F.col(metric) >= F.lit(best[metric] - error))
        .withColumns({"band_low": F.lit(best[metric] - error), "band_high": F.lit(best[metric])})
        .orderBy("n_features", F.col(metric).desc(), "model", "feature_set")
        .limit(1)
    )


def one_error_band(
    comparison: DataFrame, n_estimates: int, metric: str = "roc_auc", baseline: str = "baseline"
) -> DataFrame:
    """(best - one standard error, best) over the candidates."""
    top = F.max_by(f"{metric}_sd", metric)
    return (
        comparison.filter(F.col("model") != baseline)
        .agg(F.max(metric).alias("band_high"), top.alias("sd"))
        .select(
            (F.col("band_high") - F.col("sd") / F.lit(float(n_estimates) ** 0.5)).alias("band_low"),
            "band_high",
        )
    )
