"""Tree ensembles of the library, one distributed fit over all rows at a time; ``ensembles`` fits many at once.

They are the library's ensembles, which differ from others in two ways that no option reaches: boosting has no
penalty on leaf values, and columns are sampled for each node, not for each tree. Numeric columns are cut at
``bins`` quantiles before splitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.design import CATEGORY, FLAG, Term
from riskloom.operators.linear import Design
from riskloom.operators.scan import SMALL_SIDE
from riskloom.roles import SEED
from riskloom.session import discard, stage

FOREST, BOOSTING = "forest", "boosting"
LIBRARY_DEPTH = 30


@dataclass(frozen=True)
class TreeOptions:
    """Fixed hyperparameters. The library needs a depth limit for a forest without one: 30 is its largest.

    ``leaf_penalty``, ``least_curvature`` and ``fit_rows`` (units that a fit may read; all by default) are for ``ensembles``.
    """

    forest_trees: int = 300
    forest_depth: int | None = None
    forest_leaf: int = 5
    boosting_rounds: int = 300
    boosting_depth: int = 3
    boosting_rate: float = 0.05
    sampling: float = 0.8
    bootstrap: bool = True
    bins: int = 256
    seed: int = SEED
    leaf_penalty: float = 1.0
    least_curvature: float = 1.0
    fit_rows: int | None = None


def estimator(kind: str, options: TreeOptions = TreeOptions()):
    common = {"featuresCol": "inputs", "labelCol": "y", "seed": options.seed, "maxBins": options.bins}
    if kind == FOREST:
        return RandomForestClassifier(
            numTrees=options.forest_trees,
            maxDepth=LIBRARY_DEPTH if options.forest_depth is None else options.forest_depth,
            minInstancesPerNode=options.forest_leaf,
            featureSubsetStrategy="sqrt",
            bootstrap=options.bootstrap,
            cacheNodeIds=False,
            **common,
        )
    if kind == BOOSTING:
        return GBTClassifier(
            maxIter=options.boosting_rounds,
            maxDepth=options.boosting_depth,
            stepSize=options.boosting_rate,
            subsamplingRate=options.sampling,
            featureSubsetStrategy=str(options.sampling),
            **common,
        )
    raise ValueError(f"unknown tree model {kind!r}")


def _pipeline(kind: str, columns: Sequence[str], options: TreeOptions, weight: str | None) -> Pipeline:
    assemble = VectorAssembler(inputCols=list(columns), outputCol="inputs")
    chosen = estimator(kind, options)
    return Pipeline(stages=[assemble, chosen.setWeightCol(weight) if weight else chosen])


def fit_tree(
    kind: str,
    rows: DataFrame,
    columns: Sequence[str],
    options: TreeOptions = TreeOptions(),
    weight: str | None = None,
) -> PipelineModel:
    model = _pipeline(kind, columns, options, weight).fit(rows.withColumn("y", F.col("y").cast("double")))
    # A copy is the model without its training summary. The summary holds the session, which cannot go to the tasks
    # once the session has observed a query.
    return model.copy()


def tree_out_of_fold(
    kind: str,
    design: Design,
    feature_sets: Sequence[str] | None = None,
    options: TreeOptions = TreeOptions(),
    folds: Sequence[tuple[int, int]] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Fit on the other folds of the repetition, score the fold; for every fold and set.

    A few fits run at a time, so that the small last stages of one leave room for another. Sets of dummies and flags
    are fitted on counted inputs where that gives the same trees, others on a row per unit.
    """
    if folds is None:
        pairs = design.table.select("repetition", "fold").distinct().collect()  # folds x repetitions
        folds = sorted((r["repetition"], r["fold"]) for r in pairs)
    names = list(feature_sets or design.sets)
    counted = {name: _counted_inputs(kind, design, name, options) for name in names}

    def score_fold(task: tuple[str, int, int]) -> DataFrame:
        name, repetition, fold = task
        columns = [design.column(t) for t in design.sets[name]]
        if counted[name] is not None:
            same, weight = counted[name].filter(F.col("repetition") == repetition), "n"
        else:
            # One row per unit: a repetition's folds are one entry of the fold vectors.
            own = [F.lit(repetition).alias("repetition"), F.col("folds")[repetition].alias("fold")]
            same, weight = design.units.select(*own, "unit_id", "y", *columns), None
        model = fit_tree(kind, same.filter(F.col("fold") != fold), columns, options, weight)
        scored = model.transform(same.filter(F.col("fold") == fold))
        return scored.withColumn("p", F.element_at(vector_to_array("probability"), 2))

    # Each fit has its own copy of the local properties: Spark keeps the id of a running query there.
    spark = design.table.sparkSession
    tasks = [partial(score_fold, (name, *pair)) for name in names for pair in folds]
    tasks = [inheritable_thread_target(spark)(task) for task in tasks]
    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(lambda task: task(), tasks))

    def of_units(i: int, name: str) -> DataFrame:
        scored = reduce(DataFrame.unionByName, parts[i * len(folds) : (i + 1) * len(folds)])
        if counted[name] is not None:
            inputs = ["repetition", "fold", *[design.column(t) for t in design.sets[name]]]
            scores = stage(scored.select(*inputs, "p").distinct())
            # No null is among the inputs: the library stops at one.
            scored = design.table.join(F.broadcast(scores), inputs)
        own = [F.lit(kind).alias("model"), F.lit(name).alias("feature_set")]
        return scored.select(*own, "repetition", "fold", "unit_id", "y", "p")

    found = reduce(DataFrame.unionByName, [of_units(i, name) for i, name in enumerate(names)])
    discard(*[table for table in counted.values() if table is not None])
    return found


def _counted_inputs(kind: str, design: Design, name: str, options: TreeOptions) -> DataFrame | None:
    """Units ``n`` of every repetition, fold, outcome and different input of a feature set, staged; one pass for all fits.

    A fit that draws no rows and asks for no number of rows in a leaf reads only sums over equal rows, so a row weighted
    by its count stands for them. None for other fits, for terms that are not dummies or flags (the library cuts a
    number by a sample of its rows), and where there are too many different inputs to be broadcast.
    """
    whole = not options.bootstrap and options.forest_leaf == 1 if kind == FOREST else options.sampling == 1.0
    terms = design.sets[name]
    if not whole or not all(t.kind in (CATEGORY, FLAG) for t in terms):
        return None
    keys = ["repetition", "fold", "y", *[design.column(t) for t in terms]]
    counted = stage(design.table.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("n")))
    if counted.count() <= SMALL_SIDE:
        return counted
    discard(counted)
    return None


def fit_final_tree(
    kind: str, design: Design, feature_set: str, options: TreeOptions = TreeOptions()
) -> PipelineModel:
    """Refit on all rows, each once."""
    terms: Sequence[Term] = design.sets[feature_set]
    return fit_tree(kind, design.units, [design.column(t) for t in terms], options)


def tree_scorer(model: PipelineModel, design_columns: Sequence[tuple[str, Term]]):
    """A function that adds the fitted tree's ``risk`` to rows with the source columns.

    ``design_columns``: the input columns the model was fitted on, with their terms.
    """

    def score(df: DataFrame) -> DataFrame:
        inputs = df.withColumns({name: term.column() for name, term in design_columns})
        scored = model.transform(inputs).withColumn("risk", F.element_at(vector_to_array("probability"), 2))
        return scored.select(*df.columns, "risk")

    return score


def design_columns(design: Design, feature_set: str) -> list[tuple[str, Term]]:
    return [(design.column(t), t) for t in design.sets[feature_set]]
