"""L2 logistic regression for all folds and feature sets at once.

A Newton step needs, for each problem (feature set x repetition x left-out fold),
the loss, gradient and Hessian summed over its training rows. One pass over the
data yields them for every problem: each task reduces its rows to one sum per
problem and slot, and a grouped sum, spread over all problems and slots, finishes
the job. Only those sums, about a hundred numbers per problem, reach the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.columns import sigmoid
from riskloom.operators.design import Term
from riskloom.operators.folds import by_repetition, gathered_folds
from riskloom.roles import DEFAULT_ROLES, Roles
from riskloom.session import stage

# Executors get the task function by value: they need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_STEPS = 100
ALL_FOLDS = -1  # a problem that leaves no fold out
INTERCEPT = "(intercept)"
LOGISTIC, BASELINE = "logistic", "baseline"


@dataclass(frozen=True)
class LinearModel:
    """Coefficients on the standardised scale, with the centres and scales behind it."""

    feature_set: str
    terms: tuple[Term, ...]
    coefficients: tuple[float, ...]
    centres: tuple[float, ...]
    scales: tuple[float, ...]
    intercept: float
    repetition: int = 0
    fold: int = ALL_FOLDS

    def slopes(self) -> list[float]:
        """Coefficients per unit of each term's raw value."""
        return [b / s for b, s in zip(self.coefficients, self.scales)]

    def offset(self) -> float:
        """Log-odds when every raw term is zero."""
        shift = sum(b * c / s for b, c, s in zip(self.coefficients, self.centres, self.scales))
        return self.intercept - shift

    def contribution_columns(self) -> dict[str, Column]:
        """Standardised value times coefficient, per term."""
        return {
            t.name: (t.column() - F.lit(c)) / F.lit(s) * F.lit(b)
            for t, b, c, s in zip(self.terms, self.coefficients, self.centres, self.scales)
        }

    def log_odds(self) -> Column:
        total = F.lit(self.intercept)
        for value in self.contribution_columns().values():
            total = total + value
        return total

    def probability(self) -> Column:
        return sigmoid(self.log_odds())


MODEL_SCHEMA = (
    "feature_set string, repetition int, fold int, position int, term string, source string, "
    "kind string, level string, coefficient double, centre double, scale double"
)


def model_table(spark: SparkSession, models: Sequence[LinearModel]) -> DataFrame:
    """Models as rows: the intercept at position 0, then one row per term."""
    rows = []
    for m in models:
        head = (m.feature_set, m.repetition, m.fold)
        rows.append((*head, 0, INTERCEPT, None, None, None, m.intercept, None, None))
        rows += [
            (*head, i, t.name, t.source, t.kind, t.level, b, c, s)
            for i, (t, b, c, s) in enumerate(
                zip(m.terms, m.coefficients, m.centres, m.scales), start=1
            )
        ]
    return spark.createDataFrame(rows, MODEL_SCHEMA)


def read_models(table: DataFrame) -> list[LinearModel]:
    """Inverse of ``model_table``; a model table has a handful of rows per fold."""
    grouped: dict[tuple, list] = {}
    for r in table.orderBy("feature_set", "repetition", "fold", "position").collect():
        grouped.setdefault((r["feature_set"], r["repetition"], r["fold"]), []).append(r)
    return [
        LinearModel(
            feature_set,
            tuple(Term(r["term"], r["source"], r["kind"], r["level"]) for r in rows[1:]),
            tuple(r["coefficient"] for r in rows[1:]),
            tuple(r["centre"] for r in rows[1:]),
            tuple(r["scale"] for r in rows[1:]),
            rows[0]["coefficient"],
            repetition,
            fold,
        )
        for (feature_set, repetition, fold), rows in grouped.items()
    ]


# --------------------------------------------------------------------------- training data


@dataclass(frozen=True)
class Design:
    """Model inputs: one column per distinct term.

    ``units`` is staged, one row per unit: unit_id, y, folds (one fold per repetition) and the terms. ``table`` is the
    same with a row per repetition and fold, spread out while it is read.
    """

    table: DataFrame
    terms: tuple[Term, ...]
    sets: dict[str, tuple[Term, ...]]
    units: DataFrame

    def column(self, term: Term) -> str:
        return f"x{self.terms.index(term)}"


def build_design(
    folds: DataFrame, sets: dict[str, Sequence[Term]], roles: Roles = DEFAULT_ROLES
) -> Design:
    """Evaluate all terms of all sets once and write one row per unit; passes then read only numbers.

    ``folds`` has the fold vectors of ``fold_vectors``, or the rows of ``assign_folds``, which are gathered.
    """
    terms = tuple(dict.fromkeys(t for chosen in sets.values() for t in chosen))
    columns = [t.column().alias(f"x{i}") for i, t in enumerate(terms)]
    unit = [F.col(roles.unit_id).alias("unit_id"), "y", *columns]
    names = ["unit_id", "y", *[f"x{i}" for i in range(len(terms))]]
    if "folds" in folds.columns:
        units = folds.select(*unit, "folds")
    else:
        units = gathered_folds(folds.select(*unit, "repetition", "fold"), names)
    units = stage(units.select("unit_id", "folds", *names[1:]))
    return Design(by_repetition(units), terms, {k: tuple(v) for k, v in sets.items()}, units)


@dataclass
class Moments:
    """Count, positives, means and population variances of the terms on some rows."""

    n: float
    positives: float
    mean: np.ndarray
    variance: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        gap = other.mean - self.mean
        share = other.n / n if n else 0.0
        spread = (self.n * self.variance + other.n * other.variance) / n if n else self.variance
        return Moments(
            n,
            self.positives + other.positives,
            self.mean + gap * share,
            spread + gap * gap * share * (1.0 - share),
        )


def fold_moments(design: Design) -> dict[tuple[int, int], Moments]:
    """Moments of every (repetition, fold): one aggregate, folds x repetitions rows."""
    width = len(design.terms)
    aggregated = design.table.groupBy("repetition", "fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("y").alias("pos"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(width)],
        *[F.var_pop(f"x{i}").alias(f"v{i}") for i in range(width)],
    )
    return {
        (r["repetition"], r["fold"]): Moments(
            float(r["n"]),
            float(r["pos"]),
            np.array([r[f"m{i}"] for i in range(width)], dtype=float),
            np.array([r[f"v{i}"] for i in range(width)], dtype=float),
        )
        for r in aggregated.collect()
    }


def training_moments(
    moments: dict[tuple[int, int], Moments], repetition: int, fold: int
) -> Moments:
    """Moments of a repetition's rows outside ``fold``."""
    parts = [m for (r, f), m in sorted(moments.items()) if r == repetition and f != fold]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


# --------------------------------------------------------------------------- solver


@dataclass
class Problem:
    feature_set: str
    repetition: int
    fold: int
    columns: list[int]
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    previous: np.ndarray | None = None
    loss: float = np.inf
    gradient: float = np.inf
    done: bool = False
    halvings: int = field(default=0)


def _to_shared(shared: Problem, problem: Problem) -> np.ndarray:
    """Matrix that takes a problem's weights to those with the same log-odds on the standardised terms of another."""
    size = len(problem.columns) + 1
    matrix = np.zeros((size, size))
    matrix[0, 0] = 1.0
    matrix[0, 1:] = (shared.centre - problem.centre) / problem.scale
    matrix[np.arange(1, size), np.arange(1, size)] = shared.scale / problem.scale
    return matrix


def _own_sums(matrix: np.ndarray, loss: float, gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """Loss, gradient and upper Hessian triangle in a problem's own weights, from those in shared ones."""
    triangle = np.triu_indices(len(gradient))
    whole = np.zeros((len(gradient), len(gradient)))
    whole[triangle] = hessian
    whole = whole + np.triu(whole, 1).T
    return np.concatenate(([loss], matrix.T @ gradient, (matrix.T @ whole @ matrix)[triangle]))


def _partial_sums(
    batches: Iterator[pa.RecordBatch], problems: list[tuple[int, Problem]], width: int, slots: int
) -> Iterator[pa.RecordBatch]:
    """Sums of loss, gradient and upper Hessian triangle over this task's rows.

    Problems with the same terms share one standardised matrix, that of the first of them: log-odds and gradients of
    all of them are one product each, and a problem's own centres and scales are brought in by ``_own_sums`` at the end.
    """
    sets: dict[tuple[int, ...], list[tuple[int, Problem]]] = {}
    for index, problem in problems:
        sets.setdefault(tuple(problem.columns), []).append((index, problem))
    totals = []
    for columns, members in sets.items():
        maps = [_to_shared(members[0][1], problem) for _, problem in members]
        weights = np.stack([m @ problem.weights for m, (_, problem) in zip(maps, members)], axis=1)
        size = len(columns) + 1
        loss, gradient = np.zeros(len(members)), np.zeros((size, len(members)))
        # Products of terms, upper triangle, by problem.
        hessian = np.zeros((size * (size + 1) // 2, len(members)))
        totals.append((list(columns), members, maps, weights, loss, gradient, hessian))
    for batch in batches:
        n = batch.num_rows
        values = np.empty((n, width))
        for i in range(width):
            values[:, i] = batch.column(f"x{i}").to_numpy(zero_copy_only=False)
        outcome = batch.column("y").to_numpy().astype(float)
        folds = batch.column("folds").flatten().to_numpy().reshape(n, -1)
        for columns, members, _, weights, loss, gradient, hessian in totals:
            z = np.empty((n, len(columns) + 1))
            z[:, 0] = 1.0
            z[:, 1:] = (values[:, columns] - members[0][1].centre) / members[0][1].scale
            eta = z @ weights
            tail = np.exp(-np.abs(eta))
            p = np.where(eta >= 0, 1.0, tail) / (1.0 + tail)
            # A problem that leaves no fold out takes every row.
            taken = np.stack([folds[:, problem.repetition] != problem.fold for _, problem in members], axis=1)
            loss += np.where(taken, np.log1p(tail) + np.maximum(eta, 0.0) - outcome[:, None] * eta, 0.0).sum(axis=0)
            gradient += z.T @ np.where(taken, p - outcome[:, None], 0.0)
            above, right = np.triu_indices(z.shape[1])
            terms = np.ascontiguousarray(z.T)
            hessian += (terms[above] * terms[right]) @ np.where(taken, p * (1.0 - p), 0.0)
    sums = {index: np.zeros(slots) for index, _ in problems}
    for _, members, maps, _, loss, gradient, hessian in totals:
        for j, (index, _) in enumerate(members):
            flat = _own_sums(maps[j], loss[j], gradient[:, j], hessian[:, j])
            sums[index][: len(flat)] = flat
    indices = np.fromiter(sums, dtype=np.int32)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(indices, slots)),
            pa.array(np.tile(np.arange(slots, dtype=np.int32), len(indices))),
            pa.array(np.concatenate(list(sums.values()))),
        ],
        names=["problem", "slot", "value"],
    )


def _evaluate(design: Design, open_problems: list[tuple[int, Problem]]) -> dict[int, np.ndarray]:
    """One pass over the data for all open problems."""
    width = len(design.terms)
    size = max(len(p.columns) for _, p in open_problems) + 1
    slots = 1 + size + size * (size + 1) // 2
    summed = (
        design.units.drop("unit_id").mapInArrow(
            lambda it: _partial_sums(it, open_problems, width, slots),
            "problem int, slot int, value double",
        )
        .groupBy("problem", "slot")
        .agg(F.sum("value").alias("value"))
        .toPandas()  # problems x slots numbers
    )
    totals = {index: np.zeros(slots) for index, _ in open_problems}
    for index, part in summed.groupby("problem"):
        totals[index][part["slot"].to_numpy()] = part["value"].to_numpy()
    return totals


def _advance(problem: Problem, sums: np.ndarray) -> None:
    """Newton step with the penalty added; a step that did not help is halved."""
    size = len(problem.columns) + 1
    penalty = problem.weights.copy()
    penalty[0] = 0.0
    loss = sums[0] + 0.5 * float(penalty @ penalty)
    gradient = sums[1 : 1 + size] + penalty
    problem.gradient = float(np.max(np.abs(gradient)))
    if loss > problem.loss + 1e-9 * max(1.0, abs(problem.loss)) and problem.halvings < 30:
        problem.weights = 0.5 * (problem.weights + problem.previous)
        problem.halvings += 1
        return
    hessian = np.zeros((size, size))
    hessian[np.triu_indices(size)] = sums[1 + size : 1 + size + size * (size + 1) // 2]
    hessian = hessian + np.triu(hessian, 1).T + np.diag([0.0] + [1.0] * (size - 1))
    step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
    problem.loss, problem.halvings = loss, 0
    if float(gradient @ step) < 1e-18 * max(1.0, abs(loss)) or np.max(np.abs(step)) < 1e-10:
        problem.done = True
        return
    problem.previous, problem.weights = problem.weights, problem.weights - step


def _solve(design: Design, problems: list[Problem]) -> list[Problem]:
    for _ in range(MAX_STEPS):
        open_problems = [(i, p) for i, p in enumerate(problems) if not p.done]
        if not open_problems:
            return problems
        for index, sums in _evaluate(design, open_problems).items():
            _advance(problems[index], sums)
    raise RuntimeError("logistic regression did not converge")


def _problem(
    design: Design, feature_set: str, repetition: int, fold: int, moments: Moments, start: np.ndarray | None
) -> Problem:
    chosen = design.sets[feature_set]
    columns = [design.terms.index(t) for t in chosen]
    scaled = np.array([t.scaled for t in chosen], dtype=bool)
    spread = np.sqrt(moments.variance[columns])
    centre = np.where(scaled, moments.mean[columns], 0.0)
    scale = np.where(scaled & (spread > 0), spread, 1.0)
    weights = np.zeros(len(columns) + 1) if start is None else start.copy()
    return Problem(feature_set, repetition, fold, columns, centre, scale, weights)


def _as_model(design: Design, problem: Problem) -> LinearModel:
    return LinearModel(
        problem.feature_set,
        design.sets[problem.feature_set],
        tuple(float(w) for w in problem.weights[1:]),
        tuple(float(c) for c in problem.centre),
        tuple(float(s) for s in problem.scale),
        float(problem.weights[0]),
        problem.repetition,
        problem.fold,
    )


def fit_all_rows(design: Design, moments: dict | None = None) -> dict[str, LinearModel]:
    """One model per feature set on all rows."""
    moments = moments or fold_moments(design)
    problems = [
        _problem(design, s, 0, ALL_FOLDS, training_moments(moments, 0, ALL_FOLDS), None)
        for s in design.sets
    ]
    return {p.feature_set: _as_model(design, p) for p in _solve(design, problems)}


def fit_folds(
    design: Design, full: dict[str, LinearModel] | None = None, moments: dict | None = None
) -> list[LinearModel]:
    """One model per feature set, repetition and left-out fold.

    Folds start from the all-rows solution, so two or three passes settle them.
    """
    moments = moments or fold_moments(design)
    full = full or fit_all_rows(design, moments)
    problems = []
    for feature_set, model in full.items():
        start = np.array([model.intercept, *model.coefficients])
        for repetition, fold in sorted(moments):
            inside = training_moments(moments, repetition, fold)
            problems.append(_problem(design, feature_set, repetition, fold, inside, start))
    return [_as_model(design, p) for p in _solve(design, problems)]


# --------------------------------------------------------------------------- predictions


def fold_parameters(design: Design, models: Sequence[LinearModel]) -> DataFrame:
    """One row per feature set, repetition and fold: offset and a slope for every term."""
    rows = []
    for m in models:
        slopes = dict(zip(m.terms, m.slopes()))
        rows.append(
            (m.feature_set, m.repetition, m.fold, m.offset(), [slopes.get(t, 0.0) for t in design.terms])
        )
    schema = "feature_set string, repetition int, fold int, b0 double, b array<double>"
    return design.table.sparkSession.createDataFrame(rows, schema)


def out_of_fold(design: Design, models: Sequence[LinearModel]) -> DataFrame:
    """Every row scored by the models that did not see its fold."""
    # The parameter table has one row per model: always small enough to broadcast.
    parameters = F.broadcast(fold_parameters(design, models))
    eta = F.col("b0")
    for i in range(len(design.terms)):
        eta = eta + F.element_at("b", i + 1) * F.col(f"x{i}")
    return design.table.join(parameters, ["repetition", "fold"]).select(
        F.lit(LOGISTIC).alias("model"),
        "feature_set",
        "repetition",
        "fold",
        "unit_id",
        "y",
        sigmoid(eta).alias("p"),
    )


def baseline_predictions(design: Design, moments: dict | None = None) -> DataFrame:
    """Majority class of the training rows, as probability 0 or 1; ties go to 0."""
    moments = moments or fold_moments(design)
    rows = []
    for repetition, fold in sorted(moments):
        inside = training_moments(moments, repetition, fold)
        rows.append((repetition, fold, 1.0 if 2 * inside.positives > inside.n else 0.0))
    constants = design.table.sparkSession.createDataFrame(
        rows, "repetition int, fold int, p double"
    )
    sets = F.explode(F.array(*[F.lit(s) for s in design.sets])).alias("feature_set")
    return (
        design.table.select("repetition", "fold", "unit_id", "y")
        .join(F.broadcast(constants), ["repetition", "fold"])
        .select(F.lit(BASELINE).alias("model"), sets, "repetition", "fold", "unit_id", "y", "p")
    )
