"""Toxicity: a chain of linear classifiers over the words of a whole text.

Categories are predicted one after the other; each model sees the words and the probabilities (above the
share) of the categories before it. For training those probabilities are out of fold: the sample is dealt into FOLDS parts
by a hash, and a document's probability comes from a model that never saw it, so that later models learn
from values as uncertain as they will meet. Models are logistic regressions with an L1 penalty (coordinate
steps of follow-the-leader kind), which leaves weights on a few thousand word features only.

Features of a text: its words, and the first STEMS characters of words (so unseen endings of a known stem still
count), in grades: that one distinct word has the stem, that two or three have, and that those two or more are
1% or 2% of the distinct words (a stem may be harmless alone and not in numbers). With them go shares that
tell the make of a text, not its subject: signs, capitals and digits per byte, repeated lines and repeated words, each
in grades from SHARES on. All are hashed to 2**BITS places.

The fit reads at most ``sample`` labelled documents on average (a documented bound on rows, dealt by hash of the
id and, where ids repeat, of id and text; equal rows count once); every row is scored. Defined cases: null or empty texts have no words and get the model's constant;
unlabelled, null-labelled and repeated label rows are fine (a document is positive for a category if any of
its label rows is); without labels, or with one class only, the category's share is its probability. Rows
equal in id are scored each on its own text. Other columns pass through; result names replace equal ones.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, sampled, share_of

BITS = 20
SAMPLE = 12_000
FOLDS = 3
EPOCHS = 8
PENALTY = 4.0
RATE = 1.0
STEMS = (4, 5, 6, 7)
#: A share counts as each of these grades that it reaches.
SHARES = (0.01, 0.03, 0.06, 0.1, 0.2, 0.35, 0.5)
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS, _CAPITALS, _DIGITS = b"#*$%&|<>!~^=", string.ascii_uppercase.encode(), string.digits.encode()


def word_names(word: str) -> list[int]:
    """Hashes of the word and of its stems."""
    return [xxhash.xxh3_64_intdigest(p) for p in (f"w{word}", *(f"{n}{word[:n]}" for n in STEMS if len(word) > n))]


def graded(name: int, count: int, distinct: int) -> list[int]:
    """Places of the grades that ``count`` of ``distinct`` words reach."""
    grades = [0]
    if count > 1:
        grades += [1] * (count >= 2) + [2] * (count >= 3) + [3] * (100 * count >= distinct) + [4] * (50 * count >= distinct)
    return [(name + g * 0x9E3779B97F4A7C15 >> 7) & ((1 << BITS) - 1) for g in grades]


def _grade_places() -> list[list[int]]:
    names = ("signs", "capitals", "digits", "lines", "words")
    return [[xxhash.xxh3_64_intdigest(f"share {n} {at}") >> 7 & ((1 << BITS) - 1) for at in SHARES] for n in names]


_GRADES = _grade_places()


def make_places(text: str, words: list[str]) -> list[int]:
    """Places of the shares that tell the make of a text."""
    raw = text.encode("utf-8", "surrogatepass")
    size, lines = max(len(raw), 1), [x for x in raw.split(b"\n") if x]
    shares = [(len(raw) - len(raw.translate(None, c))) / size for c in (_SIGNS, _CAPITALS, _DIGITS)]
    shares += [1 - len(set(x)) / len(x) if x else 0.0 for x in (lines, words)]
    return [p for share, places in zip(shares, _GRADES) for at, p in zip(SHARES, places) if share >= at]


def text_features(words: set[str], make: list[int]) -> list[int]:
    """Distinct places of a text."""
    counts = Counter(n for w in words for n in word_names(w))
    return sorted({p for n, c in counts.items() for p in graded(n, c, len(words))}.union(make))


@dataclass(frozen=True)
class LinearStep:
    """One category: bias, weights of hashed features, weights of earlier categories."""

    category: str
    bias: float
    places: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray


@dataclass(frozen=True)
class Chain:
    steps: tuple[LinearStep, ...]

    @property
    def categories(self) -> list[str]:
        return [s.category for s in self.steps]


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


def _fit(rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray, seed: int = 0):
    """Follow-the-regularised-leader passes over the documents: bias, dense weights, weights of ``extra``.

    The bias stays at the log-odds of the category's share and words only speak for it: otherwise the bias, or the
    words of every clean document, would sink until a single telling word no longer made up for them.
    """
    size, more = 1 << BITS, extra.shape[1]
    z, root = np.zeros(size + more), np.zeros(size + more)  # root of the summed squared gradients
    tail = np.arange(size, size + more)
    order = np.random.default_rng(seed)

    def weights(zs: np.ndarray, roots: np.ndarray, words: int) -> np.ndarray:
        """Weights of places of which the first ``words`` are words."""
        w = (np.minimum(np.maximum(zs, -PENALTY), PENALTY) - zs) / ((1.0 + roots) / RATE + 1e-3)
        np.maximum(w[:words], 0.0, out=w[:words])
        return w

    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
    base = math.log(share / (1 - share))
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            words = len(rows[i])
            places = np.concatenate([rows[i], tail]) if more else rows[i]
            zs, roots = z[places], root[places]
            w = weights(zs, roots, words)
            x = extra[i]
            error = _sigmoid(base + float(w[:words].sum()) + float(w[words:] @ x)) - y[i]
            g = np.full(len(places), error)
            g[words:] *= x
            now = np.sqrt(roots * roots + g * g)
            z[places] = zs + g - (now - roots) / RATE * w
            root[places] = now
    w = weights(z, root, size)
    return base, w[:size], w[size:]


def _predict(model, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    bias, w, we = model
    return np.array([_sigmoid(bias + w[r].sum() + float(we @ e)) for r, e in zip(rows, extra)])


def fit_chain(rows: list[np.ndarray], labels: dict[str, np.ndarray], folds: np.ndarray) -> Chain:
    """``rows``: distinct feature places of each document; ``folds``: its fold number."""
    extra = np.zeros((len(rows), 0))
    steps = []
    for category, y in labels.items():
        if not len(y) or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.0
            share = min(max(share, 1e-6), 1 - 1e-6)
            none = np.zeros(0)
            steps.append(LinearStep(category, math.log(share / (1 - share)), none.astype(np.int64), none, np.zeros(extra.shape[1])))
            extra = np.column_stack([extra, np.zeros(len(rows))])
            continue
        bias, w, we = _fit(rows, extra, y)
        places = np.flatnonzero(w)
        steps.append(LinearStep(category, bias, places, w[places], we))
        unseen = np.zeros(len(rows))
        for fold in range(FOLDS):
            train, test = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            if len(train) and len(test):
                model = _fit([rows[i] for i in train], extra[train], y[train])
                unseen[test] = _predict(model, [rows[i] for i in test], extra[test])
        extra = np.column_stack([extra, unseen - y.mean()])
    return Chain(tuple(steps))


def _words(batch: pa.RecordBatch, column: str) -> Iterator[tuple[set[str], list[int]]]:
    """Distinct words and make of each text."""
    texts = batch.column(column)
    for text, low in zip(texts.to_pylist(), pc.utf8_lower(texts).to_pylist()):
        words = _WORD.findall(low) if low else []
        yield set(words), make_places(text, words) if text else []


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    sample: int = SAMPLE,
) -> Chain:
    """Fit the chain on about ``sample`` labelled documents; ``labels`` has 0/1 columns named as ``categories``."""
    wanted = [F.max(F.col(c).cast("int")).alias(f"__y{i}") for i, c in enumerate(categories)]
    known = labels.filter(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("__id")).agg(*wanted)
    known = known.dropna()
    side = sampled(known, share_of(sample, known.count()), ["__id"]).drop("__deal")
    # The sample is bounded by its parameter; it is the side that travels.
    pairs = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text")).join(
        F.broadcast(side), "__id"
    )
    # A second deal for ids that many rows share; this count reads ids only.
    pairs = sampled(pairs, share_of(sample, pairs.count()), ["__id", "__text"])
    pairs = pairs.withColumn("__fold", F.pmod(F.xxhash64(F.lit("fold"), "__deal"), F.lit(FOLDS)))
    names = [f"__y{i}" for i in range(len(categories))]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(words, make) for words, make in _words(batch, "__text")]
            arrays = [pa.array(rows, pa.list_(pa.int32())), batch.column("__fold"), batch.column("__deal")]
            arrays += [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names=["places", "fold", "deal", *names])

    schema = "places array<int>, fold bigint, deal bigint, " + ", ".join(f"{n} int" for n in names)
    table = map_arrow(pairs, places, schema).toArrow().sort_by([("deal", "ascending")])
    offsets = table.column("places").combine_chunks()
    flat, cuts = offsets.flatten().to_numpy(), offsets.offsets.to_numpy()
    rows = [flat[a:b] for a, b in zip(cuts[:-1] - cuts[0], cuts[1:] - cuts[0])]
    y = {c: table.column(n).to_numpy().astype(float) for c, n in zip(categories, names)}
    return fit_chain(rows, y, table.column("fold").to_numpy())


def score(docs: DataFrame, model: Chain, text_column: str = "text") -> DataFrame:
    """All rows and columns, plus ``p_<category>`` for each category of the chain."""
    results = [f"p_{c}" for c in model.categories]
    base = docs.drop(*results)
    names = base.columns
    # The weights are sparse: at most a few thousand places, whatever the corpus.
    tables = [dict(zip(s.places.tolist(), s.weights.tolist())) for s in model.steps]
    biases, earlier = [s.bias for s in model.steps], [s.earlier.tolist() for s in model.steps]
    shares = [_sigmoid(b) for b in biases]
    steps = range(len(tables))

    weighted = set().union(*tables)

    class Seen(dict):
        """Word to its names with a weight at any grade; most words have none."""

        def __missing__(self, word: str):
            value = tuple(n for n in word_names(word) if not weighted.isdisjoint(graded(n, 1 << 30, 1)))
            self[word] = value
            return value

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for batch in batches:
            if len(seen) > 500_000:
                seen.clear()
            out: list[list[float]] = [[] for _ in steps]
            for words, make in _words(batch, text_column):
                counts = Counter(chain.from_iterable(filter(None, map(seen.__getitem__, words))))
                hit = {p for n, c in counts.items() for p in graded(n, c, len(words))}.union(make)
                before: list[float] = []  # probabilities above the share, as in training
                found: list[float] = []
                for k in steps:
                    table = tables[k]
                    value = biases[k] + math.fsum(table.get(p, 0.0) for p in hit)
                    found.append(_sigmoid(value + math.fsum(a * b for a, b in zip(earlier[k], before))))
                    before.append(found[k] - shares[k])
                for k in steps:
                    out[k].append(found[k])
            arrays = [*batch.columns, *(pa.array(x, pa.float64()) for x in out)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *results])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return map_arrow(base, scored, fields + "".join(f", `{r}` double" for r in results))
