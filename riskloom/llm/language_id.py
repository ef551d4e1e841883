"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are folded to lower case and everything but letters to blanks; n-grams of ORDERS characters are hashed
to 2**BITS places. Term frequencies count as 1 + ln(tf), weighted by the inverse document frequency over all documents that may
be learned from, and scaled to length one. The model is trained by follow-the-regularised-leader with an
elastic-net penalty (most weights stay exactly zero), and its scores are then calibrated by one temperature,
fitted on the part of the sample that the training did not see, against smoothed targets: a part without any error
would otherwise ask for a temperature of zero and scores of one.

The fit reads about ``sample`` documents, dealt evenly over the languages by a hash of id, text and language (a documented
bound on rows, equal rows counting once); document frequencies and predictions cover all rows and whole texts, long ones in portions. Language,
source and id never enter a prediction.

Defined cases: null texts and texts without a letter get ``und`` and score 0, as does everything if nothing can be
learned; documents with a null id or language are predicted but not learned from; repeated rows are
predicted alike; of equal probabilities the language first in order wins; an empty table gives an empty table. Only id, text and language are read.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, sampled, share_of

ORDERS = (1, 2, 3)
BITS = 15
SAMPLE = 4_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
#: One in this many sample documents calibrates instead of training.
CALIBRATE = 5
#: Range in which the temperature is looked for; a warning says if the best one lies at its end.
TEMPERATURES = (0.05, 20.0)
#: Characters handled at a time.
PORTION = 200_000
UNDETERMINED = "und"

_FOLD = np.arange(128, dtype=np.uint64)
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the whole text."""
    counts = np.zeros(1 << BITS, np.int64)
    widest = max(ORDERS)
    low = text.lower()
    for at in range(0, len(low), PORTION):
        portion = low[at : at + PORTION + widest - 1]  # n-grams that start in this portion
        code = np.frombuffer(portion.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        plain = code < 128
        code[plain] = _FOLD[code[plain]]
        value = np.zeros(len(code), np.uint64)
        last = len(code) if at + PORTION >= len(low) else PORTION
        for n in range(1, widest + 1):
            m = len(code) - n + 1
            if m <= 0:
                break
            value = (value[:m] * _STEP) ^ (code[n - 1 :] + np.uint64(n << 40))
            value ^= value >> np.uint64(29)
            if n in ORDERS:
                hashed = (value[: min(m, last)] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)
                counts += np.bincount(hashed.astype(np.int64), minlength=1 << BITS)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        places = np.flatnonzero(counts)
        return _softmax((_vector(counts[places], self.idf[places]) @ self.weights[places] + self.bias) / self.temperature)


def _vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(counts)) * idf
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Follow-the-regularised-leader: weights and bias from (places, values) rows."""
    size = (1 << BITS) + 1
    z, n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(places) -> np.ndarray:
        zp, np_ = z[places], n[places]
        w = -(zp - np.sign(zp) * L1) / ((BETA + np.sqrt(np_)) / ALPHA + L2)
        return np.where(np.abs(zp) <= L1, 0.0, w)

    order = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            places, values = rows[i]
            places, values = np.append(places, size - 1), np.append(values, 1.0)
            w = weights(places)
            off = _softmax(values @ w)
            off[labels[i]] -= 1
            g = values[:, None] * off
            root = np.sqrt(n[places])
            z[places] += g - (np.sqrt(n[places] + g * g) - root) / ALPHA * w
            n[places] += g * g
    w = weights(slice(None))
    return w[:-1], w[-1]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm.

    Targets are smoothed: of a language with n texts the right one counts (n + 1) / (n + 2), the others share the rest.
    """
    classes = scores.shape[1] if len(labels) else 0
    if classes < 2:
        return 1.0
    n = np.bincount(labels, minlength=classes)[labels]
    targets = np.repeat((1 / (n + 2) / (classes - 1))[:, None], classes, axis=1)
    targets[np.arange(len(labels)), labels] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        p = _softmax(scores / math.exp(t))
        return float(-(targets * np.log(np.maximum(p, 1e-300))).sum(axis=1).mean())

    ends = [math.log(t) for t in TEMPERATURES]
    (lo, hi), ratio = ends, (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        if loss(a) <= loss(b):
            hi = b
        else:
            lo = a
    if min(lo - ends[0], ends[1] - hi) < 1e-6:
        warnings.warn(f"the best temperature lies at an end of {TEMPERATURES}", stacklevel=2)
    return math.exp((lo + hi) / 2)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of non-null texts and, per place, how many hold it: summed over tasks, 2**BITS rows in the end."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << BITS, np.int64)
        n = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text is not None:
                    held += ngram_counts(text) > 0
                    n += 1
        places = np.flatnonzero(held)
        # Place -1 counts the documents.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(places, -1)), pa.array(np.append(held[places], n))], names=["place", "n"]
        )

    table = map_arrow(docs.select("text"), count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << BITS)
    known = table[table["place"] >= 0]
    df[known["place"].to_numpy()] = known["n"].to_numpy()
    return int(table.loc[table["place"] < 0, "n"].sum()), df


def train(docs: DataFrame, sample: int = SAMPLE) -> LanguageModel | None:
    """Fit on rows (doc_id, text, lang); None if there is nothing to learn from."""
    docs = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    shares = docs.groupBy("lang").count().orderBy("lang").collect()  # one row per language
    if not shares:
        return None
    languages = [r["lang"] for r in shares]
    n, df = document_frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    docs = docs.select("doc_id", "text", "lang")
    part = F.create_map(*[F.lit(x) for r in shares for x in (r["lang"], share_of(sample // len(shares), r["count"]))])
    picked = sampled(docs, part[F.col("lang")], docs.columns).select(
        "text", "lang", "__deal", F.pmod(F.xxhash64(F.lit("part"), "__deal"), F.lit(CALIBRATE)).alias("part")
    )

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [ngram_counts(t) for t in batch.column("text").to_pylist()]
            places = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p.astype(np.int32) for p in places], pa.list_(pa.int32())),
                    pa.array([c[p].astype(np.int32) for c, p in zip(counts, places)], pa.list_(pa.int32())),
                    batch.column("lang"),
                    batch.column("__deal"),
                    batch.column("part"),
                ],
                names=["places", "counts", "lang", "deal", "part"],
            )

    table = map_arrow(picked, sparse, "places array<int>, counts array<int>, lang string, deal bigint, part bigint").toArrow()
    table = table.sort_by([("deal", "ascending"), ("lang", "ascending")])
    number = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([number[x] for x in table.column("lang").to_pylist()], np.int64)
    rows = []
    for chunk_p, chunk_c in zip(table.column("places").chunks, table.column("counts").chunks):
        for p, c in zip(chunk_p, chunk_c):
            p, c = p.values.to_numpy().astype(np.int64), c.values.to_numpy()
            rows.append((p, _vector(c, idf[p])))
    hold = table.column("part").to_numpy() == 0
    seen = np.flatnonzero(~hold)
    if not len(seen):
        seen = np.arange(len(rows))
    weights, bias = fit([rows[i] for i in seen], labels[seen], len(languages))
    scores = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in np.flatnonzero(hold)]).reshape(-1, len(languages))
    return LanguageModel(tuple(languages), idf, weights, bias, temperature(scores, labels[hold]))


def predict(docs: DataFrame, model: LanguageModel | None, keep: list[Column] | None = None) -> DataFrame:
    """Columns ``keep`` (default doc_id), ``lang_pred`` and ``score`` of every row."""
    base = docs.select(*(keep or [F.col("doc_id")]), F.col("text").alias("__text"))
    names = base.columns[:-1]
    # 2**BITS weights per language: bounded by the languages, not by documents.
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("__text").to_pylist():
                if model is None or not text or not any(map(str.isalpha, text)):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = model.probabilities(ngram_counts(text))
                best = int(p.argmax())
                langs.append(model.languages[best])
                scores.append(float(p[best]))
            columns = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    return map_arrow(base, score, f"{fields}, lang_pred string, score double")
