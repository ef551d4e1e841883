"""Quality rules: thresholds per language and source from mergeable quantile sketches.

Every text gives a few ratios. Their distribution in each (lang, source) group is kept as a logarithmic
histogram sketch: a value falls into the bucket ``ceil(log(v) / log(GAMMA))``, which fixes it to about 1%, and
a sketch is nothing but counts per bucket. Sketches merge by adding counts, in any order, so they are plain
partial aggregations and a group holding most rows costs one row per bucket and task. A group's sketch is
shrunk towards its language and the whole table: thresholds are read from the weighted sum of the group's own
shares, its language's and the table's, with PRIOR rows for each of the latter two. So a small group does not
set its own rules, and no switch decides when it may.

Thresholds are fences: from the quartiles, FENCE interquartile ranges outwards. Ratios that are nearly always
zero have no such range; there the fence lies EVENTS events away, counted in a text of the group's median size,
which is read from sketches of the denominators. So either width comes from the merged sketches, and no rule has
a cutoff of its own. A fence is never nearer than the sketch can tell values apart. The thresholds then join
the rows.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined cases: null or empty texts have no words, all ratios zero, and
fail the base rule; a null lang or source is a group of its own; repeated rows count as often as they appear;
an empty table gives an empty table. Other columns pass through; result names replace equal ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import BROADCAST_ROWS, map_arrow, sized, stage

GAMMA = 1.02
#: Values below this count as zero (bucket null).
LEAST = 1e-6
FENCE = 5.0
EVENTS = 4
PRIOR = 200
#: Stands for the null bucket where buckets are put in order; below ``log(LEAST) / log(GAMMA)``.
ZERO = -1000
#: Rows of cumulated language sketches, an array each, up to which they are sent to all executors.
SKETCH_ROWS = 500
SHINGLE = 8
MIN_WORDS = 20
MAX_REPEATED = 30
SALTS = 32
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A ratio, what one event adds to its top, and which sides are fenced."""

    name: str
    top: str
    bottom: str
    event: int = 1
    low: bool = False
    high: bool = True


RULES = (
    Rule("word_length", "word_chars", "n_words", low=True),
    Rule("symbol_ratio", "n_symbols", "n_words"),
    Rule("dup_line_ratio", "n_dup_lines", "n_lines"),
    Rule("repeat_ratio", "n_repeat_words", "n_words", event=2 * SHINGLE),
    Rule("same_word_ratio", "n_same_words", "n_words"),
    Rule("upper_ratio", "n_upper", "word_chars"),
)
#: Denominators, whose sketches give the size of a text.
SIZES = tuple(dict.fromkeys(r.bottom for r in RULES))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_same_words", "n_upper")

_CLASS = np.zeros(256, np.uint8)
_CLASS[list(b"\x20\t\n\x0b\x0c\r")] = 1  # between words
_CLASS[0x80:0xC0] = 2  # continues a character
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True


def repeated_words(ids: np.ndarray, width: int = SHINGLE) -> int:
    """Words inside windows of ``width`` words that occur at least twice (``width`` is a power of two)."""
    if len(ids) <= width:
        return 0
    names, step = ids.astype(np.int64), 1
    while step < width:  # names of double length from pairs of names
        pairs = names[:-step] * (len(ids) + 1) + names[step:]
        names = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        step *= 2
    often = np.bincount(names)[names] > 1
    if not often.any():
        return 0
    change = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(often)
    change[starts] += 1
    change[starts + width] -= 1
    return int((np.cumsum(change[:-1]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The COUNTS of one text."""
    words = text.split() if text else []
    if not words:
        return (0,) * len(COUNTS)
    raw = np.frombuffer(text, np.uint8)
    chars = int((_CLASS[raw] == 0).sum())
    seen: set[bytes] = set()
    dup = lines = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    table: dict[bytes, int] = {}
    ids = np.fromiter((table.setdefault(w, len(table)) for w in words), np.int64, len(words))
    same = int((ids[1:] == ids[:-1]).sum())
    return (len(words), chars, int(_IS_SYMBOL[raw].sum()), dup, repeated_words(ids), lines, same, int(_IS_UPPER[raw].sum()))


def features(docs: DataFrame, keep: list[str], text_column: str = "text") -> DataFrame:
    """Columns ``keep`` and the COUNTS of every row."""
    base = docs.select(*keep, F.col(text_column).alias("__text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t) for t in batch.column("__text").cast(pa.binary()).to_pylist()]
            grid = np.array(rows, np.int64).reshape(len(rows), len(COUNTS))
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(grid[:, k]) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *COUNTS])

    fields = ", ".join(f"`{n}` {base.schema[n].dataType.simpleString()}" for n in keep)
    return map_arrow(base, counted, fields + "".join(f", {c} bigint" for c in COUNTS))


def ratio(rule: Rule) -> Column:
    return F.when(F.col(rule.bottom) > 0, F.col(rule.top) / F.col(rule.bottom)).otherwise(0.0)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def sketches(counts: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, rule, bucket, n): mergeable by adding ``n``. Texts without words are left out.

    ``rule`` names a ratio or a denominator.
    """
    values = [(r.name, ratio(r)) for r in RULES] + [(c, F.col(c).cast("double")) for c in SIZES]
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), v.alias("v")) for name, v in values])
    long = counts.filter("n_words > 0").select(
        F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(pairs).alias("x")
    )
    bucket = F.when(F.col("x.v") >= LEAST, F.ceil(F.log("x.v") / math.log(GAMMA)).cast("int"))
    return (
        long.select("lang", "source", "x.rule", bucket.alias("bucket"))
        .groupBy("lang", "source", "rule", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _background(cells: DataFrame) -> DataFrame:
    """(lang, rule, bucket, w): language and table sketches as one cumulated weight, PRIOR rows each.

    One row per language, rule and bucket of the table, however many sources a language has. The sums are whole
    numbers until the end, so that no order of adding shows.
    """
    by_lang = stage(cells.groupBy("lang", "rule", "bucket").agg(F.sum("n").alias("n")))
    overall = by_lang.groupBy("rule", "bucket").agg(F.sum("n").alias("n_all"))
    langs = by_lang.groupBy("lang", "rule").agg(F.sum("n").alias("t")).alias("g")
    grid = langs.join(overall, "rule").select("lang", "rule", "t", "bucket", "n_all")
    found = grid.alias("x").join(
        by_lang.alias("y"),
        F.col("x.lang").eqNullSafe(F.col("y.lang"))
        & (F.col("x.rule") == F.col("y.rule"))
        & (F.col("x.bucket") == F.col("y.bucket")),
        "left",
    )
    found = found.select("x.*", F.coalesce("y.n", F.lit(0)).alias("n"))
    whole = Window.partitionBy("lang", "rule")
    ordered = whole.orderBy("bucket")
    share = F.sum("n").over(ordered) / F.col("t") + F.sum("n_all").over(ordered) / F.sum("n_all").over(whole)
    return found.select("lang", "rule", "bucket", (PRIOR * share).alias("w"))


def quartiles(sketch: DataFrame) -> DataFrame:
    """(lang, source, rule, q1, q2, q3) of the merged sketch of every group.

    Only a group's own buckets meet the background's weight there. A quartile lies at an own bucket or between
    two; in the second case the background alone rises, and one search of its array finds the place.
    """
    cells = sketch.withColumn("bucket", F.coalesce("bucket", F.lit(ZERO)))
    cells = cells.groupBy("lang", "source", "rule", "bucket").agg(F.sum("n").alias("n"))
    background = stage(_background(cells))
    own = cells.alias("x").join(
        background.alias("y"),
        F.col("x.lang").eqNullSafe(F.col("y.lang"))
        & (F.col("x.rule") == F.col("y.rule"))
        & (F.col("x.bucket") == F.col("y.bucket")),
    )
    own = own.select("x.*", F.col("y.w").alias("w"))
    key = ["lang", "source", "rule"]
    whole = Window.partitionBy(*key)
    own = own.withColumns({"to": F.sum("n").over(whole.orderBy("bucket")), "all": F.sum("n").over(whole)})
    shares = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    picks = []
    for name, q in shares.items():
        # Shares are compared with a margin far above rounding and far below one row.
        need = q * (F.col("all") + 2 * PRIOR) * (1 - 1e-9)
        reached = F.col("to") + F.col("w") >= need
        picks += [
            F.min(F.when(reached, F.col("bucket"))).alias(f"{name}_at"),
            (F.first(need) - F.coalesce(F.min(F.when(reached, F.col("to") - F.col("n"))), F.first("all"))).alias(
                f"{name}_rest"
            ),
        ]
    groups = own.groupBy(*key).agg(*picks)
    curves = background.groupBy(F.col("lang").alias("__l"), F.col("rule").alias("__r")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "w"))).alias("__curve")
    )
    curves = sized(stage(curves), SKETCH_ROWS)
    joined = groups.join(curves, F.col("lang").eqNullSafe(F.col("__l")) & (F.col("rule") == F.col("__r")))

    def value(name: str) -> Column:
        between = F.filter("__curve", lambda x: x["w"] >= F.col(f"{name}_rest"))
        at = F.least(F.col(f"{name}_at"), F.get(between, F.lit(0))["bucket"])
        middle = F.pow(F.lit(GAMMA), at) * 2 / (1 + GAMMA)
        return F.when(at == ZERO, 0.0).otherwise(middle).alias(name)

    return joined.select(*key, *[value(name) for name in shares])


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, rule, low, high, by_events) of every group; ``by_events``: events set the width, not quartiles."""
    named = F.map_from_entries(F.collect_list(F.struct("rule", F.struct("q1", "q2", "q3"))))
    groups = quartiles(sketch).groupBy("lang", "source").agg(named.alias("q"))
    limits = []
    for r in RULES:
        q1, q3 = F.col("q")[r.name]["q1"], F.col("q")[r.name]["q3"]
        spread = FENCE * (q3 - q1)
        size = F.greatest(F.col("q")[r.bottom]["q2"], F.lit(1.0))
        events = EVENTS * r.event / size
        reach = F.greatest(spread, events, (GAMMA - 1) * q3)
        limits.append(
            F.struct(
                F.lit(r.name).alias("rule"),
                (q1 - reach if r.low else F.lit(float("-inf"))).alias("low"),
                (q3 + reach if r.high else F.lit(float("inf"))).alias("high"),
                (events > spread).alias("by_events"),
            )
        )
    return groups.select("lang", "source", F.inline(F.array(*limits)))


def judge(counts: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``counts`` with ``base_failed``, ``failed_rules`` and ``kept``.

    One row of limits per group: broadcast if counted to be small, else replicated over SALTS salts, so that
    a group with most rows is spread over that many tasks.
    """
    wide = limits.groupBy(F.col("lang").alias("__l"), F.col("source").alias("__s")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", F.struct("low", "high")))).alias("__limits")
    )
    wide = stage(wide)
    same = F.col(lang).eqNullSafe(F.col("__l")) & F.col(source).eqNullSafe(F.col("__s"))
    if wide.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = counts.join(F.broadcast(wide), same, "left")
    else:
        salted = wide.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = counts.withColumn("__deal", F.pmod(F.xxhash64(*COUNTS), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, same & (F.col("__deal") == F.col("__salt")), "left").drop("__deal", "__salt")
    checks = []
    for r in RULES:
        limit = F.col("__limits")[r.name]
        checks.append(F.when((ratio(r) < limit["low"]) | (ratio(r) > limit["high"]), F.lit(r.name)))
    failed = F.array_compact(F.array(*checks))
    return (
        joined.withColumn("base_failed", base_failed())
        .withColumn("failed_rules", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
        .drop("__l", "__s", "__limits")
    )


def quality(docs: DataFrame, keep: list[str], lang: str = "lang", source: str = "source", text_column: str = "text") -> DataFrame:
    """Columns ``keep``, the counts, and the verdict of every row of ``docs``."""
    held = [c for c in dict.fromkeys([*keep, lang, source]) if c not in COUNTS]
    counts = stage(features(docs, held, text_column))
    return judge(counts, thresholds(stage(sketches(counts, lang, source))), lang, source)


def filter_documents(docs: DataFrame, lang: str = "lang", source: str = "source", text_column: str = "text") -> DataFrame:
    """The kept rows of ``docs``, all columns: counts are taken twice, so that texts are never staged."""
    named = docs.select(F.col(lang).alias("__lang"), F.col(source).alias("__source"), F.col(text_column).alias("text"))
    limits = thresholds(stage(sketches(features(named, ["__lang", "__source"]), "__lang", "__source")))
    rows = docs.select(
        F.struct("*").alias("__row"),
        F.col(lang).alias("__lang"),
        F.col(source).alias("__source"),
        F.col(text_column).alias("text"),
    )
    judged = judge(features(rows, ["__row", "__lang", "__source"]), limits, "__lang", "__source")
    return judged.filter("kept").select("__row.*")
