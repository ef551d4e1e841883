"""Corpus pipeline: documents to packed sequences, one operator of riskloom.llm per stage.

Stages filter or clean whole documents and keep the columns of the table, whatever their names, except the last,
which packs. Rows
that share an id share a verdict; rows equal in id and text count as copies from the third stage on. A null
id is an id like any other. Missing labels or an empty benchmark table make their stage keep everything.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import decontaminate, line_dedup, near_dup
from riskloom.llm.common import clear_scope, sized, stage, staging_scope
from riskloom.llm.queries import TOXIC_AT, packed, table, toxicity_scores

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SCOPE = "pipeline"


def _scoped(work: Stage) -> Stage:
    """Predecessors are written before a stage starts, so what they staged can go."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear_scope(spark, SCOPE)
        with staging_scope(SCOPE):
            return work(spark, docs, sf_dir)

    return run_stage


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the ids of a staged, distinct list; broadcast only if counted to be short."""
    ids = sized(ids.select(F.col("doc_id").alias("__gone")))
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__gone")), "left_anti")


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with all columns but id and text under names that no operator uses, and the way back to the old ones."""
    inner = {c: c if c in ("doc_id", "text") else f"__column{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    return renamed, {c: F.col(n).alias(c) for c, n in inner.items()}


@_scoped
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain calls toxic go."""
    inner, back = _apart(docs)
    scores = toxicity_scores(inner, table(spark, sf_dir, "labels"))
    return scores.filter(F.col("p_toxic") < TOXIC_AT).select(*back.values())


@_scoped
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated three-line windows go; a document of which no line is left goes too."""
    inner, back = _apart(docs)
    result = line_dedup.dedup_lines(inner)
    result = result.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    if "n_chars" in back:
        back["n_chars"] = F.length("text").cast("bigint").alias("n_chars")
    return result.select(*back.values())


@_scoped
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the least id stays."""
    inner, back = _apart(docs)
    found = near_dup.near_duplicates(inner, width=5, percent=80)
    gone = stage(found.filter(~F.col("kept")).select("doc_id").distinct())
    # The join has dealt rows by id already, so equal rows meet without another shuffle.
    return _without(inner, gone).dropDuplicates(["doc_id", "text"]).select(*back.values())


@_scoped
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    inner, back = _apart(docs)
    found = decontaminate.contamination(inner, table(spark, sf_dir, "benchmark"))
    return _without(inner, stage(found.filter("n_hit > 0").select("doc_id").distinct())).select(*back.values())


@_scoped
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: No SQL: learned weights and a tokenizer are outside it; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is written and read again as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for _, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
