"""Registered queries of the numbered operators: whole tables, production parameters, full results."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    decontaminate,
    fill_middle,
    fingerprints,
    html_text,
    language_id,
    line_dedup,
    manifest,
    near_dup,
    packing,
    quality_rules,
    secrets,
    suffix_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {"op2_decontamination": decontaminate.SQL, "op5_line_dedup": line_dedup.SQL}

#: Chain of the toxicity query, in order, and the probability from which a document counts as toxic.
CATEGORIES = ("low_quality", "toxic")
TOXIC_AT = 0.5
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = language_id.train(docs.filter(~held_out))
    return language_id.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with ``p_low_quality`` and ``p_toxic`` from a chain fitted on the labelled ones."""
    labels = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    return toxicity.score(docs, toxicity.train(docs, labels, CATEGORIES))


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = quality_rules.quality(table(spark, sf_dir, "documents"), ["doc_id"])
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return result.select("doc_id", *base, "base_failed", "kept", "failed_rules")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of the matches: counts, the hash of the item list, and the verdict."""
    found = decontaminate.contamination(docs, benchmark)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "p_low_quality", "p_toxic", (F.col("p_toxic") >= TOXIC_AT).alias("toxic"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    fixed = F.filter("spans", lambda s: s["kind"] != "field")

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in secrets.KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(joined(fixed), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages), ["page_id", "url"])


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.transform(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and a later state of the table checked against it: every fifth text or so in lower case."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    made = manifest.manifest(docs, changed={"text": F.when(tampered, lowered).otherwise(F.col("text"))})
    checked = made.withColumn("folded_root", manifest.folded(F.col("found"), F.col("at"), F.col("siblings")))
    return checked.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof(F.col("siblings")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
