"""The pipeline stage by stage against brute force, and the registered queries on the smallest tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import duck, rows_of
from tests.llm.test_line_and_quality import brute_lines
from tests.llm.test_matching import brute_components, brute_contamination, near_texts
from tests.llm.test_models_and_pages import toxic_rows

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, make_docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(12)
    rows, labels = toxic_rows(n=200)
    texts = [t for _, t in rows] + near_texts(4, families=6, members=5)
    lines = [" ".join(rng.choice("klmnopq") * 3 for _ in range(6)) for _ in range(5)]
    texts += ["\n".join([f"head {i} of its own", *lines, f"tail {i} of its own"]) for i in range(4)]
    item = "one two three four five six seven eight nine ten eleven"
    texts += [f"before it {item} after it", "\n".join(lines), None, "", "x"]
    texts += [texts[5], texts[5]]
    make_docs(texts).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t, _ in labels], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_match_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = {}
    before = None
    for name, work in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        work(spark, docs, folder).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "packing":
            assert docs.columns == DOCUMENTS
            now = sorted((r.doc_id, r.text) for r in docs.collect())
            ids[name] = now
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in docs.collect())
        if name == "toxicity":
            kept = {i for i, _ in now}
            assert not kept & {i for i in range(200) if i % 5 == 0} and kept >= {i for i in range(200) if i % 5}
        elif name == "line_dedup":
            texts = [t for _, t in before]
            left = brute_lines(texts)
            expected = [(i, new) for (i, old), new in zip(before, left) if new == old or new != ""]
            assert now == expected
        elif name == "near_dedup":
            roots, _ = brute_components([t for _, t in before], 5)
            assert now == [x for k, x in enumerate(before) if roots[k] == k]
        elif name == "decontamination":
            hits = brute_contamination([t for _, t in before], [(1, "one two three four five six seven eight nine ten eleven")])
            assert now == [x for x, h in zip(before, hits) if not h[1]] and len(now) < len(before)
        before = now
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in before}
    fill = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 4096


def test_stages_leave_clashing_columns_alone(spark, folder, clashing):
    """Columns named like those an operator adds come out as they went in."""
    extra = clashing | {"p_low_quality": "mine", "n_removed": "mine", "toxic": 9, "n_hit": "h", "__gone": 4, "contaminated": None}
    plain = spark.read.parquet(f"{folder}/documents.parquet")
    docs = plain.withColumns({k: F.lit(v).cast("string" if v is None else type(v).__name__.replace("str", "string").replace("bool", "boolean")) for k, v in extra.items()})
    for name, work in corpus_pipeline.STAGES[:-1]:
        got = work(spark, docs, folder)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        rows = got.collect()
        assert rows and all(r[k] == v for r in rows for k, v in extra.items()), name
        assert sorted((r.doc_id, r.text, r.n_chars) for r in rows) == sorted(
            (r.doc_id, r.text, r.n_chars) for r in work(spark, plain, folder).collect()
        )


def test_run_equals_the_stages_and_cleans_up(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() > 100 and set(rows.columns) >= {"doc_id", "sequence_id", "offset"}


def test_empty_tables(spark, folder, make_docs, tmp_path):
    path = str(tmp_path / "empty")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_queries_run(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    table = "pages" if name == "op8_html_extraction" else "documents"
    assert len(rows) >= spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    if name in ORACLE_SQL:
        result = duck(sf_dir).execute(ORACLE_SQL[name])
        assert rows_of(df.columns, [tuple(r) for r in rows]) == rows_of([d[0] for d in result.description], result.fetchall())


def test_entry_point_registers_them():
    import __spark_entry__ as entry

    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
