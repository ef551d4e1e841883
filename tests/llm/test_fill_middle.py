"""Fill-in-middle against plain string slicing."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import fill_middle
from riskloom.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [
    None, "", "a", "ab", "é", "日本語の文章です。", "🙂🙃" * 50, "line one\nline two\n\nline four", "x <P> y", "<S>", "tail <M>", "<", "<P", "P>",
    "<<<>>>", "S>M>P>", "\x00 null byte", " \t\r\n ", "é combining", "word " * 3000, "ž" * 70_000,
]


@pytest.fixture(scope="module")
def docs(make_docs):
    return make_docs([(i, t) for i, t in enumerate(TEXTS * 12)] + [(None, "no id"), (None, "no id"), (5, "same id"), (5, None)])


def test_equals_slicing(docs):
    got = fill_middle.restore(fill_middle.transform(docs, keep=["doc_id", "text"])).collect()
    assert len(got) == docs.count()
    forms = set()
    for r in got:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == expected(r.doc_id, r.text)
        assert r.restored == (r.text or "")
        forms.add(r.form)
    assert forms == {"plain", "psm", "spm"}


def test_windows_cut_long_texts(monkeypatch, docs, by_value):
    by_value(fill_middle)
    whole = sorted(fill_middle.transform(docs).collect(), key=repr)
    monkeypatch.setattr(fill_middle, "WINDOW", 7)
    assert sorted(fill_middle.transform(docs.filter("length(text) < 5000 or text is null")).collect(), key=repr) == [
        r for r in whole if r.n < 5000
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(min_size=1, max_size=40), st.integers(0, 40), st.integers(0, 40)), max_size=8), st.integers(1, 12))
def test_pieces_of_any_text(rows, window):
    rows = [(t.encode("utf-8", "ignore").decode(), a, b) for t, a, b in rows]
    rows = [r for r in rows if r[0]]
    low = np.array([min(a, b) for _, a, b in rows], np.int64)
    high = np.array([max(a, b) for _, a, b in rows], np.int64)
    texts = pa.array(["skipped", *[t for t, _, _ in rows]], pa.string())[1:]
    got = [p.to_pylist() for p in fill_middle.pieces(texts, low, high, window)]
    want = [[t[:a] for (t, _, _), a in zip(rows, low)]]
    want.append([t[a:b] for (t, _, _), a, b in zip(rows, low, high)])
    want.append([t[b:] for (t, _, _), b in zip(rows, high)])
    assert got == want


def test_other_columns_and_empty_table(make_docs, clashing):
    extra = clashing | {"form": "f", "output": 1, "restored": "r", "prefix_chars": None, "__fm_text": 3}
    df = make_docs(["some text", "other text"], **extra)
    assert {r.output.count("<M>") for r in fill_middle.transform(df).collect()} <= {0, 1}
    kept = fill_middle.transform(df, keep=["doc_id", "size"])
    assert kept.columns == ["doc_id", "size", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_middle.restore(fill_middle.transform(make_docs([]))).collect() == []


def test_marks_must_be_findable(make_docs):
    for marks in (("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("", "x", "y")):
        with pytest.raises(ValueError):
            fill_middle.transform(make_docs(["a"]), marks=marks)


def test_own_marks_and_shares(make_docs):
    texts = [f"text number {i}" for i in range(300)]
    got = fill_middle.transform(make_docs(texts), seed=9, cut_percent=50, spm_percent=100, marks=("[p]", "{s}", "(m)")).collect()
    assert {r.form for r in got} == {"plain", "spm"}
    assert 100 < sum(r.form == "spm" for r in got) < 200
    assert all(r.output.startswith("{s}") and "[p]" in r.output and "(m)" in r.output for r in got if r.form == "spm")


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op11_fill_middle"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, prefix, middle, output = expected(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (sha(output), sha(docs[r.doc_id] or ""))
