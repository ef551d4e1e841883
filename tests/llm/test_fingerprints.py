"""Multiset fingerprints against one paragraph and one word run at a time."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.llm import fingerprints as fp
from riskloom.llm.queries import QUERIES

MASK = (1 << 64) - 1


def mixed(x):
    x ^= x >> 32
    x = x * 0xD6E8FEB86659FD93 & MASK
    return x ^ x >> 32


def slow(paragraphs):
    """Sums of paragraph vectors with Python integers."""
    import xxhash

    wide, sparse = [0] * fp.WIDE, [0] * fp.SPARSE
    for p in paragraphs:
        lanes = hashlib.shake_256(p).digest(8 * fp.WIDE)
        for i in range(fp.WIDE):
            wide[i] = (wide[i] + int.from_bytes(lanes[8 * i : 8 * i + 8], "little")) % 2**64
        words = p.split()
        runs = [words[i : i + fp.SHINGLE] for i in range(len(words) - fp.SHINGLE + 1)] or ([words] if words else [])
        for run in runs:
            h = 0
            for w in run:
                h = mixed((h * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(w)) & MASK)
            lane = h % fp.SPARSE
            sparse[lane] = (sparse[lane] + (-1 if h >> 63 else 1)) % 2**16
    return wide, sparse


def written(text):
    wide, sparse = slow((text or "").encode().split(b"\n"))
    return fp.written((np.array([wide], np.uint64), np.array([sparse], np.uint16)))[0]


def sums(*texts):
    return fp.Vectors().sums([t.encode().split(b"\n") for t in texts])


def brute(rows):
    """Rows (id, text) to the query's result, but for the likenesses."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), written(t), written(edited), t, edited, after)
    return out


TEXTS = [
    None, "", "one", "one two three four five six\nseven", "seven\none two three four five six", "\n\n", "  ", "日本語\n文章", "🙂" * 31,
    "same line\n" * 40, "word " * 4000, "a\x00b\r\nc", "last one of all",
]

lines = st.lists(st.text(st.characters(blacklist_characters="\n", blacklist_categories=["Cs"]), max_size=30), min_size=1, max_size=12)


@settings(max_examples=60, deadline=None)
@given(lines, st.randoms(use_true_random=False))
def test_order_plays_no_part_and_sums_are_right(paragraphs, rng):
    moved = paragraphs[:]
    rng.shuffle(moved)
    wide, sparse = sums("\n".join(paragraphs), "\n".join(moved))
    assert (wide[0] == wide[1]).all() and (sparse[0] == sparse[1]).all()
    expected = slow([p.encode() for p in paragraphs])
    assert wide[0].tolist() == expected[0] and sparse[0].tolist() == expected[1]


@settings(max_examples=60, deadline=None)
@given(lines, lines, lines)
def test_insertion_and_deletion(kept, gone, come):
    wide, sparse = sums(*["\n".join(p) for p in (kept + gone, kept + come, gone, come)])
    whole, later, removed, inserted = ((wide[i : i + 1], sparse[i : i + 1]) for i in range(4))
    got = fp.changed(whole, removed, inserted)
    assert (got[0] == later[0]).all() and (got[1] == later[1]).all()
    assert fp.written(got) == fp.written(later)
    back = fp.read(fp.written(got))
    assert (back[0] == got[0]).all() and (back[1] == got[1]).all()


def test_different_multisets_differ():
    texts = ["a\nb", "a\nb\nb", "a\na\nb", "a b", "ab", "a\nb\n", "a", "", "b", " a\nb", "a\nB"]
    assert len(set(fp.written(sums(*texts)))) == len(texts)


def test_likeness_follows_what_is_shared():
    rng = random.Random(5)
    errors = []
    for share in (0.0, 0.25, 0.5, 0.75, 0.9):
        for _ in range(20):
            one = [str(rng.random()) for _ in range(400)]
            other = one[: int(400 * share)] + [str(rng.random()) for _ in range(400 - int(400 * share))]
            a, b = sums(" ".join(one)), sums(" ".join(other))
            errors.append(abs(fp.likeness(a, b)[0] - share))
    assert np.mean(errors) < 0.06 and max(errors) < 0.3
    assert fp.likeness(sums("x y"), sums("x y"))[0] == 1.0
    assert fp.likeness(sums(""), sums(""))[0] == 1.0
    assert fp.likeness(sums(""), sums("\n"))[0] == 0.0


def test_chunks_change_nothing(monkeypatch):
    texts = ["\n".join(f"line {i} of text {k}" for i in range(50)) for k in range(9)] + ["x" * 500]
    whole = fp.written(sums(*texts))
    monkeypatch.setattr(fp, "CHUNK", 64)
    assert fp.written(sums(*texts)) == whole


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_brute_force(make_docs, clashing, partitions):
    rows = [(3 * i - 20, f"{t or ''}{i}" if i % 4 else t) for i, t in enumerate(TEXTS * 25)]
    docs = make_docs(rows, **clashing).repartition(partitions)
    want = brute(rows)
    got = fp.edited(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        n, digest, own, edited, *texts = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n, digest, own, edited)
        a, b, c = (sums(t) for t in texts)
        assert (r.near_edited, r.near_next) == (fp.likeness(a, b)[0], fp.likeness(a, c)[0])
    plain = {r.doc_id: r.fingerprint for r in fp.fingerprints(docs).collect()}
    assert plain == {i: w[2] for i, w in want.items()}


def test_one_document_none_and_nulls(spark, make_docs):
    one = fp.edited(make_docs([(7, "alone here")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(7, 1.0)]
    assert one[0].edited_sha256 == hashlib.sha256(b"alonealone").hexdigest()
    assert fp.edited(make_docs([])).collect() == [] and fp.fingerprints(make_docs([])).collect() == []
    got = fp.edited(make_docs([(None, "no id at all"), (2**62 + 1, "b"), (2**62, "first of the two"), (0, None)])).collect()
    by_id = {r.doc_id: r for r in got}
    assert set(by_id) == {None, 0, 2**62, 2**62 + 1}
    assert by_id[2**62].edited_sha256 == hashlib.sha256(b"first ofb").hexdigest()
    assert by_id[2**62 + 1].edited_sha256 == hashlib.sha256(b"b").hexdigest()
    assert by_id[None].edited_sha256 == hashlib.sha256(b"no id ").hexdigest()


def test_repeated_ids_and_rows(make_docs):
    rows = [(1, "same row same row")] * 400 + [(1, "other text of id one")] * 3 + [(i, f"text {i}") for i in range(2, 60)]
    got = fp.edited(make_docs(rows)).collect()
    assert len(got) == len(rows)
    again = fp.edited(make_docs(rows).repartition(5)).collect()
    assert sorted(got, key=repr) == sorted(again, key=repr)


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(rows)
    got = QUERIES["op12_document_fingerprints"](spark, sf_dir).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == want[r.doc_id][:4]
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.9
