"""Decontamination, near duplicates and substring removal against brute force, and their edge cases."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from riskloom.llm import components, decontaminate, near_dup, suffix_dedup

# --------------------------------------------------------------------------- decontamination

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(t):
    return TERM.findall((t or "").translate(LOW))


def brute_contamination(texts, items, width=10):
    out = []
    windows = {}
    for name, t in items:
        w = terms(t)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(name) if name is not None else "null")
    for t in texts:
        w, hit, names = terms(t), set(), set()
        for window, own in windows.items():
            n = len(window)
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) == window:
                    hit.update(range(i, i + n))
                    names |= own
        out.append((len(w), len(hit), sorted(names)))
    return out


@pytest.fixture(scope="module")
def bench():
    rng = random.Random(8)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(9, 14)))) for i in range(6)]
    items += [(10, "Short ITEM"), (10, "Short ITEM"), (11, None), (12, ""), (None, "é-è ü"), (13, "a a a a a a a a a a a a")]
    texts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    for i, (_, t) in enumerate(items):
        if t:
            texts[i] += f". {t}, {t} " + texts[i]
    return [*texts, None, "", "short, item!", "É é è ü", "a " * 4000], items


@pytest.mark.parametrize("segment, block", [(400_000, 100_000), (200, 7)])
def test_contamination_matches_brute_force(spark, make_docs, bench, clashing, monkeypatch, by_value, segment, block):
    by_value(decontaminate)
    monkeypatch.setattr(decontaminate, "SEGMENT", segment)
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    texts, items = bench
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(make_docs(texts, **clashing).coalesce(2), table).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.items) for r in rows] == brute_contamination(texts, items)


def test_contamination_edges(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(make_docs([]), none).count() == 0
    rows = decontaminate.contamination(make_docs(["a b", None]), none).collect()
    assert [(r.n_hit, r.items) for r in rows] == [(0, []), (0, [])]
    twice = make_docs([(1, "x y z"), (1, "x y z"), (None, "x y z")])
    item = spark.createDataFrame([(3, "y z")], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.contamination(twice, item).collect()] == [2, 2, 2]


def test_proximity_follows_words_in_order(make_docs):
    docs = make_docs(["the red old fox ran", "red fox", "fox red", "red a b c d fox", "red", "fox"])
    index = decontaminate.build_index(docs)
    found = {(r.doc_id, r.first, r.last) for r in decontaminate.proximity(index, {"q": "red fox"}, slop=1).collect()}
    assert found == {(0, 1, 3), (1, 0, 1)}


def brute_proximity(texts, items, slop, width):
    found = set()
    for name, t in items:
        w = terms(t)
        for window in [w[i : i + width] for i in range(max(1, len(w) - width + 1))] if w else ():
            for d, text in enumerate(texts):
                own = terms(text)
                for first in range(len(own)):
                    for last in range(first, min(len(own), first + len(window) + slop)):
                        inner = iter(own[first : last + 1])
                        if own[first] == window[0] and all(x in inner for x in window):
                            found.add((str(name) if name is not None else "null", d, first, last))
                            break
    return found


@pytest.mark.parametrize("block", [100_000, 5])
def test_proximity_of_a_table_of_items(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    rng = random.Random(12)
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 25))) for _ in range(40)] + [None, "", "A, b! c"]
    items = [(i, " ".join(rng.choice("abcdefz") for _ in range(n))) for i, n in enumerate([1, 2, 3, 4, 6, 9, 9])]
    items += [(None, "a b c"), (20, ""), (21, None), (22, "c a a c"), (22, "c a a c")]
    table = spark.createDataFrame(items, "item_id long, text string")
    for parts in (1, 5):
        index = decontaminate.build_index(make_docs(texts).repartition(parts))
        for slop in (0, 3):
            rows = decontaminate.proximity(index, table, slop, width=4).collect()
            got = [(r.name, r.doc_id, r.first, r.last) for r in rows]
            assert len(got) == len(set(got)) and set(got) == brute_proximity(texts, items, slop, 4)
    assert decontaminate.proximity(index, table.limit(0), 2).count() == 0


# --------------------------------------------------------------------------- near duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_components(texts, width):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near_texts(seed, families=12, members=8, length=70):
    rng = random.Random(seed)
    texts = []
    for _ in range(families):
        base = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(length)]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6, 9])):
                own[rng.randrange(length)] = "".join(rng.choice("xyz") for _ in range(4))
            texts.append(" ".join(own))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("width, block", [(2, 2_000), (5, 3)])
def test_components_match_brute_force(make_docs, clashing, monkeypatch, width, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "PER_COPY", 2)
    texts = [*near_texts(width), None, "", "one", "One", "two words", "two  WORDS\n", "w " * 3000]
    rows = near_dup.near_duplicates(make_docs(texts, **clashing), width=width).orderBy("doc_id").collect()
    expected, sizes = brute_components(texts, width)
    assert [r.component_id for r in rows] == expected
    assert [r.n_shingles for r in rows] == sizes
    assert [r.kept for r in rows] == [i == c for i, c in enumerate(expected)]


def test_chains_and_hot_copies(make_docs, monkeypatch):
    """A long chain in which only neighbours are similar, beside many copies of one text."""
    from riskloom.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 4)
    words = [f"w{i}" for i in range(60)]
    chain = []
    for step in range(12):
        chain.append(" ".join([f"n{i}" for i in range(step * 3)] + words[step * 3 :]))
    texts = [*chain, *["same text again and again"] * 40]
    rows = near_dup.near_duplicates(make_docs(texts), width=2).orderBy("doc_id").collect()
    assert [r.component_id for r in rows] == brute_components(texts, 2)[0]


def test_near_duplicate_edges(make_docs):
    assert near_dup.near_duplicates(make_docs([]), width=2).count() == 0
    rows = near_dup.near_duplicates(make_docs([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "q r")]), width=2).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True),
    ]


def test_every_pair_under_the_distance_shares_a_key():
    import numpy as np

    rng = np.random.default_rng(1)
    allowed = 2 * near_dup.SYMBOLS // near_dup.CHUNK - 1
    a = rng.integers(0, 1 << 16, (300, near_dup.SYMBOLS), dtype=np.uint16)
    b = a.copy()
    for i in range(300):
        b[i, rng.choice(near_dup.SYMBOLS, allowed, replace=False)] += 1
    shared = near_dup.bucket_keys(a) == near_dup.bucket_keys(b)
    assert shared.any(axis=1).all()
    assert (near_dup.first_common_key(a != b) == shared.argmax(axis=1)).all()


def test_components_of_random_links(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(350)] + [(i, i + 1) for i in range(500, 700)]
    links = [x for x in links if x[0] != x[1]]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(links, "a long, b long").repartition(6))
    assert {(r.node, r.root) for r in got.collect()} == {(x, find(x)) for x in list(root)}


# --------------------------------------------------------------------------- repeated substrings


def brute_removed(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for t in raw:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in raw:
        covered = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        out.append(bytes(b for b, c in zip(t, covered) if not c))
    return out


@pytest.fixture(scope="module")
def repeats():
    rng = random.Random(5)

    def some(n):
        return "".join(rng.choice("abcdefgh éß\n") for _ in range(n))

    shared, line = some(260), some(150)
    texts = [some(rng.randint(0, 700)) for _ in range(15)]
    texts += [some(50) + shared + some(120), some(33) + shared[:230] + some(10), some(300) + shared[40:] , shared[20:]]
    texts += [some(90) + line + some(90) for _ in range(14)]  # common, but too short to go
    base = some(900)
    for k in range(6):
        cut = rng.randrange(900)
        texts.append(base[:cut] + some(3) + base[cut + k :])
    texts += [base, base, "In. " * 200, "ab" * 300, "a" * 199, "b" * 200, "c" * 201, None, "", shared]
    return texts


@pytest.mark.parametrize("group, block, portion", [(20_000, 150_000, 900_000), (3, 50, 300)])
def test_removal_matches_brute_force(make_docs, repeats, clashing, monkeypatch, by_value, group, block, portion):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "PORTION", portion)
    by_value(suffix_dedup)  # workers see the changed values
    expected = brute_removed(repeats)
    for parts in (1, 9):
        docs = make_docs(repeats, **clashing).repartition(parts)
        rows = suffix_dedup.dedup_substrings(docs).orderBy("doc_id").collect()
        assert [bytes(r.kept) for r in rows] == expected
        for r, t in zip(rows, repeats):
            assert r.n_bytes == len((t or "").encode()) and r.n_bytes - len(r.kept) == sum(s.end - s.start for s in r.spans)


def test_removal_edges(make_docs):
    assert suffix_dedup.dedup_substrings(make_docs([])).count() == 0
    text = "".join(chr(97 + i % 23) + chr(97 + i % 7) for i in range(200))
    rows = suffix_dedup.dedup_substrings(make_docs([(1, text), (1, text), (None, None)])).collect()
    assert sorted(len(r.kept) for r in rows) == [0, 0, 0]
    single = suffix_dedup.dedup_substrings(make_docs([(1, "".join(chr(33 + i * i % 89) for i in range(250)))])).first()
    assert isinstance(single.spans, list)


def test_suffix_arrays_of_random_strings():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(800):
        own = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(1, 40)), 0)
        symbols = own.tolist()
        assert suffix_dedup.suffix_array(own).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_hash_rows_are_equal_in_both_scans(make_docs):
    keyed = suffix_dedup._keyed(make_docs(["a", None, "b"]), "doc_id", "text")
    assert keyed.filter(F.col("text").isNull()).count() == 0 and keyed.select("row").distinct().count() == 3
