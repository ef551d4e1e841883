"""Line dedup and quality rules against brute force, and their edge cases."""

import collections
import math
import random
import re

import pytest

from riskloom.llm import line_dedup, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lines(texts):
    """Remaining text of each, by the definition."""
    seen, gone = set(), collections.defaultdict(set)
    for i, t in enumerate(texts):
        lines = t.split("\n") if t is not None else []
        for s in range(max(1, len(lines) - 2)):
            w = "\n".join(lines[s : s + 3])
            if WORD.search(w):
                if w in seen:
                    gone[i].update(range(s, min(s + 3, len(lines))))
                seen.add(w)
    return [t if not gone[i] else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def lined():
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "", " ", "delta one"]
    texts = ["\n".join(rng.choice(words) for _ in range(rng.randint(0, 14))) for _ in range(120)]
    return [*texts, None, "", "one", "one\ntwo", "a\na\na\na\na", "\n\n\n\n", "x\ny\nz", "x\ny\nz", "\n".join("pq" * 3000)]


def test_lines_match_brute_force(make_docs, lined):
    for parts in (1, 7):
        rows = line_dedup.dedup_lines(make_docs(lined).repartition(parts)).orderBy("doc_id").collect()
        assert [r.text for r in rows] == brute_lines(lined)
    assert rows[lined.index("a\na\na\na\na")].n_removed == 4
    assert rows[120].text is None and rows[120].n_lines == 0


def test_line_edges(spark, make_docs, clashing):
    assert line_dedup.dedup_lines(make_docs([])).count() == 0
    same = "k\nl\nm"
    docs = make_docs([(5, same), (5, same), (None, same), (7, "q"), (8, "q"), (9, "q\nr"), (10, " "), (11, " ")], **clashing)
    rows = line_dedup.dedup_lines(docs).collect()
    kept = {(r.doc_id, r.text) for r in rows}
    # The null id comes first; the repeated row is one document and goes as a whole, a repeated short text too.
    assert kept == {(None, same), (5, ""), (7, "q"), (8, ""), (9, "q\nr"), (10, " "), (11, " ")} and len(rows) == 8
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in rows}[8] == (1, 1)
    assert set(docs.columns) <= set(rows[0].asDict())


def test_hot_window_takes_the_broadcast_path(spark, make_docs, monkeypatch):
    from riskloom.llm import common

    monkeypatch.setattr(common, "HOT_KEYS", 3)
    texts = ["l1\nl2\nl3"] * 50 + [f"u{i}\nv{i}\nw{i}\nu{i}\nv{i}\nw{i}" for i in range(10)]
    rows = line_dedup.dedup_lines(make_docs(texts)).orderBy("doc_id").collect()
    assert [r.text for r in rows] == brute_lines(texts)


def brute_counts(t):
    t = t or ""
    words = WORD.findall(t)
    grams = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_counts_match_brute_force(make_docs):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab ç\n#é|".split(" ")) for _ in range(rng.randint(0, 80))) for _ in range(150)]
    texts += [None, "", " \t", "ü" * 5000, "x y " * 400, "a b c d e f g h", "a b c d e f g h i a b c d e f g h"]
    rows = quality_rules.quality(make_docs(texts), ["doc_id"]).orderBy("doc_id").collect()
    got = [(r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows]
    assert got == [brute_counts(t) for t in texts]
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_sketches_merge_and_do_not_depend_on_partitions(make_docs):
    rng = random.Random(2)
    texts = [" ".join("w" * rng.randint(1, 9) for _ in range(40)) for _ in range(200)]
    docs = make_docs(texts)
    counts = quality_rules.features(docs, ["doc_id", "lang", "source"])
    one = sorted(map(str, quality_rules.thresholds(quality_rules.sketches(counts)).collect()))
    many = sorted(map(str, quality_rules.thresholds(quality_rules.sketches(counts.repartition(13))).collect()))
    assert len(one) == len(many) and [x[:40] for x in one] == [x[:40] for x in many]
    halves = [quality_rules.sketches(counts.filter(f"doc_id % 2 = {k}")) for k in (0, 1)]
    merged = halves[0].union(halves[1]).groupBy("lang", "source", "rule", "bucket").sum("n")
    whole = quality_rules.sketches(counts).groupBy("lang", "source", "rule", "bucket").sum("n")
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))


def brute_limits(rows):
    """(lang, source, rule): limits, by weights of every single row."""
    rows = [r for r in rows if r.n_words > 0]

    def rounded_up(v):
        if v < quality_rules.LEAST:
            return 0.0
        bucket = math.ceil(math.log(v) / math.log(quality_rules.GAMMA))
        return quality_rules.GAMMA**bucket * 2 / (1 + quality_rules.GAMMA)

    def quantile(lang, source, value, q):
        in_lang = sum(r.lang == lang for r in rows)
        weights = collections.Counter()
        for r in rows:
            w = quality_rules.PRIOR / len(rows) + quality_rules.PRIOR / in_lang * (r.lang == lang)
            weights[rounded_up(value(r))] += w + (r.lang == lang and r.source == source)
        left = q * sum(weights.values()) - 1e-6
        for v in sorted(weights):
            left -= weights[v]
            if left <= 0:
                return v

    limits = {}
    for lang, source in {(r.lang, r.source) for r in rows}:
        for rule in quality_rules.RULES:
            q1, q3 = (quantile(lang, source, lambda r: r[rule.top] / r[rule.bottom], q) for q in (0.25, 0.75))
            size = quantile(lang, source, lambda r: r[rule.bottom], 0.5)
            events = quality_rules.EVENTS * rule.event / max(size, 1)
            reach = max(quality_rules.FENCE * (q3 - q1), events, (quality_rules.GAMMA - 1) * q3)
            limits[lang, source, rule.name] = (q1 - reach if rule.low else -math.inf, q3 + reach)
    return limits


@pytest.mark.parametrize("broadcast", [True, False])
def test_thresholds_and_verdicts_match_brute_force(make_docs, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(quality_rules, "SKETCH_ROWS", 0)
        monkeypatch.setattr(quality_rules, "BROADCAST_ROWS", 0)
    rng = random.Random(12)
    texts = []
    for i in range(240):
        words = ["w" * rng.randint(1, 5 + 3 * (i % 6)) for _ in range(rng.randint(20, 60 + i))]
        words = [w + rng.choice(["\n", "#", "Q", " "] if rng.random() < 0.1 * (i % 2) else [" "]) for w in words]
        texts.append(" ".join(words) * rng.choice([1, 1, 1, 2]))
    texts += [" ".join(f"{i}######" for i in range(90)), "A#" * 50, "x " * 90, "one", None, "", *(["the same " + "row " * 5 + "of many words " * 3] * 40)]
    keep = ["doc_id", "lang", "source"]
    docs = make_docs(texts)
    counts = quality_rules.features(docs, keep)
    expected = brute_limits(counts.collect())
    found = quality_rules.thresholds(quality_rules.sketches(counts)).collect()
    assert {(r.lang, r.source, r.rule) for r in found} == set(expected)
    for r in found:
        assert (r.low, r.high) == pytest.approx(expected[r.lang, r.source, r.rule], rel=1e-9)
    verdicts = quality_rules.quality(docs, keep).collect()
    assert len(verdicts) == len(texts)
    for r in verdicts:
        failed = set()
        for rule in quality_rules.RULES if r.n_words else ():
            low, high = expected[r.lang, r.source, rule.name]
            if not low <= r[rule.top] / r[rule.bottom] <= high:
                failed.add(rule.name)
        if r.n_words:
            assert set(r.failed_rules) == failed
        assert r.kept == (not r.base_failed and not failed)
    assert any(r.failed_rules and not r.base_failed for r in verdicts)


def test_group_of_equal_texts_keeps_them(make_docs):
    text = " ".join(f"word{i % 40} line{i}" for i in range(600))
    assert all(r.kept for r in quality_rules.quality(make_docs([text] * 50), ["doc_id"]).collect())


def test_quality_keeps_clean_and_drops_junk(make_docs, clashing):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(300)]
    clean = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(300)]
    junk = [" ".join(w + "###" for w in rng.sample(vocabulary, 60)) for _ in range(10)]
    junk += [" ".join(w.upper() for w in rng.sample(vocabulary, 60)) for _ in range(10)]
    docs = make_docs(clean + junk, **clashing)
    kept = {r.doc_id for r in quality_rules.filter_documents(docs).collect()}
    assert kept == set(range(300))
    assert quality_rules.filter_documents(docs).columns == docs.columns
    assert quality_rules.quality(make_docs([]), ["doc_id"]).count() == 0
