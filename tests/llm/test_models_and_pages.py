"""Packing, language, toxicity, secrets and page text: exact properties, held-out accuracy, edge cases."""

import random
import re
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import common, html_text, language_id, packing, secrets, toxicity

# --------------------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def tokenizer_path():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")


ODD = [
    "it's. He'll, 5. x.. y., (z). 3,14 A.B. e.g., end.",
    "<|startoftext|> inside <|endoftext|>. And <|STARTOFTEXT|>, UPPER.",
    "İstanbul ﬁn Σας ΟΔΟΣ. é   nbsp em a\u0085b \x1c c",
    "", None, " \n\t", "...,,,", "日本語。テスト, ok.", "a" * 3000, "word " * 9000,
]


def test_ids_equal_those_of_whole_texts(make_docs, tokenizer_path, clashing):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path)
    rows = packing.pack(make_docs(ODD, **clashing).repartition(3), tokenizer_path).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    expected = {}
    for i, t in enumerate(ODD):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for k, a in enumerate(range(0, len(ids), 4096)):
            expected[(i, k)] = (a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes()))
    assert got == expected


def check_plan(lengths, capacity, **options):
    values, counts = np.unique(lengths, return_counts=True)
    moves, n = packing.plan_packing(values, counts, capacity, **options)
    fill = {}
    placed = {}
    for length, rank, total, each, first, offset in moves.tolist():
        assert placed.get(length, 0) == rank  # ranks go on without a gap
        placed[length] = rank + total
        for i in range(total):
            fill.setdefault(first + i // each, []).append((offset + i % each * length, length))
    assert placed == dict(zip(values.tolist(), counts.tolist()))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert set(fill) == set(range(n))
    return n


@pytest.mark.parametrize("seed", range(6))
def test_plans_are_gapless_and_tight(seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(1, 101, rng.integers(1, 400)), np.full(seed * 7, 100), np.full(seed * 30, 37)])
    for options in ({"small": 10, "groups": 12}, {"small": 40, "groups": 6}, {"small": 100}, {"small": 0, "groups": 3}):
        n = check_plan(lengths, 100, **options)
        assert n >= -(-int(lengths.sum()) // 100)
    assert check_plan(lengths, 100, small=37, groups=12) <= 1.1 * lengths.sum() / 100 + 2


def test_packing_edges(make_docs, tokenizer_path):
    assert packing.pack(make_docs([]), tokenizer_path).count() == 0
    rows = packing.pack(make_docs([(None, "a b"), (3, "c"), (3, "c")]), tokenizer_path).collect()
    assert len(rows) == 3 and {r.sequence_id for r in rows} == {0} and sorted(r.offset for r in rows) in ([0, 2, 4], [0, 3, 5])


# --------------------------------------------------------------------------- language


def language_texts(seed=1, n=240):
    rng = random.Random(seed)
    kinds = {"aa": "abcdefg", "bb": "ghijklm", "cc": "öüäbcde"}
    rows = []
    for i in range(n):
        lang = rng.choice(list(kinds))
        rows.append((i, " ".join("".join(rng.choice(kinds[lang]) for _ in range(rng.randint(2, 7))) for _ in range(25)), lang))
    return rows


def test_language_on_held_out_texts(spark, clashing):
    rows = language_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(docs.filter("doc_id % 4 <> 2"))
    assert model.languages == ("aa", "bb", "cc") and (model.weights == 0).mean() > 0.5
    for name, value in clashing.items():
        docs = docs.withColumn(name, F.lit(value))
    found = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    held = [(i, lang) for i, _, lang in rows if i % 4 == 2]
    assert sum(found[i].lang_pred == lang for i, lang in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_edges(spark, make_docs):
    docs = make_docs([None, "", "123 !? ²", "bonjour tout le monde", (None, "x"), "words " * 60_000])
    model = language_id.train(docs)
    rows = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert [rows[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and rows[0].score == 0.0
    assert rows[3].lang_pred in model.languages
    empty = make_docs([])
    assert language_id.train(empty) is None and language_id.predict(empty, None).count() == 0
    assert language_id.predict(docs, None).filter("lang_pred = 'und'").count() == docs.count()


def test_long_texts_count_whole(monkeypatch):
    text = "The quick brown fox, ünïcode. " * 50
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "PORTION", 37)
    assert (language_id.ngram_counts(text) == whole).all()


def test_temperature_restores_calibration():
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(4_000, 3))
    p = language_id._softmax(scores)
    labels = np.array([rng.choice(3, p=row) for row in p])
    assert language_id.temperature(scores * 5, labels) == pytest.approx(5, rel=0.15)


def test_temperature_without_any_error_stays_off_its_bound():
    labels = np.arange(300) % 3
    scores = np.where(np.eye(3)[labels] == 1, 2.0, 0.0)
    t = language_id.temperature(scores, labels)
    top = language_id._softmax(scores / t)[np.arange(300), labels]
    # The smoothed target of a language with 100 texts is the best that its scores can reach.
    assert t > 2 * language_id.TEMPERATURES[0] and top == pytest.approx(101 / 102, rel=1e-3)
    assert language_id.temperature(scores[:0], labels[:0]) == 1.0
    with pytest.warns(UserWarning, match="temperature"):
        language_id.temperature(np.array([[0.0, 2.0], [2.0, 0.0]] * 4), np.array([0, 1] * 4))


# --------------------------------------------------------------------------- samples


@pytest.mark.parametrize("rows", [
    [(None, f"text {i}") for i in range(3000)],
    [(5, f"text {i}") for i in range(3000)],
    [(i, "same") for i in range(3000)],
    [(7, "same")] * 3000,
    [(None, None)] * 3000,
])
def test_samples_bound_rows_whatever_the_ids(spark, rows):
    df = spark.createDataFrame(rows, "id long, text string").repartition(5)
    different = len(set(rows))
    n = common.sampled(df, common.share_of(300, 3000), ["id", "text"]).count()
    assert n <= 1 if different == 1 else 240 < n < 360
    assert common.sampled(df, common.share_of(5000, 3000), ["id", "text"]).count() == different


def test_fits_read_bounded_rows(spark, monkeypatch):
    """Null and repeated ids bring no more rows to the driver than the bound says."""
    seen = []
    monkeypatch.setattr(secrets, "train_field", lambda runs: seen.append(len(runs)))
    texts = [f"call it {i} token={'ab1' * 4}{i} now and then" for i in range(2000)]
    for ids in ([None] * 2000, [5] * 2000):
        secrets.train(spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string"), sample=50)
    assert all(20 < n < 100 for n in seen)
    seen.clear()
    monkeypatch.setattr(toxicity, "fit_chain", lambda rows, labels, folds: seen.append(len(rows)))
    docs = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    toxicity.train(docs, spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int"), ["toxic"], sample=50)
    assert 20 < seen[0] < 100
    seen.clear()
    monkeypatch.setattr(html_text, "train_weights", lambda rows, labels: seen.append(len(rows)))
    pages = [(None, f"<article>{'<p>a b</p>' * 400}<p>{i}</p></article>") for i in range(300)]
    html_text.train(spark.createDataFrame(pages, "page_id long, html string"), sample=30)
    assert 10 * html_text.PAGE_BLOCKS < seen[0] < 60 * html_text.PAGE_BLOCKS


# --------------------------------------------------------------------------- toxicity


def toxic_rows(seed=3, n=500):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        own = [rng.choice(words) for _ in range(60)]
        if toxic:
            own[10:12] = ["zork" + rng.choice(words), rng.choice(["Vile", "NASTY,", "vile"])]
        rows.append((i, " ".join(own)))
        labels.append((i, int(toxic), int(toxic and i % 10 == 0)))
    return rows, labels


def test_toxicity_on_held_out_texts(spark, clashing):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in clashing.items():
        docs = docs.withColumn(name, F.lit(value))
    known = spark.createDataFrame(labels[:300], "doc_id long, toxic int, severe int")
    chain = toxicity.train(docs, known, ["toxic", "severe"])
    assert chain.categories == ["toxic", "severe"] and len(chain.steps[1].earlier) == 1
    found = {r.doc_id: r.p_toxic for r in toxicity.score(docs, chain).collect()}
    held = range(300, 500)
    assert all(found[i] >= 0.5 for i in held if i % 5 == 0) and all(found[i] < 0.5 for i in held if i % 5)


def test_out_of_fold_probabilities_feed_the_next_step():
    rng = np.random.default_rng(0)
    rows = [np.array([int(x)]) for x in rng.integers(0, 2, 300)]
    first = np.array([float(r[0]) for r in rows])
    # The second category is the first with its sense turned round, on noise features only.
    chain = toxicity.fit_chain([np.array([5 + i]) for i in range(300)], {"a": first, "b": 1 - first}, np.arange(300) % 3)
    assert abs(chain.steps[1].earlier[0]) < 3  # unseen probabilities of noise say little
    sharp = toxicity.fit_chain(rows, {"a": first, "b": first}, np.arange(300) % 3)
    assert sharp.steps[1].earlier[0] > 0.5


def test_toxicity_edges(spark, make_docs):
    docs = make_docs([None, "", "good words", "bad words", (None, "bad"), "word " * 50_000])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scores = toxicity.score(docs, toxicity.train(docs, none, ["toxic"])).collect()
    assert len(scores) == 6 and all(r.p_toxic < 0.01 for r in scores)
    odd = spark.createDataFrame([(2, 0), (3, 1), (3, 0), (3, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    rows = {(r.doc_id, r.text): r.p_toxic for r in toxicity.score(docs, toxicity.train(docs, odd, ["toxic"])).collect()}
    assert len(rows) == 6 and all(0 <= p <= 1 for p in rows.values())
    assert toxicity.score(make_docs([]), toxicity.Chain(())).count() == 0


def test_make_of_a_text_is_learned_where_words_say_nothing():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(200)]
    rows, bad = [], []
    for i in range(400):
        own = [rng.choice(words) for _ in range(40)]
        if i % 4 == 0:
            own = [[w + "###", w.upper(), f"{w}\n"][i // 4 % 3] for w in own] if i // 4 % 3 < 2 else ["one line\n"] * 20
        text = " ".join(own)
        found = toxicity._WORD.findall(text.lower())
        rows.append(np.array(toxicity.text_features(set(found), toxicity.make_places(text, found))))
        bad.append(float(i % 4 == 0))
    fit, held = slice(0, 300), range(300, 400)
    step = toxicity.fit_chain(rows[fit], {"bad": np.array(bad[fit])}, np.arange(300) % 3).steps[0]
    table = dict(zip(step.places.tolist(), step.weights.tolist()))
    found = [step.bias + sum(table.get(int(p), 0.0) for p in rows[i]) > 0 for i in held]
    assert found == [i % 4 == 0 for i in held]
    assert toxicity.make_places("abcd", ["abcd"]) == []
    signs, capitals, digits, lines, repeats = toxicity._GRADES
    assert toxicity.make_places("A#a\n", ["a", "a"]) == signs[:5] + capitals[:5] + repeats  # a quarter, a quarter, a half


# --------------------------------------------------------------------------- secrets


def secret_texts(seed=4, n=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    texts = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(40)]
        if i % 4 == 0:
            own[20:20] = ["token", "=", '"' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"']
        if i % 7 == 0:
            own[5:5] = ["call", "4785380592391139", "or", "10.2.33.4", "a.b@mail.org"]
        texts.append(" ".join(own[:30]) + "\n" + " ".join(own[30:]))
    return texts


def test_field_finds_what_no_pattern_names(make_docs):
    texts = secret_texts()
    texts.append(texts[1].replace("\n", " auth Zk3+9dQpL0x7Rt5/uvWq1A== here\n"))
    docs = make_docs(texts)
    field = secrets.train(docs)
    rows = {r.doc_id: r.spans for r in secrets.scan(docs, field).collect()}
    for i, t in enumerate(texts):
        fixed = [(s.start, s.kind, s.end) for s in rows[i] if s.kind != "field"]
        assert fixed == [(a, secrets.KINDS[k], b) for a, k, b in secrets.base_spans(t)]
        own = [t[s.start : s.end] for s in rows[i] if s.kind == "field"]
        assert own == (["Zk3+9dQpL0x7Rt5/uvWq1A=="] if i == len(texts) - 1 else [])


@pytest.mark.parametrize(
    "line, tags, found",
    [
        ("use xK9$mPq2!vR7@nL4 now", "OBO", ["xK9$mPq2!vR7@nL4"]),
        ("use (\"pa55:w0rd#Trx9%Qm2\"), now", "OBO", ["pa55:w0rd#Trx9%Qm2"]),
        ("use q7Rt2x now", "OBO", ["q7Rt2x"]),
        ("at Zk3+9dQpL0x7Rt5 Wq1AuvRt5x7L0.", "OBI", ["Zk3+9dQpL0x7Rt5 Wq1AuvRt5x7L0"]),
        ("at Zk3+9dQpL0x7Rt5 Wq1AuvRt5x7L0.", "OBB", ["Zk3+9dQpL0x7Rt5", "Wq1AuvRt5x7L0"]),
        ("token=abcdef1 Wq1AuvRt5x7L0", "BI", ["Wq1AuvRt5x7L0"]),
    ],
)
def test_decoded_spans_stay_whole(monkeypatch, line, tags, found):
    monkeypatch.setattr(secrets, "viterbi", lambda *_: np.array(["BIO".index(t) for t in "O" + tags]))
    field = secrets._empty_field()
    text = "first\n" + line
    got = secrets.decode([text], field, secrets._WordScores(field), [secrets.base_spans(text)])
    assert [text[a:b] for _, a, b in got] == found


def test_each_labelled_secret_begins_anew():
    text = "here " + "0f" * 12 + " " + "1e" * 12 + " end"
    assert [t for _, tags in secrets._runs(text) for t in tags] == [secrets.O, secrets.B, secrets.B, secrets.O]


def test_fixed_patterns():
    key = "AKIA" + "Q" * 16
    text = f"ſecret=abcdefg PassWord: 'hunter2x' api-key=zzzzzzz api_key=short {key} {'0f' * 12} token=abcde"
    got = [(secrets.KINDS[k], text[a:b]) for a, k, b in secrets.base_spans(text)]
    assert got == [("assign", "PassWord: 'hunter2x"), ("access", key), ("hex", "0f" * 12)]


def test_viterbi_matches_enumeration():
    import itertools

    rng = np.random.default_rng(6)
    field = secrets.Field({}, rng.normal(size=(3, 3)), np.array([0.2, -1e4, 0.1]))
    field.moves[2, 1] = -1e4
    lengths = np.array([4, 0, 1, 6, 3])
    scores = rng.normal(size=(lengths.sum(), 3))
    got, at = secrets.viterbi(scores, lengths, field), 0
    for n in lengths.tolist():
        def value(path, at=at):
            moves = sum(field.moves[a, b] for a, b in zip(path, path[1:]))
            return field.start[path[0]] + moves + sum(scores[at + i, k] for i, k in enumerate(path))

        if n:
            assert tuple(got[at : at + n].tolist()) == max(itertools.product(range(3), repeat=n), key=value)
        at += n


def test_forward_backward_matches_enumeration():
    import itertools

    rng = np.random.default_rng(9)
    moves, start = rng.normal(size=(3, 3)), np.array([0.3, -1e4, 0.1])
    moves[2, 1] = -1e4
    lengths = np.array([5, 3, 3, 1])
    e = rng.normal(size=(4, 5, 3)) * (np.arange(5) < lengths[:, None])[:, :, None]
    z, p, expected = secrets.forward_backward(e, lengths, moves, start)
    counts = np.zeros((3, 3))
    for r, n in enumerate(lengths.tolist()):
        paths = list(itertools.product(range(3), repeat=n))
        value = np.array([start[x[0]] + sum(moves[a, b] for a, b in zip(x, x[1:])) + sum(e[r, t, k] for t, k in enumerate(x)) for x in paths])
        chance = np.exp(value - value.max())
        assert z[r] == pytest.approx(np.log(chance.sum()) + value.max())
        chance /= chance.sum()
        own = np.zeros((5, 3))
        for x, c in zip(paths, chance):
            for t, k in enumerate(x):
                own[t, k] += c
            for a, b in zip(x, x[1:]):
                counts[a, b] += c
        assert np.allclose(p[r], own)
    assert np.allclose(expected, counts)
    # Both are the derivatives of the log partition.
    step = 1e-6
    for t, k in ((0, 0), (2, 2), (4, 1)):
        e[0, t, k] += step
        assert (secrets.forward_backward(e, lengths, moves, start)[0][0] - z[0]) / step == pytest.approx(p[0, t, k], abs=1e-4)
        e[0, t, k] -= step
    moves[0, 2] += step
    assert (secrets.forward_backward(e, lengths, moves, start)[0].sum() - z.sum()) / step == pytest.approx(expected[0, 2], abs=1e-4)


def test_lines_left_out_hold_no_secret():
    rng = np.random.default_rng(4)
    left_out = 0
    for trial in range(60):
        moves, start = rng.normal(size=(3, 3)), np.array([rng.normal(), -1e4, rng.normal()])
        moves[2, 1] = -1e4
        field = secrets.Field({}, moves, start)
        lengths = rng.integers(1, 6, 30)
        scores = rng.normal(size=(lengths.sum(), 3))
        scores[:, 2] += rng.uniform(0, 4)
        starts = np.cumsum(lengths) - lengths
        may = secrets.may_hold(scores, starts, field)
        tags = secrets.viterbi(scores, lengths, field)
        assert not (tags[~np.repeat(may, lengths)] != secrets.O).any()
        left_out += int((~may).sum())
    assert left_out > 100


def test_field_recall_and_precision_by_kind():
    rng = random.Random(41)
    letters = string.ascii_letters + string.digits
    draw = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    secret = {
        "prefix": lambda: "ghp_" + draw(letters, 36),
        "base64": lambda: draw(letters + "+/", 43) + "=",
        "token": lambda: ".".join(draw(letters + "-_", n) for n in (20, 40, 30)),
        "short": lambda: draw(letters, 16),
        "signs": lambda: f"{draw(letters, 4)}${draw(letters, 4)}!{draw(letters, 3)}@{draw(letters, 3)}",
        "hex": lambda: draw("0123456789abcdef", 20),
        "address": lambda: f"postgres://admin:{draw(letters, 12)}@db.internal:5432/main",
    }
    harmless = {
        "dashed": lambda: "-".join(draw("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
        "number": lambda: draw("0123456789", rng.randint(5, 18)),
        "mail": lambda: f"{draw('abcdefgh', 6)}{rng.randint(1, 99)}@mail.org",
        "page": lambda: f"https://example.com/a/{draw('abcdefgh', 6)}/{rng.randint(1, 9999)}",
    }
    runs = []
    for i, text in enumerate(secret_texts()):
        runs += [(w, t, secrets.file_features(text)) for w, t in secrets._runs(text)]
    field = secrets.train_field(sorted(runs))
    words = secrets._WordScores(field)
    plain = [t.replace("\n", " ").split() for t in secret_texts(seed=8) if "token" not in t]
    contexts = (["{}"], ["the", "credential", "is", "{}", "and"], ["passphrase", "{}", ","])

    def share(kind):
        hit = 0
        for k in range(120):
            own, value = list(rng.choice(plain)), kind()
            at = rng.randint(1, len(own) - 1)
            own[at:at] = [w.replace("{}", value) for w in contexts[k % 3]]
            text = " ".join(own)
            a = text.index(value)
            fixed = [secrets.base_spans(text)]
            spans = [(x, y) for _, x, y in secrets.decode([text], field, words, fixed)] + [(x, y) for x, _, y in fixed[0]]
            hit += any(x < a + len(value) and y > a for x, y in spans)
        return hit / 120

    assert {name: s for name, kind in secret.items() if (s := share(kind)) < 0.85} == {}
    assert {name: s for name, kind in harmless.items() if (s := share(kind)) > 0.02} == {}


def test_secret_edges(make_docs, clashing):
    docs = make_docs([None, "", "plain", (None, "token=abcdef1"), (5, "token=abcdef1"), (5, "token=abcdef1"), "w " * 50_000], **clashing)
    field = secrets.train(make_docs(["nothing here"]))
    rows = secrets.scan(docs, field).collect()
    assert sorted(len(r.spans) for r in rows) == [0, 0, 0, 0, 1, 1, 1]
    assert secrets.scan(make_docs([]), field).count() == 0 and secrets.train(make_docs([])).weights == {}


# --------------------------------------------------------------------------- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, and so on, to make this page better for you.</p></div>
{open}<h1>A title &amp; more</h1><p>First <b>para</b>graph,
 with   a <a href="#">link</a>.<p>Second one is long enough, it ends here.<form><label>Mail</label><input></form>
<ul><li>one item of it</li><li>another item</li></ul>{close}
<div id="comments"><p>I liked this a lot, thank you very much, it is a great text.</p></div>
<footer>&copy; site</footer></body></html>"""
TEXT = "A title & more\n\nFirst paragraph, with a link.\n\nSecond one is long enough, it ends here.\n\none item of it\n\nanother item"


@pytest.mark.parametrize("marks", [("<article>", "</article>"), ("<div>", "</div>"), ("<main>", "")])
def test_main_text(spark, marks):
    pages = [(i, PAGE.format(open="<article>", close="</article>")) for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, html string")
    weights = html_text.train(df)
    assert html_text.main_text(PAGE.format(open=marks[0], close=marks[1]), weights) == TEXT
    rows = html_text.extract(df.withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1)), weights, ["page_id"]).collect()
    assert {(r.text, r.n_chars) for r in rows} == {(TEXT, len(TEXT))}


def brute_cut(source, sink, ties):
    import itertools

    n = len(source)
    best = None
    for side in itertools.product((0, 1), repeat=n):  # 1: with the source
        cost = sum(sink[i] if side[i] else source[i] for i in range(n))
        cost += sum(w for a, b, w in ties if side[a] != side[b])
        if best is None or cost < best[0] - 1e-12:
            best = (cost, side)
    return best[0]


def test_cut_is_minimal():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        source, sink = rng.uniform(0, 3, n), rng.uniform(0, 3, n)
        ties = [(a, b, float(rng.uniform(0, 2))) for a in range(n) for b in range(a) if rng.uniform() < 0.5]
        graph = html_text.CutGraph(n)
        for i in range(n):
            graph.terminals(i, float(source[i]), float(sink[i]))
        for a, b, w in ties:
            graph.tie(a, b, w, w)
        side = graph.source_side()
        cost = sum(sink[i] if i in side else source[i] for i in range(n)) + sum(w for a, b, w in ties if (a in side) != (b in side))
        assert cost == pytest.approx(brute_cut(source, sink, ties))


def test_ties_decide_where_a_block_says_little(monkeypatch):
    """Without any telling element a short line goes with its neighbours, which only the ties of the cut can do."""
    long = "<p>" + "Some words of a longer text, and then a few more of them, as it goes on. " * 6 + "</p>"
    page = f"<div>{long}<div>so it was</div>{long}</div>"
    weights = np.array(html_text.PRIOR)
    assert "so it was" in html_text.main_text(page, weights)
    for tie in ("NEXT_TIE", "PARENT_TIE", "GRANDPARENT_TIE"):
        monkeypatch.setattr(html_text, tie, 0.0)
    assert "so it was" not in html_text.main_text(page, weights)


def test_page_edges(spark):
    weights = np.array(html_text.PRIOR)
    assert [html_text.main_text(x, weights) for x in (None, "", "<p", "<script>x", "<!-- a", "<nav>a</nav>")] == [""] * 6
    assert html_text.main_text("<article><p>&lt;b&gt; &am x &#228;<p>cut off in the mid", weights) == "<b> &am x ä\n\ncut off in the mid"
    none = spark.createDataFrame([], "page_id long, html string")
    assert (html_text.train(none) == weights).all() and html_text.extract(none, weights, ["page_id"]).count() == 0
    rows = spark.createDataFrame([(None, None), (1, "<p>x"), (1, "<p>x")], "page_id long, html string")
    assert html_text.extract(rows, weights, ["page_id"]).count() == 3
    deep = "<div>" * 3000 + "<p>" + "word, " * 300 + "</p>"
    assert re.match("word, word", html_text.main_text(deep, weights))


STORY = "<article class='post tag-legal'><h1>A title of it</h1><p>First paragraph, which is long enough, ends here.</p>{}</article>"
STORY_TEXT = "A title of it\n\nFirst paragraph, which is long enough, ends here."
LONG = "<p>I liked this a lot, thank you very much, it is a great text, and a long one.</p>"


@pytest.mark.parametrize(
    "rest",
    [
        f"<div id='comments'><article class='comment'>{LONG}</article><article>{LONG}</article></div>",
        f"<div class='related'><article class='card'>{LONG}</article></div>",
        f"<aside class='sidebar'><div><article>{LONG}</article></div></aside>",
        f"<article class='teaser'>{LONG}</article>",
        f"<article class='comment'><article>{LONG}</article></article>",
    ],
)
def test_articles_that_are_not_the_main_text(rest):
    weights = np.array(html_text.PRIOR)
    assert html_text.main_text(STORY.format("") + rest, weights) == STORY_TEXT
    assert html_text.main_text(STORY.format(rest), weights) == STORY_TEXT
    wrapped = f"<body class='sidebar'><div class='widget promo'>{STORY.format('')}</div>{rest}"
    assert html_text.main_text(wrapped, weights) == STORY_TEXT


def test_text_of_formulas_fallbacks_and_wrapping_forms():
    weights = np.array(html_text.PRIOR)
    formula = "<p>We know, as said before, that <math><semantics><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></semantics></math> holds.</p>"
    shown = "We know, as said before, that x=1 holds."
    assert html_text.main_text(STORY.format(formula), weights) == f"{STORY_TEXT}\n\n{shown}"
    for tag in ("object", "canvas"):
        assert html_text.main_text(STORY.format(f"<{tag}><p>The drawing shows a house, a tree and a river.</p></{tag}>"), weights) == (
            STORY_TEXT + "\n\nThe drawing shows a house, a tree and a river."
        )
    for form in ("<p>Skip</p><form id='all'>{}</form>", "<body><form>{}</form></body>"):
        assert STORY_TEXT in html_text.main_text(form.format(STORY.format("")), weights)
    plain = STORY.format("").replace("article", "div").replace(" tag-legal", "")
    assert html_text.main_text(f"<body><form>{plain}</form></body>", weights) == STORY_TEXT
    mail = "<form><p>Leave your name, your address and your question here.</p></form>"
    assert html_text.main_text(STORY.format(mail), weights) == STORY_TEXT
    assert html_text.main_text(f"<span><form>{LONG}</span>" + STORY.format(""), weights) == STORY_TEXT
