"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds what they miss.

The field tags the white-space tokens of each line as B(egin), I(nside) or O(utside) of a secret. A token's
score comes from its own shape, the words before and after it, and features of the whole text; a matrix scores
transitions (I cannot follow O). It is trained by maximum likelihood (forward-backward, adaptive gradient
steps) on token runs of a bounded sample of documents, labelled by the fixed patterns, and on copies of them: labelled
runs with random strings of other alphabets, lengths and forms in the secret's place, and plain runs with ordinary
ids, numbers, names and addresses. So it learns what random strings are like, and that dashed ids, long numbers and
addresses without a password are none. Decoding is Viterbi over every line of every whole text, all lines of a batch in
step; lines that no path with a secret can win (``may_hold``, exact) are left out.

Fixed patterns, leftmost and non-overlapping per kind: ``assign``, ``access`` and ``hex`` (PATTERNS). Spans are
code points, end exclusive. A decoded span is all of its tokens, without the quotes, brackets and closing punctuation at
its ends. Fixed spans always stay as they are: tokens that touch one are taken out of the decoded span, and what
is left on either side is a span of its own. Spans under LEAST characters (as in the fixed rule) are left out.

Defined cases: null and empty texts have no spans; rows are scanned one by one, repeated ones alike; without any
labelled secret in the sample the field tags nothing; an empty table gives an empty table. Only id and
text are read.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, sampled, share_of

#: Kind, pattern, least length of the group that counts, in the order of the listing.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "field")

SAMPLE = 20_000
#: Tokens on each side of a labelled one that go into the training run.
AROUND = 8
PLAIN_RUN = 24
#: Tokens of one training run, and runs of one text, that the fit may use.
RUN_TOKENS = 64
TEXT_RUNS = 32
#: Labelled runs with another string in the secret's place, and plain runs with ordinary ids, made for the fit.
COPIES = 2_000
EPOCHS = 60
RATE = 0.4
PENALTY = 1e-3
LEAST = 6
WORDS_KEPT = 400_000
B, I, O = 0, 1, 2  # noqa: E741
_BEFORE = "\"'`([{<"
_BEHIND = "\"'`)]}>,;:."
_SHAPE = str.maketrans(
    {**{chr(c): "9" for c in range(48, 58)}, **{chr(c): "a" for c in range(97, 123)}, **{chr(c): "A" for c in range(65, 91)}}
)
_RUN = re.compile(r"(.)\1+")
_EDGES = _BEFORE + _BEHIND + "!?"
_HEXADECIMAL = frozenset(string.hexdigits)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start and kind."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _shape(word: str) -> str:
    """Classes of characters, runs as one: ``Tok3n=`` is ``Aa9a=``."""
    if word.isascii() and word.isalpha():
        if word.islower():
            return "a"
        if word[0].isupper() and word[1:].islower():
            return "Aa"
    return _RUN.sub(r"\1", word.translate(_SHAPE))


def own_key(word: str) -> tuple:
    """What the own features of a token are made of; its first and last entries are what it tells its neighbours."""
    core = word.strip(_EDGES) or word
    shape, n = _shape(core), len(core)
    sign = "=" in word or ":" in word
    if core.isalpha():
        marks, digits, hexadecimal = (0, 0, 0, False, False), 0, False
        kinds = (not core.isupper(), not core.islower(), False, False)
    else:
        digits = sum(map(str.isdigit, core))
        letters = sum(map(str.isalpha, core))
        bare = core.replace("-", "")
        hexadecimal = 0 < digits < n and _HEXADECIMAL.issuperset(bare) and letters > 0
        marks = (min(core.count("-"), 5), min(core.count("."), 3), min(core.count("/"), 4), "@" in core, "://" in core)
        kinds = ("a" in shape, "A" in shape, digits > 0, digits + letters < n)
    return shape[:6], min(n, 48), min(len(shape), 16), min(len(set(core)), 24), 8 * digits // n, kinds, marks, hexadecimal, word[0] in "\"'", sign


def own_features(key: tuple) -> list[str]:
    """Features of a token itself: its alphabet, how often it changes the class of character, how varied it is."""
    shape, n, changes, distinct, digits, kinds, (dashes, dots, slashes, at, scheme), hexadecimal, quoted, sign = key
    mix = "".join(letter for letter, held in zip("aA9*", kinds) if held)
    # Graded features hold from their bound on, so that longer or more varied tokens than those seen count as well.
    names = [f"length {t}" for t in (6, 8, 10, 12, 16, 20, 24, 32, 40) if n >= t]
    names += [f"changes {t}" for t in (3, 4, 5, 6, 8, 10, 12) if changes >= t]
    names += [f"rate {t}" for t in range(1, 7) if 8 * changes >= t * n]
    names += [f"distinct {t}" for t in (6, 8, 10, 12, 16, 20) if distinct >= t]
    names += [f"digits {t}" for t in range(1, 8) if digits >= t]
    names += [f"mix {mix}", f"mix {mix} length {min(n // 8, 4)}", f"mix {mix} changes {min(changes // 2, 6)}"]
    names += [f"{name} {count}" for name, count in (("dashes", dashes), ("dots", dots), ("slashes", slashes)) if count]
    if hexadecimal:
        names += [f"hexadecimal {min(n // 4, 8)} {dashes > 0}"]
    return [*names, f"address {at} {scheme} {mix}", f"shape {shape}", f"quoted {quoted}", f"assigns {sign}"]


def core_of(word: str) -> str:
    return word.strip("\"'.,;:!?()[]{}<>#*$%&|-=").lower()[:20]


def near_features(word: str, side: str) -> list[str]:
    """What a token says about its neighbour: the word, its shape, whether it assigns."""
    key = own_key(word)
    return [f"{side} {core_of(word)}", *_near_shape(key[0], key[-1], side)]


def _near_shape(shape: str, sign: bool, side: str) -> list[str]:
    return [f"{side} shape {shape}", f"{side} sign {sign}"]


def file_features(text: str) -> list[str]:
    """Features of the whole text."""
    n = max(len(text), 1)
    lines = text.count("\n") + 1
    return [
        f"file size {n.bit_length()}",
        f"file lines {lines.bit_length()}",
        f"file assigns {min(text.count('=') + text.count(':'), 3)}",
    ]


@dataclass(frozen=True)
class Field:
    """Tag scores of each feature seen in training, transition scores (from, to) and start scores."""

    weights: dict[str, tuple[float, float, float]]
    moves: np.ndarray
    start: np.ndarray

    def of(self, features: list[str]) -> np.ndarray:
        none = (0.0, 0.0, 0.0)
        return np.array([self.weights.get(f, none) for f in features]).sum(axis=0)


_NEVER = -1e4


def _empty_field() -> Field:
    """Tags everything O."""
    moves = np.zeros((3, 3))
    moves[:, :O] = _NEVER
    return Field({}, moves, np.array([_NEVER, _NEVER, 0.0]))


def without_context(runs: list[tuple[list[str], list[int], list[str]]]) -> list[tuple[list[str], list[int], list[str]]]:
    """Copies of the labelled runs with ordinary words of plain runs around the secret, so that shapes count alone."""
    plain = [w for words, tags, _ in runs if all(t == O for t in tags) for w in words]
    if not plain:
        return []
    copies, at = [], 0
    for words, tags, file in runs:
        if any(t != O for t in tags):
            own = []
            for word, tag in zip(words, tags):
                own.append(word if tag != O else plain[at % len(plain)])
                at += 7
            copies.append((own, tags, file))
    return copies


def _drawn(rng: random.Random, alphabet: str, least: int, most: int) -> str:
    return "".join(rng.choices(alphabet, k=rng.randint(least, most)))


def strange(rng: random.Random) -> str:
    """A random string such as secrets are: from some alphabet, alone, behind a prefix, in parts or in an address."""
    mixed = string.ascii_letters + string.digits
    form = rng.randrange(9)
    if form == 0:
        return _drawn(rng, string.hexdigits[:16], 16, 64)
    if form == 1:
        return _drawn(rng, string.digits + "ABCDEF", 16, 64)
    if form == 2:
        return _drawn(rng, mixed + "+/", 16, 64) + rng.choice(("", "=", "=="))
    if form == 3:
        return _drawn(rng, string.ascii_lowercase, 2, 4) + rng.choice("_-") + _drawn(rng, mixed, 16, 40)
    if form == 4:
        return ".".join(_drawn(rng, mixed + "_-", 12, 40) for _ in range(3))
    if form == 5:
        user, password = _drawn(rng, string.ascii_lowercase, 3, 8), _drawn(rng, mixed + "!#$%&*+-_", 8, 20)
        host = _drawn(rng, string.ascii_lowercase, 3, 9) + rng.choice((".com", ".org", ":5432", ".net/x"))
        return f"{_drawn(rng, string.ascii_lowercase, 4, 8)}://{user}:{password}@{host}"
    if form == 6:
        return _drawn(rng, mixed + "!@#$%^&*+-_?", 10, 28)
    return _drawn(rng, mixed if form == 7 else rng.choice((string.ascii_lowercase, string.ascii_uppercase)) + string.digits, 12, 48)


def ordinary(rng: random.Random, word: str) -> str:
    """An id, number, name or address that is no secret."""
    number, low = _drawn(rng, string.digits, 1, 20), word.strip(_EDGES).lower() or "x"
    form = rng.randrange(14)
    if form == 0:
        return "-".join(_drawn(rng, string.hexdigits[:16], n, n) for n in (8, 4, 4, 4, 12))
    if form == 1:
        return f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}" + rng.choice(("", "T10:20:30Z", "T08:01"))
    if form == 2:
        return ".".join(str(rng.randint(0, 255)) for _ in range(rng.choice((2, 3, 4))))
    if form == 3:
        return f"{low}.{rng.choice('abcdef')}{rng.randint(1, 99)}@{low}.org"
    if form == 4:
        return f"https://www.{low}.org/{low}/{number[:6]}" + rng.choice(("", ".html", f"/{low}-{low}"))
    if form == 5:
        return f"/{low}/{low}{rng.randint(1, 9)}/{low}.txt"
    if form == 6:
        return low + low.capitalize() + rng.choice(("", low.capitalize(), number[:2]))
    if form == 7:
        return f"{low}_{low}" + rng.choice(("", f"_{number[:3]}"))
    if form == 8:
        return low + number[:4]
    if form == 9:
        return low[:4].upper() + "-" + number[:8]
    if form == 10:
        return rng.choice(("v", "$", "+", "#", "")) + rng.choice((f"{number[:3]}.{number[:2]}", f"{number[:2]},{number[:3]}", number))
    if form == 11:
        return low + rng.choice("#$%&*!|=") * rng.randint(1, 4)
    if form == 12:
        return f"{low}-{low}-{rng.choice((low, number[:3]))}"
    return number


def made_runs(runs: list[tuple[list[str], list[int], list[str]]], copies: int = COPIES) -> list[tuple[list[str], list[int], list[str]]]:
    """Copies of labelled runs with strange strings for the secret, three of four among plain words; of plain runs with ordinary ids."""
    rng = random.Random(0)
    labelled = [r for r in runs if any(t != O for t in r[1])]
    plain = [r for r in runs if all(t == O for t in r[1])]
    words = [w for own, _, _ in plain for w in own]
    made = []
    for k in range(copies):
        own, tags, file = labelled[k % len(labelled)]
        among = bool(plain) and k % 4 > 0
        shown = [rng.choice(words) if among and t == O else w for w, t in zip(own, tags)]
        frame = rng.choice(("{}", "{}", "{}", '"{}"', "{},", "{}.", "({})"))
        shown = [w if t == O else frame.format(strange(rng)) for w, t in zip(shown, tags)]
        made.append((shown, tags, rng.choice(plain)[2] if among else file))
        if plain:
            own, tags, file = plain[rng.randrange(len(plain))]
            made.append(([ordinary(rng, w) if rng.random() < 0.2 else w for w in own], tags, file))
    return made


class _Groups:
    """Tokens with equal features, numbered once, so that a pass over the tokens touches one number each."""

    def __init__(self, names: dict[str, int]):
        self.names, self.known = names, {}
        self.pick: list[int] = []
        self.owner: list[int] = []

    def number(self, key, features) -> int:
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.known)
            picked = [self.names.setdefault(f, len(self.names)) for f in features()]
            self.pick += picked
            self.owner += [found] * len(picked)
        return found

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(self.owner, weights[self.pick, k], len(self.known)) for k in range(3)], axis=1)

    def gradient(self, of: np.ndarray, off: np.ndarray) -> np.ndarray:
        own = np.stack([np.bincount(of, off[:, k], len(self.known)) for k in range(3)], axis=1)
        return np.stack([np.bincount(self.pick, own[self.owner, k], len(self.names)) for k in range(3)], axis=1)


def _log_total(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def forward_backward(e: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition of each run, tag probabilities and expected numbers of moves; ``e`` is padded, the longest run first."""
    longest = e.shape[1]
    active = [int((lengths > t).sum()) for t in range(longest)]
    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0] + start
    for t in range(1, longest):
        n = active[t]
        alpha[:n, t] = e[:n, t] + _log_total(alpha[:n, t - 1, :, None] + moves, 1)
        alpha[n:, t] = alpha[n:, t - 1]
    for t in range(longest - 2, -1, -1):
        n = active[t + 1]
        beta[:n, t] = _log_total(moves + (e[:n, t + 1] + beta[:n, t + 1])[:, None, :], 2)
    z = _log_total(alpha[:, -1], 1)
    held = np.arange(longest) < lengths[:, None]
    p = np.exp(np.minimum(alpha + beta - z[:, None, None], 0)) * held[:, :, None]
    expected = np.zeros((3, 3))
    for t in range(1, longest):
        n = active[t]
        both = alpha[:n, t - 1, :, None] + moves + (e[:n, t] + beta[:n, t])[:, None, :] - z[:n, None, None]
        expected += np.exp(np.minimum(both, 0)).sum(axis=0)
    return z, p, expected


def train_field(runs: list[tuple[list[str], list[int], list[str]]]) -> Field:
    """``runs``: tokens, tags and file features of each training run."""
    if not any(t != O for _, tags, _ in runs for t in tags):
        return _empty_field()
    runs = sorted([*runs, *without_context(runs), *made_runs(runs)], key=lambda r: -len(r[0]))
    lengths = np.array([len(w) for w, _, _ in runs])
    longest = int(lengths[0])
    names: dict[str, int] = {}
    own_of, file_of, before_of, after_of = (_Groups(names) for _ in range(4))
    tokens, tags = [], np.full((len(runs), longest), -1)
    for r, (words, own, file) in enumerate(runs):
        text = file_of.number(tuple(file), lambda: file)  # noqa: B023
        for t, word in enumerate(words):
            key = own_key(word)
            left, right = words[t - 1] if t else None, words[t + 1] if t + 1 < len(words) else None
            tokens.append(
                (
                    own_of.number(key, lambda: own_features(key)),  # noqa: B023
                    text,
                    before_of.number(left, lambda: near_features(left, "before") if left is not None else ["first"]),  # noqa: B023
                    after_of.number(right, lambda: near_features(right, "after") if right is not None else ["last"]),  # noqa: B023
                )
            )
        tags[r, : len(own)] = own
    groups, tokens = (own_of, file_of, before_of, after_of), np.array(tokens)
    for group in groups:
        group.pick, group.owner = np.array(group.pick), np.array(group.owner)
    mask = tags >= 0
    weights, moves, start = np.zeros((len(names), 3)), np.zeros((3, 3)), np.zeros(3)
    seen = [np.full_like(weights, 1e-8), np.full_like(moves, 1e-8), np.full_like(start, 1e-8)]
    gold = np.zeros((len(runs), longest, 3))
    r, t_of = np.nonzero(mask)  # in the order of the tokens
    gold[r, t_of, tags[r, t_of]] = 1
    gold_moves = np.zeros((3, 3))
    pairs = mask[:, 1:]
    np.add.at(gold_moves, (tags[:, :-1][pairs], tags[:, 1:][pairs]), 1)

    for _ in range(EPOCHS):
        e = np.zeros((len(runs), longest, 3))
        e[r, t_of] = sum(group.scores(weights)[of] for group, of in zip(groups, tokens.T))
        m, s = moves.copy(), start.copy()
        m[O, I], s[I] = _NEVER, _NEVER
        _, p, expected = forward_backward(e, lengths, m, s)
        off = (p - gold)[r, t_of]
        g = sum(group.gradient(of, off) for group, of in zip(groups, tokens.T)) + PENALTY * weights
        steps = [(weights, g), (moves, expected - gold_moves), (start, (p - gold)[:, 0].sum(axis=0))]
        for (w, g), h in zip(steps, seen):
            h += g * g
            w -= RATE * g / np.sqrt(h)
    moves[O, I], start[I] = _NEVER, _NEVER
    return Field({name: tuple(weights[i].tolist()) for name, i in names.items()}, moves, start)


def viterbi(scores: np.ndarray, lengths: np.ndarray, field: Field) -> np.ndarray:
    """Best tags of lines laid end to end; all lines move in step, the longest first."""
    tags = np.full(len(scores), O, np.int8)
    first = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], first[order]
    keep = lengths > 0
    lengths, first = lengths[keep], first[keep]
    if not len(lengths):
        return tags
    moves = field.moves
    back = np.zeros((len(scores), 3), np.int8)
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    state = scores[first] + field.start
    for t in range(1, int(lengths[0])):
        n = active[t]
        state_n = state[:n]
        at = first[:n] + t
        new = np.empty((n, 3))
        for k in range(3):
            into = state_n + moves[:, k]
            best = into.argmax(axis=1)
            back[at, k] = best
            new[:, k] = into[np.arange(n), best]
        state[:n] = new + scores[at]
    tag = state.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        tags[at] = tag[:n]
        if t:
            tag[:n] = back[at, tag[:n]]
    return tags


def may_hold(scores: np.ndarray, starts: np.ndarray, field: Field) -> np.ndarray:
    """Which lines (by their first token) can have a best path other than all O.

    Against all O, a secret gains at most the best move into B and back to O at its begin, and the best move into I
    at each further token. If no begin gains, and all gains of I together do not make up for the best begin, O stays.
    """
    moves, stay = field.moves, field.moves[O, O]
    back = max(0.0, moves[B, O] - stay, moves[I, O] - stay)
    begin = scores[:, B] - scores[:, O] + (moves[:, B].max() - stay + back)
    begin[starts] = (scores[starts, B] - scores[starts, O]) + (max(field.start[B] - field.start[O], 0.0) + back)
    inside = scores[:, I] - scores[:, O] + (max(moves[B, I], moves[I, I]) - stay)
    best = np.maximum.reduceat(begin, starts)
    return (best >= -1e-9) | (best + np.add.reduceat(np.maximum(inside, 0.0), starts) >= -1e-9)


class _WordScores(dict):
    """Row of each distinct word in ``table``: its own, before and after scores (three tags each)."""

    def __init__(self, field: Field):
        super().__init__()
        self.field, self.table = field, np.zeros((1024, 9))
        self.own: dict[tuple, np.ndarray] = {}
        self.near: dict[tuple, np.ndarray] = {}
        self.known = {n.partition(" ")[2] for n in field.weights if n.startswith(("before ", "after "))}

    def __missing__(self, word: str) -> int:
        key = own_key(word)
        own = self.own.get(key)
        if own is None:
            own = self.own[key] = self.field.of(own_features(key))
        around = (key[0], key[-1])
        near = self.near.get(around)
        if near is None:
            sides = [self.field.of(_near_shape(*around, side)) for side in ("before", "after")]
            near = self.near[around] = np.concatenate(sides)
        row = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[row, :3], self.table[row, 3:] = own, near
        core = core_of(word)
        if core in self.known:
            self.table[row, 3:6] += self.field.of([f"before {core}"])
            self.table[row, 6:] += self.field.of([f"after {core}"])
        self[word] = row
        return row


def decode(
    texts: list[str | None], field: Field, words: _WordScores, fixed: list[list[tuple[int, int, int]]] | None = None
) -> Iterator[tuple[int, int, int]]:
    """(text number, start, end) of every decoded secret, without the tokens that touch a span of ``fixed``."""
    lines, owner = [], []
    for i, text in enumerate(texts):
        for line in text.split("\n") if text else ():
            lines.append(line)
            owner.append(i)
    if not lines:
        return
    tokens = [line.split() for line in lines]
    lengths = np.array([len(t) for t in tokens])
    ids = np.fromiter(map(words.__getitem__, chain.from_iterable(tokens)), np.int64, int(lengths.sum()))
    if not len(ids):
        return
    table = words.table
    scores = table[ids, :3]
    scores[1:] += table[ids[:-1], 3:6]
    scores[:-1] += table[ids[1:], 6:9]
    some = lengths > 0
    starts = (np.cumsum(lengths) - lengths)[some]
    ends = np.cumsum(lengths)[some] - 1
    inner = starts[1:]  # neighbours end with the line
    scores[inner] -= table[ids[inner - 1], 3:6]
    scores[starts] += field.of(["first"])
    outer = ends[:-1]
    scores[outer] -= table[ids[outer + 1], 6:9]
    scores[ends] += field.of(["last"])
    file = np.array([field.of(file_features(t)) if t else np.zeros(3) for t in texts])
    scores += np.repeat(file[np.array(owner)], lengths, axis=0)
    tags = np.full(len(scores), O, np.int8)
    open_lines = np.zeros(len(lengths), bool)
    open_lines[some] = may_hold(scores, starts, field)
    if open_lines.any():
        chosen = np.repeat(open_lines, lengths)
        tags[chosen] = viterbi(scores[chosen], lengths[open_lines], field)
    hits = np.flatnonzero(tags == B)
    if not len(hits):
        return
    line_of = np.searchsorted(np.cumsum(lengths), hits, side="right")
    first = np.cumsum(lengths) - lengths
    base: dict[int, int] = {}
    at = 0
    for n, line in enumerate(lines):  # offset of each line in its text
        if n == 0 or owner[n] != owner[n - 1]:
            at = 0
        base[n] = at
        at += len(line) + 1
    for hit, n in zip(hits.tolist(), line_of.tolist()):
        last = hit
        while last + 1 < first[n] + lengths[n] and tags[last + 1] == I:
            last += 1
        spans = [m.span() for m in re.finditer(r"\S+", lines[n])]
        own = [(a - base[n], e - base[n]) for a, _, e in fixed[owner[n]]] if fixed else []
        run: list[tuple[int, int]] = []
        for span in [*spans[hit - first[n] : last - first[n] + 1], None]:
            if span and all(span[1] <= a or span[0] >= e for a, e in own):
                run.append(span)
                continue
            if run:
                lo, hi = run[0][0], run[-1][1]
                while lo < hi and lines[n][lo] in _BEFORE:
                    lo += 1
                while lo < hi and lines[n][hi - 1] in _BEHIND:
                    hi -= 1
                if hi - lo >= LEAST:
                    yield owner[n], base[n] + lo, base[n] + hi
            run = []


def _runs(text: str) -> Iterator[tuple[list[str], list[int]]]:
    """Training runs of one text: around each labelled token, and one plain run from its first long line."""
    marked = []
    for start, kind, end in base_spans(text):
        if kind == 0:
            m = ASSIGN.match(text, start)
            marked.append((m.start(2), m.end(2)))
        else:
            marked.append((start, end))
    at, plain = 0, False
    for line in text.split("\n"):
        own = [(a - at, b - at) for a, b in marked if a < at + len(line) and b > at]
        if own:
            spans = [m.span() for m in re.finditer(r"\S+", line)]
            words = [line[a:b] for a, b in spans]
            hit = [{k for k, (x, y) in enumerate(own) if a < y and b > x} for a, b in spans]
            tags = [O if not h else I if i and h & hit[i - 1] else B for i, h in enumerate(hit)]
            yes = [i for i, h in enumerate(hit) if h]
            while yes:
                lo = max(0, yes[0] - AROUND)
                hi = yes[0] + AROUND + 1
                while hi - lo < RUN_TOKENS and any(i < hi + AROUND and i >= hi for i in yes):
                    hi += AROUND
                yield words[lo:hi], tags[lo:hi]
                yes = [i for i in yes if i >= hi]
        elif not plain:
            words = line.split()
            if len(words) > 2:
                plain = True
                yield words[:PLAIN_RUN], [O] * len(words[:PLAIN_RUN])
        at += len(line) + 1


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = SAMPLE) -> Field:
    """Fit on about ``sample`` documents, dealt by a hash of id and text (equal rows count once); one in four of those
    without a secret is used, of each text at most TEXT_RUNS runs of at most about RUN_TOKENS tokens."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    picked = sampled(rows, share_of(sample, docs.count()), ["id", "text"])
    base = picked.select("text", (F.pmod("__deal", F.lit(4)) == 0).alias("plain"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, tags, files = [], [], []
            for text, plain in zip(batch.column("text").to_pylist(), batch.column("plain").to_pylist()):
                for w, t in islice(_runs(text), TEXT_RUNS) if text else ():
                    if plain or any(x != O for x in t):
                        words.append(w)
                        tags.append(t)
                        files.append(file_features(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.string())), pa.array(tags, pa.list_(pa.int32())), pa.array(files, pa.list_(pa.string()))],
                names=["words", "tags", "file"],
            )

    rows = map_arrow(base, label, "words array<string>, tags array<int>, file array<string>").toArrow()
    runs = sorted(zip(rows.column("words").to_pylist(), rows.column("tags").to_pylist(), rows.column("file").to_pylist()))
    return train_field(runs)


def scan(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ``spans``: array of (kind, start, end), by start and kind, of every row."""
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordScores(field)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            if len(words) > WORDS_KEPT:
                words = _WordScores(field)
            texts = batch.column("text").to_pylist()
            found = [base_spans(t) for t in texts]
            for block in range(0, len(texts), 200):
                fixed = found[block : block + 200]
                for i, start, end in list(decode(texts[block : block + 200], field, words, fixed)):
                    found[block + i].append((start, 3, end))
            rows = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(own)] for own in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    id_type = base.schema["doc_id"].dataType.simpleString()
    return map_arrow(base, find, f"doc_id {id_type}, spans array<struct<kind: string, start: bigint, end: bigint>>")
