"""Removal of every byte under a LENGTH-byte string that also starts elsewhere, by suffix arrays.

The corpus is too large for one suffix array, so strings that could be equal are first brought together. Every
LENGTH-byte string has one anchor: the last position of least hash among the CORE-byte pieces in it. Equal strings
have equal anchor pieces at equal offsets, and the strings of one anchor start next to each other, so an anchor
with its strings is one stretch of text (a fragment, about 1.25 times LENGTH). Fragments are dealt by anchor hash.

- Fragments equal as a whole repeat in all their strings. They are found by sorting, within a task's batch before
  and over all tasks after dealing, and one of them stays for the rest. So a batch sends one row for each different
  fragment however often it holds it, and the bytes it has settled travel as merged stretches, dealt evenly.
- Of anchors with several different fragments, those are fetched from the texts and concatenated, each followed by a
  separator. What all fragments of an anchor share around it becomes one weighted symbol. Their suffix array is
  built by grouping (suffix_array.py); the longest match of a suffix with any other is that with a neighbour
  in it, and a string repeats if the match is LENGTH bytes or more.

Anchors with more than GROUP different fragments (a shorter line common to very many texts) are not put into one
array: the strings of such fragments are counted by hash over the cluster, which is exact as well.

Hashes are 64 bits wide and only compared under the same anchor. Defined cases: null texts are empty; texts
under LENGTH bytes have no string and stay whole; repeated rows repeat each other; null ids are ids; an
empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, mixed, stage
from riskloom.llm.decontaminate import merged
from riskloom.llm.suffix_array import suffix_array

LENGTH = 200
CORE = 100
#: Starts of CORE-byte pieces in a string.
SPAN = LENGTH - CORE + 1
#: Bytes of a text hashed at a time; places within must fit in PLACE_BITS.
PORTION = 900_000
PLACE_BITS = 20
#: Symbols of one suffix array (whole anchors), and fragments of one anchor that go into one.
BLOCK = 150_000
GROUP = 20_000

_rng = np.random.default_rng(71)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_LOW = np.uint64((1 << PLACE_BITS) - 1)


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self):
        self.size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * self.size, 1 << 14)
            ones = np.ones(self.size, np.uint64)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = ones * np.uint64(base)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up, self.down


_powers = _Powers()


def _sums(raw: np.ndarray) -> np.ndarray:
    up, _ = _powers.upto(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    return sums


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _powers.upto(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


def fragments(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one text: anchor hash, fragment hash, first start, number of starts, anchor's place after the first start."""
    out = []
    for at in range(0, len(raw) - LENGTH + 1, PORTION):
        part = raw[at : at + PORTION + LENGTH - 1]
        sums = _sums(part)
        _, down = _powers.upto(len(sums))
        h = mixed((sums[CORE:] - sums[:-CORE]) * down[: len(sums) - CORE])
        # Low bits hold the place from behind: the least key is the least hash, and of equal ones the last.
        key = (h & ~_LOW) | (_LOW - np.arange(len(h), dtype=np.uint64))
        width = 1
        while 2 * width <= SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < SPAN:
            key = np.minimum(key[: len(key) - (SPAN - width)], key[SPAN - width :])
        anchor = (_LOW - (key & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        count = np.diff(np.append(first, len(anchor)))
        place = anchor[first]
        whole = _hash(sums, first, first + count - 1 + LENGTH)
        # Equal fragments also hold their anchor and starts alike.
        whole = mixed(whole + ((place - first) * 128 + count).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25))
        out.append((h[place], whole, first + at, count, place - first))
    return tuple(np.concatenate(x) for x in zip(*out))


# A start, a count (7 bits), an anchor place (7 bits) and 16 bits of a second row hash in one number.


def _pack(start: np.ndarray, count: np.ndarray, place: np.ndarray, check: int | np.ndarray) -> np.ndarray:
    return (((start << 7 | count) << 7 | place) << 16) | check


def _unpack(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return packed >> 30, packed >> 23 & 127, packed >> 16 & 127, packed & 0xFFFF


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, text, row, check): a row is known by 64 + 16 bits of hashes of id and text."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.col(id_column).alias("doc_id"),
        text.alias("text"),
        F.xxhash64(F.col(id_column), text).alias("row"),
        F.hash(text, F.col(id_column)).bitwiseAND(0xFFFF).alias("check"),
    )


#: A fragment of a batch; one that the batch holds more than once; a stretch of settled bytes.
SINGLE, SEVERAL, SETTLED = 0, 1, 2
_COLUMNS = ["h", "whole", "row", "packed", "state"]


def _settled(row: np.ndarray, packed: np.ndarray) -> list[np.ndarray]:
    """Columns of the merged stretches under fragments, which are in order of row and place."""
    start, count, _, check = _unpack(packed)
    end = start + count - 1 + LENGTH
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (check[1:] != check[:-1]) | (start[1:] > end[:-1]) | (start[1:] < start[:-1])])
    # Fragments of a text rise in start and end, so a stretch ends with its last one. Starts fall where the same row comes again.
    last = np.concatenate([np.flatnonzero(new)[1:], [len(new)]]) - 1
    row, start, end, check = row[new], start[new], end[last], check[new]
    spread = mixed(row.view(np.uint64) + start.astype(np.uint64)).view(np.int64)
    return [spread, end, row, _pack(start, 0, 0, check), np.full(len(row), SETTLED, np.int32)]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[], [], [], []]
        source = zip(batch.column("text").cast(pa.binary()), batch.column("row").to_pylist(), batch.column("check").to_pylist())
        for text, row, check in source:
            buffer = text.as_buffer()
            if len(buffer) < LENGTH:
                continue
            h, whole, start, count, place = fragments(np.frombuffer(buffer, np.uint8))
            for kept, values in zip(found, (h.view(np.int64), whole.view(np.int64), np.full(len(h), row), _pack(start, count, place, check))):
                kept.append(values)
        if not found[0]:
            continue
        h, whole, row, packed = (np.concatenate(x) for x in found)
        order = np.lexsort((whole, h))
        new = np.concatenate([[True], (h[order][1:] != h[order][:-1]) | (whole[order][1:] != whole[order][:-1])])
        size = np.diff(np.append(np.flatnonzero(new), len(order)))
        sent = order[new]
        columns = [h[sent], whole[sent], row[sent], packed[sent], np.where(size > 1, SEVERAL, SINGLE).astype(np.int32)]
        if (size > 1).any():
            again = np.zeros(len(order), bool)
            again[order] = np.repeat(size > 1, size)
            columns = [np.concatenate(x) for x in zip(columns, _settled(row[again], packed[again]))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_COLUMNS)


def _sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, whole). Kind 0: covered bytes, from a fragment equal to another or a settled stretch
    (``whole`` is their end). Kind 1: one of each different fragment of an anchor that has several, ``many`` if it is
    equal to another. Memory is bounded: one run is carried over."""
    names = ["kind", "h", "whole", "row", "packed", "many"]
    carry: list | None = None  # columns of the last run's first row, its weight so far, whether its anchor had a run before

    def batch_of(kind: int, columns: list[np.ndarray], many: np.ndarray) -> pa.RecordBatch:
        arrays = [np.full(len(many), kind, np.int32), *columns, many]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)

    def told_of(columns: list[np.ndarray]) -> pa.RecordBatch:
        start, count, _, _ = _unpack(columns[3])
        return batch_of(0, [columns[0], start + count - 1 + LENGTH, *columns[2:]], np.ones(len(start), bool))

    for batch in batches:
        if not batch.num_rows:
            continue
        *columns, state = (batch.column(n).to_numpy() for n in _COLUMNS)
        settled = state == SETTLED
        if settled.any():
            yield batch_of(0, [c[settled] for c in columns], np.ones(int(settled.sum()), bool))
            columns, state = [c[~settled] for c in columns], state[~settled]
            if not len(state):
                continue
        weight = 1 + (state == SEVERAL).astype(np.int64)
        told, had = 0, False  # rows at the front that were told before
        if carry is not None:
            columns = [np.concatenate([[c], x]) for c, x in zip(carry[0], columns)]
            weight = np.concatenate([[carry[1]], weight])
            told, had = int(carry[1] > 1), carry[2]
        h, whole = columns[0], columns[1]
        new_h = np.concatenate([[True], h[1:] != h[:-1]])
        new = new_h | np.concatenate([[True], whole[1:] != whole[:-1]])
        first = np.flatnonzero(new)
        size = np.add.reduceat(weight, first)
        run = np.cumsum(new) - 1
        equal = np.flatnonzero(size[run] > 1)
        equal = equal[equal >= told]
        yield told_of([c[equal] for c in columns])
        joins_previous = ~new_h[first]
        joins_previous[0] = had
        done = len(first) - 1
        joins_next = np.concatenate([~new_h[first[1:]], [False]])
        several = np.flatnonzero((joins_previous | joins_next)[:done])
        yield batch_of(1, [c[first[several]] for c in columns], size[several] > 1)
        last = first[-1]
        carry = [[c[last] for c in columns], int(min(size[-1], 2)), bool(joins_previous[-1])]
    if carry is not None and carry[2]:
        yield batch_of(1, [np.array([c]) for c in carry[0]], np.array([carry[1] > 1]))


# --------------------------------------------------------------------------- suffix arrays over fragments


def _shared(texts: list[bytes], places: list[int]) -> tuple[int, int]:
    """Bytes before and after the anchor that all fragments have in common."""
    left, right = min(places), min(len(t) - p for t, p in zip(texts, places))
    a = np.stack([np.frombuffer(t, np.uint8, left, p - left) for t, p in zip(texts, places)])
    b = np.stack([np.frombuffer(t, np.uint8, right, p) for t, p in zip(texts, places)])
    same_a = (a == a[0]).all(axis=0)[::-1]
    same_b = (b == b[0]).all(axis=0)
    return (left if same_a.all() else int(same_a.argmin())), (right if same_b.all() else int(same_b.argmin()))


def repeated_starts(groups: list[list[tuple[bytes, int, int]]]) -> list[list[np.ndarray]]:
    """For each anchor's different fragments (text, starts, anchor place): which starts repeat in another fragment.

    One suffix array over all of them. Symbols: 0 ends, 1 separates, 2-257 bytes, then one per anchor.
    """
    pieces: list[np.ndarray] = []
    begin: list[tuple[int, int, int, int]] = []  # first symbol, bytes before the shared part, its bytes, starts
    at = 0
    one = np.ones(1, np.int64)
    for number, group in enumerate(groups):
        left, right = _shared([g[0] for g in group], [g[2] for g in group])
        for text, starts, place in group:
            raw = np.frombuffer(text, np.uint8)
            head, tail = raw[: place - left].astype(np.int64) + 2, raw[place + right :].astype(np.int64) + 2
            pieces += [head, np.array([258 + number]), tail, one]
            begin.append((at, place - left, left + right, starts))
            at += len(head) + len(tail) + 2
    symbols = np.concatenate([*pieces, np.zeros(1, np.int64)])
    order = suffix_array(symbols)
    weight = np.ones(len(symbols), np.int64)
    shared = np.array([b[0] + b[1] for b in begin])
    weight[shared] = [b[2] for b in begin]
    bytes_before = np.concatenate([[0], np.cumsum(weight)])
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    # Suffixes asked for: each byte before a shared part, and the shared part.
    asked = np.concatenate([np.arange(a, a + n + 1) for a, n, _, _ in begin])
    longest = np.zeros(len(symbols), np.int64)
    for step in (-1, 1):
        r = rank[asked] + step
        ok = (r >= 0) & (r < len(order))
        mine, other = asked[ok], order[r[ok]]
        run = np.zeros(len(mine), np.int64)
        active = np.arange(len(mine))
        while len(active):
            x = symbols[mine[active] + run[active]]
            go = (x == symbols[other[active] + run[active]]) & (x > 1)
            active = active[go]
            run[active] += 1
        match = bytes_before[mine + run] - bytes_before[mine]
        longest[mine] = np.maximum(longest[mine], match)
    results, k = [], 0
    for group in groups:
        own = []
        for _ in group:
            a, n, size, starts = begin[k]
            k += 1
            s = np.arange(starts)
            inside = np.maximum(s - n, 0)  # starts within the shared part
            own.append((longest[np.minimum(a + s, a + n)] - inside >= LENGTH) & (inside <= size))
        results.append(own)
    return results


def _stretches(which: np.ndarray) -> Iterator[tuple[int, int]]:
    """Half-open runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], which.astype(np.int8), [0]])))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments sorted by (h, whole). Kind 0: covered bytes of a row. Kind 1: one string of an anchor too common."""
    names = ["kind", "row", "check", "start", "end", "h", "string"]
    out: list[tuple] = []
    waiting: list[list[tuple]] = []
    symbols = 0

    def table() -> pa.RecordBatch:
        nonlocal out
        columns = list(zip(*out)) or [()] * len(names)
        out = []
        types = [pa.int32(), *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def settle() -> None:
        nonlocal waiting, symbols
        groups = [g for g in waiting if len(g) > 1]
        if groups:
            found = repeated_starts([[(text, count, place) for _, _, text, count, place, *_ in g] for g in groups])
            for group, own in zip(groups, found):
                for (_, _, _, _, _, row, check, start, many), which in zip(group, own):
                    if not many:  # the others are covered already
                        out.extend((0, row, check, start + a, start + b - 1 + LENGTH, 0, 0) for a, b in _stretches(which))
        waiting, symbols = [], 0

    def strings(items: list[tuple]) -> None:
        """All strings of fragments of a common anchor, for counting."""
        for h, _, text, count, place, row, check, start, many in items:
            sums = _sums(np.frombuffer(text, np.uint8))
            s = np.arange(count)
            value = mixed(_hash(sums, s, s + LENGTH) + (place - s).astype(np.uint64)).view(np.int64)
            out.extend((1, row, check, start + i, -1 if many else start + i + LENGTH, h, v) for i, v in enumerate(value.tolist()))

    group: list[tuple] = []
    common = False
    last = None
    for batch in batches:
        h_col, whole_col = batch.column("h").to_pylist(), batch.column("whole").to_pylist()
        start, count, place, check = (x.tolist() for x in _unpack(batch.column("packed").to_numpy()))
        rest = zip(batch.column("text").to_pylist(), count, place, batch.column("row").to_pylist(), check, start, batch.column("many").to_pylist())
        for h, whole, item in zip(h_col, whole_col, rest):
            if last is not None and h != last[0]:
                if common:
                    strings(group)
                else:
                    waiting.append(group)
                group, common = [], False
                if symbols > BLOCK:
                    settle()
                if len(out) > 50_000:
                    yield table()
            elif last == (h, whole):
                continue  # the same row twice in the table
            last = (h, whole)
            group.append((h, whole, *item))
            symbols += len(item[0]) // 4
            if len(group) > GROUP:
                common = True
                strings(group)
                group = []
                yield table()
    if common:
        strings(group)
    elif group:
        waiting.append(group)
    settle()
    yield table()


def covered_bytes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, check, start, end): stretches of bytes under repeated strings; a row's stretches may overlap."""
    keyed = _keyed(docs, id_column, text_column)
    long = "h bigint, whole bigint, row bigint, packed bigint"
    anchors = map_arrow(keyed.select("text", "row", "check"), _anchors, f"{long}, state int")
    dealt = anchors.repartition("h").sortWithinPartitions("h", "whole")
    sorted_out = stage(map_arrow(dealt, _sorted_out, f"kind int, {long}, many boolean"))

    whole = sorted_out.filter("kind = 0").select(
        "row",
        F.col("packed").bitwiseAND(0xFFFF).alias("check"),
        F.shiftright("packed", 30).alias("start"),
        F.col("whole").alias("end"),
    )

    wanted = (
        sorted_out.filter("kind = 1")
        .withColumn("check", F.col("packed").bitwiseAND(0xFFFF).cast("int"))
        .groupBy("row", "check")
        .agg(F.collect_list(F.struct("h", "whole", "packed", "many")).alias("list"))  # anchors of one text
    )
    held = keyed.select("row", "check", "text").join(wanted.hint("shuffle_hash"), ["row", "check"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {n: [] for n in ("h", "whole", "row", "packed", "many", "text")}
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, row, items in zip(texts, batch.column("row").to_pylist(), batch.column("list").to_pylist()):
                for item in items:
                    start, count = item["packed"] >> 30, item["packed"] >> 23 & 127
                    rows["row"].append(row)
                    rows["text"].append(text[start : start + count - 1 + LENGTH])
                    for n in ("h", "whole", "packed", "many"):
                        rows[n].append(item[n])
            types = [*[pa.int64()] * 4, pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], names=list(rows))

    texts = map_arrow(held, cut, f"{long}, many boolean, text binary")
    dealt = texts.repartition("h").sortWithinPartitions("h", "whole")
    found = stage(
        map_arrow(dealt, _compare, "kind int, row bigint, check bigint, start bigint, end bigint, h bigint, string bigint")
    )
    some = found.filter("kind = 0").select("row", "check", "start", "end")
    common = found.filter("kind = 1")
    counts = common.groupBy("h", "string").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    rest = common.filter("end > 0").join(counts, ["h", "string"]).select("row", "check", "start", "end")
    return whole.unionByName(some).unionByName(rest)


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (removed bytes, end exclusive) and kept (the remaining bytes) of every row."""
    spans = (
        covered_bytes(docs, id_column, text_column)
        .groupBy("row", "check")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # anchors of one text
    )
    joined = _keyed(docs, id_column, text_column).join(spans.hint("shuffle_hash"), ["row", "check"], "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans")):
                sizes.append(len(text))
                own = []
                if spans.is_valid:
                    values = spans.values
                    a, b = merged(values.field("start").to_numpy(), values.field("end").to_numpy())
                    own = list(zip(a, b))
                    edges = [0, *(x for pair in own for x in pair), len(text)]
                    text = b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2]))
                removed.append([{"start": i, "end": j} for i, j in own])
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_arrow(
        joined.select("doc_id", "text", "spans"),
        remove,
        f"doc_id {kind}, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary",
    )
