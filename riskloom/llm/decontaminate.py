"""Benchmark decontamination with a positional inverted index of the training text.

The index is cut by documents into segments of about SEGMENT words, each written as one row: the sorted hashes
of its terms, and per term the ascending word positions (a segment's documents are laid end to end, one
position apart). A positional list is therefore one sorted array, and building an index needs no shuffle.

A query window is looked up segment by segment. It can only occur where all its terms do. Of those that are
left, the list of the rarest term (rarest in that segment) gives the candidate starts; the lists of the
others, from the next rarest on, are shifted by their offsets in the window and intersected with them. Windows are
handled together, as arrays. Proximity matches start from the rarest term as well and follow the terms in
order, each at its next position.

Test windows are distinct by content and travel in blocks of at most BLOCK_WINDOWS, each a pass over the
stored index, so that what is broadcast has a bound while the test set may grow.

Words are lower-cased (A-Z) runs of other than ASCII non-alphanumerics. A window is WORDS consecutive words of an
item; a shorter item is one window. Defined cases: null or empty texts have no words; repeated rows are
documents of their own; items with a null id are listed as ``null``, repeated items once; an empty test
set or table gives zero hits or no rows; no other column is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WordHashes, map_arrow, stage

WORDS = 10
#: Words of one index segment; a longer document is a segment of its own.
SEGMENT = 400_000
BLOCK_WINDOWS = 100_000

_FOLD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


# --------------------------------------------------------------------------- index


class _Ordinals(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _segment(number: int, ids: list, lengths: list[int], words: list[list[bytes]]) -> dict:
    """One row of the index."""
    ordinals = _Ordinals()
    gap = np.arange(len(lengths)) + np.concatenate([[0], np.cumsum(lengths)[:-1]])
    total = int(sum(lengths))
    code = np.empty(total, np.int64)
    at = 0
    for w in words:
        code[at : at + len(w)] = np.fromiter(map(ordinals.__getitem__, w), np.int64, len(w))
        at += len(w)
    place = np.arange(total) + np.repeat(np.arange(len(lengths)), lengths)
    terms = WordHashes().of(list(ordinals))
    order = np.argsort(terms)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    both = np.sort((rank[code] << 32) | place)
    positions = (both & 0xFFFFFFFF).astype(np.uint32)
    counts = np.bincount(both >> 32, minlength=len(order)).astype(np.uint32)
    # Differences compress; the first position of a term is kept whole (the sum wraps around).
    steps = np.diff(positions, prepend=np.uint32(0))
    return {
        "segment": number,
        "ids": ids,
        "bases": gap.tolist(),
        "lengths": lengths,
        "terms": terms[order].tobytes(),
        "counts": counts.tobytes(),
        "steps": steps.tobytes(),
    }


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The stored index: segment, ids, bases, lengths, and the terms with their positions."""
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    kind = base.schema["doc_id"].dataType

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        schema, number = None, 0
        ids, lengths, words, total = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, words, total, number
            row = _segment((task << 32) | number, ids, lengths, words)
            ids, lengths, words, total, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [
                        ("segment", pa.int64()),
                        ("ids", pa.list_(batch.schema.field("doc_id").type)),
                        ("bases", pa.list_(pa.int64())),
                        ("lengths", pa.list_(pa.int64())),
                        ("terms", pa.binary()),
                        ("counts", pa.binary()),
                        ("steps", pa.binary()),
                    ]
                )
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                own = words_of(text)
                if total and total + len(own) > SEGMENT:
                    yield flush()
                ids.append(doc)
                lengths.append(len(own))
                words.append(own)
                total += len(own)
        if ids:
            yield flush()

    return map_arrow(
        base,
        build,
        f"segment bigint, ids array<{kind.simpleString()}>, bases array<bigint>, lengths array<bigint>, "
        "terms binary, counts binary, steps binary",
    )


class Segment:
    """Term lists of one index row."""

    def __init__(self, row: dict):
        self.terms = np.frombuffer(row["terms"], np.uint64)
        counts = np.frombuffer(row["counts"], np.uint32).astype(np.int64)
        self.counts = counts
        self.first = np.cumsum(counts) - counts
        self.positions = np.cumsum(np.frombuffer(row["steps"], np.uint32), dtype=np.uint32).astype(np.int64)
        self.keys = (np.repeat(np.arange(len(counts)), counts) << 32) | self.positions
        self.ids, self.bases, self.lengths = row["ids"], np.array(row["bases"]), np.array(row["lengths"])

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Number of each term in this segment, -1 where it does not occur."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        want = (term << 32) | np.maximum(position, 0)
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return (self.keys[at] == want) & (position >= 0)

    def rarest(self, term: np.ndarray, window: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start candidates from the lists of ``term``: (window, start)."""
        n = self.counts[term]
        which = np.repeat(np.arange(len(term)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return window[which], self.positions[self.first[term][which] + within] - offset[which]

    def phrases(self, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every exact occurrence; ``windows`` holds term hashes, ``sizes`` the used columns."""
        used = np.arange(windows.shape[1]) < sizes[:, None]
        term = self.find(windows)
        alive = np.flatnonzero(((term >= 0) | ~used).all(axis=1) & (sizes > 0))
        if not len(alive):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        term, used = term[alive], used[alive]
        often = np.where(used, self.counts[np.maximum(term, 0)], np.iinfo(np.int64).max)
        order = np.argsort(often, axis=1, kind="stable")
        found_w, found_s = [], []
        for part in np.array_split(np.arange(len(alive)), max(1, len(alive) // 2_000)):
            w, start = self.rarest(term[part, order[part, 0]], part, order[part, 0])
            for k in range(1, windows.shape[1]):
                if not len(w):
                    break
                offset = order[w, k]
                here = used[w, offset]
                ok = ~here | self.holds(np.maximum(term[w, offset], 0), start + offset)
                w, start = w[ok], start[ok]
            found_w.append(alive[w])
            found_s.append(start)
        return np.concatenate(found_w), np.concatenate(found_s)

    def near(self, window: np.ndarray, slop: int) -> list[tuple[int, int]]:
        """(first, last) position of the terms in order within ``len(window) + slop`` words of one document."""
        term = self.find(window)
        if (term < 0).any():
            return []
        lists = [self.positions[self.first[t] : self.first[t] + self.counts[t]] for t in term]
        reach, least = len(window) + slop, min(range(len(lists)), key=lambda i: len(lists[i]))
        first = lists[0]
        around = np.searchsorted(lists[least], first)
        close = np.minimum(around, len(lists[least]) - 1)
        first = first[(lists[least][close] >= first) & (lists[least][close] < first + reach)]
        last = first
        for own in lists[1:]:
            at = np.searchsorted(own, last, side="right")
            ok = at < len(own)
            first, last = first[ok], own[at[ok]]
        ok = last - first < reach
        first, last = first[ok], last[ok]
        same = np.searchsorted(self.bases, first, side="right") == np.searchsorted(self.bases, last, side="right")
        return list(zip(first[same].tolist(), last[same].tolist()))

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, position, side="right") - 1


# --------------------------------------------------------------------------- test windows


def windows_of(items: DataFrame, id_column: str = "item_id", text_column: str = "text", width: int = WORDS) -> DataFrame:
    """(terms binary, size, items array<string>): distinct windows with the items that hold them."""
    base = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("item"), F.col(text_column).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            item, terms, sizes = [], [], []
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                h = known.of(words_of(text))
                for w in {h[i : i + width].tobytes() for i in range(max(1, len(h) - width + 1))} if len(h) else ():
                    item.append(name)
                    terms.append(w)
                    sizes.append(len(w) // 8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.string()), pa.array(terms, pa.binary()), pa.array(sizes, pa.int32())],
                names=["item", "terms", "size"],
            )

    return map_arrow(base, cut, "item string, terms binary, size int").distinct()


def window_blocks(items: DataFrame, width: int = WORDS, **columns) -> Iterator[tuple[np.ndarray, np.ndarray, list[list[str]]]]:
    """Blocks of at most about BLOCK_WINDOWS (item, window) pairs: term hashes, sizes, items of each window."""
    pairs = stage(windows_of(items, width=width, **columns))
    blocks = max(1, -(-pairs.count() // BLOCK_WINDOWS))
    part = F.pmod(F.xxhash64("terms"), F.lit(blocks))
    for number in range(blocks):
        held: dict[bytes, list[str]] = {}
        for row in pairs.filter(part == number).select("terms", "item").toLocalIterator():
            held.setdefault(bytes(row["terms"]), []).append(row["item"])
        grid = np.zeros((len(held), width), np.uint64)
        sizes = np.zeros(len(held), np.int64)
        for i, terms in enumerate(held):
            h = np.frombuffer(terms, np.uint64)
            grid[i, : len(h)], sizes[i] = h, len(h)
        yield grid, sizes, list(held.values())


# --------------------------------------------------------------------------- matches


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Union of half-open intervals."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])
    return starts[new].tolist(), ends[last].tolist()


def matches(index: DataFrame, items: DataFrame, width: int = WORDS, **columns) -> DataFrame:
    """One row per document with a match: segment, ordinal, covered word spans, matching items."""
    results = None
    for grid, sizes, names in window_blocks(items, width, **columns):

        def search(batches: Iterator[pa.RecordBatch], grid=grid, sizes=sizes, names=names) -> Iterator[pa.RecordBatch]:
            schema = pa.schema(
                [
                    ("segment", pa.int64()),
                    ("ordinal", pa.int32()),
                    ("starts", pa.list_(pa.int64())),
                    ("ends", pa.list_(pa.int64())),
                    ("items", pa.list_(pa.string())),
                ]
            )
            for batch in batches:
                for row in batch.to_pylist():
                    segment = Segment(row)
                    window, start = segment.phrases(grid, sizes)
                    if not len(window):
                        continue
                    doc = segment.document(start)
                    order = np.argsort(doc, kind="stable")
                    window, start, doc = window[order], start[order], doc[order]
                    cuts = np.flatnonzero(np.diff(doc)) + 1
                    out = []
                    for w, s, d in zip(np.split(window, cuts), np.split(start, cuts), np.split(doc, cuts)):
                        s = s - segment.bases[d[0]]
                        a, b = merged(s, s + sizes[w])
                        held = sorted({name for k in set(w.tolist()) for name in names[k]})
                        out.append({"segment": row["segment"], "ordinal": int(d[0]), "starts": a, "ends": b, "items": held})
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

        found = map_arrow(
            index, search, "segment bigint, ordinal int, starts array<bigint>, ends array<bigint>, items array<string>"
        )
        results = found if results is None else results.unionByName(found)
    # Blocks of windows meet here, one short row per document and block.
    spans = F.flatten(F.collect_list(F.arrays_zip("starts", "ends")))
    return results.groupBy("segment", "ordinal").agg(
        F.array_sort(spans).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )


def proximity(index: DataFrame, items: DataFrame | dict[str, str], slop: int, width: int = WORDS, **columns) -> DataFrame:
    """(name, doc_id, first, last): the words of each window in order, within its length plus ``slop`` words.

    ``items`` is a table of test items, cut into windows and sent in blocks as in ``matches`` (``name`` is the item, each
    place of an item counts once), or a stated, small set of query texts by name, each taken whole.
    """
    kind = index.schema["ids"].dataType.elementType.simpleString()
    if isinstance(items, dict):
        known = WordHashes()
        hashes = [known.of(words_of(text.encode())) for text in items.values()]
        grid = np.zeros((len(hashes), max([len(h) for h in hashes], default=0)), np.uint64)
        for i, h in enumerate(hashes):
            grid[i, : len(h)] = h
        blocks = [(grid, np.array([len(h) for h in hashes], np.int64), [[name] for name in items])]
    else:
        blocks = window_blocks(items, width, **columns)
    results = None
    for grid, sizes, names in blocks:

        def search(batches: Iterator[pa.RecordBatch], grid=grid, sizes=sizes, names=names) -> Iterator[pa.RecordBatch]:
            used = np.arange(grid.shape[1]) < sizes[:, None]
            for batch in batches:
                id_type = batch.schema.field("ids").type.value_type
                place = [("first", pa.int64()), ("last", pa.int64()), ("segment", pa.int64()), ("ordinal", pa.int32())]
                schema = pa.schema([("name", pa.string()), ("doc_id", id_type), *place])
                for row in batch.to_pylist():
                    segment = Segment(row)
                    term = segment.find(grid)
                    out = []
                    for w in np.flatnonzero(((term >= 0) | ~used).all(axis=1) & (sizes > 0)).tolist():
                        for first, last in segment.near(grid[w, : sizes[w]], slop):
                            d = int(segment.document(np.array([first]))[0])
                            base = int(segment.bases[d])
                            found = {"doc_id": segment.ids[d], "first": first - base, "last": last - base}
                            found |= {"segment": row["segment"], "ordinal": d}
                            out += [{"name": name, **found} for name in names[w]]
                    yield pa.RecordBatch.from_pylist(out, schema=schema)

        found = map_arrow(index, search, f"name string, doc_id {kind}, first bigint, last bigint, segment bigint, ordinal int")
        results = found if results is None else results.unionByName(found)
    # Documents of one id stay apart; windows of an item that share a place meet.
    return results.distinct().drop("segment", "ordinal")


def _covered(spans):
    """Words in the union of sorted half-open spans."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("to"))

    def step(state, span):
        start = F.greatest(state["to"], span["starts"])
        gain = F.greatest(span["ends"] - start, F.lit(0))
        return F.struct((state["n"] + gain).alias("n"), F.greatest(state["to"], span["ends"]).alias("to"))

    return F.aggregate(spans, zero, step, lambda state: state["n"])


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items, spans (word numbers, end exclusive)."""
    index = stage(build_index(docs, id_column, text_column))
    rows = index.select("segment", F.posexplode(F.arrays_zip("ids", "lengths")).alias("ordinal", "d")).select(
        "segment", "ordinal", F.col("d.ids").alias("doc_id"), F.col("d.lengths").alias("n_words")
    )
    none = F.array().cast("array<string>")
    return rows.join(matches(index, items), ["segment", "ordinal"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce(_covered(F.col("spans")), F.lit(0)).alias("n_hit"),
        F.coalesce("items", none).alias("items"),
        F.col("spans"),
    )


#: The digest of the query in SQL, for unique document ids.
SQL = r"""
with folded as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), asked as (
  select coalesce(cast(item_id as varchar), 'null') as item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), windows as (
  select distinct item, w[s:s + 9] as t
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from asked where len(w) > 0)
), sizes as (
  select distinct len(t) as n from windows
), spots as (
  select doc_id, s, n, w[s:s + n - 1] as t
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from folded, sizes where len(w) >= n)
), hits as (
  select doc_id, s, n, item from spots join windows using (t)
), covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(s, s + n)) as p from (select distinct doc_id, s, n from hits)) group by doc_id
), listed as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hits group by doc_id
)
select f.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from folded f left join covered using (doc_id) left join listed using (doc_id)
"""
