"""Best-fit packing of token sequences by the linear grouping scheme.

Only lengths matter for packing and there are at most ``capacity`` different ones, so the whole corpus is
packed through its length histogram, whatever its size:

1. Lengths over ``SMALL`` are sorted downwards and dealt into GROUPS groups of equal cardinality; each length
   is rounded up to the longest of its group.
2. The few rounded sizes are packed by configurations (which sizes share a sequence): the linear programme
   over configurations is solved by column generation, priced with a knapsack over the capacity, and rounded
   down; what the rounding leaves over goes on with the small lengths.
3. Actual documents take the places of rounded ones, the longest first, and give back the rounding.
4. The remaining lengths are placed best fit, the longest first, into the fullest sequence with room.

Sequences with equal contents are handled as one range of numbers. The result is a list of moves: the
documents of one length from rank a on go to sequences from s on, at one offset. Documents of one length are
interchangeable, so a document only needs its rank among those of its length; ranks come from counts per
task and length, not from an ordering in one task. Moves are bounded by lengths and ranges, not by documents,
which is why they may be broadcast.

A document is its token ids and then END; longer ones are cut into pieces of ``capacity`` tokens. Token ids are
those of the whole text: pieces between ASCII white space are tokenized once per distinct piece, which gives
the same ids because the tokenizer drops white space and joins nothing across it (tests compare).

Defined cases: null and empty texts have the END token only; null ids and repeated rows are packed row by row;
an empty table gives an empty table; columns other than the id are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.llm.common import map_arrow, stage

CAPACITY = 4096
END = 1
SMALL = 1536
GROUPS = 24
#: Distinct pieces of text whose ids a Python worker keeps.
PIECES = 1_500_000
#: Words tokenized in one call.
JOINED = 2_000
_SPECIAL = b"<|"
_MARKS = (b".", b",")


class PieceIds(dict):
    """Token ids (little-endian bytes) of pieces of text, each tokenized once."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _each(self, pieces: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        for piece, e in zip(pieces, found):
            self[piece] = np.array(e.ids, "<u4").tobytes()

    def _together(self, words: list[bytes]) -> None:
        """Words of letters only, as one text; each ends at its one end-of-word token."""
        ids = self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids
        ids = np.array(ids, "<u4")
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(cuts) != len(words):  # some letter folds into several words
            self._each(words)
            return
        raw, at = ids.tobytes(), 0
        for word, cut in zip(words, cuts):
            self[word], at = raw[at:cut], cut

    def learn(self, pieces: set[bytes]) -> None:
        """A final dot or comma after a letter or digit is a token of its own, so such pieces only need their stem."""
        marked = [p for p in pieces if p[-1:] in _MARKS and p[-2:-1].isalnum()]
        stems = {p[:-1] for p in marked} | set(_MARKS) | pieces.difference(marked)
        new = [p for p in stems if p not in self]
        words = [p for p in new if p.isalpha() or not p.isascii() and p.decode().isalpha()]
        for at in range(0, len(words), JOINED):
            self._together(words[at : at + JOINED])
        self._each([p for p in new if p not in self])
        for p in marked:
            self[p] = self[p[:-1]] + self[p[-1:]]

    def ids_of(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of whole texts. White space is dropped and case folded by the tokenizer as well; texts with signs
        of special tokens keep their case, which such tokens depend on."""
        if len(self) > PIECES:
            self.clear()
        rows, gaps = [], []
        for text in texts:
            words = (text if _SPECIAL in text else text.lower()).split() if text else []
            row = list(map(self.get, words))
            gaps.append([(i, words[i]) for i, v in enumerate(row) if v is None])
            rows.append(row)
        new = {word for gap in gaps for _, word in gap}
        if new:
            self.learn(new)
            for row, gap in zip(rows, gaps):
                for i, word in gap:
                    row[i] = self[word]
        return [b"".join(row) for row in rows]


#: Kept between the tasks of one Python worker.
_workers: dict[str, PieceIds] = {}


def tokenized(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, piece, start, length, crc32 of the ids, task and rank among the task's equal lengths."""
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer_path not in _workers:
            _workers[tokenizer_path] = PieceIds(tokenizer_path)
        known = _workers[tokenizer_path]
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            source = batch.column("text").cast(pa.binary())
            ids = batch.column("doc_id")
            at, out = [], {n: [] for n in ("piece", "start", "length", "crc", "rank")}
            for block in range(0, len(source), 250):
                part = known.ids_of(source.slice(block, 250).to_pylist())
                for row, data in enumerate(part, block):
                    data += end
                    for k, start in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[start : start + 4 * capacity]
                        n = len(own) // 4
                        at.append(row)
                        out["piece"].append(k)
                        out["start"].append(start // 4)
                        out["length"].append(n)
                        out["crc"].append(zlib.crc32(own))
                        out["rank"].append(int(ranks[n]))
                        ranks[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(at, pa.int64())),
                    pa.array(out["piece"], pa.int32()),
                    pa.array(out["start"], pa.int64()),
                    pa.array(out["length"], pa.int64()),
                    pa.array(out["crc"], pa.int64()),
                    pa.array(out["rank"], pa.int64()),
                    pa.array([task] * len(at), pa.int32()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "rank", "task"],
            )

    kind = base.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        base,
        pieces,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, rank bigint, task int",
    )


# --------------------------------------------------------------------------- the plan, from a histogram


def equal_groups(lengths: np.ndarray, counts: np.ndarray, groups: int) -> list[list[tuple[int, int]]]:
    """Lengths downwards dealt into groups of equal cardinality; a length may be split over groups."""
    total = int(counts.sum())
    edges = [total * k // groups for k in range(groups + 1)]
    dealt: list[list[tuple[int, int]]] = [[] for _ in range(groups)]
    done, g = 0, 0
    for length, n in zip(lengths.tolist(), counts.tolist()):
        while n:
            while done >= edges[g + 1]:
                g += 1
            take = min(n, edges[g + 1] - done)
            dealt[g].append((length, take))
            done, n = done + take, n - take
    return [d for d in dealt if d]


def _best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack: the most valuable multiset of sizes that fits."""
    best = np.zeros(capacity + 1)
    taken: list[np.ndarray] = []
    for size, value in zip(sizes.tolist(), values.tolist()):
        count = np.zeros(capacity + 1, np.int16)
        if value > 1e-12:
            old = best.copy()
            for k in range(1, capacity // size + 1):
                other = old[: capacity + 1 - k * size] + k * value
                better = other > best[k * size :] + 1e-12
                best[k * size :][better] = other[better]
                count[k * size :][better] = k
        taken.append(count)
    use = np.zeros(len(sizes), np.int64)
    room = capacity
    for i in range(len(sizes) - 1, -1, -1):
        use[i] = taken[i][room]
        room -= int(use[i]) * int(sizes[i])
    return float(best[capacity]), use


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Column generation for the configuration programme; configurations with whole numbers of sequences."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    x = demand / np.diag(basis)
    for _ in range(60 * m):
        price = inverse.sum(axis=0)
        value, column = _best_configuration(sizes, price, capacity)
        if value <= 1 + 1e-9:
            break
        d = inverse @ column
        steps = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        out = int(np.argmin(steps))
        x = x - steps[out] * d
        x[out] = steps[out]
        basis[:, out] = column
        inverse = np.linalg.inv(basis)
    whole = np.floor(np.maximum(x, 0) + 1e-7).astype(np.int64)
    left, plan = demand.astype(np.int64).copy(), []
    for j in range(m):
        use = basis[:, j].astype(np.int64)
        times = int(min([whole[j], *(left[i] // use[i] for i in np.flatnonzero(use))]))
        if times > 0:
            plan.append((use, times))
            left -= use * times
    return plan


class _Packer:
    """Ranges of sequences with equal room, and the moves made so far."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, how many)]
        self.next_sequence = 0
        self.used = np.zeros(capacity + 1, np.int64)  # documents placed, by length
        self.moves: list[tuple[int, int, int, int, int, int]] = []

    def open(self, n: int) -> tuple[int, int]:
        first = self.next_sequence
        self.next_sequence += n
        return first, n

    def move(self, length: int, first: int, n: int, each: int, offset: int) -> None:
        """``each`` documents of a length into each of ``n`` sequences."""
        self.moves.append((length, int(self.used[length]), n * each, each, first, offset))
        self.used[length] += n * each

    def leave(self, room: int, first: int, n: int) -> None:
        if room and n:
            self.rooms.setdefault(room, []).append((first, n))

    def best_fit(self, length: int, count: int) -> None:
        while count:
            fits = [r for r in self.rooms if r >= length]
            if fits:
                room = min(fits)
                ranges = self.rooms[room]
                first, n = ranges.pop()
                if not ranges:
                    del self.rooms[room]
            else:
                room = self.capacity
                first, n = self.open(-(-count // (room // length)))
            each = min(room // length, max(1, count))
            full = min(n, count // each)
            if full:
                self.move(length, first, full, each, self.capacity - room)
                self.leave(room - each * length, first, full)
                count -= full * each
            rest_first, rest = first + full, n - full
            if rest and count and count < each:  # the last few share one sequence
                self.move(length, rest_first, 1, count, self.capacity - room)
                self.leave(room - count * length, rest_first, 1)
                rest_first, rest, count = rest_first + 1, rest - 1, 0
            self.leave(room, rest_first, rest)


def plan_packing(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS):
    """Moves (length, first rank, documents, per sequence, first sequence, offset) and the number of sequences."""
    order = np.argsort(-lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    packer = _Packer(capacity)
    large = lengths > small
    left = np.zeros(capacity + 1, np.int64)
    left[lengths[~large]] = counts[~large]
    if large.any():
        dealt = equal_groups(lengths[large], counts[large], groups)
        merged: dict[int, list[tuple[int, int]]] = {}
        for g in dealt:  # groups with the same rounded size are one size
            merged.setdefault(g[0][0], []).extend(g)
        sizes = np.array(list(merged), np.int64)
        demand = np.array([sum(n for _, n in g) for g in merged.values()], np.int64)
        queue = [list(reversed(g)) for g in merged.values()]  # the longest is taken first

        def take(i: int, most: int) -> tuple[int, int]:
            length, n = queue[i].pop()
            if n > most:
                queue[i].append((length, n - most))
            return length, min(n, most)

        for use, times in configurations(sizes, demand, capacity):
            slots = [i for i in np.flatnonzero(use) for _ in range(int(use[i]))]
            ranges = [(*packer.open(times), capacity)]
            for i in slots:
                after = []
                for first, n, room in ranges:
                    while n:
                        length, got = take(i, n)
                        packer.move(length, first, got, 1, capacity - room)
                        after.append((first, got, room - length))
                        first, n = first + got, n - got
                ranges = after
            for first, n, room in ranges:
                packer.leave(room, first, n)
        for q in queue:
            for length, n in q:
                left[length] += n
    for length in range(capacity, 0, -1):
        if left[length]:
            packer.best_fit(length, int(left[length]))
    return np.array(packer.moves, np.int64).reshape(-1, 6), packer.next_sequence


# --------------------------------------------------------------------------- the operator


def pack(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(tokenized(docs, tokenizer_path, id_column, text_column, capacity))
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    per_task = stage(per_task)
    # At most ``capacity`` rows, whatever the corpus.
    histogram = per_task.groupBy("length").agg(F.sum("n").alias("n")).toPandas()
    moves, _ = plan_packing(histogram["length"].to_numpy(), histogram["n"].to_numpy(), capacity)
    moves = moves[np.lexsort((moves[:, 1], moves[:, 0]))]
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")
    )
    keys = moves[:, 0] * (1 << 44) + moves[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            m = moves[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            i = rank - m[:, 1]
            sequence, offset = m[:, 4] + i // m[:, 3], m[:, 5] + (i % m[:, 3]) * length
            columns = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        ranked,
        place,
        f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    )
