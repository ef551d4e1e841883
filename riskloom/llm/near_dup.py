"""Near-duplicate documents: MinHash signatures, a multi-index Hamming join, exact confirmation, components.

Every distinct shingle set (exact copies are one class from the start) has a signature of SYMBOLS MinHash
values, BITS bits each. The signature is cut into chunks of CHUNK symbols. If two signatures differ in at
most ``SYMBOLS/CHUNK * 2 - 1`` symbols, then by the pigeonhole principle some chunk differs in at most one
symbol. All ways to be wrong in one symbol are enumerated by leaving each symbol of a chunk out in turn: such
a pair meets under at least one of these keys. (Pairs further apart usually meet too and are not turned away
before DISTANCE, at which a pair of the wanted similarity arrives with probability below 1e-6.)

Pairs of one bucket are not all written out. First every member is paired with the bucket's first. These
pairs, if close enough by signature, are confirmed on full shingle sets, and components are formed. Only buckets in
which several components meet can hold an unknown link between them; their members are compared across
components inside tasks (large buckets in a grid of blocks), by signature and then by their least shingle hashes:
a pair that could still be a link is confirmed on full sets as well, and pairs that cannot are not written
anywhere. A pair is looked at under the first of its common keys only. So no candidate that matters to a component
goes unconfirmed and none is capped.

Words are runs of other than ASCII white space, A-Z lower-cased. Defined cases: texts without words have no
shingles, are linked with nothing and are their own component; a text of fewer words than a shingle has its
whole word sequence as one; rows equal in text are one class; null ids take part but name a component only if
it has no other id; an empty table gives an empty table. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WordHashes, lookup, map_arrow, mixed, stage
from riskloom.llm.components import components

SYMBOLS = 60
BITS = 16
CHUNK = 6
DISTANCE = 27
#: Least shingle hashes kept of each set; a set of no more is kept whole.
SKETCH = 192
#: Standard deviations that an estimate from sketches may fall short of the similarity.
SLACK = 4.5
#: Members of one block of a bucket when its components are compared.
BLOCK = 2_000
#: Pairs confirmed against one copy of a document; a document in more pairs is replicated.
PER_COPY = 5_000

_rng = np.random.default_rng(20240917)
_MULTIPLY = (_rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, SYMBOLS, dtype=np.uint64).astype(np.uint32)
_PRIMES = _rng.integers(0, 1 << 63, CHUNK, dtype=np.uint64) | np.uint64(1)
_NUMBER = np.uint64(63)


def shingle_set(text: bytes | None, width: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = known.of(words)
    n = max(1, len(h) - width + 1)
    value = np.full(n, min(len(h), width), np.uint64)
    for k in range(min(width, len(h))):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(value)


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.empty(SYMBOLS, np.uint32)
    for i in range(SYMBOLS):
        least[i] = (x * _MULTIPLY[i] + _ADD[i]).min()
    return (mixed(least.astype(np.uint64) + np.uint64(1)) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def signatures(docs: DataFrame, width: int, id_column: str, text_column: str) -> DataFrame:
    """doc_id, n_shingles, set_hash (null without shingles), signature and least hashes of every row."""
    base = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            count, hashes, signs, least = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                s = shingle_set(text, width, known)
                count.append(len(s))
                hashes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                signs.append(signature(s).tobytes() if len(s) else None)
                least.append((s[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), *(pa.array(x, pa.binary()) for x in (hashes, signs, least))],
                names=["doc_id", "n_shingles", "set_hash", "signature", "least"],
            )

    kind = base.schema["doc_id"].dataType.simpleString()
    return map_arrow(base, sign, f"doc_id {kind}, n_shingles bigint, set_hash binary, signature binary, least binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def bucket_keys(matrix: np.ndarray) -> np.ndarray:
    """One key per chunk and left-out symbol: rows x SYMBOLS. The lowest bits hold the number of the key."""
    keys = np.empty((len(matrix), SYMBOLS), np.uint64)
    for c in range(SYMBOLS // CHUNK):
        part = (matrix[:, c * CHUNK : (c + 1) * CHUNK].astype(np.uint64) + np.uint64(1)) * _PRIMES
        part = mixed(part)
        whole = part.sum(axis=1, dtype=np.uint64)
        for k in range(CHUNK):
            number = c * CHUNK + k
            value = mixed(whole - part[:, k] + np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
            keys[:, number] = value & ~_NUMBER | np.uint64(number)
    return keys


def first_common_key(differ: np.ndarray) -> np.ndarray:
    """Number of the first key that pairs share, from rows of differing symbols; SYMBOLS if none."""
    chunks = differ.reshape(len(differ), SYMBOLS // CHUNK, CHUNK)
    wrong = chunks.sum(axis=2)
    number = np.where(wrong == 1, chunks.argmax(axis=2), 0) + np.arange(SYMBOLS // CHUNK) * CHUNK
    return np.where(wrong <= 1, number, SYMBOLS).min(axis=1)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = bucket_keys(_matrix(batch.column("signature"))).view(np.int64)
            ids = np.repeat(batch.column("cid").to_numpy(), SYMBOLS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "cid"])


def _first_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and cid: every member of a bucket with the bucket's first."""
    key, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        k, c = batch.column("key").to_numpy(), batch.column("cid").to_numpy()
        new = np.concatenate([[k[0] != key], k[1:] != k[:-1]]) if key is not None else np.concatenate([[True], k[1:] != k[:-1]])
        start = np.where(new, np.arange(len(k)), -1)
        start = np.maximum.accumulate(start)
        a = np.where(start >= 0, c[np.maximum(start, 0)], first if first is not None else 0)
        key, first = k[-1], a[-1]
        keep = ~new & (a != c)
        yield pa.RecordBatch.from_arrays([pa.array(k[keep]), pa.array(a[keep]), pa.array(c[keep])], names=["key", "a", "b"])


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Runs of equal values in sorted columns ``names``; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        grid = np.stack([batch.column(n).to_numpy() for n in names])
        cuts = [0, *(np.flatnonzero((grid[:, 1:] != grid[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            own = tuple(grid[:, lo].tolist())
            if held and own != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = own
    if held:
        yield pa.Table.from_batches(held)


class _Sketches:
    """Least hashes of the members of a group, for one member against others."""

    def __init__(self, column: pa.Array, sizes: np.ndarray):
        raw = [np.frombuffer(x, np.uint32) for x in column.to_pylist()]
        self.sets, self.sizes = raw, sizes
        self.flat = np.concatenate(raw)
        lengths = np.array([len(x) for x in raw])
        self.start = np.cumsum(lengths) - lengths
        # Everything up to its bound is known of a set.
        self.bound = np.array([x[-1] if len(x) < n else (1 << 32) - 1 for x, n in zip(raw, sizes)], np.uint32)
        self.names, self.code = np.unique(self.flat, return_inverse=True)

    def may_link(self, one: int, others: np.ndarray, percent: int) -> np.ndarray:
        """False where the known hashes rule the similarity out."""
        mine = np.zeros(len(self.names), bool)
        mine[self.code[self.start[one] : self.start[one] + len(self.sets[one])]] = True
        bound = np.minimum(self.bound[others], self.bound[one])
        joint = np.empty(len(others), np.int64)
        theirs = np.empty(len(others), np.int64)
        own = np.searchsorted(self.sets[one], bound, side="right")
        for k, other in enumerate(others.tolist()):
            n = int(np.searchsorted(self.sets[other], bound[k], side="right"))
            at = self.start[other]
            theirs[k], joint[k] = n, np.count_nonzero(mine[self.code[at : at + n]])
        seen = own + theirs - joint
        wanted = percent / 100
        union = (self.sizes[one] + self.sizes[others]) / (1 + wanted)
        spread = np.sqrt(wanted * (1 - wanted) / np.maximum(seen, 1) * np.maximum(0, 1 - seen / union))
        return joint >= (wanted - SLACK * spread) * seen - 1


def _across(percent: int):
    """Pairs of different components that may be links, within each (key, g, h) group."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, ["key", "g", "h"]):
            table = table.combine_chunks()
            cid, comp, block, size = (table.column(n).to_numpy() for n in ("cid", "comp", "block", "n_shingles"))
            matrix = _matrix(table.column("signature"))
            g, h = table.column("g")[0].as_py(), table.column("h")[0].as_py()
            number = table.column("key")[0].as_py() & int(_NUMBER)
            _, inverse, counts = np.unique(comp, return_inverse=True, return_counts=True)
            # Each pair once: members of the largest component do not ask, and of two that ask the later one does.
            asks = inverse != np.argmax(counts)
            sketches = None
            found_a, found_b = [], []
            for q in np.flatnonzero(asks):
                other = comp != comp[q]
                other[:q] &= ~asks[:q]
                if g != h:
                    other &= block != block[q]
                other &= (100 * np.minimum(size, size[q]) >= percent * np.maximum(size, size[q]))
                other = np.flatnonzero(other)
                differ = matrix[other] != matrix[q]
                near = differ.sum(axis=1) <= DISTANCE
                near[near] = first_common_key(differ[near]) == number
                other = other[near]
                if len(other):
                    sketches = sketches or _Sketches(table.column("least"), size)
                    other = other[sketches.may_link(q, other, percent)]
                    found_a.append(np.minimum(cid[other], cid[q]))
                    found_b.append(np.maximum(cid[other], cid[q]))
            if found_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found_a)), pa.array(np.concatenate(found_b))], names=["a", "b"]
                )

    return compare


def near_signatures(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures differ in at most DISTANCE symbols and whose sizes allow the similarity."""
    side = classes.select("cid", "signature", "n_shingles")
    left = side.select(F.col("cid").alias("a"), F.col("signature").alias("sa"), F.col("n_shingles").alias("na"))
    right = side.select(F.col("cid").alias("b"), F.col("signature").alias("sb"), F.col("n_shingles").alias("nb"))
    joined = pairs.join(left, "a").join(right, "b")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                differ = (_matrix(batch.column("sa")) != _matrix(batch.column("sb"))).sum(axis=1)
                yield batch.select(["a", "b", "na", "nb"]).filter(pa.array(differ <= DISTANCE))

    return map_arrow(joined.select("a", "b", "sa", "sb", "na", "nb"), close, "a bigint, b bigint, na bigint, nb bigint")


def confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, id_column: str, text_column: str) -> DataFrame:
    """The staged pairs (a, b) whose full shingle sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = wanted.join(classes.select("cid", F.col("rep").alias("__rep"), "set_hash"), "cid")
    source = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
    held = source.join(wanted, F.col("__id").eqNullSafe(F.col("__rep"))).select("cid", "set_hash", "text")
    held = stage(held)
    count = pairs.groupBy("a").agg((F.floor((F.count("*") - 1) / PER_COPY) + 1).cast("int").alias("copies"))
    texts = held.select("cid", "set_hash", "text")
    hubs = texts.join(count.withColumnRenamed("a", "cid"), "cid").select(
        F.col("cid").alias("a"),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        F.lit(-1).cast("bigint").alias("b"),
        "set_hash",
        "text",
    )
    leaves = (
        pairs.select("a", "b")
        .join(count, "a")
        .withColumn("copy", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int"))
        .join(texts.withColumnRenamed("cid", "b"), "b")
        .select("a", "copy", "b", "set_hash", "text")
    )
    both = hubs.unionByName(leaves)
    both = both.repartition("a", "copy").sortWithinPartitions("a", "copy", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        hub, mine = None, None
        for batch in batches:
            out_a, out_b = [], []
            columns = (batch.column(n).to_pylist() for n in ("a", "b", "set_hash"))
            for a, b, own_hash, text in zip(*columns, batch.column("text").cast(pa.binary()).to_pylist()):
                own = shingle_set(text, width, known)
                if xxhash.xxh3_128_digest(own.tobytes()) != own_hash:
                    continue  # another row with the same id
                if b < 0:
                    hub, mine = a, own
                elif hub == a:
                    joint = len(np.intersect1d(mine, own, assume_unique=True))
                    if 100 * joint >= percent * (len(mine) + len(own) - joint):
                        out_a.append(a)
                        out_b.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    return stage(map_arrow(both, compare, "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row, for ``width``-word shingles and ``percent``."""
    signed = stage(signatures(docs, width, id_column, text_column))
    classes = (
        signed.filter("set_hash is not null")
        .groupBy("set_hash")
        .agg(
            F.min("doc_id").alias("rep"),
            F.count("*").alias("n"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
            F.first("least").alias("least"),
        )
        .withColumn("cid", F.monotonically_increasing_id())
    )
    classes = stage(classes)
    keys = map_arrow(classes.select("cid", "signature"), _keys, "key bigint, cid bigint")
    sorted_keys = keys.repartition("key").sortWithinPartitions("key", "cid")
    firsts = stage(map_arrow(sorted_keys, _first_pairs, "key bigint, a bigint, b bigint"))

    fits = (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    pairs = stage(near_signatures(firsts.select("a", "b").distinct(), classes).filter(fits).select("a", "b"))
    links = confirm(pairs, classes, docs, width, percent, id_column, text_column)
    grouped = stage(components(links))

    # Buckets of three and more in which several components meet.
    members = firsts.select("key", F.col("b").alias("cid")).unionByName(
        firsts.groupBy("key").agg(F.first("a").alias("cid"), F.count("*").alias("k")).filter("k > 1").select("key", "cid")
    )
    members = members.join(grouped.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "comp", F.coalesce("root", "cid")
    )
    mixed_up = members.groupBy("key").agg(F.count("*").alias("k"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed_up = mixed_up.filter("k > 2 and lo < hi").select("key", F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks"))
    open_members = (
        members.join(mixed_up, "key")
        .join(classes.select("cid", "signature", "n_shingles", "least"), "cid")
        .withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "key", F.least("block", "other").alias("g"), F.greatest("block", "other").alias("h"), "cid", "comp", "block", "n_shingles",
            "signature", "least",
        )
    )
    dealt = open_members.repartition("key", "g", "h").sortWithinPartitions("key", "g", "h")
    more = stage(map_arrow(dealt, _across(percent), "a bigint, b bigint").distinct().join(pairs, ["a", "b"], "left_anti"))
    if not more.isEmpty():
        extra = confirm(more, classes, docs, width, percent, id_column, text_column)
        if not extra.isEmpty():
            stars = grouped.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
            grouped = stage(components(stars.unionByName(extra)))

    named = classes.join(grouped.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = stage(named.select("set_hash", "n", "root", "rep"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    values = stage(named.join(least, "root").select("set_hash", "n", "component_id"))
    with_set = signed.filter("set_hash is not null").select("doc_id", "n_shingles", "set_hash")
    found = lookup(with_set, values, "set_hash").select("doc_id", "n_shingles", "component_id")
    alone = signed.filter("set_hash is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
