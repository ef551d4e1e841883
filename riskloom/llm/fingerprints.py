"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph is a ``\\n``-split piece of a text, empty ones included. Each is hashed to a wide vector, and the fingerprint
of a text is the sum of its paragraphs' vectors modulo powers of two, lane by lane. So order plays no part, the
fingerprint of two texts put together (with a line break) is the sum of theirs, and a paragraph is inserted or deleted
by adding or subtracting its vector, without the rest of the text.

A vector has two parts, both hashed from the paragraph alone:

* WIDE lanes modulo 2**64, all filled from one extendable hash of its bytes: different multisets of paragraphs have
  different sums but for a chance of 2**-1024 (nothing here resists a forger who may choose paragraphs at will).
* SPARSE lanes modulo 2**16, in which each run of SHINGLE words (or the whole paragraph, if shorter) adds 1 or -1 to one
  lane of its hash. Products of these sums estimate products of the word-run counts, so their cosine is a likeness of
  texts that share part of a paragraph, with an error of about SPARSE ** -0.5 (0.06).

Equal fingerprints have likeness 1. Lanes of the second part stay exact while a lane's sum is below 2**15, which is
some 10**9 words in a text; beyond that they wrap and only the likeness suffers.

Defined cases: a null text counts as empty, which is one empty paragraph. A text without words has likeness 0 to any
text of another fingerprint. Documents are ordered by id, nulls first, then by a hash of the text; rows equal in both
are neighbours, in any order, so their results agree as a multiset. The only document of a table is its own next one.
Texts of any length are hashed CHUNK bytes of paragraphs at a time. An empty table gives an empty table. Columns
beside id and text play no part, whatever their names.
"""

from __future__ import annotations

import binascii
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import WordHashes, map_arrow, mixed
from riskloom.llm.ordered import bucket_count, sortable, split_points, with_bucket

WIDE = 16
SPARSE = 256
SHINGLE = 5
#: Bytes of paragraphs hashed together.
CHUNK = 1 << 20
#: Documents whose fingerprints are made together.
TOGETHER = 256


class Vectors:
    """Sums of paragraph vectors for many bundles of paragraphs at once."""

    def __init__(self) -> None:
        self._words = WordHashes()

    def sums(self, bundles: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Wide (n x WIDE, uint64) and sparse (n x SPARSE, uint16) sums, one row per bundle."""
        wide = np.zeros((len(bundles), WIDE), np.uint64)
        sparse = np.zeros((len(bundles), SPARSE), np.uint16)
        paragraphs: list[bytes] = []
        owners: list[int] = []
        size = 0
        for owner, bundle in enumerate(bundles):
            for paragraph in bundle:
                paragraphs.append(paragraph)
                owners.append(owner)
                size += len(paragraph) + 1
                if size >= CHUNK:
                    self._add(wide, sparse, paragraphs, owners)
                    paragraphs, owners, size = [], [], 0
        if paragraphs:
            self._add(wide, sparse, paragraphs, owners)
        return wide, sparse

    def _add(self, wide: np.ndarray, sparse: np.ndarray, paragraphs: list[bytes], owners: list[int]) -> None:
        first, owner = owners[0], np.array(owners) - owners[0]
        rows = int(owner[-1]) + 1
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        lanes = b"".join(hashlib.shake_256(p).digest(8 * WIDE) for p in paragraphs)
        added = np.add.reduceat(np.frombuffer(lanes, "<u8").reshape(-1, WIDE), heads, axis=0)
        wide[first + owner[heads]] += added
        runs, of = self._shingles(paragraphs)
        if len(runs):
            lane = (runs % np.uint64(SPARSE)).astype(np.int64)
            sign = 1.0 - 2.0 * (runs >> np.uint64(63))
            counts = np.bincount(owner[of] * SPARSE + lane, weights=sign, minlength=rows * SPARSE)
            sparse[first : first + rows] += counts.astype(np.int64).astype(np.uint16).reshape(rows, SPARSE)

    def _shingles(self, paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word run, and the number of its paragraph."""
        split = [p.split() for p in paragraphs]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        total = int(lengths.sum())
        if not total:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        words = np.zeros(total + SHINGLE, np.uint64)
        words[:total] = self._words.of([w for s in split for w in s])
        of = np.repeat(np.arange(len(split)), lengths)
        begins = np.cumsum(lengths) - lengths
        place = np.arange(total) - begins[of]
        starts = np.flatnonzero(place <= np.maximum(lengths[of] - SHINGLE, 0))
        of = of[starts]
        runs = np.zeros(len(starts), np.uint64)
        with np.errstate(over="ignore"):
            for j in range(SHINGLE):
                more = j < lengths[of]
                runs = np.where(more, mixed(runs * np.uint64(0x9E3779B97F4A7C15) + words[starts + j]), runs)
        return runs, of


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row: 1 for equal fingerprints, else the cosine of the sparse parts, at least 0."""
    x, y = (part[1].astype(np.int16).astype(np.float64) for part in (a, b))
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.divide((x * y).sum(1), norm, out=np.zeros(len(x)), where=norm > 0)
    same = (a[0] == b[0]).all(1) & (a[1] == b[1]).all(1)
    return np.where(same, 1.0, np.clip(cosine, 0.0, 1.0))


def written(sums: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """Fingerprints as base64 text: the wide lanes, then the sparse ones, little endian."""
    wide, sparse = sums
    raw = [w.tobytes() + s.tobytes() for w, s in zip(wide.astype("<u8"), sparse.astype("<u2"))]
    return [binascii.b2a_base64(r, newline=False).decode() for r in raw]


def read(fingerprints: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Inverse of ``written``."""
    raw = [binascii.a2b_base64(f) for f in fingerprints]
    cut = 8 * WIDE
    wide = np.frombuffer(b"".join(r[:cut] for r in raw), "<u8").reshape(-1, WIDE)
    return wide, np.frombuffer(b"".join(r[cut:] for r in raw), "<u2").reshape(-1, SPARSE)


def changed(
    sums: tuple[np.ndarray, np.ndarray], removed: tuple[np.ndarray, np.ndarray], inserted: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints after paragraphs went and came: the lanes wrap by themselves."""
    wide, sparse = (x - gone + come for x, gone, come in zip(sums, removed, inserted))
    return wide, sparse


# --------------------------------------------------------------------------- tables


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and its fingerprint."""
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            parts = [texts[i : i + TOGETHER] for i in range(0, len(texts), TOGETHER)]
            found = [f for part in parts for f in written(vectors.sums([t.split(b"\n") for t in part]))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string())], ["id", "fingerprint"])

    kind = plain.schema["id"].dataType.simpleString()
    return map_arrow(plain, made, f"id {kind}, fingerprint string").select(F.col("id").alias(id_column), "fingerprint")


def _edit(text: str, following: str) -> tuple[str, list[bytes], list[bytes]]:
    """The edited text, and the paragraphs that go and come: those from the one on that holds the cut."""
    half = len(text) // 2
    cut = len(text) - half
    edited = text[:cut] + following[:half]
    kept = text.rfind("\n", 0, cut) + 1
    return edited, text[kept:].encode().split(b"\n"), edited[kept:].encode().split(b"\n")


def _results(vectors: Vectors, rows: list[tuple]) -> pa.RecordBatch:
    """Rows (id, text, next text) to the digest of each; the edited fingerprint follows from the first by its changes."""
    ids, texts, following = zip(*rows)
    edits = [_edit(t, f) for t, f in zip(texts, following)]
    # A document and its next one are neighbours: each text is hashed once where it stands, and once more at the end.
    distinct: dict[str, int] = {}
    place = [distinct.setdefault(t, len(distinct)) for t in texts]
    after = [distinct.setdefault(t, len(distinct)) for t in following]
    wide, sparse = vectors.sums([t.encode().split(b"\n") for t in distinct])
    own, following_sums = (wide[place], sparse[place]), (wide[after], sparse[after])
    edited = changed(own, vectors.sums([gone for _, gone, _ in edits]), vectors.sums([come for _, _, come in edits]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e, _, _ in edits], pa.string()),
            pa.array(written(own), pa.string()),
            pa.array(written(edited), pa.string()),
            pa.array(likeness(own, edited)),
            pa.array(likeness(own, following_sums)),
        ],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def edited(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document beside an edited one whose second half gives way to the beginning of the next document.

    Documents meet their next ones in buckets of the id order, sorted by Spark and read as a stream; the first row of
    a bucket is also sent to the end of the one before it, the first of all to the end of the last. So texts are
    shuffled once, and a task holds the texts of TOGETHER documents.
    """
    order = ["id", "h"]
    plain = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    plain = plain.withColumn("h", F.xxhash64("text"))
    # Structs sort by their fields, nulls first.
    total, first = plain.agg(F.count("*"), F.min(F.struct(*order))).first()
    kind = plain.schema["id"].dataType.simpleString()
    points = split_points(plain, order, total, bucket_count(plain)) if total else []
    # The least row is no split point: all of its kind would be the end of an empty bucket.
    points = [p for p in points if p != sortable(first)]
    last = len(points)
    placed = with_bucket(plain, order, points, "bucket")
    least = F.col("id").eqNullSafe(F.lit(first["id"])) & (F.col("h") == first["h"]) if total else F.lit(False)
    end = F.when(F.col("bucket_first"), F.col("bucket") - 1).when(least, F.lit(last))
    both = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("end")), F.struct(end.alias("bucket"), F.lit(True).alias("end"))
    )
    copies = F.filter(both, lambda c: c["bucket"].isNotNull())
    dealt = placed.withColumn("copy", F.explode(copies)).select("id", "h", "text", "copy.bucket", "copy.end")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "end", "id", "h")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        waiting, rows, size = None, [], 0
        for batch in batches:
            ids, buckets, ends = (batch.column(c).to_pylist() for c in ("id", "bucket", "end"))
            for doc_id, text, bucket, end in zip(ids, batch.column("text"), buckets, ends):
                text = text.as_py()
                if waiting is not None and waiting[2] == bucket:
                    rows.append((waiting[0], waiting[1], text))
                    size += len(waiting[1])
                waiting = None if end else (doc_id, text, bucket)
                if len(rows) >= TOGETHER or size >= CHUNK:
                    yield _results(vectors, rows)
                    rows, size = [], 0
        if rows:
            yield _results(vectors, rows)

    schema = (
        f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return map_arrow(dealt.select("id", "text", "bucket", "end"), stream, schema).withColumnRenamed("id", id_column)
