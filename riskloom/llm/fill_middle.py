"""Fill-in-middle: a text is cut into prefix, middle and suffix, and the middle is moved to the end behind marks.

The cut is drawn from a hash of the document id, so it needs no state and a lost task redraws the same one. Ids,
lengths, forms and cut places are Spark columns; only moving the pieces is a pyarrow.compute pipeline over whole
batches. A batch's texts are one flat array of units (code points) over the bytes that are there already, a list
array gives each text its units; flattened, every unit knows its text (parent index) and its ordinal in it, is
filtered by role (before the first cut, between the cuts, after the second), and what is left is rebuilt into lists
and joined. The flat arrays cover WINDOW bytes at a time, so a text of any length costs its own bytes and one
window; the pieces that a text has in several windows are joined the same way.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle).

Defined cases: a null text counts as empty, an empty text or one that holds a mark is plain, a null id draws as the
empty string. Rows that share an id share the draws, equal rows the result. A piece may be empty. Columns that are
not asked for by ``keep`` play no part, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import map_arrow

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 1
#: Of a hundred texts that could be cut, so many are; of a hundred that are cut, so many have the suffix first.
CUT_PERCENT = 90
SPM_PERCENT = 20
#: Bytes of text whose units are flat at a time.
WINDOW = 1 << 20

_TEXT, _LOW, _HIGH, _FORM = "__fm_text", "__fm_low", "__fm_high", "__fm_form"


def _checked(marks: Sequence[str]) -> None:
    """A mark can be found again only if no mark begins inside a mark or across its edge."""
    heads = {m[:1] for m in marks}
    if len(set(marks)) != 3 or "" in heads or any(c in heads for m in marks for c in m[1:]):
        raise ValueError(f"marks {marks!r}: three different ones, whose first characters occur nowhere else in them")


def _draw(digest: Column, group: int) -> Column:
    """The group-th eight hexadecimal digits as a number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


# --------------------------------------------------------------------------- pieces of a batch


def _offsets(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]


def _joined(strings: pa.Array, owner: np.ndarray, owners: int) -> pa.Array:
    """Strings with the same owner, which stand together in order, joined to one each."""
    ends = np.zeros(owners + 1, np.int32)
    np.cumsum(np.bincount(owner, minlength=owners), out=ends[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), strings), "")


def _windows(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive stretches of at most ``size`` bytes (or one code point) that end between code points."""
    start = 0
    while start < len(data):
        end = min(start + size, len(data))
        while end < len(data) and end > start and data[end] & 0xC0 == 0x80:
            end -= 1
        if end == start:
            end = start + 1
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
        yield start, end
        start = end


def pieces(texts: pa.Array, low: np.ndarray, high: np.ndarray, window: int = WINDOW) -> list[pa.Array]:
    """Units before ``low``, from there to ``high`` and from there on, of non-empty texts: three string arrays."""
    offsets, buffer = _offsets(texts), texts.buffers()[2]
    first, last = int(offsets[0]), int(offsets[-1])
    edges = offsets - first
    data = np.frombuffer(buffer, np.uint8)[first:last]
    seen = np.zeros(len(texts), np.int64)
    found: list[list[pa.Array]] = [[], [], []]
    owners: list[np.ndarray] = []
    for start, end in _windows(data, window):
        # The texts of this stretch, and where their units begin in it.
        here = np.arange(np.searchsorted(edges, start, "right") - 1, np.searchsorted(edges, end, "left"))
        raw = buffer.slice(first + start, end - start)
        octets = pa.Array.from_buffers(pa.uint8(), end - start, [None, raw])
        leads = pc.not_equal(pc.bit_wise_and(octets, pa.scalar(0xC0, pa.uint8())), pa.scalar(0x80, pa.uint8()))
        places = pc.indices_nonzero(leads).to_numpy().astype(np.int32)
        ends = np.append(places, np.int32(end - start))
        units = pa.StringArray.from_buffers(len(places), pa.py_buffer(ends), raw)
        begins = np.searchsorted(places, edges[here] - start).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.append(begins, np.int32(len(places)))), units)
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        # Ordinal of a unit: its place in the stretch, less that of its text's first unit, plus the units seen before.
        shift = pa.array(seen[here] - begins)
        ordinal = pc.add(pa.array(np.arange(len(places))), pc.take(shift, parent))
        left, right = pc.take(pa.array(low[here]), parent), pc.take(pa.array(high[here]), parent)
        before, after = pc.less(ordinal, left), pc.greater_equal(ordinal, right)
        for role, mask in enumerate((before, pc.invert(pc.or_(before, after)), after)):
            kept = pc.filter(parent, mask).to_numpy()
            found[role].append(_joined(pc.filter(flat, mask), kept, len(here)))
        owners.append(here)
        seen[here] += np.diff(np.append(begins, len(places)))
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    return [_joined(pa.concat_arrays(part) if part else pa.array([], pa.string()), owner, len(texts)) for part in found]


def _by_form(form: pa.Array, makers: dict) -> pa.Array:
    """Rows of each form made together, then put back in the order of the batch."""
    parts, places = [], []
    for name, make in makers.items():
        at = pc.indices_nonzero(pc.equal(form, name))
        if len(at):
            parts.append(make(at))
            places.append(at.to_numpy())
    if not parts:
        return pa.array([], pa.string())
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(places), kind="stable")))


def _arranged(batch: pa.RecordBatch, marks: Sequence[str], window: int) -> pa.Array:
    text, form = batch.column(_TEXT), batch.column(_FORM)
    p, s, m = marks

    def cut(at: pa.Array):
        low, high = (batch.column(c).take(at).to_numpy() for c in (_LOW, _HIGH))
        return pieces(text.take(at), low, high, window)

    def psm(at: pa.Array) -> pa.Array:
        prefix, middle, suffix = cut(at)
        return pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, "")

    def spm(at: pa.Array) -> pa.Array:
        prefix, middle, suffix = cut(at)
        return pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, "")

    return _by_form(form, {PLAIN: text.take, PSM: psm, SPM: spm})


def _halves(strings: pa.Array, mark: str) -> tuple[pa.Array, pa.Array]:
    both = pc.split_pattern(strings, mark, max_splits=1)
    return pc.list_element(both, 0), pc.list_element(both, 1)


def _rebuilt(output: pa.Array, form: pa.Array, marks: Sequence[str]) -> pa.Array:
    p, s, m = marks

    def psm(at: pa.Array) -> pa.Array:
        rest, middle = _halves(output.take(at), m)
        rest, suffix = _halves(rest, s)
        return pc.binary_join_element_wise(_halves(rest, p)[1], middle, suffix, "")

    def spm(at: pa.Array) -> pa.Array:
        rest, middle = _halves(output.take(at), m)
        rest, prefix = _halves(rest, p)
        return pc.binary_join_element_wise(prefix, middle, _halves(rest, s)[1], "")

    return _by_form(form, {PLAIN: output.take, PSM: psm, SPM: spm})


# --------------------------------------------------------------------------- the operator


def transform(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: Sequence[str] | None = None,
    seed: int = SEED,
    cut_percent: int = CUT_PERCENT,
    spm_percent: int = SPM_PERCENT,
    marks: Sequence[str] = MARKS,
) -> DataFrame:
    """The columns ``keep`` (the id unless given) with ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``."""
    _checked(marks)
    keep = [id_column] if keep is None else list(keep)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 256)
    text = F.coalesce(F.col(text_column), F.lit(""))
    kept = [F.col(c).alias(f"__fm_keep{i}") for i, c in enumerate(keep)]
    drawn = docs.select(*kept, text.alias(_TEXT), digest.alias("__fm_h")).withColumn("__fm_n", F.length(_TEXT).cast("bigint"))
    n, h = F.col("__fm_n"), F.col("__fm_h")
    a, b = (_draw(h, i) % (n + 1) for i in (0, 1))
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains(F.col(_TEXT), F.lit(mark))
    plain = (n == 0) | marked | (_draw(h, 2) % 100 >= cut_percent)
    form = F.when(plain, PLAIN).when(_draw(h, 3) % 100 < spm_percent, SPM).otherwise(PSM)
    drawn = drawn.withColumns({_LOW: F.least(a, b), _HIGH: F.greatest(a, b), _FORM: form}).drop("__fm_h")
    held = [f"__fm_keep{i}" for i in range(len(keep))]
    marks = tuple(marks)

    def arrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = [batch.column(c) for c in (*held, "__fm_n", _FORM, _LOW, _HIGH)]
                names = [*held, "__fm_n", _FORM, _LOW, _HIGH, "__fm_out"]
                yield pa.RecordBatch.from_arrays([*columns, _arranged(batch, marks, WINDOW)], names=names)

    whole = drawn.schema
    schema = T.StructType([whole[c] for c in (*held, "__fm_n", _FORM, _LOW, _HIGH)]).add("__fm_out", "string")
    moved = map_arrow(drawn, arrange, schema)
    cut = F.col(_FORM) != PLAIN
    return moved.select(
        *[F.col(h).alias(c) for h, c in zip(held, keep)],
        F.col("__fm_n").alias("n"),
        F.col(_FORM).alias("form"),
        F.when(cut, F.col(_LOW)).alias("prefix_chars"),
        F.when(cut, F.col(_HIGH) - F.col(_LOW)).alias("middle_chars"),
        F.col("__fm_out").alias("output"),
    )


def restore(transformed: DataFrame, marks: Sequence[str] = MARKS) -> DataFrame:
    """Add ``restored``: the text that ``output`` was made from, read from ``output`` and ``form`` alone."""
    _checked(marks)
    marks = tuple(marks)
    names = transformed.columns

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = _rebuilt(batch.column("output"), batch.column("form"), marks)
                yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*names, "restored"])

    schema = T.StructType(list(transformed.schema.fields)).add("restored", "string")
    return map_arrow(transformed, rebuild, schema)
