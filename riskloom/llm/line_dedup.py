"""Line dedup: windows of three consecutive lines that occurred earlier are taken out.

Lines are the ``\\n``-split pieces of a text. Every run of three consecutive lines with at least one
non-blank line is a window, known by the 128-bit hash of its text. A text of one or two lines is one window as
a whole; it can only equal other texts of as many lines. Occurrences are ordered by document id,
then text hash, then line number; the first one stays. A line goes if any later occurrence covers it, so
overlapping occurrences merge into one removed stretch.

Defined cases: a null or blank text has no window and is returned unchanged. Rows equal in id and text are one document: they count once and both get the same result. A null id
sorts first. An empty table gives an empty table. All other columns are passed through unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import lookup, map_arrow, stage

#: Lines of one window.
WINDOW = 3
NOT_BLANK = r"[^\x20\x09-\x0D]"

_ID, _TEXT_HASH, _GONE = "__ld_id", "__ld_text", "__ld_gone"


def _windows(lines: Column) -> Column:
    """Hash of each window, the whole text if it has fewer lines; null where all its lines are blank."""

    def window(i: Column) -> Column:
        joined = F.array_join(F.slice(lines, i, WINDOW), "\n")
        return F.when(joined.rlike(NOT_BLANK), F.unhex(F.md5(joined)))

    last = F.greatest(F.size(lines) - (WINDOW - 1), F.lit(1))
    return F.when(lines.isNotNull(), F.transform(F.sequence(F.lit(1), last), window))


def later_windows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Window starts that are not the first of their kind: one row per document that has any."""
    lines = docs.select(
        F.col(id_column).alias(_ID),
        F.xxhash64(F.col(text_column)).alias(_TEXT_HASH),
        F.split(F.col(text_column), "\n").alias("lines"),
    )
    windows = lines.select(_ID, _TEXT_HASH, F.posexplode(_windows(F.col("lines"))).alias("start", "h"))
    windows = stage(windows.filter("h is not null"))
    place = F.struct(_ID, _TEXT_HASH, "start")
    kinds = stage(
        windows.groupBy("h")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
        .filter("first < last")
        .drop("last")
    )
    later = lookup(windows, kinds, "h").filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy(_ID, _TEXT_HASH).agg(F.sort_array(F.collect_set("start")).alias(_GONE))


def covered(starts: list[int], lines: int) -> set[int]:
    """Line numbers under the windows of a text."""
    return {line for s in starts for line in range(s, min(s + WINDOW, lines))}


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with the remaining text, ``n_lines`` and ``n_removed`` (lines).

    Columns of these two names in the input are replaced.
    """
    gone = later_windows(docs, id_column, text_column)
    extra = {"n_lines", "n_removed"}
    base = docs.drop(*extra)
    joined = (
        base.withColumn(_TEXT_HASH, F.xxhash64(F.col(text_column)))
        .alias("d")
        .join(
            gone.alias("g"),
            F.col(f"d.{id_column}").eqNullSafe(F.col(f"g.{_ID}"))
            & (F.col(f"d.{_TEXT_HASH}") == F.col(f"g.{_TEXT_HASH}")),
            "left",
        )
        .select("d.*", f"g.{_GONE}")
        .drop(_TEXT_HASH)
    )
    names = base.columns

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, removed = [], [], []
            column = batch.column(names.index(text_column))
            for text, starts in zip(column.to_pylist(), batch.column(_GONE).to_pylist()):
                lines = text.split("\n") if text is not None else []
                out = covered(starts, len(lines)) if starts else ()
                before.append(len(lines))
                removed.append(len(out))
                kept.append("\n".join([x for i, x in enumerate(lines) if i not in out]) if out else text)
            arrays = [
                pa.array(kept, pa.string()) if name == text_column else batch.column(i)
                for i, name in enumerate(names)
            ]
            arrays += [pa.array(before, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_lines", "n_removed"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return map_arrow(joined, rebuild, f"{fields}, n_lines bigint, n_removed bigint")


#: The same result in SQL, for unique document ids.
SQL = r"""
with lines as (
  select doc_id, string_split(text, chr(10)) as l from documents where text is not null
), spots as (
  select doc_id, l, unnest(range(1, greatest(len(l) - 1, 2))) as s from lines
), windows as (
  select doc_id, s, len(l) as n_lines, array_to_string(l[s:s+2], chr(10)) as w from spots
), kinds as (
  select w, min(doc_id * 1000000 + s) as first, count(*) as n from windows
  where regexp_matches(w, '[^\x20\x09-\x0D]') group by w having count(*) > 1
), gone as (
  select distinct doc_id, s + k as line
  from windows join kinds using (w), (select unnest([0, 1, 2]) as k)
  where doc_id * 1000000 + s <> first and s + k <= n_lines
), split_lines as (
  select doc_id, unnest(l) as x, generate_subscripts(l, 1) as line from lines
), rebuilt as (
  select doc_id, string_agg(x, chr(10) order by line) as t
  from split_lines anti join gone using (doc_id, line) group by doc_id
), counts as (
  select doc_id, count(*) as k from gone group by doc_id
)
select d.doc_id,
       case when d.text is null then 0 else len(string_split(d.text, chr(10))) end as n_lines,
       coalesce(k, 0) as n_removed,
       sha256(case when d.text is not null then coalesce(t, '') end) as kept_sha256
from documents d left join counts using (doc_id) left join rebuilt using (doc_id)
"""
