"""Order across the whole table without one task for it: buckets between split points, positions within groups.

Split points are rows of a bounded sample, in the order of all ordering columns, so a value that many rows share is
split by the columns after it. They only balance the work; every result is exact for any split points.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows sampled for each bucket.
PER_BUCKET = 40
#: Buckets for each shuffle partition.
BUCKETS = 4


def bucket_count(df: DataFrame) -> int:
    return BUCKETS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sortable(row: Sequence) -> tuple:
    """A row as Spark sorts it: nulls first, text by code point (the same order as its UTF-8 bytes)."""
    return tuple((0, 0) if v is None else (1, v) for v in row)


def split_points(df: DataFrame, order: Sequence[str], total: int, buckets: int) -> list[tuple]:
    """At most ``buckets`` - 1 rows of ``order``, near its quantiles; about PER_BUCKET rows a bucket are sampled."""
    share = min(1.0, PER_BUCKET * buckets / max(total, 1))
    rows = df.select(*order)
    sampled = sorted({sortable(r) for r in (rows if share == 1.0 else rows.sample(False, share, 42)).collect()})
    return sorted({sampled[i * len(sampled) // buckets] for i in range(1, buckets)}) if sampled else []


def with_bucket(df: DataFrame, order: Sequence[str], points: Sequence[tuple], name: str) -> DataFrame:
    """Add the number of split points that are at most the row, and ``name``_first: whether the row equals one."""
    points = list(points)

    @F.arrow_udf("struct<bucket: int, first: boolean>")
    def place(*columns: pa.Array) -> pa.Array:
        rows = [sortable(r) for r in zip(*(c.to_pylist() for c in columns))]
        at = [bisect_right(points, r) for r in rows]
        first = [i > 0 and points[i - 1] == r for i, r in zip(at, rows)]
        return pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(first, pa.bool_())], ["bucket", "first"])

    placed = df.withColumn(name, place(*order))
    return placed.select(*df.columns, F.col(name)["bucket"].alias(name), F.col(name)["first"].alias(f"{name}_first"))


def positions(df: DataFrame, group: str, order: Sequence[str], name: str, size: str) -> DataFrame:
    """Add the row's place in its group (from 0, by ``order``) and the group's size. ``df`` is staged.

    Groups are counted per bucket, a group's bucket starts where the buckets before it end, and rows are numbered
    inside (group, bucket): a group of any size is dealt over as many tasks as it fills buckets.
    """
    at = f"{name}_bucket"
    full = [group, *order]
    points = split_points(df, full, df.count(), bucket_count(df))
    placed = with_bucket(df, full, points, at).drop(f"{at}_first")
    before = Window.partitionBy("__g").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(F.col(group).alias("__g"), F.col(at).alias("__b")).agg(F.count("*").alias("__n"))
    # At most one row a bucket for each group.
    starts = counts.select(
        "__g", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"), F.sum("__n").over(Window.partitionBy("__g")).alias(size)
    )
    joined = placed.join(starts, F.col(group).eqNullSafe(F.col("__g")) & (F.col(at) == F.col("__b")))
    inside = Window.partitionBy(group, at).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return joined.withColumn(name, F.col("__from") + F.row_number().over(inside) - 1).select(*df.columns, name, size)
