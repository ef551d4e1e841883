"""Shared pieces: staging with a scope, Arrow batches of text, word hashes, joins on a hot key."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import shared_folder

#: Rows of one Arrow batch sent to Python; bounds a task's memory when texts are long.
BATCH_ROWS = 1_000
#: Distinct words kept by one Python worker before its table is emptied.
WORD_TABLE = 300_000
#: Rows up to which a counted side is sent to all executors.
BROADCAST_ROWS = 10_000
#: A key holding more than this share of all rows is hot; there are fewer than HOT_KEYS of them.
HOT_KEYS = 1_000

_scope = ["general"]


# --------------------------------------------------------------------------- staging


@contextlib.contextmanager
def staging_scope(name: str) -> Iterator[None]:
    """Tables staged inside belong to ``name`` and can be deleted together."""
    _scope.append(name)
    try:
        yield
    finally:
        _scope.pop()


def _root(spark: SparkSession, scope: str) -> str:
    return f"{shared_folder(spark)}/riskloom-llm/{spark.sparkContext.applicationId}/{scope}"


#: Spark deletes the shuffle files of a query at its end while this is set.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: one computation for several readers, lineage ends here.

    Nothing reads the query's shuffle files once the table is written, so they go at once.
    """
    spark = df.sparkSession
    path = f"{_root(spark, _scope[-1])}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def clear_scope(spark: SparkSession, scope: str) -> None:
    """Delete the tables of a scope; no unfinished DataFrame may still read them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_root(spark, scope))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# --------------------------------------------------------------------------- samples

_SPREAD = 1 << 30


def share_of(sample: int, rows: int) -> int:
    """Bound of ``__deal`` below which about ``sample`` of ``rows`` rows lie."""
    return min(_SPREAD, _SPREAD * sample // max(rows, 1))


def sampled(df: DataFrame, share: int | Column, columns: Sequence[str]) -> DataFrame:
    """Rows whose ``__deal``, a hash of ``columns`` below 2**30, is under ``share``; equal rows count once.

    The bound is one on rows, whatever the ids: a null or repeated id deals its rows by the other columns, and of
    rows equal in all ``columns`` one is left. A table of few different rows, each there very often, may leave none.
    """
    cells = [F.col(f"`{c}`") for c in columns]
    deal = F.pmod(F.xxhash64(*cells), F.lit(_SPREAD))
    picked = df.withColumn("__deal", deal).filter(F.col("__deal") < share)
    return picked.withColumn("__row", F.xxhash64(F.lit("row"), *cells)).dropDuplicates(["__row"]).drop("__row")


# --------------------------------------------------------------------------- Arrow batches


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most BATCH_ROWS rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    """A text column as UTF-8 bytes; null stays None."""
    return batch.column(name).cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """Word to 64-bit hash, computed once per distinct word."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORD_TABLE:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# --------------------------------------------------------------------------- joins


def sized(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A staged side, broadcast only if it is counted to be small."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def lookup(rows: DataFrame, values: DataFrame, key: str, how: str = "inner", total: int | None = None) -> DataFrame:
    """Join staged ``rows`` with staged ``values`` (one row per key, ``n`` = its rows) when few keys may hold most rows.

    Keys with more than ``total / HOT_KEYS`` rows, fewer than HOT_KEYS by construction, are broadcast, so their
    rows are never shuffled; the rest is an ordinary join. ``rows`` may not have a null key.
    """
    total = rows.count() if total is None else total
    floor = total // HOT_KEYS + 1
    hot = F.broadcast(values.filter(F.col("n") > floor).drop("n"))
    cold = values.filter(F.col("n") <= floor).drop("n")
    if values.filter(F.col("n") > floor).isEmpty():
        return rows.join(cold, key, how)
    rest = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(cold, key, how))
