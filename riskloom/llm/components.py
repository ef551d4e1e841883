"""Connected components of a table of links, by alternating star contractions.

Each partition first replaces its links by stars (union-find over the partition, in bounded portions), which
takes out most links and nearly all length of chains. Then large-star and small-star steps alternate until
nothing changes: every node hangs its larger (or smaller) neighbours on the least one it knows. Every step is
an aggregation and a join; its result is staged, so lineage stays short and a lost executor costs one step.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, stage

#: Nodes held by one task while it contracts its links.
PORTION = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while (up := parent[x]) != top:
            parent[x], x = top, up
        return top

    def stars() -> pa.RecordBatch:
        pairs = [(n, root(n)) for n in list(parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        columns = list(zip(*pairs)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > PORTION:
            yield stars()
            parent = {}
    yield stars()


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One step; ``links`` and the result have the larger node in ``a``, the smaller in ``b``."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if larger:
        moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b, any order); root is the least reachable node."""
    links = stage(map_arrow(links.select("a", "b"), _contract, "a bigint, b bigint").distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(links)
    while True:
        links = stage(_star(_star(links, larger=True), larger=False))
        now = state(links)
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
