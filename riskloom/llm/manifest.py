"""Merkle manifest of a table: one tree per source, one tree over the sources, and a witness for every row.

A leaf is the digest of a row's fields. Runs of FAN consecutive nodes become their digest, level by level, until one
node is left. A witness of a leaf holds, per level, its place in its run and the digests of the run's other members.

Witnesses grow by appending: ``OpenTree`` takes leaves in order and keeps only its open runs; members of an open
run carry the partial witness that they have so far, and when a run closes each of them gets the siblings of that run
and its digest is appended one level up. On Spark an open tree covers an aligned block of FAN * FAN leaves, so blocks
of any source are built wherever they lie and no task sees a source. Block roots are then further appends: the roots of
a source, in order, are the leaves of the next round's blocks, until every source has one root, and those are the
leaves of the last tree. Partial witnesses of the rounds are appended from the top down, one row per block.

Positions come from ``ordered.positions``: a source that holds most rows is numbered by many tasks. Block rows hold at
most FAN * FAN leaves; nothing about leaves reaches the driver but a bounded sample of ordering keys.

Defined cases: a null field is encoded as ``-``, an empty text as ``0:``. Null sources are one source, the first. Null
ids sort first; rows of a source that share an id are ordered by leaf, equal leaves have neighbouring places (rows
equal in all fields share a bucket when numbered). A source of one row has its leaf as root, a table of one source that
source's root. An empty table has no rows. Columns beside the fields play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, stage
from riskloom.llm.ordered import positions

FAN = 16
#: Leaves of one block: two levels.
BLOCK = FAN * FAN
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(texts: Sequence[str]) -> str:
    return hashlib.sha256("".join(texts).encode()).hexdigest()


class OpenTree:
    """Append leaves in order; every leaf's witness is complete when ``finish`` has closed the open runs.

    A witness is a list of (place in the run, siblings joined): shared by all leaves below a child, made once.
    """

    def __init__(self) -> None:
        self.witnesses: list[list[tuple[int, str]]] = []
        self._open: list[list[tuple[str, list[list]]]] = [[]]

    def append(self, leaf: str) -> None:
        witness: list[tuple[int, str]] = []
        self.witnesses.append(witness)
        self._add(0, leaf, [witness])

    def _add(self, level: int, node: str, below: list[list]) -> None:
        if level == len(self._open):
            self._open.append([])
        self._open[level].append((node, below))
        if len(self._open[level]) == FAN:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self._open[level] = self._open[level], []
        nodes = [node for node, _ in run]
        for i, (_, below) in enumerate(run):
            siblings = "".join(nodes[:i] + nodes[i + 1 :])
            for witness in below:
                witness.append((i, siblings))
        self._add(level + 1, digest(nodes), [w for _, below in run for w in below])

    def finish(self, levels: int | None) -> str:
        """Close what is open from below; the root after ``levels`` levels, or of the whole tree."""
        level = 0
        while True:
            top = level == len(self._open) - 1 and len(self._open[level]) == 1
            if level == levels or (levels is None and top):
                return self._open[level][0][0]
            if self._open[level]:
                self._close(level)
            level += 1


def fold(leaf: str, witness: Sequence[tuple[int, str]]) -> str:
    """The root that a leaf and its witness lead to."""
    width = len(leaf)
    for place, siblings in witness:
        leaf = digest((siblings[: place * width], leaf, siblings[place * width :]))
    return leaf


def grown(leaves: Sequence[str], total: int) -> tuple[str, list[list[tuple[int, str]]]]:
    """Root and witnesses of one block among ``total`` leaves: alone it is a whole tree, else it has two levels."""
    tree = OpenTree()
    for leaf in leaves:
        tree.append(leaf)
    return tree.finish(None if total <= BLOCK else 2), tree.witnesses


# --------------------------------------------------------------------------- leaves


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[_encoded(c) for c in fields]), 256)


def _group(source: Column) -> Column:
    """Sources as text that is never null and sorts as they do, null first."""
    return F.coalesce(F.concat(F.lit("1"), source.cast("string")), F.lit("0"))


# --------------------------------------------------------------------------- rounds

_MEMBER = "place", "node"


def _blocks(nodes: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Nodes (grp, place, total, node) gathered to one row per aligned block, members in order. Staged."""
    members = F.sort_array(F.collect_list(F.struct(*_MEMBER, *carried)))
    at = F.floor(F.col("place") / BLOCK).cast("bigint")
    return stage(nodes.groupBy("grp", at.alias("block"), "total").agg(members.alias("members")))


def _roots(blocks: DataFrame) -> DataFrame:
    """One node per block, placed in the next round; ``total`` counts its fellows there. Staged."""

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("nodes").to_pylist(), batch.column("total").to_pylist())
            roots = [grown(nodes, total)[0] for nodes, total in rows]
            columns = [batch.column(c) for c in ("grp", "block", "total")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(roots, pa.string())], ["grp", "place", "total", "node"])

    plain = blocks.select("grp", "block", "total", F.col("members")["node"].alias("nodes"))
    closed = map_arrow(plain, close, "grp string, place bigint, total bigint, node string")
    return stage(closed.withColumn("total", F.ceil(F.col("total") / BLOCK).cast("bigint")))


_WITNESS = "at array<int>, siblings array<string>"


def _lowered(blocks: DataFrame, above: DataFrame, top: Sequence[str], carried: str = "") -> DataFrame:
    """One row per member: its partial witness in the block, with the block's own witness appended.

    ``above`` has one row per block: grp, block, at, siblings, and the columns ``top`` that all members take over;
    ``carried`` are fields of the members, as DDL, that go along.
    """
    fields = [f.split()[0] for f in carried.split(", ") if f]
    same = [blocks[c] == above[c] for c in ("grp", "block")]
    rows = blocks.join(above, same).select(
        blocks["grp"], "total", "members", F.col("at").alias("upper_at"), F.col("siblings").alias("upper_siblings"), *top
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in ("grp", "total", "upper_at", "upper_siblings", *top)}
                members = batch.column("members")[row].values
                leaves = members.field("node").to_pylist()
                _, witnesses = grown(leaves, one["total"])
                at = [[i for i, _ in w] + one["upper_at"] for w in witnesses]
                siblings = [[s for _, s in w] + one["upper_siblings"] for w in witnesses]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([one["grp"]] * len(leaves), pa.string()),
                        members.field("place"),
                        members.field("node"),
                        pa.array(at, pa.list_(pa.int32())),
                        pa.array(siblings, pa.list_(pa.string())),
                        *[pa.array([one[c]] * len(leaves), pa.string()) for c in top],
                        *[members.field(c) for c in fields],
                    ],
                    names=["grp", "place", "node", "at", "siblings", *top, *fields],
                )

    schema = f"grp string, place bigint, node string, {_WITNESS}"
    return map_arrow(rows, spread, ", ".join([schema, *[f"{c} string" for c in top], *[carried] * bool(carried)]))


def _tree(nodes: DataFrame, carried: Sequence[str] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round from the leaves up, and the nodes (grp, place 0, total 1, node) that are left, one per group."""
    rounds, left = [], None
    while True:
        blocks = _blocks(nodes, carried)
        rounds.append(blocks)
        roots = _roots(blocks)
        alone = roots.filter("total = 1")
        left = alone if left is None else left.unionByName(alone)
        nodes, carried = roots.filter("total > 1"), ()
        if nodes.isEmpty():
            return rounds, left


def _empty_witness(df: DataFrame) -> DataFrame:
    none = F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("siblings")
    return df.select("*", *none)


def _as_blocks(lowered: DataFrame, top: Sequence[str]) -> DataFrame:
    """Witnesses of a round's leaves, which are the blocks of the round below."""
    return lowered.select("grp", F.col("place").alias("block"), "at", "siblings", *top)


# --------------------------------------------------------------------------- the operator


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    source_column: str = "source",
    id_column: str = "doc_id",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per document: id, ``place`` in its source, ``leaf``, ``subroot``, ``root`` and the witness (``at``, ``siblings``).

    ``at`` holds the place in the run and ``siblings`` the other members' digests, joined, for each level from the leaf
    up. ``changed`` (field to expression) adds ``found``: the leaf of the row with these fields instead, for checks of
    a later state against the manifest.
    """
    now = [F.col(c) for c in fields]
    then = [(changed or {}).get(c, F.col(c)) for c in fields]
    leaves = stage(
        docs.select(
            _group(F.col(source_column)).alias("grp"),
            F.col(id_column).alias("id"),
            leaf_digest(now).alias("node"),
            *([leaf_digest(then).alias("found")] if changed else []),
        )
    )
    carried = "id " + leaves.schema["id"].dataType.simpleString() + (", found string" if changed else "")
    names = [c.split()[0] for c in carried.split(", ")]
    placed = positions(leaves, "grp", ["id", "node"], "place", "total")
    rounds, subroots = _tree(placed, names)

    # The sources' own tree: one group, a leaf per source.
    sources = stage(subroots.select(F.lit("").alias("top"), F.col("grp").alias("source"), F.col("node")))
    placed = positions(sources, "top", ["source"], "place", "total").withColumnRenamed("top", "grp")
    upper, root = _tree(placed, ["source"])
    above = _empty_witness(root.select("grp", F.col("place").alias("block"), F.col("node").alias("root")))
    for blocks in reversed(upper[1:]):
        above = stage(_as_blocks(_lowered(blocks, above, ["root"]), ["root"]))
    by_source = stage(_lowered(upper[0], above, ["root"], "source string"))

    # Each source's last round is one block, which starts from the witness of the source.
    top = ["subroot", "root"]
    last = by_source.select(
        F.col("source").alias("grp"), F.lit(0).cast("bigint").alias("block"), "at", "siblings", F.col("node").alias("subroot"), "root"
    )
    above = last
    for blocks in reversed(rounds[1:]):
        higher = stage(_as_blocks(_lowered(blocks, above, top), top))
        # Sources whose tree ended in a lower round wait for their one block there.
        above = higher.unionByName(last.join(blocks.select("grp").distinct(), "grp", "left_anti"))
    leaves_out = _lowered(rounds[0], above, top, carried)
    found = ["found"] if changed else []
    return leaves_out.select(F.col("id").alias(id_column), "place", F.col("node").alias("leaf"), "subroot", "root", "at", "siblings", *found)


def proof(siblings: Column) -> Column:
    """Digest of a witness: all siblings from the leaf's run to the last one."""
    return F.sha2(F.array_join(siblings, ""), 256)


def folded(leaf: Column, at: Column, siblings: Column) -> Column:
    """``fold`` as a Spark expression."""
    steps = F.arrays_zip(at.alias("at"), siblings.alias("siblings"))

    def step(node: Column, one: Column) -> Column:
        cut = one["at"] * 64
        before = F.substring(one["siblings"], F.lit(1), cut)
        after = F.substring(one["siblings"], cut + 1, F.length(one["siblings"]) - cut)
        return F.sha2(F.concat(before, node, after), 256)

    return F.aggregate(steps, leaf, step)
