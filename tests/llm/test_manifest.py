"""Merkle manifest against a plain recursive build of the tree."""

import hashlib
import string
import zlib

import pytest
from pyspark.sql import functions as F

from riskloom.llm import manifest
from riskloom.llm.ordered import positions
from riskloom.llm.queries import QUERIES


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text=None):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text or row["text"]]
    if text is not None:
        fields[-1] = text
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(leaves):
    """Root, and per leaf the sibling lists of all levels."""
    paths = [[] for _ in leaves]
    nodes = [(leaf, [i]) for i, leaf in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for start in range(0, len(nodes), 16):
            run = nodes[start : start + 16]
            for k, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append((k, [n for j, (n, _) in enumerate(run) if j != k]))
            above.append((H(*[n for n, _ in run]), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], paths


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row."""
    rows = [r if isinstance(r, dict) else r.asDict() for r in rows]
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    tops = {}
    for s in sources:
        own = [r for r in rows if r["source"] == s]
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        tops[s] = (own, *tree([leaf_of(r) for r in own]))
    if not sources:
        return []
    root, upper = tree([tops[s][1] for s in sources])
    out = []
    for s, above in zip(sources, upper):
        own, subroot, paths = tops[s]
        for r, path in zip(own, paths):
            steps = path + above
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
                text = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
            node = leaf_of(r) if text is None else leaf_of(r, text)
            for k, siblings in steps:
                node = H(*siblings[:k], node, *siblings[k:])
            proof = H(*[x for _, siblings in steps for x in siblings])
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def run(df):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    made = manifest.manifest(df, changed={"text": F.when(tampered, lowered).otherwise(F.col("text"))})
    made = made.withColumn("folded", manifest.folded(F.col("found"), F.col("at"), F.col("siblings")))
    made = made.select("doc_id", "leaf", "subroot", "root", manifest.proof(F.col("siblings")), "folded", F.col("folded") == F.col("root"))
    return sorted((tuple(r) for r in made.collect()), key=repr)


@pytest.mark.parametrize("n", [0, 1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4097])
def test_open_tree(n):
    leaves = [H(str(i)) for i in range(n)]
    if not n:
        return
    root, paths = tree(leaves)
    if n <= manifest.BLOCK:
        got, witnesses = manifest.grown(leaves, n)
        assert got == root
        assert [[(k, "".join(s)) for k, s in p] for p in paths] == witnesses
    grown = manifest.OpenTree()
    for leaf in leaves:
        grown.append(leaf)
    assert grown.finish(None) == root
    for leaf, witness, path in zip(leaves, grown.witnesses, paths):
        assert [(k, "".join(s)) for k, s in path] == witness
        assert manifest.fold(leaf, witness) == root


def test_levels_of_a_block_among_others():
    leaves = [H(str(i)) for i in range(17)]
    assert manifest.grown(leaves[:1], 1000)[0] == H(H(leaves[0]))
    assert manifest.grown(leaves, 1000)[0] == H(H(*leaves[:16]), H(leaves[16]))
    assert manifest.grown(leaves[:16], 1000)[0] == H(H(*leaves[:16]))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, sizes):
    """Rows per source; ids interleave the sources."""
    rows, i = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append(((i * 7919) % 1_000_003, f"Text {i} Ä", None if i % 5 else "en", source, i if i % 3 else None))
            i += 1
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1},
        {"a": 1, None: 1},
        {"a": 16, "b": 17, None: 3, "": 2, "Ä": 1, "z": 256, "é": 257},
        {"hot": 4500, "a": 300, None: 20},
        {f"s{i}": 1 + i % 3 for i in range(300)},
    ],
)
def test_equals_brute_force(spark, sizes):
    df = table(spark, sizes)
    assert run(df.repartition(5)) == brute(df.collect())


def test_three_rounds(spark):
    df = table(spark, {"hot": 66_000, "b": 2})
    got = run(df)
    want = brute(df.collect())
    assert len(got) == 66_002 and got == want


def test_nulls_ties_repeats_and_clashes(spark, make_docs, clashing):
    rows = [(None, None, None, None, None), (None, "", None, "s", 0), (5, "A", "x", "s", 1), (5, "A", "x", "s", 1), (5, "B", "x", "s", 1)]
    rows += [(0, None, "x", "s", 1), (10, "ABC", "", "", -4), (2**62, "Big", "l", "s", 2**62), (2**62 + 1, "Big", "l", "s", 1)]
    rows += [(i, "X" * 50_000, "x", None, 1) for i in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows and df.collect())
    assert run(df) == want
    extra = clashing | {"node": 1, "place": 2, "total": 3, "grp": "g", "id": 9, "found": "f", "at": 1, "members": "m"}
    assert run(df.withColumns({k: F.lit(v) for k, v in extra.items()})) == want
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_positions_split_a_hot_group(spark):
    df = spark.createDataFrame([("h" if i % 3 else "c", (i * 37) % 5000) for i in range(5000)], "g string, k long").checkpoint()
    got = positions(df, "g", ["k"], "at", "size").collect()
    for g in "hc":
        own = sorted((r.k, r.at) for r in got if r.g == g)
        assert [a for _, a in own] == list(range(len(own)))
        assert {r.size for r in got if r.g == g} == {len(own)}


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = QUERIES["op13_merkle_manifest"](spark, sf_dir)
    assert got.columns == names
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs)
