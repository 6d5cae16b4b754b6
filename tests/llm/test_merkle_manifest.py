"""Merkle manifest against a plain tree, and its defined results on odd rows."""

import hashlib
import random
import zlib

import pytest

from hitlens.llm import merkle_manifest
from hitlens.llm.common import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, tree int, `a.b` int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    parts = [r[0], r[3], r[2], r[4], text]
    return h("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def tree(nodes):
    """Root of a list of hashes, and for each the (left, right) siblings on its way up."""
    rows, at, ways = [nodes], list(range(len(nodes))), [[] for _ in nodes]
    while len(rows[-1]) > 1:
        below = rows[-1]
        for way, k in zip(ways, at, strict=True):
            first = k // 3 * 3
            way.append(("".join(below[first:k]), "".join(below[k + 1 : first + 3])))
        rows.append([h("".join(below[k : k + 3])) for k in range(0, len(below), 3)])
        at = [k // 3 for k in at]
    return rows[-1][0], ways


def plain(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified) of plain tuples."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda x: x[:3])
        trees[s] = tree([x[2] for x in by_source[s]])
    root, ups = tree([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, ups, strict=True):
        for (_, _, own, r), way in zip(by_source[s], trees[s][1], strict=True):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            acc = leaf(r, r[1].replace("\n", "")) if even and r[1] is not None else own
            for left, right in way + up:
                acc = h(left + acc + right)
            out.append((r[0], own, trees[s][0], root, h("".join(a + b for a, b in way + up)), acc, acc == root))
    return sorted(out, key=str)


def proved(df):
    """The columns of the query, from the operator."""
    out = merkle_manifest.audited(df, merkle_manifest.without_breaks())
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, h("".join(s.left + s.right for s in r.proof)), r.folded_root, r.verified) for r in out.collect()), key=str)


def documents(sizes, seed=3):
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), sum(n for _, n in sizes))
    rows = []
    for source, n in sizes:
        for _ in range(n):
            text = rng.choice([None, "", "a", "é\nb\n", "x\ny", "\n", "plain line"])
            rows.append((ids.pop(), text, rng.choice([None, "en", "de"]), source, rng.choice([None, 3, -1]), "x", 4, 5))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "sizes",
    [[("a", 1)], [("a", 3)], [("b", 4), ("a", 1), (None, 2), ("", 5), ("é", 3), ("Z", 1), ("-", 2)], [("hot", 800), ("x", 243), ("y", 244), ("z", 27), ("w", 28)]],
)
def test_proofs(spark, sizes):
    rows = documents(sizes)
    got = proved(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got == plain(rows)
    assert any(not r[-1] for r in got) or sum(n for _, n in sizes) < 4


def test_many_sources(spark):
    rows = documents([(f"s{k}", 1 + k % 2) for k in range(300)])
    assert proved(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_odd_rows(spark):
    rows = documents([("a", 5), (None, 3)])
    rows += [rows[0], rows[0], (None, "t\n", "en", "a", 1, "x", 1, 1), (None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert proved(df) == plain(rows)
    out = merkle_manifest.audited(df)
    assert set(out.columns) == {*df.columns, *merkle_manifest.PRODUCED} - {"text"}
    assert all(r.verified for r in out.collect())  # nothing altered
    assert merkle_manifest.audited(df.limit(0)).count() == 0


def test_nodes_are_nested_intervals(spark):
    leaves = spark.createDataFrame([("t", k, 800, h(str(k)), k) for k in range(800)], "tree string, rank long, n long, digest string, payload long")
    nodes = {(r.level, r.lo): r for r in merkle_manifest.Forest(leaves, "test").nodes().collect()}
    assert sum(level == 0 for level, _ in nodes) == 800 and max(level for level, _ in nodes) == 7
    for (level, lo), r in nodes.items():
        assert r.hi == min(800, lo + 3**level)
        if level:
            inside = [n for (at, _), n in nodes.items() if at == level - 1 and lo <= n.lo and n.hi <= r.hi]
            assert r.digest == h("".join(n.digest for n in sorted(inside, key=lambda n: n.lo)))


def test_query_over_one_document(spark, tmp_path):
    spark.createDataFrame(documents([("a", 1)]), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    (r,) = QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()
    assert r.leaf == r.subroot == r.root and r.proof_sha256 == h("")
