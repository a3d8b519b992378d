import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from emporium.llm import manifest
from tests.llm.helpers import empty_documents, odd_documents

COLS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, bump=0):
    out = ""
    for c in COLS:
        v = row[c]
        if v is not None:
            v = str(v + bump) if c == "n_chars" else str(v)
        out += "-" if v is None else f"{len(v.encode())}:{v}"
    return h(out)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        low = out[-1]
        out.append([h(*low[i:i + 2]) for i in range(0, len(low), 2)])
    return out


def path(tree, at):
    out = []
    for level in tree[:-1]:
        i = at ^ 1
        out.append((level[i] if i < len(level) else None, at & 1))
        at >>= 1
    return out


def brute(rows):
    """One tuple a row: id, leaf, subroot, root, proof, root folded from the changed leaf."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[g] = levels([leaf(r) for r in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for place, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            way = path(trees[g], at) + path(top, place)
            hit = (r["doc_id"] is not None and r["n_chars"] is not None
                   and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0)
            node = leaf(r, int(hit))
            for other, side in way:
                node = h(node) if other is None else h(other, node) if side else h(node, other)
            out.append((r["doc_id"], leaf(r), trees[g][-1][0], top[-1][0], [o for o, _ in way if o], node))
    return sorted(out, key=str)


def result(df):
    got = manifest.verify(df).collect()
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, list(r.proof), r.folded_root) for r in got], key=str), got


def table(spark, n, langs):
    rows = [(None if i % 31 == 30 else (i * 37) % 101 - 9, None if i % 5 == 0 else "s", langs[i % len(langs)],
             None if i % 11 == 0 else i, None if i % 13 == 0 else "é" * (i % 4) + "x") for i in range(n)]
    return spark.createDataFrame(rows + rows[:2], "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize("n", [1, 5, 64, 211])
def test_proofs_equal_brute_force(spark, n):
    df = table(spark, n, [None, "en", "en", "en", "de", "é", "en"])
    got, rows = result(df)
    assert got == brute([r.asDict() for r in df.collect()])
    assert all((r.copies is None) == (r.changed is None) for r in rows)
    assert all((r.folded_root == r.root) == (r.changed is None) for r in rows)


def test_a_single_leaf_is_the_root(spark):
    df = table(spark, 3, ["en"]).limit(1)
    row = manifest.verify(df).collect()[0]
    assert row.leaf == row.subroot == row.root and list(row.proof) == []


def test_versions_copy_only_ancestors_and_share_the_rest(spark):
    rows = [r for r in manifest.verify(table(spark, 211, ["en", "de"])).collect() if r.changed]
    assert len(rows) > 10
    for r in rows:
        assert r.copies[0] == r.changed and r.copies[-1] == r.folded_root
        assert len(r.copies) >= len(r.proof) + 1  # the leaf and one node a level
        assert not set(r.copies) & set(r.proof)


def test_trees_of_several_tiers_equal_one_tree(spark):
    nodes = [h(str(i)) for i in range(9000)]  # three blocks of 4096 and a tier above
    df = spark.createDataFrame([("t", i, len(nodes), x) for i, x in enumerate(nodes)],
                               "tree string, idx long, total long, hash string")
    roots, paths = manifest.forest(df, "tree")
    tree = levels(nodes)
    assert [r.hash for r in roots.collect()] == [tree[-1][0]]
    want = {b: [o for o, _ in path(tree[12:], b)] for b in range(3)}
    assert {r.block: manifest._path(r.path) for r in paths.collect()} == want


def test_odd_rows_and_empty_tables(spark):
    df = odd_documents(spark)
    assert result(df)[0] == brute([r.asDict() for r in df.collect()])
    clash = df.withColumns({c: F.lit("x") for c in ("leaf", "idx", "total", "block", "path", "root", "_nr", "changed")})
    assert result(clash)[0] == result(df)[0]
    assert manifest.verify(empty_documents(spark)).collect() == []
