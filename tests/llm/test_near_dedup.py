import random

import numpy as np
import pytest

from emporium.llm import near_dedup
from emporium.llm.components import components
from tests.llm.helpers import empty_documents, odd_documents, prose, words


def brute(rows, size, percent):
    """(doc_id -> (set size, smallest reachable id)) over all pairs."""
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("size", [4, 5])
def test_groups_equal_brute_force(spark, size):
    rng = random.Random(5)
    rows = [(r.doc_id, r.text) for r in odd_documents(spark).collect()]
    original = prose(rng, 120).split()
    for k in range(60):  # a group of near copies, some of which only chains link
        w = list(original)
        for _ in range(rng.randrange(1, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(9)}"
        rows.append((1000 + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.groups(docs, near_dedup.Settings(shingle=size)).collect()
    want = brute(rows, size, 80)
    assert len(got) == len(want)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty_table_and_odd_columns(spark):
    assert near_dedup.groups(empty_documents(spark)).collect() == []
    docs = odd_documents(spark)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {
        r.doc_id for r in near_dedup.groups(docs).where("kept").collect()}


def test_null_ids_stay(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")],
                                 "doc_id long, text string")
    assert sorted(near_dedup.keep_one(docs).collect(), key=str) == sorted(
        [r for r in docs.collect() if r.doc_id != 2], key=str)


def test_sketch_limit_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(4)
    for n in (20, 150, 1000, 20_000):
        lost = 0
        for _ in range(60):
            both = int(n * 0.8)
            h = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
            a, b = np.sort(h[rng.permutation(len(h))[:both + (len(h) - both) // 2]]), None
            rest = np.setdiff1d(h, a)
            b = np.sort(np.concatenate([rng.permutation(a)[:both], rest]))
            inter = len(np.intersect1d(a, b))
            if 100 * inter < 80 * (len(a) + len(b) - inter):
                continue
            sk = [near_dedup._sketches(x, np.zeros(len(x), np.int64), 1).view(np.uint64) for x in (a, b)]
            ones = int(np.bitwise_count(sk[0] ^ sk[1]).sum())
            lost += ones > near_dedup.most_ones(np.array([len(a)]), np.array([len(b)]), 80)[0]
        assert lost == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (205, 204)]
    got = components(spark.createDataFrame(edges, "u long, v long"), "t").collect()
    want = {i: 1 for i in range(2, 41)} | {100 + k: 100 for k in range(1, 30)} | {205: 204}
    assert {r.id: r.component for r in got} == want
