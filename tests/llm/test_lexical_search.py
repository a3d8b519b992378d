import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporium.llm import lexical_search
from emporium.llm.lexical_search import Settings, resolve
from tests.llm.helpers import odd_documents, odd_rows


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k):
    """Sorted (item_id, rank, doc_id, score) by scoring every pair."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counts:
            n, score = sum(c.values()), 0
            for t in set(terms(text)):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 50 + (50 * n * n_docs) // n_terms
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def corpus(seed=5, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "日本語", "x_y", "it's"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 3, 20, 80])))) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(90)]  # ties: many copies of one text
    rows += [(7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1]), (2000, None), (2001, ""), (2002, "  ..."),
             (-5, rows[9][1])]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.choice([1, 4, 30])))) for i in range(40)]
    return rows, items + [(3, rows[7][1]), (3, rows[7][1]), (None, "w3 w50"), (90, None), (91, ""), (92, "unheard of"),
                          (93, "W1 w1 ÉTÉ Été")]


@pytest.mark.parametrize("s", [Settings(k=10, depth=2, deeper=2, shard_postings=300), Settings(k=50),
                               Settings(k=3, first=1, block_items=9)])
def test_ranks_equal_brute_force(spark, s):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"n": F.lit("x"), "term": F.lit(1), "score": F.lit(2.0), "item": F.lit(1)}).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = sorted([tuple(r) for r in lexical_search.rank(docs, asked, s).collect()], key=str)
    assert got == brute(rows, items, s.k)


def test_odd_documents_and_empty_tables(spark):
    docs = odd_documents(spark)
    rows = [*odd_rows(), odd_rows()[0]]
    items = [(i, t) for i, t in rows if t and len(t) < 2000]
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = sorted([tuple(r) for r in lexical_search.rank(docs, asked).collect()], key=str)
    assert got == brute(rows, items, 50)
    assert lexical_search.rank(docs.limit(0), asked).collect() == []
    assert lexical_search.rank(docs, asked.limit(0)).collect() == []


def test_lists_are_left_early_and_the_result_is_certain():
    rng = np.random.default_rng(4)
    lists = []
    for _ in range(4):
        docs = rng.permutation(20000)[:15000]
        lists.append((docs, np.sort((1000 * rng.pareto(2, len(docs))).astype(np.int64) + 1)[::-1]))
    docs, impact = (np.concatenate(x) for x in zip(*lists))
    heads, lengths = np.arange(4) * 15000, np.full(4, 15000)
    whole = np.bincount(docs, impact, minlength=20000).astype(np.int64)
    cut = np.sort(whole)[-50]
    found, score = resolve(heads, lengths, docs, impact, 20000, Settings(), 1)
    assert set(found) == set(np.flatnonzero(whole >= cut)) and (whole[found] == score).all()

    class Counting(np.ndarray):
        read = 0

        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.dtype != bool:
                Counting.read = max(Counting.read, int(at.max(initial=0) % 15000))
            return np.asarray(self)[at]

    # one list decides: a bound above all other sums ends the reading at the first depth
    resolve(heads, lengths, docs, impact.view(Counting), 20000, Settings(), int(whole.max()) * 2)
    assert Counting.read < 2000
