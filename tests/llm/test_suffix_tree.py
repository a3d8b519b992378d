import math
import pathlib
import zlib
from collections import Counter

import numpy as np

from emporium.llm import suffix_tree
from emporium.llm.common import read
from emporium.session import ensure_checkpoint_dir
from tests.llm.helpers import empty_documents, odd_documents, words


def base_of(rows):
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        w = [*words(t), None]
        out.append((i, len(w), sum(counts[x] > 0 for x in w), n,
                    sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return out


def test_counts_and_base_scores_equal_brute_force(spark, sf_dir):
    for docs in (odd_documents(spark), read(spark, sf_dir, "documents")):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        # Few tokens travel to the tasks, so most counts are joined in.
        got = suffix_tree.score_documents(docs, suffix_tree.Settings(entries=64)).collect()
        a = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
        for x, y in zip(a, sorted(base_of(rows)), strict=True):
            assert x[:4] == y[:4] and math.isclose(x[4], y[4], rel_tol=1e-9)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 1) for r in got)


def test_states_sum_to_one_and_beat_the_base(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    tree, _ = suffix_tree.fit(docs.select("text"), suffix_tree.Settings(divergence=0.0))
    assert tree.retained.sum() > 20 and len(tree.steps) > 1
    root, symbols = tree.root(), np.arange(tree.n_symbols)
    for state in np.flatnonzero(tree.retained):
        p = root * 10 ** tree.ratio(np.full(len(symbols), state), symbols)
        assert abs(p.sum() - 1) < 1e-6
    got = suffix_tree.score_documents(docs).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert got[0] > got[1]


def test_log_ratios_equal_a_plain_tree(spark):
    """Scores by dictionaries over the same counts."""
    texts = ["a b a b a b c", "b a b a", "a b c a b c", "c c c a b", "a b"] * 6
    rows = list(enumerate(texts))
    s = suffix_tree.Settings(depth=2, divergence=0.0)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_tree.score_documents(docs, s, folds=1, held=1).collect()
    streams = [["^", *t.split(), "$"] for t in texts]
    uni, ctx = Counter(), {}
    for x in streams:
        uni.update(x[1:])
        for i in range(1, len(x)):
            for d in (1, 2):
                if i - d >= 0:
                    ctx.setdefault(tuple(x[i - d:i]), Counter())[x[i]] += 1
    n, v = sum(uni.values()), len(uni)
    norm = n + 0.5 * (v + 1)

    def p(c, x):
        if not c:
            return (uni[x] + 0.5) / norm
        if c not in ctx:
            return p(c[1:], x)
        q, size = p(c[1:], x), sum(ctx[c].values())
        kept = ctx[c][x]
        if kept:
            return (kept + s.smoothing * q) / (size + s.smoothing)
        return q * s.smoothing / (size + s.smoothing)

    want = [sum(math.log10(p(tuple(x[max(0, i - 2):i]), x[i])) for i in range(1, len(x))) for x in streams]
    for r in got:
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-6), (r, want[r.doc_id])


def test_empty_and_untrained(spark):
    assert suffix_tree.score_documents(empty_documents(spark)).collect() == []
    docs = spark.createDataFrame([(i, "a b") for i in range(3)], "doc_id long, text string")
    got = suffix_tree.score(docs, *suffix_tree.fit(docs.limit(0).select("text"))).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0)] * 3


def test_a_phrase_seen_twice_is_learned_in_a_large_corpus(spark):
    """What is kept goes by occurrences, not by a share of the corpus."""
    phrase = "quartz ferret juggles lanterns"
    filler = [" ".join(f"w{(i * 7 + j * j) % 4000}" for j in range(200)) for i in range(400)]
    rows = list(enumerate([phrase, phrase, *filler]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # Shares of 1 / 64 travel, and nothing of the phrase makes up such a share.
    s = suffix_tree.Settings(entries=64)
    got = {r.doc_id: r for r in suffix_tree.score_documents(docs, s, folds=1, held=1).collect()}
    assert got[0].score > got[0].base_score + 4
    full = {r.doc_id: r for r in suffix_tree.score_documents(docs, suffix_tree.Settings(), folds=1, held=1).collect()}
    assert all(math.isclose(full[i].score, got[i].score, rel_tol=1e-9) for i in full)


def test_only_scores_stay_on_disk(spark, sf_dir):
    """Tables and shuffle files go when no later step reads them."""
    folder = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    setting = spark.conf.get(suffix_tree._FREE, None)
    docs = read(spark, sf_dir, "documents")
    assert suffix_tree.score_documents(docs).count() == docs.count()
    left = [x.name for x in set(folder.iterdir()) - before if x.name.startswith("pst-")]
    assert left and all(x.startswith("pst-scores-") for x in left)
    assert spark.conf.get(suffix_tree._FREE, None) == setting


def test_more_texts_a_task_than_a_place_has_numbers(spark):
    rows = [(None if i % 9 == 0 else i // 2, f"a b{i % 70} c{i}") for i in range(140_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = suffix_tree.score_documents(docs, suffix_tree.Settings(entries=64)).collect()
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1:
            counts.update([*t.split(), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted((-1 if i is None else i, sum(counts[x] > 0 for x in (*t.split(), None)), round(sum(
        math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in (*t.split(), None)), 6)) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_known, round(r.base_score, 6)) for r in got) == want


def test_keys_come_back_from_their_differences():
    for keys in (np.zeros(0, np.uint64), np.array([0, 1, 2**63, 2**64 - 1], np.uint64)):
        assert suffix_tree._unpacked(suffix_tree._packed(keys)).tolist() == keys.tolist()
