import re

import pytest
from pyspark.sql import functions as F

from emporium.llm import mixing
from tests.llm.helpers import empty_documents, odd_documents, prose


def shares(sizes, weights, share, repeats):
    """Targets by sharing out again and again, as the words of the task have it."""
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, held = share * sum(sizes.values()), {}
    while True:
        free = [n for n in names if n not in held]
        if not free:
            return held
        unit = (total - sum(held.values())) / sum(weight[n] for n in free)
        above = [n for n in free if unit * weight[n] > repeats * sizes[n]]
        if not above:
            return held | {n: unit * weight[n] for n in free}
        held |= {n: repeats * sizes[n] for n in above}


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 10, "c": 300, "d": 5, None: 20}, {"a": 1, "b": 1, "c": 1}, {"a": 0, "b": 7}, {None: 4},
    {f"s{i}": i * i for i in range(40)}, {"a": 0}])
@pytest.mark.parametrize("share", [1.5, 2.5])
def test_targets_equal_repeated_sharing(spark, sizes, share):
    rows = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.targets(rows, mixing.Settings(share=share)).collect()}
    want = shares(sizes, (3, 1, 2), share, 2.0)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-6 * max(1, want[k]) for k in want)


def many(spark, n=3000):
    import random
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.choice([1, 5, 40, 400])), rng.choice(["hot", "hot", "é", "z", None, "src1"]))
            for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_taken_words_come_near_their_targets_and_no_row_passes_its_double(spark):
    got = mixing.plan(many(spark)).collect()
    assert len(got) == 3000
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) < 0.01 * own[0].target
        rate = own[0].target / own[0].source_size
        assert {r.copies for r in own} <= {int(rate), int(rate) + 1} and max(r.copies for r in own) <= 2


def test_partitioning_does_not_change_the_mix(spark):
    docs = many(spark, 500)
    a, b = mixing.plan(docs).collect(), mixing.plan(docs.repartition(7, "text")).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_the_mix_holds_whole_rows_as_often_as_planned(spark):
    docs = odd_documents(spark).withColumn("source", F.when(F.col("doc_id") > 3, "a")).withColumns(
        {"_copies": F.lit(1), "size": F.lit("x"), "target": F.lit(2), "part": F.lit(3), "weird name.x": F.lit(4)})
    plan = mixing.plan(docs).collect()
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    times = {}
    for r in plan:
        times[r.doc_id] = times.get(r.doc_id, 0) + r.copies
    rows = out.collect()
    assert {k: v for k, v in times.items() if v} == {
        k: sum(r.doc_id == k for r in rows) for k in {r.doc_id for r in rows}}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == texts[r.doc_id] and r.size == "x" for r in rows)


def test_null_and_repeated_ids_empty_texts_and_empty_tables(spark):
    rows = [(None, "a b", "s"), (None, "c d e", "s"), (1, None, "s"), (1, "", None), (1, " \n", "t"), (2, "x" * 50000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(docs).collect()
    assert sorted((r.size, r.source or "") for r in got) == [(0, ""), (0, "s"), (0, "t"), (1, "t"), (2, "s"), (3, "s")]
    assert all(r.copies == 0 for r in got if r.size == 0)
    assert {r.target for r in got if r.source is None} == {0.0}
    assert mixing.plan(empty_documents(spark)).collect() == []
    assert mixing.mix(empty_documents(spark)).collect() == []


def test_words_are_runs_of_other_than_white_space(spark):
    texts = ["", " ", "a", " a\tb\x0bc\x0c\rd\n", "é x \U0001f600 $1 \\2", "a  b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mixing.n_words(F.col("t"))).collect()] == [
        len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts]
