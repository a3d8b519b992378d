import random

import numpy as np
from pyspark.sql import functions as F

from emporium.llm import quality, toxicity
from emporium.llm.common import read
from tests.llm.helpers import empty_documents, odd_documents, prose


def corpus(spark, seed=1, n=240):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        text = prose(rng, rng.randrange(5, 300))
        toxic, junk = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            w = text.split()
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["Idiot", "vequai", "vequel", "scum!!"]))
            text = " ".join(w)
        if junk:
            text += "\n" + " ".join(rng.choice(["@@##", "$$%%", "***"]) for _ in range(60))
        docs.append((i, text))
        labels.append((i, int(not junk), int(toxic)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def held(df):
    return df.where("crc32(cast(doc_id as string)) % 3 = 1")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    got = held(toxicity.score(docs, model).join(labels, "doc_id")).collect()
    assert np.mean([r.rejected == (r.toxic == 1) for r in got]) > 0.95
    assert all(abs(r.grade - r.severity) <= 2 and 0 <= r.severity <= toxicity.GRADES for r in got)
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == toxicity.GRADES
    kept = toxicity.keep_clean(docs, model)
    clean = {r.doc_id for r in toxicity.score(docs, model).where("not rejected").collect()}
    assert {r.doc_id for r in kept.collect()} == clean


def test_toxicity_odd_rows(spark):
    docs = odd_documents(spark)
    none = toxicity.fit(docs, spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int"))
    got = toxicity.score(docs, none).collect()
    assert len(got) == docs.count() and not any(r.rejected for r in got)
    one = toxicity.fit(docs, spark.createDataFrame([(2, 1, 1), (3, 1, 1)], "doc_id long, quality int, toxic int"))
    assert toxicity.score(docs, one).count() == docs.count()
    assert toxicity.score(empty_documents(spark), none).collect() == []
    assert toxicity.keep_clean(docs, none).columns == docs.columns


def test_quality_on_held_out_rows(spark):
    docs, labels = corpus(spark, 2)
    got = held(quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id")).collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in got]) > 0.95


def test_quality_odd_rows(spark):
    docs = odd_documents(spark)
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = quality.score(docs, none).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {0.5}
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (9, 0, 0), (13, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert all(0 <= r.score <= 1 for r in got) and len(got) == docs.count()
    assert quality.score(empty_documents(spark), none).collect() == []


def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(0)
    x, own, y = rng.normal(size=(9, 5)), np.array([3, 1, 5]), np.array([1.0, 0.0, 1.0])
    p = {"W": rng.normal(size=(5, 4)), "b0": rng.normal(size=4), "V": rng.normal(size=(4, 4)),
         "U": rng.normal(size=(4, 4)), "w": rng.normal(size=4), "c": rng.normal(size=4), "b": np.zeros(())}

    def loss(q):
        s = quality._forward(q, x, own)[0]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for name, g in quality._gradient(p, x, own, y).items():
        for at in np.ndindex(p[name].shape):
            up, down = {k: v.copy() for k, v in p.items()}, {k: v.copy() for k, v in p.items()}
            up[name][at] += 1e-6
            down[name][at] -= 1e-6
            assert abs((loss(up) - loss(down)) / 2e-6 - np.asarray(g)[at]) < 1e-6


def test_quality_on_the_given_labels(spark, sf_dir):
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    got = held(quality.score(docs, quality.fit(docs, labels)).join(labels, "doc_id"))
    assert got.agg(F.avg(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int"))).first()[0] > 0.8


def test_toxicity_from_few_labels(spark):
    rng = random.Random(4)
    docs, labels, n = [], [], 0
    for i in range(120):
        toxic = i % 12 == 0
        docs.append((i, prose(rng, 12) + (" scumbag " if toxic else " friend ") + prose(rng, 12)))
        if i < 48:  # four toxic labels, some of them in the held-out fold
            labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id for r in toxicity.score(docs, model).where("rejected").collect()}
    assert got == set(range(0, 120, 12))
