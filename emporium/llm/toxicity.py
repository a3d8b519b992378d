"""Toxicity by cumulative-link ordinal regression on sparse text features.

Features of a text are the lower-cased letter runs it holds and their prefixes of
4 and 6 bytes (so inflected forms of a stem count as one), as 64-bit hashes,
present or absent.  Of all features the ``n_features`` with the greatest
log-likelihood ratio between toxic and other labelled texts are kept.

The labels only say toxic or not, so severity grades are made from them: grade 0
is a text not labelled toxic; labelled ones are graded 1 to ``GRADES`` by how
many distinct kept features speak for toxicity, at the terciles of the sample.
One weight vector is shared by all thresholds:

    P(grade > k) = sigmoid(w · x - theta_k),   theta_0 < theta_1 < theta_2

and the severity is the expected grade, the sum of these probabilities.  A text
is rejected if P(grade > 0) is at least one half.

The model is fitted on a bounded sample: at most ``sample_rows`` labelled rows,
those of the smallest hashed ids, each distinct text once.  Scoring reads every
whole text.

Defined results: null and empty texts, and all texts where no label is given,
have no feature and get the intercept's probabilities (0 without labels); null
labels are left out; repeated rows are scored one by one; several labels of one
document count as toxic if one does; other columns are ignored or, in
``keep_clean``, returned as they are.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import (chunks, distinct_per_text, fold, letter_runs, mix, scratch_table, signed,
                                 span_hashes, string_buffers, tidy)

GRADES = 3
_PREFIXES = (4, 6)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, text number) of every occurrence in a chunk of texts."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low, starts, ends = letter_runs(data, offsets)
    text = np.searchsorted(offsets, starts, side="right") - 1
    found, of = [span_hashes(low, starts, ends)], [text]
    for n in _PREFIXES:
        long = ends - starts >= n
        found.append(mix(span_hashes(low, starts[long], starts[long] + n) + np.uint64(n)))
        of.append(text[long])
    return np.concatenate(found), np.concatenate(of)


@dataclass(frozen=True)
class Model:
    hashes: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray  # empty without labels

    def probabilities(self, total: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0.. by the sum of the weights of a text's features."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - total[:, None], -500, 500)))


def _hits(data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray,
          sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature number, text number), each pair once, of the kept features."""
    h, text = features(data, offsets)
    maybe = sieve[(h & np.uint64(len(sieve) - 1)).astype(np.int64)]
    h, text = h[maybe], text[maybe]
    where = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
    sure = hashes[where] == h if len(hashes) else np.zeros(len(h), bool)
    pair = np.unique(text[sure] * max(1, len(hashes)) + where[sure])
    return pair % max(1, len(hashes)), pair // max(1, len(hashes))


def _sieve(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[(hashes & np.uint64(len(out) - 1)).astype(np.int64)] = True
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, folds: int, held: int,
                    label: str = "toxic") -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled texts outside the held-out fold."""
    marks = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max(label).alias("y"))
             .where(fold("doc_id", folds) != held)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    own = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return (own.join(F.broadcast(marks), "doc_id")  # at most ``rows`` rows
            .withColumn("h", F.xxhash64("text"))
            .groupBy("h").agg(F.min(F.struct("doc_id", "text", "y")).alias("r")).select("r.*"))


def _select_features(sample: DataFrame, n_features: int) -> np.ndarray:
    """Hashes of the features that tell toxic texts best, in ascending order.

    A feature's log-likelihood ratio must exceed what the best of as many features
    reaches by chance (2 ln of their number, at most 20); if none does, as with a
    handful of labels, the best ones are taken as they are.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y = np.array(b.column("y").to_pylist(), np.int64)
            data, offsets = string_buffers(b.column("text"))
            for i, j, part, offs in chunks(data, offsets):
                h, text = features(part, offs)
                order = np.argsort(text, kind="stable")
                h, n = distinct_per_text(h[order], np.bincount(text, minlength=j - i))
                toxic = np.repeat(y[i:j] > 0, n)
                unique, inverse = np.unique(h, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(unique)),
                     pa.array(np.bincount(inverse, weights=toxic, minlength=len(unique)).astype(np.int64)),
                     pa.array(np.bincount(inverse, minlength=len(unique)).astype(np.int64))],
                    names=["h", "toxic", "n"])

    counted = (sample.select("text", "y").mapInArrow(tidy(local), "h long, toxic long, n long")
               .groupBy("h").agg(F.sum("toxic").alias("a"), F.sum("n").alias("n")))
    counted = scratch_table(counted, "toxic-features")
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("y") > 0).cast("long")).alias("t")).first()
    if not size.n or not size.t or size.t == size.n:
        return np.zeros(0, np.uint64)
    share = size.t / size.n
    a, n = F.col("a").cast("double"), F.col("n").cast("double")
    # Log-likelihood ratio of the feature's toxic share against that of all texts.
    ratio = 2 * (F.when(a > 0, a * F.log(a / (n * share))).otherwise(0.0)
                 + F.when(n > a, (n - a) * F.log((n - a) / (n * (1 - share)))).otherwise(0.0))
    telling = a > n * share  # of toxic texts
    rated = counted.withColumn("g", F.when(telling | (n >= 3), ratio).otherwise(0.0))
    chance = min(20.0, 2 * math.log(max(2, counted.count())))
    best = (rated.where(F.col("g") > chance).orderBy(F.desc("g"), "h").limit(n_features).select("h").collect()
            or rated.where(telling).orderBy(F.desc("g"), "h").limit(n_features).select("h").collect())
    return np.sort(np.array([r.h for r in best], np.int64).view(np.uint64))


def _fit(rows: list[np.ndarray], y: np.ndarray, size: int, steps: int, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the likelihood of the grades."""
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.concatenate(rows).astype(np.int64) if len(text) else np.zeros(0, np.int64)
    k, n = int(y.max()), len(y)
    w = np.zeros(size)
    above = np.array([(y > i).mean() for i in range(k)]).clip(1e-4, 1 - 1e-4)
    first = -np.log(above / (1 - above))
    gaps = np.log(np.expm1(np.maximum(np.diff(first), 1e-2)))  # inverse softplus
    par = np.concatenate([w, first[:1], gaps])
    m, v = np.zeros_like(par), np.zeros_like(par)

    def sig(x):
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    for step in range(1, steps + 1):
        w, steep = par[:size], sig(par[size + 1:])
        theta = par[size] + np.concatenate([[0], np.cumsum(np.logaddexp(0, par[size + 1:]))])
        s = np.bincount(text, weights=w[feat], minlength=n)
        low = np.where(y > 0, sig(s - theta[np.maximum(y - 1, 0)]), 1.0)
        high = np.where(y < k, sig(s - theta[np.minimum(y, k - 1)]), 0.0)
        p = np.maximum(low - high, 1e-12)
        ds = 1 - low - high
        dtheta = np.zeros(k)
        inner, outer = y > 0, y < k
        np.add.at(dtheta, y[inner] - 1, -(low * (1 - low) / p)[inner])
        np.add.at(dtheta, y[outer], (high * (1 - high) / p)[outer])
        g = np.empty_like(par)
        g[:size] = np.bincount(feat, weights=ds[text], minlength=size) / n - l2 * w
        g[size] = dtheta.sum() / n
        g[size + 1:] = np.cumsum(dtheta[::-1])[::-1][1:] / n * steep
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        par = par + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    theta = par[size] + np.concatenate([[0], np.cumsum(np.logaddexp(0, par[size + 1:]))])
    return par[:size], theta


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, n_features: int = 2048,
        folds: int = 3, held: int = 1, steps: int = 1500, l2: float = 1e-6) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    sample = scratch_table(labelled_sample(docs, labels, sample_rows, folds, held), "toxic-sample")
    hashes = _select_features(sample, n_features)
    sieve = _sieve(hashes)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for i, j, part, offs in chunks(data, offsets):
                feat, text = _hits(part, offs, hashes, sieve)
                own = [feat[text == t].astype(np.int32) for t in range(j - i)]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("y").slice(i, j - i),
                     pa.array(own, pa.list_(pa.int32()))], names=["doc_id", "y", "f"])

    # At most sample_rows rows of at most n_features kept features each.
    got = (sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
           .mapInArrow(tidy(local), "doc_id long, y int, f array<int>").orderBy("doc_id", "y").collect())
    if not got:
        return Model(hashes, np.zeros(len(hashes)), np.zeros(0))
    rows = [np.array(r.f, np.int64) for r in got]
    toxic = np.array([r.y > 0 for r in got])
    if toxic.all() or not toxic.any():
        odds = (toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5)
        return Model(hashes, np.zeros(len(hashes)), np.array([-np.log(odds)] + [50.0] * (GRADES - 1)))
    text = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.concatenate(rows)
    speaks = np.bincount(feat, weights=toxic[text], minlength=len(hashes)) > toxic.mean() * np.bincount(
        feat, minlength=len(hashes))
    evidence = np.array([speaks[r].sum() for r in rows])
    cuts = np.quantile(evidence[toxic], [i / GRADES for i in range(1, GRADES)])
    y = np.where(toxic, 1 + (evidence[:, None] > cuts[None, :]).sum(axis=1), 0)
    weights, thresholds = _fit(rows, y, len(hashes), steps, l2)
    return Model(hashes, weights, thresholds)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, grade, rejected) of every row."""
    hashes, weights, sieve = model.hashes, model.weights, _sieve(model.hashes)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            total = np.zeros(b.num_rows)
            for i, j, part, offs in chunks(data, offsets):
                feat, text = _hits(part, offs, hashes, sieve)
                total[i:j] = np.bincount(text, weights=weights[feat], minlength=j - i)
            p = model.probabilities(total) if len(model.thresholds) else np.zeros((b.num_rows, 1))
            severity = p.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(severity), pa.array(p[:, 0]),
                 pa.array((p >= 0.5).sum(axis=1).astype(np.int32)), pa.array(p[:, 0] >= 0.5)],
                names=["doc_id", "severity", "p_toxic", "grade", "rejected"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(tidy(judge), "doc_id long, severity double, p_toxic double, grade int, rejected boolean"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, whose text is not rejected."""
    hashes, weights, sieve = model.hashes, model.weights, _sieve(model.hashes)
    names, at = docs.columns, docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column(at))
            total = np.zeros(b.num_rows)
            for i, j, part, offs in chunks(data, offsets):
                feat, text = _hits(part, offs, hashes, sieve)
                total[i:j] = np.bincount(text, weights=weights[feat], minlength=j - i)
            p = model.probabilities(total) if len(model.thresholds) else np.zeros((b.num_rows, 1))
            yield pa.RecordBatch.from_arrays(b.columns, names=names).filter(pa.array(p[:, 0] < 0.5))

    return docs.mapInArrow(tidy(keep), docs.schema)
