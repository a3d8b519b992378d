"""Quality by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words, the whole text).
Every passage is encoded from the shares of its byte classes and punctuation,
word lengths and repetitions; an encoder layer turns that into h.  Gated
attention (learned from document labels alone) weighs the passages,

    a_i ∝ exp(w · (tanh(V h_i) ⊙ sigmoid(U h_i))),

and the weighted representation z = Σ a_i h_i gives the document's score
sigmoid(c · z + b).  So a page of good prose with one stretch of junk is judged
by the stretch, without any passage having been labelled.

The model is fitted on a bounded sample: at most ``sample_rows`` labelled rows
outside the held-out fold (those of the smallest hashed ids), each distinct text
once.  Training and scoring read all passages of every text.  Labels, language, source and id are never
inputs of a score.

Defined results: null and empty texts are one passage of zeros and get its
score; null labels are left out; of several labels of one document the least
counts; without labels (or with one class only) every score is the smoothed
share of label 1, 0.5 without labels; repeated rows are scored one by one; other
columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import _LOWER, chunks, fold, scratch_table, span_hashes, string_buffers, words

PASSAGE = 64  # words

_GROUPS = 14
_GROUP = np.zeros(256, np.uint8)  # 0: lower-case letters and non-ASCII bytes
for _at, _bytes in enumerate((range(65, 91), range(48, 58), b".", b",", b"!?", b"#$%&*@^~", b"|",
                              b"<>{}[]\\/=_+", b"()'\"`-:;", (10,), (32, 9, 11, 12, 13),
                              (*range(9), *range(14, 32), 127), range(0xC0, 0x100)), start=1):
    _GROUP[list(_bytes)] = _at
N_FEATURES = _GROUPS + 8


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, passages per text) of a chunk of texts."""
    n = len(offsets) - 1
    starts, ends, counts = words(data, offsets)
    own = np.maximum(1, -(-counts // PASSAGE))
    total = int(own.sum())
    text = np.repeat(np.arange(n), own)
    nth = np.arange(total) - np.repeat(np.cumsum(own) - own, own)
    first = np.minimum((np.cumsum(counts) - counts)[text] + nth * PASSAGE, len(starts))
    n_words = np.clip(counts[text] - nth * PASSAGE, 0, PASSAGE)
    out = np.zeros((total, N_FEATURES), np.float32)
    if len(starts) == 0:
        return out, own
    passage = np.repeat(np.arange(total), n_words)  # of each word
    # Bytes belong to the passage of the last word that began.
    full = np.flatnonzero(n_words > 0)
    size = np.diff(np.concatenate([starts[first[full]], [len(data)]]))
    of = np.repeat(full, size)
    group = _GROUP[data[starts[0]:]].astype(np.int64)
    seen = np.bincount(of * _GROUPS + group, minlength=total * _GROUPS).reshape(total, _GROUPS)
    n_bytes = np.maximum(1, seen.sum(axis=1, keepdims=True))
    out[:, :_GROUPS] = seen / n_bytes
    low = _LOWER[data]
    h = span_hashes(low, starts, ends)
    length = (ends - starts).astype(np.float64)

    def mean(x: np.ndarray) -> np.ndarray:
        return np.bincount(passage, weights=x, minlength=total) / np.maximum(1, n_words)

    same = np.zeros(len(h))
    same[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    order = np.lexsort((h, passage))
    again = np.zeros(len(h))
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (passage[order[1:]] == passage[order[:-1]])
    last, head = data[ends - 1], data[starts]
    average = mean(length)
    alone = (length == 1) & (_GROUP[head] >= 3)
    columns = (same, again, (_GROUP[last] == 6) & (length > 1), _GROUP[last] == 5,
               alone, (head >= 65) & (head <= 90), length / 20, (length / 20) ** 2)
    for i, x in enumerate(columns):
        out[:, _GROUPS + i] = mean(np.asarray(x, np.float64))
    out[:, -1] -= (average / 20) ** 2
    return out, own


@dataclass(frozen=True)
class Model:
    prior: float
    par: dict | None  # None: every score is the prior

    def score(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        if self.par is None:
            return np.full(len(own), self.prior)
        return _forward(self.par, (x - self.par["mean"]) / self.par["scale"], own)[0]


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _forward(p: dict, x: np.ndarray, own: np.ndarray):
    """Scores of bags: x holds the passages of all bags in a row, ``own`` of each."""
    at = np.cumsum(own) - own
    bag = np.repeat(np.arange(len(own)), own)
    h = np.tanh(x @ p["W"] + p["b0"])
    t, g = np.tanh(h @ p["V"]), _sig(h @ p["U"])
    e = (t * g) @ p["w"]
    e = np.exp(e - np.maximum.reduceat(e, at)[bag])
    a = e / np.add.reduceat(e, at)[bag]
    z = np.add.reduceat(a[:, None] * h, at, axis=0)
    return _sig(z @ p["c"] + p["b"]), (bag, h, t, g, a, z)


def _gradient(p: dict, x: np.ndarray, own: np.ndarray, y: np.ndarray) -> dict:
    s, (bag, h, t, g, a, z) = _forward(p, x, own)
    d = (s - y) / len(y)
    dz = d[:, None] * p["c"]
    part = (h * dz[bag]).sum(axis=1)  # dL/da
    de = a * (part - np.add.reduceat(a * part, np.cumsum(own) - own)[bag])
    dt, dg = de[:, None] * p["w"] * g * (1 - t * t), de[:, None] * p["w"] * t * g * (1 - g)
    dh = a[:, None] * dz[bag] + dt @ p["V"].T + dg @ p["U"].T
    du = dh * (1 - h * h)
    return {"W": x.T @ du, "b0": du.sum(axis=0), "V": h.T @ dt, "U": h.T @ dg,
            "w": (de[:, None] * t * g).sum(axis=0), "c": z.T @ d, "b": d.sum()}


def _train(x: np.ndarray, own: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int) -> dict:
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = ((x - mean) / scale).astype(np.float32)
    p = {"W": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), "b0": np.zeros(hidden),
         "V": rng.normal(0, hidden ** -0.5, (hidden, hidden)), "U": rng.normal(0, hidden ** -0.5, (hidden, hidden)),
         "w": rng.normal(0, hidden ** -0.5, hidden), "c": rng.normal(0, hidden ** -0.5, hidden), "b": np.zeros(())}
    m, v = {k: np.zeros_like(q) for k, q in p.items()}, {k: np.zeros_like(q) for k, q in p.items()}
    at, step = np.cumsum(own) - own, 0
    for _ in range(max(epochs, -(-1500 * 64 // max(1, len(y))))):  # at least 1500 steps
        order = rng.permutation(len(y))
        for s in range(0, len(y), 64):
            pick = order[s:s + 64]
            n = own[pick]
            rows = np.repeat(at[pick] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            step += 1
            for k, g in _gradient(p, x[rows], n, y[pick]).items():
                g = g + 1e-4 * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return p | {"mean": mean, "scale": scale}


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 10_000, folds: int = 3,
        held: int = 1, hidden: int = 16, epochs: int = 6, seed: int = 7) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    marks = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("y"))
             .where(fold("doc_id", folds) != held)
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = (docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")  # at most sample_rows
              .withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
              .groupBy("h").agg(F.min(F.struct("doc_id", "text", "y")).alias("r")).select("r.*"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for i, j, part, offs in chunks(data, offsets):
                x, own = encode(part, offs)
                rows, at = [], 0
                for n in own:
                    rows.append(x[at:at + n].tobytes())
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), b.column("y").slice(i, j - i),
                     pa.array(rows, pa.binary())], names=["doc_id", "y", "x"])

    # At most sample_rows rows, each with some 20 numbers for 64 words.
    got = (sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
           .mapInArrow(local, "doc_id long, y int, x binary").orderBy("doc_id", "y").collect())
    y = np.array([float(r.y > 0) for r in got])
    if not len(y) or y.all() or not y.any():
        return Model(float((y.sum() + 1) / (len(y) + 2)), None)
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, N_FEATURES) for r in got]
    own = np.array([len(b) for b in bags])
    return Model(float(y.mean()), _train(np.concatenate(bags).astype(np.float64), own, y, hidden, epochs, seed))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from all passages of its text."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            s = np.zeros(b.num_rows)
            for i, j, part, offs in chunks(data, offsets):
                s[i:j] = model.score(*encode(part, offs))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s)], names=["doc_id", "score"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(judge, "doc_id long, score double"))
