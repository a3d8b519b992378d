"""Exact top-k inner-product search by a vector-approximation file.

1. Equal vectors form one class, kept as its integer vector and its ``k + 1``
   smallest ids (no result can need more of them), so copies cost nothing.
2. Every class is quantised per dimension into ``2 ** cell_bits`` cells of equal
   width between the dimension's least and greatest value.  A query's exact
   vector and a cell give a lower and an upper bound of the score.
3. Scan: blocks of cells meet blocks of queries; each pair of blocks keeps the
   classes whose upper bound reaches the block's own k-th lower bound.  The
   k-th lower bound over all blocks then cuts the rest.
4. Exact vectors are read in bound order: first each query's best ``k + 1``
   classes, whose exact scores give a sharper threshold, then every class whose
   upper bound still reaches it.  All others are certain to lose.

Scores are 64-bit integers, and sums beyond their range wrap; vectors of different
lengths are never compared.

Defined results: vectors that are null or hold null or non-finite components, or one
that scaled reaches 2^62 (no 64-bit integer could hold its scores), take no part; fewer than k candidates give fewer rows; ties go to the smaller
id; rows that share an id, of one vector or of several, are separate rows; empty tables give empty results; other
columns of the input are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.llm.common import scratch_table

_SAFE = float(1 << 52)


def _usable(vec: Column, scale: int) -> Column:
    return vec.isNotNull() & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(2.0 ** 62 / scale)))


def _integers(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, dim, code): code holds ``floor(scale * x)`` as little-endian 64-bit integers."""
    rows = df.where(_usable(F.col(vec_col), scale)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            flat = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            flat = flat.astype("<i8")
            offs = np.concatenate([[0], np.cumsum(np.diff(v.offsets.to_numpy()))])
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(np.diff(offs).astype(np.int32)),
                 pa.array([flat[i:j].tobytes() for i, j in zip(offs[:-1], offs[1:])], pa.binary())],
                names=["id", "dim", "code"])

    return rows.mapInArrow(encode, "id long, dim int, code binary")


def _classes(rows: DataFrame, keep: int) -> DataFrame:
    """(cid, dim, code, ids): one row per distinct vector, numbered by cid.

    Ids may repeat over vectors, so none of them can name a class.  The numbers
    hold once the table is written.
    """

    def thin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:  # map-side: a batch keeps its smallest ids of each vector
            f = f.sort_values("id", kind="stable")
            yield f[f.groupby(["dim", "code"]).cumcount() < keep]

    w = Window.partitionBy("dim", "code").orderBy("id")
    ranked = (rows.mapInPandas(thin, rows.schema)
              .withColumn("r", F.row_number().over(w)).where(F.col("r") <= keep))
    return ranked.groupBy("dim", "code").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("cid"), "dim", "code", "ids")


def _matrix(codes, dim: int) -> np.ndarray:
    if len(codes) == 0 or dim == 0:
        return np.zeros((len(codes), dim), np.int64)
    return np.frombuffer(b"".join(codes), "<i8").reshape(len(codes), dim)


def _ranges(classes: DataFrame) -> DataFrame:
    """Least and greatest value of every dimension: (dim, low, high) as binaries."""
    schema = "dim int, low binary, high binary"

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # a row a task and length
        for f in frames:
            for dim, g in f.groupby("dim"):
                m = _matrix(list(g.code), int(dim))
                low, high = ends.get(int(dim), (m[0], m[0]))
                ends[int(dim)] = np.minimum(low, m.min(axis=0)), np.maximum(high, m.max(axis=0))
        if ends:
            yield pd.DataFrame([(d, low.tobytes(), high.tobytes()) for d, (low, high) in ends.items()],
                               columns=["dim", "low", "high"])

    def merge(f: pd.DataFrame) -> pd.DataFrame:
        dim = int(f.dim.iloc[0])
        low, high = _matrix(list(f.low), dim).min(axis=0), _matrix(list(f.high), dim).max(axis=0)
        return pd.DataFrame({"dim": [dim], "low": [low.tobytes()], "high": [high.tobytes()]})

    return (classes.select("dim", "code").mapInPandas(local, schema)
            .groupBy("dim").applyInPandas(merge, schema))


def _quantise(classes: DataFrame, ranges: dict, cell_bits: int) -> DataFrame:
    """(cid, dim, cells): one byte per dimension."""

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for dim, g in f.groupby("dim"):
                low, width = ranges[int(dim)]
                m = _matrix(list(g.code), int(dim))
                c = ((m - low) // width).astype(np.uint8)
                out.append(pd.DataFrame({"cid": g.cid.to_numpy(), "dim": g.dim.to_numpy(),
                                         "cells": [r.tobytes() for r in c]}))
            if out:
                yield pd.concat(out)

    return classes.select("cid", "dim", "code").mapInPandas(cells, "cid long, dim int, cells binary")


def _bounds(cells: np.ndarray, q: np.ndarray, low: np.ndarray,
            width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores: arrays (queries, vectors) of integers."""
    floor = low + width * cells.astype(np.int64)
    top = int(np.abs(q).max(initial=0)) * int((np.abs(floor) + width).max(initial=0)) * max(1, q.shape[1])
    if top < _SAFE:  # exact in double precision
        base = (q.astype(np.float64) @ floor.astype(np.float64).T).astype(np.int64)
    else:
        base = q @ floor.T
    up = (np.maximum(q, 0) * (width - 1)).sum(axis=1)
    down = (np.minimum(q, 0) * (width - 1)).sum(axis=1)
    return base + down[:, None], base + up[:, None]


def _scan(cells: DataFrame, queries: DataFrame, ranges: dict, keep: int,
          data_blocks: int, query_blocks: int) -> DataFrame:
    """Blocks of cells against blocks of queries: (qid, cid, low, high) that may win."""
    left = (cells.withColumn("db", F.pmod(F.xxhash64("cid"), F.lit(data_blocks)))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    right = (queries.select(F.col("cid").alias("qid"), "dim", "code")
             .withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(query_blocks)).cast("int"))
             .withColumn("db", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(data_blocks - 1).cast("long")))))

    def scan(data: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim in set(data.dim) & set(q.dim):
            low, width = ranges[int(dim)]
            d = data[data.dim == dim]
            own = q[q.dim == dim]
            grid = np.frombuffer(b"".join(d.cells), np.uint8).reshape(len(d), int(dim))
            cid = d.cid.to_numpy()
            for s in range(0, len(own), 64):
                part = own.iloc[s:s + 64]
                lo, hi = _bounds(grid, _matrix(list(part.code), int(dim)), low, width)
                k = min(keep, lo.shape[1])
                cut = np.partition(lo, lo.shape[1] - k, axis=1)[:, lo.shape[1] - k]
                i, j = np.nonzero(hi >= cut[:, None])
                out.append(pd.DataFrame({"qid": part.qid.to_numpy()[i], "cid": cid[j],
                                         "low": lo[i, j], "high": hi[i, j]}))
        return (pd.concat(out) if out else
                pd.DataFrame({c: np.zeros(0, np.int64) for c in ("qid", "cid", "low", "high")}))

    return left.groupBy("db", "qb").cogroup(right.groupBy("db", "qb")).applyInPandas(
        scan, "qid long, cid long, low long, high long")


def _exact(pairs: DataFrame, classes: DataFrame, queries: DataFrame) -> DataFrame:
    """(qid, cid, score) of the pairs, from the exact vectors."""
    q = queries.select(F.col("cid").alias("qid"), F.col("code").alias("qcode"))
    joined = pairs.select("qid", "cid").join(classes.select("cid", "code"), "cid").join(q, "qid")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [int(np.dot(np.frombuffer(x, "<i8"), np.frombuffer(y, "<i8")))
                 for x, y in zip(b.column("code").to_pylist(), b.column("qcode").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("qid"), b.column("cid"), pa.array(s, pa.int64())],
                names=["qid", "cid", "score"])

    return joined.select("qid", "cid", "code", "qcode").mapInArrow(
        score, "qid long, cid long, score long")


def _kth(df: DataFrame, value: str, keep: int) -> DataFrame:
    """(qid, cut): each query's ``keep``-th greatest value, if it has as many."""
    w = Window.partitionBy("qid").orderBy(F.desc(value))
    return (df.select("qid", value).withColumn("r", F.row_number().over(w))
            .where(F.col("r") == keep).select("qid", F.col(value).alias("cut")))


def top_k(df: DataFrame, queries: Column, k: int = 5, scale: int = 256, cell_bits: int = 6,
          data_block: int = 8192, query_block: int = 1024,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` best other rows of every row that ``queries`` selects (by ``id``).

    ``queries`` is a condition on the column ``id``.  Returns query_id, rank,
    vec_id, score.  Block sizes bound a task's memory; their number grows with
    the table.
    """
    keep = k + 1  # a query's own row may be among them
    rows = scratch_table(_integers(df, id_col, vec_col, scale), "va-rows")
    classes = scratch_table(_classes(rows, keep), "va-classes")
    asked = (rows.where(queries).join(classes.select("cid", "dim", "code"), ["dim", "code"])
             .select(F.monotonically_increasing_id().alias("uid"),
                     F.col("id").alias("query_id"), F.col("cid").alias("qid")))
    asked = scratch_table(asked, "va-queries")
    q = scratch_table(classes.join(asked.select(F.col("qid").alias("cid")).distinct(), "cid", "left_semi"),
                      "va-query-vectors")
    # One row per vector length: bounded by the number of lengths.
    ranges = {}
    for r in _ranges(classes).collect():
        low, high = np.frombuffer(r.low, "<i8"), np.frombuffer(r.high, "<i8")
        ranges[r.dim] = (low, np.maximum(1, -(-(high - low + 1) // (1 << cell_bits))))
    cells = _quantise(classes, ranges, cell_bits)
    n, n_q = classes.count(), q.count()
    found = scratch_table(_scan(cells, q, ranges, keep, max(1, -(-n // data_block)),
                                max(1, -(-n_q // query_block))), "va-scan")
    cut = _kth(found, "low", keep)
    found = scratch_table(
        found.join(cut, "qid", "left").where(F.col("cut").isNull() | (F.col("high") >= F.col("cut")))
        .withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("high"), "cid")))
        .select("qid", "cid", "high", "r"), "va-candidates")
    first = scratch_table(_exact(found.where(F.col("r") <= keep), classes, q), "va-first")
    sharper = _kth(first, "score", keep)
    rest = (found.where(F.col("r") > keep).join(sharper, "qid", "left")
            .where(F.col("cut").isNull() | (F.col("high") >= F.col("cut"))))
    scored = first.unionByName(_exact(rest, classes, q))
    members = (scored.join(classes.select("cid", "ids"), "cid")
               .select("qid", "cid", "score", F.explode("ids").alias("vec_id")))
    order = [F.desc("score"), F.asc("vec_id")]
    best = (members.withColumn("r", F.row_number().over(Window.partitionBy("qid").orderBy(*order)))
            .where(F.col("r") <= keep).drop("r"))
    answers = asked.join(best, "qid")
    # Its own row goes: one row of its id in its class, whatever copies it has.
    own = (F.col("vec_id") == F.col("query_id")) & (F.col("cid") == F.col("qid"))
    answers = (answers.withColumn("own", own)
               .withColumn("o", F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("own"))))
               .where(~(F.col("own") & (F.col("o") == 1))))
    ranked = answers.withColumn(
        "rank", F.row_number().over(Window.partitionBy("uid").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
