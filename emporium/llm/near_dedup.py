"""Near-duplicate groups by banded MinHash, odd sketches and exact verification.

1. Every text becomes its set of distinct word shingles.  Texts of one set (by
   size and a 128-bit hash of the set) form a class and go on as one row, the
   smallest id.
2. A class has ``bands · rows`` MinHash values, which bucket it once per band,
   and an odd sketch: its MinHash samples of one permutation cut into
   ``SAMPLES`` bins, folded into a parity bitmap of ``64 · WORDS`` bits.  The
   number of ones in the XOR of two sketches estimates how many samples the two
   don't share, very precisely at high similarity.
3. Star round: each bucket links its members to its leader only, the member
   that meets the most others over all its bands.  Linked pairs whose sketches
   can't reach the threshold (``SIGMAS`` standard errors) are dropped, the rest
   verified on the full sets, and the components of what holds are formed.
4. Cross round: a bucket whose members fall into several components may still
   hide a link.  Its members outside its largest component meet every member
   of another component, in blocks of rows that one task compares by their sketches;
   a pair counts in the first bucket that the two share, and what remains is verified
   on the full sets.  So no link between different texts of a bucket is lost, and
   pairs inside a component are never enumerated.

Two texts at the threshold miss all bands with probability
(1 - s^rows)^bands: 2e-6 at 0.8 with 25 bands of 4 rows.

Defined results: null and empty texts (no word) have an empty set, are their own
component and kept; repeated rows of one id are one document; a text of fewer
words than a shingle is one shingle; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import (chunks, distinct_per_text, mix, scratch_table, sequence_hashes, signed,
                                 string_buffers, word_hashes, tidy)
from emporium.llm.components import components

SAMPLES = 4096  # bins of the one-permutation MinHash behind the sketch
WORDS = 64  # 64-bit words of a sketch
SIGMAS = 3.0
#: Members of a bucket compared at once.
BLOCK = 1024
#: Pairs verified per block; a block's texts are read once, and fit in a task.
BLOCK_PAIRS = 5_000


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80  # similarity threshold
    bands: int = 25
    rows: int = 4


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    return distinct_per_text(*sequence_hashes(*word_hashes(data, offsets), shingle))


def _sketches(h: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The odd sketch of every text, ``WORDS`` 64-bit words each.

    ``h`` is sorted within each text, so the least hash of a bin (the top twelve
    bits number the bins) is the first of its run.
    """
    bin_ = (h >> np.uint64(52)).astype(np.int64) + text * SAMPLES
    first = np.ones(len(h), bool)
    first[1:] = bin_[1:] != bin_[:-1]
    bit = mix(h[first]) % np.uint64(64 * WORDS)
    out = np.zeros(n * WORDS, np.uint64)
    np.bitwise_xor.at(out, text[first] * WORDS + (bit >> np.uint64(6)).astype(np.int64),
                      np.uint64(1) << (bit & np.uint64(63)))
    return signed(out)


def _rank(h: np.ndarray) -> tuple[int, int, int]:
    """(size, two hashes) of a set, as ``signatures`` gives them."""
    keys = [int(signed(mix(h + np.uint64(k)).sum(keepdims=True))[0]) for k in (1, 2)] if len(h) else [0, 0]
    return len(h), *keys


def signatures(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, k1, k2, bands, sketch) of every row; empty texts have n = 0."""
    per = s.bands * s.rows
    rng = np.random.default_rng(20_240_229)
    a = rng.integers(0, 1 << 63, per, np.uint64) * np.uint64(2) + np.uint64(1)
    c = rng.integers(0, 1 << 63, per, np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for i, j, part, offs in chunks(data, offsets):
                h, n = _sets(part, offs, s.shingle)
                m, full = j - i, np.flatnonzero(n)
                at = (np.cumsum(n) - n)[full]
                text = np.repeat(np.arange(m), n)
                bands = np.zeros((m, s.bands), np.uint64)
                keys = np.zeros((2, m), np.uint64)
                if len(full):
                    for k in range(per):
                        least = np.minimum.reduceat(h * a[k] + c[k], at)
                        band = k // s.rows
                        bands[full, band] = mix(bands[full, band] + least + np.uint64(band + 1))
                    keys[0, full] = np.add.reduceat(mix(h + np.uint64(1)), at)
                    keys[1, full] = np.add.reduceat(mix(h + np.uint64(2)), at)
                sketch = _sketches(h, text, m)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, m), pa.array(n), pa.array(signed(keys[0])),
                     pa.array(signed(keys[1])),
                     pa.ListArray.from_arrays(np.arange(m + 1, dtype=np.int32) * s.bands,
                                              pa.array(signed(bands.ravel()))),
                     pa.ListArray.from_arrays(np.arange(m + 1, dtype=np.int32) * WORDS,
                                              pa.array(sketch))],
                    names=["doc_id", "n", "k1", "k2", "bands", "sketch"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(tidy(sign), "doc_id long, n long, k1 long, k2 long, bands array<long>, "
                              "sketch array<long>"))


def most_ones(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Ones in the XOR of two sketches up to which sets of these sizes may reach t.

    Of the B bins that the union of two sets at the threshold fills, a share 1 - t
    differs, and gives one sample, or two if the other set has one there.  D
    differing samples set N/2 (1 - exp(-2D/N)) of N bits on average.  The limit
    allows ``SIGMAS`` standard errors of the sampling and of the bitmap; sizes
    whose ratio is below t rule a pair out (-1).
    """
    n_bits, t = 64.0 * WORDS, percent / 100
    na, nb = na.astype(np.float64), nb.astype(np.float64)
    union = (na + nb) / (1 + t)
    bins = SAMPLES * (1 - np.exp(-union / SAMPLES))
    twice = 1 - np.exp(-np.maximum(na, nb) / SAMPLES)
    differ = bins * (1 - t) * (1 + twice)
    spread = (1 + twice) ** 2 * bins * t * (1 - t) * (1 - bins / union) + bins * (1 - t) * twice * (1 - twice)
    most = differ + SIGMAS * np.sqrt(np.maximum(spread, 0)) + 1
    fade = np.exp(-4 / n_bits * most)
    spread = n_bits / 4 * (1 - fade) - most * fade
    limit = n_bits / 2 * (1 - np.exp(-2 / n_bits * most)) + SIGMAS * np.sqrt(np.maximum(spread, 0)) + 1
    return np.where(np.minimum(na, nb) * 100 >= np.maximum(na, nb) * percent, limit, -1)


def _lists(col: pa.Array, width: int) -> np.ndarray:
    """A list column of fixed width as a matrix of unsigned words (whose ones are counted)."""
    return col.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(col), width)


def verify(pairs: DataFrame, texts: DataFrame, s: Settings, name: str) -> DataFrame:
    """The pairs (u, v) of ``pairs`` (u, v, near) whose full sets reach the threshold.

    Pairs are sorted by ``near`` into blocks, so that pairs that share texts come
    together; each block reads each of its texts once.
    """
    pairs = scratch_table(pairs.select("u", "v", "near").distinct(), f"{name}-pairs")
    n = pairs.count()
    spark = pairs.sparkSession
    if n == 0:
        return spark.createDataFrame([], "u long, v long")
    blocks = max(-(-n // BLOCK_PAIRS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = scratch_table(pairs.repartitionByRange(blocks, "near", "u", "v")
                           .withColumn("block", F.spark_partition_id()), f"{name}-blocks")
    ends = placed.select(F.col("block").alias("part"), F.explode(F.array("u", "v")).alias("doc_id")).distinct()
    own = ends.join(texts.select("doc_id", "text"), "doc_id")

    def check(p: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
        sets: dict = {}
        ids = t.doc_id.to_numpy()
        data, offsets = string_buffers(pa.array(t.text.tolist(), pa.large_string()))
        for i, j, part, offs in chunks(data, offsets):
            h, size = _sets(part, offs, s.shingle)
            cut = np.concatenate([[0], np.cumsum(size)])
            for k in range(j - i):
                own, old = h[cut[k]:cut[k + 1]], sets.get(ids[i + k])
                if old is None or _rank(own) > _rank(old):  # the text that counts
                    sets[ids[i + k]] = own
        good = np.zeros(len(p), bool)
        for k, (u, v) in enumerate(zip(p.u.to_numpy(), p.v.to_numpy())):
            x, y = sets[u], sets[v]
            both = len(np.intersect1d(x, y, assume_unique=True))
            good[k] = 100 * both >= s.percent * (len(x) + len(y) - both) and both > 0
        return p.loc[good, ["u", "v"]]

    return placed.groupBy("block").cogroup(own.groupBy("part")).applyInPandas(check, "u long, v long")


def _buckets(rows: DataFrame) -> DataFrame:
    """(bucket, doc_id, m) of the buckets that hold m > 1 classes."""
    band = rows.select("doc_id", F.explode("bands").alias("bucket"))
    crowd = band.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return scratch_table(band.join(crowd, "bucket"), "dedup-buckets")


def _star(band: DataFrame) -> DataFrame:
    """(leader, doc_id): every class with the leader of each of its buckets.

    The leader is the member that meets the most others over all its buckets: in
    a group of copies of one text, that text or a copy close to it.
    """
    meets = band.groupBy("doc_id").agg(F.sum("m").alias("meets"))
    ranked = band.join(meets, "doc_id").select("bucket", F.struct("meets", (-F.col("doc_id")).alias("d")).alias("x"))
    leader = ranked.groupBy("bucket").agg(F.max("x").alias("x")).select("bucket", (-F.col("x.d")).alias("leader"))
    return band.join(leader, "bucket").where("doc_id <> leader").select("leader", "doc_id").distinct()


def _sketched(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs (leader, doc_id) whose sketches may reach the threshold, as (u, v, near)."""
    a = sketch.select(F.col("doc_id").alias("leader"), F.col("n").alias("na"), F.col("sketch").alias("a"))
    b = sketch.select("doc_id", F.col("n").alias("nb"), F.col("sketch").alias("b"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ones = np.bitwise_count(_lists(x.column("a"), WORDS) ^ _lists(x.column("b"), WORDS)).sum(axis=1)
            good = ones <= most_ones(x.column("na").to_numpy(), x.column("nb").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays(
                [x.column("leader"), x.column("doc_id"), x.column("leader")], names=["u", "v", "near"]
            ).filter(pa.array(good))

    return (pairs.join(b, "doc_id").join(a, "leader").select("leader", "doc_id", "na", "nb", "a", "b")
            .mapInArrow(tidy(keep), "u long, v long, near long"))


def _cross(band: DataFrame, label: DataFrame, rows: DataFrame, percent: int, bands: int) -> DataFrame:
    """Pairs (u, v, near) of one bucket and two components whose sketches may reach it.

    The members outside a bucket's largest component meet all its members, in
    blocks of about ``BLOCK`` by ``BLOCK`` rows, so that a large bucket is many tasks'.
    A pair counts in the first bucket that the two share.
    """
    named = (band.select("bucket", "doc_id").join(label.withColumnRenamed("id", "doc_id"), "doc_id", "left")
             .withColumn("component", F.coalesce("component", "doc_id")))
    share = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("c"))
    main = (share.groupBy("bucket").agg(F.max(F.struct("c", "component")).alias("x"),
                                        F.count(F.lit(1)).alias("k"), F.sum("c").alias("m")).where("k > 1")
            .select("bucket", F.col("x.component").alias("main"),
                    F.ceil(F.col("m") / BLOCK).cast("int").alias("every"),
                    F.ceil((F.col("m") - F.col("x.c")) / BLOCK).cast("int").alias("few")))
    mixed = scratch_table(named.join(main, "bucket").join(rows, "doc_id"), "dedup-mixed")

    def side(df: DataFrame, own: str, other: str, i: str, j: str, number: int) -> DataFrame:
        return (df.withColumn(i, F.pmod(F.xxhash64("doc_id"), F.col(own)).cast("int"))
                .withColumn(j, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select("bucket", "i", "j", F.lit(number).alias("side"), "doc_id", "component", "main", "n",
                        "bands", "sketch"))

    both = (side(mixed.where("component <> main"), "few", "every", "i", "j", 0)
            .unionByName(side(mixed, "every", "few", "j", "i", 1)))

    def compare(rows_: pa.Table) -> pa.RecordBatch:
        first = rows_.column("side").to_numpy() == 0
        a, b = np.flatnonzero(first), np.flatnonzero(~first)
        doc, comp, n = (rows_.column(c).to_numpy() for c in ("doc_id", "component", "n"))
        main_, bucket = rows_.column("main")[0].as_py(), rows_.column("bucket")[0].as_py()
        sketch = _lists(rows_.column("sketch").combine_chunks(), WORDS)
        band_ = _lists(rows_.column("bands").combine_chunks(), bands)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for x in a:
            y = b[(comp[b] != comp[x]) & ((comp[b] == main_) | (doc[b] > doc[x]))]
            limit = most_ones(np.broadcast_to(n[x], y.shape), n[y], percent)
            y, limit = y[limit >= 0], limit[limit >= 0]
            y = y[np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1) <= limit]
            same = band_[y] == band_[x]
            y = y[band_[x][same.argmax(axis=1)] == np.int64(bucket).view(np.uint64)] if len(y) else y
            found.append((np.full(len(y), x), y))
        u = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
        v = np.concatenate([q for _, q in found]) if found else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(doc[u]), pa.array(doc[v]), pa.array(comp[u])],
                                          names=["u", "v", "near"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the rows of one block so far
        key = None
        for x in batches:
            ids = np.stack([x.column(c).to_numpy() for c in ("bucket", "i", "j")])
            cuts = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1).tolist(), x.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:]):
                if s == e:
                    continue
                if held and tuple(ids[:, s]) != key:
                    yield compare(pa.Table.from_batches(held))
                    held = []
                key = tuple(ids[:, s])
                held.append(x.slice(s, e - s))
        if held:
            yield compare(pa.Table.from_batches(held))

    return (both.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(tidy(meet), "u long, v long, near long"))


def groups(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signs = scratch_table(signatures(texts, s), "dedup-signatures")
    # One set per id; rows without an id link with nothing.
    own = signs.groupBy("doc_id").agg(F.max(F.struct("n", "k1", "k2")).alias("set"))
    full = own.where(F.col("doc_id").isNotNull() & (F.col("set.n") > 0))
    classes = full.groupBy("set").agg(F.min("doc_id").alias("rep"))
    member = scratch_table(full.join(classes, "set").select("doc_id", "rep", "set"), "dedup-members")
    reps = member.where("doc_id = rep").select("doc_id", "set")
    rows = scratch_table(
        signs.join(reps, "doc_id").where(F.struct("n", "k1", "k2") == F.col("set"))
        .dropDuplicates(["doc_id"]).select("doc_id", "n", "bands", "sketch"), "dedup-classes")
    sketch = rows.select("doc_id", "n", "sketch")
    band = _buckets(rows)
    near = scratch_table(texts.join(band.select("doc_id").distinct(), "doc_id", "left_semi"), "dedup-texts")
    held = scratch_table(verify(_sketched(_star(band), sketch, s.percent), near, s, "dedup-star"), "dedup-links")
    label = components(held, "dedup-components")
    more = verify(_cross(band, label, rows, s.percent, s.bands), near, s, "dedup-cross")
    label = components(held.unionByName(more), "dedup-components")
    linked = (member.join(label.withColumnRenamed("id", "rep"), "rep", "left")
              .select("doc_id", F.coalesce("component", "rep").alias("component_id")))
    out = own.join(linked, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("set.n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, but for the documents of a group
    that are not its smallest id.  Rows without an id stay."""
    gone = groups(docs, s, id_col, text_col).where(~F.col("kept")).select("doc_id")
    return docs.join(gone, docs[id_col].cast("long") == gone["doc_id"], "left_anti")
