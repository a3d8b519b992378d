"""Ranked lexical search by NRA: impact-sorted lists read without random access.

Every document is scored for every item by the terms they share; the impact of a term
in a document is an integer of its weight, its occurrences and the document's length.

1. Items travel to the tasks in blocks of at most ``block_chars`` characters and
   ``block_items`` items; a larger benchmark takes one pass over the documents per block.
2. Documents become rows of the block's terms and their occurrences, written once.  The
   numbers of documents and terms and every term's document count come from those rows.
3. A task takes its rows in shards of about ``shard_postings`` postings and sorts every
   term's list of a shard by falling impact.
4. NRA reads an item's lists side by side, deeper each round.  A document's lower bound
   is what was read of it; its upper bound adds, for each list where it has not been met,
   the last impact read there.  Reading ends when no document that is still unknown can
   reach the k-th lower bound and every document whose upper bound reaches it has equal
   bounds: members, ties and scores are then final.
5. The k-th score found so far, in earlier shards and by a first round over one in
   ``first`` documents, is the bound that later shards begin with; most of their lists
   are left early.  A window over what the tasks found ranks the whole.

Terms are told apart by 64-bit hashes.  Scores below 2^53 are exact.

Defined results: a null or empty text has no terms, finds nothing and is found by
nothing; every row of the items is an item of its own, also with a null or repeated id;
repeated documents are ranked each; of equal scores the smaller id comes first, null
last; empty tables give no rows; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.llm.common import _LOWER, chunks, scratch_table, span_hashes, string_buffers

_TERM = np.zeros(256, bool)  # bytes of terms: 0-9, A-Z, a-z and all beyond ASCII
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True


@dataclass(frozen=True)
class Settings:
    k: int = 50
    depth: int = 64  # postings of each list read in the first round
    deeper: int = 4  # by how much the depth grows a round
    chunk_bytes: int = 1 << 18  # bytes of text that a task tokenises at once
    shard_postings: int = 1 << 19
    first: int = 16
    block_chars: int = 4_000_000
    block_items: int = 20_000


def text_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every term, terms per text); A-Z is lower-cased."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    solid = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.r_[False, solid[:-1]]))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.r_[solid[1:], False])) + 1
    return span_hashes(_LOWER[data], starts, ends), np.diff(np.searchsorted(starts, offsets))


class Items:
    """A block of items: a sorted vocabulary and each item's distinct terms in it."""

    def __init__(self, texts: list[str | None]):
        h, n = text_terms(*string_buffers(pa.array(texts, pa.large_string())))
        self.vocabulary, at = np.unique(h, return_inverse=True)
        self.terms = [np.unique(x) for x in np.split(at, np.cumsum(n)[:-1])] if texts else []


def _postings(docs: DataFrame, vocabulary: np.ndarray, s: Settings) -> DataFrame:
    """(doc_id, n, term, tf): a document's number of terms and those of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = string_buffers(b.column("text"))
            for i, j, part, offs in chunks(data, offsets, s.chunk_bytes):
                h, n = text_terms(part, offs)
                at = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
                hit = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
                text = np.repeat(np.arange(j - i), n)[hit]
                key, tf = np.unique(text * max(1, len(vocabulary)) + at[hit], return_counts=True)
                text, term = np.divmod(key, max(1, len(vocabulary)))
                ends = pa.array(np.searchsorted(text, np.arange(j - i + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))],
                    names=["doc_id", "n", "term", "tf"])

    return docs.mapInArrow(count, "doc_id long, n long, term array<int>, tf array<int>")


def resolve(heads: np.ndarray, lengths: np.ndarray, docs: np.ndarray, impact: np.ndarray, size: int,
            s: Settings, least: int) -> tuple[np.ndarray, np.ndarray]:
    """NRA over lists that start at ``heads`` of ``docs`` and ``impact`` (falling in each list).

    Returns (documents, scores): all that reach the k-th greatest score, ties included,
    and ``least`` (at least 1).
    """
    depth = s.depth
    while True:
        read = np.minimum(lengths, depth)
        of = np.repeat(np.arange(len(read)), read)
        at = np.repeat(heads - np.cumsum(read) + read, read) + np.arange(len(of))
        last = np.where(read < lengths, impact[heads + read - 1], 0)  # bounds what is unread
        unread = int(last.sum())
        met = docs[at]
        low = np.bincount(met, impact[at], minlength=size)
        beyond = unread - np.bincount(met, last[of], minlength=size)
        seen = np.flatnonzero(low)
        low, high = low[seen], low[seen] + beyond[seen]
        cut = least
        if len(seen) >= s.k:
            cut = max(cut, int(np.partition(low, len(low) - s.k)[len(low) - s.k]))
        alive = high >= cut
        if unread < cut and (low[alive] == high[alive]).all():
            return seen[alive], low[alive].astype(np.int64)
        depth *= s.deeper


class Best:
    """The k best documents of one item so far."""

    def __init__(self, least: int):
        self.least = max(1, least)
        self.score, self.null, self.doc = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, null: np.ndarray, doc: np.ndarray, k: int) -> None:
        score, null, doc = np.r_[self.score, score], np.r_[self.null, null], np.r_[self.doc, doc]
        order = np.lexsort((doc, null, -score))[:k]
        self.score, self.null, self.doc = score[order], null[order], doc[order]
        if len(order) == k:
            self.least = max(self.least, int(self.score[-1]))


class Corpus:
    """What the scores take from the whole corpus."""

    def __init__(self, n_docs: int, n_terms: int, counts: np.ndarray):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(c) + 1))) for c in counts],
                               np.int64)

    def impact(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        m = 100 - 50 + (50 * n * self.n_docs) // max(1, self.n_terms)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _shards(batches: Iterator[pa.RecordBatch], postings: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += len(b.column("term").flatten())
        if size >= postings:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _search_shard(shard: pa.Table, items: Items, corpus: Corpus, best: list[Best], s: Settings) -> None:
    doc_id = shard["doc_id"].combine_chunks()
    null, ids = doc_id.is_null().to_numpy(zero_copy_only=False), doc_id.fill_null(0).to_numpy()
    term = shard["term"].combine_chunks()
    doc = np.repeat(np.arange(len(ids)), term.value_lengths().to_numpy())
    term = term.flatten().to_numpy().astype(np.int64)
    tf = shard["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
    impact = corpus.impact(term, tf, shard["n"].to_numpy()[doc])
    order = np.lexsort((-impact, term))
    order = order[impact[order] > 0]
    doc, impact = doc[order], impact[order]
    head = np.searchsorted(term[order], np.arange(len(items.vocabulary) + 1))
    for terms, b in zip(items.terms, best):
        lengths = head[terms + 1] - head[terms]
        lists = terms[lengths > 0]
        if len(lists):
            found, score = resolve(head[lists], lengths[lengths > 0], doc, impact, len(ids), s, b.least)
            b.add(score, null[found], ids[found], s.k)


def _found(rows: DataFrame, items: Items, corpus: Corpus, s: Settings, least: dict[int, int]) -> DataFrame:
    """(item, doc_id, score): of each task, the k best documents of every item that reach ``least``."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(least.get(i, 1)) for i in range(len(items.terms))]
        for shard in _shards(batches, s.shard_postings):
            _search_shard(shard, items, corpus, best, s)
        for i in range(0, len(best), 1000):
            part = best[i:i + 1000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(i, i + len(part)), [len(b.doc) for b in part]), pa.int32()),
                 pa.array(np.concatenate([b.doc for b in part]), pa.int64(),
                          mask=np.concatenate([b.null for b in part])),
                 pa.array(np.concatenate([b.score for b in part]), pa.int64())],
                names=["item", "doc_id", "score"])

    return rows.mapInArrow(search, "item int, doc_id long, score long")


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of every item, with their rank; first within parts of each item."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(16)))
    parts = (parts.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order)))
             .where(F.col("rank") <= k))
    whole = Window.partitionBy("item").orderBy(*order)
    return parts.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).drop("part")


def _blocks(items: DataFrame, s: Settings) -> list[DataFrame]:
    size, n = items.agg(F.sum(F.length("text")), F.count(F.lit(1))).first()
    blocks = max(-(-(size or 0) // s.block_chars), -(-n // s.block_items), 1)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i) for i in range(blocks)]


def _rank_block(docs: DataFrame, block: DataFrame, s: Settings) -> DataFrame:
    spark = docs.sparkSession
    # at most about block_chars characters and block_items rows
    rows = block.orderBy("item_id", "text").collect()
    items = Items([r.text for r in rows])
    postings = scratch_table(_postings(docs, items.vocabulary, s), "nra-postings")
    n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    counts = np.zeros(len(items.vocabulary), np.int64)
    for r in postings.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # of the block's terms
        counts[r.t] = r["count"]
    corpus = Corpus(n_docs, n_terms or 0, counts)
    early = F.pmod(F.xxhash64("doc_id"), F.lit(s.first)) == 0
    first = scratch_table(_found(postings.where(early), items, corpus, s, {}), "nra-first")
    least = {r.item: r.score for r in _best_rows(first, s.k).where(F.col("rank") == s.k).collect()}  # one an item
    rest = scratch_table(_found(postings.where(~early), items, corpus, s, least), "nra-rest")
    ranked = _best_rows(first.unionByName(rest), s.k)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id long")
    return scratch_table(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "nra-ranked")


def rank(docs: DataFrame, items: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    out = None
    for block in _blocks(asked, s):
        part = _rank_block(own, block, s)
        out = part if out is None else out.unionByName(part)
    return out
