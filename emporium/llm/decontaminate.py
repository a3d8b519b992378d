"""Benchmark decontamination by CGK embedding, bit sampling and edit distance.

Texts and benchmark items are read as words: runs of letters and digits, in lower
case; each character of a script written without spaces is a word.  A document holds an item if some run of its words is within an edit
distance (insertions, deletions, replacements of words) of ``edits`` percent of
the item's words.

1. The items are cut into windows of their size class, 16 words (8 or 4 for shorter
   items), the last one ending with the item; the documents' windows start at every word.
2. The CGK random walk reads a window's words by steps: at step t it emits the
   word it stands at, and goes on to the next one or stays by a random bit of
   (t, word).  After an edit the walks over two windows soon meet again, so a
   small edit distance becomes a small Hamming distance of what they emit.
3. Each of ``walks`` independent walks is sampled ``samples`` times at ``picks``
   steps; windows that agree in all picks of one sample are candidates, and so are
   equal windows, by a hash of all their words.  With the defaults, items at the full
   edit distance are found in about 98 of 100 cases (a test measures it for items of
   4 words and more), and exact copies always.
4. A candidate must agree with its item's window in ``agree`` of all steps; then
   the edit distance of the whole item to the text around is computed exactly.

Items of fewer than ``MIN_WORDS`` words allow no edit: a hash of the whole item at
every word finds them.

Windows with fewer than ``familiar`` of their words among the benchmark's words
are not walked: they hold more edits than twice the share allowed.

The items are held by every task, in blocks of at most ``block_chars`` characters
of items; a larger benchmark takes one pass per block.  Documents are read once
per block and nothing but the finds is shuffled.

Defined results: null and empty texts hold nothing; items that are null or
hold no word are held by no document; equal items, items without id and repeated
documents are found each; empty tables give no rows; other columns are ignored
or, in ``keep_clean``, returned as they are.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import chunks, letter_runs, mix, span_hashes, string_buffers, tidy

MIN_WORDS = 4  # of a window
_SIZES = (16, 8, 4)  # windows in words
_PAD = 64


@dataclass(frozen=True)
class Settings:
    edits: int = 20  # percent of an item's words
    walks: int = 2
    samples: int = 16
    picks: int = 5
    agree: float = 0.4
    familiar: float = 0.6
    seed: int = 11
    block_chars: int = 32_000_000


def _characters(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans, cut at every character of a script without spaces; its punctuation is left out.

    By their lead bytes in UTF-8: U+3000 to U+9FFF, U+20000 on and U+FF00 to U+FFFF
    (Chinese, Japanese, full width), Thai, Lao, Khmer and Burmese.
    """
    if not len(starts) or not (low >= 0xE0).any():
        return starts, ends
    after = np.concatenate([low[1:], [0]])
    third = np.concatenate([low[2:], [0, 0]])
    wide = ((low >= 0xE3) & (low <= 0xE9)) | ((low == 0xEF) & (after >= 0xBC))
    wide |= (low == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
    wide |= (low == 0xE1) & (((after >= 0x80) & (after <= 0x82)) | (after == 0x9E) | (after == 0x9F))
    far = (low == 0xF0) & (after >= 0xA0)
    alone = np.flatnonzero(wide | far)
    if not len(alone):
        return starts, ends
    beyond = alone + np.where(far[alone], 4, 3)
    own = np.searchsorted(starts, alone, side="right") - 1
    beyond = np.minimum(beyond, ends[own])  # a broken last character
    cuts = np.unique(np.concatenate([starts, alone, beyond[beyond < ends[own]]]))
    stop = np.minimum(np.concatenate([cuts[1:], [len(low)]]), ends[np.searchsorted(starts, cuts, side="right") - 1])
    mark = (low == 0xE3) & (after == 0x80) | (low == 0xEF) & (after == 0xBC) & ((third < 0x90) | (third > 0x99)) \
        & ((third < 0xA1) | (third > 0xBA))
    keep = ~mark[cuts]
    return cuts[keep], stop[keep]


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, first word of every text and the end) of a chunk."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low, starts, ends = letter_runs(data, offsets, digits=True)
    starts, ends = _characters(low, starts, ends)
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


def _run_keys(words: np.ndarray, size: int) -> np.ndarray:
    """A key of every run of ``size`` words."""
    n = max(0, len(words) - size + 1)
    key = np.full(n, size, np.uint64)
    for j in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + words[j:j + n]
    return mix(key)


def _steps(size: int) -> int:
    return size + size // 2  # a walk of n steps passes n / 2 words on average


class Walks:
    """The random bits of the walks and the steps that the samples pick."""

    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        longest = _steps(max(_SIZES))
        self.s = s
        self.coins = rng.integers(0, 1 << 63, (s.walks, longest), np.uint64) * np.uint64(2) + np.uint64(1)
        self.picks = {size: [[np.sort(rng.choice(_steps(size), s.picks, replace=False)) for _ in range(s.samples)]
                             for _ in range(s.walks)] for size in _SIZES}
        self.weights = rng.integers(0, 1 << 63, (s.picks,), np.uint64) * np.uint64(2) + np.uint64(1)

    def emitted(self, words: np.ndarray, starts: np.ndarray, walk: int, size: int) -> np.ndarray:
        """What the walk emits over the windows at ``starts``: (steps, windows)."""
        out = np.empty((_steps(size), len(starts)), np.uint64)
        at = starts.copy()
        for t in range(len(out)):
            out[t] = words[at]
            at += ((out[t] * self.coins[walk, t]) >> np.uint64(63)).astype(np.int64)
        return out

    def keys(self, emitted: np.ndarray, walk: int, size: int) -> Iterator[np.ndarray]:
        """The key of every window in each sample."""
        for n, picks in enumerate(self.picks[size][walk]):
            key = emitted[picks[0]] * self.weights[0]
            for t, w in zip(picks[1:], self.weights[1:]):
                key = key + emitted[t] * w
            yield mix(key + np.uint64(n))


class Items:
    """The windows of a block of items, indexed by their keys."""

    def __init__(self, ids: list[int], texts: list[str], s: Settings):
        self.s, self.walks = s, Walks(s)
        data, offsets = string_buffers(pa.array(texts, pa.large_string()))
        h, first = text_words(data, offsets)
        self.items = [(i, h[a:b]) for i, a, b in zip(ids, first[:-1], first[1:]) if b > a]
        self.known = np.zeros(1 << 22, bool)  # a sieve of the benchmark's words
        for _, w in self.items:
            self.known[(w >> np.uint64(42)).astype(np.int64)] = True
        self.by_size: dict[int, dict] = {}
        windows = defaultdict(list)  # size -> (item, offset)
        whole = defaultdict(list)  # number of words -> items
        for k, (_, w) in enumerate(self.items):
            if len(w) < MIN_WORDS:
                whole[len(w)].append(k)
                continue
            size = next(x for x in _SIZES if len(w) >= x)
            for o in sorted({*range(0, len(w) - size + 1, size), len(w) - size}):
                windows[size].append((k, o))
        for size, own in windows.items():
            emitted = []
            for walk in range(s.walks):
                emitted.append(np.concatenate([
                    self.walks.emitted(np.concatenate([self.items[k][1], np.zeros(_PAD, np.uint64)]),
                                       np.array([o]), walk, size) for k, o in own], axis=1))
            keys = [[self._index(k) for k in self.walks.keys(e, walk, size)] for walk, e in enumerate(emitted)]
            keys[0].append(self._index(np.concatenate([_run_keys(self.items[k][1][o:o + size], size) for k, o in own])))
            self.by_size[size] = {"windows": np.array(own, np.int64), "emitted": emitted, "keys": keys}

        self.short = {n: (np.array(own), *self._index(np.concatenate([_run_keys(self.items[k][1], n) for k in own])))
                      for n, own in whole.items()}

    @staticmethod
    def _index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.uint64]:
        bits = min(22, max(12, int(np.ceil(np.log2(len(keys) * 256)))))
        sieve = np.zeros(1 << bits, bool)
        shift = np.uint64(64 - bits)
        sieve[(keys >> shift).astype(np.int64)] = True
        order = np.argsort(keys, kind="stable")
        return keys[order], order, sieve, shift

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, word where the item would begin) of a chunk's windows."""
        found = []
        padded = np.concatenate([words, np.zeros(_PAD, np.uint64)])
        if not self.by_size:
            return np.zeros((0, 2), np.int64)
        familiar = np.concatenate([[0], np.cumsum(self.known[(padded >> np.uint64(42)).astype(np.int64)])])
        for size, own in self.by_size.items():
            seen = familiar[size:len(words) + size] - familiar[:len(words)]
            starts = np.flatnonzero(seen >= self.s.familiar * size)
            for walk in range(self.s.walks):
                emitted = self.walks.emitted(padded, starts, walk, size)
                hits = []
                equal = [_run_keys(padded, size)[starts]] if walk == 0 else []
                for key, (keys, order, sieve, shift) in zip(chain(self.walks.keys(emitted, walk, size), equal),
                                                            own["keys"][walk], strict=True):
                    maybe = np.flatnonzero(sieve[(key >> shift).astype(np.int64)])
                    k = key[maybe]
                    lo, hi = np.searchsorted(keys, k), np.searchsorted(keys, k, side="right")
                    n = hi - lo
                    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    hits.append(np.repeat(maybe, n) * len(order) + order[at])
                pair = np.unique(np.concatenate(hits))
                if not len(pair):
                    continue
                at, window = pair // len(own["windows"]), pair % len(own["windows"])
                same = np.zeros(len(pair), np.int64)
                for t in range(len(emitted)):
                    same += emitted[t][at] == own["emitted"][walk][t][window]
                good = same >= self.s.agree * len(emitted)
                item, offset = own["windows"][window[good]].T
                found.append(np.stack([item, starts[at[good]] - offset]))
        if not found:
            return np.zeros((0, 2), np.int64)
        return np.unique(np.concatenate(found, axis=1).T, axis=0)

    def copies(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, text, word in the text) of the first copy of each short item in each text."""
        for n, (own, keys, order, sieve, shift) in self.short.items():
            key = _run_keys(words, n)
            at = np.flatnonzero(sieve[(key >> shift).astype(np.int64)])
            text = np.searchsorted(first, at, side="right") - 1
            inside = at + n <= first[text + 1]
            at, text = at[inside], text[inside]
            lo, hi = np.searchsorted(keys, key[at]), np.searchsorted(keys, key[at], side="right")
            at, text, lo, hi = (x[hi > lo] for x in (at, text, lo, hi))
            # The first place of each run in each text; equal items are few.
            _, once = np.unique(np.stack([text, lo]), axis=1, return_index=True)
            for i in once.tolist():
                for k in order[lo[i]:hi[i]].tolist():
                    yield int(own[k]), int(text[i]), int(at[i] - first[text[i]])

    def best(self, item: int, words: np.ndarray, at: int) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best run of ``words`` near ``at``, if close enough."""
        pattern = self.items[item][1]
        most = len(pattern) * self.s.edits // 100
        a, b = max(0, at - most - _SIZES[0]), min(len(words), at + len(pattern) + most + _SIZES[0])
        text = words[a:b].tolist()
        edits, end = _closest(pattern.tolist(), text)
        if edits > most:
            return None
        edits, back = _closest(pattern[::-1].tolist(), text[:end][::-1], anchored=True)
        return edits, a + end - back, a + end


def _closest(pattern: list[int], text: list[int], anchored: bool = False) -> tuple[int, int]:
    """Least edit distance of the pattern to a run of the text, and the run's end.

    Bit-parallel dynamic programming, one column of the pattern in one integer;
    the run may begin anywhere, or at the text's begin if ``anchored``.
    """
    m = len(pattern)
    full, top = (1 << m) - 1, 1 << (m - 1)
    eq: dict[int, int] = {}
    for i, x in enumerate(pattern):
        eq[x] = eq.get(x, 0) | (1 << i)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, x in enumerate(text, start=1):
        e = eq.get(x, 0)
        xv = e | minus
        xh = (((e & plus) + plus) ^ plus) | e
        up, down = minus | (full & ~(xh | plus)), plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = ((up << 1) | int(anchored)) & full, (down << 1) & full
        plus, minus = down | (full & ~(xv | up)), up & xv
        if score < best:
            best, end = score, j
    return best, end


def _finds(items: Items, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(text, item_id, edits, item_words, start_word, end_word): the best of each
    item in each text of a chunk."""
    words, first = text_words(data, offsets)
    if not len(words) or not items.items:
        return
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    done: set[tuple[int, int, int]] = set()
    for item, at in items.candidates(words).tolist():
        middle = min(max(0, at + len(items.items[item][1]) // 2), len(words) - 1)
        text = int(np.searchsorted(first, middle, side="right")) - 1
        a, b = int(first[text]), int(first[text + 1])
        near = (item, text, (at - a) // 8)  # the neighbourhood is searched as a whole
        if near in done:
            continue
        done.add(near)
        got = items.best(item, words[a:b], at - a)
        if got is not None and got < best.get((text, item), (1 << 30, 0, 0)):
            best[text, item] = got
    for item, text, start in items.copies(words, first):
        best[text, item] = 0, start, start + len(items.items[item][1])
    for (text, item), (edits, start, end) in sorted(best.items()):
        yield text, items.items[item][0], edits, len(items.items[item][1]), start, end


def _blocks(benchmark: DataFrame, s: Settings, id_col: str, text_col: str) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_chars`` characters, one if it is smaller."""
    own = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // s.block_chars))
    return [own.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def find(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
         text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, item_words, start_word, end_word) of every find."""
    schema = "doc_id long, item_id long, edits int, item_words int, start_word long, end_word long"
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in _blocks(benchmark, s, item_col, item_text):
        rows = block.orderBy("item_id", "text").collect()  # at most about block_chars characters

        def search(batches: Iterator[pa.RecordBatch], rows=[(r.item_id, r.text) for r in rows]):
            items = Items([i for i, _ in rows], [t for _, t in rows], s)
            for b in batches:
                data, offsets = string_buffers(b.column("text"))
                ids = b.column("doc_id").to_pylist()
                got = [(ids[i + x[0]], *x[1:]) for i, _, part, offs in chunks(data, offsets)
                       for x in _finds(items, part, offs)]
                cols = list(zip(*got)) or [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32(),
                                                           pa.int64(), pa.int64()))],
                    names=["doc_id", "item_id", "edits", "item_words", "start_word", "end_word"])

        part = own.mapInArrow(tidy(search), schema)
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, s: Settings = Settings(), text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no item."""
    names, at, schema = docs.columns, docs.columns.index(text_col), docs.schema
    for block in _blocks(benchmark, s, item_col, item_text):
        rows = block.orderBy("item_id", "text").collect()  # at most about block_chars characters

        def keep(batches: Iterator[pa.RecordBatch], rows=[(r.item_id, r.text) for r in rows]):
            items = Items([i for i, _ in rows], [t for _, t in rows], s)
            for b in batches:
                data, offsets = string_buffers(b.column(at))
                clean = np.ones(b.num_rows, bool)
                for i, _, part, offs in chunks(data, offsets):
                    for x in _finds(items, part, offs):
                        clean[i + x[0]] = False
                yield pa.RecordBatch.from_arrays(b.columns, names=names).filter(pa.array(clean))

        docs = docs.mapInArrow(tidy(keep), schema)
    return docs
